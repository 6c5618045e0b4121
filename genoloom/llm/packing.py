"""Packing into optimal length buckets and token-budget batches.

1. Whole texts are measured in tokens (words and one end token). A text of more than ``max_len`` tokens
   becomes consecutive pieces of at most ``max_len``; nothing is cut away.
2. The global histogram of piece lengths has at most ``max_len`` entries whatever the corpus; dynamic
   programming over it chooses at most ``n_buckets`` boundaries that minimise the padding tokens.
3. A batch of bucket b holds ``budget // boundary_b`` pieces, so its padded size keeps to the budget.
   Batches are cut from a fixed order inside each bucket.

Scale: pieces are sorted by bucket, key, piece, length and a row number that was written with them, so even a key that holds a
third of all rows is cut over many tasks. Ranks inside a bucket are counts of the ranges before (a row a range and bucket,
at most ``RANGES`` and a few) plus the place in the range; only keys and lengths are shuffled, never texts. The order is a
function of the rows alone but among equal ones, and ranges are written, so a task that runs again gives the same batches.

Defined results: null text is empty (one end token); empty input gives no batch; rows that repeat a
doc_id are packed each, equal rows in any order among themselves; extra columns are not carried.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, table, words

MAX_LEN = 4096
N_BUCKETS = 16
BUDGET = 65_536
RANGE_ROWS = 20_000
RANGES = 20_000


def boundaries(histogram: dict[int, int], n_buckets: int = N_BUCKETS) -> list[int]:
    """Bucket boundaries (largest length of each bucket) with the least padding, by exact dynamic
    programming: cost(i, j) pads lengths i+1..j to length j. Fewest buckets on ties, then the smallest
    boundaries. An empty histogram gives no boundary."""
    lengths = sorted(n for n, count in histogram.items() if count)
    if not lengths:
        return []
    size = np.array(lengths, np.int64)
    count = np.concatenate([[0], np.cumsum([histogram[n] for n in lengths])]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum([n * histogram[n] for n in lengths])]).astype(np.int64)
    m = len(lengths)
    far = np.iinfo(np.int64).max // 4
    best = np.full(m + 1, far, np.int64)
    best[0] = 0
    choices, costs = [], []
    for _ in range(min(n_buckets, m)):
        new, choice = np.full(m + 1, far, np.int64), np.zeros(m + 1, np.int32)
        for j in range(1, m + 1):
            cost = best[:j] + size[j - 1] * (count[j] - count[:j]) - (total[j] - total[:j])
            choice[j] = cost.argmin()
            new[j] = cost[choice[j]]
        choices.append(choice)
        costs.append(int(new[m]))
        best = new
    k = int(np.argmin(costs))
    out, j = [], m
    while j:
        out.append(lengths[j - 1])
        j, k = int(choices[k][j]), k - 1
    return out[::-1]


def pack_pieces(docs: DataFrame, max_len: int, key: str = "doc_id", n_tokens: Column | None = None) -> DataFrame:
    """(doc_id, piece, start, n_tokens): consecutive pieces that cover each document's tokens."""
    length = (F.size(words(F.col("text"))) + 1 if n_tokens is None else n_tokens).cast("bigint")
    sized = docs.select(F.col(key).alias("doc_id"), length.alias("whole"))
    last = F.expr(f"CAST((whole - 1) DIV {max_len} AS INT)")
    cut = sized.select("doc_id", "whole", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("bigint") * max_len
    return cut.select(
        "doc_id", "piece", start.alias("start"), F.least(F.lit(max_len), F.col("whole") - start).alias("n_tokens")
    )


def pack(
    docs: DataFrame, max_len: int = MAX_LEN, n_buckets: int = N_BUCKETS, budget: int = BUDGET, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bucket_len, batch, slot) for every piece of every document."""
    if not 0 < max_len <= budget:
        raise ValueError("max_len must be positive and within the budget")
    cut = table(pack_pieces(docs, max_len).withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("n_tokens").count().collect()}  # at most max_len rows
    edges = boundaries(histogram, n_buckets)
    if not edges:
        empty = cut.drop("row").withColumns({"bucket_len": F.lit(0).cast("bigint"), "batch": F.lit(0).cast("bigint")})
        return empty.withColumn("slot", F.lit(0).cast("bigint"))
    ranges = min(max(1, -(-sum(histogram.values()) // range_rows)), RANGES)
    bucket = F.element_at(F.array(*map(F.lit, edges)), F.expr(f"1 + size(filter(array({','.join(map(str, edges))}), e -> e < n_tokens))"))
    order = ["bucket_len", F.col("doc_id").asc_nulls_first(), "piece", "n_tokens", "row"]
    ranged = cut.withColumn("bucket_len", bucket.cast("bigint")).repartitionByRange(int(ranges), *order).sortWithinPartitions(*order)
    places = {"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}
    placed = table(ranged.withColumns(places).drop("row"), "placed")
    counts = placed.groupBy("bucket_len", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("bucket_len").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("bucket_len", "range", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    ranked = placed.join(F.broadcast(ahead), ["bucket_len", "range"])  # at most RANGES + n_buckets rows
    rank, each = F.col("ahead") + F.col("at") - F.col("first"), F.expr(f"{budget} DIV bucket_len")
    return ranked.withColumns({"rank": rank, "each": each}).select(
        "doc_id", "piece", "start", "n_tokens", "bucket_len", F.expr("rank DIV each").alias("batch"), F.expr("rank % each").alias("slot")
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir, "doc_id", "text"))


#: The dynamic programming as a recursion over the number of buckets, with the chosen boundaries as a list.
SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '')) + 1 AS BIGINT) AS whole FROM documents
), cut AS (
  SELECT doc_id, CAST(p AS INTEGER) AS piece, CAST(p * {MAX_LEN} AS BIGINT) AS start, CAST(least({MAX_LEN}, whole - p * {MAX_LEN}) AS BIGINT) AS n_tokens
  FROM (SELECT doc_id, whole, unnest(range(0, (whole - 1) // {MAX_LEN} + 1)) AS p FROM sized)
), lengths AS (
  SELECT n_tokens AS size, count(*) AS c, row_number() OVER (ORDER BY n_tokens) AS j FROM cut GROUP BY n_tokens
), upto AS (
  SELECT CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS size, CAST(0 AS BIGINT) AS c, CAST(0 AS BIGINT) AS t
  UNION ALL SELECT j, size, CAST(sum(c) OVER (ORDER BY j) AS BIGINT), CAST(sum(c * size) OVER (ORDER BY j) AS BIGINT) FROM lengths
), best AS (
  SELECT 0 AS k, CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS cost, CAST([] AS BIGINT[]) AS edges
  UNION ALL
  SELECT k, j, x.cost, list_append(x.edges, size) FROM (
    SELECT b.k + 1 AS k, u.j, u.size, min({{'cost': b.cost + u.size * (u.c - a.c) - (u.t - a.t), 'i': b.j, 'edges': b.edges}}) AS x
    FROM best b JOIN upto a ON a.j = b.j JOIN upto u ON u.j > b.j WHERE b.k < {N_BUCKETS} GROUP BY b.k, u.j, u.size)
), chosen AS (
  SELECT edges FROM best WHERE j = (SELECT max(j) FROM upto) AND k > 0 ORDER BY cost, k LIMIT 1
), ranked AS (
  SELECT cut.*, row_number() OVER (PARTITION BY bucket_len ORDER BY doc_id NULLS FIRST, piece, n_tokens) - 1 AS r
  FROM (SELECT cut.*, list_min(list_filter(edges, lambda e: e >= n_tokens)) AS bucket_len FROM cut, chosen) cut
)
SELECT doc_id, piece, start, n_tokens, bucket_len, r // ({BUDGET} // bucket_len) AS batch, r % ({BUDGET} // bucket_len) AS slot FROM ranked
"""
