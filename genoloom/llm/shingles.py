"""Texts whose sets of five-word shingles have a Jaccard similarity of ``LEAST`` or more, and the groups they link.

SimHash says which texts to compare: the fingerprints of their sets are indexed by deletion variants (``simhash.similar_scheme``),
and pairs that share a key and are near are proposed. Whether two texts are linked is decided on their whole sets of
shingle hashes. A pair at a similarity of 0.8 isn't proposed with a probability of about 0.005, fewer above; that pair is
still found if other texts chain the two.

Texts that are proposed for each other, directly or by a chain, are one cluster. A cluster's sets meet in one task, where a
breadth-first search finds a spanning forest of its links: every text found is compared with all texts not found yet, so
whatever is linked within a cluster is connected, whether the pair shares a key or not. No cluster is capped.

Scale: texts with equal sets are one node, whatever their number. Keys grow in width with the number of nodes; the sets of
texts that are near none are never written, and those of the others are shuffled once. A cluster is held by one task, as hashes.

Defined results: null, empty and blank texts have the empty set, equal to each other and similar to nothing else; texts
of fewer words than a shingle are one shingle; rows are linked by their texts alone, so rows that share a doc_id may stand in
several components, and a row without a doc_id is in that of its text; a component without any doc_id has a null name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import arrow_schema, batch_with, extended, pieces, table
from .components import components

SHINGLE = 5
#: The least similarity of a link, as a fraction.
LEAST = (4, 5)
#: Clustered nodes whose ids are broadcast at most; more are joined by a shuffle.
BROADCAST_NODES = 200_000


def hashes(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    return np.unique(simhash.shingle_hashes(text, SHINGLE))


def identity(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed 64-bit integers."""
    from xxhash import xxh3_128_digest

    return tuple(np.frombuffer(xxh3_128_digest(found.tobytes()), np.int64).tolist())


def with_sets(df: DataFrame, words: int) -> DataFrame:
    """``df`` without its text, with the set's name (s0, s1) and its fingerprint of so many words (null for the empty set),
    or its hashes ``found`` where ``words`` is 0."""
    columns = [f"fp{i}" for i in range(words)]
    schema = extended(df.drop("text").schema, ("s0", "bigint"), ("s1", "bigint"), *[(c, "bigint") for c in columns], *([] if words else [("found", "array<bigint>")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for batch in pieces(large, "text"):
                sets = [hashes(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
                names = np.array([identity(s) for s in sets], np.int64).reshape(-1, 2)
                more = {f"s{i}": pa.array(np.ascontiguousarray(names[:, i])) for i in (0, 1)}
                if words:
                    none = np.array([not len(s) for s in sets], bool)
                    fps = np.array([simhash.majority(s, words) for s in sets], np.uint64).reshape(-1, words).view(np.int64)
                    more |= {c: pa.array(np.ascontiguousarray(fps[:, i]), mask=none) for i, c in enumerate(columns)}
                else:
                    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    flat = np.concatenate([np.zeros(0, np.int64), *[s.view(np.int64) for s in sets]])
                    more["found"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield batch_with(batch.drop_columns(["text"]), **more)

    return df.mapInArrow(run, schema)


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Index pairs that connect whatever is linked among the sets, by breadth-first search over exact similarities."""
    sizes = np.array([len(s) for s in sets], np.int64)
    distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    ends = np.cumsum(sizes)
    own = [flat[b - n : b] for b, n in zip(ends, sizes)]
    mark = np.zeros(len(distinct), bool)
    edges, left = [], np.ones(len(sets), bool)
    for start in range(len(sets)):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            keep = left[owner]
            flat, owner = flat[keep], owner[keep]
            if not len(flat):
                return edges
            node = queue.pop()
            while True:
                mark[own[node]] = True
                common = np.bincount(owner[mark[flat]], minlength=len(sets))
                mark[own[node]] = False
                near = np.flatnonzero(left & (LEAST[1] * common >= LEAST[0] * (sizes + sizes[node] - common)))
                left[near] = False
                edges += [(node, x) for x in near.tolist()]
                queue += near.tolist()
                if len(near) or not queue:
                    break
                node = queue.pop()
    return edges


LINKS = "a bigint, b bigint"


def links(rows: DataFrame, nodes: DataFrame, scheme: simhash.Scheme) -> DataFrame:
    """(a, b): links that connect all similar nodes, from rows (r0, r1, text) and nodes (node, r0, r1, fp0, ...)."""
    # texts with the same fingerprint but other sets: the smallest stands for them among the proposals
    whole = nodes.where("fp0 IS NOT NULL")
    heads = table(whole.groupBy(*scheme.columns).agg(F.min("node").alias("node"), F.max("node").alias("last")), "heads")
    same = whole.join(heads.where("node <> last").withColumnRenamed("node", "head"), scheme.columns).where("node <> head")
    meets = simhash.folded(simhash.links(heads.drop("last"), scheme)).union(same.select(F.col("node").alias("a"), F.col("head").alias("b")))
    labels = table(components(meets), "clusters")
    named = labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
    members = table(nodes.select("node", *ROW).join(named, "node"), "members")
    few = members.count() <= BROADCAST_NODES
    again = with_sets(rows.join(F.broadcast(members) if few else members.hint("merge"), list(ROW)).select("label", "node", "text"), 0)
    dealt = again.select("label", "node", "found").repartition("label").sortWithinPartitions("label", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(LINKS)
        label, last, names, sets = None, None, [], []

        def flush() -> pa.RecordBatch:
            pairs = forest(sets) if len(sets) > 1 else []
            ends = [pa.array([names[p[i]] for p in pairs], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, schema=schema)

        for batch in batches:
            for i, name in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if name == last:  # a row that stands twice
                    continue
                if name[0] != label:
                    if sets:
                        yield flush()
                    label, names, sets = name[0], [], []
                last = name
                names.append(name[1])
                sets.append(batch.column(2)[i].values.to_numpy(zero_copy_only=False).view(np.uint64))
        if sets:
            yield flush()

    return dealt.mapInArrow(run, LINKS)


#: Two hashes of a row's key and text name it, whatever its key.
ROW = ("r0", "r1")


def row_names(key: Column, text: Column) -> dict[str, Column]:
    return {"r0": F.xxhash64(key, text), "r1": F.xxhash64(F.lit(1), text, key)}


def classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For rows (doc_id, text, r0, r1): each row's set (doc_id, r0, r1, s0, s1), and each set's class (s0, s1, label) with the
    first row of the class (first: struct of whether its doc_id is null, doc_id, r0, r1)."""
    scheme = simhash.similar_scheme(rows.count())
    named = table(with_sets(rows, scheme.words), "sets")
    whole = ["s0", "s1"]
    least = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", *ROW)).alias("least")
    sets = named.groupBy(*whole).agg(least, *[F.first(c).alias(c) for c in scheme.columns])
    nodes = table(sets.select("*", *[F.col(f"least.{r}").alias(r) for r in ROW], F.monotonically_increasing_id().alias("node")), "nodes")
    labels = table(components(links(rows, nodes, scheme)), "labels")
    own = nodes.select(*whole, "node", "least").join(labels, "node", "left").select(*whole, F.coalesce("label", "node").alias("label"), "least")
    first = own.groupBy("label").agg(F.min("least").alias("first"))
    return named.select("doc_id", *ROW, *whole), own.drop("least").join(first, "label")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, component_id) for every row of ``docs``; a component is named by its smallest doc_id."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *[v.alias(k) for k, v in row_names(F.col(key), F.col(text)).items()])
    named, own = classes(rows)
    return named.join(own, ["s0", "s1"], "left").select("doc_id", F.col("first.doc_id").alias("component_id"))


def unique(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``docs``: that of the smallest key, without a key only where no row has one; of several
    texts under it the one of the smallest hash, of equal rows the smallest. Rows are told apart by key and text, so
    texts that share a key by accident are judged each by itself.

    Only names are compared and shuffled to find the rows that go; texts then lose those by a join, broadcast up to
    ``BROADCAST_NODES`` names. Where a kept row stands more than once, those few are reduced by a shuffle."""
    named_as = row_names(F.col(key), F.col(text))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *[v.alias(k) for k, v in named_as.items()])
    named, own = classes(rows)
    stand = table(named.join(own, ["s0", "s1"]).groupBy(*ROW).agg(F.count(F.lit(1)).alias("n"), F.first("first").alias("first")), "rows")
    kept = (F.col("r0") == F.col("first.r0")) & (F.col("r1") == F.col("first.r1"))
    hinted = lambda d: F.broadcast(d) if d.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES else d.hint("merge")
    own_names = {f"_s_{k}": v for k, v in named_as.items()}
    apart = lambda d: hinted(d.select(*[F.col(k).alias(f"_s_{k}") for k in ROW]))
    left = docs.withColumns(own_names).join(apart(stand.where(~kept)), list(own_names), "left_anti")
    twice = stand.where(kept & (F.col("n") > 1))
    if twice.isEmpty():
        return left.select(*docs.columns)
    single = left.join(apart(twice), list(own_names), "left_anti").select(*docs.columns)
    many = left.join(apart(twice), list(own_names), "left_semi")
    some = many.groupBy(*own_names).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return single.unionByName(some.select("row.*"))
