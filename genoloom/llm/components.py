"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step gives every node the smallest neighbour seen (large star: to its larger neighbours, small star: to
its smaller ones and itself), so paths fold and every component ends as a star around its smallest node,
after a number of rounds that grows with the logarithm of its size. Links never reach the driver; each round
is written to the shared folder, so a lost executor costs one round. Minima are pre-aggregated before the
shuffle and the joins can be split by Spark where one node holds very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b) with a > b."""
    if large:
        links = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        links = edges
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    joined = links.join(least, F.col("a") == F.col("k"))
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b) that isn't the smallest of its component; label is the
    smallest. Loops and repeated links are allowed; an empty table gives an empty one."""
    now = table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")
    mark = None
    while True:
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark or row[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
        mark = tuple(row)
        now = table(star(star(now, True), False), "links")
