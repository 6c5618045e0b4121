"""Interval joins by bins: an equality join on (contig, bin) with the exact test after it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import q


def strand_window(df: DataFrame, tss: str = "tss", strand: str = "strand", before: int = 50, after: int = 200) -> DataFrame:
    """``low`` and ``high`` (both inclusive) around a transcription start, mirrored on the minus strand."""
    plus = q(strand) != "-"
    return df.withColumns(
        {
            "low": F.when(plus, q(tss) - before).otherwise(q(tss) - after),
            "high": F.when(plus, q(tss) + after).otherwise(q(tss) + before),
        }
    )


def range_join(points: DataFrame, windows: DataFrame, contig: str, at: str, low: str = "low", high: str = "high", width: int = 1000) -> DataFrame:
    """Rows of ``points`` with each window of the same contig that holds ``at`` (bounds inclusive).

    A window stands in every bin of ``width`` that it touches and a point in one, so each pair meets once. Choose a
    width near the typical window: windows much longer than it are repeated, points of a bin much shorter collide.
    """
    bins = F.sequence(F.floor(q(low) / width), F.floor(q(high) / width))
    dealt = windows.where(q(low) <= q(high)).withColumn("_bin", F.explode(bins)).withColumnRenamed(contig, "_contig")
    placed = points.withColumn("_bin", F.floor(q(at) / width))
    on = (placed[contig] == dealt["_contig"]) & (placed["_bin"] == dealt["_bin"])
    joined = placed.join(dealt, on & (q(at) >= q(low)) & (q(at) <= q(high)))
    return joined.drop("_bin", "_contig")
