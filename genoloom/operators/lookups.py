"""Small lookup tables applied to columns: unknown values keep their own name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import q

#: Rows and bytes (of their JSON form) up to which a lookup is broadcast; beyond, Spark joins it by key.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows of ``size`` bytes in all; measuring stops one row later."""
    each = F.length(F.to_json(F.struct(*map(q, df.columns)))).cast("bigint")
    n, held = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(each), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and held <= size else df


def replace_by(df: DataFrame, column: str, lookup: DataFrame, alias: str, name: str) -> DataFrame:
    """``column`` replaced by the lookup's ``name`` where its ``alias`` equals it, unchanged elsewhere.

    An alias given twice keeps its smallest name, so no row is multiplied; nulls stay null.
    """
    table = lookup.where(q(alias).isNotNull()).groupBy(q(alias).alias("_alias")).agg(F.min(q(name)).alias("_name"))
    joined = df.join(small(table), q(column) == F.col("_alias"), "left")
    return joined.withColumn(column, F.coalesce("_name", q(column).cast("string"))).select(*map(q, df.columns))
