"""Best row of each group, key checks and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import q


def best_per_group(df: DataFrame, keys: list[str], score: str, nulls_first: bool = False, ties: list[str] | None = None) -> DataFrame:
    """The whole row with the highest ``score`` of each group whose keys are all non-null.

    NaN counts as missing. Missing scores win with ``nulls_first`` and lose otherwise. Ties go to the row that is smallest
    in ``ties`` (all other columns by default). A group is ranked from at most one row a task: maxima of structs
    are pre-aggregated, so a hot group costs no window.
    """
    order = ties if ties is not None else [c for c in df.columns if c not in {*keys, score}]
    rows = df.dropna(subset=keys)
    value = F.when(~F.isnan(q(score).cast("double")), q(score))
    missing = value.isNull()
    rank = F.struct((~missing if nulls_first else missing).alias("m"), (-value.cast("double")).alias("s"), *[q(c) for c in order], F.struct(*map(q, df.columns)).alias("row"))
    best = rows.groupBy(*map(q, keys)).agg(F.min(rank).alias("best"))
    return best.select("best.row.*")


def best_by_window(df: DataFrame, keys: list[str], score: str, ties: list[str]) -> DataFrame:
    """The same with a ranking window, for rows whose columns have no order (maps)."""
    w = Window.partitionBy(*map(q, keys)).orderBy(q(score).desc_nulls_last(), *map(q, ties))
    return df.dropna(subset=keys).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def distinct_union(frames: list[DataFrame], column: str) -> DataFrame:
    """Distinct values of a column over several tables; each is reduced before the union."""
    return reduce(DataFrame.union, [f.select(q(column)).distinct() for f in frames]).distinct()


def cast_void(df: DataFrame, peer: DataFrame) -> DataFrame:
    """Columns of the null type take the type that ``peer`` has for them."""
    types = dict(peer.dtypes)
    return df.withColumns({c: q(c).cast(types[c]) for c, kind in df.dtypes if kind == "void" and c in types})
