"""Join of feature sets on the key columns that they share.

Rules (documented contract): an output is named ``feature.<set>@<path>``, nested fields joined by dots; only listed
variables survive; sets are joined by full outer joins on their common key columns; a set without a broadcast column
(``tissue``) is crossed with that column's distinct values over the other sets; sets that share no key at all are an error; fill values apply after the join; rows
with a null key are removed last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import q
from .groups import distinct_union
from .lookups import small

Variables = dict[str, list]


def selected(name: str, variables: list) -> dict[str, Column]:
    """Output columns of one set: entries are column names or ``{struct: [fields]}``, to any depth."""
    out: dict[str, Column] = {}

    def walk(path: list[str], column: Column | None, entries: list) -> None:
        for entry in entries:
            items = entry.items() if isinstance(entry, dict) else [(entry, None)]
            for key, below in items:
                here = q(key) if column is None else column.getField(key)
                if below is None:
                    out[f"feature.{name}@{'.'.join([*path, key])}"] = here
                else:
                    walk([*path, key], here, below)

    walk([], None, variables)
    return out


def join_featuresets(
    sets: dict[str, DataFrame], variables: Variables, keys: list[str], fill: dict[str, object] | None = None,
    broadcast_columns: tuple[str, ...] = ("tissue",), how: str = "full",
) -> DataFrame:
    """One table of all sets' selected variables by their keys; see the module's rules."""
    values = {}
    for c in broadcast_columns:
        having = [df for df in sets.values() if c in df.columns]
        if having:
            values[c] = distinct_union(having, c)
    parts = []
    for name, df in sets.items():
        own = [k for k in keys if k in df.columns]
        part = df.select(*map(q, own), *[v.alias(k) for k, v in selected(name, variables.get(name, [])).items()])
        for c, v in values.items():
            if c not in own:
                part = part.crossJoin(small(v))
        parts.append(part)

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        on = [k for k in keys if k in a.columns and k in b.columns]
        if not on:
            raise ValueError(f"feature sets share none of the keys {keys}")
        return a.join(b, on, how)

    out = reduce(join, parts)
    present = [k for k in keys if k in out.columns]
    out = out.dropna(subset=present).select(*present, *[q(c) for c in out.columns if c not in present])
    return out.withColumns({k: F.coalesce(q(k), F.lit(v)) for k, v in (fill or {}).items() if k in out.columns})


def with_expression(expression: DataFrame, features: DataFrame) -> DataFrame:
    """Features of expressed genes: inner join on all columns that both have."""
    shared = [c for c in expression.columns if c in features.columns]
    rest = [q(c) for c in [*expression.columns, *features.columns] if c not in shared]
    return features.join(small(expression), shared).select(*map(q, shared), *rest)
