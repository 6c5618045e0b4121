"""Feature vectors, required features and batch scoring by pluggable models."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import is_usable
from ..schemas import q

DEFAULTS = {"boolean": False, "float": 0.0, "double": 0.0, "tinyint": 0, "smallint": 0, "int": 0, "bigint": 0}


class Scorer(Protocol):
    """A model: scores of a matrix with a row for each record, a column for each feature."""

    def predict(self, matrix: np.ndarray) -> np.ndarray: ...


def feature_columns(df: DataFrame, features: list[str], fill: dict[str, object] | None = None) -> dict[str, Column]:
    """Model inputs in order as floats: nulls and NaN take the fill value, else false, 0."""
    types, out = dict(df.dtypes), {}
    for name in features:
        kind = types.get(name)
        if kind not in DEFAULTS:
            raise ValueError(f"feature {name} has type {kind}; models take booleans and numbers")
        value = F.lit((fill or {}).get(name, DEFAULTS[kind]))
        column = F.coalesce(q(name), value.cast(kind))
        if kind in ("float", "double"):
            column = F.when(F.isnan(column), value.cast(kind)).otherwise(column)
        out[name] = column.cast("float")
    return out


def usable(df: DataFrame, required: list[str] | None) -> Column:
    """Whether all required features are present: not null, not NaN. True without any."""
    types, out = dict(df.dtypes), F.lit(True)
    for name in required or []:
        out = out & is_usable(q(name), types[name])
    return out


def arranged(df: DataFrame, score: Column, name: str, keys: list[str], keep_features: bool) -> DataFrame:
    present = [k for k in keys if k in df.columns]
    rest = [q(c) for c in df.columns if c not in present and c != name] if keep_features else []
    return df.select(*map(q, present), score.cast("double").alias(name), *rest)


def predict(
    df: DataFrame, model: Scorer, name: str, features: list[str], keys: list[str], required: list[str] | None = None,
    fill: dict[str, object] | None = None, keep_features: bool = True,
) -> DataFrame:
    """Keys, the score ``name`` and the other columns. Rows without a required feature have a null score; one pass,
    in Arrow batches, the model once in each worker."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        own = cloudpickle.loads(shared.value)
        for batch in batches:
            matrix = batch.to_numpy(np.float32)
            yield pd.Series(own.predict(matrix) if len(matrix) else [], dtype="float64")

    # field names may hold dots; the vector's order is what counts
    inputs = [c.alias(f"f{i}") for i, c in enumerate(feature_columns(df, features, fill).values())]
    return arranged(df, F.when(usable(df, required), score(F.struct(*inputs))), name, keys, keep_features)


def predict_native(
    df: DataFrame, expression, name: str, features: list[str], keys: list[str], required: list[str] | None = None,
    fill: dict[str, object] | None = None, keep_features: bool = True,
) -> DataFrame:
    """The same with a model that is a column expression of its feature columns (linear, logistic)."""
    value = expression(feature_columns(df, features, fill))
    return arranged(df, F.when(usable(df, required), value), name, keys, keep_features)


def linear(weights: dict[str, float], bias: float = 0.0):
    """Weighted sum of features as an expression for ``predict_native``."""

    def of(columns: dict[str, Column]) -> Column:
        out = F.lit(float(bias))
        for name, w in weights.items():
            out = out + columns[name].cast("double") * F.lit(float(w))
        return out

    return of


def logistic(weights: dict[tuple[str, ...], float], bias: float = 0.0):
    """Logistic model over features and products of two features: keys hold one or two names."""

    def of(columns: dict[str, Column]) -> Column:
        z = F.lit(float(bias))
        for names, w in weights.items():
            term = F.lit(float(w))
            for n in names:
                term = term * columns[n].cast("double")
            z = z + term
        return 1 / (1 + F.exp(-z))

    return of


class TreeEnsemble:
    """Evaluator of a gradient-boosted tree model in the public LightGBM text format.

    Numerical splits only. A value that is missing (NaN, or zero where the model says so) takes the split's
    default side. The score is the sum of leaf values, through the logistic function for a binary objective."""

    def __init__(self, text: str):
        head, *blocks = text.split("\nTree=")
        fields = dict(x.split("=", 1) for x in head.splitlines() if "=" in x)
        self.features = fields.get("feature_names", "").split()
        self.binary = fields.get("objective", "").startswith("binary")
        self.trees = [self.tree(b.split("\n\n")[0]) for b in blocks]

    @staticmethod
    def tree(block: str) -> dict[str, np.ndarray]:
        fields = dict(x.split("=", 1) for x in block.splitlines()[1:] if "=" in x)
        if int(fields.get("num_cat", "0")):
            raise ValueError("categorical splits aren't supported")
        kinds = {"split_feature": int, "threshold": float, "decision_type": int, "left_child": int, "right_child": int, "leaf_value": float}
        return {k: np.array(fields.get(k, "").split(), dtype=kind) for k, kind in kinds.items()}

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        total = np.zeros(len(matrix))
        for t in self.trees:
            node = np.zeros(len(matrix), np.int64) if len(t["split_feature"]) else np.full(len(matrix), -1)
            while (live := np.flatnonzero(node >= 0)).size:
                at = node[live]
                value = matrix[live, t["split_feature"][at]].astype(np.float64)
                kind = t["decision_type"][at]
                missing, default_left = (kind >> 2) & 3, (kind & 2) > 0
                absent = (missing == 2) & np.isnan(value) | (missing == 1) & (np.isnan(value) | (np.abs(value) <= 1e-35))
                value = np.where(np.isnan(value) & ~absent, 0.0, value)
                left = np.where(absent, default_left, value <= t["threshold"][at])
                node[live] = np.where(left, t["left_child"][at], t["right_child"][at])
            total += t["leaf_value"][-node - 1]
        return 1 / (1 + np.exp(-total)) if self.binary else total
