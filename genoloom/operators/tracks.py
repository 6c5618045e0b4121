"""Post-processing of sequence-model tracks: central bins, shifts, isoforms, tissue mapping, variant effect."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import q
from .intervals import range_join, strand_window


def central_mean(values: Column, n: int) -> Column:
    """Mean of the middle ``n`` elements of an array (all of a shorter one), null for an empty one; the left one
    of two possible middles."""
    size = F.size(values)
    k = F.least(F.lit(n), size)
    first = F.floor((size - k) / 2).cast("int") + 1
    middle = F.slice(values, first, F.greatest(k, F.lit(0)))
    total = F.aggregate(middle, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.when(size > 0, total / k)


def sequence_requests(
    kind: str, genes: DataFrame, variants: DataFrame | None = None, shift: int = 43, before: int = 50, after: int = 200,
) -> DataFrame:
    """What a sequence model has to be asked: for ``reference`` each transcript (chrom, tss, strand, ...), for ``alternative``
    each transcript with every variant in the window around its start; both once for each shift of the sequence.
    Another allele type is an error."""
    if kind not in ("reference", "alternative"):
        raise ValueError(f"unknown allele type: {kind}")
    if kind == "alternative":
        if variants is None:
            raise ValueError("alternative sequences need variants")
        genes = range_join(variants, strand_window(genes, before=before, after=after), "chrom", "start", width=before + after).drop("low", "high")
    shifts = [-shift, 0, shift] if shift else [0]
    return genes.withColumn("shift", F.explode(F.array(*map(F.lit, shifts))))


def over_shifts(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mean of each track over the shifted predictions of a sequence."""
    return df.groupBy(*map(q, keys)).agg(*[F.avg(q(v)).alias(v) for v in values])


def over_isoforms(df: DataFrame, keys: list[str], values: list[str], mode: str = "canonical", weight: str | None = None) -> DataFrame:
    """One row a gene: of its canonical transcripts (mean), the weighted mean of all, or their maximum."""
    if mode == "canonical":
        return over_shifts(df.where("canonical"), keys, values)
    if mode == "max":
        return df.groupBy(*map(q, keys)).agg(*[F.max(q(v)).alias(v) for v in values])
    if mode == "weighted" and weight:
        return df.groupBy(*map(q, keys)).agg(*[(F.sum(q(v) * q(weight)) / F.sum(q(weight))).alias(v) for v in values])
    raise ValueError(f"unknown way to aggregate isoforms: {mode}")


def to_tissues(df: DataFrame, tracks: str, matrix: np.ndarray, tissues: list[str], bias: np.ndarray | None = None) -> DataFrame:
    """Rows spread over tissues with the linear image of their track array: ``expression = tracks . matrix + bias``. The
    dot product is a column expression over a literal row of weights a tissue; the matrix is small and fixed."""
    bias = np.zeros(len(tissues)) if bias is None else bias
    rows = [F.struct(F.lit(t).alias("tissue"), F.array(*[F.lit(float(x)) for x in matrix[:, i]]).alias("w"), F.lit(float(bias[i])).alias("b")) for i, t in enumerate(tissues)]
    spread = df.withColumn("_t", F.explode(F.array(*rows)))
    product = F.zip_with(q(tracks), F.col("_t.w"), lambda x, w: x.cast("double") * w)
    value = F.aggregate(product, F.col("_t.b"), lambda a, x: a + x)
    return spread.withColumns({"tissue": F.col("_t.tissue"), "expression": value}).drop("_t")


def effect(alt: DataFrame, ref: DataFrame, keys: list[str], value: str = "expression", output: str = "score") -> DataFrame:
    """Alternative minus reference expression of the same transcript or gene and tissue."""
    base = ref.select(*map(q, keys), q(value).alias("_ref"))
    return alt.join(base, keys).withColumn(output, q(value) - F.col("_ref")).drop("_ref", value)
