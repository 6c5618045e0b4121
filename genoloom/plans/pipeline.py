"""From variants and their tables to one score a variant, gene and tissue, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.annotations import parse_annotations
from ..operators.featureset import join_featuresets, with_expression
from ..operators.predict import Scorer, predict
from ..operators.splice import best_scores
from ..operators.tissue_features import tissue_features
from ..schemas import GROUP_KEY, q
from .config import ModelSpec

OUTPUT_KEY = [*GROUP_KEY, "tissue_type"]


@dataclass
class Inputs:
    """Tables of one run; ``splice`` and ``tracks`` may be absent."""

    annotations: DataFrame
    isoforms: DataFrame
    expression: DataFrame
    variants: DataFrame | None = None
    transcripts: DataFrame | None = None
    chromosomes: DataFrame | None = None
    splice: DataFrame | None = None
    tissue_names: DataFrame | None = None
    tracks: DataFrame | None = None


def feature_table(inputs: Inputs, spec: ModelSpec) -> DataFrame:
    """Features of all sets that the model names, for expressed genes."""
    wanted = [f for entry in spec.variables.get("vep", []) if isinstance(entry, dict) for f in entry.get("features", [])]
    labels = sorted({f.rpartition(".")[0] for f in wanted}) or None
    vep = parse_annotations(inputs.annotations, inputs.chromosomes)
    sets = {"vep": tissue_features(vep, inputs.isoforms, gtf=inputs.transcripts, labels=labels)}
    if inputs.splice is not None and inputs.variants is not None:
        sets["splice"] = best_scores(inputs.variants, inputs.splice, inputs.tissue_names).where("gene IS NOT NULL")
    if inputs.tracks is not None:
        sets["tracks"] = inputs.tracks
    joined = join_featuresets(sets, spec.variables, list(GROUP_KEY), spec.fill)
    return with_expression(inputs.expression, joined)


def run(inputs: Inputs, spec: ModelSpec, model: Scorer, keep_features: bool = True) -> DataFrame:
    """The model's score for every row of the feature table."""
    return predict(feature_table(inputs, spec), model, spec.name, spec.features, OUTPUT_KEY, spec.required, spec.fill, keep_features)


def called(scored: DataFrame, spec: ModelSpec, cutoff: str) -> DataFrame:
    """Optional: rows beyond a named cutoff (scores at or below it; expression drops), in the model's tissues."""
    out = scored.where(q(spec.name) <= F.lit(spec.cutoffs[cutoff]))
    return out.where(F.col("tissue").isin(spec.tissues)) if spec.tissues else out
