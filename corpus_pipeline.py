"""Corpus pipeline: quality rules, language ID, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Stages work on all rows their predecessor kept and fit their models and thresholds to those. Columns beside
those of documents pass through them untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoloom.llm import common, language_id, packing, pii, quality, shingles


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def carrying(stage: Stage) -> Stage:
    """The stage with all columns but those of documents carried beside it as one, so that no name clashes with its own."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rest = [c for c in docs.columns if c not in COLUMNS]
        if not rest:
            return stage(spark, docs, sf_dir)
        held = F.struct(*[docs[f"`{c}`"].alias(c) for c in rest]).alias("carried_columns")
        out = stage(spark, docs.select(*COLUMNS, held), sf_dir)
        return out.select(*[F.col(c) if c in COLUMNS else F.col("carried_columns").getField(c).alias(c) for c in docs.columns])

    return run


@carrying
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that pass the base rule and their group's adaptive thresholds."""
    return quality.judge(docs).where("kept").select(*docs.columns)


@carrying
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a language that decoding isn't in doubt about."""
    named = language_id.identify(docs)
    return named.where("lang_pred <> 'und' AND NOT ambiguous").select(*docs.columns)


@carrying
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts (SimHash proposes, five-word shingles at 0.8 or more decide), that of the
    smallest doc_id. Rows are told apart by doc_id and text, so no text goes but for one that is similar to it."""
    return shingles.unique(docs)


@carrying
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind in brackets."""
    clean = pii.with_redacted(pii.detect(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in a batch of a length bucket."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("pii", personal_data),
    ("packing", pack),
]

#: Fitted models and components aren't SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
