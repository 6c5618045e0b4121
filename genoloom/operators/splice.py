"""Splice scores: two predictors joined by variant and gene, scored, keyed and reduced to the best row a gene and tissue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..schemas import SPLICE_OUTPUT, VARIANT_KEY, ddl, q
from .groups import best_per_group, cast_void
from .intervals import range_join
from .lookups import replace_by, small
from .variants import join_scores

#: Output names of predictor columns; tables that use other names pass their own mapping.
RENAMES = {
    "gene_id": "gene",
    "delta_score": "site_score",
    "delta_logit_psi": "junction_score",
    "delta_psi": "junction_psi_change",
    "score": "splice_score",
}


def junction_sites(maps: DataFrame, junction: str = "junction") -> DataFrame:
    """The two splice sites of each junction ``chrom:start-end:strand`` (0-based, half-open): chrom, strand, ``site`` and whether
    it is the donor. Junctions that don't parse have no sites."""
    pattern = r"^(.+):([0-9]+)-([0-9]+):([+-])$"
    part = lambda i: s.capture(q(junction), pattern, i)
    parsed = maps.withColumns({"chrom": part(1), "strand": part(4), "_low": part(2).cast("bigint"), "_high": part(3).cast("bigint")})
    plus = F.col("strand") == "+"
    ends = F.array(F.struct(F.col("_low").alias("site"), plus.alias("donor")), F.struct(F.col("_high").alias("site"), (~plus).alias("donor")))
    return parsed.where("_low IS NOT NULL").withColumn("_s", F.explode(ends)).select(*map(q, parsed.columns[:-2]), "_s.site", "_s.donor")


def near_sites(variants: DataFrame, sites: DataFrame, reach: int = 100) -> DataFrame:
    """Variants (chrom, start, ...) with every splice site of their contig at most ``reach`` bases away, by a range join."""
    windows = sites.withColumns({"_low": q("site") - reach, "_high": q("site") + reach})
    return range_join(variants, windows, "chrom", "start", "_low", "_high", width=2 * reach + 1).drop("_low", "_high")


def join_predictors(junctions: DataFrame, sites: DataFrame, tissues: DataFrame) -> DataFrame:
    """Full join of junction scores (by tissue) and site scores (without): on (variant, gene_name, tissue), site rows
    standing for every tissue. Gene ids known from junction rows fill site-only rows of the same gene name."""
    ids = junctions.where("gene_id IS NOT NULL AND gene_name IS NOT NULL").groupBy("gene_name").agg(F.min("gene_id").alias("_id"))
    spread = sites.crossJoin(small(tissues.select("tissue").distinct()))
    joined = junctions.join(spread, ["variant", "gene_name", "tissue"], "full").join(ids, "gene_name", "left")
    return joined.withColumn("gene_id", F.coalesce("gene_id", "_id")).drop("_id")


def score_variants(junctions: DataFrame, sites: DataFrame, tissues: DataFrame, score: Callable[[DataFrame], Column]) -> DataFrame:
    """The fixed output table of joined predictors; ``score`` gives the model's column. Junction rows count as expressed
    where their median read number is positive. No batches and no stand-in rows: empty inputs give an empty table."""
    joined = join_predictors(junctions, sites, tissues)
    keyed = joined.withColumns(s.split_position_id(q("variant")))
    expressed = F.when(q("median_n").isNotNull(), (q("median_n") > 0).cast("bigint"))
    full = keyed.withColumn("splice_site_is_expressed", expressed)
    return full.withColumn("score", score(full)).to(ddl(SPLICE_OUTPUT))


def best_scores(
    variants: DataFrame, scores: DataFrame, tissue_aliases: DataFrame | None = None, nulls_first: bool = False,
    renames: dict[str, str] = RENAMES, score: str = "splice_score",
) -> DataFrame:
    """Every variant with its highest ``score`` a gene and tissue. Columns are renamed where they exist. Tissue aliases are renamed before grouping, so two names
    of one tissue compete."""
    known = {old: new for old, new in renames.items() if old in scores.columns}
    rows = cast_void(scores.withColumnsRenamed(known), variants)
    if tissue_aliases is not None:
        rows = replace_by(rows, "tissue", tissue_aliases, "alias", "tissue")
    best = best_per_group(rows, [*VARIANT_KEY, "gene", "tissue"], score, nulls_first)
    return join_scores(variants, best, list(VARIANT_KEY))


def looked_up(variants: DataFrame, store: DataFrame, keys: list[str], model: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Stored scores of variants; those without one go to ``model`` (rows with keys in, scores out), or stay null when
    only lookups are wanted. The store is a Parquet table partitioned by chromosome, so only its chromosomes are read."""
    if model is None:
        return variants.join(store, keys, "left")
    rest = variants.join(store, keys, "left_anti")
    return variants.join(store, keys).unionByName(model(rest), allowMissingColumns=True)
