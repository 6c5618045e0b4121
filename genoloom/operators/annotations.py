"""Raw annotation rows (all strings) to typed transcript-level rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..schemas import CONSEQUENCES, IMPACTS, LOF, NMD_LABEL, VARIANT_KEY, q
from .lookups import replace_by

ID = "#Uploaded_variation"
# Types of the annotation columns; others stay strings.
LISTS = {
    "string": ("Consequence", "IMPACT", "Existing_variation", "FLAGS", "TREMBL", "REFSEQ_MATCH", "MAX_AF_POPS", "PUBMED", "LoF_flags"),
    "int": ("EXON", "INTRON"),
}
SCALARS = {
    "int": ("ALLELE_NUM", "DISTANCE", "HGVS_OFFSET", "MOTIF_POS", "BLOSUM62"),
    "tinyint": ("STRAND",),
    "float": ("sift_score", "polyphen_score", "condel_score", "MAX_AF", "MOTIF_SCORE_CHANGE", "MaxEntScan_ref", "MaxEntScan_alt", "MaxEntScan_diff", "CADD_PHRED", "CADD_RAW"),
}
FREQUENCIES = (
    "AF", "AFR_AF", "AMR_AF", "EAS_AF", "EUR_AF", "SAS_AF", "AA_AF", "EA_AF", "gnomAD_AF", "gnomAD_AFR_AF", "gnomAD_AMR_AF",
    "gnomAD_ASJ_AF", "gnomAD_EAS_AF", "gnomAD_FIN_AF", "gnomAD_NFE_AF", "gnomAD_OTH_AF", "gnomAD_SAS_AF",
)
SCORED = {"Condel": "condel", "SIFT": "sift", "PolyPhen": "polyphen"}
UNUSED = ("Location", "Allele", "GENE_PHENO")


def typed(name: str) -> Column:
    """A raw column in its type: lists split on commas, frequencies reduced to their smallest value."""
    if name in FREQUENCIES:
        return s.smallest(s.list_of(q(name), "float")).alias(name)
    for kind, names in LISTS.items():
        if name in names:
            return s.list_of(q(name), kind).alias(name)
    for kind, names in SCALARS.items():
        if name in names:
            return q(name).try_cast(kind).alias(name)
    return q(name)


def parse_annotations(raw: DataFrame, aliases: DataFrame | None = None, labels: tuple[str, ...] = CONSEQUENCES) -> DataFrame:
    """Variant key and typed columns of transcript rows, label sets as structs of booleans.

    ``aliases`` (alias, chrom) renames chromosomes. An ``NMD`` column adds its label to the consequences.
    Unparsable ids give null keys: see ``require_parsed``.
    """
    nmd = "NMD" in raw.columns
    rows = raw.withColumns(s.parse_variant_id(q(ID)))
    extra = {"pos": F.col("start") + 1, "len": F.col("end") - F.col("start")}
    if "CANONICAL" in raw.columns:
        extra["CANONICAL"] = F.coalesce(q("CANONICAL") == "YES", F.lit(False))
    for column, name in SCORED.items():
        if column in raw.columns:
            extra[f"{name}_prediction"] = s.bracket_label(q(column))
            extra[f"{name}_score"] = s.bracket_score(q(column))
    rows = rows.withColumns(extra).drop(ID, *UNUSED, *SCORED)
    if aliases is not None:
        rows = replace_by(rows, "chrom", aliases, "alias", "chrom")
    first = [*VARIANT_KEY, "pos", "len"]
    rows = rows.select(*first, *[typed(c) for c in rows.columns if c not in first])
    flags = F.struct(
        *[F.array_contains("Consequence", x).alias(x) for x in labels],
        *([(q("NMD") == NMD_LABEL).alias(NMD_LABEL)] if nmd else []),
    )
    out = rows.where(F.col("Feature_type") == "Transcript").withColumns(
        {"IMPACT": s.one_hot_list(q("IMPACT"), IMPACTS), "Consequence": flags, **({"LoF": s.one_hot(q("LoF"), LOF)} if "LoF" in rows.columns else {})}
    )
    return out.drop("Feature_type").withColumnsRenamed({"Gene": "gene", "Feature": "transcript"})


def unparsed(df: DataFrame) -> DataFrame:
    """One row (failed, total): rows with a null in the variant key, and all rows."""
    missing = F.lit(False)
    for c in VARIANT_KEY:
        missing = missing | q(c).isNull()
    return df.agg(F.count_if(missing).alias("failed"), F.count(F.lit(1)).alias("total"))


def require_parsed(df: DataFrame) -> DataFrame:
    """``df`` itself, or an error that counts the rows whose variant id didn't parse."""
    failed, total = unparsed(df).first()
    if failed:
        raise ValueError(f"{failed} of {total} variants failed to parse")
    return df
