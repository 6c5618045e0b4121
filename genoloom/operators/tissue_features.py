"""Isoform-weighted consequence features for each (variant, gene, tissue).

By definition every annotation row is crossed with every tissue and aggregated. Only the ``.proportion`` features
depend on the tissue, so all forms aggregate once for each (variant, gene) and spread the groups over tissues
last, without a shuffle after that. With few labels and tissues, isoform weights stand beside each transcript, a column a
tissue, and all features are sums of one aggregation. With many, the isoform-weighted labels of the rows that carry a
label are summed by tissue into a map, which meets the other features by (variant, gene). The direct form does so from lists of
each transcript's isoform rows, and where those repeat, counts also depend on the tissue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..schemas import VARIANT_KEY, q
from .lookups import small

WEIGHT = "median_transcript_proportions"
#: Labels times tissues up to which isoform-weighted sums are columns of the one aggregation.
WIDE = 256
SCORES = {"sift_score": "sift_score.pval_max_significant", "CADD_RAW": "cadd_raw.max", "polyphen_score": "polyphen_score.max", "condel_score": "condel_score.max"}


def flags_of(vep: DataFrame, labels: list[str] | None = None) -> dict[str, Column]:
    """Output prefix of each label: its boolean column, for the two label structs; ``labels`` keeps some."""
    out = {}
    for struct, prefix in (("Consequence", ""), ("LoF", "LoF_")):
        if struct in vep.columns:
            for f in vep.schema[struct].dataType.fields:
                out[prefix + f.name] = q(struct).getField(f.name)
    return out if labels is None else {k: v for k, v in out.items() if k in set(labels)}


def transcript_rows(gtf: DataFrame, dedupe: bool = False) -> DataFrame:
    """(gene, transcript, copies) from transcript annotation: ids lose their version; rows that then coincide
    count as often as they stand, once with ``dedupe``."""
    keys = gtf.select(s.without_version(q("gene_id")).alias("gene"), s.without_version(q("transcript_id")).alias("transcript"))
    copies = F.lit(1).cast("bigint") if dedupe else F.count(F.lit(1))
    return keys.groupBy("gene", "transcript").agg(copies.alias("copies"))


def group_scores(vep: DataFrame) -> list[Column]:
    out = []
    for column, name in SCORES.items():
        if column in vep.columns:
            value = s.minus_log10(q(column)) if column == "sift_score" else s.no_nan(q(column))
            out.append(F.max(value).alias(name))
    return out


def annotated(vep: DataFrame, gtf: DataFrame | None, dedupe: bool) -> DataFrame:
    """``vep`` with ``copies``: how often the transcript annotation repeats its transcript, at least once."""
    if gtf is None:
        return vep.withColumn("copies", F.lit(1).cast("bigint"))
    rows = vep.join(small(transcript_rows(gtf, dedupe)), ["gene", "transcript"], "left")
    return rows.withColumn("copies", F.coalesce("copies", F.lit(1).cast("bigint")))


def isoforms_are_unique(isoforms: DataFrame) -> bool:
    """Whether (gene, transcript, tissue) is a key, which ``tissue_features`` relies on."""
    return isoforms.groupBy("gene", "transcript", "tissue").count().where("count > 1").isEmpty()


def tissue_features(
    vep: DataFrame, isoforms: DataFrame, tissues: DataFrame | None = None, gtf: DataFrame | None = None,
    labels: list[str] | None = None, dedupe: bool = False, check: bool = True,
) -> DataFrame:
    """One row a (variant, gene, tissue) with the struct ``features``. Isoform keys that repeat multiply sums in the
    direct form; if ``check`` finds such keys, the direct form is used. A null tissue is a tissue without isoform weights:
    its rows have proportions of 0."""
    flags = flags_of(vep, labels)
    own = tissues is None
    tissues = (isoforms if own else tissues).select("tissue").distinct()
    names = None
    if check and own:  # one pass over the isoforms tells their tissues and whether their keys repeat
        found = isoforms.groupBy("gene", "transcript", "tissue").count().groupBy("tissue").agg(F.max("count")).limit(WIDE + 1).collect()
        names = [r[0] for r in found]
        unique = all(r[1] == 1 for r in found) and (len(found) <= WIDE or isoforms_are_unique(isoforms))
    else:
        unique = not check or isoforms_are_unique(isoforms)
    if not unique:
        return tissue_features_direct(vep, isoforms, tissues, gtf, labels, dedupe)
    names = [r[0] for r in tissues.limit(WIDE + 1).collect()] if names is None else names
    if names and len(names) * len(flags) <= WIDE:
        ordered = sorted(names, key=lambda n: (n is not None, n))
        return wide_form(vep, isoforms, ordered, flags, annotated(vep, gtf, dedupe))
    return map_form(vep, isoforms, tissues, flags, annotated(vep, gtf, dedupe))


def wide_form(vep: DataFrame, isoforms: DataFrame, names: list[str], flags: dict[str, Column], rows: DataFrame) -> DataFrame:
    """One join by transcript and one aggregation by (variant, gene)."""
    keys = [*VARIANT_KEY, "gene"]
    weight = q(WEIGHT).cast("double")
    weights = isoforms.groupBy("gene", "transcript").agg(*[F.max(F.when(F.col("tissue") == t, weight)).alias(f"w{i}") for i, t in enumerate(names)], F.lit(1).alias("w"))
    joined = rows.join(weights, ["gene", "transcript"], "left")
    counts = {k: F.when(F.coalesce(v, F.lit(False)), F.col("copies")).otherwise(0) for k, v in flags.items()}
    sums = {(k, i): F.sum(F.col(f"w{i}") * c).alias(f"p{i}_{k}") for k, c in counts.items() for i in range(len(names))}
    groups = joined.groupBy(*keys).agg(
        *[F.max(v).alias(f"{k}.max") for k, v in flags.items()],
        *[F.sum(c).cast("int").alias(f"{k}.sum") for k, c in counts.items()],
        *group_scores(vep),
        F.sum(F.when(q("Consequence").isNotNull(), F.col("copies")).otherwise(0)).alias("num_transcripts"),
        *sums.values(),
    )
    own = [F.struct(F.lit(t).cast("string").alias("tissue"), *[F.coalesce(q(f"p{i}_{k}"), F.lit(0.0)).cast("float").alias(k) for k in flags]) for i, t in enumerate(names)]
    kept = [q(c) for c in groups.columns if not any(c == f"p{i}_{k}" for k, i in sums)]
    spread = groups.select(*kept, F.explode(F.array(*own)).alias("own"))
    share = [q("own").getField(k).alias(f"{k}.proportion") for k in flags]
    return spread.select(*keys, F.col("own.tissue").alias("tissue"), features_struct(flags, share, groups.columns))


def map_form(vep: DataFrame, isoforms: DataFrame, tissues: DataFrame, flags: dict[str, Column], rows: DataFrame) -> DataFrame:
    """Two aggregations by (variant, gene) that meet on it."""
    keys = [*VARIANT_KEY, "gene"]
    # Nulls stand in groups of their own; with stand-ins for them, groups and sums meet by plain equality on the
    # columns that both are partitioned by already.
    stand_in = {k: F.lit("\0") if kind == "string" else F.lit(-(1 << 63)).cast(kind) for k, kind in vep.dtypes if k in keys}
    rows = rows.withColumns({k: F.coalesce(q(k), v) for k, v in stand_in.items()})
    on = {k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}
    groups = rows.groupBy(*keys).agg(
        *[F.max(v).alias(f"{k}.max") for k, v in flags.items()],
        *[F.sum(F.when(v, F.col("copies")).otherwise(0)).cast("int").alias(f"{k}.sum") for k, v in on.items()],
        *group_scores(vep),
        F.sum(F.when(q("Consequence").isNotNull(), F.col("copies")).otherwise(0)).alias("num_transcripts"),
    )
    carries = F.lit(False)
    for v in on.values():
        carries = carries | v
    counts = {k: F.when(v, F.col("copies")).otherwise(0) for k, v in on.items()}
    carrying = rows.where(carries).select(*keys, "transcript", *[v.alias(f"n_{k}") for k, v in counts.items()])
    weights = isoforms.where("tissue IS NOT NULL").select("gene", "transcript", "tissue", q(WEIGHT).cast("double").alias("w"))
    sums = carrying.join(weights, ["gene", "transcript"]).repartition(*keys).groupBy(*keys, "tissue")
    sums = sums.agg(*[F.sum(F.col("w") * q(f"n_{k}")).alias(f"p_{k}") for k in flags])
    entry = F.struct(F.col("tissue"), F.struct(*[q(f"p_{k}") for k in flags]))
    by_tissue = sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("by_tissue"))
    joined = groups.join(by_tissue, keys, "left")
    spread = joined.crossJoin(small(tissues)).withColumn("own", F.try_element_at("by_tissue", F.col("tissue")))
    share = [F.coalesce(q("own").getField(f"p_{k}"), F.lit(0.0)).cast("float").alias(f"{k}.proportion") for k in flags]
    back = [F.nullif(q(k), v).alias(k) for k, v in stand_in.items()]
    return spread.select(*back, "tissue", features_struct(flags, share, groups.columns)).select(*keys, "tissue", "features")


def features_struct(flags: dict[str, Column], share: list[Column], columns: list[str]) -> Column:
    scores = [q(n) for n in SCORES.values() if n in columns]
    fields = [*[q(f"{k}.max") for k in flags], *[q(f"{k}.sum") for k in flags], *share, *scores, q("num_transcripts")]
    return F.struct(*fields).alias("features")


def tissue_features_direct(
    vep: DataFrame, isoforms: DataFrame, tissues: DataFrame | None = None, gtf: DataFrame | None = None,
    labels: list[str] | None = None, dedupe: bool = False,
) -> DataFrame:
    """The same for any isoform keys: rows count once for each isoform row of their transcript and tissue, at least once.

    Rows are summed by (variant, gene) as if no isoform repeated, and crossed with tissues last. A transcript's isoform rows
    are one list of tissue numbers and weights; it meets the rows that carry a label and is taken apart where those stand dealt
    by (variant, gene). Isoform rows beyond a tissue's first add further copies of all rows of their transcript."""
    flags = flags_of(vep, labels)
    keys = [*VARIANT_KEY, "gene"]
    tissues = (isoforms if tissues is None else tissues).select("tissue").distinct()
    numbered = small(tissues.withColumn("i", F.row_number().over(Window.orderBy("tissue"))))
    weights = isoforms.select("gene", "transcript", "tissue", q(WEIGHT).cast("double").alias("w")).join(numbered, "tissue")
    found = weights.groupBy("gene", "transcript").agg(F.sort_array(F.collect_list(F.struct("i", "w"))).alias("found"))
    lists = found.select("gene", "transcript", F.col("found.i").alias("at"), F.col("found.w").alias("ws"))
    further = F.filter("at", lambda x, k: (k > 0) & (x == F.get(F.col("at"), k - 1)))
    repeated = lists.select("gene", "transcript", further.alias("at")).where(F.size("at") > 0)

    # One struct is the key of all that follows: nulls in it are equal, and what is dealt by it stays dealt where some of its
    # columns are constants, which Spark takes out of a list of keys.
    rows = annotated(vep, gtf, dedupe).withColumn("key", F.struct(*map(q, keys)))
    on = {k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}
    counts = {k: F.when(v, F.col("copies")).otherwise(0).alias(f"n_{k}") for k, v in on.items()}
    transcripts = F.when(q("Consequence").isNotNull(), F.col("copies")).otherwise(0)
    groups = rows.groupBy("key").agg(
        *[F.max(v).alias(f"{k}.max") for k, v in flags.items()],
        *[F.sum(v).alias(f"{k}.sum") for k, v in counts.items()],
        *group_scores(vep),
        F.sum(transcripts).alias("num_transcripts"),
    )
    carries = F.lit(False)
    for v in on.values():
        carries = carries | v
    met = rows.where(carries).select("key", "gene", "transcript", *counts.values()).join(lists, ["gene", "transcript"])
    met = met.select("key", *[q(f"n_{k}") for k in flags], F.lit(None).cast("bigint").alias("more"), "at", "ws")
    if not repeated.isEmpty():
        again = rows.select("key", "gene", "transcript", *counts.values(), transcripts.alias("more")).join(small(repeated), ["gene", "transcript"])
        met = met.union(again.select("key", *[q(f"n_{k}") for k in flags], "more", "at", F.lit(None).cast("array<double>").alias("ws")))
    dealt = met.repartition("key").select("key", *[q(f"n_{k}") for k in flags], "more", "ws", F.posexplode("at").alias("place", "i"))
    sums = dealt.groupBy("key", "i").agg(
        *[F.sum(F.when(q(f"n_{k}") > 0, F.get("ws", "place") * q(f"n_{k}"))).alias(f"p_{k}") for k in flags],
        *[F.sum(F.when(F.col("more").isNotNull(), q(f"n_{k}"))).alias(f"x_{k}") for k in flags],
        F.sum("more").alias("x"),
    )
    own = [f"{x}_{k}" for x in "px" for k in flags] + ["x"]
    by_tissue = sums.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct(*map(q, own))))).alias("by_tissue"))
    spread = groups.join(by_tissue, "key", "left").crossJoin(numbered).withColumn("own", F.try_element_at("by_tissue", F.col("i")))
    part = lambda name: F.coalesce(q("own").getField(name), F.lit(0))
    whole = spread.withColumns({f"{k}.sum": (q(f"{k}.sum") + part(f"x_{k}")).cast("int") for k in flags} | {"num_transcripts": F.col("num_transcripts") + part("x")})
    share = [part(f"p_{k}").cast("float").alias(f"{k}.proportion") for k in flags]
    return whole.select(*[F.col("key").getField(k).alias(k) for k in keys], "tissue", features_struct(flags, share, groups.columns))


def region_stats(df: DataFrame) -> DataFrame:
    """(chrom, min_start, max_start, num_rows, region_size) of each chromosome."""
    found = df.groupBy("chrom").agg(F.min("start").alias("min_start"), F.max("start").alias("max_start"), F.count(F.lit(1)).alias("num_rows"))
    return found.withColumn("region_size", F.col("max_start") - F.col("min_start"))
