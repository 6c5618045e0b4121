"""Registered queries for the engine's own operators and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import annotations, featureset, groups, intervals, lookups, predict, splice, tissue_features, tracks, variants
from ..schemas import JUNCTION_SCORES, SPLICE_OUTPUT, SPLICE_SCORES, VARIANT_KEY, ddl, q
from ..sources import genome, sinks, text_tables
from . import bridge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = bridge.sql(sql)
        return f

    return add


def keyed(df: DataFrame) -> DataFrame:
    """Bridge columns under the engine's key names."""
    return df.withColumnsRenamed({"start_": "start", "end_": "end"})


def plain(df: DataFrame) -> DataFrame:
    """Key names that SQL doesn't reserve."""
    return df.withColumnsRenamed({"start": "start_", "end": "end_"})


def scratch(spark: SparkSession) -> str:
    """A fresh path in the folder that the session shares, for queries that read files. Only local mode may go without."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "/tmp/checkpoints"
    return f"{base.rstrip('/')}/text-{uuid.uuid4().hex}"


# --- identifiers and cells ----------------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, nullif(regexp_extract(id, '(.+):([0-9]+):([0-9]+):(.+?)>(.+)', 1), '') AS chrom,
  CAST(nullif(regexp_extract(id, '(.+):([0-9]+):([0-9]+):(.+?)>(.+)', 2), '') AS BIGINT) AS start_,
  CAST(nullif(regexp_extract(id, '(.+):([0-9]+):([0-9]+):(.+?)>(.+)', 3), '') AS BIGINT) AS end_,
  CASE WHEN regexp_extract(id, '(.+):([0-9]+):([0-9]+):(.+?)>(.+)', 4) = '-' THEN '' ELSE nullif(regexp_extract(id, '(.+):([0-9]+):([0-9]+):(.+?)>(.+)', 4), '') END AS ref,
  CASE WHEN regexp_extract(id, '(.+):([0-9]+):([0-9]+):(.+?)>(.+)', 5) = '-' THEN '' ELSE nullif(regexp_extract(id, '(.+):([0-9]+):([0-9]+):(.+?)>(.+)', 5), '') END AS alt
FROM ids""")
def variant_id_parse(spark: SparkSession, d: str) -> DataFrame:
    return plain(bridge.frame(spark, d, "ids").withColumns(s.parse_variant_id(F.col("id"))).drop("id"))


@query("""
SELECT count(*) FILTER (WHERE NOT regexp_matches(id, '(.+):([0-9]+):([0-9]+):(.+?)>(.+)')) AS failed, count(*) AS total FROM ids""")
def parse_quality_counts(spark: SparkSession, d: str) -> DataFrame:
    parsed = bridge.frame(spark, d, "ids").withColumns(s.parse_variant_id(F.col("id")))
    return annotations.unparsed(parsed)


@query("""
SELECT l_orderkey, l_linenumber, regexp_replace(cell, '\\(.*', '') AS prediction,
  CAST(nullif(regexp_extract(cell, '.*\\((.*)\\)', 1), '') AS DOUBLE) AS score FROM labelled""")
def score_prediction_split(spark: SparkSession, d: str) -> DataFrame:
    cell = F.col("cell")
    return bridge.frame(spark, d, "labelled").select(
        "l_orderkey", "l_linenumber", s.bracket_label(cell).alias("prediction"), s.bracket_score(cell).cast("double").alias("score")
    )


@query("""
SELECT o_orderkey, concat('chr1:', CAST(o_custkey AS VARCHAR), ':', ref, '>', alt) AS id, 'chr1' AS chrom, CAST(pos AS BIGINT) - 1 AS start_,
  CAST(pos AS BIGINT) - 1 + length(ref) AS end_, ref, alt, CAST(pos AS BIGINT) AS pos
FROM (SELECT o_orderkey, pos AS o_custkey, pos, ref, alt FROM alleles)""")
def splice_key_split(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "alleles")
    ident = rows.select("o_orderkey", F.concat(F.lit("chr1:"), q("pos").cast("string"), F.lit(":"), "ref", F.lit(">"), "alt").alias("id"))
    return plain(ident.withColumns(s.split_position_id(F.col("id"))).withColumn("end", q("end").cast("bigint")))


@query("SELECT l_orderkey, l_linenumber, l_returnflag = 'A' AS A, l_returnflag = 'N' AS N, l_returnflag = 'X' AS X FROM lineitem")
def one_hot_scalar(spark: SparkSession, d: str) -> DataFrame:
    flags = s.one_hot(F.col("l_returnflag"), ["A", "N", "X"])
    return spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", flags.alias("f")).select("l_orderkey", "l_linenumber", "f.*")


@query("""
SELECT p_partkey, list_contains(string_split(p_type, ' '), 'STEEL') AS STEEL, list_contains(string_split(p_type, ' '), 'SMALL') AS SMALL FROM part""")
def one_hot_list(spark: SparkSession, d: str) -> DataFrame:
    flags = s.one_hot_list(F.split("p_type", " "), ["STEEL", "SMALL"])
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", flags.alias("f")).select("p_partkey", "f.*")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE round(CAST(least(l_discount, l_tax) AS DOUBLE), 6) END AS lowest FROM lineitem""")
def allele_freq_min(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    last = F.when(F.col("l_returnflag") == "R", "?").otherwise(F.col("l_tax").cast("string"))
    cell = F.concat_ws(",", F.col("l_discount").cast("string"), last)
    return rows.select("l_orderkey", "l_linenumber", F.round(s.smallest(s.list_of(cell, "double")), 6).alias("lowest"))


@query("""
SELECT concat('G', CAST(p_size % 7 AS VARCHAR)) AS gene, concat('T', CAST(p_partkey % 50 AS VARCHAR)) AS transcript, count(*) AS copies
FROM part GROUP BY 1, 2""")
def gtf_transcript_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/part.parquet").select(
        F.format_string("G%d.%d", F.col("p_size") % 7, "p_partkey").alias("gene_id"),
        F.format_string("T%d.%d.x", F.col("p_partkey") % 50, "p_size").alias("transcript_id"),
    )
    return tissue_features.transcript_rows(rows)


ANNOTATION = """
SELECT CASE WHEN l_linenumber = 2 THEN concat('1:', CAST(l_orderkey AS VARCHAR(20)), ':', CAST(l_orderkey + 1 AS VARCHAR(20)), ':A>-')
    ELSE concat('chr2:', CAST(l_orderkey AS VARCHAR(20)), ':', CAST(l_orderkey + 1 AS VARCHAR(20)), ':A>C') END AS id,
  concat('G', CAST(l_partkey AS VARCHAR(20))) AS gene, concat('T', CAST(l_suppkey AS VARCHAR(20))) AS feature,
  CASE WHEN l_quantity < 40 THEN 'Transcript' ELSE 'RegulatoryFeature' END AS kind,
  CASE l_returnflag WHEN 'R' THEN 'stop_gained,missense_variant' WHEN 'A' THEN 'intron_variant' END AS consequence,
  CASE WHEN l_linestatus = 'F' THEN 'HIGH' ELSE 'LOW' END AS impact, CASE WHEN l_linenumber = 1 THEN 'YES' END AS canonical,
  CASE WHEN l_linenumber < 4 THEN 'tolerated(0.5)' WHEN l_linenumber = 4 THEN 'tolerated' END AS sift,
  CASE WHEN l_linenumber = 3 THEN 'HC' WHEN l_linenumber = 4 THEN 'LC' END AS lof,
  CASE WHEN l_linenumber = 5 THEN 'NMD_escaping_variant' END AS nmd, CASE WHEN l_linenumber <> 6 THEN '1.25' END AS cadd, '3/10' AS exon
FROM lineitem"""


@query(
    f"""
SELECT CASE WHEN id LIKE '1:%' THEN 'chr1' ELSE 'chr2' END AS chrom, CAST(string_split(id, ':')[2] AS BIGINT) AS start_,
  CAST(string_split(id, ':')[3] AS BIGINT) AS end_, 'A' AS ref, CASE WHEN id LIKE '%-' THEN '' ELSE 'C' END AS alt, gene, feature AS transcript,
  consequence IN ('stop_gained,missense_variant') AS stop_gained, consequence = 'intron_variant' AS intron_variant,
  coalesce(nmd = 'NMD_escaping_variant', NULL) AS nmd, impact = 'HIGH' AS high, lof = 'HC' AS hc, coalesce(canonical = 'YES', FALSE) AS canonical,
  regexp_replace(sift, '\\(.*', '') AS sift_prediction, CAST(nullif(regexp_extract(sift, '.*\\((.*)\\)', 1), '') AS DOUBLE) AS sift_score,
  CAST(cadd AS DOUBLE) AS cadd
FROM ({ANNOTATION}) WHERE kind = 'Transcript'"""
)
def annotation_parse(spark: SparkSession, d: str) -> DataFrame:
    names = {
        "id": annotations.ID, "gene": "Gene", "feature": "Feature", "kind": "Feature_type", "consequence": "Consequence", "impact": "IMPACT",
        "canonical": "CANONICAL", "sift": "SIFT", "lof": "LoF", "nmd": "NMD", "cadd": "CADD_RAW", "exon": "EXON",
    }
    raw = bridge.frame(spark, d, ANNOTATION).withColumnsRenamed(names)
    aliases = spark.createDataFrame([("1", "chr1"), ("2", "chr2")], "alias string, chrom string")
    out = annotations.parse_annotations(raw, aliases, ("stop_gained", "intron_variant"))
    return plain(out).select(
        "chrom", "start_", "end_", "ref", "alt", "gene", "transcript", "Consequence.stop_gained", "Consequence.intron_variant",
        F.col("Consequence.NMD_escaping_variant").alias("nmd"), F.col("IMPACT.HIGH").alias("high"), F.col("LoF.HC").alias("hc"),
        F.col("CANONICAL").alias("canonical"), "sift_prediction", F.col("sift_score").cast("double").alias("sift_score"),
        F.col("CADD_RAW").cast("double").alias("cadd"),
    )


# --- lookups, filters, statistics ---------------------------------------------------------------


@query("""
SELECT c_custkey, coalesce(name, n_name) AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN aliases ON n_name = alias""")
def alias_lookup_default(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT c_custkey, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey")
    return lookups.replace_by(rows, "nation", bridge.frame(spark, d, "aliases"), "alias", "name")


@query("SELECT o_orderkey, ref, alt FROM alleles WHERE regexp_matches(ref, '^[ACGTacgt]+$') AND regexp_matches(alt, '^[ACGTacgt]+$')")
def valid_allele_filter(spark: SparkSession, d: str) -> DataFrame:
    return variants.valid_alleles(bridge.frame(spark, d, "alleles")).select("o_orderkey", "ref", "alt")


@query("""
SELECT o_orderkey, pos, ref, unnest(string_split(alt, ',')) AS alt, CAST(unnest(range(1, len(string_split(alt, ',')) + 1)) AS INTEGER) AS allele FROM alleles""")
def multiallelic_split(spark: SparkSession, d: str) -> DataFrame:
    return variants.split_alleles(bridge.frame(spark, d, "alleles"))


@query("""
SELECT o_orderkey, pos, pos - 1 AS start_, CASE WHEN o_orderkey % 3 = 0 THEN pos + 100 ELSE pos - 1 + length(ref) END AS end_ FROM alleles""")
def info_end_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "alleles").withColumn("info_END", F.when(F.col("o_orderkey") % 3 == 0, F.col("pos") + 100))
    return plain(variants.with_keys(rows, "info_END")).select("o_orderkey", "pos", "start_", "end_")


@query("""
SELECT c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_nationkey < 12 AND c_custkey <= 1000 + n_nationkey""")
def contig_targets(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT c_custkey, c_acctbal, n_name AS chrom, c_custkey AS pos FROM customer JOIN nation ON c_nationkey = n_nationkey")
    contigs = bridge.frame(spark, d, "SELECT n_name AS contig, CAST(0 AS BIGINT) AS start, CAST(1000 + n_nationkey AS BIGINT) AS `end` FROM nation WHERE n_nationkey < 12")
    return variants.on_contigs(rows, contigs).select("c_custkey", "c_acctbal")


@query("""
SELECT chrom, min(start_) AS min_start, max(start_) AS max_start, count(*) AS num_rows, max(start_) - min(start_) AS region_size FROM scores GROUP BY chrom""")
def region_stats(spark: SparkSession, d: str) -> DataFrame:
    return tissue_features.region_stats(keyed(bridge.frame(spark, d, "scores")))


@query("SELECT DISTINCT k FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)")
def distinct_union(spark: SparkSession, d: str) -> DataFrame:
    frames = [bridge.frame(spark, d, x) for x in ("SELECT c_nationkey AS k FROM customer", "SELECT s_nationkey AS k FROM supplier")]
    return groups.distinct_union(frames, "k")


@query("SELECT chrom, start_, end_, gene, tissue, score FROM scores WHERE chrom = 'chr1' AND start_ >= 1000 AND end_ <= 5000")
def region_filter(spark: SparkSession, d: str) -> DataFrame:
    return plain(variants.in_region(keyed(bridge.frame(spark, d, "scores")), "chr1", 1000, 5000)).select("chrom", "start_", "end_", "gene", "tissue", "score")


@query("SELECT DISTINCT concat('chr', CAST(l_suppkey % 5 AS VARCHAR)) AS contig FROM lineitem")
def contig_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    bridge.frame(spark, d, "SELECT concat('##contig=<ID=chr', CAST(l_suppkey % 5 AS STRING), ',length=10>') AS value FROM lineitem").write.text(path)
    return genome.vcf_contigs(spark, path)


@query("SELECT o_orderkey, r_name AS tissue FROM orders CROSS JOIN region")
def tissue_cross_expand(spark: SparkSession, d: str) -> DataFrame:
    tissues = bridge.frame(spark, d, "SELECT r_name AS tissue FROM region")
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey").crossJoin(lookups.small(tissues))


# --- tissue features ----------------------------------------------------------------------------

TISSUE_SQL = """
SELECT chrom, start_, end_, ref, alt, v.gene, n_name AS tissue, bool_or(stop_gained) AS stop_gained_max,
  CAST(coalesce(sum(CASE WHEN stop_gained THEN 1 END), 0) AS INTEGER) AS stop_gained_sum,
  round(coalesce(sum(CASE WHEN stop_gained THEN prop END), 0), 4) AS stop_gained_proportion, bool_or(lof_hc) AS hc_max,
  CAST(coalesce(sum(CASE WHEN lof_hc THEN 1 END), 0) AS INTEGER) AS hc_sum, round(coalesce(sum(CASE WHEN lof_hc THEN prop END), 0), 4) AS hc_proportion,
  round(max(-log10(sift)), 6) AS sift, round(max(cadd_raw), 6) AS cadd, count(*) AS num_transcripts
FROM vep v CROSS JOIN nation LEFT JOIN iso i ON v.gene = i.gene AND v.transcript = i.transcript AND n_name = i.tissue
GROUP BY ALL"""


def tissue_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    vep = keyed(bridge.frame(spark, d, "vep")).select(
        *VARIANT_KEY, "gene", "transcript", F.struct("stop_gained").alias("Consequence"), F.struct(F.col("lof_hc").alias("HC")).alias("LoF"),
        F.col("sift").alias("sift_score"), F.col("cadd_raw").alias("CADD_RAW"),
    )
    isoforms = bridge.frame(spark, d, "iso").withColumnRenamed("prop", tissue_features.WEIGHT)
    tissues = bridge.frame(spark, d, "SELECT n_name AS tissue FROM nation")
    return {"vep": vep, "isoforms": isoforms, "tissues": tissues}


def tissue_output(df: DataFrame) -> DataFrame:
    f = lambda name: F.col("features").getField(name)
    number = lambda name: F.round(f(name).cast("double"), 4)
    return plain(df).select(
        "chrom", "start_", "end_", "ref", "alt", "gene", "tissue", f("stop_gained.max").alias("stop_gained_max"), f("stop_gained.sum").alias("stop_gained_sum"),
        number("stop_gained.proportion").alias("stop_gained_proportion"), f("LoF_HC.max").alias("hc_max"), f("LoF_HC.sum").alias("hc_sum"),
        number("LoF_HC.proportion").alias("hc_proportion"), F.round(f("sift_score.pval_max_significant"), 6).alias("sift"),
        F.round(f("cadd_raw.max"), 6).alias("cadd"), f("num_transcripts").alias("num_transcripts"),
    )


@query(TISSUE_SQL)
def tissue_vep_features(spark: SparkSession, d: str) -> DataFrame:
    return tissue_output(tissue_features.tissue_features_direct(**tissue_inputs(spark, d)))


@query(TISSUE_SQL)
def tissue_vep_features_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return tissue_output(tissue_features.tissue_features(**tissue_inputs(spark, d)))


# --- best rows and joins ------------------------------------------------------------------------

BEST = """
SELECT chrom, start_, end_, ref, alt, gene, tissue, score, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY chrom, start_, end_, ref, alt, gene, tissue
  ORDER BY score DESC NULLS LAST, l_linenumber) AS k FROM scores WHERE gene IS NOT NULL) WHERE k = 1"""


@query(BEST)
def best_score_per_group(spark: SparkSession, d: str) -> DataFrame:
    keys = [*VARIANT_KEY, "gene", "tissue"]
    rows = keyed(bridge.frame(spark, d, "scores"))
    return plain(groups.best_per_group(rows, keys, "score", ties=["l_linenumber"]))


@query(BEST)
def best_score_by_window(spark: SparkSession, d: str) -> DataFrame:
    rows = keyed(bridge.frame(spark, d, "scores"))
    return plain(groups.best_by_window(rows, [*VARIANT_KEY, "gene", "tissue"], "score", ["l_linenumber"]))


@query(f"""
WITH b AS ({BEST}), v AS (SELECT DISTINCT concat('chr', CAST(o_custkey % 5 AS VARCHAR)) AS chrom, o_orderkey AS start_, o_orderkey + 1 AS end_, 'A' AS ref, 'C' AS alt FROM orders)
SELECT v.*, b.gene, b.tissue, b.score AS best FROM v LEFT JOIN b USING (chrom, start_, end_, ref, alt)""")
def variants_left_join_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT concat('chr', CAST(o_custkey % 5 AS STRING)) AS chrom, o_orderkey AS start, o_orderkey + 1 AS `end`, 'A' AS ref, 'C' AS alt FROM orders").distinct()
    scores = keyed(bridge.frame(spark, d, "scores"))
    return plain(splice.best_scores(rows, scores)).withColumnRenamed("splice_score", "best").drop("l_linenumber")


@query("""
WITH named AS (SELECT *, CASE tissue WHEN 'A' THEN 'N' ELSE tissue END AS t FROM scores WHERE gene IS NOT NULL)
SELECT chrom, start_, end_, gene, t AS tissue, max(score) AS best FROM named GROUP BY ALL""")
def tissue_alias_best(spark: SparkSession, d: str) -> DataFrame:
    rows = keyed(bridge.frame(spark, d, "scores"))
    names = spark.createDataFrame([("A", "N"), ("N", "N")], "alias string, tissue string")
    renamed = lookups.replace_by(rows, "tissue", names, "alias", "tissue")
    best = groups.best_per_group(renamed, [*VARIANT_KEY, "gene", "tissue"], "score")
    return plain(best).select("chrom", "start_", "end_", "gene", "tissue", F.col("score").alias("best"))


@query("""
WITH m AS (SELECT concat('chr1:', CAST(l_orderkey AS VARCHAR), ':AC>G') AS variant, concat('N', CAST(l_partkey AS VARCHAR)) AS gene_name,
    concat('E', CAST(l_partkey AS VARCHAR)) AS gene_id, l_returnflag AS tissue, l_discount AS delta_logit_psi, l_quantity - 10 AS median_n
    FROM lineitem),
  a AS (SELECT concat('chr1:', CAST(o_orderkey AS VARCHAR), ':AC>G') AS variant, concat('N', CAST(o_custkey AS VARCHAR)) AS gene_name, CAST(o_totalprice AS FLOAT) AS delta_score FROM orders),
  t AS (SELECT DISTINCT l_returnflag AS tissue FROM lineitem),
  g AS (SELECT gene_name, min(gene_id) AS own FROM m GROUP BY 1),
  j AS (SELECT * FROM m FULL JOIN (SELECT * FROM a CROSS JOIN t) USING (variant, gene_name, tissue))
SELECT 'chr1' AS chrom, CAST(string_split(variant, ':')[2] AS BIGINT) - 1 AS start_, CAST(string_split(variant, ':')[2] AS BIGINT) + 1 AS end_, 'AC' AS ref, 'G' AS alt,
  coalesce(gene_id, own) AS gene_id, tissue, delta_logit_psi, CAST(delta_score AS DOUBLE) AS delta_score, CAST(median_n > 0 AS BIGINT) AS expressed,
  round(coalesce(delta_logit_psi, 0) + 2 * coalesce(CAST(delta_score AS DOUBLE), 0), 1) AS score
FROM j LEFT JOIN g USING (gene_name)""")
def splice_predictor_join(spark: SparkSession, d: str) -> DataFrame:
    junctions = bridge.frame(spark, d, """
        SELECT concat('chr1:', CAST(l_orderkey AS STRING), ':AC>G') AS variant, l_returnflag AS tissue, '' AS junction, '' AS event_type, '' AS splice_site,
          concat('E', CAST(l_partkey AS STRING)) AS gene_id, concat('N', CAST(l_partkey AS STRING)) AS gene_name, l_discount AS delta_logit_psi,
          CAST(0 AS DOUBLE) AS ref_psi, l_quantity - 10 AS median_n, CAST(0 AS DOUBLE) AS delta_psi FROM lineitem""")
    sites = bridge.frame(spark, d, """
        SELECT concat('chr1:', CAST(o_orderkey AS STRING), ':AC>G') AS variant, concat('N', CAST(o_custkey AS STRING)) AS gene_name,
          CAST(o_totalprice AS FLOAT) AS delta_score FROM orders""")
    for name, kind in (("acceptor_gain", "float"), ("acceptor_loss", "float"), ("donor_gain", "float"), ("donor_loss", "float")):
        sites = sites.withColumns({name: F.lit(None).cast(kind), f"{name}_position": F.lit(None).cast("int")})
    tissues = bridge.frame(spark, d, "SELECT DISTINCT l_returnflag AS tissue FROM lineitem")
    zero = lambda c: F.coalesce(q(c).cast("double"), F.lit(0.0))
    out = splice.score_variants(junctions, sites, tissues, lambda df: zero("delta_logit_psi") + 2 * zero("delta_score"))
    exact = F.round(zero("delta_logit_psi") + 2 * zero("delta_score"), 1)
    return plain(out).select("chrom", "start_", "end_", "ref", "alt", "gene_id", "tissue", "delta_logit_psi", "delta_score", F.col("splice_site_is_expressed").alias("expressed"), exact.alias("score"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS score, o_orderkey % 3 <> 0 AS computed FROM orders""")
def lookup_or_model(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey")
    store = bridge.frame(spark, d, "SELECT o_orderkey, o_totalprice AS score FROM orders WHERE o_orderkey % 3 = 0")
    model = lambda rest: rest.withColumns({"score": F.col("o_custkey").cast("double"), "computed": F.lit(True)})
    out = splice.looked_up(rows, store, ["o_orderkey"], model)
    return out.select("o_orderkey", "score", F.coalesce("computed", F.lit(False)).alias("computed"))


# --- feature sets -------------------------------------------------------------------------------

SETS_SQL = """
WITH a AS (SELECT l_partkey AS gene, l_returnflag AS tissue, max(l_discount) AS m, min(l_tax) AS n FROM lineitem WHERE l_quantity < 20 GROUP BY 1, 2),
  b AS (SELECT l_partkey AS gene, l_returnflag AS tissue, max(l_extendedprice) AS x FROM lineitem WHERE l_quantity > 10 GROUP BY 1, 2),
  c AS (SELECT p_partkey AS gene, p_retailprice AS y FROM part WHERE p_size < 25),
  t AS (SELECT DISTINCT tissue FROM (SELECT tissue FROM a UNION ALL SELECT tissue FROM b))
"""


@query(SETS_SQL + """
SELECT coalesce(ab.gene, c2.gene) AS gene, coalesce(ab.tissue, c2.tissue) AS tissue, m AS a_m, n AS a_n, coalesce(x, -1.0) AS b_x, y AS c_y
FROM (SELECT * FROM a FULL JOIN b USING (gene, tissue)) ab FULL JOIN (SELECT * FROM c CROSS JOIN t) c2 ON ab.gene = c2.gene AND ab.tissue = c2.tissue""")
def featureset_outer_join(spark: SparkSession, d: str) -> DataFrame:
    one = bridge.frame(spark, d, "SELECT l_partkey AS gene, l_returnflag AS tissue, max(l_discount) AS m, min(l_tax) AS n FROM lineitem WHERE l_quantity < 20 GROUP BY 1, 2")
    sets = {
        "a": one.select("gene", "tissue", F.struct("m", "n").alias("features")),
        "b": bridge.frame(spark, d, "SELECT l_partkey AS gene, l_returnflag AS tissue, max(l_extendedprice) AS x FROM lineitem WHERE l_quantity > 10 GROUP BY 1, 2"),
        "c": bridge.frame(spark, d, "SELECT p_partkey AS gene, p_retailprice AS y FROM part WHERE p_size < 25"),
    }
    chosen = {"a": [{"features": ["m", "n"]}], "b": ["x"], "c": ["y"]}
    out = featureset.join_featuresets(sets, chosen, ["gene", "tissue"], {"feature.b@x": -1.0})
    names = {"feature.a@features.m": "a_m", "feature.a@features.n": "a_n", "feature.b@x": "b_x", "feature.c@y": "c_y"}
    return out.withColumnsRenamed(names)


@query("""
SELECT p_partkey AS gene, l_orderkey, l_linenumber, p_size AS size FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 20""")
def expressed_inner_natural(spark: SparkSession, d: str) -> DataFrame:
    expression = bridge.frame(spark, d, "SELECT p_partkey AS gene, p_size AS size FROM part WHERE p_size < 20")
    rows = bridge.frame(spark, d, "SELECT l_partkey AS gene, l_orderkey, l_linenumber FROM lineitem")
    return featureset.with_expression(expression, rows)


# --- models -------------------------------------------------------------------------------------

MODEL_ROWS = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 5 THEN NULL ELSE l_discount END AS a, CASE WHEN l_quantity > 45 THEN NULL ELSE l_tax END AS b,
  l_returnflag = 'R' AS c, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber END AS n FROM lineitem"""
LINEAR_SQL = f"""
SELECT l_orderkey, l_linenumber, CASE WHEN a IS NULL THEN NULL ELSE round(0.5 + 2 * a - coalesce(b, 0.25) + CASE WHEN c THEN 1 ELSE 0 END + 0.125 * coalesce(n, 0), 4) END AS score, b
FROM ({MODEL_ROWS})"""
WEIGHTS = {"a": 2.0, "b": -1.0, "c": 1.0, "n": 0.125}
MODEL_KEYS = ["l_orderkey", "l_linenumber"]


class Weighted:
    """A linear model with the interface of fitted ones."""

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        return 0.5 + matrix.astype(np.float64) @ np.array(list(WEIGHTS.values()))


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*MODEL_KEYS, F.round("score", 4).alias("score"), "b")


@query(LINEAR_SQL)
def required_split_predict_linear(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, MODEL_ROWS)
    return rounded(predict.predict_native(rows, predict.linear(WEIGHTS, 0.5), "score", list(WEIGHTS), MODEL_KEYS, ["a"], {"b": 0.25}))


@query(LINEAR_SQL)
def required_split_predict_batches(spark: SparkSession, d: str) -> DataFrame:
    return rounded(predict.predict(bridge.frame(spark, d, MODEL_ROWS), Weighted(), "score", list(WEIGHTS), MODEL_KEYS, ["a"], {"b": 0.25}))


@query(f"""
SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(0.1 + 3 * coalesce(a, 0) - 2 * coalesce(b, 0) + 5 * coalesce(a, 0) * coalesce(b, 0)))), 5) AS score
FROM ({MODEL_ROWS})""")
def logistic_interactions(spark: SparkSession, d: str) -> DataFrame:
    model = predict.logistic({("a",): 3.0, ("b",): -2.0, ("a", "b"): 5.0}, 0.1)
    out = predict.predict_native(bridge.frame(spark, d, MODEL_ROWS), model, "score", ["a", "b"], MODEL_KEYS, keep_features=False)
    return out.withColumn("score", F.round("score", 5))


TREES = """tree
feature_names=a n
objective=regression

Tree=0
num_leaves=3
num_cat=0
split_feature=0 1
threshold=0.045 3.5
decision_type=2 2
left_child=-1 -2
right_child=1 -3
leaf_value=1.5 -2 4

Tree=1
num_leaves=2
num_cat=0
split_feature=1
threshold=1.5
decision_type=2
left_child=-1
right_child=-2
leaf_value=0.25 0.75

end of trees
"""


@query(f"""
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN coalesce(a, 0) <= 0.045 THEN 1.5 WHEN coalesce(n, 0) <= 3.5 THEN -2.0 ELSE 4.0 END
  + CASE WHEN coalesce(n, 0) <= 1.5 THEN 0.25 ELSE 0.75 END AS DOUBLE) AS score FROM ({MODEL_ROWS})""")
def tree_ensemble_predict(spark: SparkSession, d: str) -> DataFrame:
    model = predict.TreeEnsemble(TREES)
    return predict.predict(bridge.frame(spark, d, MODEL_ROWS), model, "score", model.features, MODEL_KEYS, keep_features=False)


# --- intervals and tracks -----------------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, o_orderkey FROM (SELECT l_orderkey, l_linenumber, l_suppkey % 5 AS c, l_partkey * 10 + l_linenumber AS p FROM lineitem) l
JOIN (SELECT o_orderkey, o_custkey % 5 AS c, o_custkey * 10 AS t, o_orderstatus = 'F' AS minus FROM orders) o
  ON l.c = o.c AND p BETWEEN t - CASE WHEN minus THEN 200 ELSE 50 END AND t + CASE WHEN minus THEN 50 ELSE 200 END""")
def tss_window_join(spark: SparkSession, d: str) -> DataFrame:
    points = bridge.frame(spark, d, "SELECT l_orderkey, l_linenumber, l_suppkey % 5 AS chrom, l_partkey * 10 + l_linenumber AS start FROM lineitem")
    genes = bridge.frame(spark, d, "SELECT o_orderkey, o_custkey % 5 AS chrom, o_custkey * 10 AS tss, CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand FROM orders")
    out = intervals.range_join(points, intervals.strand_window(genes), "chrom", "start", width=250)
    return out.select("l_orderkey", "l_linenumber", "o_orderkey")


@query("SELECT vec_id, round((CAST(embedding[31] AS DOUBLE) + embedding[32] + embedding[33]) / 3, 5) AS middle FROM embeddings WHERE len(embedding) = 63 UNION ALL SELECT vec_id, round((CAST(embedding[CAST((len(embedding) - 3) // 2 + 1 AS BIGINT)] AS DOUBLE) + embedding[CAST((len(embedding) - 3) // 2 + 2 AS BIGINT)] + embedding[CAST((len(embedding) - 3) // 2 + 3 AS BIGINT)]) / 3, 5) FROM embeddings WHERE len(embedding) <> 63")
def central_bin_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/embeddings.parquet")
    return rows.select("vec_id", F.round(tracks.central_mean(F.col("embedding"), 3), 5).alias("middle"))


@query("SELECT l_partkey AS gene, round(avg(l_discount), 8) AS x, round(avg(l_tax), 8) AS y FROM lineitem GROUP BY 1")
def track_shift_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT l_partkey AS gene, l_discount AS x, l_tax AS y FROM lineitem")
    return tracks.over_shifts(rows, ["gene"], ["x", "y"]).select("gene", F.round("x", 8).alias("x"), F.round("y", 8).alias("y"))


@query("SELECT l_partkey AS gene, round(sum(l_tax * l_quantity) / sum(l_quantity), 8) AS x FROM lineitem GROUP BY 1")
def isoform_weighted_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT l_partkey AS gene, l_tax AS x, l_quantity AS w FROM lineitem")
    return tracks.over_isoforms(rows, ["gene"], ["x"], "weighted", "w").withColumn("x", F.round("x", 8))


@query("SELECT l_partkey AS gene, max(l_tax) AS x FROM lineitem GROUP BY 1")
def isoform_max(spark: SparkSession, d: str) -> DataFrame:
    return tracks.over_isoforms(bridge.frame(spark, d, "SELECT l_partkey AS gene, l_tax AS x FROM lineitem"), ["gene"], ["x"], "max")


@query("SELECT l_partkey AS gene, round(avg(l_tax), 8) AS x FROM lineitem WHERE l_linenumber = 1 GROUP BY 1")
def isoform_canonical(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT l_partkey AS gene, l_tax AS x, l_linenumber = 1 AS canonical FROM lineitem")
    return tracks.over_isoforms(rows, ["gene"], ["x"]).withColumn("x", F.round("x", 8))


@query("""
SELECT l_orderkey, l_linenumber, tissue, round(CASE tissue WHEN 'liver' THEN 0.5 + 2 * l_tax + l_discount ELSE 3 * l_discount - l_tax END, 8) AS expression
FROM lineitem CROSS JOIN (VALUES ('liver'), ('lung')) t(tissue)""")
def track_tissue_mapping(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT l_orderkey, l_linenumber, array(l_tax, l_discount) AS tracks FROM lineitem")
    out = tracks.to_tissues(rows, "tracks", np.array([[2.0, -1.0], [1.0, 3.0]]), ["liver", "lung"], np.array([0.5, 0.0]))
    return out.select("l_orderkey", "l_linenumber", "tissue", F.round("expression", 8).alias("expression"))


@query("""
SELECT a.p AS transcript, a.f AS tissue, round(a.x - r.x, 4) AS score FROM (SELECT l_partkey AS p, l_returnflag AS f, max(l_extendedprice) AS x FROM lineitem GROUP BY 1, 2) a
JOIN (SELECT l_partkey AS p, l_returnflag AS f, min(l_extendedprice) AS x FROM lineitem WHERE l_linenumber < 4 GROUP BY 1, 2) r ON a.p = r.p AND a.f = r.f""")
def track_variant_effect(spark: SparkSession, d: str) -> DataFrame:
    alt = bridge.frame(spark, d, "SELECT l_partkey AS transcript, l_returnflag AS tissue, max(l_extendedprice) AS expression FROM lineitem GROUP BY 1, 2")
    ref = bridge.frame(spark, d, "SELECT l_partkey AS transcript, l_returnflag AS tissue, min(l_extendedprice) AS expression FROM lineitem WHERE l_linenumber < 4 GROUP BY 1, 2")
    return tracks.effect(alt, ref, ["transcript", "tissue"]).withColumn("score", F.round("score", 4))


# --- text formats -------------------------------------------------------------------------------


@query("""
SELECT 'chr1' AS chrom, pos - 1 AS start_, pos - 1 + length(ref) AS end_, ref, a AS alt FROM (SELECT pos, ref, unnest(string_split(alt, ',')) AS a FROM alleles)
WHERE regexp_matches(ref, '^[ACGTacgt]+$') AND regexp_matches(a, '^[ACGTacgt]+$')""")
def vcf_text_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "alleles")
    path = scratch(spark)
    lines = rows.select(F.concat_ws("\t", F.lit("chr1"), q("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit(".")).alias("value"))
    spark.createDataFrame([("##fileformat=VCFv4.2",), ("#CHROM\tPOS",)], "value string").union(lines).write.text(path)
    return plain(variants.valid_alleles(variants.with_keys(variants.split_alleles(genome.read_vcf(spark, path)), "info_END"))).select("chrom", "start_", "end_", "ref", "alt")


@query("""
SELECT concat('G', CAST(p_partkey AS VARCHAR), '.1') AS gene_id, concat('T', CAST(p_partkey AS VARCHAR), '.2') AS transcript_id,
  CASE WHEN p_size < 25 THEN 'protein_coding' ELSE 'lncRNA' END AS transcript_biotype, p_partkey * 10 - 1 AS start_ FROM part WHERE p_size % 2 = 0""")
def gtf_text_parse(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    bridge.frame(spark, d, """
        SELECT concat('chr1\tsrc\t', CASE WHEN p_size % 2 = 0 THEN 'transcript' ELSE 'exon' END, '\t', CAST(p_partkey * 10 AS STRING), '\t', CAST(p_partkey * 10 + 5 AS STRING),
          '\t.\t+\t.\tgene_id "G', CAST(p_partkey AS STRING), '.1"; transcript_id "T', CAST(p_partkey AS STRING), '.2"; transcript_type "',
          CASE WHEN p_size < 25 THEN 'protein_coding' ELSE 'lncRNA' END, '"; tag "a"; tag "b";') AS value FROM part""").write.text(path)
    rows = genome.transcripts(genome.read_gtf(spark, path))
    return rows.select("gene_id", "transcript_id", "transcript_biotype", F.col("Start").alias("start_"))


@query(f"SELECT id, gene, consequence, lof FROM ({ANNOTATION})")
def vep_tsv_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    rows = bridge.frame(spark, d, ANNOTATION).select("id", "gene", "consequence", "lof")
    cells = [F.coalesce(F.col(c), F.lit("-")) for c in rows.columns]
    top = spark.createDataFrame([("## made by a test",), ("#Uploaded_variation\tGene\tConsequence\tLoF",)], "value string")
    top.coalesce(1).write.text(f"{path}/head")
    rows.select(F.concat_ws("\t", *cells).alias("value")).write.text(f"{path}/rows")
    out = text_tables.read_annotations(spark, f"{path}/rows", header=f"{path}/head")
    return out.select(q(annotations.ID).alias("id"), F.col("Gene").alias("gene"), F.col("Consequence").alias("consequence"), F.col("LoF").alias("lof"))


@query("""
SELECT concat('G', CAST(p_partkey AS VARCHAR)) AS gene, p_brand AS tissue, CASE WHEN p_size < 25 THEN TRUE ELSE FALSE END AS gene_is_expressed,
  CAST(CAST(p_size AS FLOAT) AS DOUBLE) AS median_expression FROM part""")
def typed_tsv_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    rows = bridge.frame(spark, d, """
        SELECT 'x' AS other, concat('G', CAST(p_partkey AS STRING)) AS gene, p_brand AS tissue, 'all' AS tissue_type, CAST(p_size < 25 AS STRING) AS gene_is_expressed,
          CAST(p_size AS STRING) AS median_expression, '0.5' AS expression_dispersion FROM part""")
    rows.coalesce(1).write.csv(path, header=True, sep="\t")
    out = text_tables.expected_expression(spark, path)
    return out.select("gene", "tissue", "gene_is_expressed", F.col("median_expression").cast("double").alias("median_expression"))


# --- whole tables through writers and readers ----------------------------------------------------

PLACES = """
SELECT concat('chr', CAST(l_suppkey % 5 AS VARCHAR(10))) AS chrom, l_orderkey AS start_, l_orderkey + l_linenumber AS end_, l_returnflag AS ref,
  l_linestatus AS alt FROM lineitem"""


@query(f"SELECT * FROM ({PLACES})")
def sorted_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_parquet(bridge.frame(spark, d, PLACES), path, sort=["chrom", "start_"])
    return text_tables.parquet(spark, path)


@query(f"SELECT * FROM ({PLACES})")
def parquet_by_input_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_parquet(bridge.frame(spark, d, PLACES).withColumn("vcf_file", F.concat("chrom", F.lit(".vcf"))), path, by=["vcf_file"])
    out = text_tables.parquet(spark, path, partitions=True)
    return out.where(F.col("vcf_file") == F.concat("chrom", F.lit(".vcf"))).drop("vcf_file")


@query("""
SELECT concat('chr', CAST(l_suppkey % 5 AS VARCHAR)) AS chrom, l_orderkey AS start_, l_returnflag AS tissue, l_discount AS delta_psi, CAST(NULL AS VARCHAR) AS junction FROM lineitem""")
def declared_schema_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    rows = bridge.frame(spark, d, "SELECT l_discount AS delta_psi, 1 AS other, l_returnflag AS tissue, l_orderkey AS start, concat('chr', CAST(l_suppkey % 5 AS STRING)) AS chrom FROM lineitem")
    sinks.write_schema(rows, path, ddl(SPLICE_OUTPUT))
    return plain(text_tables.parquet(spark, path)).select("chrom", "start_", "tissue", "delta_psi", "junction")


@query("SELECT count(*) AS n, 26 AS columns FROM lineitem WHERE l_quantity < 0")
def empty_table_keeps_schema(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    sinks.write_schema(bridge.frame(spark, d, "SELECT l_returnflag AS chrom FROM lineitem WHERE l_quantity < 0"), path, ddl(SPLICE_OUTPUT))
    out = text_tables.parquet(spark, path)
    return out.agg(F.count(F.lit(1)).alias("n")).withColumn("columns", F.lit(len(out.columns)))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_returnflag, CASE WHEN l_linenumber = 2 THEN NULL ELSE 'a,\"b' END AS cell FROM lineitem")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    rows = bridge.frame(spark, d, "SELECT l_orderkey, l_returnflag, l_linenumber FROM lineitem")
    sinks.write_csv(rows.select("l_orderkey", "l_returnflag", F.when(F.col("l_linenumber") != 2, F.lit('a,"b')).alias("cell")), path)
    return spark.read.csv(path, header=True)


VCF_WRITTEN = f"""
SELECT chrom, start_ + 1 AS pos, concat(chrom, ':', CAST(start_ AS VARCHAR(20)), ':', CAST(end_ AS VARCHAR(20)), ':', ref, '>', alt) AS id, ref, alt, end_ AS info_end FROM ({PLACES})"""


def vcf_written(spark: SparkSession, d: str, shards: int | None) -> DataFrame:
    path = scratch(spark)
    sinks.write_vcf(keyed(bridge.frame(spark, d, PLACES)), path, ["##fileformat=VCFv4.2"], shards=shards)
    return genome.read_vcf(spark, path).select("chrom", "pos", "id", "ref", "alt", F.col("info_END").alias("info_end"))


@query(VCF_WRITTEN)
def vcf_write_read(spark: SparkSession, d: str) -> DataFrame:
    return vcf_written(spark, d, 1)


@query(VCF_WRITTEN)
def vcf_shards_write_read(spark: SparkSession, d: str) -> DataFrame:
    return vcf_written(spark, d, 7)


@query("""
SELECT 'chr1' AS chromosome, CAST(pos AS INTEGER) AS position, ref AS reference, len(string_split(alt, ',')) AS n_alternate, string_split(alt, ',')[1] AS first_alternate,
  CASE WHEN pos % 2 = 0 THEN CAST(pos + 3 AS INTEGER) END AS info_end FROM alleles""")
def vcf_to_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    info = F.when(F.col("pos") % 2 == 0, F.concat(F.lit("SVTYPE=DEL;END="), (F.col("pos") + 3).cast("string"))).otherwise(".")
    cells = [F.lit("chr1"), q("pos").cast("string"), F.lit("."), q("ref"), q("alt"), F.lit("."), F.lit("PASS"), info]
    bridge.frame(spark, d, "alleles").select(F.concat_ws("\t", *cells).alias("value")).write.text(f"{path}/t")
    sinks.write_parquet(genome.as_variant_table(genome.read_vcf(spark, f"{path}/t")), f"{path}/p")
    table = text_tables.parquet(spark, f"{path}/p").withColumnRenamed("info_END", "info_end")
    return table.select("chromosome", "position", "reference", F.size("alternate").cast("bigint").alias("n_alternate"), F.get("alternate", F.lit(0)).alias("first_alternate"), "info_end")


@query(f"SELECT id, gene AS x, consequence AS x_2, lof AS x_3 FROM ({ANNOTATION})")
def duplicate_header_names(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    rows = bridge.frame(spark, d, ANNOTATION).select(F.concat_ws("\t", "id", "gene", F.coalesce("consequence", F.lit("-")), F.coalesce("lof", F.lit("-"))).alias("value"))
    spark.createDataFrame([("## x",), ("#Uploaded_variation\tx\tx\tx",)], "value string").coalesce(1).write.text(f"{path}/head")
    rows.write.text(f"{path}/rows")
    return text_tables.read_annotations(spark, f"{path}/rows", header=f"{path}/head").withColumnRenamed(annotations.ID, "id")


@query("""
SELECT concat('G', CAST(p_partkey AS VARCHAR)) AS gene, p_brand AS tissue, p_type AS transcript, CAST(CAST(p_size AS FLOAT) AS DOUBLE) AS median_proportion FROM part""")
def isoform_tsv_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    rows = bridge.frame(spark, d, """
        SELECT p_type AS transcript, '0.25' AS mean_transcript_proportions, CAST(p_size AS STRING) AS median_transcript_proportions, '' AS sd_transcript_proportions,
          concat('G', CAST(p_partkey AS STRING)) AS gene, 'all' AS tissue_type, p_brand AS tissue FROM part""")
    rows.coalesce(1).write.csv(path, header=True, sep="\t")
    out = text_tables.isoform_proportions(spark, path)
    return out.select("gene", "tissue", "transcript", F.col("median_transcript_proportions").cast("double").alias("median_proportion"))


@query("""
SELECT concat('chr1:', CAST(l_orderkey AS VARCHAR), ':A>C') AS variant, concat('N', CAST(l_partkey AS VARCHAR)) AS gene_name, CAST(CAST(l_linenumber AS FLOAT) AS DOUBLE) AS delta_score FROM lineitem""")
def splice_csv_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    rows = bridge.frame(spark, d, "SELECT 'x' AS other, concat('N', CAST(l_partkey AS STRING)) AS gene_name, concat('chr1:', CAST(l_orderkey AS STRING), ':A>C') AS variant, CAST(l_linenumber AS STRING) AS delta_score FROM lineitem")
    more = [f.name for f in ddl(SPLICE_SCORES).fields if f.name not in rows.columns]
    rows.withColumns({c: F.lit(None).cast("string") for c in more}).coalesce(1).write.csv(path, header=True)
    return text_tables.splice_scores(spark, path).select("variant", "gene_name", F.col("delta_score").cast("double").alias("delta_score"))


@query("SELECT n_name AS contig, CAST(0 AS BIGINT) AS start_, CAST(100 + n_nationkey + 1 AS BIGINT) AS end_ FROM nation")
def fasta_index_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    bridge.frame(spark, d, "SELECT n_name, 100 + n_nationkey AS n, 7 AS o, 60 AS b, 61 AS w FROM nation").write.csv(path, sep="\t")
    return plain(genome.read_fai(spark, path))


@query("""
WITH s AS (SELECT n_name AS contig, repeat('ACGTT', 10 * CAST(n_nationkey AS BIGINT)) AS t FROM nation WHERE n_nationkey > 0),
  k AS (SELECT contig, t, unnest(range(0, CAST(ceil(length(t) / 64) AS BIGINT))) AS chunk FROM s)
SELECT contig, CAST(chunk AS BIGINT) AS chunk, greatest(0, (chunk - 1) * 64) + 1 AS first_,
  substr(t, greatest(0, (chunk - 1) * 64) + 1, least((chunk + 1) * 64, length(t)) - greatest(0, (chunk - 1) * 64)) AS bases FROM k""")
def fasta_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    lines = bridge.frame(spark, d, "SELECT n_name, CAST(n_nationkey AS INT) AS k FROM nation").select(
        "n_name", F.explode(F.concat(F.array(F.concat(F.lit(">"), "n_name", F.lit(" note"))), F.array_repeat(F.lit("acgtt" * 2), F.col("k") * 5))).alias("value")
    )
    lines.coalesce(1).select("value").write.text(path)
    return genome.read_fasta(spark, path, piece=64).withColumnRenamed("first", "first_")


# --- order, keys and types ------------------------------------------------------------------------


@query(f"""
WITH b AS ({BEST}), v AS (SELECT DISTINCT concat('chr', CAST(o_custkey % 5 AS VARCHAR)) AS chrom, o_orderkey AS start_, o_orderkey + 1 AS end_, 'A' AS ref, 'C' AS alt FROM orders)
SELECT chrom, start_, gene, tissue, score, row_number() OVER (ORDER BY chrom NULLS FIRST, start_ NULLS FIRST, gene NULLS FIRST, tissue NULLS FIRST) AS place
FROM v LEFT JOIN b USING (chrom, start_, end_, ref, alt) QUALIFY place <= 200""")
def ordered_top_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT concat('chr', CAST(o_custkey % 5 AS STRING)) AS chrom, o_orderkey AS start, o_orderkey + 1 AS `end`, 'A' AS ref, 'C' AS alt FROM orders").distinct()
    best = groups.best_per_group(keyed(bridge.frame(spark, d, "scores")), [*VARIANT_KEY, "gene", "tissue"], "score", ties=["l_linenumber"])
    top = variants.join_scores(rows, best, list(VARIANT_KEY), ordered=True).limit(200)  # a report of the first rows
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("bigint")
    return plain(top).select("chrom", "start_", "gene", "tissue", "score", place.alias("place"))


@query("""
SELECT coalesce('N' || CAST(CASE WHEN n_nationkey < 10 THEN n_nationkey END AS VARCHAR), n_name) AS chrom, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def contig_rename(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT n_name AS chrom, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
    return variants.rename_contigs(rows, bridge.frame(spark, d, "aliases").withColumnRenamed("name", "chrom"))


@query("""
SELECT o_orderkey, concat('chr1:', CAST(pos - 1 AS VARCHAR), ':', CAST(CASE WHEN o_orderkey % 5 = 0 THEN pos + 10 ELSE pos - 1 + length(ref) END AS VARCHAR), ':', ref, '>', a) AS id,
  CASE WHEN o_orderkey % 7 = 0 THEN 'given' WHEN NOT regexp_matches(ref, '^[ACGTacgt]+$') OR NOT regexp_matches(a, '^[ACGTacgt]+$') THEN 'OTHER' WHEN length(ref) <> length(a) THEN 'INDEL'
    WHEN upper(ref) = upper(a) THEN 'REF' WHEN length(ref) = 1 THEN 'SNP' ELSE 'MNP' END AS kind
FROM (SELECT *, unnest(string_split(alt, ',')) AS a FROM alleles)""")
def tags_and_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = variants.split_alleles(bridge.frame(spark, d, "alleles").withColumns({"info_END": F.when(F.col("o_orderkey") % 5 == 0, F.col("pos") + 10), "info_TYPE": F.when(F.col("o_orderkey") % 7 == 0, "given")}))
    tagged = variants.with_tags(rows)
    ident = s.format_variant_id(F.lit("chr1"), F.col("pos") - 1, F.col("info_END"), F.col("ref"), F.col("alt"))
    return tagged.select("o_orderkey", ident.alias("id"), F.col("info_TYPE").alias("kind"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS BIGINT) ELSE CAST(3 + 2 * (o_custkey % 90) AS BIGINT) END AS pos, CASE o_orderstatus WHEN 'F' THEN 'GCA' WHEN 'O' THEN 'A' ELSE 'ACA' END AS ref,
  CASE o_orderstatus WHEN 'F' THEN 'G' WHEN 'O' THEN 'C' ELSE '<DEL>' END AS alt FROM orders""")
def left_alignment(spark: SparkSession, d: str) -> DataFrame:
    bases = "G" + "CA" * 100 + "TTTT"
    chunks = [("chr1", k, max(0, (k - 1) * 128) + 1, bases[max(0, (k - 1) * 128) : (k + 1) * 128]) for k in range(2)]
    reference = spark.createDataFrame(chunks, "contig string, chunk long, first long, bases string")
    rows = bridge.frame(spark, d, """
        SELECT o_orderkey, 'chr1' AS chrom, CAST(3 + 2 * (o_custkey % 90) AS BIGINT) AS pos, CASE o_orderstatus WHEN 'O' THEN 'A' ELSE 'ACA' END AS ref,
          CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'C' ELSE '<DEL>' END AS alt FROM orders""")
    return variants.left_align(rows, reference).drop("chrom")


@query("SELECT l_orderkey, l_linenumber, CAST(NULL AS VARCHAR) AS gene FROM lineitem")
def null_column_types(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT l_orderkey, l_linenumber, NULL AS gene FROM lineitem")
    return groups.cast_void(rows, bridge.frame(spark, d, "scores"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL ELSE round(2 * CASE WHEN l_linenumber = 2 THEN 0.5 ELSE l_discount END + CASE WHEN l_linenumber = 3 THEN 0 ELSE l_tax END, 5) END AS score
FROM lineitem""")
def missing_numbers_predict(spark: SparkSession, d: str) -> DataFrame:
    nan = F.lit(float("nan"))
    rows = bridge.frame(spark, d, "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem").select(
        *MODEL_KEYS, F.when(F.col("l_linenumber") == 2, nan).otherwise(F.col("l_discount")).alias("x.y"),
        F.when(F.col("l_linenumber") == 3, nan).otherwise(F.col("l_tax")).alias("z"), F.when(F.col("l_linenumber") == 1, nan).otherwise(1.0).alias("needed"),
    )
    out = predict.predict_native(rows, predict.linear({"x.y": 2.0, "z": 1.0}), "score", ["x.y", "z"], MODEL_KEYS, ["needed"], {"x.y": 0.5}, keep_features=False)
    return out.withColumn("score", F.round("score", 5))


ANNOTATED_SQL = TISSUE_SQL.replace("CROSS JOIN nation", """LEFT JOIN (SELECT concat('G', CAST(p_partkey % 4 AS VARCHAR)) AS gene, concat('T', CAST(p_partkey AS VARCHAR)) AS transcript
  FROM part CROSS JOIN (SELECT 1 AS i UNION ALL SELECT 2) WHERE p_size % 3 <> 0 AND (i = 1 OR p_size % 5 = 0)) g ON v.gene = g.gene AND v.transcript = g.transcript
CROSS JOIN (SELECT n_name FROM nation UNION ALL SELECT NULL)""")


@query(ANNOTATED_SQL)
def tissue_features_annotated(spark: SparkSession, d: str) -> DataFrame:
    """With a transcript annotation that repeats and lacks transcripts, and a null tissue."""
    inputs = tissue_inputs(spark, d)
    gtf = bridge.frame(spark, d, """
        SELECT concat('G', CAST(p_partkey % 4 AS STRING), '.', CAST(i AS STRING)) AS gene_id, concat('T', CAST(p_partkey AS STRING), '.7') AS transcript_id
        FROM part CROSS JOIN (SELECT 1 AS i UNION ALL SELECT 2) WHERE p_size % 3 <> 0 AND (i = 1 OR p_size % 5 = 0)""")
    inputs["tissues"] = inputs["tissues"].union(spark.sql("SELECT CAST(NULL AS STRING)"))
    return tissue_output(tissue_features.tissue_features(**inputs, gtf=gtf))


@query("""
SELECT c_custkey, l_orderkey, l_linenumber, (k = 1) = (l_extendedprice > 20000) AS donor FROM (SELECT c_custkey, c_nationkey % 5 AS c, c_custkey * 7 AS p FROM customer) v
JOIN (SELECT l_orderkey, l_linenumber, l_extendedprice, l_suppkey % 5 AS c, l_partkey * 10 + CASE WHEN k = 1 THEN 0 ELSE 50 END AS site, k FROM lineitem CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2)) s
  ON v.c = s.c AND abs(p - site) <= 20""")
def junctions_near_variants(spark: SparkSession, d: str) -> DataFrame:
    maps = bridge.frame(spark, d, """
        SELECT l_orderkey, l_linenumber, concat(CAST(l_suppkey % 5 AS STRING), ':', CAST(l_partkey * 10 AS STRING), '-', CAST(l_partkey * 10 + 50 AS STRING), ':',
          CASE WHEN l_extendedprice > 20000 THEN '+' ELSE '-' END) AS junction FROM lineitem""")
    rows = bridge.frame(spark, d, "SELECT c_custkey, CAST(c_nationkey % 5 AS STRING) AS chrom, c_custkey * 7 AS start FROM customer")
    return splice.near_sites(rows, splice.junction_sites(maps), 20).select("c_custkey", "l_orderkey", "l_linenumber", "donor")


@query("""
SELECT o_orderkey, c_custkey, unnest([-43, 0, 43]) AS shift FROM (SELECT c_custkey, c_nationkey AS c, c_custkey * 13 AS p FROM customer) v
JOIN (SELECT o_orderkey, o_custkey % 25 AS c, o_custkey * 11 AS t FROM orders) o ON v.c = o.c AND p BETWEEN t - 50 AND t + 200""")
def model_sequence_requests(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.frame(spark, d, "SELECT c_custkey, c_nationkey AS chrom, c_custkey * 13 AS start FROM customer")
    genes = bridge.frame(spark, d, "SELECT o_orderkey, o_custkey % 25 AS chrom, o_custkey * 11 AS tss, '+' AS strand FROM orders")
    return tracks.sequence_requests("alternative", genes, rows).select("o_orderkey", "c_custkey", "shift")


# --- files by their names -------------------------------------------------------------------------


def named_file(spark: SparkSession, lines: DataFrame, folder: str, name: str) -> None:
    """Lines (value) as one file of this name, for readers that go by names."""
    made = scratch(spark)
    lines.coalesce(1).write.text(made)
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(at(folder))
    files.rename(files.globStatus(at(f"{made}/part-*"))[0].getPath(), at(folder, name))


def text_lines(spark: SparkSession, *values: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)


ENDINGS = (".vcf", ".vcf.gz", ".txt", ".bcf", ".vcf.bgz")


@query("""
SELECT concat('r', CAST(r_regionkey AS VARCHAR), ['.vcf', '.vcf.gz', '.txt', '.bcf', '.vcf.bgz'][CAST(r_regionkey AS INTEGER) + 1]) AS name FROM region WHERE r_regionkey <> 2""")
def variant_file_discovery(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch(spark)
    for (k,) in bridge.frame(spark, d, "SELECT CAST(r_regionkey AS INT) FROM region").collect():  # five files
        named_file(spark, text_lines(spark, "#x"), f"{folder}/{k % 2}", f"r{k}{ENDINGS[k]}")
    return text_tables.variant_files(spark, folder).select("name")


@query("""
SELECT concat('chr1:', CAST(p_partkey AS VARCHAR), '-', CAST(p_partkey + 9 AS VARCHAR), ':+') AS junction, CASE WHEN p_size % 2 = 0 THEN 'Liver' ELSE 'Skin - Leg' END AS tissue,
  CASE WHEN p_size % 4 < 2 THEN 'psi5' ELSE 'psi3' END AS event_type FROM part""")
def splice_map_files(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch(spark)
    rows = bridge.frame(spark, d, "SELECT concat('chr1:', CAST(p_partkey AS STRING), '-', CAST(p_partkey + 9 AS STRING), ':+') AS value, p_size FROM part")
    for i in range(4):
        tissue, event = ("Skin - Leg" if i % 2 else "Liver"), ("psi5" if i < 2 else "psi3")
        named_file(spark, text_lines(spark, "junction").union(rows.where(F.col("p_size") % 4 == i).select("value")), folder, f"{tissue}_splicemap_{event}_v1.csv")
    return text_tables.splice_maps(spark, f"{folder}/*_splicemap_*.csv", "_splicemap").select("junction", "tissue", "event_type")


@query("""
SELECT 'chrom' AS kind, concat('c', CAST(n_nationkey AS VARCHAR)) AS alias, n_name AS name FROM nation
UNION ALL SELECT 'tissue', n_name, concat('t', CAST(n_regionkey AS VARCHAR)) FROM nation""")
def alias_tables_read(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch(spark)
    rows = bridge.frame(spark, d, "SELECT concat('c', CAST(n_nationkey AS STRING)) AS c, n_name, concat('t', CAST(n_regionkey AS STRING)) AS t FROM nation")
    named_file(spark, text_lines(spark, "#alias\tchrom").union(rows.select(F.concat_ws("\t", "c", "n_name"))), folder, "chromosomes.tsv")
    named_file(spark, text_lines(spark, "old,new,more").union(rows.select(F.concat_ws(",", "n_name", "t", F.lit("x")))), folder, "tissues.csv")
    chroms = text_tables.chromosome_aliases(spark, f"{folder}/chromosomes.tsv").select(F.lit("chrom").alias("kind"), "alias", F.col("chrom").alias("name"))
    tissues = text_tables.tissue_aliases(spark, f"{folder}/tissues.csv").select(F.lit("tissue").alias("kind"), "alias", F.col("tissue").alias("name"))
    return chroms.union(tissues)


@query("""
SELECT concat('chr1:', CAST(l_orderkey AS VARCHAR), ':A>C') AS variant, l_returnflag AS tissue, l_discount AS delta_logit_psi, l_quantity AS median_n FROM lineitem""")
def junction_csv_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    rows = bridge.frame(spark, d, "SELECT CAST(l_quantity AS DOUBLE) AS median_n, l_returnflag AS tissue, concat('chr1:', CAST(l_orderkey AS STRING), ':A>C') AS variant, CAST(l_discount AS DOUBLE) AS delta_logit_psi FROM lineitem")
    more = [f.name for f in ddl(JUNCTION_SCORES).fields if f.name not in rows.columns]
    rows.withColumns({c: F.lit(None).cast("string") for c in more}).coalesce(1).write.csv(path, header=True)
    return text_tables.junction_scores(spark, path).select("variant", "tissue", "delta_logit_psi", "median_n")


@query("SELECT chrom, min(start_) AS min_start, count(*) AS num_rows, row_number() OVER (ORDER BY chrom) AS place FROM scores GROUP BY chrom")
def ordered_region_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = tissue_features.region_stats(keyed(bridge.frame(spark, d, "scores"))).orderBy("chrom")  # a row a contig
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("bigint")
    return stats.select("chrom", "min_start", "num_rows", place.alias("place"))
