"""Readers of genome formats: VCF text, GTF, FASTA and its index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import q

VCF_COLUMNS = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info")
GTF_COLUMNS = ("Chromosome", "Source", "Feature", "Start", "End", "Score", "Strand", "Frame")


def info_value(info, key: str):
    """Value of ``KEY=value`` in an INFO cell, null if it isn't there."""
    return F.nullif(F.regexp_extract(info, rf"(?:^|;){key}=([^;]*)", 1), F.lit(""))


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Records of VCF text files (plain, gzip, bgzip) with END, TYPE and SVTYPE and the file each came from. BCF is
    binary and has to be converted by its own tools."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("vcf_file"))
    cells = F.split(F.col("value"), "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.length("value") > 0)).select(
        *[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(VCF_COLUMNS)], "vcf_file"
    )
    none = lambda c: F.when(q(c) != ".", q(c))
    return rows.withColumns(
        {
            "pos": q("pos").cast("bigint"),
            "id": none("id"),
            "qual": none("qual").try_cast("double"),
            "info_END": info_value(q("info"), "END").try_cast("bigint"),
            "info_TYPE": info_value(q("info"), "TYPE"),
            "info_SVTYPE": info_value(q("info"), "SVTYPE"),
        }
    )


def vcf_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Distinct contig names of the header lines."""
    name = F.regexp_extract("value", r"^##contig=<(?:.*,)?ID=([^,>]+)", 1)
    return spark.read.text(path).select(name.alias("contig")).where("contig <> ''").distinct()


def as_variant_table(vcf: DataFrame) -> DataFrame:
    """The column layout of converted variant files: chromosome, position, identifier, reference, alternate, info_END."""
    return vcf.select(
        q("chrom").alias("chromosome"),
        q("pos").cast("int").alias("position"),
        F.when(q("id").isNotNull(), F.split("id", ";")).alias("identifier"),
        q("ref").alias("reference"),
        F.split("alt", ",").alias("alternate"),
        F.split("filter", ";").alias("filter"),
        q("info_END").cast("int").alias("info_END"),
    )


def read_gtf(spark: SparkSession, path: str, attributes: tuple[str, ...] = ("gene_id", "transcript_id", "gene_name", "transcript_type", "transcript_biotype", "tag")) -> DataFrame:
    """GTF lines with 0-based starts and the named attributes; repeated ones are joined by commas. Other attributes
    stay in ``Attributes``."""
    cells = F.split(F.col("value"), "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.length("value") > 0))
    rows = rows.select(*[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(GTF_COLUMNS)], F.get(cells, F.lit(8)).alias("Attributes"))

    def attribute(name: str):
        found = F.regexp_extract_all(F.col("Attributes"), F.lit(rf'(?:^|[;\s]){name} "?([^";]*)"?'), F.lit(1))
        return F.nullif(F.array_join(found, ","), F.lit(""))

    rows = rows.withColumns({a: attribute(a) for a in attributes})
    return rows.withColumns({"Start": q("Start").cast("bigint") - 1, "End": q("End").cast("bigint")})


def transcripts(gtf: DataFrame) -> DataFrame:
    """Transcript lines; the biotype under one name whichever the file uses."""
    rows = gtf.where("Feature = 'transcript'")
    if {"transcript_type", "transcript_biotype"} <= set(rows.columns):
        return rows.withColumn("transcript_biotype", F.coalesce("transcript_biotype", "transcript_type")).drop("transcript_type")
    return rows.withColumnRenamed("transcript_type", "transcript_biotype")


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """(contig, start, end) of a FASTA index: from 0 to one behind the length."""
    schema = "contig string, length bigint, offset bigint, bases int, width int"
    return spark.read.csv(path, schema=schema, sep="\t").select("contig", F.lit(0).cast("bigint").alias("start"), (F.col("length") + 1).alias("end"))


def read_fasta(spark: SparkSession, path: str, piece: int = 65_536) -> DataFrame:
    """(contig, chunk, first, bases): each chunk holds its piece of a contig after the piece before it, upper case;
    ``first`` is the 1-based position of its first base.

    Lines are placed block by block: a window numbers the bases of a block of the file, and one row a contig and block
    carries contigs and positions over from block to block. What a task holds is a block of lines, then two pieces; no
    contig is ever one value. A contig without bases has no chunk.
    """
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select(F.btrim("value").alias("value"), *meta, F.monotonically_increasing_id().alias("n"))
    head = F.col("value").startswith(">")
    placed = Window.partitionBy("file", "block").orderBy("n")
    rows = lines.select(
        "file", "block", "n",
        F.when(head, F.regexp_extract("value", r"^>\s*(\S*)", 1)).alias("name"),
        F.when(head, "").otherwise(F.upper(F.regexp_replace("value", r"\s", ""))).alias("bases"),
        F.sum(head.cast("int")).over(placed).alias("part"),
    )
    size = F.length("bases").cast("bigint")
    inside = Window.partitionBy("file", "block", "part").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    parts = rows.groupBy("file", "block", "part").agg(F.max("name").alias("name"), F.sum(size).alias("size"))
    in_file = Window.partitionBy("file").orderBy("block", "part")
    parts = parts.withColumns({"contig": F.last("name", True).over(in_file), "nth": F.count("name").over(in_file)})
    ahead = Window.partitionBy("file", "nth").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file", "nth")
    parts = parts.withColumns({"before": F.coalesce(F.sum("size").over(ahead), F.lit(0)), "total": F.sum("size").over(whole)})
    parts = parts.where("contig IS NOT NULL AND size > 0").select("file", "block", "part", "contig", "nth", "before", "total")
    at = F.col("before") + F.col("within")
    found = rows.where("bases <> ''").join(parts, ["file", "block", "part"]).select("file", "contig", "nth", "total", at.alias("at"), "bases")
    own = F.sequence(F.expr(f"at DIV {piece}"), F.expr(f"(at + length(bases) - 1) DIV {piece}"))
    cut = found.select("*", F.explode(own).alias("k"))
    low, high = F.greatest(F.col("at"), F.col("k") * piece), F.least(F.col("at") + F.length("bases"), (F.col("k") + 1) * piece)
    text = F.substr("bases", (low - F.col("at") + 1).cast("int"), (high - low).cast("int"))
    twice = F.explode(F.array("k", F.col("k") + 1)).alias("chunk")
    dealt = cut.select("file", "contig", "nth", "total", low.alias("low"), text.alias("text"), twice).where(F.col("chunk") * piece < F.col("total"))
    ordered = F.sort_array(F.collect_list(F.struct("low", "text")))
    chunks = dealt.groupBy("file", "contig", "nth", "chunk").agg(ordered.alias("t"))
    return chunks.select("contig", "chunk", (F.get("t", F.lit(0))["low"] + 1).alias("first"), F.array_join("t.text", "").alias("bases"))
