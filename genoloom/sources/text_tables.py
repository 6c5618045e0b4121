"""Readers of delimited tables. Schemas are declared; cells that don't fit raise an error unless said otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EXPECTED_EXPRESSION, ISOFORM_PROPORTIONS, JUNCTION_SCORES, SPLICE_SCORES, ddl, q

VARIANT_FILES = r"\.(vcf|vcf\.gz|vcf\.bgz|bcf)$"


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Names in the first line that doesn't start with ``##``; reads until it is found."""
    first = spark.read.text(path).where(~F.col("value").startswith("##")).first()
    if first is None:
        raise ValueError(f"{path} has no header line")
    return first[0].rstrip("\r\n").split("\t")


def unique_names(names: list[str]) -> list[str]:
    """The second ``X`` becomes ``X_2``, the third ``X_3``."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return out


def read_tsv(spark: SparkSession, path: str, names: list[str], null: str = "-") -> DataFrame:
    """Headerless tab-separated strings, ``null`` and empty cells as null. Lines that start with ``#`` are skipped."""
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.csv(path, schema=schema, sep="\t", nullValue=null, quote="", comment="#")


def read_annotations(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """The annotator's table: names from the header line of ``header`` (or the file itself)."""
    return read_tsv(spark, path, unique_names(header_of(spark, header or path)))


def read_typed(spark: SparkSession, path: str, schema: str, sep: str = "\t", columns: list[str] | None = None) -> DataFrame:
    """A table with a header, bound to ``schema`` by name: CSV binds by position, so the header is read first and
    columns in other places or beyond the schema do no harm. Missing columns are an error."""
    kinds = {f.name: f.dataType for f in ddl(schema).fields}
    first = spark.read.option("maxRowsInMemory", 1).text(path).first()
    names = first[0].rstrip("\r\n").split(sep) if first else list(kinds)
    missing = set(columns or kinds) - set(names)
    if missing:
        raise ValueError(f"{path} lacks {sorted(missing)}")
    full = ", ".join(f"`{n}` {kinds[n].simpleString() if n in kinds else 'string'}" for n in names)
    rows = spark.read.csv(path, schema=full, sep=sep, header=True, mode="FAILFAST", enforceSchema=True)
    return rows.select(*[q(c) for c in (columns or kinds)])


def expected_expression(spark: SparkSession, path: str) -> DataFrame:
    names = spark.read.text(path).first()[0].split("\t")
    columns = [f.name for f in ddl(EXPECTED_EXPRESSION).fields if f.name != "transcript" or "transcript" in names]
    return read_typed(spark, path, EXPECTED_EXPRESSION, columns=columns)


def isoform_proportions(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, ISOFORM_PROPORTIONS)


def junction_scores(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, JUNCTION_SCORES, sep=",")


def splice_scores(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, SPLICE_SCORES, sep=",")


def chromosome_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, chrom) of an alias table whose first column is ``#alias``."""
    return spark.read.csv(path, sep="\t", header=True).select(q("#alias").alias("alias"), "chrom")


def tissue_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, tissue) from the first two columns of a CSV file with a header."""
    df = spark.read.csv(path, header=True)
    return df.select(q(df.columns[0]).alias("alias"), q(df.columns[1]).alias("tissue"))


def splice_maps(spark: SparkSession, pattern: str, suffix: str) -> DataFrame:
    """All splice-site tables that match a glob in one read. File names are the tissue, ``suffix`` and more, with
    the event type (psi5, psi3) somewhere behind; both become columns."""
    df = spark.read.csv(pattern, header=True).select("*", F.col("_metadata.file_name").alias("_file"))
    name = F.url_decode("_file")
    return df.withColumns(
        {"tissue": F.substring_index(name, suffix, 1), "event_type": F.regexp_extract(name, r"(psi[35])", 1)}
    ).drop("_file")


def variant_files(spark: SparkSession, folder: str, pattern: str = VARIANT_FILES) -> DataFrame:
    """(path, name) of the files below a folder whose name fits."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1)).where(F.col("name").rlike(pattern))


def parquet(spark: SparkSession, path: str, partitions: bool = False) -> DataFrame:
    """A Parquet file or folder. Folder names such as ``chrom=chr1`` add no column unless ``partitions`` is set."""
    reader = spark.read.option("recursiveFileLookup", not partitions)
    return reader.parquet(path)
