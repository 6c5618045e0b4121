"""Writers. Outputs are written by Spark's committer to a path that isn't read by the same plan."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import q


NAMES = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"


def write_parquet(df: DataFrame, path: str, sort: list[str] | None = None, by: list[str] | None = None, mode: str = "error") -> None:
    """Snappy Parquet with statistics. ``sort`` orders rows inside files, so that row groups can be skipped by key;
    ``by`` makes a folder for each value, e.g. one output for each input file. Columns of the null type become strings."""
    void = {c: q(c).cast("string") for c, kind in df.dtypes if kind == "void"}
    out = df.withColumns(void) if void else df
    if sort:
        out = out.repartitionByRange(*map(q, sort)).sortWithinPartitions(*map(q, sort))
    writer = out.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_schema(df: DataFrame, path: str, schema: T.StructType, mode: str = "error") -> None:
    """``df`` in exactly this schema: missing columns are null, others dropped, order and types fixed. An empty table
    still has its schema."""
    df.to(schema).write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).csv(path, header=True)


def write_vcf(df: DataFrame, path: str, header: list[str], mode: str = "error", shards: int | None = 1) -> None:
    """Records (chrom, start, end, ref, alt) as minimal VCF text under a replaced header, ids made of the key, sorted.

    One file by default, as the format has one header; all rows then pass through one task. With ``shards`` (None: as many
    as Spark has shuffle partitions) the sorted rows are cut by range into files that each stand under the header."""
    ident = F.format_string("%s:%d:%d:%s>%s", "chrom", "start", "end", "ref", "alt")
    info = F.concat(F.lit("END="), q("end").cast("string"))
    line = F.concat_ws("\t", q("chrom"), (q("start") + 1).cast("string"), ident, q("ref"), q("alt"), F.lit("."), F.lit("."), info)
    spark = df.sparkSession
    if shards != 1:
        _write_shards(df.select(q("chrom"), q("start"), line.alias("value")), path, header, mode, shards)
        return
    top = spark.createDataFrame([(0, i, "", 0, h) for i, h in enumerate([*header, NAMES])], "part int, n int, chrom string, start bigint, value string")
    body = df.select(F.lit(1).alias("part"), F.lit(0).alias("n"), q("chrom"), q("start"), line.alias("value"))
    top.union(body).orderBy("part", "n", "chrom", "start", "value").coalesce(1).select("value").write.mode(mode).text(path)


def _write_shards(lines: DataFrame, path: str, header: list[str], mode: str, shards: int | None) -> None:
    top = pa.RecordBatch.from_arrays([pa.array([*header, NAMES])], names=["value"])

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield top
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(2)], names=["value"])

    keys = [q("chrom"), q("start"), q("value")]
    ranged = lines.repartitionByRange(*([shards] if shards else []), *keys).sortWithinPartitions(*keys)
    ranged.mapInArrow(headed, "value string").write.mode(mode).text(path)
