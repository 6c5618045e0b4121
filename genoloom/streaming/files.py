"""Variant files as a stream: the same stateless transforms over files as they arrive. An addition, not part of
the batch semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.variants import split_alleles, valid_alleles, with_keys
from ..sources.genome import VCF_COLUMNS, info_value
from pyspark.sql import functions as F


def stream_variants(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Valid alleles with keys from VCF text files that arrive in a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    cells = F.split(F.col("value"), "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.length("value") > 0))
    rows = rows.select(*[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(VCF_COLUMNS)])
    rows = rows.withColumns({"pos": F.col("pos").cast("bigint"), "info_END": info_value(F.col("info"), "END")})
    return valid_alleles(with_keys(split_alleles(rows), "info_END")).select("chrom", "start", "end", "ref", "alt")


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet; each file is processed once."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
