"""What the training-data operators share: scratch space, column handling and word rules.

Scratch tables go to the folder that ``spark.checkpoint.dir`` names, because executors and the
driver see no other common folder. Only in local mode (tests, a laptop) may that setting be missing; a folder under
/tmp/checkpoints is used then.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space between words (fixed by the contract) as a Java regular expression and as characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from the session; one of our own where it is unset in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = "file:///tmp/checkpoints/genoloom"
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def drop_scratch() -> None:
    """Delete this session's scratch tables; results that still read them must be written first."""
    while _made:
        spark, path = _made.pop()
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the JVM may be gone already at exit
            continue


def table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Arrow batches of at most ``rows`` rows for the jobs that run inside; the setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def growing(size: int, each: int, most: int) -> int:
    """How many shares of ``each`` bytes ``size`` bytes are cut into; beyond ``most`` shares their number grows with the
    cube root only and the shares grow too, so that plans stay manageable at any size."""
    n = max(1, -(-size // each))
    return n if n <= most else round(most * (n / most) ** (1 / 3))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array; null and blank text give an empty one."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as the empty string."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def extended(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    """``schema`` without columns that the new fields replace (names compare without case), plus those."""
    new = {name.lower() for name, _ in fields}
    kept = [f for f in schema.fields if f.name.lower() not in new]
    return T.StructType(kept + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])


def batch_with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with further columns, replacing any of the same name (without case)."""
    new = {name.lower() for name in columns}
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n.lower() not in new]
    return pa.RecordBatch.from_arrays(
        [c for _, c in kept] + list(columns.values()), names=[n for n, _ in kept] + list(columns)
    )


def pieces(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Slices of ``batch`` that hold about ``limit`` bytes of ``column`` each, so that one batch of
    very long texts doesn't fill a worker. A single longer value is a slice of its own."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)



_ARROW = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "float": pa.float32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}


def arrow_type(ddl: str) -> pa.DataType:
    return pa.list_(arrow_type(ddl[6:-1])) if ddl.startswith("array<") else _ARROW[ddl]


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a flat DDL string; usable in workers, which have no session to parse it."""
    return pa.schema([(name, arrow_type(kind)) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def row_of(ddl: str, *values) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)
