"""Variant records: contigs, alleles, splitting, left alignment and keys."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..schemas import q
from .lookups import replace_by, small


def split_alleles(df: DataFrame, alt: str = "alt") -> DataFrame:
    """One row for each comma-separated alternative allele, with its 1-based number ``allele``."""
    rest = [q(c) for c in df.columns if c != alt]
    return df.select(*rest, F.posexplode(F.split(q(alt), ",")).alias("allele", alt)).withColumn("allele", F.col("allele") + 1).select(*map(q, df.columns), "allele")


def valid_alleles(df: DataFrame) -> DataFrame:
    """Rows whose alleles hold bases only: symbolic and spanning alleles go."""
    return df.where(s.only_bases(q("ref")) & s.only_bases(q("alt")))


def on_contigs(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rows whose 1-based ``pos`` lies on a contig of the FASTA index (contig, start, end)."""
    c = small(contigs.select(q("contig").alias("_contig"), q("end").alias("_end")))
    return df.join(c, (q("chrom") == F.col("_contig")) & (q("pos") <= F.col("_end")), "left_semi")


def in_region(df: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """Rows that lie within [start, end) of a chromosome: plain comparisons, which reach the Parquet scan. Regions side by
    side leave out what spans their border; use ``range_join`` to assign every row."""
    return df.where((q("chrom") == chrom) & (q("start") >= start) & (q("end") <= end))


def with_keys(df: DataFrame, info_end: str | None = None) -> DataFrame:
    """``start`` (0-based) and ``end`` from 1-based ``pos`` and ``ref``; an END value given in INFO wins."""
    end = q("pos") - 1 + F.length(q("ref"))
    if info_end is not None:
        end = F.coalesce(q(info_end).cast("bigint"), end)
    return df.withColumns({"start": q("pos").cast("bigint") - 1, "end": end.cast("bigint")})


def with_tags(df: DataFrame, info_end: str = "info_END", info_type: str = "info_TYPE") -> DataFrame:
    """The tags END and TYPE filled in from position and alleles where the file doesn't give them."""
    end = q("pos").cast("bigint") - 1 + F.length(q("ref"))
    fill = {info_end: end, info_type: s.variant_type(q("ref"), q("alt"))}
    return df.withColumns({c: F.coalesce(q(c), v) if c in df.columns else v for c, v in fill.items()})


def rename_contigs(df: DataFrame, aliases: DataFrame) -> DataFrame:
    return replace_by(df, "chrom", aliases, "alias", "chrom")


def join_scores(variants: DataFrame, scores: DataFrame, keys: list[str], ordered: bool = False) -> DataFrame:
    """All variants with their scores where there are any; sorted only on request."""
    out = variants.join(scores, keys, "left")
    return out.orderBy(*[F.asc_nulls_first(c) for c in [*keys, "gene", "tissue"] if c in out.columns]) if ordered else out


def shift_left(pos: int, ref: str, alt: str, bases: str, first: int) -> tuple[int, str, str]:
    """An indel moved as far left as its sequence allows and trimmed. ``bases`` is the reference from 1-based ``first``."""
    while True:
        if ref and alt and ref[-1] == alt[-1] and (len(ref) > 1 or len(alt) > 1):
            ref, alt = ref[:-1], alt[:-1]
        elif (not ref or not alt) and pos - 1 >= first:
            pos -= 1
            ref, alt = bases[pos - first] + ref, bases[pos - first] + alt
        else:
            break
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def left_align(df: DataFrame, chunks: DataFrame) -> DataFrame:
    """Indels moved left against the reference; other rows unchanged.

    ``chunks`` (contig, chunk, first, bases) cuts contigs into pieces, each with the bases of the piece before it, so a
    row meets one chunk by an equality join and can move at least one whole piece. Rows without reference stay. Only
    indels are joined and moved; all other rows pass by.
    """
    width = chunks.agg(F.max(F.length("bases"))).first()[0] or 1
    piece = F.floor((q("pos") - 1) / F.lit(max(1, (width + 1) // 2))).cast("bigint")
    indel = F.coalesce((F.length("ref") != F.length("alt")) & s.only_bases(q("ref")) & s.only_bases(q("alt")), F.lit(False))
    rows = df.where(indel).withColumn("_piece", piece)
    c = chunks.select(q("contig").alias("_contig"), q("chunk").alias("_chunk"), q("first").alias("_first"), q("bases").alias("_bases"))
    joined = rows.join(c, (q("chrom") == F.col("_contig")) & (F.col("_piece") == F.col("_chunk")), "left").drop("_contig", "_chunk", "_piece")
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("pos", "ref", "alt", "_first", "_bases")}
            moved = [
                shift_left(p, r, a, b, f) if b is not None and 0 <= p - f < len(b) else (p, r, a)
                for p, r, a, f, b in zip(get["pos"], get["ref"], get["alt"], get["_first"], get["_bases"])
            ]
            new = dict(zip(("pos", "ref", "alt"), zip(*moved))) if moved else {"pos": [], "ref": [], "alt": []}
            columns = [pa.array(new[n], batch.schema.field(n).type) if n in new else batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.where(~indel).unionAll(joined.mapInArrow(run, df.schema))


def first_of(df: DataFrame, column: str):
    """Some value of a column, null if there is none: one row read."""
    row = df.select(q(column)).where(q(column).isNotNull()).first()
    return row[0] if row else None


def numbered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Duplicate records numbered within their key from 1."""
    return df.withColumn("copy", F.row_number().over(Window.partitionBy(*map(q, keys)).orderBy(*map(q, df.columns))))
