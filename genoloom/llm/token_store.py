"""Token-id shards with a minimal perfect hash index.

Format, one folder written by Spark's committer (a lost executor leaves no torn shard):

* ``meta``: one row (n_buckets, dtype, end_id).
* ``payload``: rows (shard, chunk, base, before, keys, lens, ids). Documents stand in ascending key
  order over all shards; ``ids`` are raw little-endian 16- or 32-bit token ids of whole documents,
  about ``CHUNK_IDS`` of them a chunk. ``keys`` and ``lens`` are raw 64-bit integers, ``base`` and
  ``before`` count the documents and ids of the shard that stand before the chunk.
* ``index``: one row a bucket of keys (hash of the key modulo n_buckets): a minimal perfect hash over
  its distinct keys and per slot a 32-bit fingerprint and the places (shard, position, repeats).

The perfect hash is a cascade of bit arrays: at each level a key owns its bit if no other key hashes
there; the others go to the next level. The rank of the owned bit is the slot, so n keys take slots
0..n-1 and a lookup reads a few words, a fingerprint and one slot, whatever the size of the store.

Scale: one range shuffle of the texts by key, ties broken by a hash of the text and a row number so that neither one
repeated key nor one repeated row fills a task; shards follow the corpus's size up to ``SHARDS`` of them and its cube root
beyond, chunks and buckets hold a bounded share each; the index is built
and read bucket by bucket and never gathered; reading moves some 40 bytes a document, no payload.

Defined results: null text is empty; an empty document is the end id alone; a null key sorts first
and is reached by reading, not by lookup; rows that repeat a key are all stored, next to each other,
and a lookup returns all of them; columns other than key and text are not stored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, documents, growing, row_of, scratch, small_batches, table

END_ID = 2
CHUNK_IDS = 1 << 16
#: Bytes of text a shard, for up to ``SHARDS`` shards; larger stores have larger shards, their chunks stay as they are.
SHARD_BYTES = 16 << 20
SHARDS = 4096
WORD_CACHE = 350_000
BUCKET_KEYS = 50_000
GAMMA = 1.6
NULL_KEY = -(1 << 63)


# --- encoding -------------------------------------------------------------------------------


#: A cut is safe between a letter or digit and an ASCII mark after it: the splitter parts them in any
#: case. Only the apostrophe, which starts contractions, is left out.
CUT = re.compile(r"([!-&(-/:-@\[-`{-~])(?<=[^\W_].)")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others, in order, for
    the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordCache(dict):
    """Ids of short units of text as bytes. The tokenizer lower-cases letter by letter and its splitter
    treats spaces and the cuts above as hard boundaries, so a text's ids are its units' ids in a row.

    A unit of Latin letters is one word for the merge model and goes to it directly; any other goes
    through the whole tokenizer. Used by one worker process for all its tasks."""

    made: dict[tuple[str, str], WordCache] = {}

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.letters = Tokenizer.from_file(path), dtype, byte_letters()
        self.code = {"<u2": "H", "<u4": "I"}[dtype]
        probe = ["naïve", "straße", "a"]
        whole = [e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False)]
        self.direct = [self.merged(w) for w in probe] == [np.array(x, dtype).tobytes() for x in whole]

    @classmethod
    def of(cls, path: str, dtype: str) -> WordCache:
        if (path, dtype) not in cls.made:
            cls.made[path, dtype] = cls(path, dtype)
        return cls.made[path, dtype]

    def merged(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def __missing__(self, unit: str) -> bytes:
        if self.direct and unit.isalpha() and max(unit) <= "\u00ff" and unit.islower():
            out = self.merged(unit)
        else:
            out = np.array(self.tokenizer.encode(unit, add_special_tokens=False).ids, self.dtype).tobytes()
        if len(unit) <= 40:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[unit] = out
        return out

    def text(self, text: str) -> bytes:
        """Ids of a whole text."""
        # Lower case first makes more units alike. It must not undo a special token's spelling, follow the
        # final-sigma rule or make letters that normalisation would then compose; such a text is cut at spaces.
        low = text.lower()
        if "<|" not in text and "\u03a3" not in text and unicodedata.is_normalized("NFC", low):
            text = CUT.sub(r" \1", low)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def id_type(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


# --- minimal perfect hash -------------------------------------------------------------------


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over keys and a seed; wraps on purpose."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x2545F491) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys, with a 32-bit fingerprint for each slot."""

    def __init__(self, sizes: list[int], bits: np.ndarray, prints: np.ndarray):
        self.sizes, self.bits, self.prints = sizes, bits, prints
        words = np.unpackbits(bits.reshape(-1, 8), axis=1).sum(axis=1) if len(bits) else np.zeros(0)
        self.ranks = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, rest = [], [], keys
        while len(rest):
            size = -(-int(len(rest) * GAMMA + 1) // 64) * 64
            at = (mix(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
            owned = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(owned))
            rest = rest[~owned[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, np.uint8)
        out = cls(sizes, bits, np.zeros(len(keys), np.uint32))
        out.prints[out.slots(keys)] = cls.fingerprint(keys)
        return out

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (mix(keys, 0xF1) >> np.uint64(32)).astype(np.uint32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level holds it."""
        out = np.full(len(keys), -1, np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + (mix(keys[todo], level) % np.uint64(size)).astype(np.int64)
            hit = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            for_hit = at[hit]
            word = for_hit >> 6
            before = self.ranks[word]
            # bits of the same 64-bit word that stand before this one
            block = np.unpackbits(self.bits.reshape(-1, 8)[word], axis=1)
            inside = (np.arange(64) < (for_hit & 63)[:, None]) & (block == 1)
            out[todo[hit]] = before + inside.sum(axis=1)
            todo, base = todo[~hit], base + size
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where the fingerprint says that it isn't one of the set."""
        slots = self.slots(keys)
        ok = slots >= 0
        ok[ok] = self.prints[slots[ok]] == self.fingerprint(keys[ok])
        return np.where(ok, slots, -1)


# --- writing --------------------------------------------------------------------------------

META = "n_buckets bigint, dtype string, end_id int"
PAYLOAD = "shard int, chunk int, base bigint, before bigint, keys binary, lens binary, ids binary"
INDEX = (
    "bucket bigint, sizes array<bigint>, bits binary, prints binary, firsts binary, shards binary, "
    "positions binary, repeats binary"
)
PLACES = "key bigint, shard int, position bigint, repeats bigint"


def bucket(key: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets))


def write_store(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> None:
    """Encode all texts with the tokenizer file and write meta, payload and index under ``path``."""
    spark, dtype = docs.sparkSession, id_type(tokenizer)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    shards = max(growing(size, SHARD_BYTES, SHARDS), min(spark.sparkContext.defaultParallelism, size >> 20), 1)
    n_buckets = -(-n // BUCKET_KEYS) or 1
    spark.createDataFrame([(n_buckets, dtype, end_id)], META).coalesce(1).write.parquet(f"{path}/meta")
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.col("row")]
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(int(shards), *order).sortWithinPartitions(*order).drop("row")
    with small_batches(spark):
        # ids don't repeat as whole values: no dictionary, and small row groups to keep writers' buffers small
        writer = ranged.mapInArrow(_encoder(tokenizer, dtype, end_id), PAYLOAD).write
        writer.options(**{"parquet.enable.dictionary": "false", "parquet.block.size": str(8 << 20)}).parquet(f"{path}/payload")
    places = spark.read.schema(PAYLOAD).parquet(f"{path}/payload").select("shard", "base", "keys")
    keyed = places.mapInArrow(_places, PLACES).withColumn("bucket", bucket(F.col("key"), n_buckets))
    keyed.groupBy("bucket").applyInArrow(_index, INDEX).write.parquet(f"{path}/index")


def _encoder(tokenizer: str, dtype: str, end_id: int):
    end = np.array([end_id], dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache, shard = WordCache.of(tokenizer, dtype), TaskContext.get().partitionId()
        chunk = base = before = held = 0
        keys, lens, ids = [], [], []

        def row() -> pa.RecordBatch:
            raw = (np.array(keys, "<i8").tobytes(), np.array(lens, "<i8").tobytes(), b"".join(ids))
            return row_of(PAYLOAD, shard, chunk, base, before, *raw)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for k, text in zip(*(c.to_pylist() for c in part.columns)):
                    keys.append(NULL_KEY if k is None else k)
                    ids.append(cache.text(text) + end)
                    lens.append(len(ids[-1]) // len(end))
                    held += lens[-1]
                    if held >= CHUNK_IDS:
                        yield row()
                        chunk, base, before, held = chunk + 1, base + len(keys), before + held, 0
                        keys, lens, ids = [], [], []
        if keys:
            yield row()

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each run of equal keys of a chunk stands."""
    for batch in batches:
        for shard, base, raw in zip(*(c.to_pylist() for c in batch.columns)):
            keys = np.frombuffer(raw, "<i8")
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            repeats = np.diff(np.concatenate([first, [len(keys)]]))
            real = keys[first] != NULL_KEY
            first, repeats = first[real], repeats[real]
            columns = keys[first], np.full(len(first), shard, np.int32), base + first, repeats
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "shard", "position", "repeats"])


def _index(places: pa.Table) -> pa.Table:
    """One index row from the places of a bucket's keys."""
    places = places.sort_by([("key", "ascending"), ("shard", "ascending"), ("position", "ascending")])
    keys, shard, position, repeats, bucket_ = (c.to_numpy() for c in places.columns)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    table = PerfectHash.build(keys[first])
    slots = table.slots(keys[first])
    firsts = np.empty((len(first), 2), np.int64)
    firsts[slots, 0], firsts[slots, 1] = first, np.append(first[1:], len(keys))
    raw = (x.tobytes() for x in (table.bits, table.prints, firsts, shard, position, repeats))
    return pa.Table.from_batches([row_of(INDEX, int(bucket_[0]), table.sizes, *raw)])


# --- reading --------------------------------------------------------------------------------


def meta(spark: SparkSession, path: str) -> tuple[int, str, int]:
    return tuple(spark.read.schema(META).parquet(f"{path}/meta").first())


def locate(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keyed access: places (key, shard, position) of every stored row of each distinct non-null key."""
    n_buckets = meta(spark, path)[0]
    wanted = keys.select(F.col(key).cast("bigint").alias("key")).where("key is not null").distinct()
    wanted = wanted.withColumn("bucket", bucket(F.col("key"), n_buckets))
    index = spark.read.schema(INDEX).parquet(f"{path}/index")

    def find(asked: pa.Table, rows: pa.Table) -> pa.Table:
        out = arrow_schema(PLACES)
        if not asked.num_rows or not rows.num_rows:
            return out.empty_table()
        row = rows.to_pylist()[0]
        raw = lambda name, kind: np.frombuffer(row[name], kind)
        table = PerfectHash(row["sizes"], raw("bits", np.uint8), raw("prints", np.uint32))
        ks = asked.column("key").to_numpy()
        slots = table.find(ks)
        ks, slots = ks[slots >= 0], slots[slots >= 0]
        spans = raw("firsts", np.int64).reshape(-1, 2)[slots]
        n = spans[:, 1] - spans[:, 0]
        at = np.repeat(spans[:, 1] - np.cumsum(n), n) + np.arange(n.sum())
        places = (raw("shards", np.int32)[at], raw("positions", np.int64)[at], raw("repeats", np.int64)[at])
        return pa.table([np.repeat(ks, n), *places], schema=out)

    found = wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, PLACES)
    each = F.explode(F.sequence("position", F.col("position") + F.col("repeats") - 1))
    return found.select("key", "shard", each.alias("position"))


STORED = "key bigint, shard int, position bigint, within bigint, n_tokens bigint, ids_crc32 bigint"


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Every stored document in its place, with the crc32 of its ids as 32-bit integers."""
    dtype = meta(spark, path)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, _, base, before, keys, lens, ids = (c[i].as_py() for c in batch.columns)
                keys, lens = np.frombuffer(keys, "<i8"), np.frombuffer(lens, "<i8")
                ids = memoryview(np.frombuffer(ids, dtype).astype("<u4").view(np.uint8))
                ends = np.cumsum(lens)
                crcs = [zlib.crc32(ids[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), lens.tolist())]
                columns = (
                    pa.array(keys, mask=keys == NULL_KEY),
                    pa.array(np.full(len(keys), shard, np.int32)),
                    pa.array(base + np.arange(len(keys))),
                    pa.array(before + ends - lens),
                    pa.array(lens),
                    pa.array(crcs, pa.int64()),
                )
                names = arrow_schema(STORED).names
                yield pa.RecordBatch.from_arrays(list(columns), names=names)

    return spark.read.schema(PAYLOAD).parquet(f"{path}/payload").mapInArrow(run, STORED)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, start): ids in all shards before it. The window runs over one row of two numbers a
    shard, not over documents."""
    heads = spark.read.schema(PAYLOAD).parquet(f"{path}/payload").select("shard", F.col("lens"), "before")
    last = heads.mapInArrow(_totals, "shard int, n_ids bigint").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return last.select("shard", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).alias("start"))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [int(np.frombuffer(x.as_py(), "<i8").sum()) for x in batch.column("lens")]
        yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(n, pa.int64())], names=["shard", "n_ids"])


def read_store(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of all stored rows of ``keys``: each non-null key goes through
    the index to its places, and what the payload holds there is returned; null keys by reading."""
    with small_batches(spark, 32):  # rows of 0.1 MB and more each
        stored = table(scan(spark, path), "stored")
    placed = locate(spark, path, keys, key).join(stored.drop("key"), ["shard", "position"])
    rows = placed.unionByName(stored.where("key is null"))
    out = rows.join(starts(spark, path), "shard")
    return out.select(F.col("key").alias(key), (F.col("start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ids) of all stored rows of the non-null ``keys``, ids as an array. Asked places are grouped
    by chunk, so the payload is joined chunk by chunk."""
    dtype = meta(spark, path)[1]
    payload = spark.read.schema(PAYLOAD).parquet(f"{path}/payload")
    heads = payload.select("shard", "chunk", "base", F.lead("base").over(Window.partitionBy("shard").orderBy("chunk")).alias("to"))
    at = (F.col("position") >= F.col("base")) & (F.col("to").isNull() | (F.col("position") < F.col("to")))
    asked = locate(spark, path, keys, key).join(heads, "shard").where(at)
    asked = asked.groupBy("shard", "chunk").agg(F.collect_list(F.struct("key", "position")).alias("asked"))
    rows = payload.join(asked, ["shard", "chunk"]).select("base", "lens", "ids", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, lens, ids, places in zip(*(c.to_pylist() for c in batch.columns)):
                ends, ids = np.cumsum(np.frombuffer(lens, "<i8")), np.frombuffer(ids, dtype)
                at = [p["position"] - base for p in places]
                cut = [ids[ends[i - 1] if i else 0 : ends[i]].astype(np.int32) for i in at]
                out = pa.array([p["key"] for p in places], pa.int64()), pa.array(cut, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(out), names=["key", "ids"])

    return rows.mapInArrow(run, "key bigint, ids array<int>").withColumnRenamed("key", key)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-store")
    write_store(documents(spark, sf_dir, "doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_store(spark, path, documents(spark, sf_dir, "doc_id"))
