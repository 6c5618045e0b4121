"""SimHash near-duplicates by deletion-variant signatures.

A scheme cuts fingerprints into segments and indexes each distinct fingerprint under every variant of a segment with one
bit as a wildcard. Equal keys meet by an equality shuffle, and every candidate pair is verified.

``exact_scheme`` (four-word shingles, 64 bits, at most 4 different) loses no link. Of three segments one differs by at most
one bit, which gives 64 keys of 20 bits. With more fingerprints a key has to hold more bits: of m segments, any m - 3 of
which form a key together, some m - 3 differ by at most one bit in all, as 4 bits touch at most 4 segments. m = 5, 6 and 7 give 256,
640 and 1280 keys of about 24, 31 and 35 bits, so the fingerprints that share a key by chance stay few (``exact_scheme``).

``similar_scheme`` proposes pairs of texts whose shingle sets have a Jaccard similarity of ``JACCARD``: so many segments that
such a pair shares no key with a probability of at most ``MISS``, each as wide as the number of fingerprints asks for.
Proposals are near in their first two words; ``shingles`` verifies them on the sets themselves.

A pair is handled under the first key that it shares, where all words are compared; otherwise a bucket gives a star for each
component of its proposals, around the smallest node, so that proposals grow with a group's size and not its square. A bucket of
more than ``SMALL`` fingerprints gives a spanning forest of its links instead of all pairs: links are found by
breadth-first search, and a large bucket of the exact scheme is cut again by wildcards over its other bits. No bucket is capped.

Scale: exact copies are one fingerprint before anything is joined, whatever their number. A bucket holds distinct
fingerprints alone; a group of near copies has only as many as the bits allow around each of them. Components are
found by ``components``, without links on the driver.

Defined results: null, empty and blank texts have fingerprint zero, linked like any other; texts of fewer words than a
shingle are one shingle; a component is named by its smallest doc_id; rows that share a doc_id are one node, so they
share a component; a null doc_id has a fingerprint, no component and links nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, batch_with, documents, extended, pieces, table
from .components import components

SEED = 42
SMALL = 24
#: Fingerprints that share a key by chance, on average, at most (for up to 2 ** 37 of them).
CHANCE = 64
#: Links that a task folds at once.
FOLD = 1 << 20
JACCARD = 0.8
MISS = 0.005


@dataclass(frozen=True)
class Scheme:
    """Words of a fingerprint, segments (word, mask), the distance of a link in the first ``compared`` words."""

    words: int
    segments: tuple[tuple[int, int], ...]
    distance: int
    compared: int

    @property
    def columns(self) -> list[str]:
        return [f"fp{i}" for i in range(self.words)]

    @property
    def keys(self) -> list[tuple[int, int]]:
        """(word, mask) of each key: a segment's mask without one of its bits."""
        return [(w, mask & ~(1 << b)) for w, mask in self.segments for b in range(64) if mask >> b & 1]


def exact_scheme(n: int, distance: int = 4) -> Scheme:
    """The scheme for ``n`` distinct 64-bit fingerprints that finds all links of at most 4 bits."""
    for m in (3, 5, 6, 7):
        edges = [round(64 * i / m) for i in range(m + 1)]
        own = [((1 << b) - 1) & ~((1 << a) - 1) for a, b in zip(edges, edges[1:])]
        masks = [sum(c) for c in combinations(own, max(1, m - 3))]
        if n <= CHANCE << (min(x.bit_count() for x in masks) - 1):
            break
    return Scheme(1, tuple((0, x) for x in masks), distance, 1)


def bit_rate(jaccard: float = JACCARD) -> float:
    """How often a bit of the fingerprints of two sets of this similarity (and like size) differs."""
    return math.acos(2 * jaccard / (1 + jaccard)) / math.pi


def similar_scheme(n: int) -> Scheme:
    """The scheme for ``n`` distinct fingerprints that proposes pairs at ``JACCARD`` but for a share of ``MISS``."""
    p = bit_rate()
    for width in (16, 20, 24, 30):
        if n <= CHANCE << (width - 1):
            break
    found = (1 - p) ** width + width * p * (1 - p) ** (width - 1)
    count = math.ceil(math.log(MISS) / math.log(1 - found))
    each = 64 // width
    segments = tuple((i // each, ((1 << width) - 1) << (width * (i % each))) for i in range(count))
    # near: within 3.5 standard deviations of what such pairs differ by in two words; other pairs differ by 64 or so
    return Scheme(-(-count // each), segments, math.floor(128 * p + 3.5 * math.sqrt(128 * p * (1 - p))), 2)


EXACT = exact_scheme(1)


def mixed(h: np.ndarray, word: int) -> np.ndarray:
    """Hashes for a further fingerprint word, derived from the first word's."""
    if word == 0:
        return h
    x = h + np.uint64(word * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority(hashes: np.ndarray, words: int = 1) -> tuple[int, ...]:
    """The bits that are set in over half the hashes, as unsigned 64-bit words; further words have hashes of their own."""
    n, out = len(hashes), []
    for word in range(words):
        bits = np.zeros(64, np.int64)
        for at in range(0, n, 1 << 16):  # a very long text is never one matrix
            part = mixed(hashes[at : at + (1 << 16)], word).astype("<u8").view(np.uint8).reshape(-1, 8)
            bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * bits > n).tobytes(), "little"))
    return tuple(out)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Hashes of a text's word shingles, repeats included; a shorter text is one shingle, a blank one none."""
    from xxhash import xxh64_intdigest

    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    data = b" ".join(found)
    n = max(1, len(found) - size + 1)
    if n == 1:
        return np.array([xxh64_intdigest(data, SEED)], np.uint64)
    starts = list(accumulate((len(w) + 1 for w in found), initial=0))
    spans = zip(starts[:n], starts[size:])
    return np.fromiter((xxh64_intdigest(data[a : b - 1], SEED) for a, b in spans), np.uint64, n)


def fingerprint(text: str | None) -> int:
    """SimHash of a text's four-word shingles."""
    return majority(shingle_hashes(text, 4))[0]


def add_fingerprint(df: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as the signed 64-bit column fp0."""
    schema = extended(df.drop(text).schema if drop_text else df.schema, ("fp0", "bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, text):
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                fps = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
                yield batch_with(batch.drop_columns([text]) if drop_text else batch, fp0=pa.array(fps))

    return df.mapInArrow(run, schema)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distance(x: np.ndarray) -> np.ndarray:
    """Different bits of fingerprints, from their xor (rows, words)."""
    return np.bitwise_count(x).sum(axis=-1)


def first_key(x: np.ndarray, scheme: Scheme) -> np.ndarray:
    """The number of the first key that two fingerprints with xor ``x`` (rows, words) share, -1 for none."""
    out = np.full(len(x), -1, np.int64)
    at = 0
    for word, mask in scheme.segments:
        part = x[:, word] & np.uint64(mask)
        ones = np.bitwise_count(part)
        lower = ((part - np.uint64(1)) & ~part) & np.uint64(mask)  # the segment's bits below the lowest that is set
        here = np.where(ones == 0, at, np.where(ones == 1, at + np.bitwise_count(lower).astype(np.int64), -1))
        out = np.where(out < 0, here, out)
        at += mask.bit_count()
    return out


def forest(fps: np.ndarray, scheme: Scheme = EXACT, free: int = 64) -> list[tuple[int, int]]:
    """Index pairs that connect whatever is linked among distinct fingerprints (rows, words).

    By breadth-first search: each found node is compared with those not found yet. More than 4096 of the exact scheme
    are cut by deletion variants over all bits first, as often as bits remain."""
    n = len(fps)
    if n > 4096 and scheme.words == 1 and free > 30:
        edges = []
        only = fps[:, 0]
        varying = [b for b in range(64) if len(np.unique(only >> np.uint64(b) & np.uint64(1))) > 1]
        thirds = [varying[i::3] for i in range(3)]
        for third in thirds:
            for skip in third:
                keys = only & np.uint64(sum(1 << b for b in third if b != skip))
                order = np.argsort(keys, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
                    if len(part) == n:
                        return search(fps, scheme)
                    if len(part) > 1:
                        edges += [(int(part[i]), int(part[j])) for i, j in forest(fps[part], scheme, free - len(third) + 1)]
        return edges
    return search(fps, scheme)


def search(fps: np.ndarray, scheme: Scheme = EXACT) -> list[tuple[int, int]]:
    edges, rest = [], np.arange(len(fps))
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = distance(fps[rest] ^ fps[node]) <= scheme.distance
            if near.any():
                found = rest[near].tolist()
                edges += [(node, x) for x in found]
                queue += found
                rest = rest[~near]
    return edges


LINKS = "a bigint, b bigint"


def links(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """(a, b): links that connect all nodes (fp0, ..., node) within distance, from distinct fingerprints."""
    keys = F.array(*[F.struct(F.lit(w).cast("tinyint").alias("word"), F.lit(signed(m)).alias("mask")) for w, m in scheme.keys])
    each = nodes.select(*scheme.columns, "node", F.posexplode(keys).alias("w", "k"))
    word = F.element_at(F.array(*scheme.columns), F.col("k.word") + 1)
    shown = scheme.columns[: scheme.compared]
    keyed = each.select(F.col("w").cast("smallint").alias("w"), *shown, "node", word.bitwiseAND(F.col("k.mask")).alias("v"))
    dealt = keyed.repartition("w", "v").sortWithinPartitions("w", "v", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the last bucket's rows may go on in the next batch
        schema = arrow_schema(LINKS)

        def flush() -> pa.RecordBatch:
            whole = np.concatenate(held, axis=1)
            held.clear()
            return pa.RecordBatch.from_arrays(_bucket_links(whole, scheme), schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            if held and held[-1][[0, -1], -1].tolist() != rows[[0, -1], 0].tolist():
                yield flush()
            last = (rows[0] == rows[0, -1]) & (rows[-1] == rows[-1, -1])
            first = 0 if last.all() else int(len(last) - np.argmin(last[::-1]))
            if first:
                held.append(rows[:, :first])
                yield flush()
            held.append(rows[:, first:])
        if held:
            yield flush()

    return dealt.mapInArrow(run, LINKS)


def stars(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, the smallest of its component) that connect what the links (i, j) connect: one for each x, not for each pair."""
    names, ends = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j, label = ends[: len(i)], ends[len(i) :], np.arange(len(names))
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        if (new == label).all():
            break
        label = new[new]
    other = np.flatnonzero(label != np.arange(len(names)))
    return names[other], names[label[other]]


def folded(edges: DataFrame) -> DataFrame:
    """Links (a, b) that connect what ``edges`` (a, b) connect: of every ``FOLD`` links that a task meets, those that join
    anything. Links of one group from many buckets become one for each node, around the same smallest node in most tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(LINKS)
        held: list[np.ndarray] = []

        def fold() -> pa.RecordBatch:
            ends = stars(*np.concatenate(held, axis=1))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], schema=schema)

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            if sum(h.shape[1] for h in held) >= FOLD:
                yield fold()
        if held:
            yield fold()

    return edges.mapInArrow(run, LINKS)


def _bucket_links(rows: np.ndarray, scheme: Scheme) -> list[pa.Array]:
    """Links of whole buckets, which stand one after the other; rows are key, fingerprint words, node, value."""
    w, node, v = rows[0], rows[-2], rows[-1]
    fps = np.ascontiguousarray(rows[1 : 1 + scheme.compared].T).view(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])]))
    sizes = np.diff(np.append(starts, len(w)))
    size = np.repeat(sizes, sizes)
    place = np.arange(len(w)) - np.repeat(starts, sizes)
    a, b = [], []
    one_key = scheme.compared == scheme.words  # a pair is linked under the first key that it shares
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for d in range(1, min(SMALL, int(sizes.max(initial=1)))):
        i = np.flatnonzero((size <= SMALL) & (place + d < size))
        x = fps[i] ^ fps[i + d]
        near = distance(x) <= scheme.distance
        i, x = i[near], x[near]
        if one_key:
            i = i[first_key(x, scheme) == w[i]]
            a.append(node[i])
            b.append(node[i + d])
        else:
            ends.append((i, i + d))
    if ends:
        linked, first = stars(*map(np.concatenate, zip(*ends)))
        a.append(node[linked])
        b.append(node[first])
    for s in np.flatnonzero(sizes > SMALL):
        at = starts[s]
        pairs = forest(fps[at : at + sizes[s]], scheme)
        if pairs:
            i, j = np.array(pairs).T
            a.append(node[at + i])
            b.append(node[at + j])
    none = np.zeros(0, np.int64)
    return [pa.array(np.concatenate([none, *x]), pa.int64()) for x in (a, b)]


def classes(fps: DataFrame, key: str = "doc_id") -> DataFrame:
    """(fp0, component_id) for each distinct fingerprint of rows (key, fp0) with a key."""
    keyed = fps.where(F.col(key).isNotNull())
    nodes = table(keyed.groupBy("fp0").agg(F.min(key).cast("bigint").alias("node")), "nodes")
    found = links(nodes, exact_scheme(nodes.count()))
    # Rows that share a doc_id are one node: a fingerprint's smallest id stands for it, and its others link to it
    # where they stand under several fingerprints.
    shared = keyed.groupBy(key).agg(F.min("fp0").alias("x"), F.max("fp0").alias("y")).where("x <> y").select(key)
    more = keyed.join(shared, key, "left_semi").join(nodes, "fp0").select(F.col(key).cast("bigint").alias("a"), F.col("node").alias("b"))
    labels = components(found.union(more))
    joined = nodes.join(labels, "node", "left")
    return joined.select("fp0", F.coalesce("label", "node").alias("component_id"))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    fps = table(add_fingerprint(rows, drop_text=True), "fps")
    joined = fps.join(classes(fps), "fp0", "left")
    named = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select("doc_id", hex_of(F.col("fp0")).alias("fingerprint"), named.alias("component_id"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
