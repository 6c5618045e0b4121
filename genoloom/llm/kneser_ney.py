"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, kept as sorted hash arrays in the shared folder
and memory-mapped by the workers that score.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased and one end token a text; start marks stand before the first.
Words are 56-bit hashes, 48 bits in the place before the last two. Counting, for order 3 (order 2 leaves out what concerns trigrams):

1. every ``SAMPLE``-th text tells which words are so frequent that one part can't hold all that stands around them. This
   decides where n-grams are kept, never what is counted; the list has at most ``2 * parts`` words;
2. each task counts its trigrams and deals them to parts by their middle word, or by the last two words if the middle one is
   frequent. A shipped row carries its distinct words once; trigrams are places in those lists, with runs of equal contexts;
3. parts sum them and thus hold all words that stand before a pair: they write files of trigrams with their counts, of
   bigrams with the number of different words before them (after a start mark: their count, as nothing else can stand
   before), and of contexts with sums of what the model needs (total, numbers of counts 1, 2 and 3 or more). They pass on
   such sums by word, with continuations, and by contexts that end in a frequent word;
4. word parts sum those and write files of words and of these contexts.

Only part totals (a row a part) reach the driver, for the discounts. Scoring looks words, pairs and trigrams up in the
mapped files, a block of tokens at a time; no token is shuffled. Everything counted covers all training texts; file
sizes follow the corpus; the number of parts follows its bytes up to ``PARTS`` and their cube root beyond. A word that is a third
of all tokens is spread over all parts. A worker opens the files that a block's words ask for, ``OPEN_FILES`` at once at most.

A file keeps of each hash the bits that choose a bucket of about 32 and 32 bits more, so an n-gram that was never seen is
taken for a seen one with a probability of about 1 in 130 million, at any size.
Part files are written under a temporary name and renamed, so repeated tasks are harmless. The shared folder must be a
path that workers can open (``file:`` or mounted); another store raises an error.

Defined results: null text is empty: one end token; nothing to learn from: every token has probability 1 in both
models; copies score alike; columns of the input beside key and text aren't carried.
"""

from __future__ import annotations

import os
import pickle
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, crc_mod, documents, growing, pieces, row_of, scratch, small_batches

ORDER = 3
#: Bytes of text a part, for up to ``PARTS`` parts; larger corpora have larger parts. Words, which are far fewer than
#: n-grams, have parts of their own, at most ``WORD_PARTS``, and contexts that end in a frequent word have ``PARTS`` at most.
PART_BYTES = 28 << 20
PARTS = 1 << 14
WORD_PARTS = 1 << 10
SAMPLE = 32
#: Files that a worker keeps mapped at once.
OPEN_FILES = 4096
#: Tokens scored and counted at once.
BLOCK = 1 << 19
HELD = 1 << 22
WORD_CACHE = 200_000
ALPHA = 0.1
LEAST_DISCOUNT = 0.05


class Hashes(dict):
    """56-bit hashes of words in the upper bits of 64, short ones remembered; one a worker process."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        out = xxh64_intdigest(word, 9) & ~0xFF
        if len(word) <= 40:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = out
        return out


HASHES = Hashes()
#: No word is empty or a space, so these two are free.
END, START = b"", b" "


def token_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's words and the end token."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def blocks(texts: Iterator[str | None], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, sizes of texts) for runs of whole texts of about ``most`` tokens."""
    held, n = [], 0
    for text in texts:
        held.append(token_hashes(text))
        n += len(held[-1])
        if n >= most:
            yield np.concatenate(held), np.array([len(t) for t in held])
            held, n = [], 0
    if held:
        yield np.concatenate(held), np.array([len(t) for t in held])


def before(values: np.ndarray, sizes: np.ndarray, start: int) -> np.ndarray:
    """Of each token the value of the token before it; of a text's first one, ``start``."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[np.cumsum(sizes) - sizes] = start
    return out


def numbered(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct words with the start mark, the place of each token's word and that of the start mark."""
    unique, places = np.unique(np.append(words, np.uint64(HASHES[START])), return_inverse=True)
    return unique, places[:-1], int(places[-1])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joint_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


#: Of the first word of a pair, 48 bits tell it from others that stand before the same second word.
OUTER = np.uint64(~0xFFFF & (1 << 64) - 1)


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return joint_hash(left & OUTER, right)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    narrow = np.uint16 if parts <= 1 << 16 else np.uint32  # stable sorts of 16 bits are counting sorts
    return (mix(hashes + np.uint64(77)) % np.uint64(parts)).astype(narrow)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Places where sorted rows differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def grouped(columns: list[np.ndarray], n: int, sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of ``columns`` of numbers under ``n``, ascending, and their sums."""
    bits = max(1, (n - 1).bit_length())
    if bits * len(columns) <= 64:
        key = columns[0].astype(np.uint64)
        for c in columns[1:]:
            key = key << np.uint64(bits) | c.astype(np.uint64)
        order = np.argsort(key)
        first = changes(key[order])
    else:
        order = np.lexsort(columns[::-1])
        first = changes(*(c[order] for c in columns))
    at = order[first]
    return [c[at] for c in columns], [np.add.reduceat(s[order], first) if len(first) else s for s in sums]


def counted(columns: list[np.ndarray], n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``columns`` of numbers under ``n``, ascending, and how often each occurs."""
    bits = max(1, (n - 1).bit_length())
    if bits * len(columns) > 64:
        rows, (c,) = grouped(columns, n, [np.ones(len(columns[0]), np.int64)])
        return rows, c
    key = columns[0].astype(np.uint64)
    for c in columns[1:]:
        key = key << np.uint64(bits) | c.astype(np.uint64)
    key.sort()
    first = changes(key)
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    mask = np.uint64((1 << bits) - 1)
    return [(key >> np.uint64(bits * k) & mask).astype(np.int64) for k in reversed(range(len(columns)))], times


def narrow(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


CODED = "part bigint, data binary"
TOTALS = "part bigint, kind int, words bigint, tokens bigint, c1 bigint, c2 bigint, c3 bigint, c4 bigint, more bigint"
#: Rows under this part are numbers of counts 1 to 4 on their way to the driver.
EXACT = -1


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers, each in the narrowest type, byte planes apart, compressed."""
    own = [narrow(a) for a in arrays]
    raw = pickle.dumps([(a.dtype.str, a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) for a in own], 5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    out = []
    for kind, planes in pickle.loads(raw):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel())
    return out


def steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=np.uint64(0))


def shares(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that occurs and the places of its rows, in their order."""
    order = np.argsort(part, kind="stable")
    asked, first = np.unique(part[order], return_index=True)
    for p, a, b in zip(asked.tolist(), first, np.append(first[1:], len(order))):
        yield p, order[a:b]


def listed(places: np.ndarray, size: int, scrap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``places`` (numbers under ``size``), ascending, and each one's place among them."""
    if size > 16 * len(places):
        return np.unique(places, return_inverse=True)
    used = np.zeros(size, bool)
    used[places] = True
    used = np.flatnonzero(used)
    scrap[used] = np.arange(len(used))
    return used, scrap[places]


def dealt(part: np.ndarray, words: np.ndarray, columns: list[np.ndarray], times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row a part: for each of its sorted ``columns`` the distinct words, places among them and lengths of runs; counts."""
    scrap = np.zeros(len(words), np.int64)
    for p, at in shares(part):
        own = [c[at] for c in columns]
        data = []
        for k, c in enumerate(own):
            head = changes(*own[: k + 1])
            used, places = listed(c[head], len(words), scrap)
            listing = words[used] & OUTER if k < len(own) - 2 else words[used]  # the outermost word matters only in pairs
            data += [steps(listing), places if k else places[:0], np.diff(np.append(head, len(at)))]
        yield row_of(CODED, p, packed(*data, times[at]))


def gathered(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """(distinct words of each column, columns of places among them, counts) of a part's rows."""
    rows = [unpacked(d) for d in table.column("data").to_pylist()]
    words, columns = [], []
    for k in range(0, len(rows[0]) - 1, 3):
        own = [np.cumsum(r[k].astype(np.uint64)) for r in rows]
        words.append(np.unique(np.concatenate(own)))
        column = []
        for listing, r in zip(own, rows):
            place = np.searchsorted(words[-1], listing).astype(np.uint32)
            column.append(np.repeat(place[r[k + 1]] if k else place, r[k + 2]))
            r[k : k + 3] = [None] * 3
        columns.append(np.concatenate(column))
    return words, columns, np.concatenate([r[-1] for r in rows]).astype(np.int64)


class Layout:
    """In which part an n-gram is: by its last word but one, or by the last two if that one is ``frequent``."""

    def __init__(self, parts: int, frequent: np.ndarray):
        self.parts, self.frequent = parts, frequent
        self.word_parts, self.pair_parts = min(parts, WORD_PARTS), min(parts, PARTS)

    def of(self, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Parts of the n-grams that end in ``pairs`` of which ``words`` are the first."""
        return part_of(np.where(np.isin(words, self.frequent), pairs, words), self.parts)


def frequent(texts: DataFrame, parts: int) -> np.ndarray:
    """Words that are over 1 / (2 * parts) of the tokens of every ``SAMPLE``-th text: fewer than ``2 * parts``."""
    mark = np.uint64(HASHES[START])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of a block's more frequent words, and of all tokens under the start mark."""
        own = (t for b in batches for part in pieces(b, "text") for t in part.column(0).to_pylist())
        for hashes, _ in blocks(own, BLOCK):
            words, times = np.unique(hashes, return_counts=True)
            often = times * 8 * parts > len(hashes)
            words, times = np.append(words[often], mark), np.append(times[often], len(hashes))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times)], names=["word", "n"])

    sample = texts.withColumn("row", F.monotonically_increasing_id()).where(F.col("row") % SAMPLE == 0).select("text")
    found = sample.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n")).limit(2 * parts + 1).collect()
    total = max((r.n for r in rows), default=0)
    words = np.array([r.word for r in rows if r.n * 2 * parts > total], np.int64).view(np.uint64)
    return np.sort(words[words != mark])


def _counter(order: int, layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (t for b in batches for part in pieces(b, "text") for t in part.column(0).to_pylist())
        for hashes, sizes in blocks(texts, HELD):
            words, places, start = numbered(hashes)
            chain = [places]
            for _ in range(order - 1):
                chain.insert(0, before(chain[0], sizes, start))
            rows, times = counted(chain, len(words))
            v, w = words[rows[-2]], words[rows[-1]]
            yield from dealt(layout.of(v, pair_hash(v, w)), words, rows, times)

    return run


def _store(path: Path, keys: np.ndarray, *columns: np.ndarray) -> None:
    """A file of ascending keys and their counts: a header, the (up to 255) most frequent rows of counts, places and counts
    of all rows that aren't among them, where each bucket of keys begins, 32 bits of each key, and a byte that names each
    key's row of counts. Renamed when complete."""
    draft = path.with_name(f".{path.name}-{uuid.uuid4().hex}")
    order = np.argsort(keys)
    keys, columns = keys[order], np.stack([c[order] for c in columns]).astype(np.int64)
    n = len(keys)
    bits = min(32, max(1, (n >> 5).bit_length()))
    edges = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    depth = int(np.diff(edges).max()).bit_length()
    if len(columns) == 1:
        kind = columns[0].astype(np.uint64)
    else:
        kind = np.zeros(n, np.uint64)
        for c in columns:
            kind = mix(kind + c.astype(np.uint64) + np.uint64(1))
    _, first, of, times = np.unique(kind, return_index=True, return_inverse=True, return_counts=True)
    common = np.argsort(-times, kind="stable")[:255]
    code = np.full(len(first), 255, np.uint8)
    code[common] = np.arange(len(common))
    code = code[of]
    rare = np.flatnonzero(code == 255)
    with draft.open("wb") as f:
        f.write(np.array([n, len(columns), bits, depth, len(common), len(rare)], np.int64).tobytes())
        f.write(columns[:, first[common]].tobytes())
        f.write(rare.astype(np.int64).tobytes())
        f.write(columns[:, rare].tobytes())
        f.write(edges.astype(np.int64).tobytes())
        f.write((keys >> np.uint64(32 - bits)).astype(np.uint32).tobytes())
        f.write(code.tobytes())
    os.replace(draft, path)


class Mapped:
    """A stored file, memory-mapped. A part that got no rows has no file and no keys."""

    def __init__(self, path: Path):
        self.n = 0
        if not path.exists():
            return
        raw = np.memmap(path, np.uint8, "r")
        self.n, width, self.bits, self.depth, common, rare = raw[:48].view(np.int64).tolist()
        at = 48

        def take(count: int, kind: type) -> np.ndarray:
            nonlocal at
            at += count * np.dtype(kind).itemsize
            return raw[at - count * np.dtype(kind).itemsize : at].view(kind)

        self.common = np.array(take(width * common, np.int64)).reshape(width, common)
        self.rare_at = take(rare, np.int64)
        self.rare = take(width * rare, np.int64).reshape(width, rare)
        self.edges = take((1 << self.bits) + 1, np.int64)
        self.rest = take(self.n, np.uint32)
        self.code = take(self.n, np.uint8)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it is unknown."""
        if not self.n:
            return np.full(len(keys), -1)
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        rest = (keys >> np.uint64(32 - self.bits)).astype(np.uint32)
        low, end = self.edges[bucket], self.edges[bucket + 1]
        high = end
        for _ in range(self.depth):
            middle = (low + high) >> 1
            under = (self.rest[np.minimum(middle, self.n - 1)] < rest) & (low < high)
            low, high = np.where(under, middle + 1, low), np.where(under, high, middle)
        found = np.minimum(low, self.n - 1)
        return np.where((low < end) & (self.rest[found] == rest), found, -1)

    def counts(self, rows: np.ndarray) -> np.ndarray:
        code = self.code[rows]
        out = self.common[:, np.minimum(code, self.common.shape[1] - 1)]
        odd = np.flatnonzero(code == 255)
        if len(odd):
            out[:, odd] = self.rare[:, np.searchsorted(self.rare_at, rows[odd])]
        return out


def classes(c: np.ndarray) -> list[np.ndarray]:
    """What a context sums over its n-grams: their counts and how many have a count of 1, of 2 and of more."""
    return [c, *((x).astype(np.int64) for x in (c == 1, c == 2, c >= 3))]


def passed(part: np.ndarray, kind: int, keys: np.ndarray, sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row a part: the kind of its keys, they in ascending order, their sums."""
    order = np.argsort(keys)
    for p, at in shares(part[order]):
        at = order[at]
        yield row_of(CODED, p, packed(np.array([kind]), steps(keys[at]), *(s[at] for s in sums)))


def exact(kind: int, c: np.ndarray) -> pa.RecordBatch:
    return row_of(CODED, EXACT, packed(np.array([kind]), np.array([(c == k).sum() for k in (1, 2, 3, 4)])))


#: Kinds of sums: of contexts of one word, of words, of contexts of two words.
AS_CONTEXT, AS_WORD, AS_PAIR = 0, 1, 2


def _reducer(folder: str, order: int, layout: Layout):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        words, columns, c = gathered(table)
        del table
        n = max(map(len, words))
        rows, (c,) = grouped(columns, n, [c])
        del columns
        out = [exact(order, c)]
        (first, last), (v, w) = words[-2:], rows[-2:]
        if order == 3:
            u, total = rows[0], c
            pair = pair_hash(words[0][u], first[v])
            _store(Path(folder, f"trigram-{part}"), joint_hash(pair, last[w]), c)
            head = changes(u, v)
            pair, sums = pair[head], [np.add.reduceat(x, head) for x in classes(c)]
            spread = np.isin(first[v[head]], layout.frequent)
            _store(Path(folder, f"context-{part}"), pair[~spread], *(x[~spread] for x in sums))
            pair = pair[spread]
            out += passed(part_of(pair, layout.pair_parts).astype(np.int64) + layout.word_parts, AS_PAIR, pair, [x[spread] for x in sums])
            del u, pair, sums, rows
            (v, w), (c, total) = grouped([v, w], n, [np.ones(len(total), np.int64), total])
            c = np.where(first[v] == np.uint64(HASHES[START]), total, c)
            out.append(exact(2, c))
        else:
            total = c
        _store(Path(folder, f"bigram-{part}"), pair_hash(first[v], last[w]), c)
        head = changes(v)
        keys = first[v[head]]
        out += passed(part_of(keys, layout.word_parts), AS_CONTEXT, keys, [np.add.reduceat(x, head) for x in classes(c)])
        (w,), sums = grouped([w], n, [total, np.ones(len(c), np.int64)])
        out += passed(part_of(last[w], layout.word_parts), AS_WORD, last[w], sums)
        return pa.Table.from_batches(out)

    return run


def _word_reducer(folder: str, layout: Layout):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = [unpacked(d) for d in table.column("data").to_pylist()]
        if part == EXACT:
            sums = {kind: sum(r[1].astype(np.int64) for r in rows if r[0][0] == kind) for kind in {int(r[0][0]) for r in rows}}
            return pa.Table.from_batches([row_of(TOTALS, EXACT, kind, 0, 0, *map(int, c), 0) for kind, c in sums.items()])
        keys = np.concatenate([np.cumsum(r[1].astype(np.uint64)) for r in rows])
        # total, ones, twos, more (as context), count, continuations (as word)
        columns = np.zeros((4 if part >= layout.word_parts else 6, len(keys)), np.int64)
        at = 0
        for kind, own, *sums in rows:
            for k, s in enumerate(sums, 4 if kind[0] == AS_WORD else 0):
                columns[k, at : at + len(own)] = s
            at += len(own)
        order = np.argsort(keys)
        first = changes(keys[order])
        sums = [np.add.reduceat(c[order], first) for c in columns]
        keys = keys[order[first]]
        if part >= layout.word_parts:
            _store(Path(folder, f"pair-{part - layout.word_parts}"), keys, *sums)
            return pa.Table.from_batches([row_of(TOTALS, part, 0, *[0] * 7)])
        _store(Path(folder, f"word-{part}"), keys, *sums)
        count, ways = sums[4:]
        low = [int((ways == k).sum()) for k in (1, 2, 3, 4)]
        return pa.Table.from_batches([row_of(TOTALS, part, 1, int((count > 0).sum()), int(count.sum()), *low, int(ways.sum()))])

    return run


def discounts(c: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more from the numbers of counts 1 to 4; where a
    number that they divide by is 0, the middle of their range. None is under ``LEAST_DISCOUNT``: the weight of the lower
    order comes from the discounts, and without any an unseen word would have no probability."""
    if not all(c):
        return [0.5, 1.0, 1.5]
    y = c[0] / (c[0] + 2 * c[1])
    return [min(k, max(LEAST_DISCOUNT, k - (k + 1) * y * c[k] / c[k - 1])) for k in (1, 2, 3)]


def discount(counts: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def weights(sums: np.ndarray, d: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """(divisor, weight of the lower order) of contexts from their four sums; a context never seen leaves all to it."""
    total, ones, twos, more = sums
    seen = np.maximum(total, 1)
    return seen, np.where(total > 0, (d[0] * ones + d[1] * twos + d[2] * more) / seen, 1.0)


def local_path(uri: str) -> str:
    """The path at which workers open a shared folder."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"memory-mapped models need a shared folder that workers can open, not {uri}")
    return uri


class Model:
    """Where a model's files are and its totals; small, so it goes to workers by value."""

    def __init__(self, folder: str, order: int, layout: Layout, totals: list[tuple]):
        self.folder, self.order, self.layout = folder, order, layout
        own = [t for t in totals if t[1] == 1]
        self.vocabulary, self.tokens = sum(t[2] for t in own), sum(t[3] for t in own)
        self.bigrams = sum(t[8] for t in own)
        self.low = [sum(t[4 + k] for t in own) for k in range(4)]
        self.discounts = {1: discounts(self.low)}
        for kind in (2, 3):
            self.discounts[kind] = discounts(next(([*t[4:8]] for t in totals if t[1] == kind), [0] * 4))
        self.files: dict[str, Mapped] = {}

    def mapped(self, name: str) -> Mapped:
        """A file, opened when it is first asked for; the one opened first goes when too many are open."""
        if name not in self.files:
            while len(self.files) >= OPEN_FILES:
                self.files.pop(next(iter(self.files)))
            self.files[name] = Mapped(Path(self.folder, name))
        return self.files[name]

    def look_up(self, kind: str, keys: np.ndarray, parts: np.ndarray, columns: int = 1) -> np.ndarray:
        """Columns of ``keys``, zero where unknown."""
        out = np.zeros((columns, len(keys)), np.int64)
        for p, asked in shares(parts):
            table = self.mapped(f"{kind}-{p}")
            rows = table.rows(keys[asked])
            hit = rows >= 0
            if hit.any():
                out[:, asked[hit]] = table.counts(rows[hit])
        return out

    def score(self, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(known tokens, base score, model score) of each text of a block."""
        words, word, start = numbered(hashes)
        *of_word, count, ways = self.look_up("word", words, part_of(words, self.layout.word_parts), 6)
        if self.bigrams:
            d = self.discounts[1]
            rest = (d[0] * self.low[0] + d[1] * self.low[1] + d[2] * (self.vocabulary - self.low[0] - self.low[1])) / self.bigrams
            lower = (ways - discount(ways, d)) / self.bigrams + rest / (self.vocabulary + 1)
        else:
            lower = np.ones(len(words))
        # the pair (start, start) comes last, so that it has a place too
        ends = np.append(before(word, sizes, start) * len(words) + word, start * len(words) + start)
        pairs, pair = np.unique(ends, return_inverse=True)
        pair, first = pair[:-1], int(pair[-1])
        left, right = np.divmod(pairs, len(words))
        keys = pair_hash(words[left], words[right])
        parts = self.layout.of(words[left], keys)
        d = self.discounts[2]
        (n,) = self.look_up("bigram", keys, parts)
        seen, weight = weights(of_word, d)
        p = ((n - discount(n, d)) / seen[left] + weight[left] * lower[right])[pair]
        if self.order == 3:
            d = self.discounts[3]
            context = before(pair, sizes, first)
            (n,) = self.look_up("trigram", joint_hash(keys[context], words[word]), parts[pair])
            sums = np.zeros((4, len(keys)), np.int64)
            spread = np.isin(words, self.layout.frequent)[right]
            for kind, at, by, n_parts in (
                ("context", ~spread, words[right], self.layout.parts),
                ("pair", spread, keys, self.layout.pair_parts),
            ):
                sums[:, at] = self.look_up(kind, keys[at], part_of(by[at], n_parts), 4)
            seen, weight = weights(sums, d)
            p = (n - discount(n, d)) / seen[context] + weight[context] * p
        starts = np.cumsum(sizes) - sizes
        base = np.log10((count + ALPHA) / (self.tokens + ALPHA * (self.vocabulary + 1)))
        add = lambda x: np.add.reduceat(x, starts)
        return add((count > 0).astype(np.int64)[word]), add(base[word]), add(np.log10(p))


def train(texts: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Count all rows of ``texts`` and write the model's files to the shared folder; ``order`` is 2 or 3."""
    if order not in (2, 3):
        raise ValueError(f"order {order} is neither 2 nor 3")
    spark = texts.sparkSession
    folder = local_path(scratch(spark, "kneser-ney"))
    os.makedirs(folder, exist_ok=True)
    column = texts.select(F.col(text).alias("text"))
    size = column.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = growing(size, PART_BYTES, PARTS)
    layout = Layout(parts, frequent(column, parts))
    rows = column.mapInArrow(_counter(order, layout), CODED)
    rows = rows.groupBy("part").applyInArrow(_reducer(folder, order, layout), CODED)
    with small_batches(spark):
        totals = rows.groupBy("part").applyInArrow(_word_reducer(folder, layout), TOTALS).collect()  # a row a part
    return Model(folder, order, layout, [tuple(t) for t in totals])


SCORED = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row; perplexity is
    ``10 ** (-score / n_tokens)``."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    names = arrow_schema(f"doc_id bigint, {SCORED}").names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole, "text")):
            at = 0
            for words, sizes in blocks(iter(batch.column(1).to_pylist()), BLOCK):
                known, base, own = model.score(words, sizes)
                columns = (sizes, known, np.full(len(sizes), model.tokens), base, own)
                ids = batch.column(0).slice(at, len(sizes))
                at += len(sizes)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=names)

    return rows.mapInArrow(run, f"doc_id bigint, {SCORED}")


def held_out(key: Column) -> Column:
    return crc_mod(key, 10) == 0


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    scored = score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
