"""Language ID by error-correcting output codes over binary n-gram classifiers.

Each language has a codeword; each bit is predicted by a logistic classifier over hashed character n-grams
(orders 1 to 4 of the lower-cased letters, every other run of characters being one space). A text is given the language
whose codeword has the least weighted logistic loss over all bits, a bit's weight being the log odds that it is
right on labelled texts it wasn't fitted to. ``score`` is the softmax of the negative losses; a text whose
score is under ``AMBIGUOUS`` is flagged.

Fitting reads a bounded sample: about ``PER_LANGUAGE`` distinct texts a language, chosen by the hash of the text, so a
group of copies counts once and the choice doesn't depend on order or partitions. Everything else covers all rows and
whole texts. The model has a fixed size (``BUCKETS`` weights a bit) and is broadcast.

Defined results: null text or text without a letter: ``und``, score 0; no labelled text at all: ``und`` for every text;
one language only: that language with score 1; equal losses: the language first in order; equal texts, equal
results; columns of the input named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_with, crc_mod, documents, extended, pieces, row_of

PER_LANGUAGE = 1500
BUCKETS = 1 << 14
ORDERS = (1, 2, 3, 4)
EPOCHS = 12
BATCH = 128
RATE = 0.5
DECAY = 1e-6
AMBIGUOUS = 0.6


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point of the first plane, its lower-case form, or a space where it isn't a letter."""
    low = [ord(c.lower()) if (c := chr(i)).isalpha() and len(c.lower()) == 1 else i if c.isalpha() else 32 for i in range(1 << 16)]
    return np.array(low, np.uint32)


def buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plane = letters()
    points = np.where(points < len(plane), plane[np.minimum(points, len(plane) - 1)], points)
    space = points == 32
    points = np.concatenate([[32], points[~space | ~np.concatenate([[True], space[:-1]])], [32]]).astype(np.uint32)
    out, state = [], np.zeros(len(points), np.uint32)
    for n in ORDERS:
        if len(points) < n:
            break
        state = state[: len(points) - n + 1] * np.uint32(0x01000193) ^ points[n - 1 :] * np.uint32(0x9E3779B1)
        mixed = (state ^ state >> np.uint32(15)) * np.uint32(0x85EBCA77 + 2 * n)
        out.append((mixed ^ mixed >> np.uint32(13)) * np.uint32(0xC2B2AE3D) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(out)


def vector(text: str) -> np.ndarray:
    """Square roots of the n-gram counts, of length 1."""
    v = np.sqrt(np.bincount(buckets(text), minlength=BUCKETS).astype(np.float32))
    return v / np.linalg.norm(v)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each of k languages. Up to five languages have every split of them in two as a
    bit; more have about 10 log2(k) random splits, the best of 200 draws by the least distance of two rows."""
    if k <= 5:
        rest = range(1, k)
        splits = [set(s) for r in range(1, k) for s in combinations(rest, r)]
        return np.array([[1 if i in s else -1 for s in splits] for i in range(k)], np.int8).reshape(k, len(splits))
    rng, bits, best = np.random.default_rng(seed), int(10 * np.log2(k)), None
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        apart = code.astype(int) @ code.T
        worst = apart[~np.eye(k, dtype=bool)].max()
        if best is None or worst < best[0]:
            best = worst, code
    return best[1]


SAMPLE = "lang string, h bigint, at binary, value binary"
MODEL = "weights binary, reliable binary, n_texts int"


class Model:
    """Languages, codewords, classifier weights (bucket by bit, then the bias) and bit weights."""

    def __init__(self, langs: list[str], weights: np.ndarray, reliable: np.ndarray):
        self.langs, self.weights, self.reliable, self.code = langs, weights, reliable, codewords(len(langs))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores of texts that hold a letter (None otherwise)."""
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        names, scores = [], []
        for text in texts:
            if text is None:
                names.append("und")
                scores.append(0.0)
                continue
            margin = vector(text) @ self.weights[:-1] + self.weights[-1]
            loss = np.logaddexp(0, -self.code * margin) @ self.reliable if len(margin) else np.zeros(len(self.langs))
            p = np.exp(loss.min() - loss)
            names.append(self.langs[int(loss.argmin())])
            scores.append(float(p.max() / p.sum()))
        return names, scores


def fit_rows(langs: list[str], rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bit reliabilities from sample rows (lang, h, buckets, values), by AdaGrad over batches in an
    order fixed by the texts' hashes. Every fifth text only measures reliability; then all are fitted."""
    code = codewords(len(langs)).astype(np.float32)
    of = {name: i for i, name in enumerate(langs)}
    unique = {(r[0], r[1]): r for r in rows}
    rows = [unique[k] for k in sorted(unique, key=lambda k: (k[1] * 0x9E3779B97F4A7C15 & (2**64 - 1), k[0]))]
    at = [np.frombuffer(r[2], np.uint16) for r in rows]
    value = [np.frombuffer(r[3], np.float32) for r in rows]
    target = np.array([of[r[0]] for r in rows], np.int64)

    def dense(which: np.ndarray) -> np.ndarray:
        x = np.zeros((len(which), BUCKETS + 1), np.float32)
        for i, k in enumerate(which):
            x[i, at[k]] = value[k]
        x[:, -1] = 1
        return x

    def train(which: np.ndarray) -> np.ndarray:
        w = np.zeros((BUCKETS + 1, code.shape[1]), np.float32)
        seen = np.full_like(w, 1e-6)
        rng = np.random.default_rng(0)
        # each language counts alike, however its texts are distributed
        share = np.bincount(target[which], minlength=len(langs))
        weight = len(which) / np.maximum(1, share) / max(1, (share > 0).sum())
        for _ in range(EPOCHS):
            order = rng.permutation(which)
            for start in range(0, len(order), BATCH):
                k = order[start : start + BATCH]
                x, y = dense(k), code[target[k]]
                pull = -y / (1 + np.exp(np.clip(y * (x @ w), -30, 30))) * weight[target[k]][:, None]
                grad = x.T @ pull.astype(np.float32) / len(k) + DECAY * w
                seen += grad**2
                w -= RATE * grad / np.sqrt(seen)
        return w

    every = np.arange(len(rows))
    if len(rows) < 50:
        return train(every), np.ones(code.shape[1], np.float32)
    w = train(every[every % 5 != 0])
    test = every[every % 5 == 0]
    wrong = np.zeros(code.shape[1])
    for start in range(0, len(test), BATCH):
        k = test[start : start + BATCH]
        wrong += (np.sign(dense(k) @ w) != code[target[k]]).sum(axis=0)
    rate = (wrong + 1) / (len(test) + 2)
    odds = np.maximum(0.1, np.log((1 - rate) / rate))
    return train(every), (odds / odds.mean()).astype(np.float32)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Model from all rows of ``labelled`` with text and lang, through the bounded sample."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    rows = rows.withColumn("h", F.xxhash64("text"))
    counts = dict(map(tuple, rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02)).collect()))  # a row a language
    langs = sorted(counts)
    if len(langs) < 2:
        return Model(langs, np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0, np.float32))
    share = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, per_language / max(1, n)))])
    chosen = rows.where(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < F.try_element_at(share, F.col("lang")) * (1 << 30))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for part in pieces(batch, "text"):
                for t, name, h in zip(*(c.to_pylist() for c in part.columns)):
                    if (name, h) not in seen:
                        seen.add((name, h))
                        v = vector(t)
                        at = np.flatnonzero(v)
                        yield row_of(SAMPLE, name, h, at.astype(np.uint16).tobytes(), v[at].tobytes())

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        if found:
            w, reliable = fit_rows(langs, found)
            yield row_of(MODEL, w.tobytes(), reliable.tobytes(), len(found))

    model = chosen.mapInArrow(features, SAMPLE).repartition(1).mapInArrow(train, MODEL).first()
    if model is None:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0, np.float32))
    return Model(langs, np.frombuffer(model[0], np.float32).reshape(BUCKETS + 1, -1), np.frombuffer(model[1], np.float32))


def add_language(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score and ambiguous; rows and other columns stay."""
    shared = df.sparkSession.sparkContext.broadcast((model.langs, model.weights, model.reliable))
    schema = extended(df.schema, ("lang_pred", "string"), ("score", "double"), ("ambiguous", "boolean"))
    marked = df.withColumn("_letter", F.col(text).rlike(r"\p{L}"))
    kept = [f.name for f in df.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for whole in batches:
            for batch in pieces(whole, text):
                texts = batch.column(kept.index(text)).to_pylist()
                asked = [t if ok else None for t, ok in zip(texts, batch.column(len(kept)).to_pylist())]
                names, scores = own.predict(asked)
                yield batch_with(
                    batch.drop_columns(["_letter"]),
                    lang_pred=pa.array(names, pa.string()),
                    score=pa.array(scores, pa.float64()),
                    ambiguous=pa.array([s < AMBIGUOUS for s in scores], pa.bool_()),
                )

    return marked.mapInArrow(run, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with predictions of a model fitted to its labelled rows that aren't held out."""
    return add_language(docs, fit(docs.where(crc_mod(F.col(key), 4) != 2), text, lang), text)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = fit(docs.where(crc_mod(F.col("doc_id"), 4) != 2))
    held = (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out")
    named = add_language(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held, "lang_pred", "score", "ambiguous")
