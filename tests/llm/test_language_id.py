import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoloom.llm import language_id as li

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = li.op1_language_id(spark, SF).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and len(held) > 200
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def slow_buckets(text):
    """n-gram buckets with Python integers, one n-gram at a time."""
    letters = [c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text]
    letters = [c if ord(o) < 1 << 16 else o for c, o in zip(letters, text)]
    points = [32] + [ord(c) for i, c in enumerate(letters) if c != " " or i and letters[i - 1] != " "] + [32]
    out, word = [], (1 << 32) - 1
    for n in li.ORDERS:
        for i in range(len(points) - n + 1):
            state = 0
            for k in range(n):
                state = (state * 0x01000193 & word) ^ (points[i + k] * 0x9E3779B1 & word)
            x = (state ^ state >> 15) * (0x85EBCA77 + 2 * n) & word
            out.append(((x ^ x >> 13) * 0xC2B2AE3D & word) >> (32 - 14))
    return out


def slow_decode(text, model):
    """Weighted losses of each codeword, bit by bit."""
    counts = {}
    for b in slow_buckets(text):
        counts[b] = counts.get(b, 0) + 1
    length = math.sqrt(sum(counts.values()))
    margins = [sum(math.sqrt(c) / length * model.weights[b, j] for b, c in counts.items()) + model.weights[-1, j] for j in range(model.code.shape[1])]
    losses = [sum(r * math.log1p(math.exp(-bit * m)) for r, bit, m in zip(model.reliable, row, margins)) for row in model.code]
    best = min(range(len(losses)), key=lambda k: (losses[k], k))
    return model.langs[best], 1 / sum(math.exp(losses[best] - x) for x in losses)


def test_decoding_against_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = li.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    texts = [r.text for r in docs.orderBy("doc_id").limit(40).collect()] + ["Ünï 日本 x", "a", "İstanbul 1 ß", "été " * 20_000]
    names, scores = model.predict(texts)
    for text, name, score in zip(texts, names, scores):
        want = slow_decode(text, model)
        assert (name, score) == (want[0], pytest.approx(want[1], rel=1e-3))


def test_ties_give_the_first_language():
    model = li.Model(["a", "b", "c"], np.zeros((li.BUCKETS + 1, 3), np.float32), np.ones(3, np.float32))
    assert model.predict(["any text", None]) == (["a", "und"], [pytest.approx(1 / 3), 0.0])


def test_codewords_are_apart():
    for k in (2, 3, 4, 5, 6, 12, 40):
        code = li.codewords(k).astype(int)
        apart = (code.shape[1] - code @ code.T) // 2
        assert code.shape[0] == k and apart[~np.eye(k, dtype=bool)].min() >= (1 if k < 4 else code.shape[1] // 4)


def test_edge_rows(spark):
    en, de = "the house and the garden with them ", "der hund und die katze mit dem haus "
    rows = [(i, (en if i % 2 else de) * (1 + i % 5), "en" if i % 2 else "de", 1) for i in range(60)]
    rows += [(70, None, "en", 1), (71, "123 !?", "en", 1), (72, en, None, 1), (None, de, None, 1), (73, "", None, 1), (74, "日本", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, SCORE int")
    got = {r.doc_id: r for r in li.identify(docs).collect()}
    assert [got[i].lang_pred for i in (70, 71, 73)] == ["und"] * 3 and got[70].score == 0
    assert got[72].lang_pred == "en" and got[None].lang_pred == "de" and got[74].lang_pred in ("en", "de")
    assert li.identify(docs.limit(0)).count() == 0
    one = docs.where("lang = 'en' AND text IS NOT NULL")
    assert {(r.lang_pred, r.score) for r in li.identify(one).where(F.col("doc_id") < 60).collect()} == {("en", 1.0)}
    nothing = li.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_many_languages(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(7):
        words = ["".join(rng.choice(list("abcdefghijklmnopq")[k : k + 9], 5)) for _ in range(30)]
        rows += [(len(rows) + i, " ".join(rng.choice(words, 40)), f"l{k}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = li.identify(docs).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
