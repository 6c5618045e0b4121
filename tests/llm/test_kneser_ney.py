import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from genoloom.llm import kneser_ney as kn


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def own_discounts(n):
    """Chen and Goodman's estimates, kept within [0.05, count]; the middle where they are undefined."""
    n1, n2, n3, n4 = n
    if 0 in n:
        return [0.5, 1, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [max(0.05, min(1, 1 - 2 * y * n2 / n1)), max(0.05, min(2, 2 - 3 * y * n3 / n2)), max(0.05, min(3, 3 - 4 * y * n4 / n3))]


def brute(train, texts, order=3):
    """Both scores from dictionaries, straight from the definitions: a context is a tuple of words, shorter by one at
    each lower order; below the highest order an n-gram counts the words seen before it, or itself after a start mark."""
    grams, words = Counter(), Counter()
    chains = lambda ts: zip(*([*["<s>"] * (order - 1), *ts][k:] for k in range(order)))
    for t in train:
        ts = tokens(t)
        words.update(ts)
        grams.update(chains(ts))
    n, v = sum(words.values()), len(words)
    levels = {order: grams}
    for k in range(order - 1, 0, -1):
        counts, raw = Counter(), Counter()
        for g, c in levels[k + 1].items():
            counts[g[1:]] += 1
        for g, c in grams.items():
            raw[g[order - k :]] += c
        levels[k] = {g: raw[g] if k > 1 and g[0] == "<s>" else c for g, c in counts.items()}
    d = {k: own_discounts([sum(c == i for c in levels[k].values()) for i in (1, 2, 3, 4)]) for k in levels}
    cut = lambda c, k: d[k][min(c, 3) - 1] if c else 0
    after = defaultdict(list)
    for k in levels:
        for g, c in levels[k].items():
            after[g[:-1]].append(c)

    def p(*g):
        if not grams:
            return 1.0
        lower = p(*g[1:]) if len(g) > 1 else 1 / (v + 1)
        if g[:-1] not in after:
            return lower
        of = after[g[:-1]]
        c = levels[len(g)].get(g, 0)
        return (c - cut(c, len(g))) / sum(of) + sum(cut(x, len(g)) for x in of) / sum(of) * lower

    out = []
    for t in texts:
        ts = tokens(t)
        base = sum(math.log10((words[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ts)
        own = sum(math.log10(p(*g)) for g in chains(ts))
        out.append((len(ts), sum(x in words for x in ts), n, base, own))
    return out, p, words


@pytest.mark.parametrize(("parts", "order"), [(24 << 20, 3), (900, 3), (60, 3), (60, 2)])
def test_against_dictionaries(spark, monkeypatch, parts, order):
    monkeypatch.setattr(kn, "PART_BYTES", parts)
    rng = np.random.default_rng(1)
    vocabulary = ["The", "a", "Éa", "x,", "dog", "cat", "ran", "sat"] + [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 60), p=None)) for _ in range(60)] + [None, "", " \n", "the the the"]
    train = spark.createDataFrame([(t,) for t in texts[:50]], "text string")
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    got = [tuple(r)[1:] for r in kn.score(docs, kn.train(train, order=order)).orderBy("doc_id").collect()]
    want, p, words = brute(texts[:50], texts, order)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9)
    for a in (("<s>", "<s>"), ("<s>", "the"), ("the", "a"), ("the", "never"), ("never", "dog")):
        assert sum(p(*a[3 - order :], b) for b in words) + p(*a[3 - order :], "unknown") == pytest.approx(1)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    got = sorted((r.n_tokens, r.base_score, r.score) for r in kn.score(docs, kn.train(docs.limit(0))).collect())
    assert got == [(1, 0.0, 0.0), (3, 0.0, 0.0)]
    assert kn.score(docs.limit(0), kn.train(docs)).count() == 0


def test_stored_counts_stay_exact(tmp_path):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**64, 20_000, np.uint64))
    counts = np.array([1, 2, 0xFFFF, 2**40])[rng.integers(0, 4, len(keys))] + rng.integers(0, 300, len(keys))
    order = rng.permutation(len(keys))
    for columns in ([counts], [counts, counts[::-1]]):
        kn._store(tmp_path / "x", keys[order], *(c[order] for c in columns))
        file = kn.Mapped(tmp_path / "x")
        rows = file.rows(keys)
        assert rows.tolist() == list(range(len(keys)))
        assert file.counts(rows).tolist() == [c.tolist() for c in columns]
        assert (file.rows(rng.integers(0, 2**64, 20_000, np.uint64)) < 0).all()
    kn._store(tmp_path / "one", keys[:1], counts[:1])
    assert kn.Mapped(tmp_path / "one").rows(keys[:3]).tolist() == [0, -1, -1]
    assert kn.Mapped(tmp_path / "none").rows(keys[:3]).tolist() == [-1] * 3


@pytest.mark.parametrize("size", [50, 1 << 40])
def test_wide_vocabularies_are_counted_alike(size):
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 5, 300) for _ in range(3)]
    want = sorted(Counter(zip(*(c.tolist() for c in columns))).items())
    rows, times = kn.counted(columns, size)
    assert list(zip(zip(*(r.tolist() for r in rows)), times.tolist())) == want


def test_no_discount_leaves_a_word_without_probability(spark):
    """Count of counts 10, 6, 20, 2: the second discount would be 0."""
    train = [f"t{i}" for i, n in enumerate([1] * 10 + [2] * 6 + [3] * 20 + [4] * 2) for _ in range(n)]
    texts = ["t0 zzz", "t11 zzz", "zzz zzz", "t12 t3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.score for r in kn.score(docs, kn.train(spark.createDataFrame([(t,) for t in train], "text string"))).orderBy("doc_id").collect()]
    assert np.isfinite(got).all() and got == pytest.approx([w[4] for w in brute(train, texts)[0]], rel=1e-9)


def test_parts_of_any_corpus_are_few(monkeypatch):
    from genoloom.llm import token_store
    from genoloom.llm.common import growing

    assert growing(0, 10, 5) == 1 and growing(50, 10, 5) == 5 and growing(50_000, 10, 5) == 50
    for size in (10**12, 10**14):  # up to 10 ** 11 documents
        parts, shards = growing(size, kn.PART_BYTES, kn.PARTS), growing(size, token_store.SHARD_BYTES, token_store.SHARDS)
        assert parts * kn.WORD_PARTS < 2 * 10**8 and shards < 60_000 and size / shards < 4 << 30


def test_a_word_that_is_a_third_of_all_is_spread(spark):
    rng = np.random.default_rng(5)
    rows = [(" ".join(f"{a} {b} the" for a, b in rng.integers(0, 5000, (40, 2)).tolist()),) for _ in range(640)]
    texts = spark.createDataFrame(rows, "text string").repartition(4)
    found = kn.frequent(texts, 64)
    assert kn.HASHES[b"the"] in found.tolist() and len(found) < 128
    layout, held = kn.Layout(64, found), Counter()
    for batch in kn._counter(3, layout)(iter([kn.pa.RecordBatch.from_pydict({"text": [t for (t,) in rows]})])):
        held[batch.column(0)[0].as_py()] += len(kn.unpacked(batch.column(1)[0].as_py())[-1])
    assert len(held) == 64 and max(held.values()) < 2 * sum(held.values()) / 64


def test_long_and_repeated_texts_and_few_open_files(spark, monkeypatch):
    monkeypatch.setattr(kn, "PART_BYTES", 4000)
    monkeypatch.setattr(kn, "OPEN_FILES", 2)
    long = " ".join(f"w{i % 701}" for i in range(60_000))
    texts = [long, "a b", "a b", long]
    docs = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(tuple(r)[1:] for r in kn.score(docs, kn.train(docs)).collect())
    for g, w in zip(got, sorted(brute(texts, texts)[0]), strict=True):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9)
