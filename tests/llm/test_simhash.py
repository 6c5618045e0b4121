import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from genoloom.llm import simhash as sh
from genoloom.llm.components import components


def slow_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def slow_components(fps, linked=lambda a, b: bin(a ^ b).count("1") <= 4):
    """{key: smallest key reachable}, by comparing all pairs."""
    label = {k: k for k in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if label[b] < label[a] and linked(fps[a], fps[b]):
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("text", [None, "", " \n ", "One", "a b c", "a b c d", "É A b C d e f g h", "x y " * 700])
def test_fingerprint(text):
    assert sh.fingerprint(text) == slow_fingerprint(text)


SIZES = (1000, 10**8, 10**10, 10**12)


def test_exact_schemes_lose_no_link():
    rng = np.random.default_rng(1)
    for n, keys, bits in zip(SIZES, (64, 256, 640, 1280), (20, 24, 30, 34)):
        scheme = sh.exact_scheme(n)
        assert abs(len(scheme.keys) - keys) <= keys // 50 and min(m.bit_count() for _, m in scheme.keys) >= bits
        x = np.zeros(20_000, np.uint64)
        for _ in range(4):
            x |= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        first = sh.first_key(x[:, None], scheme)
        assert (first >= 0).all()
        masks = np.array([m for _, m in scheme.keys], np.uint64)
        for v, k in zip(x[:300], first[:300]):
            assert np.flatnonzero((masks & v) == 0)[0] == k


def test_buckets_stay_small_whatever_the_corpus():
    for n in (10**6, 10**8, 10**9, 10**10):
        for scheme in (sh.exact_scheme(n), sh.similar_scheme(n)):
            assert n / 2 ** min(m.bit_count() for _, m in scheme.keys) <= 2 * sh.CHANCE


def test_similar_schemes_propose_pairs_at_the_bound():
    rng = np.random.default_rng(2)
    for n in (10**5, 10**9):
        scheme, found, tries = sh.similar_scheme(n), 0, 150
        for _ in range(tries):
            both = rng.integers(0, 2**63, 480).astype(np.uint64)  # two sets of 432 shingles, 384 of them shared: 0.8
            a, b = (np.array(sh.majority(x, scheme.words), np.uint64) for x in (both[:432], np.concatenate([both[:384], both[432:]])))
            near = sh.distance((a ^ b)[None, : scheme.compared])[0] <= scheme.distance
            found += near and sh.first_key((a ^ b)[None], scheme)[0] >= 0
        assert found >= 0.97 * tries


@pytest.mark.parametrize(("small", "n"), [(2, 0), (24, 0), (24, 10**8)])
def test_links(spark, monkeypatch, small, n):
    monkeypatch.setattr(sh, "SMALL", small)
    scheme = sh.exact_scheme
    monkeypatch.setattr(sh, "exact_scheme", lambda k: scheme(n or k))
    rng = np.random.default_rng(3)
    fps = {}
    for base in range(12):
        x = int(rng.integers(0, 2**63)) * 2 + base % 2
        for _ in range(int(rng.integers(1, 18))):
            fps[len(fps)] = x
            for bit in rng.choice(64, int(rng.integers(0, 6)), replace=False):
                x ^= 1 << int(bit)
    signed = [(k, x - 2**64 if x >> 63 else x) for k, x in fps.items()]
    rows = spark.createDataFrame([*signed, (None, 5)], "doc_id long, fp0 long")
    got = {r.fp0: r.component_id for r in sh.classes(rows).collect()}
    want = slow_components(fps)
    assert {k: got[x] for k, x in signed} == want


def test_forest_of_a_large_bucket():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (5000, 3)).astype(np.uint64)
    fps = np.unique(np.bitwise_xor.reduce(np.concatenate([base[rng.integers(0, 300, 5000)][:, None], flips], axis=1), axis=1))
    assert len(fps) > 4096

    def labels(edges):
        parent = list(range(len(fps)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, j in edges:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
        return [root(i) for i in range(len(fps))]

    assert labels(sh.forest(fps[:, None])) == labels(sh.search(fps[:, None]))


def test_documents(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(9, long, 1), (4, long + " end", 1), (7, None, 1), (8, "", 1), (5, "short one", 1), (5, "quite other words", 1), (None, long, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, FP int")
    got = defaultdict(set)
    for r in sh.near_duplicates(docs).collect():
        got[r.doc_id].add(r.component_id)
    assert got == {9: {4}, 4: {4}, 7: {7}, 8: {7}, 5: {5}, None: {None}}
    assert sh.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (300, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {200: 100}


def test_stars_connect_what_links_connect():
    rng = np.random.default_rng(4)
    for n in (1, 5, 60):
        i = rng.integers(0, 90, n)
        j = i + rng.integers(1, 9, n)
        x, first = sh.stars(i, j)
        pairs = {(a, b) for a, b in zip(i.tolist(), j.tolist())}
        want = slow_components({k: k for k in {*i.tolist(), *j.tolist()}}, lambda a, b: (a, b) in pairs or (b, a) in pairs)
        assert dict(zip(x.tolist(), first.tolist())) == {k: v for k, v in want.items() if v != k}
