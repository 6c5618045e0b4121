import numpy as np
import pytest

import corpus_pipeline
from genoloom.llm import shingles
from tests.llm.test_quality import counts, failed
from tests.llm.test_simhash import slow_components

SF = "/root/testdata/sf0.01"


def slow_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b) > 0


def changed(rng, words, n):
    """``words`` with ``n`` words far apart replaced, so that 5 n shingles differ."""
    out = list(words)
    for i in rng.choice(len(words) // 6 - 1, n, replace=False):
        out[6 * int(i) + 5] = f"x{rng.integers(10**9)}"
    return out


def test_links_on_both_sides_of_the_bound(spark):
    rng = np.random.default_rng(4)
    texts = {}
    for _ in range(60):
        words = [f"w{rng.integers(10**9)}" for _ in range(304)]
        for n in (0, 5, 6, 7, 9, 12):  # 300 shingles, 5 n of them changed: 0.85, 0.82, 0.79, 0.74, 0.67
            texts[len(texts)] = " ".join(changed(rng, words, n))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in shingles.groups(docs).collect()}
    sets = {k: slow_set(t) for k, t in texts.items()}
    assert got == slow_components(sets, similar)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame([(k, t) for k, t in texts.items()], docs.schema), SF).collect()}
    assert kept == set(got.values())


def test_documents_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    good = [(r.doc_id, r.text) for r in rows if not failed(counts(r.text))]
    docs = spark.createDataFrame(good, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in shingles.groups(docs).collect()}
    assert got == slow_components({k: slow_set(t) for k, t in good}, similar)


@pytest.mark.parametrize("few", [0, 200_000])
def test_edge_rows(spark, monkeypatch, few):
    monkeypatch.setattr(shingles, "BROADCAST_NODES", few)
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(9, long), (4, long + " end"), (7, None), (8, ""), (5, "short one"), (5, long + " more"), (None, long), (9, long), (6, "Short  ONE")]
    got = {(r.doc_id, r.component_id) for r in shingles.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(9, 4), (4, 4), (7, 7), (8, 7), (5, 5), (5, 4), (6, 5), (None, 4)}
    kept = shingles.unique(spark.createDataFrame([(*r, i % 2) for i, r in enumerate(rows)], "doc_id long, text string, R0 int")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(4, long + " end"), (5, "short one"), (7, None)]
    alone = spark.createDataFrame([(None, long), (None, long)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in shingles.groups(alone).collect()} == {(None, None)} and shingles.unique(alone).count() == 1
    assert shingles.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_proposals_of_a_large_group_are_folded(spark, monkeypatch):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(304)]
    docs = spark.createDataFrame([(i, " ".join(changed(rng, words, int(rng.integers(1, 4))))) for i in range(150)], "doc_id long, text string")
    real, met = shingles.components, []
    monkeypatch.setattr(shingles, "components", lambda edges: met.append(edges.distinct().count()) or real(edges))
    got = shingles.groups(docs).collect()
    assert len(got) == 150 and {r.component_id for r in got} == {0}
    monkeypatch.setattr(shingles.simhash, "folded", lambda edges: edges)
    shingles.groups(docs).count()
    folded, _, plain, _ = met
    assert folded <= 4 * 149 < plain  # a link for each node and task at most, not one for each bucket
