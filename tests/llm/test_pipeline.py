from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from genoloom.llm import common, packing
from tests.llm.test_pii import brute as brute_pii
from tests.llm.test_shingles import similar, slow_set
from tests.llm.test_simhash import slow_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, the input first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.orderBy("doc_id").collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.table(stage(spark, docs, SF), f"test-{name}")
        out.append(docs.collect())
    return out


def test_columns_and_decisions(stages):
    before, good, named, unique, clean, packed = stages
    for rows in (good, named, unique, clean):
        assert rows[0].asDict().keys() == before[0].asDict().keys()
    ids = [{r.doc_id for r in rows} for rows in stages[:5]]
    assert ids[0] > ids[1] >= ids[2] > ids[3] == ids[4]
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in unique)


def test_one_of_each_group(stages):
    _, _, named, unique, _, _ = stages
    labels = slow_components({r.doc_id: slow_set(r.text) for r in named}, similar)
    assert {r.doc_id for r in unique} == set(labels.values())


def test_personal_data_is_gone(stages):
    _, _, _, unique, clean, _ = stages
    texts = {r.doc_id: r.text for r in unique}
    touched = 0
    for r in clean:
        base = brute_pii(texts[r.doc_id])
        touched += bool(base)
        assert not brute_pii(r.text) and r.n_chars == len(r.text)
        if not base:
            assert "[EMAIL]" in r.text or "[PHONE]" in r.text or r.text == texts[r.doc_id]
    assert touched


def test_packing_covers_every_token(stages):
    _, _, _, _, clean, packed = stages
    size = {r.doc_id: len(r.text.split()) + 1 for r in clean}
    held = Counter()
    for r in packed:
        held[r.doc_id] += r.n_tokens
    assert held == size
    check_batches(packed)


def check_batches(packed, budget=packing.BUDGET):
    places = Counter((r.bucket_len, r.batch, r.slot) for r in packed)
    assert max(places.values()) == 1
    for (bucket, batch), n in Counter((r.bucket_len, r.batch) for r in packed).items():
        assert n * bucket <= budget
    for bucket in {r.bucket_len for r in packed}:
        own = sorted((r.batch, r.slot) for r in packed if r.bucket_len == bucket)
        each = budget // bucket
        assert own == [(i // each, i % each) for i in range(len(own))]
    assert all(r.n_tokens <= r.bucket_len for r in packed)


def test_edge_rows_through_all_stages(spark):
    long = " ".join(f"mot{i % 97}er w{i}" for i in range(3000))
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, long, "en", "s", 1), (3, long, "en", "s", 1), (3, long, "en", "s", 1),
            (4, long + " a@b.com", None, "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.table(stage(spark, docs, SF), "edge")
    assert {r.doc_id for r in docs.collect()} <= {None, 3, 4}
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = common.table(stage(spark, empty, SF), "edge")
        assert empty.count() == 0


def test_rows_are_told_apart_by_their_texts(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(3, "b x", "en", "s", 1), (3, "a x", "en", "s", 1), (4, "b x", "en", "s", 1), (None, "c", "en", "s", 1), (None, "c", "en", "s", 1), (5, "d", "en", "s", 1), (5, "d", "en", None, 1)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("3", "a x"), ("3", "b x"), ("5", "d"), ("None", "c")]


def test_clashing_columns_through_all_stages(spark):
    names = ("base", "SPANS", "kept", "n_words", "r0", "s1", "label", "lang_pred", "Score", "ambiguous", "_p_each", "_p_more", "row", "first", "range", "base_failed", "g1", "node")
    rows = [(i, " ".join(f"wort{(i * 37 + k * 11) % 501}er und{k}" for k in range(40)) + (" a@b.com" if i % 2 else ""), "de", "s", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plain = [docs]
    wide = [docs.select("*", *[F.lit("x").alias(n) for n in names])]
    for _, stage in corpus_pipeline.STAGES:
        for chain in (plain, wide):
            chain.append(common.table(stage(spark, chain[-1], SF), "clash"))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for a, b in zip(plain[:-1], wide[:-1]):
        assert sorted(map(tuple, a.select(*columns).collect())) == sorted(map(tuple, b.select(*columns).collect()))
    assert plain[-2].count() and sorted(map(tuple, plain[-1].collect())) == sorted(map(tuple, wide[-1].collect()))
    assert wide[-2].columns == wide[0].columns and {tuple(r) for r in wide[-2].select(*names).collect()} == {("x",) * len(names)}
