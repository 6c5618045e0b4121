import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from genoloom.llm import token_store as ts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = [
    (5, "Hello  world\nagain"),
    (None, "no key"),
    (3, None),
    (3, "third, it's"),
    (3, "third, it's"),
    (9, ""),
    (-4, "é́ 　x\x1cy word" * 50),
    (7, "z" * 3000),
]


def expected(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOKENIZER)
    return [(k, [*tok.encode(t or "", add_special_tokens=False).ids, 2]) for k, t in rows]


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ts, "CHUNK_IDS", 50)
    docs = spark.createDataFrame([(k, t, "x") for k, t in DOCS], "doc_id long, text string, ids string")
    ts.write_store(docs.repartition(3), f"{tmp_path}/s", TOKENIZER)
    got = [tuple(r) for r in ts.read_store(spark, f"{tmp_path}/s", docs).collect()]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    want = [(k, len(i), crc(i)) for k, i in expected(DOCS)]
    order = lambda x: (x is not None, x or 0)
    assert sorted(((k, n, c) for k, _, n, c in got), key=str) == sorted(want, key=str)
    at = 0
    for k, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [k for k, *_ in sorted(got, key=lambda r: r[1])] == sorted((k for k, _ in DOCS), key=order)
    some = spark.createDataFrame([(3,), (7,), (99,), (None,)], "doc_id long")
    rows = sorted((r[0], r[1]) for r in ts.fetch(spark, f"{tmp_path}/s", some).collect())
    assert rows == sorted((k, i) for k, i in expected(DOCS) if k in (3, 7))


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    ts.write_store(docs, f"{tmp_path}/s", TOKENIZER)
    assert ts.read_store(spark, f"{tmp_path}/s", docs).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(-(2**62), 2**62), max_size=400))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.int64)
    table = ts.PerfectHash.build(keys)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))
    if len(keys):
        others = keys + 1
        others = others[~np.isin(others, keys)]
        assert (table.find(others) == -1).mean() >= 0.99 if len(others) else True


def test_pieces_are_exact():
    cache = ts.WordCache(TOKENIZER, "<u2")
    texts = ["I'll  GO\n\nto 3.14 cafés", " lead", "trail ", "", "a\tb c", "x<|endoftext|>y İstanbul ΣΑΣ", "ΟΔΟΣ, İ. x__y_.z don'T we'LL,so ...,a;b ½. A\u0301,B\u0327x K\u2126 J\u030c, =\u0338 x=\u0338", "*** a$$$b.### c"]
    assert [np.frombuffer(b, "<u2").tolist() for b in map(cache.text, texts)] == [
        i[:-1] for _, i in expected(enumerate(texts))
    ]
