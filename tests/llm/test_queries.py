"""The registered queries over the whole smallest tables, against plain libraries, loops and DuckDB."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

from genoloom.llm import packing, queries
from tests.llm.test_kneser_ney import tokens
from tests.llm.test_pii import brute as brute_pii
from tests.llm.test_pipeline import check_batches
from tests.llm.test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def rows(spark, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_op1_learns_without_the_held_out(spark, docs):
    got = rows(spark, "op1_language_id")
    assert got.keys() == docs.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())


def test_op2(spark, docs):
    from tokenizers import Tokenizer

    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = rows(spark, "op2_token_store")
    for i in sorted(docs):
        ids = [*tokenizer.encode(docs[i] or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op3(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows(spark, "op3_sentencepiece")
    for i, text in docs.items():
        ids = sp.encode(text or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))


def test_op4_base(spark, docs):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    counts = Counter(t for i, text in docs.items() if not held[i] for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    got = rows(spark, "op4_lm_scoring")
    for i, text in docs.items():
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held[i], len(own), sum(t in counts for t in own), n)
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
    test = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)


def test_op6(spark, docs):
    fps = {i: slow_fingerprint(text) for i, text in docs.items()}
    labels = slow_components(fps)
    got = rows(spark, "op6_simhash")
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{fps[i]:016x}", labels[i]) for i in docs}


def test_op7(spark, docs):
    out = queries.QUERIES["op7_packing"](spark, SF).collect()
    held = Counter()
    for r in out:
        held[r.doc_id] += r.n_tokens
    assert held == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for i, t in docs.items()}
    check_batches(out)
    histogram = Counter(r.n_tokens for r in out)
    assert sorted({r.bucket_len for r in out}) == packing.boundaries(histogram)


def test_op9(spark, docs):
    got = rows(spark, "op9_media_columns")
    for i, text in docs.items():
        data = (text or "").encode()
        payload = data + bytes(-len(data) % 64 or (0 if data else 64))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), sha(payload), zlib.crc32(payload[-64:]))
        size = len(payload)
        # the format's 44 bytes of header: sizes, mono, 8000 samples of 8 bits a second
        head = b"RIFF" + (size + 36).to_bytes(4, "little") + b"WAVEfmt " + bytes([16, 0, 0, 0, 1, 0, 1, 0])
        head += (8000).to_bytes(4, "little") * 2 + bytes([1, 0, 8, 0]) + b"data" + size.to_bytes(4, "little")
        assert (r.media_bytes, r.media_sha256) == (size + 44, sha(head + payload))


def test_op10(spark, docs):
    got = rows(spark, "op10_pii")
    for i, text in docs.items():
        base = brute_pii(text)
        kinds = Counter(x.split(":")[0] for x in base.split(",") if x)
        assert got[i].base_sha256 == sha(base)
        assert [got[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds[k] for k in ("email", "ip", "card", "phone")]
        assert {x for x in base.split(",") if x} <= set(got[i].spans.split(","))


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, want.select(*columns).fetchall()))
