import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from genoloom.llm import sentencepiece_bpe as sb

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CODEC = sb.Codec(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TEXTS = [
    "", " ", "  a  b\n c <s> é", "\n\n\n", "a\0b", "▁x ▁▁", "一二三 日本語", "🙂🙃 ok", "aaaaaaaaaaaaaaaaaaaaaaa",
    "   lead and trail   ", "<0x0A></s>", "�​", "the cat\tsat", "x" * 3000, " " * 333, "ab" * 2000, "퟿\U0010ffff",
]


def ids(text):
    joined = CODEC.encode_text(text)
    return [int(i) for i in joined.split(",")] if joined else []


@pytest.mark.parametrize("text", TEXTS)
def test_edges(text):
    assert ids(text) == LIBRARY.encode(text) and CODEC.decode(ids(text)) == LIBRARY.decode(ids(text))


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abcdehinorst \n▁", max_size=60), st.lists(st.sampled_from(["the", "ing", " ", "er", "un", "tion", "aa", "1", "é"]), max_size=40).map("".join)))
def test_like_the_library(text):
    assert ids(text) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 300)), max_size=20))
def test_decode_like_the_library(some):
    assert CODEC.decode(some) == LIBRARY.decode(some)


def test_frames(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*TEXTS, None])], "doc_id int, text string, IDS int")
    got = sb.add_pieces(docs, MODEL).orderBy("doc_id").collect()
    assert [list(r.ids) for r in got] == [LIBRARY.encode(t) for t in [*TEXTS, ""]]
    back = sb.decode_ids(sb.add_pieces(docs, MODEL, outputs=("ids",)), MODEL).orderBy("doc_id").collect()
    assert [r.decoded for r in back] == [r.decoded for r in got]
    assert sb.add_pieces(docs.limit(0), MODEL).count() == 0


def test_other_models_raise(monkeypatch):
    real = sentencepiece.SentencePieceProcessor.encode
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "encode", lambda self, x: real(self, x.casefold()))
    with pytest.raises(ValueError, match="merge model"):
        sb.Codec(MODEL)
