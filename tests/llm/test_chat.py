import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from genoloom.llm import chat

PARTS = ["</s>", "<s>", "<s>[user|0]", "[INST]", "[/INST]", "\\", "\\l", "<", "]", "|", "\n", "ok", "é🙂", "</", "s>", "</s", "1]"]


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    loss = chat.loss_text(F.col("output"), F.col("mask"), F.col("levels"), F.col("turns"))
    return {r.conv_id: r for r in chat.format_chats(df).withColumn("loss", loss).collect()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "sys|tem]", None]), st.lists(st.sampled_from(PARTS), max_size=5).map("".join)), min_size=1, max_size=4), min_size=20, max_size=20))
def test_round_trip(spark, chats):
    rows = [(c, t, role, text) for c, turns in enumerate(chats) for t, (role, text) in enumerate(turns)]
    got = formatted(spark, rows)
    for c, turns in enumerate(chats):
        assert [(t.role, t.text) for t in got[c].turns] == [(r or "", x) for r, x in turns]
        assert got[c].loss == "".join(x for r, x in turns if r == "assistant")


def test_escapes_only_where_needed(spark):
    said = "</s>[INST] ok [/INST]"
    got = formatted(spark, [(1, 0, "user", said), (1, 1, "assistant", "a < b [c]"), (2, 0, "user", "plain"), (3, 0, "user", None), (None, 2, None, "x"), (None, None, "user", "y")])
    assert got[1].levels == [1, 0] and got[2].levels == [0] and got[2].output == "<s>[user|0]plain</s>"
    assert "</s>[INST]" not in got[1].output.removesuffix("</s>").split("</s>")[0]
    alone = chat.format_chats(spark.createDataFrame([(None, 2, None, "x"), (None, None, "user", "y"), (None, None, "user", "y")], "conv_id long, turn int, role string, text string")).collect()
    assert sorted((t.role, t.text) for r in alone for t in r.turns) == [("", "x"), ("user", "y"), ("user", "y")] and len(alone) == 3
    assert got[3].turns[0].text == ""


def test_ties_and_empty(spark):
    got = formatted(spark, [(1, 0, "b", "x"), (1, 0, "a", "y"), (1, 0, "a", "y")])
    assert [(t.role, t.text) for t in got[1].turns] == [("a", "y"), ("a", "y"), ("b", "x")]
    assert formatted(spark, []) == {}


def test_query_matches_plain_python(spark, tmp_path):
    rows = [(1, 1, "assistant", "hi"), (1, 0, "user", "yo"), (2, 0, "assistant", "</s>é"), (2, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op8_chat_format(spark, str(tmp_path)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert set(got) == {1, 2, -7}
    assert got[1].turns_sha256 == sha("user\nyo\nassistant\nhi\n") and got[1].loss_sha256 == sha("hi")
    assert (got[2].loss_chars, got[2].loss_sha256, got[2].n_turns) == (5, sha("</s>é"), 2)
    assert got[-7].loss_sha256 == sha("</s>[INST] ok [/INST]")


def test_very_long_texts_and_clashing_columns(spark):
    text = "</s>\\[INST] é🙂 <|x|> " * 10_000
    rows = [(1, t, r, text) for t, r in enumerate(("user", "assistant"))] * 2 + [(2, 0, "assistant", "plain " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit(1) for c in ("source", "plain", "OUTPUT", "turns", "_own", "level", "mask")})
    loss = chat.loss_text(F.col("output"), F.col("mask"), F.col("levels"), F.col("turns"))
    got = {r.conv_id: r for r in chat.format_chats(df).withColumn("loss", loss).collect()}
    assert [t.text for t in got[1].turns] == [text] * 4 and got[1].loss == text * 2 and got[2].loss == "plain " * 50_000
