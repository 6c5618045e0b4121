"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered as ``<s>[ROLE|E]TEXT</s>``, E being its escape level. The parser is deterministic: cut
the output at ``</s>``, read the header of each part, undo its escapes. A conversation is first
rendered without escapes (level 0) and parsed; turns are compared with the source by position, and those
that don't come back, together with those that hold a control string, are escaped (level 1: a backslash
before each backslash, angle and square bracket becomes two-letter code) and the text is rendered and
parsed again. Level 1 holds no control string, so the second parse is identical; a conversation that
still differs stops the job rather than pass a wrong text on.

The loss mask is an array of (start, length) spans of the rendered text, one for each assistant text.

Scale: one shuffle by conversation; what is gathered for a conversation is its own output row.
Defined results: null text and null role are empty; turns stand in the order of turn, role, text with
null turns first, equal rows next to each other; a row with a null conv_id is a conversation of its own; no rows
give no conversations; only the four columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Strings with a meaning in the template or in templates that the text may be formatted with later.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
END = "</s>"
#: Escapes in the order in which they are made: the escape character first.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"), ("[", "\\o"), ("]", "\\c"), ("|", "\\p"))


def literal(x: str) -> Column:
    return F.lit(x)


def escaped(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, literal(raw), literal(code))
    return text


def unescaped(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, literal(code), literal(raw))
    return text


def rendered_turn(turn: Column) -> Column:
    level = turn["level"]
    # roles are escaped always: they stand in the header
    body = F.when(level == 1, escaped(turn["text"])).otherwise(turn["text"])
    return F.concat(F.lit("<s>["), escaped(turn["role"]), F.lit("|"), level.cast("string"), F.lit("]"), body, F.lit(END))


def parsed(output: Column) -> Column:
    """Turns (role, text) of a rendered conversation; a part without a header gives a null role."""
    parts = F.split(output, END, -1)
    head = r"^<s>\[([^|\]]*)\|([01])\]"

    def turn(part: Column) -> Column:
        found = F.regexp_extract(part, head, 2)
        size = F.length(F.regexp_extract(part, head, 0))
        body = F.substring(part, size + 1, F.length(part))
        return F.struct(
            F.when(found != "", unescaped(F.regexp_extract(part, head, 1))).alias("role"),
            F.when(found == "1", unescaped(body)).otherwise(body).alias("text"),
        )

    return F.transform(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def source_turns(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def has_control(text: Column) -> Column:
    out = F.lit(False)
    for x in CONTROL:
        out = out | F.contains(text, F.lit(x))
    return out


def format_chats(rows: DataFrame) -> DataFrame:
    """(conv_id, output, turns, mask, n_escaped) of each conversation; ``turns`` are read back."""
    clean = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    source = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    with_level = lambda f: lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), f(t).alias("level"))
    join = lambda c: F.array_join(F.transform(F.col(c), rendered_turn), "")
    # rows without a conversation would be one group of any size
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    first = (
        clean.withColumn("_own", own).groupBy("conv_id", "_own")
        .agg(source.alias("source"))
        .withColumn("plain", F.transform("source", with_level(lambda t: F.lit(0))))
        .withColumn("output", join("plain"))
        .withColumn("turns", parsed(F.col("output")))
    )

    def level(t: Column, i: Column) -> Column:
        back = F.get(F.col("turns"), i)
        same = back["role"].eqNullSafe(t["role"]) & back["text"].eqNullSafe(t["text"])
        escape = ~same | has_control(t["text"])
        return F.struct(t["role"].alias("role"), t["text"].alias("text"), escape.cast("int").alias("level"))

    differs = ~F.col("turns").eqNullSafe(source_turns(F.col("source")))
    touched = differs | F.exists("source", lambda t: has_control(t["text"]))
    # A text cut in two shifts all later turns, so the turns after it would be escaped without need:
    # when the number of turns differs, only those that hold a control string are.
    shifted = F.size("turns") != F.size("source")
    by_content = F.transform("source", with_level(lambda t: has_control(t["text"]).cast("int")))
    second = (
        first.withColumn("plain", F.when(~touched, F.col("plain")).when(shifted, by_content).otherwise(F.transform("source", level)))
        .withColumn("output", F.when(touched, join("plain")).otherwise(F.col("output")))
        .withColumn("turns", F.when(touched, parsed(F.col("output"))).otherwise(F.col("turns")))
    )
    sizes = F.transform(F.col("plain"), lambda t: F.struct(t["role"].alias("role"), F.length(rendered_turn(t)).alias("n"), (F.length(escaped(t["role"])) + 7).alias("head")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        span = F.struct((acc["at"] + t["head"]).alias("start"), (t["n"] - t["head"] - len(END)).cast("bigint").alias("length"))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + t["n"]).alias("at"), spans.alias("spans"))

    wrong = F.raise_error(F.lit("a formatted conversation doesn't parse back to its turns"))
    identical = F.col("turns").eqNullSafe(source_turns(F.col("source")))
    return second.select(
        "conv_id",
        F.when(identical, F.col("output")).otherwise(wrong.cast("string")).alias("output"),
        "turns",
        F.transform("plain", lambda t: t["level"]).alias("levels"),
        F.aggregate(sizes, start, step)["spans"].alias("mask"),
    )


def loss_text(output: Column, mask: Column, levels: Column, turns: Column) -> Column:
    """The text under the mask, unescaped, read from the rendered output."""
    own = F.filter(F.arrays_zip(levels.alias("level"), turns.alias("turn")), lambda z: z["turn"]["role"] == "assistant")
    pairs = F.arrays_zip(mask.alias("span"), F.transform(own, lambda z: z["level"]).alias("level"))

    def piece(p: Column) -> Column:
        text = F.substring(output, (p["span"]["start"] + 1).cast("int"), p["span"]["length"].cast("int"))
        return F.when(p["level"] == 1, unescaped(text)).otherwise(text)

    return F.array_join(F.transform(pairs, piece), "")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{said}' AS text UNION ALL SELECT -7L, 1L, 'assistant', '{said}'")
    done = format_chats(rows.unionByName(added))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = loss_text(F.col("output"), F.col("mask"), F.col("levels"), F.col("turns"))
    return done.withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("output").cast("bigint").alias("formatted_chars"),
    )


#: formatted_chars: each turn adds its text and ``<s>[``, role, ``|0]``, ``</s>``; a turn that holds a control
#: string adds one character for each escape. Roles of the tables hold none of the escaped characters.
SQL = """
WITH t AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, NULL, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, NULL, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, CASE WHEN contains(text, '<s>') OR contains(text, '</s>') OR contains(text, '[INST]') OR contains(text, '[/INST]')
    THEN length(regexp_replace(text, '[^\\\\<>\\[\\]|]', '', 'g')) ELSE 0 END AS more
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length(text) + length(role) + 11 + more) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id, own
"""
