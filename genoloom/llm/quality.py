"""Quality rules with adaptive thresholds from mergeable quantile sketches, in DataFrame functions only.

Per text: words, their characters, symbols, repeated lines and words in repeated 8-word windows. A text with
fewer than 20 words or with over 30 % repeated words fails the base rule. The others are judged against their
own language and source: each feature has a quantile sketch with logarithmic buckets (relative error
``GAMMA - 1``), a count for each (language, source, feature, bucket). Such sketches merge by adding counts, in any
order and with the same result, so they roll up from sources to languages to the whole corpus. A group's
quantiles are drawn toward its language's, and a language's toward the corpus's, by a weight of ``PRIOR`` texts: a small
group mostly uses its parent's, a large one its own, without a step between. From them come fences around the median: for
word length and symbols a multiple of the quartile distance, for duplicate lines and repeats, which most texts lack, of the
distance up to the 99th percentile, so that such texts as a group has by habit stay. A least reach keeps a feature that all
texts share from making the rest outliers. The texts are joined with the fences and filtered.

Scale: sketches have at most a few hundred rows a group and feature, pre-aggregated before the shuffle, so a hot
source costs no more than any other. Thresholds are one row a group; they are broadcast when their counted rows are
at most ``BROADCAST_GROUPS`` and else joined over salted keys. Texts are never shuffled.

Defined results: null and blank texts have no words and fail; null languages and sources are groups of their own; a
group without texts that pass the base rule has no thresholds and passes nothing on; rows that repeat count as
often as they stand; columns of the input that have a name of an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, documents, table, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 0.30
SYMBOLS = "[#*$%&|<>]"

GAMMA = 1.02
PRIOR = 200
BROADCAST_GROUPS = 20_000
SALTS = 32
#: feature: (lower and upper quantile of its spread, how many spreads a text may stand from the median, the least reach, whether
#: low values are suspect too)
FEATURES = {
    "word_length": (0.25, 0.75, 6.0, 0.3, True),
    "symbol_ratio": (0.25, 0.75, 6.0, 0.06, False),
    "dup_line_ratio": (0.5, 0.99, 2.0, 0.1, False),
    "repeat_ratio": (0.5, 0.99, 2.0, 0.1, False),
}
QUANTILES = (0.25, 0.5, 0.75, 0.99)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base counts and the number of lines with a word. Each step is a projection of its own, so nothing is computed twice."""
    body = F.coalesce(F.col(text), F.lit(""))
    pair = lambda c, d: F.zip_with(
        F.slice(c, F.lit(1), F.size(c) - d), F.slice(c, F.lit(1 + d), F.size(c) - d), lambda a, b: F.xxhash64(a, b)
    )
    step = df.drop(*BASE).withColumn("_q_w", words(F.col(text)))
    step = step.withColumns(
        {
            "n_words": F.size("_q_w").cast("bigint"),
            "word_chars": F.length(F.array_join("_q_w", "")).cast("bigint"),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("bigint"),
            "_q_l": F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""),
            "_q_h": F.when(F.size("_q_w") >= WINDOW, F.transform("_q_w", lambda w: F.xxhash64(w))),
        }
    ).drop("_q_w")
    step = step.withColumns(
        {"n_lines": F.size("_q_l").cast("bigint"), "n_dup_lines": (F.size("_q_l") - F.size(F.array_distinct("_q_l"))).cast("bigint"), "_q_h": pair(F.col("_q_h"), 1)}
    ).drop("_q_l")
    for d in (2, 4):
        step = step.withColumn("_q_h", pair(F.col("_q_h"), d))
    twice = F.size(F.array_distinct("_q_h")) < F.size("_q_h")
    # (hash, position) in order: equal hashes stand together. Positions of those that do, in order again.
    at = F.transform("_q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn("_q_h", F.when(twice, F.sort_array(at)))
    same = lambda a, b: F.get(F.col("_q_h"), a)["h"] == F.get(F.col("_q_h"), b)["h"]
    held = F.filter("_q_h", lambda x, k: F.coalesce(same(k, k + 1), F.lit(False)) | F.coalesce(same(k, k - 1), F.lit(False)))
    step = step.withColumn("_q_h", F.sort_array(F.transform(held, lambda x: x["i"])))
    gap = lambda x, k: F.coalesce(F.least(F.lit(WINDOW), F.get(F.col("_q_h"), k + 1) - x), F.lit(WINDOW))
    covered = F.aggregate(F.transform("_q_h", gap), F.lit(0), lambda a, x: a + x)
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_q_h")


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > round(100 * MAX_REPEATED) * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def features() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "word_length": F.col("word_chars") / n,
        "symbol_ratio": F.col("n_symbols") / n,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_ratio": F.col("n_repeat_words") / n,
    }


def sketch(df: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """(groups, feature, bucket, n): log-bucket counts of each feature; zero has bucket -100000."""
    named = F.array(*[F.struct(F.lit(k).alias("feature"), v.alias("v")) for k, v in features().items()])
    flat = df.select(*groups, F.explode(named).alias("f")).select(*groups, "f.feature", "f.v")
    slot = F.when(F.col("v") <= 0, F.lit(-100_000)).otherwise(F.ceil(F.log("v") / F.log(F.lit(GAMMA))).cast("int"))
    return flat.groupBy(*groups, "feature", slot.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    return sketches.groupBy(*groups, "feature", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """(groups, n, {feature: array of its ``QUANTILES``}) from one level's sketches: the sorted buckets of a group and feature
    are a short array, over which the cumulative count finds them."""
    arrays = sketches.groupBy(*groups, "feature").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("b"), F.sum("n").alias("total")
    )

    def quantile(q: float) -> Column:
        # the first bucket at which the running count reaches the rank; its middle value
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("at"))

        def step(a: Column, x: Column) -> Column:
            seen = a["seen"] + x["n"]
            hit = F.when(a["at"].isNull() & (seen >= F.ceil(F.lit(q) * F.col("total"))), x["bucket"]).otherwise(a["at"])
            return F.struct(seen.alias("seen"), hit.alias("at"))

        slot = F.aggregate("b", start, step)["at"]
        value = F.pow(F.lit(GAMMA), slot.cast("double")) * (2 / (1 + GAMMA))
        return F.when(slot == -100_000, F.lit(0.0)).otherwise(value)

    rows = arrays.select(*groups, "feature", "total", F.array(*map(quantile, QUANTILES)).alias("q"))
    pick = [F.max(F.when(F.col("feature") == name, F.col("q"))).alias(name) for name in FEATURES]
    return rows.groupBy(*groups).agg(F.max("total").alias("n"), *pick)


def drawn(own: Column, n: Column, parent: Column) -> Column:
    """A group's quantiles, drawn toward its parent's by the weight of ``PRIOR`` texts."""
    return F.zip_with(own, parent, lambda x, y: (n * x + PRIOR * y) / (n + PRIOR))


def fence(name: str, q: Column) -> Column:
    low, high, times, least, _ = FEATURES[name]
    at = lambda p: F.get(q, F.lit(QUANTILES.index(p)))
    reach = F.greatest(times * (at(high) - at(low)), F.lit(least))
    return F.struct((at(0.5) - reach).alias("low"), (at(0.5) + reach).alias("high")).alias(name)


def thresholds(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row (lang, source, feature fences) for each group among the texts that pass the base rule."""
    passed = counted.where(~F.col("base_failed")).select(F.col(lang).alias("g1"), F.col(source).alias("g2"), *BASE)
    by_source = table(sketch(passed, ("g1", "g2")), "sketches")
    by_lang = merge(by_source, ("g1",))
    whole = merge(by_lang, ())
    own, langs, all_ = (quantiles(s, g) for s, g in ((by_source, ("g1", "g2")), (by_lang, ("g1",)), (whole, ())))
    langs = langs.select(F.col("g1").alias("l1"), F.col("n").alias("ln"), *[F.col(f).alias(f"l_{f}") for f in FEATURES])
    all_ = all_.select(*[F.col(f).alias(f"a_{f}") for f in FEATURES])
    joined = own.join(langs, F.col("g1").eqNullSafe(F.col("l1"))).join(F.broadcast(all_))  # one row
    n, ln = F.col("n").cast("double"), F.col("ln").cast("double")
    near = joined.withColumns({f: drawn(F.col(f), n, drawn(F.col(f"l_{f}"), ln, F.col(f"a_{f}"))) for f in FEATURES})
    return near.select("g1", "g2", *[fence(f, F.col(f)) for f in FEATURES])


def count(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with base counts and ``base_failed``."""
    return with_counts(docs.drop("base_failed", "kept"), text).withColumn("base_failed", base_failed())


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` with base counts, ``base_failed`` and ``kept``; rows and other columns stay. Texts are counted twice, for
    the thresholds and for the verdicts, which costs less than a copy of all texts on disk."""
    counted = count(docs, text)
    small = table(counted.select(F.col(lang).alias("lang"), F.col(source).alias("source"), *BASE, "base_failed"), "counted")
    return judge_counted(counted, small, lang, source)


def judge_counted(counted: DataFrame, small: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """What ``count`` gave, with ``kept``. Thresholds come from ``small``, its counts (lang, source, ...) as a written table:
    the optimiser would otherwise copy the counting expressions into every filter on their results."""
    limits = table(thresholds(small).select(*[F.col(c).alias(f"_q_{c}") for c in ("g1", "g2", *FEATURES)]), "thresholds")
    on = F.col(lang).eqNullSafe(F.col("_q_g1")) & F.col(source).eqNullSafe(F.col("_q_g2"))
    if limits.count() <= BROADCAST_GROUPS:
        joined = counted.join(F.broadcast(limits), on, "left")
    else:
        salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
        salted = limits.withColumn("_q_g3", F.explode(salts))
        keyed = counted.withColumn("_q_salt", F.pmod(F.xxhash64(*BASE), F.lit(SALTS)))
        joined = keyed.join(salted, on & (F.col("_q_salt") == F.col("_q_g3")), "left").drop("_q_salt", "_q_g3")
    good = F.lit(True)
    for name, value in features().items():
        limit = F.col(f"_q_{name}")
        good = good & (value <= limit["high"])
        if FEATURES[name][-1]:
            good = good & (value >= limit["low"])
    # one expression, so that no part of it is pushed below the join
    kept = F.when(F.col("base_failed"), False).otherwise(F.coalesce(good, F.lit(False)))
    return joined.withColumn("kept", kept).drop(*limits.columns)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    counted = table(count(docs).drop("text"), "counted")
    return judge_counted(counted, counted).select("doc_id", *BASE, "base_failed", "kept")


SQL = f"""
WITH words AS (
  SELECT doc_id, lang, source, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS w, coalesce(text, '') AS t FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8))
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(next - i, 8))) AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM windows WHERE n > 1) GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS l FROM words) LEFT JOIN covered c USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, CAST(greatest(n_words, 1) AS DOUBLE) AS m, CAST(greatest(n_lines, 1) AS DOUBLE) AS ml FROM counted
), flat AS (
  SELECT doc_id, lang, source, base_failed, unnest(['word_length', 'symbol_ratio', 'dup_line_ratio', 'repeat_ratio']) AS feature,
    unnest([word_chars / m, n_symbols / m, n_dup_lines / ml, n_repeat_words / m]) AS v FROM judged
), slots AS (
  SELECT lang, source, feature, CASE WHEN v <= 0 THEN -100000 ELSE CAST(ceil(ln(v) / ln({GAMMA})) AS INTEGER) END AS slot FROM flat WHERE NOT base_failed
), levels AS (
  SELECT 0 AS level, coalesce('s' || lang, 'n') AS g1, coalesce('s' || source, 'n') AS g2, feature, slot FROM slots
  UNION ALL SELECT 1, coalesce('s' || lang, 'n'), '', feature, slot FROM slots UNION ALL SELECT 2, '', '', feature, slot FROM slots
), sorted AS (
  SELECT level, g1, g2, feature, count(*) AS n, list_sort(list(slot)) AS s FROM levels GROUP BY ALL
), quantiles AS (
  SELECT level, g1, g2, feature, CAST(n AS DOUBLE) AS n, list_transform([0.25, 0.5, 0.75, 0.99], lambda q: CASE WHEN s[CAST(ceil(q * n) AS BIGINT)] = -100000 THEN 0
    ELSE pow({GAMMA}, s[CAST(ceil(q * n) AS BIGINT)]) * {2 / (1 + GAMMA)} END) AS q FROM sorted
), drawn AS (
  SELECT o.g1, o.g2, o.feature, list_transform([1, 2, 3, 4], lambda i: (o.n * o.q[i] + {PRIOR} * ((l.n * l.q[i] + {PRIOR} * a.q[i]) / (l.n + {PRIOR}))) / (o.n + {PRIOR})) AS q
  FROM quantiles o JOIN quantiles l ON l.level = 1 AND l.g1 = o.g1 AND l.feature = o.feature JOIN quantiles a ON a.level = 2 AND a.feature = o.feature WHERE o.level = 0
), bounds AS (
  SELECT g1, g2, feature, q[2] AS middle, CASE feature WHEN 'word_length' THEN greatest(6 * (q[3] - q[1]), 0.3) WHEN 'symbol_ratio' THEN greatest(6 * (q[3] - q[1]), 0.06)
    ELSE greatest(2 * (q[4] - q[2]), 0.1) END AS reach FROM drawn
), chosen AS (
  SELECT f.doc_id, bool_and(f.v <= b.middle + b.reach AND (f.feature <> 'word_length' OR f.v >= b.middle - b.reach)) AS good
  FROM flat f JOIN bounds b ON b.g1 = coalesce('s' || f.lang, 'n') AND b.g2 = coalesce('s' || f.source, 'n') AND b.feature = f.feature GROUP BY f.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, NOT base_failed AND coalesce(good, FALSE) AS kept
FROM judged LEFT JOIN chosen USING (doc_id)
"""
