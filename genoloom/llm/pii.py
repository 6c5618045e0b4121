"""Personal data by weak supervision, in DataFrame functions only.

1. Base spans: e-mail addresses, IP addresses, card and phone numbers by pattern and check (parts at most 255, Luhn,
   number of digits), leftmost and non-overlapping for each kind. They always stay.
2. Candidates: every match of the base patterns, valid or not, and of looser ones (addresses spelt with "(at)", IP addresses
   with marked dots, cards grouped by other marks, numbers without a plus sign).
3. Labelers vote on each candidate: the kind's check, a strict shape, a gazetteer (top-level domains, special address ranges,
   card issuers, calling and area codes), words before it, the characters before and after it. A vote is yes, no or abstains.
4. Expectation-maximisation over the histogram of vote patterns (at most 4 * 2 * 3 ** 6 * 3 rows, whatever the corpus)
   estimates how often each labeler is right and the probability of each pattern; a logistic span classifier over kind,
   votes and digits is fitted to those probabilities. Both are sums over that histogram.
5. Loose candidates to which the classifier gives a probability of ``ACCEPT`` or more are added, unless they touch a base span
   or begin inside an earlier one of their own. Matches that fail their base check only tell labelers' reliabilities.

Scale: everything but the histogram stays inside a row, so long texts, hot sources and copies cause no shuffle of their
own. Work is in proportion to a text's length, however many matches it holds: positions and overlaps come from running sums
and maxima taken block by block (``running``), contexts from the gaps between matches, and redaction cuts a form of the text
with four bytes a character, in which any place is found at once. The patterns are written so that no text makes them
backtrack: a match starts at the first character of its run, and repeats are possessive or bounded.

Defined results: null and empty texts have no spans; positions are code points, ends exclusive; spans are in order of
start, then kind; with no candidate at all nothing is added; equal texts, equal spans; the words before a match reach back
``CONTEXT`` characters, but not beyond the match of the same pattern before it; columns of the input named like an output are
replaced, those named like a working column (``_p_...``) are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, table

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ACCEPT = 0.8
ROUNDS = 40

_LOCAL = "A-Za-z0-9._%+-"
#: Base patterns. ``(?<!x)|\\G`` starts a run where it starts or where the last match ended.
PATTERNS = (
    rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_DOT = r" ?(?:\(dot\)|\[dot\]|\{dot\}|\[\.\]|\(\.\)) ?"
#: Looser patterns: (kind, pattern, what a text must hold for it to be tried).
LOOSE = (
    (
        EMAIL,
        rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]{{1,64}}+ ?(?:\(at\)|\[at\]|\{{at\}}) ?[A-Za-z0-9-]{{1,63}}(?:(?:{_DOT}|\.)[A-Za-z0-9-]{{2,63}}){{1,4}}",
        r"[(\[{]at[)\]}]",
    ),
    (IP, rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", r"[(\[{](?:dot|\.)[)\]}]"),
    (CARD, r"(?<![0-9A-Za-z./_-])[0-9]{4}(?:(?:[./_]| - )[0-9]{4}){3}(?![0-9A-Za-z/_-])", r"[0-9]{4}[./_ ]"),
    (PHONE, r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){1,3}(?![0-9]|\.[0-9])", r"\+[0-9]"),
    (PHONE, r"(?<![0-9A-Za-z(+@.:/=_-])(?<!\+[0-9]{1,3}[ .-])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9A-Za-z@_-]|\.[0-9])", r"[0-9][ .)-]"),
)
#: What a match of each kind looks like in full, once spelt marks are written plainly.
SHAPES = (
    r"^[A-Za-z0-9][^@]*@[^@]*\.[A-Za-z]{2,24}$",
    r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    r"^[3-6](?:[0-9]{11,18}|[0-9]{3}(?:(?:[ ./_-]| - )[0-9]{4}){3})$",
    r"^(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,5}){1,5}|(?:\(0[0-9]{1,4}\)|0[0-9]{1,4})(?:[ .-]?[0-9]{2,5}){1,4}|(?:\([2-9][0-9]{2}\)|[2-9][0-9]{2})[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4})$",
)
#: The gazetteer. Common top-level domains; special-purpose address ranges and first parts that no host has;
#: issuer prefixes of cards by length; assigned calling codes (plus sign), trunk zero and North American area codes (without).
DOMAINS = "com org net edu gov mil int info biz name io co me tv eu uk de fr es it nl be ch at pt pl cz se no fi dk ie gr hu ro ru ua tr il in cn jp kr tw hk sg au nz ca us mx br ar cl za test example invalid local"
LISTED = (
    rf"(?i)\.(?:{DOMAINS.replace(' ', '|')})$",
    r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|169\.254|192\.0\.2|198\.51\.100|203\.0\.113|100\.(?:6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7]))\.",
    r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|(?:5[1-5]|22[2-9]|2[3-6]|27[01]|2720)[0-9]*|3[47][0-9]{13}|(?:6011|65|64[4-9]|62|35[2-8])[0-9]*|3(?:0[0-5]|[68])[0-9]*)$",
    r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-8]|2[2-6][0-9]|29[0179]|3[578][0-9]|42[013]|50[0-9]|59[0-9]|67[0-9]|68[0-9]|69[0-2]|85[0-6]|88[0-6]|96[0-8]|97[0-7]|99[2-8])|\(?0[1-9]|\(?[2-9][0-8][0-9]\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}$)",
)
UNLISTED = (
    r"(?i)\.(?:png|jpe?g|gif|svg|py|js|txt|html?|css|json|xml)$",
    r"^(?:0|22[4-9]|2[3-5][0-9]|[3-9][0-9]{2})\.",
    r"^[01789]",
    r"^(?:\+0|\(?1[0-9]|[0-9]{2}[ .-][0-9]{2}[ .-][0-9]{2}$)",
)
WORDS = (
    r"e-?mail|contact|courriel|correo|kontakt|write to|schreib",
    r"\bip\b|host|server|addr|client|gateway|log",
    r"card|visa|master|amex|karte|carte|tarjeta|credit|konto",
    r"phone|\btel|call|fax|mobil|cell|handy|portable|whatsapp|sms",
)
AGAINST = r"version|licen[sc]e|isbn|issn|order|invoice|page|chapter|section|release|build|rows?|\bid\b|\bno\b|[#$€£§v]$"
#: Numbers that look like calendar dates.
DATE = r"^(?:(?:19|20)[0-9]{2}[ .-][0-9]{1,2}[ .-][0-9]{1,2}|[0-9]{1,2}[ .-][0-9]{1,2}[ .-](?:19|20)?[0-9]{2})$"
CONTEXT = 32

FOUND = "array<struct<start:int,end:int,m:string,left:string,right:string>>"
SPAN = "struct<start:int,kind:int,end:int>"
#: Values that a running sum takes one by one; longer arrays are taken in blocks, blocks of blocks and so on.
BLOCK = 128
DEEPEST = 3


def once(value: Column, use) -> Column:
    """``use(value)`` with the value made once: what a lambda takes from outside of it is made again for each element,
    unless it is a column or a lambda's own variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, op, zero: int, depth: int = DEEPEST) -> Column:
    """For each of an array's integers ``op`` over all before it, from ``zero``; ``op`` is associative. A plain fold copies
    its result for each value, so only blocks are folded, and then their totals in the same way."""

    def folded(block: Column) -> Column:
        start = F.struct(F.lit(zero).alias("run"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, start, lambda a, x: F.struct(op(a["run"], x).alias("run"), F.concat(a["out"], F.array(a["run"])).alias("out")))

    if not depth:
        return folded(values)["out"]

    def joined(blocks: Column) -> Column:
        ahead = running(F.transform(blocks, lambda b: b["run"]), op, zero, depth - 1)
        return F.flatten(F.zip_with(blocks, ahead, lambda b, h: F.transform(b["out"], lambda v: op(h, v))))

    def cut(own: Column) -> Column:
        ends = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int")))
        blocks = F.transform(ends, lambda k: folded(F.slice(own, k * BLOCK + 1, F.lit(BLOCK))))
        return F.when(F.size(own) <= BLOCK, folded(own)["out"]).otherwise(once(blocks, joined))

    return once(values, cut)


def matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern (start, end, match, what is left and right of it), from them and the gaps between them."""

    def row(x: Column, at: Column) -> Column:
        first = at + F.length(x["g"])
        return F.struct(
            first.alias("start"), (first + F.length(x["m"])).alias("end"), x["m"].alias("m"),
            F.lower(F.right(F.concat(F.right(x["p"], F.lit(CONTEXT)), x["g"]), F.lit(CONTEXT))).alias("left"),
            F.left(F.concat(x["h"], F.coalesce(x["n"], F.lit(""))), F.lit(2)).alias("right"),
        )

    def placed(each: Column) -> Column:
        sizes = F.transform(each, lambda x: F.length(x["g"]) + F.length(x["m"]))
        return F.zip_with(each, running(sizes, lambda a, b: a + b, 0), row)

    def beside(found: Column, gaps: Column) -> Column:
        """For each match: the match before it, the gap before it, itself, the gap after it, the match after it."""
        before = F.concat(F.array(F.lit("")), found)
        rest = F.slice(gaps, F.lit(2), F.size(found)), F.slice(found, F.lit(2), F.size(found))
        names = zip(("p", "g", "m", "h", "n"), (F.slice(before, F.lit(1), F.size(found)), F.slice(gaps, F.lit(1), F.size(found)), found, *rest))
        return F.arrays_zip(*[c.alias(n) for n, c in names])

    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.struct(found.alias("found"), gaps.alias("gaps"))
    return once(both, lambda z: once(beside(z["found"], z["gaps"]), placed))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    each = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: int, m: Column) -> Column:
    if kind == IP:
        return F.forall(F.split(m, r"\."), lambda x: F.coalesce(x.try_cast("int") <= 255, F.lit(False)))
    n = F.length(digits(m))
    if kind == CARD:
        return F.when(n.between(12, 19), luhn(digits(m))).otherwise(False)
    return n.between(9, 15) if kind == PHONE else F.lit(True)


def vote(yes: Column, no: Column) -> Column:
    """2 yes, 0 no, 1 abstains."""
    return F.when(yes, 2).when(no, 0).otherwise(1)


def plainly(m: Column) -> Column:
    """A spelt address with its marks."""
    return F.regexp_replace(F.regexp_replace(m, r" ?[(\[{]at[)\]}] ?", "@"), _DOT, ".")


def candidates(kind: int, found: Column, loose: bool) -> Column:
    """Candidates of one kind with their votes."""

    def row(x: Column) -> Column:
        m = plainly(x["m"]) if loose and kind in (EMAIL, IP) else x["m"]
        own = F.lit(False) if loose else valid(kind, x["m"])
        if not loose:
            check = F.when(own, 2).otherwise(0)
        else:
            check = F.when(valid(kind, m), 2).otherwise(0) if kind in (IP, CARD) else F.lit(1)
        size = F.length(digits(x["m"]))
        listed = digits(m) if kind == CARD else m
        return F.struct(
            x["start"].alias("start"),
            F.lit(kind).alias("kind"),
            x["end"].alias("end"),
            F.lit(int(loose)).alias("loose"),
            own.alias("valid"),
            check.alias("v_check"),
            vote(m.rlike(SHAPES[kind]) & ~m.rlike(DATE), F.lit(True)).alias("v_shape"),
            vote(listed.rlike(LISTED[kind]), listed.rlike(UNLISTED[kind])).alias("v_listed"),
            vote(x["left"].rlike(WORDS[kind]), x["left"].rlike(AGAINST)).alias("v_words"),
            vote(x["left"].rlike(r"(^|[\s(\[:,;<\"'])$"), x["left"].rlike(r"[\w=./@#-]$")).alias("v_before"),
            vote(x["right"].rlike(r"^([\s)\]:,;>!?\"']|$|\.(\s|$))"), x["right"].rlike(r"^[\w=/@#.-]")).alias("v_after"),
            F.when(size < 7, 0).when(size <= 15, 1).otherwise(2).alias("size"),
        )

    return F.transform(found, row)


VOTES = ("v_check", "v_shape", "v_listed", "v_words", "v_before", "v_after")
PATTERN = ("kind", "loose", *VOTES, "size")


def with_candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the array ``_p_found`` of all candidates. Each step is a projection, so matches aren't made twice."""
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(FOUND)
    has = {EMAIL: F.contains(body, F.lit("@")), PHONE: F.contains(body, F.lit("+"))}
    plans = [(k, p, has.get(k, F.col("_p_digit")), False) for k, p in enumerate(PATTERNS)]
    plans += [(k, p, body.rlike(g) if k == EMAIL else F.col("_p_digit") & body.rlike(g), True) for k, p, g in LOOSE]
    step = df.withColumn("_p_digit", body.rlike("[0-9]"))
    step = step.withColumns({f"_p_m{i}": F.when(ok & body.rlike(p), matches(body, p)).otherwise(none) for i, (_, p, ok, _) in enumerate(plans)})
    arrays = [candidates(k, F.col(f"_p_m{i}"), loose) for i, (k, _, _, loose) in enumerate(plans)]
    return step.withColumn("_p_found", F.concat(*arrays)).drop("_p_digit", *[f"_p_m{i}" for i in range(len(plans))])


# --- expectation-maximisation and the span classifier, over the pattern histogram --------------


def posteriors(rows: list[dict]) -> list[float]:
    """Probability that a candidate is personal data for each vote pattern (with its count ``n``): a two-class
    model in which labelers err independently, fitted by expectation-maximisation from the share of yes votes."""
    cast = [[r[v] for v in VOTES] for r in rows]
    p = [(1 + sum(v == 2 for v in vs)) / (2 + sum(v != 1 for v in vs)) for vs in cast]
    for _ in range(ROUNDS):
        total = sum(r["n"] for r in rows)
        prior = (1 + sum(r["n"] * q for r, q in zip(rows, p))) / (2 + total)
        rates = []
        for k in range(len(VOTES)):
            # weak prior observations, and a labeler's yes is never taken to speak against a candidate
            yes = [(r["n"], q, vs[k]) for r, q, vs in zip(rows, p, cast) if vs[k] != 1]
            true = (2 + sum(n * q for n, q, v in yes if v == 2)) / (3 + sum(n * q for n, q, _ in yes))
            false = (1 + sum(n * (1 - q) for n, q, v in yes if v == 2)) / (3 + sum(n * (1 - q) for n, q, _ in yes))
            rates.append((true, min(false, true)))
        for i, vs in enumerate(cast):
            odds = math.log(prior / (1 - prior))
            for v, (true, false) in zip(vs, rates):
                if v != 1:
                    odds += math.log(true / false) if v == 2 else math.log((1 - true) / (1 - false))
            p[i] = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
    return p


def span_classifier(rows: list[dict], p: list[float]) -> dict[tuple[str, int], float]:
    """Weights of (feature, value) of a logistic model fitted to the posteriors by gradient steps; ("", 0) is the bias."""
    weights: dict[tuple[str, int], float] = {("", 0): 0.0}
    total = sum(r["n"] for r in rows)
    keys = [[("", 0), *[(f, r[f]) for f in PATTERN]] for r in rows]
    for ks in keys:
        weights.update(dict.fromkeys(ks, 0.0))
    for _ in range(400):
        pull = dict.fromkeys(weights, 0.0)
        for r, q, ks in zip(rows, p, keys):
            z = sum(weights[k] for k in ks)
            error = r["n"] * (q - 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))) / total
            for k in ks:
                pull[k] += error
        for k in weights:
            weights[k] += 1.0 * (pull[k] - 1e-4 * weights[k])
    return weights


def fit(found: DataFrame) -> dict[tuple[str, int], float]:
    """The span classifier from all candidates in the column ``_p_found``."""
    flat = found.select(F.explode("_p_found").alias("f")).select(*[F.col(f"f.{x}") for x in PATTERN])
    rows = [r.asDict() for r in flat.groupBy(*PATTERN).agg(F.count(F.lit(1)).alias("n")).collect()]  # bounded
    rows.sort(key=lambda r: tuple(r[x] for x in PATTERN))
    return span_classifier(rows, posteriors(rows)) if rows else {}


def probability(c: Column, weights: dict[tuple[str, int], float]) -> Column:
    z = F.lit(weights.get(("", 0), -40.0))
    for (name, value), w in weights.items():
        if name:
            z = z + F.when(c[name] == value, w).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def with_spans(found: DataFrame, weights: dict[tuple[str, int], float]) -> DataFrame:
    """``found`` with the arrays ``base`` and ``spans`` of (start, kind, end)."""
    span = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    more = F.filter("_p_found", lambda c: (c["loose"] == 1) & (probability(c, weights) >= ACCEPT))
    step = found.withColumns(
        {"base": F.sort_array(F.transform(F.filter("_p_found", lambda c: c["valid"]), span)), "_p_more": F.transform(more, span)}
    )
    # Base and loose spans in order, base first where they start together: a loose one is alone if no base span before it
    # reaches over its start and none after it starts before its end.
    marked = lambda c, own: F.transform(c, lambda x: F.struct(x["start"].alias("start"), F.lit(own).alias("own"), x["kind"].alias("kind"), x["end"].alias("end")))
    both = F.sort_array(F.concat(marked("base", 0), marked("_p_more", 1)))
    step = step.withColumn("_p_both", F.when(F.size("_p_more") > 0, both).otherwise(F.slice(both, F.lit(1), F.lit(0))))
    far = 2**31 - 1
    reached = running(F.transform("_p_both", lambda x: F.when(x["own"] == 0, x["end"]).otherwise(0)), F.greatest, 0)
    next_ = F.reverse(running(F.reverse(F.transform("_p_both", lambda x: F.when(x["own"] == 0, x["start"]).otherwise(far))), F.least, far))
    step = step.withColumn("_p_both", F.arrays_zip(F.col("_p_both").alias("x"), reached.alias("r"), next_.alias("n")))
    alone = F.filter("_p_both", lambda z: (z["x"]["own"] == 1) & (z["r"] <= z["x"]["start"]) & (z["n"] >= z["x"]["end"]))
    step = step.withColumn("_p_more", F.transform(alone, lambda z: span(z["x"])))
    reached = running(F.transform("_p_more", lambda x: x["end"]), F.greatest, 0)
    step = step.withColumn("_p_more", F.arrays_zip(F.col("_p_more").alias("x"), reached.alias("r")))
    first = F.transform(F.filter("_p_more", lambda z: z["r"] <= z["x"]["start"]), lambda z: z["x"])
    spans = F.when(F.size("_p_more") > 0, F.sort_array(F.concat("base", first))).otherwise(F.col("base"))
    return step.withColumn("spans", spans).drop("_p_more", "_p_both", "_p_found")


def detect(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``base`` and ``spans``. Without its text, the table of candidates is written once for fitting and
    adding; with it, candidates are made again instead, which costs less than a copy of all texts on disk."""
    found = with_candidates(df, text)
    if not keep_text:
        found = table(found.drop(text), "candidates")
    return with_spans(found, fit(found))


def with_redacted(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with each span of ``text`` replaced by its kind in brackets. Spans that overlap are replaced as one, under the
    kind of the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    reached = running(F.transform(spans, lambda s: s["end"]), F.greatest, 0)
    step = df.withColumn("_p_each", F.arrays_zip(F.col(spans).alias("s"), reached.alias("r")))
    last = F.array_max(F.transform(spans, lambda s: s["end"]))

    def clean(wide: Column) -> Column:
        cut = lambda a, n: F.decode(F.substring(wide, 4 * a + 1, 4 * n), "UTF-32")

        def piece(z: Column) -> Column:
            gap = z["s"]["start"] - z["r"]
            return F.when(gap >= 0, F.concat(cut(z["r"], gap), F.element_at(names, z["s"]["kind"] + 1))).otherwise("")

        tail = once(last, lambda at: cut(at, (F.octet_length(wide) / 4).cast("int") - at))
        return F.concat(F.array_join(F.transform("_p_each", piece), ""), tail)

    # a binary column would be copied for each span; a lambda's variable isn't
    shown = once(F.encode(F.col(text), "UTF-32"), clean)
    return step.withColumn(text, F.when(F.size(spans) > 0, shown).otherwise(F.col(text))).drop("_p_each")


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = detect(documents(spark, sf_dir, "doc_id", "text"), keep_text=False)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    digest = F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return done.select("doc_id", *map(count, range(4)), digest, written(F.col("spans")).alias("spans"))
