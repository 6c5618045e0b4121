import math
import re
from collections import Counter, defaultdict

import pytest

from genoloom.llm import quality

SF = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines))


def failed(c):
    return c[0] < 20 or 100 * c[4] > 30 * c[0]


def ratios(c):
    n = max(1, c[0])
    return dict(zip(quality.FEATURES, (c[1] / n, c[2] / n, c[3] / max(1, c[5]), c[4] / n)))


def brute(rows):
    """Verdicts from plain loops: the same sketch, in dictionaries."""
    of = [(lang, source, counts(text)) for text, lang, source in rows]
    slot = lambda x: -100_000 if x <= 0 else math.ceil(math.log(x) / math.log(quality.GAMMA))
    held = defaultdict(list)
    for lang, source, c in of:
        if not failed(c):
            for group in ((lang, source), (lang,), ()):
                held[group].append(ratios(c))

    def own(group, name):
        slots = sorted(slot(r[name]) for r in held[group])
        value = lambda k: 0.0 if k == -100_000 else quality.GAMMA**k * 2 / (1 + quality.GAMMA)
        return len(slots), {q: value(slots[math.ceil(q * len(slots)) - 1]) for q in (0.25, 0.5, 0.75, 0.99)}

    def fence(lang, source, name):
        q = own((), name)[1]
        for group in ((lang,), (lang, source)):
            n, mine = own(group, name)
            q = {k: (n * mine[k] + quality.PRIOR * q[k]) / (n + quality.PRIOR) for k in q}
        if name in ("word_length", "symbol_ratio"):
            reach = max(6 * (q[0.75] - q[0.25]), 0.3 if name == "word_length" else 0.06)
        else:
            reach = max(2 * (q[0.99] - q[0.5]), 0.1)
        return q[0.5] - reach, q[0.5] + reach

    cache, out = {}, []
    for lang, source, c in of:
        kept = not failed(c)
        if kept:
            for name, value in ratios(c).items():
                if (lang, source, name) not in cache:
                    cache[lang, source, name] = fence(lang, source, name)
                low, high = cache[lang, source, name]
                kept &= value <= high and (value >= low or name != "word_length")
        out.append((*c, failed(c), kept))
    return out


@pytest.mark.parametrize("broadcast, prior", [(20_000, 200), (0, 30)])
def test_against_plain_loops(spark, monkeypatch, broadcast, prior):
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", broadcast)
    monkeypatch.setattr(quality, "PRIOR", prior)
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = [tuple(r)[1:] for r in quality.op5_quality_rules(spark, SF).orderBy("doc_id").collect()]
    want = brute([(r.text, r.lang, r.source) for r in rows])
    assert [g[:7] for g in got] == [w[:7] for w in want]
    # a value on a bucket's edge may round to either side of it
    assert sum(g != w for g, w in zip(got, want)) <= 2


def test_edge_rows(spark):
    word = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None, None, None, 5), (2, "", "en", None, 5), (3, word, None, "s", 5), (3, word, None, "s", 5), (4, "a b c d e f g h " * 60, "en", "s", 5), (5, "\x0b\x0c \r\n", "en", "s", 5)]
    docs = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, lang string, source string, N_WORDS int, g1 int, word_length int")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert not got[1].kept and not got[2].kept and got[3].kept and got[4].base_failed and got[5].n_words == 0
    assert got[4].n_repeat_words == 480 and got[3].n_repeat_words == 0
    assert quality.judge(docs.limit(0)).count() == 0


def test_every_fence_decides_and_follows_its_group(spark, monkeypatch):
    """Two sources of different habits: what is usual in one stands out in the other, beyond the base rule."""
    monkeypatch.setattr(quality, "PRIOR", 20)

    def text(i, long=4, marks=0, dups=0, words=120):
        own = [f"{chr(97 + i % 26) * (long - 2)}{chr(97 + k // 26)}{chr(97 + k % 26)}" + "#" * (k < marks) for k in range(words)]
        lines = [" ".join(own[k : k + 6]) for k in range(0, words, 6)]
        for d in range(dups):  # apart, so that no run of words repeats
            lines += [lines[0], f"uu{d} vv{d} ww{d}"]
        return "\n".join(lines)

    rows = [(i, text(i), "en", "a") for i in range(400)]
    rows += [(1000 + i, text(i, long=4 + i % 5, marks=10 * (i % 4), dups=i % 3), "en", "b") for i in range(400)]
    odd = {"long": text(3, long=8), "marks": text(3, marks=25), "dups": text(3, dups=4)}
    rows += [(2000 + k, t, "en", s) for k, (t, s) in enumerate((t, s) for t in odd.values() for s in "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    judged = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(judged[i].kept for i in range(400)) and sum(judged[1000 + i].kept for i in range(400)) >= 396
    seen = [(judged[2000 + k].kept, judged[2000 + k].base_failed) for k in range(6)]
    assert seen == [(False, False), (True, False)] * 3 and not any(judged[2000 + k].base_failed for k in range(6))
