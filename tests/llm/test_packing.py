from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from genoloom.llm import packing
from tests.llm.test_pipeline import check_batches


def padding(histogram, edges):
    return sum((next(e for e in edges if e >= n) - n) * c for n, c in histogram.items())


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
def test_boundaries_are_optimal(histogram, k):
    got = packing.boundaries(histogram, k)
    top = max(histogram)
    rest = [n for n in histogram if n != top]
    best = min(padding(histogram, sorted([*some, top])) for r in range(min(k, len(histogram))) for some in combinations(rest, r))
    assert len(got) <= k and got[-1] == top and padding(histogram, got) == best


def test_no_lengths():
    assert packing.boundaries({}) == []


def test_pieces_and_edge_rows(spark):
    rows = [(1, None, 0), (2, " ", 0), (3, "w " * 25, 0), (3, "w " * 25, 0), (None, "a b", 0), (4, "w " * 9, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, batch int")
    out = packing.pack(docs, max_len=10, n_buckets=2, budget=30, range_rows=2).collect()
    check_batches(out, 30)
    got = sorted((str(r.doc_id), r.piece, r.start, r.n_tokens) for r in out)
    three = [("3", 0, 0, 10), ("3", 1, 10, 10), ("3", 2, 20, 6)]
    assert got == sorted([("1", 0, 0, 1), ("2", 0, 0, 1), *three, *three, ("None", 0, 0, 3), ("4", 0, 0, 10)])
    again = packing.pack(docs.repartition(3), max_len=10, n_buckets=2, budget=30, range_rows=2).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert packing.pack(docs.limit(0)).count() == 0


def test_a_key_of_most_rows(spark):
    rows = [(None if i % 3 else i, "w " * (i % 4)) for i in range(3000)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), max_len=4, n_buckets=3, budget=40, range_rows=50).collect()
    check_batches(out, 40)
    assert len(out) == 3000 and sum(r.doc_id is None for r in out) == 2000
