"""Operators on literal rows: nulls, ties, empty tables and the numeric edge cases of the domain."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoloom.functions import scalars as s
from genoloom.operators import annotations, featureset, groups, intervals, lookups, predict, splice, tissue_features, tracks, variants
from genoloom.schemas import SPLICE_OUTPUT, ddl

VEP = "chrom string, start long, `end` long, ref string, alt string, gene string, transcript string, Consequence struct<stop:boolean,miss:boolean>, LoF struct<HC:boolean>, sift_score float, CADD_RAW float"
ISO = "gene string, transcript string, tissue string, median_transcript_proportions float"


def row(start, transcript, stop, miss=False, sift=None, cadd=None, gene="g", end=None):
    return ("1", start, end or start + 1, "A", "C", gene, transcript, (stop, miss), (stop,), sift, cadd)


@pytest.fixture(scope="module")
def vep(spark):
    return spark.createDataFrame(
        [
            row(1, "t1", True, sift=0.0, cadd=1.5), row(1, "t2", True, sift=0.1, cadd=float("nan")), row(2, "t1", None, None),
            row(3, "t3", False, True, sift=-1.0), row(99, "t1", True, end=180), ("1", 5, 6, "A", "C", None, None, None, None, None, None),
        ],
        VEP,
    )


@pytest.fixture(scope="module")
def iso(spark):
    return spark.createDataFrame([("g", "t1", "liver", 0.5), ("g", "t2", "liver", 0.25), ("g", "t1", "lung", 1.0), ("x", "t9", "skin", 1.0)], ISO)


def flat(df):
    return {(r.start, r.gene, r.tissue): r.features.asDict() for r in df.collect()}


@pytest.mark.parametrize("wide", [0, 256])
def test_forms_agree(spark, monkeypatch, vep, iso, wide):
    monkeypatch.setattr(tissue_features, "WIDE", wide)
    gtf = spark.createDataFrame([("g.1", "t1.1"), ("g.1_PAR", "t1.2"), ("g.2", "t2")], "gene_id string, transcript_id string")
    nulls = iso.union(spark.createDataFrame([("g", "t1", None, 0.7)], ISO))
    some = spark.createDataFrame([(None,), ("liver",)], "tissue string")
    for isoforms, tissues in ((nulls, None), (nulls, some), (iso, some), (nulls, some.where("tissue IS NOT NULL"))):
        got = flat(tissue_features.tissue_features(vep, isoforms, tissues))
        assert got == flat(tissue_features.tissue_features_direct(vep, isoforms, tissues))
        assert all(f["stop.proportion"] == 0 for (_, _, t), f in got.items() if t is None)
    for kw in ({}, {"gtf": gtf}, {"gtf": gtf, "dedupe": True}, {"labels": ["stop", "LoF_HC"]}):
        assert flat(tissue_features.tissue_features(vep, iso, **kw)) == flat(tissue_features.tissue_features_direct(vep, iso, **kw))
    copies = flat(tissue_features.tissue_features(vep, iso, gtf=gtf))
    assert copies[1, "g", "liver"]["stop.sum"] == 3 and copies[1, "g", "liver"]["num_transcripts"] == 3


@pytest.mark.parametrize("wide", [0, 256])
def test_feature_values(monkeypatch, vep, iso, wide):
    monkeypatch.setattr(tissue_features, "WIDE", wide)
    got = flat(tissue_features.tissue_features(vep, iso))
    one = got[1, "g", "liver"]
    assert one["stop.sum"] == 2 and one["stop.proportion"] == 0.75 and one["stop.max"] is True
    assert one["sift_score.pval_max_significant"] == math.inf and one["cadd_raw.max"] == 1.5
    assert got[1, "g", "skin"]["stop.proportion"] == 0
    empty = got[2, "g", "lung"]
    assert empty["stop.max"] is None and empty["stop.sum"] == 0 and empty["num_transcripts"] == 1
    assert got[3, "g", "lung"]["sift_score.pval_max_significant"] is None
    assert (99, "g", "lung") in got  # a row over a former batch border stays
    assert got[5, None, "liver"]["num_transcripts"] == 0
    assert len(got) == 5 * 3


def test_repeated_isoforms_use_the_direct_form(vep, iso):
    twice = iso.union(iso)
    assert not tissue_features.isoforms_are_unique(twice)
    assert flat(tissue_features.tissue_features(vep, twice)) == flat(tissue_features.tissue_features_direct(vep, twice))


def crossed(vep, isoforms, gtf):
    """Tissue features by their definition: each row, as often as annotated, in each tissue, as often as its isoform stands there."""
    copies = [(r.gene_id.split(".")[0], r.transcript_id.split(".")[0]) for r in gtf.collect()]
    isoforms, out = isoforms.collect(), {}
    for r in vep.collect():
        for tissue in {i.tissue for i in isoforms}:
            f = out.setdefault((r.start, r.gene, tissue), {"stop.sum": 0, "stop.proportion": 0.0, "LoF_HC.sum": 0, "num_transcripts": 0})
            found = [i[3] for i in isoforms if None not in i[:3] and (i.gene, i.transcript, i.tissue) == (r.gene, r.transcript, tissue)] or [None]
            for w in found * max(1, copies.count((r.gene, r.transcript))):
                f["num_transcripts"] += r.Consequence is not None
                f["LoF_HC.sum"] += bool(r.LoF and r.LoF.HC)
                if r.Consequence and r.Consequence.stop:
                    f["stop.sum"] += 1
                    f["stop.proportion"] += w or 0.0
    return out


def test_direct_form_by_definition(spark, vep, iso):
    more = [("g", "t1", "liver", 0.25), ("g", "t1", "liver", None), ("g", "t3", "liver", 0.5), ("g", "t3", "liver", 0.5), ("g", "t1", None, 0.5), ("g", "t1", None, 0.5), (None, None, "lung", 0.5)]
    isoforms = iso.union(spark.createDataFrame(more, ISO))
    gtf = spark.createDataFrame([("g.1", "t1.1"), ("g.2", "t1.2"), ("g.2", "t2")], "gene_id string, transcript_id string")
    got = flat(tissue_features.tissue_features_direct(vep, isoforms, gtf=gtf))
    want = crossed(vep, isoforms, gtf)
    assert {k: {x: f[x] for x in want[k]} for k, f in got.items()} == want
    assert got[3, "g", "liver"]["num_transcripts"] == 2 and got[1, "g", "liver"]["stop.sum"] == 7
    unknown = spark.createDataFrame([("g", "t3", "liver", float("nan"))], ISO)
    assert flat(tissue_features.tissue_features_direct(vep, unknown))[3, "g", "liver"]["stop.proportion"] == 0  # t3 isn't a stop


def test_direct_form_crosses_groups_not_rows(vep, iso):
    plan = tissue_features.tissue_features_direct(vep, iso)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = {word: [i for i, line in enumerate(plan) if word in line] for word in ("NestedLoopJoin", "CartesianProduct", "Exchange hashpartitioning")}
    assert len(at["NestedLoopJoin"] + at["CartesianProduct"]) == 1
    assert max(at["NestedLoopJoin"] + at["CartesianProduct"]) < min(at["Exchange hashpartitioning"])  # above whatever is shuffled


def test_empty_tables(spark, vep, iso):
    for f in (tissue_features.tissue_features, tissue_features.tissue_features_direct):
        assert f(vep.limit(0), iso).count() == 0 and f(vep, iso.limit(0)).count() == 0
    assert groups.best_per_group(vep.limit(0).select("chrom", "start"), ["chrom"], "start").count() == 0


def test_scalars(spark):
    df = spark.createDataFrame([(None, None), (0.0, ""), (float("nan"), "0.5,?"), (0.01, "2,1")], "x double, l string")
    got = df.select(s.minus_log10(F.col("x")), s.smallest(s.list_of(F.col("l"), "float")), s.is_usable(F.col("x"), "double")).collect()
    assert [tuple(r) for r in got] == [(None, None, False), (math.inf, None, True), (None, None, False), (2.0, 1.0, True)]
    cells = spark.createDataFrame([("deleterious(0.01)",), ("benign",), (None,), ("a(b)",)], "c string")
    got = cells.select(s.bracket_label(F.col("c")), s.bracket_score(F.col("c")).cast("string")).collect()
    assert [tuple(r) for r in got] == [("deleterious", "0.01"), ("benign", None), (None, None), ("a", None)]
    ids = spark.createDataFrame([("chr1:5:6:A>C>G",), ("chr1:5:6:->T",), ("x",), (None,)], "c string")
    got = [tuple(r) for r in ids.select(*[v.alias(k) for k, v in s.parse_variant_id(F.col("c")).items()]).collect()]
    assert got == [("chr1", 5, 6, "A", "C>G"), ("chr1", 5, 6, "", "T"), (None,) * 5, (None,) * 5]


def test_unparsed_variants_raise(spark):
    bad = spark.createDataFrame([("1", 1, 2, "A", None)], "chrom string, start long, `end` long, ref string, alt string")
    with pytest.raises(ValueError, match="1 of 1"):
        annotations.require_parsed(bad)


def test_parse_annotations_without_optional_columns(spark):
    names = [annotations.ID, "Gene", "Feature", "Feature_type", "Consequence", "IMPACT", "EXON", "AF", "STRAND", "GENE_PHENO"]
    raw = spark.createDataFrame([("1:2:3:A>-", "g", "t", "Transcript", "stop_gained", "HIGH", "3/10", "0.2,x", "-1", "1"), ("x", "g", "t", "Motif", None, None, None, None, None, None)], names)
    got = annotations.parse_annotations(raw).collect()
    assert len(got) == 1 and got[0].alt == "" and got[0].EXON == [None] and got[0].AF is None and got[0].STRAND == -1
    assert got[0].Consequence.stop_gained and not got[0].Consequence.missense_variant and "GENE_PHENO" not in got[0]


def test_lookups(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    names = spark.createDataFrame([("a", "Z"), ("a", "Y"), (None, "N")], "alias string, name string")
    assert sorted(map(str, lookups.replace_by(df, "k", names, "alias", "name").collect())) == sorted(map(str, [*spark.createDataFrame([("Y", 1), ("b", 2), (None, 3)], "k string, v int").collect()]))


def test_best_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", None, 2), ("a", float("nan"), 3), ("b", 2.0, 9), ("b", 2.0, 4), (None, 5.0, 1)], "k string, s double, n int")
    assert sorted(r.n for r in groups.best_per_group(df, ["k"], "s").collect()) == [1, 4]
    assert sorted(r.n for r in groups.best_per_group(df, ["k"], "s", nulls_first=True).collect()) == [2, 4]


def test_predictors(spark):
    from genoloom.schemas import JUNCTION_SCORES, SPLICE_SCORES

    junctions = spark.createDataFrame([("1:5:AC>G", "liver", "j", "p", "s", "E1", "N1", 0.5, 0.1, 3.0, 0.2)], JUNCTION_SCORES)
    sites = spark.createDataFrame([("1:5:AC>G", "N1", 0.9, *[0.1] * 4, None, 1, 1, 1), ("2:7:A>T", "N1", 0.3, *[0.1] * 4, *[1] * 4)], SPLICE_SCORES)
    tissues = spark.createDataFrame([("liver",), ("lung",)], "tissue string")
    out = splice.score_variants(junctions, sites, tissues, lambda d: F.coalesce("delta_logit_psi", F.lit(0.0)).cast("float"))
    assert out.schema.simpleString() == ddl(SPLICE_OUTPUT).simpleString()
    rows = {(r.chrom, r.tissue): r for r in out.collect()}
    assert len(rows) == 4 and rows["1", "liver"].splice_site_is_expressed == 1 and rows["2", "lung"].gene_id == "E1"
    assert rows["1", "liver"].start == 4 and rows["1", "liver"].end == 6
    for a, b in ((junctions.limit(0), sites), (junctions, sites.limit(0)), (junctions.limit(0), sites.limit(0))):
        assert splice.score_variants(a, b, tissues, lambda d: F.lit(None).cast("float")).count() == (4 if b.count() else a.count())


def test_left_alignment(spark):
    chunks = spark.createDataFrame([("1", 0, 1, "GGGCACACACAGGG"), ("1", 1, 1, "GGGCACACACAGGGTTTT"), ("1", 2, 15, "TTTT")], "contig string, chunk long, first long, bases string")
    assert variants.shift_left(9, "ACA", "A", "GGGCACACACAGGG", 1)[:2] == (3, "GCA")
    rows = spark.createDataFrame([("1", 9, "ACA", "A", 1), ("1", 9, "A", "C", 2), ("7", 9, "ACA", "A", 3), ("1", 9, "A", "<DEL>", 4)], "chrom string, pos long, ref string, alt string, k int")
    got = {r.k: (r.pos, r.ref, r.alt) for r in variants.left_align(rows, chunks).collect()}
    assert got == {1: (3, "GCA", "G"), 2: (9, "A", "C"), 3: (9, "ACA", "A"), 4: (9, "A", "<DEL>")}


def test_featuresets(spark):
    a = spark.createDataFrame([("v", "g", "liver", (1.0, 2.0)), ("v", None, "liver", (5.0, 5.0))], "chrom string, gene string, tissue string, features struct<`x.max`:double,y:double>")
    b = spark.createDataFrame([("g", 7.0)], "gene string, z double")
    keys = ["chrom", "gene", "tissue"]
    out = featureset.join_featuresets({"vep": a, "e": b}, {"vep": [{"features": ["x.max"]}], "e": ["z"]}, keys, {"feature.e@z": 0.0})
    assert out.columns == [*keys, "feature.vep@features.x.max", "feature.e@z"]
    assert [tuple(r) for r in out.collect()] == [("v", "g", "liver", 1.0, 7.0)]
    with pytest.raises(ValueError, match="share none"):
        featureset.join_featuresets({"a": spark.createDataFrame([("v", 1)], "chrom string, x int"), "b": spark.createDataFrame([("g", 1)], "gene string, y int")}, {"a": ["x"], "b": ["y"]}, keys)


def test_predict_edges(spark):
    df = spark.createDataFrame([(1, None, None, True), (2, float("nan"), 3, None), (3, 0.5, None, False)], "id int, `f.x` double, n int, b boolean")

    class Sum:
        def predict(self, m):
            return m.sum(axis=1)

    kw = {"features": ["f.x", "n", "b"], "keys": ["id"]}
    assert {r.id: r.s for r in predict.predict(df, Sum(), "s", **kw).collect()} == {1: 1.0, 2: 3.0, 3: 0.5}
    assert {r.id: r.s for r in predict.predict(df, Sum(), "s", required=["f.x"], **kw).collect()} == {1: None, 2: None, 3: 0.5}
    assert predict.predict(df, Sum(), "s", keep_features=False, **kw).columns == ["id", "s"]
    assert predict.predict(df.limit(0), Sum(), "s", **kw).count() == 0
    with pytest.raises(ValueError, match="type string"):
        predict.feature_columns(df.withColumn("t", F.lit("x")), ["t"])


def test_trees_handle_missing_values():
    text = "tree\nfeature_names=a b\nobjective=binary sigmoid:1\n\nTree=0\nnum_leaves=2\nnum_cat=0\nsplit_feature=0\nthreshold=1\ndecision_type=10\nleft_child=-1\nright_child=-2\nleaf_value=-1 1\n\nTree=1\nnum_leaves=1\nnum_cat=0\nsplit_feature=\nthreshold=\ndecision_type=\nleft_child=\nright_child=\nleaf_value=0.5\n\n"
    got = predict.TreeEnsemble(text).predict(np.array([[0.0, 0], [2.0, 0], [np.nan, 0]], np.float32))
    assert np.allclose(got, 1 / (1 + np.exp(-np.array([-0.5, 1.5, -0.5]))))


def test_tracks_and_windows(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0],), ([1.0, 2.0],), ([],), (None,)], "t array<double>")
    assert [r[0] for r in df.select(tracks.central_mean(F.col("t"), 3)).collect()] == [3.0, 1.5, None, None]
    genes = spark.createDataFrame([("1", 100, "+"), ("1", 100, "-")], "chrom string, tss long, strand string")
    points = spark.createDataFrame([("1", 49), ("1", 50), ("1", 300), ("1", 301), ("2", 100), ("1", -100)], "chrom string, start long")
    for width in (1, 37, 10_000):
        got = intervals.range_join(points, intervals.strand_window(genes), "chrom", "start", width=width)
        assert sorted((r.start, r.strand) for r in got.collect()) == [(-100, "-"), (49, "-"), (50, "+"), (50, "-"), (300, "+")]
    with pytest.raises(ValueError):
        tracks.over_isoforms(df, [], [], "other")
    with pytest.raises(ValueError, match="allele type"):
        tracks.sequence_requests("both", genes)
    assert tracks.sequence_requests("reference", genes, shift=0).count() == 2 and tracks.sequence_requests("alternative", genes, points).count() == 15
    kinds = spark.createDataFrame([("A", "C"), ("AC", "GT"), ("A", "AT"), ("A", "<DEL>"), ("a", "A"), ("A", "."), (None, "A")], "ref string, alt string")
    got = [r.info_TYPE for r in variants.with_tags(kinds.withColumn("pos", F.lit(5))).collect()]
    assert got == ["SNP", "MNP", "INDEL", "OTHER", "REF", "REF", None]


def test_lookup_size_is_bounded_in_bytes(spark):
    df = spark.range(10).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("t"))
    hinted = lambda d: "hint" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(lookups.small(df)) and not hinted(lookups.small(df, size=5000)) and not hinted(lookups.small(df, rows=9))


def test_variant_ids_with_further_marks(spark):
    import re

    ids = ["HLA-A*01:01:5:6:A>C", "1:5:6:A>G]17:198982]", "1:5:6:A>C>G", "1:5:6:>A>C", "1:5:6:A>", ":5:6:A>C", "1:x:6:A>C", "1:5:6:A C>G", "1:5:6:<DEL>>T", " 1:5:6:A>C"]
    df = spark.createDataFrame([(i,) for i in ids], "c string")
    got = [tuple(r) for r in df.select(*[v.alias(k) for k, v in s.parse_variant_id(F.col("c")).items()]).collect()]
    for i, row in zip(ids, got):
        found = re.search(s.VARIANT_ID, i)
        assert row == ((found[1], int(found[2]), int(found[3]), found[4], found[5]) if found else (None,) * 5), i
