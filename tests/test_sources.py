"""Readers, writers, configuration, the whole plan and the stream, on small files."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoloom.plans import config, pipeline
from genoloom.schemas import SPLICE_OUTPUT, ddl
from genoloom.sources import genome, sinks, text_tables
from genoloom.streaming import files

VCF = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n1\t5\t.\tA\tC,<DEL>\t.\tPASS\tEND=9;SVTYPE=DEL\n1\t7\trs1\tac\tG\t3.5\t.\t.\n"


def test_vcf(spark, tmp_path):
    with gzip.open(tmp_path / "a.vcf.gz", "wt") as f:
        f.write(VCF)
    rows = genome.read_vcf(spark, str(tmp_path / "a.vcf.gz")).orderBy("pos").collect()
    assert (rows[0].info_END, rows[0].info_SVTYPE, rows[0].id, rows[1].qual, rows[1].vcf_file) == (9, "DEL", None, 3.5, "a.vcf.gz")
    table = genome.as_variant_table(genome.read_vcf(spark, str(tmp_path / "a.vcf.gz")))
    sinks.write_parquet(table, f"{tmp_path}/chrom=1/v.parquet")
    assert "chrom" not in text_tables.parquet(spark, f"{tmp_path}/chrom=1").columns
    assert text_tables.variant_files(spark, str(tmp_path)).count() == 1


def test_gtf_and_fasta(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('# c\nchr1\ts\ttranscript\t11\t20\t.\t+\t.\tgene_id "g.1"; transcript_id "t.2"; tag "a"; tag "b"; transcript_type "x";\nchr1\ts\texon\t1\t2\t.\t+\t.\tgene_id "g.1";\n')
    (row,) = genome.transcripts(genome.read_gtf(spark, f"{tmp_path}/a.gtf")).collect()
    assert (row.Start, row.gene_id, row.tag, row.transcript_biotype) == (10, "g.1", "a,b", "x")
    (tmp_path / "a.fa").write_text(">1 first\nacgt\nACGT\n>2\nTT\n")
    got = sorted(map(tuple, genome.read_fasta(spark, f"{tmp_path}/a.fa", piece=3).collect()))
    assert got == [("1", 0, 1, "ACG"), ("1", 1, 1, "ACGTAC"), ("1", 2, 4, "TACGT"), ("2", 0, 1, "TT")]
    (tmp_path / "a.fai").write_text("1\t8\t9\t4\t5\n")
    assert [tuple(r) for r in genome.read_fai(spark, f"{tmp_path}/a.fai").collect()] == [("1", 0, 9)]


def test_tables(spark, tmp_path):
    (tmp_path / "v.tsv").write_text("## x\n#Uploaded_variation\tA\tA\n1:2:3:A>C\t-\tq\n1:2:3:A>C\t\t\"\n")
    assert text_tables.unique_names(["A", "A", "B", "A"]) == ["A", "A_2", "B", "A_3"]
    rows = text_tables.read_annotations(spark, f"{tmp_path}/v.tsv").collect()
    assert [(r.A, r.A_2) for r in rows] == [(None, "q"), (None, '"')]
    (tmp_path / "s.csv").write_text("x,gene_name,variant,delta_score,acceptor_gain,acceptor_loss,donor_gain,donor_loss,acceptor_gain_position,acceptor_loss_position,donor_gain_position,donor_loss_position\n9,N,1:2:A>C,0.5,,,,,,,,\n")
    (row,) = text_tables.splice_scores(spark, f"{tmp_path}/s.csv").collect()
    assert row.variant == "1:2:A>C" and row.acceptor_gain_position is None
    (tmp_path / "b.csv").write_text("variant,gene_name\n")
    with pytest.raises(ValueError, match="lacks"):
        text_tables.splice_scores(spark, f"{tmp_path}/b.csv")
    (tmp_path / "alias.tsv").write_text("#alias\tchrom\n1\tchr1\n")
    assert text_tables.chromosome_aliases(spark, f"{tmp_path}/alias.tsv").first() == ("1", "chr1")
    (tmp_path / "Liver_sites_psi5.csv").write_text("junction\nj\n")
    assert tuple(text_tables.splice_maps(spark, f"{tmp_path}/*_sites_*.csv", "_sites").first()) == ("j", "Liver", "psi5")


def test_sinks(spark, tmp_path):
    empty = spark.createDataFrame([], "chrom string, score double")
    sinks.write_schema(empty, f"{tmp_path}/e", ddl(SPLICE_OUTPUT))
    assert spark.read.parquet(f"{tmp_path}/e").columns == ddl(SPLICE_OUTPUT).names
    df = spark.createDataFrame([("2", 5, 6, "A", "C"), ("1", 7, 8, "G", "T")], "chrom string, start long, `end` long, ref string, alt string")
    sinks.write_vcf(df, f"{tmp_path}/v", ["##fileformat=VCFv4.2"])
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/v").collect()]
    assert lines[0].startswith("##") and lines[1].startswith("#CHROM") and lines[2] == "1\t8\t1:7:8:G>T\tG\tT\t.\t.\tEND=8"
    sinks.write_parquet(df.withColumn("n", F.lit(None)), f"{tmp_path}/p", sort=["chrom", "start"], by=["chrom"])
    assert text_tables.parquet(spark, f"{tmp_path}/p", partitions=True).where("chrom = 1").count() == 1
    sinks.write_csv(df, f"{tmp_path}/c")
    assert spark.read.csv(f"{tmp_path}/c", header=True).count() == 2


def test_config():
    base = {"a": {"x": 1, "y": [1], "z": {"k": 1}}, "b": 2, "e": {}}
    both = config.Settings(base, {"a": {"y": [2], "z": {}}, "b": {"n": 0}}, None, {"c": 3, "a": {"x": {"m": None}}})
    assert both.nested() == {"a": {"y": [2], "z": {"k": 1}, "x": {"m": None}}, "e": {}, "b": {"n": 0}, "c": 3} and base["a"]["y"] == [1]
    assert both["a.z"] == {"k": 1} and both.get("a.q", 7) == 7
    with pytest.raises(KeyError, match="a.x.m, nothing"):
        both.require("c", "a.x.m", "nothing")
    made = config.Settings({"out": "{root}/o", "root": "{base.dir}/r", "n": 3, "files": ["{out}/{{vcf}}.p", "{later}", 5]})
    assert made.resolved(base={"dir": "/d"}).nested() == {"out": "/d/r/o", "root": "/d/r", "n": 3, "files": ["/d/r/o/{vcf}.p", "{later}", 5]}
    assert config.Settings({"a": "{b}x", "b": "{a}"}).resolved().nested() == {"a": "{b}x", "b": "{a}"}
    paths = ["in/a.vcf", "in/b.txt", "out/c.vcf"]
    assert config.outputs_for(paths, "in/{f}", "o/{f}.gz", {"f": r".+\.vcf"}) == ["o/a.vcf.gz"]
    with pytest.raises(ValueError):
        config.assembly("hg17", {})
    with pytest.raises(FileNotFoundError):
        config.required_files(["/nowhere/x"])
    assert config.has_nmd(108) and not config.has_nmd(104)


def test_yaml_files(tmp_path):
    (tmp_path / "d.yaml").write_text("dirs:\n  out: '{RESULTS_DIR}/x'\n  keep: [1, 2]\n")
    (tmp_path / "s.yaml").write_text("")
    (tmp_path / "u.yaml").write_text("dirs: {keep: [3]}\n")
    read = config.Settings.read(tmp_path / "d.yaml", tmp_path / "s.yaml", tmp_path / "u.yaml").resolved(RESULTS_DIR="/r")
    read.write(tmp_path / "o.yaml")
    assert config.read_yaml(tmp_path / "o.yaml") == {"dirs": {"out": "/r/x", "keep": [3]}} == read.nested()
    (tmp_path / "features.yaml").write_text("- feature.e@Cells%20-%20x.missing\n- plain\n")
    (tmp_path / "set.yaml").write_text("variables:\n  vep:\n  - features: [a.max]\n  e:\nrequired_features: [plain]\nfill_values:\n")
    spec = config.ModelSpec.read("m", tmp_path / "set.yaml", tmp_path / "features.yaml", tissues=["liver"])
    assert spec == config.ModelSpec("m", ["feature.e@Cells - x.missing", "plain"], {"vep": [{"features": ["a.max"]}], "e": []}, ["plain"], tissues=["liver"])


def test_whole_plan(spark):
    names = ["#Uploaded_variation", "Gene", "Feature", "Feature_type", "Consequence", "IMPACT", "LoF", "CADD_RAW"]
    raw = spark.createDataFrame([("1:5:6:A>C", "g", "t", "Transcript", "stop_gained", "HIGH", "HC", "1.5"), ("1:7:8:A>C", "h", "t", "Transcript", "stop_gained", "HIGH", None, None)], names)
    iso = spark.createDataFrame([("g", "t", "liver", 0.5)], "gene string, transcript string, tissue string, median_transcript_proportions float")
    expression = spark.createDataFrame([("g", "all", "liver", True, 2.0)], "gene string, tissue_type string, tissue string, gene_is_expressed boolean, median_expression float")
    spec = config.ModelSpec("m", ["feature.vep@features.stop_gained.proportion", "median_expression"], {"vep": [{"features": ["stop_gained.proportion", "cadd_raw.max"]}]}, cutoffs={"low": 3.0}, tissues=["liver"])

    class Sum:
        def predict(self, m):
            return m.sum(axis=1)

    out = pipeline.run(pipeline.Inputs(raw, iso, expression), spec, Sum())
    (row,) = out.collect()
    assert (row.start, row.tissue_type, row.m) == (5, "all", 2.5)
    assert pipeline.called(out, spec, "low").count() == 1
    assert np.isfinite(row.m)


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.vcf").write_text(VCF)
    for expected in (2, 4):
        files.write_stream(files.stream_variants(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == expected
        (tmp_path / "in/b.vcf").write_text(VCF)
