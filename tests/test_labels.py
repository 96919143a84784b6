from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from endmark.functions import labels
from endmark.operators import checks
from endmark.plans import profiles
from endmark.sources import readers, sinks


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_names(spark):
    assert one(spark, labels.comparison_title(F.lit("drug_vs_ctrl"))) == "drug vs ctrl"
    assert one(spark, labels.plural(F.lit(1), "gene")) == "1 gene" and one(spark, labels.plural(F.lit(12345), "gene")) == "12,345 genes"
    assert one(spark, labels.wrapped_name(F.lit("abc_def-ghi"), 30)) == "abc_def-ghi"
    assert one(spark, labels.wrapped_name(F.lit("abc_def-ghi"), 8)) == "abc_def-\nghi"
    assert one(spark, labels.wrapped_name(F.lit("abcdefghijk_l"), 4)) == "abcdefghijk_\nl"
    assert one(spark, labels.wrapped_name(F.lit(""), 4)) == ""
    assert one(spark, labels.wrapped_name(F.lit("a-b-c-d-e"), 4)) == "a-b-\nc-d-\ne" and one(spark, labels.wrapped_name(F.lit("--..__"), 3)) == "--.\n.__"
    assert one(spark, labels.wrapped_name(F.lit("x_averylongpart_y"), 5)) == "x_\naverylongpart_\ny" and one(spark, labels.wrapped_name(F.lit("plain"), 2)) == "plain"
    d = spark.createDataFrame([("ctl_1", "ctl"), ("drug.2", "drug")], "sample_id string, condition string")
    assert [r.label for r in labels.sample_labels(d).orderBy("sample_id").collect()] == ["1", "2"]
    d = d.union(spark.createDataFrame([("drug3", "drug")], d.schema))
    assert [r.label for r in labels.sample_labels(d).orderBy("sample_id").collect()] == ["ctl_1", "drug.2", "drug3"]
    assert labels.sample_labels(d.limit(0)).count() == 0


def test_finite_and_nearest(spark):
    d = spark.createDataFrame([(float("nan"), 2.0), (float("inf"), float("nan")), (3.0, 1.0), (None, None), (5.0, 0.0)], "a double, b double")
    assert d.agg(labels.median_finite(F.col("a"))).first()[0] == 4.0
    assert [r.x for r in d.select(labels.first_finite(F.col("a"), F.col("b")).alias("x")).collect()] == [2.0, None, 3.0, None, 5.0]
    peaks = F.array(F.lit(4), F.lit(8))
    assert [one(spark, labels.nearest_of(F.lit(v), peaks)) for v in (0, 6, 7, 99)] == [4, 4, 8, 8]


def test_fields(spark):
    d = spark.createDataFrame([("a", "SE", "x"), ("b", "", None), ("c", "pe", "")], "sample_id string, layout string, batch string")
    got = {(r.sample_id, r.field, r.problem) for r in checks.sample_fields(d, ("batch", "age")).collect()}
    assert got == {("c", "layout", "invalid"), ("b", "batch", "missing"), ("c", "batch", "missing"), (None, "age", "no_column")}
    s = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "sample_id string, condition string")
    with pytest.raises(ValueError, match="y=1"):
        checks.replicates(s)
    assert {r.sample_id: r.exploratory for r in checks.replicates(s, policy="warn").collect()} == {"a": False, "b": False, "c": True}


def test_intervals_and_totals(spark):
    schema = "comparison string, gene_id string, feature_id string, delta_pau_ci_low string, delta_pau_ci_high string, bootstrap_successes string, bootstrap_perturbed string, bootstrap_status string"
    rows = [("C", "g", "p1", "0.1", "0.2", "9", "1", "ok"), ("C", "g", "p2", "0.3", "0.2", "9", "10", "ok"), ("C", None, "p3", "NA", "0.2", "x", "0", "odd"), ("C", "g", "p1", "", "", "0", "0", "disabled")]
    got = sorted((r.feature_id, r.problem) for r in checks.bootstrap_intervals(spark.createDataFrame(rows, schema)).collect())
    assert got == [("p1", "repeated"), ("p2", "bounds"), ("p2", "perturbed"), ("p3", "counts"), ("p3", "no_key"), ("p3", "status")]
    t = spark.createDataFrame([("a", "s", 1.0), ("a", "s", 2.0), ("b", "s", 0.5), ("c", "s", -1.0), ("d", "s", float("nan")), ("e", "s", 3e9), ("f", "s", None)], "gene_id string, sample_id string, count double")
    assert sorted(r.gene_id for r in checks.bootstrap_totals(t).collect()) == ["b", "c", "d", "e", "f"]


def test_profiles():
    assert profiles.resolved("plasmidsaurus_3prime", layout="auto", strandedness="reverse") == {"library_profile": "plasmidsaurus_3prime", "layout": "SE", "strandedness": "reverse", "evidence_source": "read_3p", "endpoint_model": "proximal_tag"}
    assert profiles.sources("exact_boundary", "auto") == ("polyA_junction", "fragment_3p", "read_3p")
    assert profiles.sources("generic_3prime", "auto") == ("read_3p", "read_5p", "polyA_junction")
    assert profiles.sources("plasmidsaurus_3prime", "PE") == ("read_3p",)
    with pytest.raises(ValueError, match="unknown library profile"):
        profiles.resolved("other")


def test_scan_files(spark, tmp_path):
    ev = spark.createDataFrame([("s", "c", "+", 5, 2)], "sample_id string, contig string, strand string, coordinate long, count long")
    con = spark.createDataFrame([("s", "c", "+", 1, 5, 9, 12, 3)], readers.CONTINUATION)
    at = sinks.write_scan(str(tmp_path), "s", "SE", "forward", {"read_3p": (ev, [("kept", 2), ("duplicate", 1)])}, (con, [("kept", 3)]))
    got = readers.read_scan(spark, at)
    assert got["layout"] == "SE" and list(got["sources"]["read_3p"]["filtering"]) == ["kept", "duplicate"]
    assert spark.read.parquet(got["sources"]["read_3p"]["table"]).collect() == ev.collect()
    assert spark.read.parquet(got["splice"]["table"]).collect() == con.collect()
    (tmp_path / "s.read_3p.parquet").rename(tmp_path / "gone")
    with pytest.raises(ValueError, match="s.read_3p.parquet"):
        readers.read_scan(spark, at)
    sinks.write_continuations(con, str(tmp_path / "c.tsv.gz"))
    assert readers.read_continuations(spark, [str(tmp_path / "c.tsv.gz")] * 2).collect() == con.collect() * 2
    assert readers.read_continuations(spark, []).count() == 0
    (tmp_path / "ends.tsv").write_text("contig\tstrand\tcoordinate\tgene_id\nc\t+\t7\tg\n")
    assert [tuple(r) for r in readers.read_transcript_ends(spark, str(tmp_path / "ends.tsv")).collect()] == [("c", "+", 7, "g")]
    sinks.write_r_tsv(spark.createDataFrame([(1.5, None), (float("nan"), "b")], "x double, y string").coalesce(1), str(tmp_path / "r.tsv"), ["x", "y"])
    import gzip

    assert gzip.open(tmp_path / "r.tsv.gz", "rt").read() == "x\ty\n1.5\t\n\tb\n"
    mark = sinks.fingerprint(str(tmp_path / "ends.tsv"))
    sinks.check_fingerprint(str(tmp_path / "ends.tsv"), mark)
    with pytest.raises(ValueError, match="changed"):
        sinks.check_fingerprint(str(tmp_path / "ends.tsv"), mark | {"source_size": 1})
