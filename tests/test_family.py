from __future__ import annotations

import numpy as np
import pytest

from endmark.operators import family as f
from endmark.plans import parameters, report


def sheet(*rows):
    return [dict(zip(("sample_id", "condition", "batch"), r, strict=True)) for r in rows]


def test_layout():
    s = sheet(("a", "C", "1"), ("b", "C", "2"), ("c", "T", "1"), ("d", "T", "2"), ("e", "B", "1"))
    got = f.family_layout(s, "C", ("batch",))
    assert got.groups == ["C", "B", "T"] and got.columns == ["intercept", "batch=2", "B", "T"] and got.exploratory
    with pytest.raises(ValueError, match="rank"):
        f.family_layout(sheet(("a", "C", "1"), ("b", "C", "1"), ("c", "T", "2"), ("d", "T", "2")), "C", ("batch",))


def test_bootstrap_bookkeeping(spark):
    d = spark.createDataFrame([("g", 0.01, False, True), ("h", 0.9, True, True), ("i", 0.01, True, False), ("j", None, None, True)], "gene_id string, gene_fdr double, candidate boolean, eligible boolean")
    assert sorted(r.gene_id for r in f.bootstrap_genes(d).collect()) == ["g", "h"]
    sites = spark.createDataFrame([("a", "pending", "gained"), ("b", "skipped", "none")], "pac_id string, bootstrap_status string, event_type string")
    ci = spark.createDataFrame([("a", -0.1, 0.2)], "pac_id string, low double, high double")
    out = {r.pac_id: (r.bootstrap_status, r.low) for r in f.with_intervals(sites, ci, ["pac_id"]).collect()}
    assert out == {"a": ("done", -0.1), "b": ("skipped", None)}
    assert [r.pac_id for r in f.calls(sites).collect()] == ["a"]
    with pytest.raises(ValueError, match="no interval"):
        f.with_intervals(sites, ci.limit(0), ["pac_id"])
    with pytest.raises(ValueError, match="no pending"):
        f.with_intervals(sites, ci.union(spark.createDataFrame([("z", 0.0, 0.0)], ci.schema)), ["pac_id"])


def test_source_choice():
    assert f.choose_source({"a": [0.1]}, explicit="b") == "b"
    assert f.choose_source({"a": [0.95, 0.9], "b": [0.5]}) == "a"
    with pytest.raises(ValueError, match="reproducible"):
        f.choose_source({"a": [0.3]})
    with pytest.raises(ValueError, match="close"):
        f.choose_source({"a": [0.9], "b": [0.9]})


def test_kernels():
    w = np.array([1, 2, 3, 2, 1, 0, 2, 0]) / 11
    assert f.kernel_modes(w, -2) == [0, 4]
    assert f.resolution(np.array([0.25] * 4), 0.5) == 2 and f.resolution(np.array([1.0])) == 1
    assert f.pile_shift(w, -10, 3) == -3


def test_sites_and_samples(spark):
    sites = spark.createDataFrame([("c", "+", 100), ("c", "-", 100)], "contig string, strand string, coordinate long")
    donors = spark.createDataFrame([("c", "+", 72)], "contig string, strand string, coordinate long")
    kept, rejected = f.internal_ends(sites, donors, 10, 2)
    assert [r.strand for r in kept.collect()] == ["-"] and [r.strand for r in rejected.collect()] == ["+"]
    rows = spark.range(100)
    assert sorted(r.id for r in f.keyed_sample(rows, "id", 7).collect()) == sorted(r.id for r in f.keyed_sample(rows.repartition(5), "id", 7).collect())
    d = spark.createDataFrame([("g", 1, 5, 9), ("h", 2, 1, 0)], "gene_id string, offset int, count int, poly_a_clip_count int")
    assert [tuple(r) for r in f.eligible_genes(d, 3).collect()] == [("g", 1, 5, 5)]
    assert f.support_text(0.5) == "supporting_sample_fraction<0.5" and f.support_text(2) == "supporting_samples<2"


def test_checksums(spark):
    s = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "ordinal int, sample_id string, path string")
    m = spark.createDataFrame([("a", "p", "11"), ("b", "q", "22")], "sample_id string, path string, sha256 string")
    assert [r.sha256 for r in f.completed_checksums(s, m).orderBy("ordinal").collect()] == ["11", "22"]
    with pytest.raises(Exception, match="no single checksum"):
        f.completed_checksums(s, m.limit(1)).collect()


def test_parameters_and_report(spark, tmp_path):
    (tmp_path / "p.yaml").write_text("seed_radius: '7'\nalpha: 0.1\n")
    s = parameters.load(str(tmp_path / "p.yaml"), alpha="0.2")
    assert (s.seed_radius, s.alpha) == (7, 0.2) and '"alpha": 0.2' in parameters.resolved(s)
    for wrong in ({"alpha": "nan"}, {"seed_radius": 1.5}, {"nothing": 1}):
        with pytest.raises(ValueError):
            parameters.load(**wrong)
    page = report.html_report("T<", {"a": spark.createDataFrame([("x<y", None)], "a string, b string")})
    assert "T&lt;" in page and "x&lt;y" in page and "<table>" in page
