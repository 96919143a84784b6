from __future__ import annotations

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from endmark.operators import annotation as a

EXONS = "gene_id string, transcript_id string, contig string, strand string, start long, end long, line_no int"


def test_gene_names(spark):
    d = spark.createDataFrame([("g", "exon", "Old", 1), ("g", "gene", None, 2), ("g", "gene", "New", 3), ("h", "exon", "H", 4), ("i", "exon", None, 5), (None, "exon", "x", 6)], "gene_id string, type string, gene_name string, line_no int")
    assert {r.gene_id: r.gene_name for r in a.gene_names(d).collect()} == {"g": "New", "h": "H", "i": "i"}


def test_terminal_exons(spark):
    rows = [("g", "t1", "c", "+", 0, 10, 1), ("g", "t1", "c", "+", 20, 30, 2), ("g", "t1", "c", "+", 90, 100, 3), ("g", "t2", "c", "+", 0, 10, 4), ("g", "t2", "c", "+", 25, 40, 5), ("g", "t3", "c", "+", 95, 120, 6), ("g", "t5", "c", "+", 50, 60, 9), ("m", "t4", "c", "-", 200, 210, 7), ("m", "t4", "c", "-", 230, 240, 8)]
    got = a.terminal_exons(spark.createDataFrame(rows, EXONS)).collect()
    # t2 ends inside an internal exon of t1; t3 and t5 are single exons of a spliced gene, t5 apart from all its spliced exons; t4 ends at its lowest exon
    assert sorted((r.transcript_id, r.start) for r in got) == [("t1", 90), ("t3", 95), ("t4", 200)]


def test_assignment(spark):
    sites = spark.createDataFrame([("p1", "c", "+", 95), ("p2", "c", "+", 5), ("p3", "c", "+", 50), ("p4", "c", "+", 150), ("p5", "c", "-", 50), ("p6", "c", "+", 9000)], "pac_id string, contig string, strand string, coordinate long")
    exons = spark.createDataFrame([("g", "t1", "c", "+", 0, 10, 1), ("g", "t1", "c", "+", 90, 100, 2)], EXONS)
    genes = spark.createDataFrame([("g", "c", "+", 0, 100), ("h", "c", "+", 60, 100), ("far", "c", "+", 0, 20)], "gene_id string, contig string, strand string, start long, end long")
    got = a.assigned_genes(sites, a.terminal_exons(exons), exons, genes, 500)
    assert sorted((r.pac_id, r.gene_id or "", r.region or "") for r in got.collect()) == [
        ("p1", "g", "last_exon"), ("p2", "g", "internal_exon"), ("p3", "g", "intron"), ("p4", "g", "downstream_of_gene"), ("p4", "h", "downstream_of_gene"), ("p5", "", ""), ("p6", "", "")]
    loci = spark.createDataFrame([("c", "+", "g", "L1", 90, 100)], "contig string, strand string, gene_id string, locus string, start long, end long")
    assert {r.pac_id: r.last_exon_locus for r in a.last_exon_locus(got, loci).collect()}["p1"] == "L1"


def test_priming_confidence_labels(spark):
    d = spark.createDataFrame([("AAAAAAAC",), ("CGCGCG",)], "w string")
    assert [r[0] for r in d.select(a.priming(F.col("w"))).collect()] == [True, False]
    t, f = F.lit(True), F.lit(False)
    got = spark.range(1).select(a.confidence(t, f, f, t, F.lit(3)), a.confidence(f, f, t, t, F.lit(3)), a.confidence(f, f, f, t, F.lit(2)), a.confidence(f, f, f, t, F.lit(1))).first()
    assert tuple(got) == ("low", "moderate", "high", "moderate")
    r = a.labels(spark.createDataFrame([("c", "+", 7)], "contig string, strand string, coordinate long"), "x1").first()
    assert (r.pac_id, r.locus, r.browser_interval) == ("PACv1.x1.c.+.7", "c:7:+", "c:7-8")


def test_motif_usage(spark):
    pau = spark.createDataFrame([("g", "a", "S", 30), ("g", "b", "S", 10), ("g", "c", "S", 60), ("h", "d", "S", 50), ("k", "e", "S", 20), ("k", "f", "S", 20), ("u", "x", "S", 90), ("u", "y", "S", 90), ("u", "x", "R", 3), ("u", "y", "R", 3)], "gene_id string, pac_id string, sample_id string, count long")
    pau = pau.withColumn("gene_total", F.sum("count").over(Window.partitionBy("gene_id", "sample_id")))
    motifs = spark.createDataFrame([("a", "M", False), ("b", "N", False), ("c", "M", True), ("d", "M", False), ("e", "M", False), ("f", "M", False), ("x", "M", False), ("y", "N", False)], "pac_id string, motif string, rescued boolean")
    # c is rescued, but counts for the gene's depth; u has too few reads in R, and so counts nowhere
    got = {r.motif: (r.score, r.genes) for r in a.motif_usage(pau, motifs).collect()}
    assert got["M"] == (pytest.approx(math.asin(math.sqrt((0.75 + 1) / 2))), 2) and got["N"] == (pytest.approx(math.asin(0.5)), 1)


def test_strandedness(spark):
    exons = spark.createDataFrame([("c", "+", "g", 0, 1000), ("c", "-", "h", 900, 2000)], "contig string, strand string, gene_id string, start long, end long")
    reads = spark.createDataFrame([(k, "c", k, k + 50, "+" if k % 10 else "-") for k in range(0, 800)] + [(9000, "c", 920, 950, "-")], "read_id long, contig string, start long, end long, read_strand string")
    r = a.strandedness(reads, exons).first()
    assert (r.n, r.forward, r.protocol) == (800, pytest.approx(0.9), "forward")


def row(gene, pac, at, region, locus, c, t, up=False, down=False, fup=False, fdown=False, fdr=0.01):
    return (gene, pac, "+", at, region, locus, c, t, fdr, up or down or fup or fdown, up, down, fup, fdown)


def test_apa_patterns(spark):
    rows = [
        row("short", "s1", 100, "last_exon", "L", 0.2, 0.7, up=True), row("short", "s2", 200, "last_exon", "L", 0.8, 0.3, down=True),
        row("ale", "a1", 100, "last_exon", "A", 0.7, 0.2, down=True), row("ale", "a2", 900, "last_exon", "B", 0.3, 0.8, up=True),
        row("intr", "i1", 50, "intron", None, 0.1, 0.6, up=True), row("intr", "i2", 200, "last_exon", "L", 0.9, 0.4, down=True),
        row("flag", "f1", 50, "intron", None, 0.1, 0.6, fup=True), row("flag", "f2", 200, "last_exon", "L", 0.9, 0.4),
        row("quiet", "q1", 100, "last_exon", "L", 0.2, 0.7), row("quiet", "q2", 200, "last_exon", "L", 0.8, 0.3),
        row("weak", "w1", 100, "last_exon", "L", 0.5, 0.55, up=True), row("weak", "w2", 200, "last_exon", "L", 0.5, 0.45),
        row("null", "n1", 100, "last_exon", "L", None, 0.7, up=True), row("null", "n2", 200, "last_exon", "L", 0.8, 0.3),
    ]
    schema = "gene_id string, pac_id string, strand string, coordinate long, region string, last_exon_locus string, control_fit double, treatment_fit double, gene_fdr double, called boolean, up boolean, down boolean, flagged_up boolean, flagged_down boolean"
    out = {r.gene_id: r for r in a.apa_patterns(spark.createDataFrame(rows, schema)).collect()}
    assert {g: r.pattern for g, r in out.items()} == {
        "short": "utr_shortening", "ale": "alternative_last_exon", "intr": "intronic_gain", "flag": "intronic_gain_potential_internal_priming", "quiet": "none", "weak": "unclassified_change", "null": "none"}
    assert out["short"].delta_utr_distal_share == pytest.approx(-0.5) and out["ale"].last_exon_switch == pytest.approx(0.5)
    assert out["intr"].delta_intronic_share == pytest.approx(0.5) and out["null"].delta_utr_distal_share is None


def test_shift_regions(spark):
    d = spark.createDataFrame([("last_exon", "intron", "proximal")], "from_region string, to_region string, direction string")
    out = a.shift_region_counts(d)
    assert out.count() == 32 and out.agg(F.sum("n")).first()[0] == 1
