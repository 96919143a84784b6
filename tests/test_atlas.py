from __future__ import annotations

from endmark.plans import atlas
from endmark.sources import readers


def test_atlas(spark, tmp_path):
    seq = list("C" * 400)
    seq[80:86] = "AATAAA"
    seq[300:312] = "A" * 12
    (tmp_path / "g.fa").write_text(">c\n" + "".join(seq) + "\n")
    chunks = readers.read_fasta(spark, str(tmp_path / "g.fa"), 100)
    features = spark.createDataFrame([("g", None, "gene", "c", "+", 0, 310, 1), ("g", "t", "exon", "c", "+", 0, 50, 2), ("g", "t", "exon", "c", "+", 90, 110, 3)],
                                     "gene_id string, transcript_id string, type string, contig string, strand string, start long, end long, line_no int")
    clusters = spark.createDataFrame([("c", "+", 101, 50, 3), ("c", "+", 300, 20, 3), ("c", "+", 20, 20, 1), ("c", "-", 200, 20, 3)], "contig string, strand string, coordinate long, total long, samples long")
    known = spark.createDataFrame([("c", "+", 103), ("c", "+", 25)], "contig string, strand string, coordinate long")
    out = {r.coordinate: r for r in atlas.annotate(clusters, features, chunks, [("AATAAA", "canonical", 1)], known, "x", chunk_width=100).collect()}
    assert len(out) == 4
    a, b, c, d = (out[k] for k in (101, 300, 20, 200))
    assert (a.gene_id, a.region, a.last_exon_locus, a.primary_motif, a.confidence, a.known_sites, a.site_rank, a.n_sites) == ("g", "last_exon", "c:91-110", "AATAAA", "high", [103], 2, 3)
    assert (b.region, b.internal_priming_flag, b.confidence, b.primary_motif) == ("intron", True, "low", "no_recognized_motif")
    assert (c.region, c.confidence, c.site_rank) == ("internal_exon", "moderate", 1)
    assert (d.gene_id or "", d.site_rank) == ("", None) and a.pac_id == "PACv1.x.c.+.101"


def test_files_to_atlas(spark, tmp_path):
    """GTF, FASTA, motif and BED files through the readers and the command to the atlas; the FASTA, motifs and exons are read as files give them."""
    seq = list("C" * 400)
    seq[80:86], seq[85:91] = "AATAAA", "ATTAAA"
    (tmp_path / "g.fa").write_text(">c some words\n" + "".join(seq[:250]) + "\n" + "".join(seq[250:]) + "\n")
    gtf = [("gene", 1, 310, 'gene_id "g"; gene_name "Zed";'), ("gene", 1, 310, 'gene_id "g"; gene_name "Able";'), ("exon", 1, 50, 'gene_id "g"; transcript_id "t";'), ("exon", 91, 110, 'gene_id "g"; transcript_id "t";')]
    (tmp_path / "g.gtf").write_text("# made\n" + "".join(f"c\tx\t{kind}\t{a}\t{b}\t.\t+\t.\t{attributes}\n" for kind, a, b, attributes in gtf))
    (tmp_path / "m.tsv").write_text("motif\tclass\tpriority\nATTAAA\tvariant\t2\nAATAAA\tcanonical\t1\n")
    (tmp_path / "k.bed").write_text("c\t0\t103\tk\t0\t+\n")
    clusters = spark.createDataFrame([("c", "+", 101, 50, 3), ("c", "+", 20, 20, 1)], "contig string, strand string, coordinate long, total long, samples long")
    clusters.write.parquet(str(tmp_path / "clusters"))
    from endmark.__main__ import parser

    a = parser().parse_args(["annotate", "--clusters", str(tmp_path / "clusters"), "--fasta", str(tmp_path / "g.fa"), "--annotation", str(tmp_path / "g.gtf"), "--motifs", str(tmp_path / "m.tsv"), "--known", str(tmp_path / "k.bed"),
                             "--assembly", "x", "--out", str(tmp_path / "atlas")])
    a.of(spark, a)
    out = {r.coordinate: r for r in spark.read.parquet(str(tmp_path / "atlas")).collect()}
    first, second = out[101], out[20]
    assert (first.gene_id, first.gene_name, first.region, first.last_exon_locus, first.primary_motif, first.primary_motif_class, first.confidence, first.known_sites) == ("g", "Zed", "last_exon", "c:91-110", "AATAAA", "canonical", "high", [103])
    assert [h.motif for h in first.motif_hits] == ["AATAAA", "ATTAAA"] and (second.region, second.gene_name) == ("internal_exon", "Zed")
