from __future__ import annotations

import gzip
import struct

import pytest
from pyspark.sql import functions as F

from endmark.functions import records, sequences
from endmark.sources import bam, readers, sinks


def put(path, text):
    path.write_text(text)
    return str(path)


def test_tsv(spark, tmp_path):
    at = put(tmp_path / "t.tsv", "id\tx\tok\n01\t1.5\tTrue\nNA\tbad\t\n")
    assert [tuple(r) for r in readers.read_tsv(spark, at).collect()] == [("01", "1.5", "True"), ("NA", "bad", "")]
    typed = readers.read_typed(spark, at, ["id", "x"], ("x",), ("ok",)).collect()
    assert [tuple(r) for r in typed] == [("01", 1.5, True), (None, None, None)]
    with pytest.raises(ValueError, match="missing columns: y"):
        readers.read_typed(spark, at, ["y"])
    with gzip.open(tmp_path / "z.tsv.gz", "wt") as f:
        f.write("a\tb\n1\t2\n")
    assert readers.read_tsv(spark, str(tmp_path / "z.tsv.gz")).first().b == "2"


GTF = 'c1\ts\tgene\t1\t100\t.\t+\t.\tgene_id "G1"; gene_name "Alpha";\nc1\ts\texon\t11\t20\t.\t+\t.\tgene_id "G1"; transcript_id "T1";\n# note\nc2\ts\texon\t5\t9\t.\t.\t.\tgene_id "G2";\n'
GFF = "c1\ts\tpseudogene\t1\t100\t.\t-\t.\tID=g1;Name=Beta\nc1\ts\tmRNA\t1\t90\t.\t-\t.\tID=t1;Parent=g1,g9\nc1\ts\texon\t5\t9\t.\t-\t.\tID=e1;Parent=t1\nc1\ts\tCDS\t5\t9\t.\t-\t.\tParent=t1\n"


def test_features(spark, tmp_path):
    gtf = readers.resolve_features(readers.read_features(spark, put(tmp_path / "a.gtf", GTF)))
    assert sorted(tuple(r) for r in gtf.collect()) == [("c1", "exon", 10, 20, "+", "G1", "T1", "Alpha", 2), ("c1", "gene", 0, 100, "+", "G1", None, "Alpha", 1)]
    gff = readers.resolve_features(readers.read_features(spark, put(tmp_path / "a.gff3", GFF))).collect()
    assert {(r.type, r.gene_id, r.transcript_id, r.gene_name) for r in gff} == {("gene", "g1", None, "Beta"), ("mRNA", "g1", "t1", "Beta"), ("exon", "g1", "t1", "Beta"), ("CDS", "g1", None, "Beta")}
    assert [r.contig for r in readers.annotated_contigs(readers.read_features(spark, str(tmp_path / "a.gtf"))).collect()] == ["c1"]
    with pytest.raises(Exception, match="nine fields"):
        readers.read_features(spark, put(tmp_path / "bad.gtf", "c1\tx\n")).collect()
    with pytest.raises(Exception, match="no gene"):
        readers.resolve_features(readers.read_features(spark, put(tmp_path / "b.gff3", "c1\ts\texon\t5\t9\t.\t-\t.\tID=e1;Parent=t7\n"))).collect()
    deep = "c1\ts\tgene\t1\t100\t.\t-\t.\tID=p0\n" + "".join(f"c1\ts\tregion\t1\t90\t.\t-\t.\tID=p{k};Parent=p{k - 1}\n" for k in range(1, 11)) + "c1\ts\texon\t5\t9\t.\t-\t.\tParent=p10\n"
    assert {r.gene_id for r in readers.resolve_features(readers.read_features(spark, put(tmp_path / "d.gff3", deep))).collect()} == {"p0"}
    ring = "".join(f"c1\ts\tregion\t1\t90\t.\t-\t.\tID=r{k};Parent=r{(k + 1) % 3}\n" for k in range(3))
    with pytest.raises(ValueError, match="cycle"):
        readers.resolve_features(readers.read_features(spark, put(tmp_path / "c.gff3", ring)))


def test_line_numbers_over_splits_and_files(spark, tmp_path):
    texts = {"b.txt": [f"b{k}" for k in range(500)], "a.txt": ["first", "", "# third"] + [f"a{k} " + "x" * (k % 7) for k in range(700)]}
    (tmp_path / "in").mkdir()
    for name, lines in texts.items():
        put(tmp_path / "in" / name, "\n".join(lines) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        got = readers.numbered_lines(spark, str(tmp_path / "in")).orderBy("line_no").collect()
        assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [(r.line_no, r.value) for r in got] == list(enumerate(texts["a.txt"] + texts["b.txt"], 1))


def test_the_first_record_in_the_file_counts(spark, tmp_path):
    """Repeated ids: the first is the parent. Names: the first gene record's, not the least."""
    gff = "c\ts\tgene\t1\t9\t.\t+\t.\tID=g1;Name=Zeta\nc\ts\tgene\t1\t9\t.\t+\t.\tID=g1;Name=Alpha\n"
    gff += "".join(f"c\ts\tmRNA\t1\t9\t.\t+\t.\tID=t;Parent=g{k}\n" for k in (1, 2)) + "c\ts\tgene\t1\t9\t.\t+\t.\tID=g2\nc\ts\texon\t1\t9\t.\t+\t.\tParent=t\n"
    got = readers.resolve_features(readers.read_features(spark, put(tmp_path / "r.gff3", gff))).filter("type = 'exon'").collect()
    assert [(r.gene_id, r.gene_name, r.line_no) for r in got] == [("g1", "Zeta", 6)]


def test_sites_motifs_aliases_kernel(spark, tmp_path):
    bed = readers.read_known_sites(spark, put(tmp_path / "k.bed", "c1\t5\t9\tn\t0\t-\nc1\t5\t9\n#x\nc1\t5\nc1\t5\t9\tn\t0\t-\n"))
    assert sorted(tuple(r) for r in bed.collect()) == [("c1", "+", 9), ("c1", "-", 5)]
    catalogue = "motif\tclass\tpriority\n# own\nATTAAA\tvariant\t2\n\naataaa\tcanonical\t1\nAAGAAA\tother\n"
    assert readers.read_motifs(spark, put(tmp_path / "m.tsv", catalogue)) == [("AATAAA", "canonical", 1), ("ATTAAA", "variant", 2), ("AAGAAA", "other", 3)]
    with gzip.open(tmp_path / "m.tsv.gz", "wt") as f:
        f.write(catalogue)
    assert len(readers.read_motifs(spark, str(tmp_path / "m.tsv.gz"))) == 3
    for line, why in (("AAAA\tx", "line 2: not a motif of six bases"), ("AAUAAA\tx", "six bases"), ("AATAAA", "a class is needed"), ("AATAAA\tx\tfirst", "whole number"), ("motif\tclass", "six bases")):
        with pytest.raises(ValueError, match=why):
            readers.read_motifs(spark, put(tmp_path / "n.tsv", f"ATTAAA\tvariant\n{line}\n"))
    assert [tuple(r) for r in readers.read_aliases(spark, put(tmp_path / "a.tsv", "alias\ttarget\nchr1\t1\n")).collect()] == [("chr1", "1")]
    sparse = spark.createDataFrame([(-1, 0.25), (2, 0.75)], "offset long, weight double")
    assert [tuple(r) for r in readers.densify_kernel(sparse).orderBy("offset").collect()] == [(-1, 0.25), (0, 0.0), (1, 0.0), (2, 0.75)]


def test_fasta_windows(spark, tmp_path):
    chunks = readers.read_fasta(spark, put(tmp_path / "g.fa", ">c1 first\nACGTA\nCCGT\n>c2\nTTTT\n"), width=4)
    points = spark.createDataFrame([(1, "c1", "+", 2, 7), (2, "c1", "-", 2, 7), (3, "c1", "+", -3, 2), (4, "c2", "+", 2, 99)], "row int, contig string, strand string, s long, e long")
    got = {r.row: r.window for r in readers.fetch_windows(points, chunks, F.col("s"), F.col("e"), 4).collect()}
    assert got == {1: "GTACC", 2: "GGTAC", 3: "AC", 4: "TT"}
    with pytest.raises(ValueError, match="uncompressed"):
        readers.read_fasta(spark, "g.fa.gz")


def bam_file(path):
    """Two records on one contig, one unmapped."""
    def record(name, flag, ref, pos, cigar, seq, tags=b""):
        codes = [bam.BASES.index(c) for c in seq]
        packed = bytes((codes[k] << 4) | (codes[k + 1] if k + 1 < len(codes) else 0) for k in range(0, len(codes), 2))
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 30, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | op) for op, n in cigar) + packed + b"\xff" * len(seq) + tags
        return struct.pack("<i", len(body)) + body

    head = b"@HD\tVN:1.6\n"
    data = b"BAM\x01" + struct.pack("<i", len(head)) + head + struct.pack("<i", 1) + struct.pack("<i", 3) + b"c1\0" + struct.pack("<i", 1000)
    data += record("r1", 16, 0, 99, [(4, 3), (0, 5), (3, 100), (0, 4)], "TTTACGTAACGT", b"XSZab\0NHC\x01")
    data += record("r2", 4, -1, -1, [], "ACG")
    half = len(data) // 2
    path.write_bytes(gzip.compress(data[:half]) + gzip.compress(data[half:]))  # several members, as in BGZF
    return str(path)


def test_bam(spark, tmp_path):
    spark.dataSource.register(bam.BamSource)
    d = spark.read.format("bam").load(bam_file(tmp_path / "x.bam"))
    first, second = sorted(d.collect(), key=lambda r: r.name)
    assert (first.flag, first.contig, first.start, first.hits, first.sequence) == (16, "c1", 99, 1, "TTTACGTAACGT")
    assert (second.contig, second.cigar, second.hits) == (None, [], None)
    c = F.col
    got = d.filter("name = 'r1'").select(
        records.reference_end(c("start"), c("cigar")), records.splice_blocks(c("start"), c("cigar")), records.terminal_clip(F.lit("-"), c("cigar"), c("sequence")),
        records.splice_edges(F.lit("-"), records.splice_blocks(c("start"), c("cigar"))), records.transcript_strand(c("flag"), F.lit("reverse"))).first()
    assert got[0] == 208 and [tuple(b) for b in got[1]] == [(99, 104), (204, 208)] and got[2] == "AAA"
    assert [tuple(e) for e in got[3]] == [(204, 208, 99, 104)] and got[4] == "+"
    with pytest.raises(Exception, match="CRAM"):
        spark.read.format("bam").load("x.cram").collect()


def test_sam(spark, tmp_path):
    d = readers.read_sam(spark, put(tmp_path / "x.sam", "@HD\tVN:1\nr1\t0\tc1\t100\t30\t3S5M100N4M\t*\t0\t0\tTTTACGTAACGT\t*\tNH:i:2\n")).first()
    assert (d.name, d.start, d.hits, [tuple(x) for x in d.cigar]) == ("r1", 99, 2, [(4, 3), (0, 5), (3, 100), (0, 4)])


def test_pair_reasons(spark):
    rows = [("a", 67, "c", "a", 131, "c"), ("a", 67, "c", "b", 131, "c"), ("a", 67, "c", "a", 67, "c"), ("a", 67, "c", "a", 131, "d"), ("a", 65, "c", "a", 129, "c")]
    d = spark.createDataFrame(rows, "n1 string, f1 int, c1 string, n2 string, f2 int, c2 string")
    one, two = (F.struct(F.col(f"n{k}").alias("name"), F.col(f"f{k}").alias("flag"), F.col(f"c{k}").alias("contig")) for k in (1, 2))
    none = F.lit(None).cast("string")
    assert [r[0] for r in d.select(records.pair_reason(one, two, none, none)).collect()] == [None, "query_name_mismatch", "mate_designation", "interchromosomal", "improper_pair"]


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("c1", "+", 5, "S1", 2), ("c1", "+", 5, "S2", 1), ("c1", "-", 7, "S1", 3)], "contig string, strand string, coordinate long, sample_id string, count long")
    assert sorted(r.value for r in sinks.bedgraph(d).collect()) == ["c1\t5\t6\t3", "c1\t7\t8\t3"]
    for name in ("a.tsv.gz", "b.tsv.gz"):
        sinks.write_small_tsv(d.orderBy("sample_id", "strand"), str(tmp_path / name), ["sample_id", "count"])
    assert sinks.file_sha256(str(tmp_path / "a.tsv.gz")) == sinks.file_sha256(str(tmp_path / "b.tsv.gz"))
    assert gzip.open(tmp_path / "a.tsv.gz", "rt").read().splitlines() == ["sample_id\tcount", "S1\t2", "S1\t3", "S2\t1"]
    sinks.write_evidence(d, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 3
    assert readers.is_sorted(d.orderBy("coordinate"), ["coordinate"]) and not readers.is_sorted(d.orderBy(F.desc("coordinate")), ["coordinate"])
    assert readers.merged([d, d], ["contig", "strand", "coordinate", "sample_id"]).count() == 6
    sites = spark.createDataFrame([("c1", "+", 9, "p", 5000)], "chrom string, strand string, coordinate long, pac_id string, total long")
    assert sinks.bed6(sites).first().value == "c1\t9\t10\tp\t1000\t+"
    with pytest.raises(ValueError, match="other columns"):
        sinks.concatenated({"a": d, "b": d.drop("count")})
    assert sinks.concatenated({"b": d, "a": d}).first().family == "a"
    assert sinks.flattened(spark.createDataFrame([([1, 2], ["x", "y"])], "members array<long>, supporting_conditions array<string>")).first().members == "1,2"


def test_seed_and_rna(spark):
    def horner(text, base):
        h = 0
        for ch in text:
            h = (h * 131 + ord(ch)) % (2**31 - 1)
        return (h + base) % (2**31 - 1)

    d = spark.createDataFrame([("G1 7",), ("gène x",), ("",)], "t string")
    assert [r[0] for r in d.select(sequences.seed_of(F.col("t"), 5)).collect()] == [horner(t, 5) for t in ("G1 7", "gène x", "")]
    assert [r[0] for r in d.select(sequences.to_rna(F.lit("ACTt"))).collect()][0] == "ACUu"
