"""Sequence queries over whole texts, against plain versions; the signals lie beyond letter 60."""

from __future__ import annotations

import re
from collections import Counter

from endmark import queries

LETTERS = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ACGTAACGTAAACGTAAACGTTACGA")
CLASSES = {"AATAAA": "canonical", "ATTAAA": "variant", "AAGAAA": "variant", "ACGTAA": "other"}
MOTIFS = (("AATAAA", 1), ("ATTAAA", 2), ("AAGAAA", 3), ("ACGTAA", 4))


def test_whole_texts(spark, tmp_path):
    texts = ["c" * 70 + " aataaa? " + "g" * 22, "b" * 65 + "aadaaa" + "d" * 90 + "attaaa", "", "Gc cg", "aadaaa" + "b" * 30 + "aadaaa" + "c" * 17]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seqs = [re.sub("[^a-z]", "", t.lower()).translate(LETTERS) for t in texts]
    features = {r.doc_id: r for r in queries.f1_f4_f5_f6_f8_sequences(spark, str(tmp_path)).collect()}
    motifs = {r.doc_id: r for r in queries.f2_f3_motifs(spark, str(tmp_path)).collect()}
    counts: Counter = Counter()
    for k, s in enumerate(seqs):
        f = features[k]
        assert len(f.revcomp) == len(s) and f.has_signal == ("AATAAA" in s)
        assert f.revcomp == s[::-1].translate(str.maketrans("ACGT", "TGCA"))
        assert f.a_run == max(map(len, re.findall("A+", s)), default=0) and f.a_fraction == (round(s.count("A") / len(s), 9) if s else 0)
        hits = sorted((p, not 15 <= len(s) - i <= 30, abs(len(s) - i - 20), len(s) - i, m) for m, p in MOTIFS for i in range(len(s)) if s.startswith(m, i))
        assert tuple(motifs[k])[1:] == ((hits[0][4], CLASSES[hits[0][4]], hits[0][3], len(hits)) if hits else ("no_recognized_motif", None, None, 0))
        counts.update({s[i : i + 4] for i in range(len(s) - 3)})
    assert any("AATAAA" in s and "AATAAA" not in s[:60] for s in seqs)
    assert {r.kmer: r.n for r in queries.f7_kmers(spark, str(tmp_path)).collect()} == counts
