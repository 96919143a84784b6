"""The jobs on growing and repeated input, against plain versions."""

from __future__ import annotations

import json
import logging
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from endmark.functions import sequences
from jobs import motif_report, queries, site_counts

READS = "run string, sample string, ctg string, side string, at long, n long, clipped long"
SETTINGS = {"columns": {"sample_id": "sample", "contig": "ctg", "strand": "side", "coordinate": "at", "count": "n", "poly_a_clip_count": "clipped"}, "radius": 5, "files_at_once": 1}
SITES = [("p1", "g1", "c", "+", 100), ("p2", "g1", "c", "+", 110), ("p3", "g2", "c", "-", 100), ("p4", "g3", "d", "+", 0)]


def reads(seed: int, samples: str = "ABC") -> list[tuple]:
    r = random.Random(seed)
    rows = [(f"run{seed}", r.choice(samples), r.choice("cd"), r.choice("+-"), r.randrange(90, 120), r.randrange(1, 9), 0) for _ in range(300)]
    return [*rows, rows[0], ("x", None, "c", "+", 100, 5, 0), ("x", "A", "c", "+", None, 5, 0), ("x", "A", "c", "+", 100, 0, 0), ("x", "", "c", "+", 100, 3, 0)]


def plain(rows: list[tuple]) -> set[tuple]:
    counts, samples = Counter(), set()
    for _, sample, ctg, side, at, n, _ in rows:
        if not sample or at is None or n <= 0:
            continue
        samples.add(sample)
        near = sorted((abs(at - site), site, pac, gene) for pac, gene, c, s, site in SITES if (c, s) == (ctg, side) and abs(at - site) <= 5)
        if near:
            counts[near[0][2], sample] += n
    totals = defaultdict(int)
    for pac, gene, *_ in SITES:
        for s in samples:
            totals[gene, s] += counts[pac, s]
    return {(pac, gene, c, strand, at, counts[pac, s], totals[gene, s], counts[pac, s] / totals[gene, s] if totals[gene, s] else None, s) for pac, gene, c, strand, at in SITES for s in samples}


@pytest.fixture
def folders(spark, tmp_path):
    spark.createDataFrame(SITES, "pac_id string, gene_id string, contig string, strand string, coordinate long").write.parquet(str(tmp_path / "atlas"))

    def add(seed: int, samples: str = "ABC") -> list[tuple]:
        rows = reads(seed, samples)
        spark.createDataFrame(rows, READS).coalesce(1).write.mode("append").parquet(str(tmp_path / "reads"))
        return rows

    def run() -> dict:
        return site_counts.update(spark, str(tmp_path / "reads"), str(tmp_path / "atlas"), str(tmp_path / "out"), str(tmp_path / "mark"), SETTINGS)

    def result() -> set[tuple]:
        rows = site_counts.result(spark, str(tmp_path / "out")).collect()
        assert len(rows) == len(set(rows))
        return {tuple(r) for r in rows}

    return tmp_path, add, run, result


def test_growing_input(folders, caplog):
    path, add, run, result = folders
    rows = add(1) + add(2)
    with caplog.at_level(logging.INFO, "jobs.site_counts"):
        first = run()
    assert first == {"batches": 2, "rows_read": len(rows), "rows_unusable": 8, "samples": 3, "rows_written": 12} and f"read {len(rows)} rows" in caplog.text
    assert result() == plain(rows)
    others = {f for f in (path / "out" / "usage").rglob("*.parquet") if "sample_id=A" not in str(f)}
    new = add(3, "A")
    assert run() == {"batches": 1, "rows_read": len(new), "rows_unusable": 4, "samples": 1, "rows_written": 4}
    assert result() == plain(rows + new)
    assert others <= set((path / "out" / "usage").rglob("*.parquet"))  # other samples' files are not written anew


def test_a_run_without_new_files_changes_nothing(folders):
    path, add, run, result = folders
    add(4)
    run()
    files = sorted(map(str, (path / "out").rglob("*.parquet")))
    assert run() == {"batches": 0, "rows_read": 0, "rows_unusable": 0, "samples": 0, "rows_written": 0}
    assert sorted(map(str, (path / "out").rglob("*.parquet"))) == files and result()


def test_a_run_that_stopped_before_its_mark_is_made_good(folders, monkeypatch):
    _, add, run, result = folders
    rows = add(5)
    with monkeypatch.context() as m:
        m.setattr(site_counts, "usage", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            run()
    assert result() == set()
    rows += add(6)
    assert run()["batches"] == 2
    assert result() == plain(rows)


def test_a_batch_that_is_done_again_counts_once(spark, folders):
    path, add, run, result = folders
    rows = add(7) + add(8)
    run()
    # without its last commit the stream does its last batch again; without the mark the job publishes again
    (path / "mark" / "commits" / "1").unlink()
    (path / "mark" / "commits" / ".1.crc").unlink(missing_ok=True)
    spark.createDataFrame([(0,)], "batch long").coalesce(1).write.mode("overwrite").parquet(str(path / "out" / "published"))
    assert run()["batches"] == 1 and result() == plain(rows)


SEQUENCES = {"sequence": "upper(text)", "id": "doc_id", "group": "lang", "stratum": "source", "motifs": [["AATAAA", "canonical", 1], ["ACA", "other", 2]], "core": [15, 30], "tail": 10}


def texts() -> list[tuple]:
    r = random.Random(9)
    rows = [(k, "".join(r.choice("acgt") for _ in range(r.randrange(80))) + r.choice(["", "aataaataaa", "a" * 12]), r.choice(["x", "y", None]), r.choice(["s", "t", None])) for k in range(150)]
    return [*rows, rows[0], rows[0], (900, None, "x", "s"), (901, "", "", "t"), (902, "AATAAA" + "C" * 20_000, "y", "s"), (None, "aca" * 50, "only", "own")]


def test_motif_report(spark, tmp_path):
    rows = texts()
    spark.createDataFrame([(*r, 1, "m") for r in rows], "doc_id long, text string, lang string, source string, length int, motif string").repartition(3).write.parquet(str(tmp_path / "texts"))
    out = str(tmp_path / "out")
    log = motif_report.report(spark, str(tmp_path / "texts"), out, SEQUENCES)
    want, groups = Counter(), defaultdict(Counter)
    for id, text, lang, source in rows:
        seq, part = (text or "").upper(), lang or "none"
        hits = sorted((p, not 15 <= len(seq) - i <= 30, abs(len(seq) - i - 20), len(seq) - i, m, kind) for m, kind, p in SEQUENCES["motifs"] for i in range(len(seq)) if seq.startswith(m, i))
        motifs = sorted({h[4] for h in hits})
        want[id, source, len(seq), len(hits), hits[0][4] if hits else "no_recognized_motif", hits[0][5] if hits else None, hits[0][3] if hits else None, ",".join(motifs), part] += 1
        for m, _, _ in SEQUENCES["motifs"]:
            groups[m][part, source, m in motifs] += 1
    both = motif_report.result(spark, out, SEQUENCES).collect()
    got = [r for r in both if r.table == "sequences"]
    assert Counter((r.id, r.stratum, r.length, r.n_hits, r.primary_motif, r.motif_class, r.distance, r.motifs, r.part) for r in got) == want
    assert log == {"rows_read": len(rows), "hits": sum(r.n_hits for r in got), "enrichment_rows": 2 * len({g for g, _, _ in groups["ACA"]})}
    for r in both:
        if r.table == "enrichment":
            n = groups[r.motif]
            up = down = strata = 0.0
            for s in {s for _, s, _ in n}:
                a, b = n[r.part, s, True], n[r.part, s, False]
                c, d = (sum(v for (g, t, h), v in n.items() if g != r.part and t == s and h is has) for has in (True, False))
                if a + b and c + d and a + c and b + d:
                    strata, up, down = strata + 1, up + a * d / (a + b + c + d), down + b * c / (a + b + c + d)
            assert (r.strata, r.with_motif, r.n_sequences) == (strata, sum(v for (g, _, h), v in n.items() if g == r.part and h), sum(v for (g, _, _), v in n.items() if g == r.part))
            assert r.odds_ratio == pytest.approx(up / down if down else float("inf")) if strata else r.odds_ratio is None and r.fdr is None
    motif_report.report(spark, str(tmp_path / "texts"), out, SEQUENCES)
    assert Counter(motif_report.result(spark, out, SEQUENCES).collect()) == Counter(both)
    # what left the input leaves the output
    spark.createDataFrame([(1, "aca", "x", "s")], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "fewer"))
    motif_report.report(spark, str(tmp_path / "fewer"), out, SEQUENCES)
    assert {(r.table, r.part) for r in motif_report.result(spark, out, SEQUENCES).collect()} == {("sequences", "x"), ("enrichment", "x")}


def test_preferred_hit_and_counts_against_all_hits(spark):
    r = random.Random(4)
    seqs = ["", "A", None, *("".join(r.choice("AAACT") for _ in range(r.randrange(120))) for _ in range(400)), "C" * 50 + "AATAAATAAA" + "C" * 40, "A" * 30 + "C" + "A" * 9]
    rows = spark.createDataFrame([(k, s) for k, s in enumerate(seqs)], "no int, seq string")
    c = F.col("seq")
    for motifs in ([("AATAAA", "x", 1), ("ACA", "y", 2), ("TA", "z", 2)], [("AA", "x", 2), ("AAT", "y", 1), ("C" * 35, "z", 1)]):
        for core in ((15, 30), (3, 8), (40, 60)):
            got = rows.select("no", "seq", sequences.motif_hits(c, motifs, core).alias("hits"), sequences.preferred_hit(c, F.reverse(c), motifs, core).alias("best"), sequences.motif_count(c, [m for m, _, _ in motifs]).alias("n"), sequences.longest_run(c, "A").alias("run")).collect()
            for x in got:
                assert x.best == (x.hits[0] if x.hits else None) and (x.seq is None or x.n == len(x.hits))
                assert x.run == max(map(len, re.findall("A+", x.seq or "")), default=0)


def test_whole_sequences_take_no_list_of_hits(spark):
    texts = spark.createDataFrame([(1, "aataaa", "x", "s")], "doc_id long, text string, lang string, source string")
    plan = motif_report.described(texts, SEQUENCES)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(seq" not in plan and "A+" not in plan


def test_config_is_tested(tmp_path):
    bad = tmp_path / "bad.json"
    for motifs in ([["AA", "x", 1], ["AA", "y", 2]], [["A+", "x", 1]]):
        bad.write_text(json.dumps({**SEQUENCES, "motifs": motifs}), encoding="utf-8")
        with pytest.raises(ValueError, match="ACGT"):
            motif_report.config(str(bad))


def test_command_lines(monkeypatch, spark, tmp_path):
    class Kept:
        """A builder that gives the tests' session, whose stop() the command line calls."""

        stopped = 0

        def appName(self, _):  # noqa: N802
            return self

        def getOrCreate(self):  # noqa: N802
            return self

        def stop(self):
            Kept.stopped += 1

    for module, call, more in ((site_counts, "update", ("--atlas", "a", "--reads", "r", "--checkpoint", "k")), (motif_report, "report", ("--texts", "t"))):
        seen = []
        monkeypatch.setattr(module, "SparkSession", type("S", (), {"builder": Kept()}))
        monkeypatch.setattr(module, call, lambda *a, seen=seen: seen.append(a[1:]))
        module.main([*more, "--out", "o"])
        assert seen and seen[0][-1] == module.config()
    assert Kept.stopped == 2


@pytest.mark.parametrize("name", ["job1_site_counts", "job2_motif_report"])
def test_queries_against_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("lineitem", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = queries.QUERIES[name](spark, sf)
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want.fetchall())
