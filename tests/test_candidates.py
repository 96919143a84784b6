"""Status of candidates and read-through by plain versions."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from endmark.operators import candidates
from endmark.plans import run

SHEET = [(f"s{k}", c) for k, c in enumerate("AAABBC")]
OBSERVED = "sample_id string, contig string, strand string, coordinate long, count long, poly_a_clip_count long"
CLUSTERS = "contig string, strand string, seed long, members array<long>"


def observed() -> list[tuple]:
    r = random.Random(3)
    return [(s, "c", strand, at, n := r.randrange(1, 9), r.randrange(n + 1)) for strand in "+-" for at in r.sample(range(1000), 160) for s, _ in SHEET if r.random() < 0.3]


def plain(rows: list[tuple], clusters: list[tuple], radius: int, s: candidates.Support, known: list[tuple]) -> dict:
    out, sizes, condition = {}, Counter(c for _, c in SHEET), dict(SHEET)
    for contig, strand, seed, members in clusters:
        own = [x for x in rows if x[1:3] == (contig, strand) and x[3] in members]
        per = Counter()
        for x in own:
            per[x[0]] += x[4]
        total = sum(per.values())
        support = Counter(condition[n] for n, v in per.items() if v >= s.least_count)
        need = lambda c: math.ceil(s.least_samples * sizes[c]) if s.least_samples < 1 else int(s.least_samples)
        passing = sorted(c for c in support if support[c] >= need(c))
        best = min(support, key=lambda c: (c not in passing, -(support[c] / sizes[c] if s.least_samples < 1 else support[c]), -support[c], c), default="")
        reads = sorted(x[3] for x in own for _ in range(x[4]))
        # the rank is rounded half to even, as numpy's rint
        width = reads[round(0.95 * (total - 1))] - reads[round(0.05 * (total - 1))]
        flank = sum(x[4] for x in rows if x[1:3] == (contig, strand) and radius < abs(x[3] - seed) <= 2 * radius)
        near = any(k[:2] == (contig, strand) and abs(k[2] - seed) <= s.known_radius for k in known)
        status = "primary" if total >= s.least_total and passing else "known_rescue_only" if near and total >= s.rescue_total and passing else "rejected"
        why = [f"total_count<{s.least_total}"] * (total < s.least_total) + [f"supporting_sample_fraction<{s.least_samples:g}" if s.least_samples < 1 else f"supporting_samples<{int(s.least_samples)}"] * (not passing)
        out[contig, strand, seed] = (
            total, support[best] if best else 0, sum(min(v, s.cap) for v in per.values()), sorted(members), status, ";".join(why) if status == "rejected" else "", sum(x[4] for x in own if abs(x[3] - seed) <= 2) / total, width,
            sum(x[5] for x in own) / total, total / max(flank, 1), min(members), max(members) + 1, 1, sum(support.values()), best, ";".join(passing))
    return out


@pytest.mark.parametrize("support", [candidates.Support(least_total=75, least_count=6, least_samples=2, rescue_total=20), candidates.Support(least_total=75, least_count=8, least_samples=0.6, rescue_total=1, known_radius=40)])
def test_status(spark, support):
    rows = observed()
    groups = defaultdict(list)
    for x in rows:
        groups[x[1], x[2], x[3] // 50].append(x[3])
    clusters = [(c, s, max(at, key=at.count), sorted(set(at))) for (c, s, _), at in groups.items()]
    known = [("c", strand, at) for strand in "+-" for at in range(0, 1000, 90)] + [("d", "+", 5)]
    got = candidates.exact_candidates(spark.createDataFrame(clusters, CLUSTERS), spark.createDataFrame(rows, OBSERVED), spark.createDataFrame(SHEET, "sample_id string, condition string"), 24, support,
                                      spark.createDataFrame(known, "contig string, strand string, coordinate long")).collect()
    want = plain(rows, clusters, 24, support, known)
    assert len(got) == len(want)
    for r in got:
        w = want[r.contig, r.strand, r.coordinate]
        assert tuple(r)[3:] == tuple(pytest.approx(v) if isinstance(v, float) else v for v in w), (r, w)
    assert {r.status for r in got} == {"primary", "known_rescue_only", "rejected"}


def test_a_sample_that_the_sheet_lacks(spark):
    clusters = spark.createDataFrame([("c", "+", 5, [5])], CLUSTERS)
    seen = spark.createDataFrame([("other", "c", "+", 5, 3, 0)], OBSERVED)
    with pytest.raises(Exception, match="no sample other"):
        candidates.exact_candidates(clusters, seen, spark.createDataFrame(SHEET, "sample_id string, condition string"), 24, candidates.Support()).collect()


CANDIDATES = "contig string, strand string, coordinate long, status string, rejection_reason string, supporting_conditions string"
SPLICED = "sample_id string, contig string, strand string, upstream_start long, upstream_end long, downstream_start long, downstream_end long, count long"


def test_readthrough(spark):
    r = random.Random(8)
    sites = [("c", strand, at, "primary", "", ";".join(sorted(r.sample("ABC", r.randrange(4))))) for strand in "+-" for at in range(100, 900, 20)]
    spliced = [(r.choice(SHEET)[0], "c", r.choice("+-"), a := r.randrange(50, 900), a + r.randrange(1, 60), 2000, 2100, r.randrange(1, 9)) for _ in range(150)]
    least, shift, width = 6, 3, 5
    condition, want = dict(SHEET), {}
    for contig, strand, at, *_, names in sites:
        pile = at - shift * width if strand == "+" else at + shift * width
        pooled = Counter()
        for x in spliced:
            if x[1:3] == (contig, strand) and x[3] <= pile + width and x[4] >= pile - width:
                pooled[condition[x[0]]] += x[7]
        wanted = [c for c in names.split(";") if c]
        want[strand, at] = bool(wanted) and all(pooled[c] >= least for c in wanted)
    kept, rejected = candidates.readthrough(spark.createDataFrame(sites, CANDIDATES), spark.createDataFrame(spliced, SPLICED), spark.createDataFrame(SHEET, "sample_id string, condition string"), least, shift, width)
    assert {(x.strand, x.coordinate) for x in kept.collect()} == {k for k, v in want.items() if not v}
    got = rejected.collect()
    assert {(x.strand, x.coordinate) for x in got} == {k for k, v in want.items() if v} and {(x.status, x.rejection_reason) for x in got} == {("rejected", "constitutive_readthrough")}
    assert 5 < sum(want.values()) < 60


def test_a_condition_saves_a_site(spark):
    """Pooled reads reach the minimum in A but not in B: the site stays where B supports it."""
    sheet = spark.createDataFrame(SHEET, "sample_id string, condition string")
    spliced = spark.createDataFrame([("s0", "c", "+", 90, 110, 200, 210, 2), ("s1", "c", "+", 95, 120, 200, 210, 1), ("s3", "c", "+", 90, 110, 200, 210, 2)], SPLICED)
    one = lambda names: spark.createDataFrame([("c", "+", 100, "primary", "", names)], CANDIDATES)
    for names, stays in (("A", False), ("B", True), ("A;B", True), ("", True)):
        kept, rejected = candidates.readthrough(one(names), spliced, sheet, 3, 0, 1)
        assert (kept.count(), rejected.count()) == (int(stays), int(not stays)), names
    for wrong, why in ((("s0", "c", "+", 90, 90, 200, 210, 2), "invalid exon block"), (("s0", "c", "+", 90, 95, 200, 210, 0), "invalid exon block"), (("x", "c", "+", 90, 95, 200, 210, 1), "no sample x")):
        with pytest.raises(Exception, match=why):
            candidates.readthrough(one("A"), spark.createDataFrame([wrong], SPLICED), sheet, 3, 0, 1)[0].collect()


def test_judged_clusters(spark):
    seen = [(s, "c", "+", at, n, 0) for s, _ in SHEET for at, n in ((100, 9), (101, 3), (400, 1))] + [("s0", "c", "+", 700, 50, 0)]
    spliced = [(s, "c", "+", 90, 110, 300, 310, 2) for s, _ in SHEET]
    sheet = spark.createDataFrame(SHEET, "sample_id string, condition string")
    evidence = spark.createDataFrame(seen, OBSERVED)
    good, bad = run.judge(evidence, sheet, run.Settings())
    assert [(r.pac_id, r.total, r.samples, r.supporting_conditions) for r in good.collect()] == [("PACv1.x.c.+.100", 72, 6, "A;B")]
    assert {(r.coordinate, r.rejection_reason) for r in bad.collect()} == {(400, "total_count<10;supporting_samples<2"), (700, "supporting_samples<2")}
    good, bad = run.judge(evidence, sheet, run.Settings(), continuations=spark.createDataFrame(spliced, SPLICED))
    assert good.count() == 0 and {(r.coordinate, r.rejection_reason) for r in bad.collect()} > {(100, "constitutive_readthrough")}
