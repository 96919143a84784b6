from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from endmark import queries
from endmark.operators import aggregates, clustering, joins, testing

OBS = "sample_id string, contig string, strand string, coordinate long, count long"


def observations(n=400, seed=3):
    r = random.Random(seed)
    rows = {(f"S{r.randrange(4)}", "c1", r.choice("+-"), r.randrange(0, 900)): r.randrange(1, 9) for _ in range(n)}
    return [(*k, c) for k, c in rows.items()]


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def greedy(rows, seed_radius, cluster_radius):
    out = []
    for strand in "+-":
        at = sorted({r[3] for r in rows if r[2] == strand})
        own = {c: sum(r[4] for r in rows if r[2] == strand and r[3] == c) for c in at}

        def rank(c, strand=strand):
            per = {}
            for s, _, st, x, n in rows:
                if st == strand and abs(x - c) <= seed_radius:
                    per[s] = per.get(s, 0) + n
            return (-sum(v > 0 for v in per.values()), -sum(min(v, 3) for v in per.values()), -sum(per.values()), c)

        free = set(at)
        for c in sorted(at, key=rank):
            if c in free:
                members = [x for x in at if x in free and abs(x - c) <= cluster_radius]
                free -= set(members)
                out.append((strand, c, tuple(members), sum(own[x] for x in members)))
    return sorted(out)


def test_greedy_clusters(spark):
    rows = observations()
    got = clustering.greedy_clusters(spark.createDataFrame(rows, OBS), 4, 8).collect()
    assert sorted((r.strand, r.seed, tuple(r.members), r.total) for r in got) == greedy(rows, 4, 8)
    assert clustering.greedy_clusters(spark.createDataFrame([], OBS)).count() == 0


def test_kernel_peaks(spark):
    rows = [("S0", "c1", "+", c, 3) for c in (100, 103, 106, 400)] + [("S0", "c1", "-", 50, 2)]
    got = clustering.kernel_peaks(spark.createDataFrame(rows, OBS), [1.0, 2.0, 1.0], 0, 3, 12).orderBy("strand", "bin").collect()
    # bins are the nearest: 100 -> 33, 103 -> 34, 106 -> 35, 400 -> 133, -50 -> -17
    assert [(r.strand, r.bin, r.score) for r in got] == [("+", 35, 12.0), ("+", 134, 6.0), ("-", -16, 4.0)]
    assert clustering.local_peaks(np.array([0, 1, 1, 0, 2, 3])).tolist() == [1, 5]
    assert clustering.local_peaks(np.array([2, 2, 1, 0, 3, 3])).tolist() == [0, 5]  # plateaus at the ends count at the end itself
    assert clustering.local_peaks(np.array([4.0])).tolist() == [0] and not len(clustering.local_peaks(np.array([])))
    up = [("S0", "c1", "+", 8, 1)]
    assert [r.bin for r in clustering.kernel_peaks(spark.createDataFrame(up, OBS), [1.0], 0, 10, 10).collect()] == [1]
    with pytest.raises(ValueError):
        clustering.kernel_peaks(spark.createDataFrame(up, OBS), [1.0], 0, 20, 10)


def test_support_by_number_and_seeds_of_single_reads(spark):
    samples = spark.createDataFrame([(f"A{k}", "A") for k in range(4)] + [(f"B{k}", "B") for k in range(2)], "sample_id string, condition string")
    counts = spark.createDataFrame([("p", f"A{k}", 5) for k in range(3)] + [("p", f"B{k}", 5) for k in range(2)], "pac_id string, sample_id string, count long")
    assert aggregates.condition_support(counts, samples, ["pac_id"], 1, 2).first().best_condition == "A"  # 3 of 4 against 2 of 2
    assert aggregates.condition_support(counts, samples, ["pac_id"], 1, 0.5).first().best_condition == "B"
    one = spark.createDataFrame([("S1", "c", "+", 10, 1), ("S2", "c", "+", 11, 1)], OBS)
    assert [(r.supporting, r.capped, r.raw) for r in aggregates.seed_metrics(one, 4).collect()] == [(2, 2, 2)] * 2


def test_odds_ratio_interval(spark):
    rows = [("x", 10, 5, 3, 12), ("x", 7, 9, 4, 15), ("y", 4, 0, 3, 2), ("z", 4, 0, 3, 0)]
    got = {r.k: r for r in testing.mantel_haenszel(spark.createDataFrame(rows, "k string, a long, b long, c long, d long"), ["k"]).collect()}
    assert got["x"].odds_ratio == pytest.approx((10 * 12 / 30 + 7 * 15 / 35) / (5 * 3 / 30 + 9 * 4 / 35))
    assert got["x"].ci_low < got["x"].odds_ratio < got["x"].ci_high
    assert got["x"].ci_low * got["x"].ci_high == pytest.approx(got["x"].odds_ratio ** 2)
    assert got["y"].odds_ratio == float("inf") and got["y"].ci_low is None and "z" not in got


def test_mantel_haenszel_of_large_strata(spark):
    rows = [("x", 60_000, 50_000, 40_000, 70_000), ("y", 4_000_000_000, 3_000_000_000, 2_000_000_000, 5_000_000_000)]
    got = {r.k: r for r in testing.mantel_haenszel(spark.createDataFrame(rows, "k string, a long, b long, c long, d long"), ["k"]).collect()}
    for k, a, b, c, d in rows:
        n = a + b + c + d
        assert got[k].odds_ratio == pytest.approx(a * d / (b * c)) and got[k].ci_low < got[k].odds_ratio < got[k].ci_high
        assert got[k].chi_square == pytest.approx((a * d - b * c) ** 2 * (n - 1) / ((a + b) * (c + d) * (a + c) * (b + d)))


def test_joins_with_ties_and_nothing_near(spark):
    left = spark.createDataFrame([(1, "c", "+", 10), (2, "c", "+", 100), (3, "d", "+", 10)], "row int, contig string, strand string, at long")
    right = spark.createDataFrame([("a", "c", "+", 5), ("b", "c", "+", 15), ("x", "c", "-", 10)], "pac string, contig string, strand string, site long")
    got = {r.row: r.pac for r in joins.nearest_within(left, right, ["contig", "strand"], ["row"], "at", "site", 5).collect()}
    assert got == {1: "a", 2: None, 3: None}
    assert joins.without_neighbours(left, right, ["contig", "strand"], "at", "site", 5).count() == 2
    empty = right.limit(0)
    assert joins.nearest_within(left, empty, ["contig", "strand"], ["row"], "at", "site", 5).filter("pac is not null").count() == 0


def test_prioritised(spark):
    points = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "pac string")
    exon = spark.createDataFrame([("p1", "e")], "pac string, gene string")
    gene = spark.createDataFrame([("p1", "g"), ("p2", "g1"), ("p2", "g2")], "pac string, gene string")
    assert sorted((r.pac, r.gene or "") for r in joins.prioritised(points, [exon, gene], "pac").collect()) == [("p1", "e"), ("p2", "g1"), ("p2", "g2"), ("p3", "")]


def test_benjamini_hochberg(spark):
    d = spark.createDataFrame([(1, 0.01), (2, 0.02), (3, 0.02), (4, None), (5, 0.9)], "id int, p double")
    got = {r.id: r.fdr for r in testing.benjamini_hochberg(d, "p").collect()}
    assert got == {1: pytest.approx(0.08 / 3), 2: pytest.approx(0.08 / 3), 3: pytest.approx(0.08 / 3), 4: None, 5: pytest.approx(0.9)}


def test_usage_of_empty_gene(spark):
    d = spark.createDataFrame([("p", "g", "S", 0), ("q", "g", "S", 0), ("r", "h", "S", 3)], "pac_id string, gene_id string, sample_id string, count long")
    assert {r.pac_id: r.pau for r in aggregates.usage(d).collect()} == {"p": None, "q": None, "r": 1.0}


def test_merged_intervals_touch(spark):
    d = spark.createDataFrame([("g", 0, 10), ("g", 10, 12), ("g", 2, 3), ("g", 13, 20)], "k string, start long, end long")
    assert sorted((r.start, r.end, r.members) for r in aggregates.merged_intervals(d, ["k"]).collect()) == [(0, 12, 3), (13, 20, 1)]


def test_endpoint_classes(spark):
    rows = [(30, 0.9, 0.0, 5.0, 0.8, -3.0, 3.0), (30, 0.9, 120.0, 200.0, 0.1, 10.0, 300.0), (3, 0.9, 0.0, 5.0, 0.8, 0.0, 0.0), (30, None, 0.0, 5.0, 0.8, 0.0, 0.0), (30, 0.9, 120.0, 200.0, 0.1, -900.0, 300.0)]
    d = spark.createDataFrame(rows, "g int, r double, m double, w double, b double, lo double, hi double")
    got = [x[0] for x in d.select(aggregates.classify_endpoints(*[F.col(c) for c in ("g", "r", "m", "w", "b", "lo", "hi")])).collect()]
    assert got == ["exact", "proximal", "ambiguous", "ambiguous", "ambiguous"]


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 17])
def test_islands_over_bins(spark, width):
    """Equal results whatever the bins: runs and unions cross any number of borders."""
    r = random.Random(width)
    points = [(k, r.randrange(-400, 400)) for k in "ab" for _ in range(120)] + [("c", 5), ("c", 5)]
    want, last, number = {}, {}, {}
    for k, at in sorted(points):
        number[k] = number.get(k, 0) + (k not in last or at - last[k] > 6)
        last[k] = at
        want[k, at] = number[k]
    got = aggregates.islands(spark.createDataFrame(points, "k string, at long"), ["k"], "at", 6, width=width).collect()
    assert len(got) == len(points) and {(x.k, x.at): x.island for x in got} == want
    spans = [(k, a := r.randrange(-300, 300), a + r.choice([0, 1, 3, 9, 120])) for k in "ab" for _ in range(40)]
    unions = []
    for k, a, b in sorted(spans):
        if unions and unions[-1][0] == k and a <= unions[-1][3]:
            unions[-1][3], unions[-1][4] = max(unions[-1][3], b), unions[-1][4] + 1
        else:
            unions.append([k, unions[-1][1] + 1 if unions and unions[-1][0] == k else 1, a, b, 1])
    got = aggregates.merged_intervals(spark.createDataFrame(spans, "k string, start long, end long"), ["k"], width=width).collect()
    assert sorted(map(list, got)) == sorted(unions)
