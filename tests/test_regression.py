"""The joint model: plain optima, nested designs, known precisions, covariates and simulated families."""

from __future__ import annotations

import math

import numpy as np
import pytest

from endmark.operators import family, models, regression

CONDITIONS = {"C": 4, "T1": 4, "T2": 3}


def sheet(batches: bool = False) -> list[dict[str, str]]:
    rows = [{"sample_id": f"{c}{k}", "condition": c} for c, n in CONDITIONS.items() for k in range(n)]
    return [{**r, "batch": "ab"[k % 2]} for k, r in enumerate(rows)] if batches else rows


def drawn(rng, share: np.ndarray, precision: float, depth: int) -> np.ndarray:
    return np.array([rng.multinomial(depth, rng.dirichlet(np.maximum(p * precision, 1e-9))) for p in share], dtype=float)


def rows_of(genes: dict[str, np.ndarray], samples: list[dict[str, str]]) -> list[tuple]:
    return [(g, f"{g}.{k}", s["sample_id"], s["condition"], int(v)) for g, y in genes.items() for s, row in zip(samples, y, strict=True) for k, v in enumerate(row)]


SCHEMA = "gene_id string, pac_id string, sample_id string, condition string, count long"


def test_trigamma():
    assert np.allclose(regression.trigamma(np.array([0.5, 1.0, 2.0, 30.0])), [math.pi**2 / 2, math.pi**2 / 6, math.pi**2 / 6 - 1, 0.0338950623], atol=1e-9)


def test_derivatives_by_differences():
    rng = np.random.default_rng(1)
    layout = family.family_layout(sheet(True), "C", ("batch",))
    y = drawn(rng, np.tile([0.5, 0.3, 0.2], (11, 1)), 20.0, 60)[None]
    beta, precision = rng.normal(size=(1, layout.design.shape[1], 2)) * 0.3, np.array([17.0])
    score, _, observed = regression._derivatives(y, layout.design, regression.shares(layout.design, beta), precision)
    flat = beta.ravel()

    def value(b: np.ndarray) -> float:
        return float(regression.likelihood(y, regression.shares(layout.design, b.reshape(beta.shape)), precision)[0])

    def slope(b: np.ndarray) -> np.ndarray:
        return regression._derivatives(y, layout.design, regression.shares(layout.design, b.reshape(beta.shape)), precision)[0].ravel()

    steps = np.eye(len(flat)) * 1e-5
    assert np.allclose(score.ravel(), [(value(flat + d) - value(flat - d)) / 2e-5 for d in steps], atol=1e-5)
    assert np.allclose(observed[0], -np.array([(slope(flat + d) - slope(flat - d)) / 2e-5 for d in steps]), atol=1e-4)


def test_groups_alone_equal_pairwise_fits(spark):
    """With conditions only, groups don't share coefficients: contrasts and fits are those of the pairwise proportions."""
    rng = np.random.default_rng(2)
    samples = sheet()
    genes = {f"g{n}": drawn(rng, np.array([[0.5, 0.3, 0.2] if s["condition"] == "C" else [0.3, 0.3, 0.4] for s in samples]), 30.0, 80) for n in range(4)}
    counts = spark.createDataFrame([(*r, 25.0) for r in rows_of(genes, samples)], SCHEMA + ", precision double")
    got = {(r.pac_id, r.treatment): r for r in regression.fit_family(counts, family.family_layout(samples, "C")).collect()}
    want = models.fit_genes(counts, "C").collect()
    assert len(got) == len(want) == 24
    for w in want:
        g = got[w.pac_id, w.treatment]
        assert (g.status, g.gene_df, g.omnibus_df) == ("ok", 2, 4)
        assert g.gene_lr == pytest.approx(w.gene_lr, abs=2e-4) and g.pac_lr == pytest.approx(w.pac_lr, abs=2e-4)
        assert g.control_fit == pytest.approx(w.control_fit, abs=2e-4) and g.treatment_fit == pytest.approx(w.treatment_fit, abs=2e-4)
        assert g.omnibus_lr >= g.gene_lr - 1e-6


def test_optimum_is_a_maximum():
    rng = np.random.default_rng(3)
    layout = family.family_layout(sheet(True), "C", ("batch",))
    y = np.stack([drawn(rng, np.tile(p, (11, 1)), 15.0, 50) for p in ([0.7, 0.2, 0.1], [0.2, 0.5, 0.3])])
    precision = np.array([9.0, 40.0])
    beta, value = regression.fit(y, layout.design, precision)
    score, _, observed = regression._derivatives(y, layout.design, regression.shares(layout.design, beta), precision)
    assert np.abs(score).max() < 1e-2 and (np.linalg.eigvalsh(observed) > 0).all()
    for _ in range(50):
        assert (regression.likelihood(y, regression.shares(layout.design, beta + rng.normal(size=beta.shape) * 0.05), precision) <= value + 1e-9).all()


def test_covariates_explain_a_batch(spark):
    """A batch that shifts usage looks like noise without the covariate; with it the precision rises and a treatment's effect is seen."""
    rng = np.random.default_rng(4)
    samples = sheet(True)

    def share(s: dict, effect: bool) -> list[float]:
        p = 0.35 + 0.3 * (s["batch"] == "a") + (0.15 if effect and s["condition"] == "T1" else 0)
        return [p, (1 - p) * 0.6, (1 - p) * 0.4]

    genes = {f"g{n}": drawn(rng, np.array([share(s, n % 2 == 0) for s in samples]), 300.0, 400) for n in range(12)}
    counts = spark.createDataFrame(rows_of(genes, samples), SCHEMA)
    out = {}
    for names in ((), ("batch",)):
        layout = family.family_layout(samples, "C", names)
        own = regression.precisions(counts, layout)
        fits = regression.fit_family(counts.join(own, "gene_id"), layout).filter("treatment = 'T1'").collect()
        out[names] = own.first().common_precision, {r.gene_id: r.gene_lr for r in fits}
    assert out["batch",][0] > 4 * out[()][0]
    effect = [g for g in genes if int(g[1:]) % 2 == 0]
    assert all(out["batch",][1][g] > 9.2 for g in effect) and sum(out[()][1][g] > 9.2 for g in effect) < 4


@pytest.mark.parametrize(("precision", "depth"), [(20.0, 400), (200.0, 400)])
def test_known_precision_is_recovered(spark, precision, depth):
    """Within 15 % for the common value of 120 genes; the adjustment matters: without it the estimate is too high."""
    rng = np.random.default_rng(5)
    samples = sheet()
    genes = {f"g{n}": drawn(rng, np.tile(rng.dirichlet([4, 3, 3]), (11, 1)), precision, depth) for n in range(120)}
    counts = spark.createDataFrame(rows_of(genes, samples), SCHEMA)
    layout = family.family_layout(samples, "C")
    own = regression.precisions(counts, layout).collect()
    assert len(own) == 120 and own[0].common_precision == pytest.approx(precision, rel=0.15)
    logs = np.log([r.precision for r in own])
    assert abs(np.median(logs) - math.log(precision)) < 0.25 and logs.std() < 0.6
    at = regression.grid()
    raw = np.mean([regression.fit(np.broadcast_to(y, (len(at), *y.shape)), layout.design, np.exp(at))[1] for y in genes.values()], axis=0)
    assert regression.peak(at, raw) > math.log(own[0].common_precision) + 0.15


def test_null_and_changed_genes(spark):
    rng = np.random.default_rng(6)
    samples = sheet()
    flat = {f"n{n}": drawn(rng, np.tile(rng.dirichlet([5, 4, 3]), (11, 1)), 50.0, 120) for n in range(60)}
    moved = {f"m{n}": drawn(rng, np.array([[0.6, 0.2, 0.2] if s["condition"] != "T2" else [0.2, 0.2, 0.6] for s in samples]), 50.0, 120) for n in range(10)}
    counts = spark.createDataFrame(rows_of({**flat, **moved}, samples), SCHEMA)
    layout = family.family_layout(samples, "C")
    fits = regression.fit_family(counts.join(regression.precisions(counts, layout), "gene_id"), layout).collect()
    p = {(r.gene_id, r.treatment): models.chi_square_sf(r.gene_lr, r.gene_df) for r in fits}
    omnibus = {r.gene_id: models.chi_square_sf(r.omnibus_lr, r.omnibus_df) for r in fits}
    null = [v for (g, _), v in p.items() if g[0] == "n"]
    assert np.mean(np.array(null) <= 0.05) <= 0.15
    assert all(p[g, "T2"] < 1e-3 and omnibus[g] < 1e-3 for g in moved) and sum(p[g, "T1"] < 0.05 for g in moved) <= 3


def test_status(spark):
    samples = sheet()
    own = {"C": [50, 40, 10], "T1": [0, 60, 40], "T2": [0, 0, 0]}
    rows = [("g", f"p{k}", s["sample_id"], s["condition"], own[s["condition"]][k] + (own[s["condition"]][k] > 0) * n, 30.0) for n, s in enumerate(samples) for k in range(3)]
    rows += [("lone", "q", s["sample_id"], s["condition"], 9, 30.0) for s in samples] + [("none", f"z{k}", s["sample_id"], s["condition"], 0, 30.0) for s in samples for k in range(2)]
    got = regression.fit_family(spark.createDataFrame(rows, SCHEMA + ", precision double"), family.family_layout(samples, "C")).collect()
    assert {(r.gene_id, r.treatment): r.status for r in got} == {("g", "T1"): "boundary", ("g", "T2"): "empty_group"}
    assert all(r.gene_lr is None and r.control_fit is None for r in got if r.treatment == "T2")
    first = next(r for r in got if r.treatment == "T1" and r.pac_id == "p0")
    assert first.treatment_fit < 0.01 and first.pac_lr > 10


def test_no_genes(spark):
    layout = family.family_layout(sheet(), "C")
    empty = spark.createDataFrame([], SCHEMA)
    assert regression.precisions(empty, layout).collect() == []


def test_peak_and_between():
    at = np.array([0.0, 1.0, 2.5, 3.0])
    curve = -((at - 1.7) ** 2)
    assert regression.peak(at, curve) == pytest.approx(1.7) and regression.peak(at, at) == 3.0
    assert np.allclose(regression.between(at, curve, np.array([0.2, 1.9, 2.9])), -((np.array([0.2, 1.9, 2.9]) - 1.7) ** 2))


def test_boundary_genes_are_taken_from_repeats(spark):
    """A site that a condition doesn't use: medians over repeats, the same each time; an unused condition leaves its contrast untested; a changing direction makes a site unstable."""
    samples = sheet()
    own = {"on": {"C": [60, 40, 0], "T1": [30, 40, 30], "T2": [60, 40, 5]}, "off": {"C": [50, 50], "T1": [0, 0], "T2": [40, 60]}, "plain": {"C": [50, 50], "T1": [40, 60], "T2": [45, 55]}, "tiny": {"C": [1, 0], "T1": [1, 0], "T2": [1, 1]}}
    rows = [(g, f"{g}.{k}", s["sample_id"], s["condition"], float(v + (v > 1) * (n % 3)), 40.0) for g, levels in own.items() for n, s in enumerate(samples) for k, v in enumerate(levels[s["condition"]])]
    counts = spark.createDataFrame(rows, "gene_id string, pac_id string, sample_id string, condition string, count double, precision double")
    layout = family.family_layout(samples, "C")
    fits = regression.fit_family(counts, layout)
    out = [{(r.pac_id, r.treatment): r for r in regression.stabilised(counts, fits, layout).collect()} for _ in range(2)]
    assert out[0] == out[1] and len(out[0]) == 18
    got = out[0]
    before = {(r.pac_id, r.treatment): r for r in fits.collect()}
    on = got["on.2", "T1"]
    assert (on.status, on.successes, on.unstable) == ("fitted_with_zero_count_stabilization", 10, "") and on.delta_spread < 0.05 and 0 < on.control_fit < 0.01 and on.pac_lr > 10
    assert {got[f"off.{k}", "T1"].status for k in range(2)} == {"group_without_counts"} and got["off.0", "T1"].gene_lr is None and got["off.0", "T2"].gene_lr is not None
    assert got["plain.0", "T1"].status == "fitted" and got["plain.0", "T1"].gene_lr == before["plain.0", "T1"].gene_lr and got["plain.0", "T1"].successes == 0
    tiny = [got[f"tiny.{k}", "T1"] for k in range(2)]
    assert all("direction_change" in r.unstable and r.pac_lr is None for r in tiny)
