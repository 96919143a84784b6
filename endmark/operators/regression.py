"""Dirichlet-multinomial regression of site usage on a design, for all genes of a comparison family.

In each sample a gene's counts over its K sites are Dirichlet-multinomial; the log-ratios of its K - 1 first sites to the last are linear in the sample's
design row, and the precision is the gene's. The family's samples, covariates and contrasts come from `family.Layout`. Coefficients are found by Newton
steps, where the observed information isn't positive definite by scoring steps (a curvature whose expectation is the Fisher information), with step halving; a nested design, without all treatments (omnibus) or
without one (contrast), gives likelihood-ratio tests. Each site is tested in its two-category margin at the gene's precision.

The precision maximises the profile likelihood less half the log determinant of the observed information (Cox and Reid): first the mean over all
genes, on a grid and then on a finer one around its peak (common precision), then for each gene its own curve plus `weight` times that mean.

A gene is one group of sites x samples rows; models of a gene (precisions, designs' margins) are fitted side by side as one batch. A curve of a few
precisions is all that is gathered over genes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import reasons
from ..plans.storage import spread, written
from .family import Layout
from .models import digamma, log_gamma

LEAST, MOST, POINTS, FINE = 0.5, 50_000.0, 15, 9
LEAST_A, STEEPEST, FLAT = 1e-10, 30.0, 1e-3


def trigamma(x: np.ndarray) -> np.ndarray:
    """Recurrence up to 8, then the asymptotic series."""
    x = np.asarray(x, dtype=float)
    out = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        out = out + np.where(low, 1 / np.where(low, x * x, 1.0), 0.0)
        x = np.where(low, x + 1, x)
    r = 1 / (x * x)
    return out + 1 / x + r / 2 + r / x * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))


def shares(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """models x samples x sites."""
    eta = np.clip(np.einsum("sp,bpk->bsk", x, beta), -STEEPEST, STEEPEST)
    e = np.exp(np.concatenate([eta, np.zeros((*eta.shape[:2], 1))], axis=2))
    return e / e.sum(axis=2, keepdims=True)


def likelihood(y: np.ndarray, share: np.ndarray, precision: np.ndarray) -> np.ndarray:
    """Without the multinomial constant, for each model."""
    a = np.maximum(share * precision[:, None, None], LEAST_A)
    n = y.sum(axis=2)
    own = log_gamma(precision)[:, None] - log_gamma(n + precision[:, None])
    return own.sum(axis=1) + (log_gamma(y + a) - log_gamma(a)).sum(axis=(1, 2))


def _derivatives(y: np.ndarray, x: np.ndarray, share: np.ndarray, precision: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, scoring matrix and observed information in the coefficients."""
    a = np.maximum(share * precision[:, None, None], LEAST_A)
    h = a * (digamma(y + a) - digamma(a))
    m = a * a * (trigamma(a) - trigamma(y + a))
    k = share.shape[2] - 1
    own, first, each = share[:, :, :k], h[:, :, :k], m[:, :, :k]
    total, whole = h.sum(axis=2)[..., None], m.sum(axis=2)[..., None, None]
    score = first - own * total
    square = own[..., :, None] * own[..., None, :]
    eye = np.eye(k)

    def spreads(v: np.ndarray, all_v: np.ndarray) -> np.ndarray:
        cross = v[..., :, None] * own[..., None, :]
        return v[..., None] * eye - cross - np.swapaxes(cross, 2, 3) + all_v * square

    curve = spreads(each, whole)
    bend = spreads(first, total[..., None]) - total[..., None] * (own[..., None] * eye - square)
    size = x.shape[1] * k
    full = lambda w: np.einsum("sp,sq,bsij->bpiqj", x, x, w).reshape(len(y), size, size)
    return np.einsum("sp,bsk->bpk", x, score), full(curve), full(curve - bend)


def fit(y: np.ndarray, x: np.ndarray, precision: np.ndarray, rounds: int = 60, tolerance: float = 1e-8) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (models x columns x sites - 1) and log-likelihoods of a batch. y: models x samples x sites, x: samples x columns."""
    n = y.sum(axis=2)
    weight = np.sqrt(np.minimum(n, precision[:, None]) + 1e-3)
    target = np.log((y[:, :, :-1] + 0.5) / (y[:, :, -1:] + 0.5))
    beta = np.stack([np.linalg.lstsq(x * w[:, None], t * w[:, None], rcond=None)[0] for w, t in zip(weight, target, strict=True)])
    value = likelihood(y, shares(x, beta), precision)
    todo = np.arange(len(y))
    for _ in range(rounds):
        share = shares(x, beta[todo])
        score, curve, observed = _derivatives(y[todo], x, share, precision[todo])
        size = curve.shape[1]
        low = np.linalg.eigvalsh(observed)
        curve = np.where((low[:, 0] > 1e-9 * low[:, -1])[:, None, None], observed, curve)
        ridge = (1e-9 + 1e-9 * np.trace(curve, axis1=1, axis2=2) / size)[:, None, None] * np.eye(size)
        step = np.linalg.solve(curve + ridge, score.reshape(len(todo), size, 1)).reshape(score.shape)
        step /= np.maximum(1.0, np.abs(step).max(axis=(1, 2)) / 5)[:, None, None]
        gain, scale, open_ = np.zeros(len(todo)), 1.0, np.arange(len(todo))
        while len(open_) and scale > 1e-4:
            at = todo[open_]
            new = beta[at] + scale * step[open_]
            got = likelihood(y[at], shares(x, new), precision[at])
            better = got >= value[at]
            gain[open_[better]] = got[better] - value[at[better]]
            beta[at[better]], value[at[better]] = new[better], got[better]
            open_, scale = open_[~better], scale / 2
        todo = todo[gain > tolerance * (1 + np.abs(value[todo]))]
        if not len(todo):
            break
    return beta, value


def adjusted(y: np.ndarray, x: np.ndarray, precisions: np.ndarray) -> np.ndarray:
    """The adjusted profile log-likelihood of a gene (samples x sites) at each precision. Directions in which the likelihood is flat count alike at all."""
    many = np.broadcast_to(y, (len(precisions), *y.shape))
    beta, value = fit(many, x, precisions, tolerance=1e-6)
    observed = _derivatives(many, x, shares(x, beta), precisions)[2]
    return value - 0.5 * np.log(np.maximum(np.linalg.eigvalsh(observed), FLAT)).sum(axis=1)


def peak(at: np.ndarray, values: np.ndarray) -> float:
    """Where a curve over ascending points is highest: the vertex of the parabola through its best point and the neighbours."""
    k = int(np.argmax(values))
    if not 0 < k < len(at) - 1:
        return float(at[k])
    (a, b, c), (u, v, w) = at[k - 1 : k + 2], values[k - 1 : k + 2]
    bottom = (b - a) * (v - w) - (b - c) * (v - u)
    return float(b - ((b - a) ** 2 * (v - w) - (b - c) ** 2 * (v - u)) / (2 * bottom)) if bottom > 0 else float(b)


def between(at: np.ndarray, values: np.ndarray, to: np.ndarray) -> np.ndarray:
    """A curve at other points: the parabola through the three given points nearest to each."""
    k = np.clip(np.searchsorted(at, to), 1, len(at) - 2)
    a, b, c = at[k - 1], at[k], at[k + 1]
    return values[k - 1] * (to - b) * (to - c) / ((a - b) * (a - c)) + values[k] * (to - a) * (to - c) / ((b - a) * (b - c)) + values[k + 1] * (to - a) * (to - b) / ((c - a) * (c - b))


def grid() -> np.ndarray:
    """Logarithms of the precisions that are tried first."""
    return np.linspace(math.log(LEAST), math.log(MOST), POINTS)


def _counts(part: pd.DataFrame, layout: Layout) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Sites in order, counts (samples x sites) and design rows of the samples with reads."""
    wide = part.pivot_table(index="sample_id", columns="pac_id", values="count", aggfunc="sum", fill_value=0).reindex(layout.samples, fill_value=0)
    y = wide.to_numpy(dtype=float)
    return list(wide.columns), y, y.sum(axis=1) > 0


def _usable(y: np.ndarray, keep: np.ndarray) -> bool:
    return y.shape[1] > 1 and keep.any()


def curves(counts: DataFrame, layout: Layout, at: np.ndarray) -> DataFrame:
    """(gene_id, curve): each gene's adjusted profile log-likelihood at exp(at). counts: gene_id, pac_id, sample_id, count."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        _, y, keep = _counts(part, layout)
        rows = [(part.gene_id.iloc[0], adjusted(y[keep], layout.design[keep], np.exp(at)).tolist())] if _usable(y, keep) else []
        return pd.DataFrame(rows, columns=["gene_id", "curve"])

    return spread(counts, "gene_id").groupBy("gene_id").applyInPandas(run, "gene_id string, curve array<double>")


def _mean_curve(own: DataFrame) -> np.ndarray:
    rows = own.select(F.posexplode("curve").alias("k", "v")).groupBy("k").agg(F.avg("v").alias("v")).orderBy("k").collect()  # a row a grid point
    return np.array([r.v for r in rows])


def common_precision(counts: DataFrame, layout: Layout, own: DataFrame) -> tuple[float, np.ndarray]:
    """The precision at which the mean curve of all genes peaks, and that curve over `grid()`; nan and nothing without genes. own: `curves` over the grid."""
    at = grid()
    mean = _mean_curve(own)
    if not len(mean):
        return math.nan, mean
    step, best = at[1] - at[0], peak(at, mean)
    near = np.linspace(best - step / 2, best + step / 2, FINE)
    return math.exp(peak(near, _mean_curve(curves(counts, layout, near)))), mean


PRECISION = "gene_id string, precision double, common_precision double"


def precisions(counts: DataFrame, layout: Layout, weight: float = 5.0) -> DataFrame:
    """(gene_id, precision, common_precision): each gene's precision where its own curve plus `weight` times the mean one is highest."""
    at = grid()
    own = written(curves(counts, layout, at))
    common, mean = common_precision(counts, layout, own)

    def run(part: pd.DataFrame, curve: pd.DataFrame) -> pd.DataFrame:
        if not len(curve) or not len(part):
            return pd.DataFrame(columns=["gene_id", "precision", "common_precision"])
        _, y, keep = _counts(part, layout)
        step = at[1] - at[0]
        best = peak(at, np.array(curve.curve.iloc[0]) + weight * mean)
        near = np.unique(np.clip(np.linspace(best - step / 2, best + step / 2, FINE), at[0], at[-1]))
        fine = adjusted(y[keep], layout.design[keep], np.exp(near)) + weight * between(at, mean, near)
        return pd.DataFrame([(part.gene_id.iloc[0], math.exp(peak(near, fine)), common)], columns=["gene_id", "precision", "common_precision"])

    return spread(counts, "gene_id").groupBy("gene_id").cogroup(spread(own, "gene_id").groupBy("gene_id")).applyInPandas(run, PRECISION)


FITS = ("gene_id string, treatment string, pac_id string, control_fit double, treatment_fit double, gene_lr double, gene_df int, pac_lr double, omnibus_lr double, omnibus_df int, status string")


def fit_family(counts: DataFrame, layout: Layout) -> DataFrame:
    """counts (gene_id, pac_id, sample_id, count, precision) of complete genes -> a row for each treatment and site: mean fitted share of the control's and the
    treatment's samples, the contrast's and the site's likelihood ratios (sites - 1 and 1 degrees of freedom), the omnibus ratio over all treatments and status:
    `ok`, `empty_group` (the gene has no reads in the control or the treatment: no fit of the contrast), `boundary` (a site no sample of some condition uses),
    `failed` (a ratio is not finite). Genes with one site are left out."""
    control, *treatments = layout.groups
    member = {g: np.array([layout.conditions[s] == g for s in layout.samples]) for g in layout.groups}
    last = [layout.columns.index(t) for t in treatments]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        sites, y, keep = _counts(part, layout)
        out = []
        if _usable(y, keep):
            gene, precision = part.gene_id.iloc[0], float(part.precision.iloc[0])
            rows, x = y[keep], layout.design[keep]
            # the gene over all its sites, then each site against the rest
            one, two = rows[None], np.stack([np.stack([rows[:, k], rows.sum(axis=1) - rows[:, k]], axis=1) for k in range(len(sites))])
            same, each = np.array([precision]), np.full(len(sites), precision)
            beta, whole = fit(one, x, same)
            margins = fit(two, x, each)[1]
            fitted = shares(layout.design, beta)[0]
            without = np.delete(x, last, axis=1)
            omnibus = max(0.0, 2 * float(whole[0] - fit(one, without, same)[1][0]))
            unused = any(((y[member[g]].sum(axis=0) == 0) & (y.sum(axis=0) > 0)).any() for g in layout.groups if y[member[g]].sum() > 0)
            for t, column in zip(treatments, last, strict=True):
                empty = not (y[member[control]].sum() and y[member[t]].sum())
                less = np.delete(x, column, axis=1)
                lr = max(0.0, 2 * float(whole[0] - fit(one, less, same)[1][0]))
                own = np.maximum(0.0, 2 * (margins - fit(two, less, each)[1]))
                status = "empty_group" if empty else "failed" if not (np.isfinite(lr) and np.isfinite(own).all()) else "boundary" if unused else "ok"
                c, d = fitted[member[control]].mean(axis=0), fitted[member[t]].mean(axis=0)
                out += [(gene, t, s, None if empty else float(c[k]), None if empty else float(d[k]), None if empty else lr, len(sites) - 1, None if empty else float(own[k]), omnibus, (len(sites) - 1) * len(treatments), status)
                        for k, s in enumerate(sites)]
        return pd.DataFrame(out, columns=[f.split()[0] for f in FITS.split(", ")])

    return spread(counts, "gene_id").groupBy("gene_id").applyInPandas(run, FITS)


#: Draws that replace zeros lie below this; a share of the repeats must succeed; a change of direction counts beyond the tolerance.
PERTURBATION, LEAST_SHARE, TOLERANCE = 0.1, 0.8, 0.001


def stabilised(counts: DataFrame, fits: DataFrame, layout: Layout, repeats: int = 10, most_spread: float = 0.2, seed: int = 1) -> DataFrame:
    """fits (of `fit_family`) with the genes at a boundary (a site that a condition doesn't use, or a failed fit) taken from repeated fits in which their zeros are
    uniform draws below 0.1; counts as for `fit_family`. Every value of such a gene is the median over the repeats that succeeded, whose number is `successes`; the spread of the difference is `delta_spread` and
    `unstable` says what speaks against it, joined by `;`: insufficient_successes (under 80 % of the repeats), direction_change, delta_spread (over most_spread). An unstable site has no ratio of its own.
    status: `fitted`, `fitted_with_zero_count_stabilization`, `fit_unavailable` (a boundary gene without zeros, or whose repeats fail) or `group_without_counts`. Draws depend on the gene, the repeat, the site and the
    sample alone; perturbed counts reach no output."""
    boundary = fits.filter(F.col("status").isin("boundary", "failed")).select("gene_id").distinct()
    zeros = counts.join(boundary, "gene_id", "left_semi").groupBy("gene_id").agg(F.count_if(F.col("count") == 0).alias("_zeros")).filter("_zeros > 0").select("gene_id")
    many = counts.join(zeros, "gene_id", "left_semi").withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    noise = (F.pmod(F.xxhash64(F.lit(seed), "gene_id", "pac_id", "sample_id", "repeat"), F.lit(1_000_003)) + 1) / F.lit(1_000_004.0) * PERTURBATION
    many = many.withColumn("count", F.when(F.col("count") == 0, noise).otherwise(F.col("count").cast("double"))).withColumn("gene_id", F.concat_ws("\t", F.col("repeat").cast("string"), "gene_id"))
    again = fit_family(many.drop("repeat"), layout).withColumn("gene_id", F.expr("substr(gene_id, instr(gene_id, '\t') + 1)"))
    delta = F.col("treatment_fit") - F.col("control_fit")
    good = F.coalesce(F.abs("gene_lr") + F.abs("pac_lr") + F.abs(delta) < float("inf"), F.lit(False)) & (F.col("status") != "failed")
    of = lambda c: F.when(good, c)
    middle = {n: F.percentile(of(F.col(n)), 0.5).alias(f"_{n}") for n in ("control_fit", "treatment_fit", "gene_lr", "pac_lr", "omnibus_lr")}
    per = again.groupBy("gene_id", "treatment", "pac_id").agg(*middle.values(), F.count_if(good).cast("int").alias("_successes"), F.min(of(delta)).alias("_low"), F.max(of(delta)).alias("_high"))
    d = fits.join(per, ["gene_id", "treatment", "pac_id"], "left").join(boundary.withColumn("_boundary", F.lit(True)), "gene_id", "left")
    redone, few = F.col("_successes").isNotNull(), F.col("_successes") < math.ceil(LEAST_SHARE * repeats - 1e-9)
    spread_ = F.col("_high") - F.col("_low")
    why = reasons((few, "insufficient_successes"), ((F.col("_low") < -TOLERANCE) & (F.col("_high") > TOLERANCE), "direction_change"), (spread_ > most_spread, "delta_spread"))
    empty = F.col("status") == "empty_group"
    status = F.when(empty, "group_without_counts").when(redone & (F.col("_successes") > 0), "fitted_with_zero_count_stabilization").when(F.col("_boundary"), "fit_unavailable").otherwise("fitted")
    d = d.withColumn("_status", status).withColumn("unstable", F.when(redone & ~empty, why).otherwise(""))
    taken = {n: F.when(F.col("_status") == "fitted", F.col(n)).when(F.col("_status") == "fitted_with_zero_count_stabilization", F.col(f"_{n}")).alias(n) for n in middle}
    taken["gene_lr"] = F.when(~(redone & few), taken["gene_lr"]).alias("gene_lr")
    taken["pac_lr"] = F.when(F.col("unstable") == "", taken["pac_lr"]).alias("pac_lr")
    columns = [taken.get(f.split()[0], F.col("_status").alias("status") if f.startswith("status") else F.col(f.split()[0])) for f in FITS.split(", ")]
    return d.select(*columns, F.coalesce("_successes", F.lit(0)).alias("successes"), spread_.alias("delta_spread"), "unstable")
