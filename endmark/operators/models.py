"""Dirichlet-multinomial models of site usage within genes, and what is decided from them.

A gene's counts over its sites in a sample are Dirichlet-multinomial with the condition's proportions and a precision of the gene. A
gene is one group of at most sites x samples rows; genes are fitted side by side by a grouped pandas function. Only the shared
precision (a grid's likelihoods summed over genes) reaches the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import spread

#: Grid of precisions for the shared estimate.
GRID = tuple(float(x) for x in np.geomspace(2, 20000, 25))

# Lanczos coefficients (g = 7, n = 9) of the log-gamma function.
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0: the series at x + 1, less log x."""
    x = np.asarray(x, dtype=float)
    t = x + 7.5
    total = np.full_like(x, _LANCZOS[0])
    for k, c in enumerate(_LANCZOS[1:], 1):
        total = total + c / (x + k)
    return 0.5 * math.log(2 * math.pi) + (x + 0.5) * np.log(t) - t + np.log(total) - np.log(x)


def _erfc(z: Column) -> Column:
    """The complementary error function for z >= 0: the power series below 2, the continued fraction, 80 levels deep, from there on."""
    steps = F.sequence(F.lit(1), F.lit(80))
    start = F.struct(z.alias("term"), z.alias("total"))
    grown = lambda s, n: s["term"] * 2 * z * z / (2 * n + 1)
    series = F.aggregate(steps, start, lambda s, n: F.struct(grown(s, n).alias("term"), (s["total"] + grown(s, n)).alias("total")), lambda s: s["total"])
    gauss = F.exp(-z * z)
    fraction = F.aggregate(steps, z, lambda f, n: z + (81 - n) / 2 / f)
    return F.when(z < 2, 1 - 2 / math.sqrt(math.pi) * gauss * series).otherwise(gauss / math.sqrt(math.pi) / fraction)


def chi_square_tail(x: Column, df: Column) -> Column:
    """Upper tail for whole degrees of freedom, null unless finite: a finite sum for even df, the normal tail plus one for odd df."""
    x, df = x.cast("double"), df.cast("int")
    odd = df % 2 == 1
    first = F.when(odd, F.sqrt(2 * x / math.pi)).otherwise(F.lit(1.0)) * F.exp(-x / 2)
    n = F.floor(df / 2).cast("int")
    terms = F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    start = F.struct(first.alias("term"), F.lit(0.0).alias("total"))
    step = lambda s, k: F.struct((s["term"] * x / F.when(odd, 2 * k + 1).otherwise(2 * k)).alias("term"), (s["total"] + s["term"]).alias("total"))
    total = F.aggregate(terms, start, step, lambda s: s["total"]) + F.when(odd, _erfc(F.sqrt(x / 2))).otherwise(0.0)
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & (df >= 1)
    return F.when(finite, F.when(x <= 0, 1.0).otherwise(F.least(F.lit(1.0), total)))


def chi_square_sf(x: float, df: int) -> float:
    if x <= 0:
        return 1.0
    if df % 2 == 0:
        term = total = math.exp(-x / 2)
        for k in range(1, df // 2):
            term *= x / (2 * k)
            total += term
    else:
        total = math.erfc(math.sqrt(x / 2))
        term = math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        for k in range(1, (df - 1) // 2 + 1):
            total += term
            term *= x / (2 * k + 1)
    return min(1.0, total)


def log_likelihood(y: np.ndarray, p: np.ndarray, precision: np.ndarray | float) -> np.ndarray:
    """Without the multinomial constant, for each model of a batch. y: models x samples x sites, p: models x sites; a sample without counts adds 0."""
    precision = np.broadcast_to(np.asarray(precision, dtype=float), len(p))
    a = np.maximum(p * precision[:, None], 1e-10)
    n = y.sum(axis=2)
    own = log_gamma(precision)[:, None] - log_gamma(n + precision[:, None])
    return own.sum(axis=1) + (log_gamma(y + a[:, None, :]) - log_gamma(a)[:, None, :]).sum(axis=(1, 2))


def _mean_step(y: np.ndarray, p: np.ndarray, precision: float) -> np.ndarray:
    """Minka's fixed point on the mean: the sum over j < y of 1 / (a + j), a difference of digammas, weighs each site."""
    a = np.maximum(p * precision, 1e-10)
    w = a * (digamma(y + a[:, None, :]) - digamma(a)[:, None, :]).sum(axis=1)
    return w / np.maximum(w.sum(axis=1, keepdims=True), 1e-300)


def fit_proportions(y: np.ndarray, precision: float, rounds: int = 40, tolerance: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood proportions of each model of a batch at a given precision: fixed-point steps, extrapolated from two of them and
    followed by a third (SQUAREM). A model is done when no proportion moves by more than tolerance. -> (models x sites, log-likelihoods)"""
    p, todo = (y.sum(axis=1) + 1e-3) / (y.sum(axis=(1, 2)) + 1e-3 * y.shape[2])[:, None], np.arange(len(y))
    for _ in range(rounds):
        at, p0 = y[todo], p[todo]
        p1 = _mean_step(at, p0, precision)
        p2 = _mean_step(at, p1, precision)
        r, v = p1 - p0, p2 - 2 * p1 + p0
        alpha = -np.maximum(1.0, np.sqrt((r * r).sum(axis=1) / np.maximum((v * v).sum(axis=1), 1e-30)))[:, None]
        far = np.maximum(p0 - 2 * alpha * r + alpha * alpha * v, 1e-12)
        new = _mean_step(at, far / far.sum(axis=1, keepdims=True), precision)
        worse = log_likelihood(at, new, precision) < log_likelihood(at, p2, precision)
        new[worse] = p2[worse]
        p[todo] = new
        todo = todo[np.abs(new - p0).max(axis=1) > tolerance]
        if not len(todo):
            break
    return p, log_likelihood(y, p, precision)


def digamma(x: np.ndarray) -> np.ndarray:
    """Recurrence up to 6, then the asymptotic series."""
    x = np.asarray(x, dtype=float)
    out = np.zeros_like(x)
    for _ in range(6):
        out = out - np.where(x < 6, 1 / np.maximum(x, 1e-300), 0)
        x = np.where(x < 6, x + 1, x)
    r = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r / 240)))


def _matrix(part: pd.DataFrame) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Sites, conditions, counts (samples x sites) and the condition's number of each sample."""
    wide = part.pivot_table(index=["condition", "sample_id"], columns="pac_id", values="count", aggfunc="sum", fill_value=0).sort_index()
    conditions = sorted(part.condition.unique())
    return list(wide.columns), conditions, wide.to_numpy(dtype=float), np.array([conditions.index(c) for c in wide.index.get_level_values(0)])


def precision_grid(counts: DataFrame, grid: tuple[float, ...] = GRID) -> DataFrame:
    """(gene_id, precision, log_likelihood) of each gene at each grid point, with the pooled proportions of each condition."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        _, conditions, y, group = _matrix(part)
        keep = y.sum(axis=1) > 0
        y, group = y[keep], group[keep]
        total = np.zeros(len(grid))
        for c in sorted(set(group)):
            one = y[group == c]
            p = one.sum(axis=0) / one.sum()
            total += log_likelihood(np.broadcast_to(one, (len(grid), *one.shape)), np.broadcast_to(p, (len(grid), len(p))), np.array(grid))
        out = [(part.gene_id.iloc[0], g, float(v)) for g, v in zip(grid, total, strict=True)] if len(y) else []
        return pd.DataFrame(out, columns=["gene_id", "precision", "log_likelihood"])

    return spread(counts, "gene_id").groupBy("gene_id").applyInPandas(run, "gene_id string, precision double, log_likelihood double")


def moderated_precision(counts: DataFrame, weight: float = 5.0, grid: tuple[float, ...] = GRID) -> DataFrame:
    """(gene_id, precision): each gene's best grid point of its own likelihood plus `weight` times the mean one over all genes."""
    own = precision_grid(counts, grid)
    shared = own.groupBy("precision").agg(F.avg("log_likelihood").alias("shared"))  # a row a grid point
    mixed = own.join(F.broadcast(shared), "precision").withColumn("v", F.col("log_likelihood") + weight * F.col("shared"))
    return mixed.groupBy("gene_id").agg(F.max_by("precision", F.struct(F.col("v"), -F.col("precision"))).alias("precision"))


def fit_genes(counts: DataFrame, control: str) -> DataFrame:
    """counts: gene_id, pac_id, sample_id, condition, count, precision (complete). For each gene and treatment: fitted proportions of control and treatment
    and likelihood-ratio statistics of the gene (sites - 1 degrees of freedom) and of each site against the rest (1).
    -> (gene_id, treatment, pac_id, control_fit, treatment_fit, gene_lr, gene_df, pac_lr)"""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        gene, precision = part.gene_id.iloc[0], float(part.precision.iloc[0])
        sites, conditions, y, group = _matrix(part)
        out = []
        if control in conditions:
            for treatment in conditions:
                if treatment == control:
                    continue
                c, t = (y * (group == conditions.index(x))[:, None] for x in (control, treatment))
                if not c.sum() or not t.sum():
                    continue
                p, value = fit_proportions(np.stack([c, t, c + t]), precision)
                # each site against the rest, in the same three groups
                two = np.concatenate([np.stack([m.T, m.sum(axis=1) - m.T], axis=2) for m in (c, t, c + t)])
                own = fit_proportions(two, precision)[1].reshape(3, len(sites))
                lr = np.maximum(0, 2 * (own[0] + own[1] - own[2]))
                gene_lr = max(0.0, float(2 * (value[0] + value[1] - value[2])))
                out += [(gene, treatment, site, float(p[0, k]), float(p[1, k]), gene_lr, len(sites) - 1, float(lr[k])) for k, site in enumerate(sites)]
        return pd.DataFrame(out, columns=["gene_id", "treatment", "pac_id", "control_fit", "treatment_fit", "gene_lr", "gene_df", "pac_lr"])

    return spread(counts, "gene_id").groupBy("gene_id").applyInPandas(run, "gene_id string, treatment string, pac_id string, control_fit double, treatment_fit double, gene_lr double, gene_df int, pac_lr double")


def boundary_genes(counts: DataFrame) -> DataFrame:
    """Genes with a site that no sample of some condition uses."""
    return counts.groupBy("gene_id", "pac_id", "condition").agg(F.sum("count").alias("n")).filter("n = 0").select("gene_id").distinct()


def stabilised(counts: DataFrame, control: str, repeats: int = 10, seed: int = 1) -> DataFrame:
    """Refits of boundary genes with zeros replaced by uniform draws below 0.1, `repeats` times: the median delta of each site and why it is unstable
    (direction_change beyond 0.001, delta_spread over 0.2), empty if stable. Draws depend on the gene and the repeat alone."""
    boundary = counts.join(boundary_genes(counts), "gene_id", "left_semi")
    many = boundary.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    noise = F.pmod(F.xxhash64(F.lit(seed), "gene_id", "pac_id", "sample_id", "repeat"), F.lit(1_000_003)) / F.lit(1_000_003.0) * 0.1
    many = many.withColumn("count", F.when(F.col("count") == 0, noise).otherwise(F.col("count").cast("double"))).withColumn("gene_id", F.concat_ws("\t", "gene_id", F.col("repeat").cast("string")))
    fits = fit_genes(many.drop("repeat"), control).withColumn("delta", F.col("treatment_fit") - F.col("control_fit")).withColumn("gene_id", F.substring_index("gene_id", "\t", 1))
    out = fits.groupBy("gene_id", "treatment", "pac_id").agg(F.percentile("delta", 0.5).alias("delta"), F.min("delta").alias("low"), F.max("delta").alias("high"))
    from ..functions.sequences import reasons

    return out.withColumn("unstable", reasons(((F.col("low") < -0.001) & (F.col("high") > 0.001), "direction_change"), (F.col("high") - F.col("low") > 0.2, "delta_spread")))


def bootstrap_deltas(counts: DataFrame, fits: DataFrame, control: str, treatment: str, replicates: int = 200, seed: int = 1) -> DataFrame:
    """Parametric bootstrap of the genes in fits (gene_id, pac_id, condition, fit, precision): for each replicate gamma draws give Dirichlet proportions and multinomial
    counts at the observed totals, which are fitted again. -> (gene_id, pac_id, replicate, delta); a failed fit has no row. Seeds depend on gene and replicate alone."""
    d = counts.filter(F.col("condition").isin(control, treatment)).join(fits, ["gene_id", "pac_id", "condition"])
    d = d.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn("seed", F.pmod(F.xxhash64(F.lit(seed), "gene_id", "replicate"), F.lit(2**31 - 1)))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng(int(part.seed.iloc[0]))
        precision, fitted = float(part.precision.iloc[0]), {}
        for condition, group in part.groupby("condition"):
            wide = group.pivot_table(index="sample_id", columns="pac_id", values="count", aggfunc="sum", fill_value=0).sort_index()
            p = group.groupby("pac_id").fit.first().reindex(wide.columns).to_numpy()
            drawn = rng.gamma(np.maximum(p * precision, 1e-10), size=wide.shape)
            drawn = drawn / np.maximum(drawn.sum(axis=1, keepdims=True), 1e-300)
            y = np.array([rng.multinomial(n, q / q.sum()) for n, q in zip(wide.sum(axis=1).astype(int), drawn, strict=True) if n > 0 and q.sum() > 0], dtype=float)
            if not len(y):
                return pd.DataFrame(columns=["gene_id", "pac_id", "replicate", "delta"])
            fitted[condition] = pd.Series(fit_proportions(y[None], precision)[0][0], index=wide.columns)
        if set(fitted) != {control, treatment}:
            return pd.DataFrame(columns=["gene_id", "pac_id", "replicate", "delta"])
        delta = fitted[treatment] - fitted[control]
        return pd.DataFrame({"gene_id": part.gene_id.iloc[0], "pac_id": delta.index, "replicate": int(part.replicate.iloc[0]), "delta": delta.to_numpy()})

    return spread(d, "gene_id", "replicate").groupBy("gene_id", "replicate").applyInPandas(run, "gene_id string, pac_id string, replicate int, delta double")


def stagewise(tests: DataFrame, alpha: float = 0.05, keys: list[str] | None = None) -> DataFrame:
    """Screen genes, then confirm sites, each value of keys (a comparison) by itself: tests (keys, gene_id, pac_id, gene_p, pac_p). gene_fdr by Benjamini-Hochberg over genes; in a gene that passes, sites are adjusted by Holm within the
    gene (with two sites both follow from the screen: 0) and scaled to the share of genes that pass; missing site p-values count as 1, then are null. Elsewhere pac_fdr is null."""
    from .testing import benjamini_hochberg

    keys = list(keys or [])
    genes = benjamini_hochberg(tests.groupBy(*keys, "gene_id").agg(F.first("gene_p").alias("gene_p")), "gene_p", "gene_fdr", keys)
    total = genes.groupBy(*keys).agg(F.count("gene_fdr").alias("_tested"), F.count_if(F.col("gene_fdr") <= alpha).alias("_passed"))  # a row for each comparison
    d = tests.drop("gene_p").join(genes, [*keys, "gene_id"])
    d = (d.join(total, keys) if keys else d.crossJoin(total)).withColumn("_p", F.coalesce("pac_p", F.lit(1.0)))
    w = Window.partitionBy(*keys, "gene_id").orderBy("_p", "pac_id")
    n = F.count("*").over(Window.partitionBy(*keys, "gene_id"))
    d = d.withColumn("_n", n).withColumn("_k", F.row_number().over(w))
    # with the gene's null rejected at most n - 2 site hypotheses can hold together when only differences count
    factor = F.greatest(F.least(F.col("_n") - F.col("_k") + 1, F.col("_n") - 2), F.lit(0))
    d = d.withColumn("_a", F.max(F.col("_p") * factor).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    scaled = F.least(F.lit(1.0), F.col("_a") * (F.col("_tested") / F.greatest("_passed", F.lit(1))))
    passes = F.col("gene_fdr") <= alpha
    return d.withColumn("pac_fdr", F.when(passes & F.col("pac_p").isNotNull(), F.when(F.col("_n") == 2, 0.0).otherwise(scaled))).drop("_p", "_n", "_k", "_a", "_tested", "_passed")


def usage_pca(pau: DataFrame, n_samples: int, least_total: int | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(samples, scores samples x components, variance shares) over PACs used in all samples, with least_total those of genes (gene_id, gene_total) with as many reads in every
    sample: the samples' Gram matrix is summed in Spark, its eigenvectors found on the driver (samples are few); a component's sign makes its largest loading positive, of
    loadings equal within 1e-6 the first by pac_id."""
    if least_total is not None:
        pau = pau.withColumn("_least", F.min("gene_total").over(Window.partitionBy("gene_id"))).filter(F.col("_least") >= least_total)
    whole = pau.filter("pau is not null").withColumn("_n", F.count("*").over(Window.partitionBy("pac_id"))).filter(F.col("_n") == n_samples)
    centred = whole.withColumn("x", F.col("pau") - F.avg("pau").over(Window.partitionBy("pac_id"))).select("pac_id", "sample_id", "x")
    other = centred.select("pac_id", F.col("sample_id").alias("b"), F.col("x").alias("y"))
    gram = centred.join(other, "pac_id").groupBy("sample_id", "b").agg(F.sum(F.col("x") * F.col("y")).alias("g")).collect()
    names = sorted({r.sample_id for r in gram})
    g = np.zeros((len(names), len(names)))
    for r in gram:
        g[names.index(r.sample_id), names.index(r.b)] = r.g
    values, vectors = np.linalg.eigh(g)
    order = [k for k in np.argsort(-values) if values[k] > 1e-12]
    scores = vectors[:, order] * np.sqrt(values[order])
    if order:
        parts = F.array(*[F.sum(F.col("x") * F.when(F.col("sample_id") == s, F.lit(1.0)).otherwise(0.0)) for s in names])
        loads = [F.aggregate(F.zip_with("v", F.array(*[F.lit(float(c)) for c in vectors[:, k]]), lambda a, b: a * b), F.lit(0.0), lambda s, a: s + a).alias(f"l{j}") for j, k in enumerate(order)]
        rows = centred.groupBy("pac_id").agg(parts.alias("v")).select("pac_id", *loads)
        top = rows.agg(*[F.max(F.abs(f"l{j}")).alias(f"m{j}") for j in range(len(order))]).first()
        best = rows.agg(*[F.min_by(f"l{j}", F.when(F.abs(f"l{j}") >= top[j] * (1 - 1e-6), F.col("pac_id"))).alias(f"b{j}") for j in range(len(order))]).first()
        scores = scores * np.array([1.0 if x >= 0 else -1.0 for x in best])
    return names, scores, values[order] / values[order].sum() if order else values[:0]


def kmer_enrichment(sites: DataFrame, k: int = 4, window: str = "window", keys: tuple[str, ...] = ()) -> DataFrame:
    """sites (gene_id, pac_id, event boolean, window): Mantel-Haenszel over genes with event and other sites, for k-mers seen in the gene: (kmer, strata, odds_ratio, chi_square, p, fdr).
    With keys (comparison) each of their values is tested by itself."""
    from ..functions.sequences import kmers
    from .testing import benjamini_hochberg, mantel_haenszel

    w = Window.partitionBy(*keys, "gene_id")
    d = sites.withColumn("_e", F.count_if("event").over(w)).withColumn("_b", F.count_if(~F.col("event")).over(w)).filter("_e > 0 and _b > 0")
    seen = d.select(*keys, "gene_id", "event", "_e", "_b", F.explode(kmers(F.col(window), k)).alias("kmer"))
    strata = seen.groupBy(*keys, "kmer", "gene_id", "_e", "_b").agg(F.count_if("event").alias("a"), F.count_if(~F.col("event")).alias("c")).withColumn("b", F.col("_e") - F.col("a")).withColumn("d", F.col("_b") - F.col("c"))
    tested = mantel_haenszel(strata, [*keys, "kmer"])
    return benjamini_hochberg(tested.withColumn("p", chi_square_tail(F.col("chi_square"), F.lit(1))), "p", "fdr", list(keys))


def moderated_t(values: np.ndarray, design: np.ndarray, contrast: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linear models of rows (motifs) with an empirical-Bayes variance: (estimates, t, degrees of freedom). Rows with missing values aren't passed in."""
    n, p = design.shape
    inverse = np.linalg.inv(design.T @ design)
    beta = values @ design @ inverse
    s2 = ((values - beta @ design.T) ** 2).sum(axis=1) / (n - p)
    df = n - p
    positive = s2[s2 > 0]
    d0, s0 = math.inf, float(positive.mean()) if len(positive) else 0.0
    if len(positive) > 1:
        z = np.log(positive)
        e = z - digamma(np.array([df / 2.0]))[0] + math.log(df / 2)
        spread = e.var(ddof=1) - trigamma(df / 2)
        if spread > 0:
            d0 = 2 * inverse_trigamma(spread)
            s0 = math.exp(e.mean() + digamma(np.array([d0 / 2]))[0] - math.log(d0 / 2))
        else:
            s0 = math.exp(e.mean())
    post = np.full_like(s2, s0) if math.isinf(d0) else (d0 * s0 + df * s2) / (d0 + df)
    estimate = beta @ contrast
    return estimate, estimate / np.sqrt(post * (contrast @ inverse @ contrast)), np.full(len(s2), min(df + d0, df * len(s2)))


def trigamma(x: float) -> float:
    total = 0.0
    while x < 6:
        total += 1 / (x * x)
        x += 1
    r = 1 / (x * x)
    return total + 1 / x + r / 2 + r / x * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))


def inverse_trigamma(y: float) -> float:
    low, high = 1e-8, 1e8
    for _ in range(200):
        mid = math.sqrt(low * high)
        low, high = (mid, high) if trigamma(mid) > y else (low, mid)
    return math.sqrt(low * high)
