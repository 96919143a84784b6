"""The whole analysis from evidence to calls, each table a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, candidates, clustering, family, joins, models, regression, testing
from .storage import written


@dataclass(frozen=True)
class Settings:
    depth_least_samples: int = 2
    depth_least_reads: int = 10
    depth_least_cpm: float = 0.0
    assembly: str = "x"
    seed_radius: int = 12
    cluster_radius: int = 24
    quantify_radius: int = 24
    pac_least_count: int = 10
    pac_least_samples: int = 2
    alpha: float = 0.05
    least_delta: float = 0.1
    zero_repeats: int = 10
    zero_most_spread: float = 0.2

    def __post_init__(self) -> None:
        for name in ("seed_radius", "cluster_radius", "quantify_radius"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")
        if not 0 < self.alpha < 1:
            raise ValueError("alpha must lie between 0 and 1")


def discover(evidence: DataFrame, settings: Settings) -> DataFrame:
    """Clusters (pac_id, contig, strand, coordinate, members, total) that enough reads and samples support."""
    clusters = written(clustering.greedy_clusters(evidence, settings.seed_radius, settings.cluster_radius))
    members = clusters.select("contig", "strand", "seed", F.explode("members").alias("coordinate"))
    support = members.join(evidence, ["contig", "strand", "coordinate"]).groupBy("contig", "strand", "seed", "sample_id").agg(F.sum("count").alias("n"))
    support = support.filter("n > 0").groupBy("contig", "strand", "seed").agg(F.count("*").alias("samples"))
    kept = clusters.join(support, ["contig", "strand", "seed"]).filter((F.col("total") >= settings.pac_least_count) & (F.col("samples") >= settings.pac_least_samples))
    name = F.concat_ws(".", F.lit("PACv1"), F.lit(settings.assembly), "contig", "strand", F.col("seed").cast("string"))
    return kept.select(name.alias("pac_id"), "contig", "strand", F.col("seed").alias("coordinate"), "members", "total", "samples")


def judge(evidence: DataFrame, samples: DataFrame, settings: Settings, known: DataFrame | None = None, continuations: DataFrame | None = None, support: candidates.Support | None = None, least_continuations: int = 2) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) clusters with support by condition, metrics, status and reasons. evidence: sample_id, contig, strand, coordinate, count, poly_a_clip_count; samples: sample_id, condition. With splice continuations the
    sites whose reads end in an exon that is spliced onward in every supporting condition are rejected too. Accepted ones carry what the atlas needs: pac_id, total, samples."""
    support = support or candidates.Support(least_total=settings.pac_least_count, least_samples=settings.pac_least_samples)
    clusters = written(clustering.greedy_clusters(evidence, settings.seed_radius, settings.cluster_radius))
    found = written(candidates.exact_candidates(clusters, evidence, samples, settings.cluster_radius, support, known))
    good, bad = found.filter("status <> 'rejected'"), found.filter("status = 'rejected'")
    if continuations is not None:
        good, through = candidates.readthrough(good, continuations, samples, least_continuations, 0, 1)
        bad = bad.unionByName(through)
    name = F.concat_ws(".", F.lit("PACv1"), F.lit(settings.assembly), "contig", "strand", F.col("coordinate").cast("string"))
    return good.withColumns({"pac_id": name, "total": F.col("total_count"), "samples": F.col("total_supporting_samples")}), bad


def quantify(evidence: DataFrame, atlas: DataFrame, settings: Settings) -> DataFrame:
    """Reads by site, gene and sample. atlas: pac_id, gene_id, contig, strand, coordinate."""
    sites = atlas.select("pac_id", "gene_id", "contig", "strand", F.col("coordinate").alias("site"))
    near = joins.nearest_within(evidence, sites, ["contig", "strand"], ["sample_id", "contig", "strand", "coordinate"], "coordinate", "site", settings.quantify_radius)
    return near.filter("pac_id is not null").groupBy("pac_id", "gene_id", "sample_id").agg(F.sum("count").alias("count"))


def compare(counts: DataFrame, atlas: DataFrame, samples: DataFrame, control: str, settings: Settings, covariates: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Tables of one family: counts, usage, filtering, sites (with FDRs, model status, stability and events, corrected within each treatment), shifts and the genes without depth. samples: sample_id, condition and the
    covariates, the control's and its treatments'. The model is `~ covariates + condition` over the whole family; genes at a boundary are taken from repeated fits with their zeros perturbed. A call is sure only where the fit
    is stable and the atlas, if it has a column `confidence`, doesn't hold the site for low."""
    rows = [r.asDict() for r in samples.select("sample_id", "condition", *covariates).orderBy("sample_id").collect()]  # a family's sheet
    layout = family.family_layout(rows, control, covariates)
    samples = samples.select("sample_id", "condition")
    whole = written(aggregates.complete(counts, atlas.select("pac_id", "gene_id"), samples, ["pac_id", "gene_id"]))
    filtering = written(testing.family_filter(whole, samples))
    tested = whole.join(filtering.filter("tested").select("pac_id"), "pac_id", "left_semi").join(samples, "sample_id")
    ready = written(tested.join(regression.precisions(tested, layout), "gene_id"))
    fits = written(regression.fit_family(ready, layout))
    fits = written(regression.stabilised(ready, fits, layout, settings.zero_repeats, settings.zero_most_spread))
    p = fits.withColumn("gene_p", models.chi_square_tail(F.col("gene_lr"), F.col("gene_df"))).withColumn("pac_p", models.chi_square_tail(F.col("pac_lr"), F.lit(1)))
    p = p.withColumn("omnibus_p", F.when(F.col("status") != "group_without_counts", models.chi_square_tail(F.col("omnibus_lr"), F.col("omnibus_df"))))
    # genes without depth in a comparison leave it before its corrections
    totals = whole.groupBy("gene_id", "sample_id").agg(F.sum("count").alias("gene_total"))
    libraries = whole.groupBy("sample_id").agg(F.sum("count").alias("library"))
    shallow = None
    for t in sorted({r.condition for r in samples.select("condition").distinct().collect()} - {control}):  # the conditions of a family's sheet
        one = testing.comparison_depth(totals, libraries, samples.select("sample_id", "condition"), control, t, settings.depth_least_samples, settings.depth_least_reads, settings.depth_least_cpm).withColumn("treatment", F.lit(t))
        shallow = one if shallow is None else shallow.unionByName(one)
    if shallow is not None:
        shallow = written(shallow)
        p = p.join(shallow.select("gene_id", "treatment"), ["gene_id", "treatment"], "left_anti")
    staged = models.stagewise(p.select("treatment", "gene_id", "pac_id", "gene_p", "pac_p"), settings.alpha, ["treatment"]).select("treatment", "gene_id", "pac_id", "gene_fdr", "pac_fdr")
    p = p.join(staged, ["treatment", "gene_id", "pac_id"])
    group = tested.groupBy("pac_id", "gene_id", "condition").agg(F.count_if(F.col("count") > 0).alias("support"), F.sum("count").alias("reads"))
    total = group.withColumn("total", F.sum("reads").over(joins.Window.partitionBy("gene_id", "condition"))).select("pac_id", "condition", "support", "total")
    side = lambda x: total.select("pac_id", F.col("condition").alias(f"{x}_condition"), F.col("support").alias(f"{x}_support"), F.col("total").alias(f"{x}_total"))
    d = p.join(side("control").filter(F.col("control_condition") == control), "pac_id").join(side("treatment").withColumnRenamed("treatment_condition", "treatment"), ["pac_id", "treatment"])
    # without reads of the gene in a condition there is no usage to report
    empty = (F.col("control_total") == 0) | (F.col("treatment_total") == 0)
    d = d.withColumns({f: F.when(~empty, F.col(f)) for f in ("control_fit", "treatment_fit")}).withColumn("delta", F.col("treatment_fit") - F.col("control_fit"))
    c = F.col
    believed = atlas.select("pac_id", "strand", "coordinate", (F.col("confidence") if "confidence" in atlas.columns else F.lit("moderate")).alias("confidence"))
    event = testing.event_type(c("control_support"), c("treatment_support"), c("delta"), c("control_fit"), c("treatment_fit"), c("gene_fdr"), c("pac_fdr"), c("unstable") == "", F.coalesce(c("confidence") != "low", F.lit(False)),
                               c("control_total"), c("treatment_total"), least_delta=settings.least_delta, alpha_g=settings.alpha, alpha_s=settings.alpha)
    sites = written(d.join(believed, "pac_id").withColumn("event_type", event))
    out = {"counts": whole, "usage": aggregates.usage(whole), "filtering": filtering, "sites": sites, "shifts": testing.gene_shifts(sites, ["treatment"])}
    return out | ({"without_depth": shallow} if shallow is not None else {})


def discover_proximal(evidence: DataFrame, kernel: DataFrame, settings: Settings, bin_size: int = 10, span: int = 500, ratio: float = 2.0) -> DataFrame:
    """Sites of proximal-tag evidence: kernel-matched peaks, then reads of each peak by the likelihood-ratio rule with ties by the oriented coordinate, then support.
    kernel: (offset, weight) of reads upstream of a site, offset >= 0. A site at a negative coordinate is dropped. -> as discover(), members being the reads' coordinates."""
    from ..operators.family import resolution

    rows = kernel.orderBy("offset").collect()  # one row an offset of the kernel
    binned: dict[int, float] = {}
    for r in rows:
        if r.weight > 0:
            at = (abs(int(r.offset)) + bin_size // 2) // bin_size * (1 if r.offset >= 0 else -1)
            binned[at] = binned.get(at, 0.0) + r.weight
    low, high = min(binned), max(binned)
    total = sum(binned.values())
    weights = [binned.get(k, 0.0) / total for k in range(low, high + 1)]
    import numpy as np

    apart = resolution(np.array(weights)) * bin_size
    peaks = clustering.kernel_peaks(evidence, weights, low, bin_size, apart)
    sign = F.when(F.col("strand") == "+", 1).otherwise(-1)
    sites = written(peaks.withColumn("site", (F.col("bin") * bin_size * sign).cast("long")).filter("site >= 0").select("contig", "strand", "site", F.concat_ws(".", F.lit("PACv1"), F.lit(settings.assembly), "contig", "strand", F.col("site").cast("string")).alias("pac_id")))
    got = joins.band_assign(evidence, sites, kernel.filter("weight > 0"), ["contig", "strand"], ["sample_id", "contig", "strand", "coordinate"], "coordinate", "site", span, ratio, "oriented")
    per = got.filter("status = 'assigned'").groupBy("pac_id", "contig", "strand", "site").agg(F.array_sort(F.collect_set("coordinate")).alias("members"), F.sum("count").alias("total"), F.count_distinct("sample_id").alias("samples"))
    kept = per.filter((F.col("total") >= settings.pac_least_count) & (F.col("samples") >= settings.pac_least_samples))
    return kept.select("pac_id", "contig", "strand", F.col("site").alias("coordinate"), "members", "total", "samples")
