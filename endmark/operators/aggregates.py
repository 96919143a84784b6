"""Grouped computations over evidence, counts and kernels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import oriented


def read_end_counts(ends: DataFrame) -> DataFrame:
    """(sample_id, contig, strand, coordinate, evidence_source) -> count, poly_a_clip_count; all sources in one pass."""
    return ends.groupBy("sample_id", "contig", "strand", "coordinate", "evidence_source").agg(F.count("*").alias("count"), F.count_if("poly_a_clip").alias("poly_a_clip_count"))


def gene_totals(counts: DataFrame) -> DataFrame:
    """Reads per gene and sample of PACs with one gene."""
    named = counts.filter("gene_id is not null and gene_id <> '' and not contains(gene_id, ',')")
    return named.groupBy("gene_id", "sample_id").agg(F.sum("count").alias("gene_total"))


def complete(counts: DataFrame, pacs: DataFrame, samples: DataFrame, keys: list[str]) -> DataFrame:
    """Counts with a row for every PAC and sample, 0 where none is recorded. Samples are few: their list is a literal on each PAC's row."""
    names = [r.sample_id for r in samples.select("sample_id").distinct().collect()]
    grid = pacs.withColumn("sample_id", F.explode(F.array(*map(F.lit, names))))
    return grid.join(counts.select(*keys, "sample_id", "count"), [*keys, "sample_id"], "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))


def usage(counts: DataFrame) -> DataFrame:
    """counts (gene_id, sample_id, count) with gene_total and pau: the share within gene and sample, null where the total is 0."""
    total = F.sum("count").over(Window.partitionBy("gene_id", "sample_id"))
    return counts.withColumn("gene_total", total).withColumn("pau", F.col("count") / F.nullif("gene_total", F.lit(0)))


def covered_genes(totals: DataFrame, least: int, n_samples: int) -> DataFrame:
    """Genes whose total reaches `least` in every one of n_samples samples."""
    return totals.groupBy("gene_id").agg(F.min("gene_total").alias("least_total"), F.count("*").alias("n")).filter((F.col("least_total") >= least) & (F.col("n") == n_samples)).select("gene_id", "least_total")


def ranked_sites(sites: DataFrame) -> DataFrame:
    """site_rank from proximal (1) to distal within gene and strand, n_sites and a label; a lone site is proximal."""
    w = Window.partitionBy("gene_id", "strand")
    out = sites.withColumn("site_rank", F.row_number().over(w.orderBy(oriented(F.col("coordinate"), F.col("strand")), "pac_id"))).withColumn("n_sites", F.count("*").over(w))
    label = F.when(F.col("site_rank") == 1, "proximal").when(F.col("site_rank") == F.col("n_sites"), "distal").otherwise("middle")
    return out.withColumn("site_label", label)


def weighted_rank_coordinate(points: DataFrame, keys: list[str], at: str, weight: str, qs: dict[str, float]) -> DataFrame:
    """For each q the first coordinate whose running weight exceeds rint(q (n - 1)), n being the total weight."""
    w = Window.partitionBy(*keys)
    run = points.groupBy(*keys, at).agg(F.sum(weight).alias("_w")).withColumn("_cum", F.sum("_w").over(w.orderBy(at).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("_w").over(w))
    return run.groupBy(*keys).agg(F.max("_n").alias("n"), *[F.min(F.when(F.col("_cum") > F.rint(q * (F.col("_n") - 1)), F.col(at))).alias(name) for name, q in qs.items()])


def offset_metrics(offsets: DataFrame, keys: list[str], low: float, high: float, near: int = 1, clips: str | None = None) -> DataFrame:
    """Calibration metrics of (offset, count): modal offset (smallest of ties), median, interval and the share within `near` of 0; with a column of
    clipped reads, also their share."""
    mode = offsets.groupBy(*keys, "offset").agg(F.sum("count").alias("count"), F.sum(clips or F.lit(0)).alias("_clips"))
    n = F.col("count")
    return mode.groupBy(*keys).agg(
        F.sum(n).alias("n"), F.min_by("offset", F.struct(-n, F.col("offset"))).alias("modal_offset"), F.percentile("offset", 0.5, n).alias("median_offset"),
        F.percentile("offset", low, n).alias("low_offset"), F.percentile("offset", high, n).alias("high_offset"),
        (F.sum(F.when(F.abs("offset") <= near, n).otherwise(0)) / F.sum(n)).alias("boundary_fraction"), *([(F.sum("_clips") / F.sum(n)).alias("poly_a_clip_fraction")] if clips else []))


def classify_endpoints(genes: Column, reproducibility: Column, median: Column, width: Column, boundary: Column, low: Column, high: Column,
                       least_genes: int = 20, least_reproducibility: float = 0.8, most: int = 500) -> Column:
    return (F.when(F.coalesce(genes, F.lit(0)) < least_genes, "ambiguous").when(reproducibility.isNull() | (reproducibility < least_reproducibility), "ambiguous")
            .when((F.abs(median) <= 2) & (width <= 12) & (boundary >= 0.5), "exact").when((median >= 3) & (low >= -most) & (high <= most), "proximal").otherwise("ambiguous"))


def empirical_kernel(offsets: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Histogram over -most..most, smoothed by [1, 2, 3, 2, 1] with zeros beyond the ends, normalised: (keys, offset, weight)."""
    grid = offsets.select(*keys).distinct().withColumn("offset", F.explode(F.sequence(F.lit(-most), F.lit(most)).cast("array<long>")))
    counts = offsets.groupBy(*keys, "offset").agg(F.sum("count").alias("count"))
    dense = grid.join(counts, [*keys, "offset"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    w = Window.partitionBy(*keys)
    tap = lambda by: F.coalesce(F.lag("count", by).over(w.orderBy("offset")), F.lit(0))
    smooth = dense.withColumn("_s", tap(2) + 2 * tap(1) + 3 * F.col("count") + 2 * tap(-1) + tap(-2))
    return smooth.withColumn("weight", F.col("_s") / F.nullif(F.sum("_s").over(w), F.lit(0))).select(*keys, "offset", "weight")


def pooled_kernel(kernels: DataFrame) -> DataFrame:
    mean = kernels.groupBy("offset").agg(F.avg("weight").alias("_w"))
    return mean.crossJoin(F.broadcast(mean.agg(F.sum("_w").alias("_t")))).select("offset", (F.col("_w") / F.col("_t")).alias("weight"))  # one row


def reproducibility(kernels: DataFrame, key: str) -> DataFrame:
    """Correlation of each kernel with the mean of the others; 1 if there is one only, 0 where one doesn't vary."""
    w = Window.partitionBy("offset")
    n = F.count("*").over(w)
    rest = kernels.withColumn("_n", n).withColumn("_rest", (F.sum("weight").over(w) - F.col("weight")) / F.nullif(n - 1, F.lit(0)))
    flat = (F.stddev_pop("weight") == 0) | (F.stddev_pop("_rest") == 0)
    return rest.groupBy(key).agg(F.when(F.max("_n") == 1, 1.0).when(flat, 0.0).otherwise(F.corr("weight", "_rest")).alias("reproducibility"))


def self_overlap(kernel: DataFrame) -> DataFrame:
    """(shift, overlap): sum over offsets of min(kernel, kernel shifted), for shifts within the kernel's span."""
    k = kernel.filter("weight > 0")
    pairs = k.alias("a").join(k.select(F.col("offset").alias("o"), F.col("weight").alias("w")), F.lit(True) & (F.col("o") >= F.col("offset")))
    return pairs.groupBy((F.col("o") - F.col("offset")).alias("shift")).agg(F.sum(F.least("weight", "w")).alias("overlap"))


def condition_support(counts: DataFrame, samples: DataFrame, keys: list[str], least: int, wanted: float) -> DataFrame:
    """Samples with count >= least per condition against what is wanted (a share of the condition below 1, else a number):
    best_condition by (passes, share or number as wanted is one or the other, support), ties alphabetical, and the sorted list of passing conditions."""
    sizes = samples.groupBy("condition").agg(F.count("*").alias("size"))
    need = F.ceil(wanted * F.col("size")) if wanted < 1 else F.lit(int(wanted))
    per = counts.filter(F.col("count") >= least).join(samples, "sample_id").groupBy(*keys, "condition").agg(F.count_distinct("sample_id").alias("support")).join(sizes, "condition")
    per = per.withColumn("passes", F.col("support") >= need).withColumn("score", F.col("support") / F.col("size") if wanted < 1 else F.col("support").cast("double"))
    order = F.struct((~F.col("passes")).alias("a"), (-F.col("score")).alias("b"), (-F.col("support")).alias("c"), F.col("condition").alias("d"))
    return per.groupBy(*keys).agg(F.min_by("condition", order).alias("best_condition"), F.min_by("support", order).alias("best_support"), F.bool_or("passes").alias("supported"),
                                  F.array_join(F.array_sort(F.collect_list(F.when(F.col("passes"), F.col("condition")))), ";").alias("passing"))


def seed_metrics(observed: DataFrame, radius: int, cap: int = 3) -> DataFrame:
    """At each (contig, strand, coordinate) with reads: sums over +-radius: raw, capped (a sample's sum counts cap at most), supporting samples with any,
    and flank: reads at radius < distance <= 2 radius."""
    per = observed.groupBy("contig", "strand", "coordinate", "sample_id").agg(F.sum("count").alias("count"))
    sites = per.groupBy("contig", "strand", "coordinate").agg(F.sum("count").alias("own"))
    from .joins import within

    near = within(sites, per.withColumnRenamed("coordinate", "at"), ["contig", "strand"], "coordinate", "at", 2 * radius)
    inner = F.abs(F.col("coordinate") - F.col("at")) <= radius
    sums = near.groupBy("contig", "strand", "coordinate", "sample_id").agg(F.sum(F.when(inner, F.col("count")).otherwise(0)).alias("s"), F.sum(F.when(~inner, F.col("count")).otherwise(0)).alias("f"))
    return sums.groupBy("contig", "strand", "coordinate").agg(F.count_if(F.col("s") > 0).alias("supporting"), F.sum(F.least("s", F.lit(cap))).alias("capped"), F.sum("s").alias("raw"), F.sum("f").alias("flank"))


#: Coordinates of a bin in which islands are numbered by themselves; a key's bins are what one task sees of it.
BIN = 1 << 17


def _bins(rows: DataFrame, keys: list[str], **values: Column) -> tuple[DataFrame, Window]:
    """Values of each (keys, _bin), and the window over a key's bins in order: a row a bin, however many rows it holds."""
    return rows.groupBy(*keys, "_bin").agg(*[v.alias(k) for k, v in values.items()]), Window.partitionBy(*keys).orderBy("_bin")


def merged_intervals(intervals: DataFrame, keys: list[str], start: str = "start", end: str = "end", width: int = BIN) -> DataFrame:
    """Unions of touching or overlapping intervals per key: (keys, island, start, end, members); islands are numbered from 1 in order. What reaches into a bin of coordinates from those before it, and how many islands
    begin there, is carried from bin to bin, so no task sees all of a key."""
    d = intervals.withColumn("_bin", F.floor(F.col(start) / F.lit(width)))
    before = Window.unboundedPreceding, -1
    ends, over = _bins(d, keys, _high=F.max(end))
    d = d.join(ends.select(*keys, "_bin", F.max("_high").over(over.rowsBetween(*before)).alias("_carried")), [*keys, "_bin"])
    w = Window.partitionBy(*keys, "_bin").orderBy(start, end)
    reach = F.greatest("_carried", F.max(end).over(w.rowsBetween(*before)))
    d = d.withColumn("_opens", (reach.isNull() | (F.col(start) > reach)).cast("long"))
    opened, over = _bins(d, keys, _n=F.sum("_opens"))
    d = d.join(opened.select(*keys, "_bin", F.coalesce(F.sum("_n").over(over.rowsBetween(*before)), F.lit(0)).alias("_earlier")), [*keys, "_bin"])
    numbered = d.withColumn("island", F.col("_earlier") + F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("members"))


def islands(points: DataFrame, keys: list[str], at: str, gap: int, name: str = "island", width: int = BIN) -> DataFrame:
    """Points numbered, from 1 in each key, by runs whose neighbours are at most gap apart. Runs are counted within bins of coordinates and carried over their borders, so no task sees all of a key."""
    d = points.withColumn("_bin", F.floor(F.col(at) / F.lit(width)))
    w = Window.partitionBy(*keys, "_bin").orderBy(at)
    # the first point of a bin is judged by the bins before it
    d = d.withColumn("_far", F.coalesce(F.col(at) - F.lag(at).over(w) > gap, F.lit(False)).cast("long")).withColumn("_own", F.sum("_far").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    bins, over = _bins(d, keys, _low=F.min(at), _high=F.max(at), _n=F.max("_own"))
    opens = F.coalesce(F.col("_low") - F.lag("_high").over(over) > gap, F.lit(True)).cast("long") + F.coalesce(F.lag("_n").over(over), F.lit(0))
    first = bins.withColumn("_opens", opens).select(*keys, "_bin", F.sum("_opens").over(over.rowsBetween(Window.unboundedPreceding, 0)).alias("_first"))
    return d.join(first, [*keys, "_bin"]).withColumn(name, F.col("_first") + F.col("_own")).drop("_bin", "_far", "_own", "_first")


def concordance(calls: DataFrame) -> DataFrame:
    """For each pair of comparisons: shared PACs, those called in both, and Pearson r of their deltas (null below 3 or without spread)."""
    a = calls.select("pac_id", F.col("comparison").alias("a"), F.col("delta").alias("da"), F.col("called").alias("ca"))
    b = calls.select("pac_id", F.col("comparison").alias("b"), F.col("delta").alias("db"), F.col("called").alias("cb"))
    pairs = a.join(b, "pac_id").filter("a < b")
    spread = (F.count("*") >= 3) & (F.stddev_pop("da") > 0) & (F.stddev_pop("db") > 0)
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.count_if(F.col("ca") & F.col("cb")).alias("called_in_both"), F.when(spread, F.corr("da", "db")).alias("r"))


def sample_correlation(pau: DataFrame, n_samples: int) -> DataFrame:
    """Correlation of usage between samples over PACs that have a usage in all."""
    whole = pau.filter("pau is not null").withColumn("_n", F.count("*").over(Window.partitionBy("pac_id"))).filter(F.col("_n") == n_samples)
    a = whole.select("pac_id", F.col("sample_id").alias("a"), F.col("pau").alias("pa"))
    b = whole.select("pac_id", F.col("sample_id").alias("b"), F.col("pau").alias("pb"))
    return a.join(b, "pac_id").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n"), F.corr("pa", "pb").alias("r"))


def single_ends(exons: DataFrame) -> DataFrame:
    """(gene_id, end_site) of genes whose transcripts all end at one 3' site. exons: gene_id, transcript_id, strand, start, end."""
    tx = exons.groupBy("gene_id", "transcript_id", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    site = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start"))
    return tx.groupBy("gene_id").agg(F.max(site).alias("end_site"), F.count_distinct(site).alias("n")).filter("n = 1").select("gene_id", "end_site")


def unit_histogram(values: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """(keys, bin, n) of values in [0, 1] in min(10, max(3, ceil(sqrt(count)))) bins, counted for each value of keys by itself."""
    keys = list(keys or [])
    some = values.filter(F.col(column).isNotNull())
    sizes = some.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_bins", F.least(F.lit(10), F.greatest(F.lit(3), F.ceil(F.sqrt("_n")))))  # a row for each value of keys
    d = some.join(sizes, keys) if keys else some.crossJoin(sizes)
    return d.groupBy(*keys, F.least(F.floor(F.col(column) * F.col("_bins")), F.col("_bins") - 1).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def with_zero_rows(rows: DataFrame, levels: DataFrame, name: str = "n") -> DataFrame:
    """Counts of rows for every combination of levels (a small table), 0 where there are none."""
    keys = levels.columns
    return levels.join(rows.groupBy(*keys).agg(F.count("*").alias(name)), keys, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def silent_groups(counts: DataFrame) -> DataFrame:
    """(gene_id, condition) without a read, from complete counts (gene_id, condition, count)."""
    return counts.groupBy("gene_id", "condition").agg(F.sum("count").alias("n")).filter("n = 0").select("gene_id", "condition")
