"""Family filter, depth status, calls and multiple testing of a comparison's PACs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import reasons


def benjamini_hochberg(tests: DataFrame, p: str, name: str = "fdr", keys: list[str] | None = None) -> DataFrame:
    """tests with the adjusted p-value; nulls are left out. Without keys all tests are ranked together, in one partition by nature:
    equal p-values are counted first, so its rows are distinct p-values."""
    keys = keys or []
    some = tests.filter(F.col(p).isNotNull())
    per = some.groupBy(*keys, p).agg(F.count("*").alias("_c"))
    up, down = Window.partitionBy(*keys).orderBy(p), Window.partitionBy(*keys).orderBy(F.desc(p))
    per = per.withColumn("_rank", F.sum("_c").over(up.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    per = per.withColumn(name, F.least(F.lit(1.0), F.min(F.col(p) * F.col("_n") / F.col("_rank")).over(down.rowsBetween(Window.unboundedPreceding, 0)))).drop("_c", "_rank", "_n")
    return tests.join(per, [*keys, p], "left")


def family_filter(counts: DataFrame, samples: DataFrame, least_count: int = 20, least_samples: int = 2, least_usage: float = 0.01, least_reads: int = 10, least_gene: int = 20,
                  usage_samples: int | None = None, dropouts: int = 1) -> DataFrame:
    """Per PAC (pac_id, gene_id): reason (empty if tested) and tested. counts: complete long counts with gene_id."""
    sizes = [r["count"] for r in samples.groupBy("condition").count().collect()]  # one a condition
    needed = min(usage_samples if usage_samples is not None else max(min(2, min(sizes)), min(sizes) - dropouts), sum(sizes))
    blank, many = F.coalesce(F.col("gene_id"), F.lit("")) == "", F.contains("gene_id", F.lit(","))
    named = counts.withColumn("_fixed", F.when(blank, "no_gene_assignment").when(many, "ambiguous_gene_assignment"))
    total = F.when(F.col("_fixed").isNull(), F.sum(F.when(F.col("_fixed").isNull(), F.col("count"))).over(Window.partitionBy("gene_id", "sample_id")))
    used = (F.col("_t") > 0) & (F.col("_t") >= least_reads) & (F.col("count") >= least_usage * F.col("_t") - 1e-12)
    per = named.withColumn("_t", total).groupBy("pac_id", "gene_id", "_fixed").agg(F.sum("count").alias("site_count"), F.count_if(F.col("count") > 0).alias("supporting"), F.count_if(used).alias("used"), F.sum("_t").alias("gene_total"))
    site = reasons((F.col("site_count") < least_count, f"site_count<{least_count}"), (F.col("supporting") < least_samples, f"supporting_samples<{least_samples}"), (F.col("used") < needed, f"sample_usage<{least_usage:g}"))
    per = per.withColumn("_site", F.coalesce("_fixed", site)).withColumn("_eligible", F.sum(F.when(F.col("_site") == "", 1).otherwise(0)).over(Window.partitionBy("gene_id")))
    gene = reasons((F.col("gene_total") < least_gene, f"gene_total<{least_gene}"), (F.col("_eligible") < 2, "fewer_than_2_testable_pacs"))
    out = per.withColumn("reason", F.when(F.col("_site") != "", F.col("_site")).otherwise(gene))
    return out.select("pac_id", "gene_id", "site_count", F.col("supporting").alias("supporting_samples"), "reason", (F.col("reason") == "").alias("tested"))


def event_type(c_support: Column, t_support: Column, delta: Column, c_fit: Column, t_fit: Column, gene_fdr: Column, pac_fdr: Column, stable: Column, confident: Column,
               c_total: Column, t_total: Column, s: int = 2, least_delta: float = 0.1, lo: float = 0.02, hi: float = 0.1, alpha_g: float = 0.05, alpha_s: float = 0.05, least_total: int = 20) -> Column:
    """Event of a PAC; a comparison with a null is false."""
    ok = lambda c: F.coalesce(c, F.lit(False))
    both = c_support.isNotNull() & t_support.isNotNull()
    cd, td, pos, neg = ok(c_support >= s), ok(t_support >= s), ok(delta >= least_delta), ok(delta <= -least_delta)
    sig = ok(gene_fdr <= alpha_g) & ok(pac_fdr <= alpha_s)
    gained = both & ~cd & td & ok(c_fit <= lo) & ok(t_fit >= hi) & pos
    lost = both & cd & ~td & ok(t_fit <= lo) & ok(c_fit >= hi) & neg
    sure = sig & ok(stable) & ok(confident)
    return (F.when(gained, F.when(sure & ok(c_total >= least_total), "gained").otherwise("gained_candidate")).when(lost, F.when(sure & ok(t_total >= least_total), "lost").otherwise("lost_candidate"))
            .when(cd & td & sig & pos, "increased_usage").when(cd & td & sig & neg, "decreased_usage").otherwise("none"))


def comparison_depth(totals: DataFrame, libraries: DataFrame, samples: DataFrame, control: str, treatment: str, least_samples: int = 2, least_reads: int = 10, floor: float = 0.0) -> DataFrame:
    """Genes without enough depth in a comparison: (gene_id, status, control_cpm, treatment_cpm). totals: (gene_id, sample_id, gene_total), complete; libraries: (sample_id, library)."""
    d = totals.join(samples, "sample_id").join(libraries, "sample_id").filter(F.col("condition").isin(control, treatment))
    d = d.withColumn("cpm", F.when(F.col("library") > 0, F.col("gene_total") * 1e6 / F.col("library")).otherwise(0.0))
    side = F.when(F.col("condition") == control, "c").otherwise("t")
    mean = d.groupBy("gene_id").agg(F.avg(F.when(side == "c", F.col("cpm"))).alias("control_cpm"), F.avg(F.when(side == "t", F.col("cpm"))).alias("treatment_cpm"))
    d = d.join(mean, "gene_id").withColumn("_other", F.when(side == "c", F.col("treatment_cpm")).otherwise(F.col("control_cpm")))
    per = lambda x, test: F.count_if((side == x) & test)
    deep, some = (F.col("gene_total") >= least_reads) & (F.col("cpm") >= floor), F.col("gene_total") > 0
    shown = F.col("_other") * F.col("library") / 1e6 >= least_reads
    agg = {f"{x}_{n}": per(x, test) for x in "ct" for n, test in (("size", F.lit(True)), ("deep", deep), ("some", some), ("shown", shown))}
    g = d.groupBy("gene_id", "control_cpm", "treatment_cpm").agg(*[v.alias(k) for k, v in agg.items()])
    need = {x: F.least(F.lit(least_samples), F.col(f"{x}_size")) for x in "ct"}
    is_deep = {x: F.col(f"{x}_deep") >= need[x] for x in "ct"}
    silent = {x: F.col(f"{x}_some") < need[x] for x in "ct"}
    show = {"t": (F.col("t_shown") >= need["t"]) & (F.col("control_cpm") >= floor), "c": (F.col("c_shown") >= need["c"]) & (F.col("treatment_cpm") >= floor)}
    status = (F.when(is_deep["t"] & silent["c"] & show["c"], "turned_on").when(is_deep["c"] & silent["t"] & show["t"], "turned_off").when(~is_deep["c"] & ~is_deep["t"], "too_low_in_both")
              .when(is_deep["t"] & ~is_deep["c"], "too_low_in_control").when(is_deep["c"] & ~is_deep["t"], "too_low_in_treatment"))
    return g.withColumn("status", status).filter("status is not null").select("gene_id", "status", "control_cpm", "treatment_cpm")


def gene_shifts(calls: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """For genes with a confirmed call, each value of keys by itself: from_pac, to_pac and direction. calls: keys, gene_id, pac_id, strand, coordinate, delta, pac_fdr, event_type."""
    up, down = F.col("event_type").isin("gained", "increased_usage"), F.col("event_type").isin("lost", "decreased_usage")
    d = calls.withColumn("_o", F.when(F.col("strand") == "+", F.col("coordinate")).otherwise(-F.col("coordinate")))
    d = d.withColumn("_up", up).withColumn("_down", down)
    nulls_last = F.coalesce("pac_fdr", F.lit(float("inf")))
    high, low = F.struct(-F.col("delta"), nulls_last, F.col("pac_id")), F.struct(F.col("delta"), nulls_last, F.col("pac_id"))
    row = F.struct("pac_id", "_o")
    gene = [*(keys or []), "gene_id"]
    first = d.groupBy(*gene).agg(F.min_by(F.when(F.col("_up"), row), F.when(F.col("_up"), high)).alias("_to"), F.min_by(F.when(F.col("_down"), row), F.when(F.col("_down"), low)).alias("_from"), F.bool_or(F.col("_up") | F.col("_down")).alias("_any")).filter("_any")
    d = d.join(first, gene)
    not_to, not_from = F.coalesce(F.col("pac_id") != F.col("_to.pac_id"), F.lit(True)), F.coalesce(F.col("pac_id") != F.col("_from.pac_id"), F.lit(True))
    rest = d.groupBy(*gene, "_to", "_from").agg(F.min_by(F.when(not_to, row), F.when(not_to, low)).alias("_f"), F.min_by(F.when(not_from, row), F.when(not_from, high)).alias("_t"))
    out = rest.select(*gene, F.coalesce("_from", "_f").alias("f"), F.coalesce("_to", "_t").alias("t"))
    return out.select(*gene, F.col("f.pac_id").alias("from_pac"), F.col("t.pac_id").alias("to_pac"), F.when(F.col("t._o") > F.col("f._o"), "distal").otherwise("proximal").alias("direction"))


def mantel_haenszel(strata: DataFrame, keys: list[str]) -> DataFrame:
    """Cochran-Mantel-Haenszel over 2 x 2 strata (a, b, c, d); strata with a zero margin are skipped: common odds ratio (infinite without discordant
    pairs on one side), its 95 % interval by the variance of Robins, Breslow and Greenland (null where the ratio is 0 or infinite) and the score chi-square without correction."""
    full = strata.filter("a + b > 0 and c + d > 0 and a + c > 0 and b + d > 0")
    # products of four margins pass 64 bits from some 55,000 rows a margin
    d = full.withColumns({x: F.col(x).cast("double") for x in "abcd"}).withColumn("n", F.col("a") + F.col("b") + F.col("c") + F.col("d"))
    e = (F.col("a") + F.col("b")) * (F.col("a") + F.col("c")) / F.col("n")
    v = (F.col("a") + F.col("b")) * (F.col("c") + F.col("d")) * (F.col("a") + F.col("c")) * (F.col("b") + F.col("d")) / (F.col("n") * F.col("n") * (F.col("n") - 1))
    r, s = F.col("a") * F.col("d") / F.col("n"), F.col("b") * F.col("c") / F.col("n")
    p, q = (F.col("a") + F.col("d")) / F.col("n"), (F.col("b") + F.col("c")) / F.col("n")
    sums = {"_r": r, "_s": s, "_pr": p * r, "_mixed": p * s + q * r, "_qs": q * s, "_x": F.col("a") - e, "_v": v}
    g = d.groupBy(*keys).agg(F.count("*").alias("strata"), *[F.sum(x).alias(k) for k, x in sums.items()])
    ratio = F.when(F.col("_s") > 0, F.try_divide("_r", "_s")).otherwise(float("inf"))
    spread = 1.959963984540054 * F.sqrt(F.col("_pr") / (2 * F.col("_r") * F.col("_r")) + F.col("_mixed") / (2 * F.col("_r") * F.col("_s")) + F.col("_qs") / (2 * F.col("_s") * F.col("_s")))
    whole = (F.col("_r") > 0) & (F.col("_s") > 0)
    g = g.withColumn("odds_ratio", ratio).withColumn("ci_low", F.when(whole, F.exp(F.log("odds_ratio") - spread))).withColumn("ci_high", F.when(whole, F.exp(F.log("odds_ratio") + spread)))
    return g.withColumn("chi_square", F.when(F.col("_v") > 0, F.col("_x") * F.col("_x") / F.col("_v"))).drop(*sums)


def percentile_interval(draws: DataFrame, keys: list[str], value: str, low: float = 0.025, high: float = 0.975, replicates: int = 200, share: float = 0.8) -> DataFrame:
    """Type-7 interval of the draws that succeeded; null below max(1, ceil(replicates * share - 1e-9)) successes."""
    import math

    enough = F.count(value) >= max(1, math.ceil(replicates * share - 1e-9))
    return draws.groupBy(*keys).agg(F.count(value).alias("successes"), F.when(enough, F.percentile(value, low)).alias("low"), F.when(enough, F.percentile(value, high)).alias("high"))
