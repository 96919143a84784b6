"""Candidate sites with their support, metrics and status, and the rejection of sites that are read-through.

Support is a matter of samples in conditions: a sample supports a site with `least_count` reads or more, a condition with enough such samples
(`least_samples`: a number, or a share of the condition's samples if below 1). A sample that the sheet doesn't name is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import reasons
from . import aggregates, joins
from .family import support_text

SITE = ["contig", "strand", "seed"]


@dataclass(frozen=True)
class Support:
    least_total: int = 20
    least_count: int = 2
    least_samples: float = 2
    rescue_total: int = 5
    known_radius: int = 12
    near: int = 2
    cap: int = 3


def named(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """rows with the condition of their sample; one that samples (sample_id, condition) lacks is an error."""
    sheet = samples.select("sample_id", "condition")
    unknown = rows.join(sheet, "sample_id", "left_anti").select("sample_id").first()
    if unknown is not None:
        raise ValueError(f"the sample sheet has no sample {unknown.sample_id}")
    return rows.join(sheet, "sample_id")


def supported(counts: DataFrame, samples: DataFrame, keys: list[str], s: Support) -> DataFrame:
    """(keys, total_supporting_samples, supporting_samples, best_supporting_condition, supported, supporting_conditions) of sites with a qualifying sample. counts: keys, sample_id, count, a row for each site and sample."""
    enough = counts.filter(F.col("count") >= s.least_count)
    total = enough.groupBy(*keys).agg(F.count("*").alias("total_supporting_samples"))
    per = aggregates.condition_support(counts, samples, keys, s.least_count, s.least_samples)
    per = per.select(*keys, F.col("best_support").alias("supporting_samples"), F.col("best_condition").alias("best_supporting_condition"), "supported", F.col("passing").alias("supporting_conditions"))
    return total.join(per, keys)


def exact_candidates(clusters: DataFrame, observed: DataFrame, samples: DataFrame, cluster_radius: int, s: Support, known: DataFrame | None = None) -> DataFrame:
    """Clusters (contig, strand, seed, members) with support, metrics, status and reasons. observed: sample_id, contig, strand, coordinate, count, poly_a_clip_count.

    status: `primary` with least_total reads and a supporting condition; else `known_rescue_only` if a known site (contig, strand, coordinate) lies within known_radius, with rescue_total reads and a supporting condition; else
    `rejected`, whose reasons are joined by `;`."""
    sheet = samples.select("sample_id", "condition")
    reads = named(observed, sheet).drop("condition")
    own = clusters.select(*SITE, F.explode("members").alias("coordinate")).join(reads, ["contig", "strand", "coordinate"])
    per = own.groupBy(*SITE, "sample_id").agg(F.sum("count").alias("count"))
    places = own.groupBy(*SITE, "coordinate").agg(F.sum("count").alias("count"), F.sum("poly_a_clip_count").alias("clips"))
    away = F.abs(F.col("coordinate") - F.col("seed"))
    metrics = places.groupBy(*SITE).agg(
        F.sum("count").alias("total_count"), F.sum("clips").alias("_clips"), F.sum(F.when(away <= s.near, F.col("count")).otherwise(0)).alias("_near"), F.min("coordinate").alias("region_start"),
        (F.max("coordinate") + 1).alias("region_end"))
    capped = per.groupBy(*SITE).agg(F.sum(F.least("count", F.lit(s.cap))).alias("capped_support"))
    ends = aggregates.weighted_rank_coordinate(places, SITE, "coordinate", "count", {"_low": 0.05, "_high": 0.95}).select(*SITE, (F.col("_high") - F.col("_low")).alias("width_90"))
    around = joins.within(clusters.select(*SITE), reads.select("contig", "strand", F.col("coordinate").alias("at"), "count"), ["contig", "strand"], "seed", "at", 2 * cluster_radius)
    flank = around.filter(F.abs(F.col("seed") - F.col("at")) > cluster_radius).groupBy(*SITE).agg(F.sum("count").alias("_flank"))
    d = clusters.select(*SITE, "members").join(metrics, SITE).join(capped, SITE).join(ends, SITE).join(flank, SITE, "left").join(supported(per, sheet, SITE, s), SITE, "left")
    if known is None:
        d = d.withColumn("_known", F.lit(False))
    else:
        hits = joins.within(clusters.select(*SITE), known.select("contig", "strand", F.col("coordinate").alias("at")), ["contig", "strand"], "seed", "at", s.known_radius).select(*SITE).distinct()
        d = d.join(hits.withColumn("_known", F.lit(True)), SITE, "left")
    supports = F.coalesce("supported", F.lit(False))
    primary = (F.col("total_count") >= s.least_total) & supports
    rescue = F.coalesce("_known", F.lit(False)) & (F.col("total_count") >= s.rescue_total) & supports
    why = reasons((F.col("total_count") < s.least_total, f"total_count<{s.least_total}"), (~supports, support_text(s.least_samples)))
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    text = lambda name: F.coalesce(name, F.lit("")).alias(name)
    return d.select(
        "contig", "strand", F.col("seed").alias("coordinate"), "total_count", zero("supporting_samples"), "capped_support", "members", F.when(primary, "primary").when(rescue, "known_rescue_only").otherwise("rejected").alias("status"),
        F.when(primary | rescue, "").otherwise(why).alias("rejection_reason"), (F.col("_near") / F.col("total_count")).alias("fraction_within_2nt"), F.col("width_90").cast("long").alias("width_90"),
        (F.col("_clips") / F.col("total_count")).alias("poly_a_clip_fraction"), (F.col("total_count") / F.greatest(F.coalesce("_flank", F.lit(0)), F.lit(1))).alias("local_enrichment"), "region_start", "region_end",
        F.lit(1).cast("long").alias("resolution_nt"), zero("total_supporting_samples"), text("best_supporting_condition"), text("supporting_conditions"))


def pile(coordinate: Column, strand: Column, shift: int) -> Column:
    """Where a site's reads pile up: `shift` upstream of it."""
    return F.when(strand == "+", coordinate - shift).otherwise(coordinate + shift)


def readthrough(candidates: DataFrame, continuations: DataFrame, samples: DataFrame, least: int, shift_bins: int, bin_size: int) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) candidates: rejected as `constitutive_readthrough` where, in every supporting condition, the reads spliced onward out of an exon block that holds the site's pile
    (within one bin of either end), pooled over the condition's samples, reach `least`. A supporting condition without them keeps the site; other conditions don't count, and a site without a
    supporting condition stays.

    candidates: contig, strand, coordinate, status, rejection_reason, supporting_conditions (joined by `;`); continuations: sample_id, contig, strand, upstream_start, upstream_end, downstream_start, downstream_end,
    count. An invalid block or an unknown sample is an error. Blocks are pooled by condition before the join, which is one on (contig, strand, bin) with the exact range behind it."""
    bad = (F.col("count") < 1) | (F.col("upstream_start") >= F.col("upstream_end")) | (F.col("downstream_start") >= F.col("downstream_end"))
    sound = F.when(~F.coalesce(bad, F.lit(True)), F.col("count")).otherwise(F.raise_error(F.lit("splice continuations hold an invalid exon block")).cast("long"))
    blocks = named(continuations.withColumn("count", sound), samples).groupBy("contig", "strand", "upstream_start", "upstream_end", "condition").agg(F.sum("count").alias("reads"))
    slack = blocks.withColumn("_start", F.col("upstream_start") - bin_size).withColumn("_end", F.col("upstream_end") + bin_size)
    site = ["contig", "strand", "coordinate"]
    wanted = candidates.select(*site, F.explode(F.filter(F.split("supporting_conditions", ";"), lambda c: c != "")).alias("condition")).distinct()
    piles = candidates.select(*site, pile(F.col("coordinate"), F.col("strand"), shift_bins * bin_size).alias("_pile")).distinct()
    held = joins.contained(piles, slack, ["contig", "strand"], "_pile", "_start", "_end").groupBy(*site, "condition").agg(F.sum("reads").alias("reads"))
    reached = wanted.join(held, [*site, "condition"], "left").withColumn("_reached", F.coalesce(F.col("reads") >= least, F.lit(False)))
    constant = reached.groupBy(*site).agg(F.bool_and("_reached").alias("_all")).filter("_all").select(*site)
    rejected = candidates.join(constant, site, "left_semi").withColumn("status", F.lit("rejected")).withColumn("rejection_reason", F.lit("constitutive_readthrough"))
    return candidates.join(constant, site, "left_anti"), rejected
