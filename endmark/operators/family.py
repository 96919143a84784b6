"""Comparison families, calibration choices and the bookkeeping around bootstrap results."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clustering import local_peaks


@dataclass(frozen=True)
class Layout:
    """Samples, design and contrasts of one control and its treatments; exploratory if a group has one sample only."""

    samples: list[str]
    groups: list[str]
    columns: list[str]
    design: np.ndarray
    exploratory: bool
    conditions: dict[str, str] | None = None


def family_layout(samples: list[dict[str, str]], control: str, covariates: tuple[str, ...] = ()) -> Layout:
    """Design `~ covariates + condition` with the control as the reference level, treatments in byte order; covariates vary or are left out, and a rank below its columns is an error."""
    treatments = sorted({s["condition"] for s in samples} - {control}, key=str.encode)
    columns, parts = ["intercept"], [np.ones(len(samples))]
    for name in covariates:
        for level in sorted({s[name] for s in samples})[1:]:
            columns.append(f"{name}={level}")
            parts.append(np.array([s[name] == level for s in samples], dtype=float))
    for t in treatments:
        columns.append(t)
        parts.append(np.array([s["condition"] == t for s in samples], dtype=float))
    design = np.stack(parts, axis=1)
    if np.linalg.matrix_rank(design) < design.shape[1]:
        raise ValueError("the design has not full rank: a covariate and the conditions can't be told apart")
    sizes = [sum(s["condition"] == c for s in samples) for c in (control, *treatments)]
    return Layout([s["sample_id"] for s in samples], [control, *treatments], columns, design, min(sizes) < 2, {s["sample_id"]: s["condition"] for s in samples})


def bootstrap_genes(sites: DataFrame, cut: float = 0.05, candidates: bool = True) -> DataFrame:
    """gene_id of eligible genes that pass the cut or hold a detection candidate. sites: gene_id, gene_fdr, candidate, eligible."""
    wanted = F.coalesce(F.col("gene_fdr") <= cut, F.lit(False)) | (F.lit(candidates) & F.coalesce("candidate", F.lit(False)))
    return sites.groupBy("gene_id").agg(F.bool_or(wanted).alias("w"), F.bool_and("eligible").alias("e")).filter("w and e").select("gene_id")


def with_intervals(sites: DataFrame, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """sites with low, high and bootstrap_status done where status was pending; a pending row without an interval, or an interval for no pending row, is an error."""
    pending = sites.filter("bootstrap_status = 'pending'").select(*keys)
    if pending.join(intervals, keys, "left_anti").limit(1).count():
        raise ValueError("a pending site has no interval")
    if intervals.join(pending, keys, "left_anti").limit(1).count():
        raise ValueError("an interval names no pending site")
    out = sites.join(intervals.select(*keys, "low", "high"), keys, "left")
    return out.withColumn("bootstrap_status", F.when(F.col("bootstrap_status") == "pending", "done").otherwise(F.col("bootstrap_status")))


def calls(sites: DataFrame) -> DataFrame:
    return sites.filter("event_type <> 'none'")


def choose_source(reproducibility: dict[str, list[float]], explicit: str | None = None, preferred: str | None = None, least: float = 0.8, margin: float = 0.05) -> str:
    """The evidence source: the explicit one, else the profile's, else that with the best median reproducibility if it reaches least and leads by margin; ties by name, descending."""
    if explicit and explicit != "auto":
        return explicit
    if preferred and preferred in reproducibility:
        return preferred
    ranked = sorted(((float(np.median(v)), k) for k, v in reproducibility.items() if v), reverse=True)
    if not ranked or ranked[0][0] < least:
        raise ValueError("no evidence source is reproducible enough")
    if len(ranked) > 1 and ranked[0][0] - ranked[1][0] < margin:
        raise ValueError(f"{ranked[0][1]} and {ranked[1][1]} are too close to choose")
    return ranked[0][1]


def eligible_genes(offsets: DataFrame, least: int) -> DataFrame:
    """offsets (gene_id, offset, count, poly_a_clip_count) of genes with at least `least` matched reads; clips count up to the reads of their row."""
    total = offsets.groupBy("gene_id").agg(F.sum("count").alias("n")).filter(F.col("n") >= least).select("gene_id")
    return offsets.join(total, "gene_id", "left_semi").withColumn("poly_a_clip_count", F.least("poly_a_clip_count", "count"))


def kernel_modes(weights: np.ndarray, low: int, share: float = 0.1) -> list[int]:
    """Offsets of local maxima with at least a share of the highest weight; weights start at offset low."""
    return [int(k) + low for k in local_peaks(weights) if weights[k] >= share * weights.max()]


def resolution(weights: np.ndarray, most_overlap: float = 0.5) -> int:
    """The first shift at which the kernel and its copy share at most most_overlap, else its length."""
    for s in range(1, len(weights)):
        if np.minimum(weights[s:], weights[:-s]).sum() <= most_overlap:
            return s
    return len(weights)


def pile_shift(weights: np.ndarray, low: int, bin_size: int) -> int:
    """Bins from a site to where its reads pile up most."""
    v = int(np.argmax(weights)) + low
    return int(np.sign(v)) * ((abs(v) + bin_size // 2) // bin_size)


def internal_ends(sites: DataFrame, donors: DataFrame, bin_size: int, shift: int) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) sites: rejected if a donor lies within a bin of where the site's reads pile up. Both have contig, strand, coordinate."""
    sign = F.when(F.col("strand") == "+", 1).otherwise(-1)
    own = sites.withColumn("_bin", F.floor((F.col("coordinate") - sign * shift * bin_size) / F.lit(bin_size)))
    near = donors.select("contig", "strand", F.explode(F.sequence(F.floor(F.col("coordinate") / F.lit(bin_size)) - 1, F.floor(F.col("coordinate") / F.lit(bin_size)) + 1)).alias("_bin")).distinct()
    keys = ["contig", "strand", "_bin"]
    return own.join(near, keys, "left_anti").drop("_bin"), own.join(near, keys, "left_semi").drop("_bin")


def keyed_sample(rows: DataFrame, key: str, k: int, seed: int = 1) -> DataFrame:
    """k rows with the least keyed hashes: the same whatever the partitions."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(k)


def completed_checksums(sheet: DataFrame, metadata: DataFrame) -> DataFrame:
    """sheet (ordinal, sample_id, path) with sha256; a sample without exactly one metadata row of the same path is an error when it is read."""
    m = metadata.groupBy("sample_id").agg(F.count("*").alias("_n"), F.first("path").alias("_path"), F.first("sha256").alias("sha256"))
    d = sheet.join(m, "sample_id", "left")
    sound = F.coalesce((F.col("_n") == 1) & (F.col("_path") == F.col("path")), F.lit(False))
    return d.withColumn("sha256", F.when(sound, F.col("sha256")).otherwise(F.raise_error(F.concat(F.lit("no single checksum for "), "sample_id")))).drop("_n", "_path")


def support_text(threshold: float) -> str:
    return f"supporting_sample_fraction<{threshold:g}" if threshold < 1 else f"supporting_samples<{int(threshold)}"
