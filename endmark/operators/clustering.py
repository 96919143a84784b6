"""Sequential clustering of read ends, island by island: an island is a run of coordinates no rule can reach across, so islands are
independent, and one that fits in a task's memory is handed to a grouped pandas function."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import nearest_bin
from ..plans.storage import spread
from .aggregates import islands, seed_metrics

#: Islands handed over together: most are tiny, and a call costs more than an island.
TOGETHER = 64


def greedy_clusters(observed: DataFrame, seed_radius: int = 12, cluster_radius: int = 24) -> DataFrame:
    """Greedy exact-boundary clustering: seeds in order of (-supporting, -capped, -raw, coordinate); an unassigned seed takes the unassigned
    coordinates within cluster_radius. Metrics are relational; only the greedy choice runs per island.
    -> (contig, strand, seed, members array<long>, total)."""
    sites = observed.groupBy("contig", "strand", "coordinate").agg(F.sum("count").alias("own"))
    ranked = sites.join(seed_metrics(observed, seed_radius), ["contig", "strand", "coordinate"])
    ranked = islands(ranked, ["contig", "strand"], "coordinate", max(seed_radius, cluster_radius))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("coordinate", ignore_index=True)
        at = part.coordinate.to_numpy()
        free = np.ones(len(at), dtype=bool)
        out = []
        for k in np.lexsort((at, -part.raw.to_numpy(), -part.capped.to_numpy(), -part.supporting.to_numpy())):
            if free[k]:
                low, high = np.searchsorted(at, [at[k] - cluster_radius, at[k] + cluster_radius + 1])
                own = np.arange(low, high)[free[low:high]]
                free[own] = False
                out.append((part.contig[0], part.strand[0], at[k], at[own].tolist(), int(part.own.to_numpy()[own].sum())))
        return pd.DataFrame(out, columns=["contig", "strand", "seed", "members", "total"])

    # islands are too far apart to touch each other's coordinates, so some may share a call
    ranked = spread(ranked.withColumn("together", F.floor(F.col("island") / TOGETHER)), "contig", "strand", "together")
    return ranked.groupBy("contig", "strand", "together").applyInPandas(run, "contig string, strand string, seed long, members array<long>, total long")


def local_peaks(score: np.ndarray) -> np.ndarray:
    """Inner strict maxima, a plateau at its floor-midpoint; and an end that is positive and not below its neighbour."""
    out, n, i = set(), len(score), 1
    while i < n - 1:
        j = i
        while j + 1 < n and score[j + 1] == score[i]:
            j += 1
        if score[i] > 0 and score[i - 1] < score[i] and j < n - 1 and score[j + 1] < score[i]:
            out.add((i + j) // 2)
        i = j + 1
    for end, next_ in ((0, 1), (n - 1, n - 2)) if n > 1 else ((0, 0),) if n else ():
        if score[end] > 0 and score[end] >= score[next_]:
            out.add(end)
    return np.array(sorted(out), dtype=np.int64)


def kernel_peaks(observed: DataFrame, kernel: list[float], low: int, bin_size: int, resolution: int, cap: int = 3) -> DataFrame:
    """Kernel-matched peaks: counts capped per row, binned on the oriented axis (to the nearest bin), convolved with the kernel (weights for read offsets low, low + 1, ... bins
    upstream of a site) in blocks of bins no further apart than the kernel spans; local maxima, then non-maximum suppression within (resolution - 1) // bin_size bins by (-score, bin).
    -> (contig, strand, bin long, score double) on the oriented axis."""
    weights = np.array(kernel, dtype=float)
    sign = F.when(F.col("strand") == "+", 1).otherwise(-1)
    if not 1 <= bin_size <= resolution:
        raise ValueError("the bin size must lie between 1 and the resolution")
    at = nearest_bin(F.col("coordinate") * sign, bin_size).cast("long")
    binned = observed.withColumn("bin", at).groupBy("contig", "strand", "bin").agg(F.sum(F.least("count", F.lit(cap))).alias("depth"))
    blocks = islands(binned, ["contig", "strand"], "bin", len(kernel) - 1)
    apart = (resolution - 1) // bin_size

    def run(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([peaks_of(part) for _, part in parts.groupby("island")])

    def peaks_of(part: pd.DataFrame) -> pd.DataFrame:
        first = int(part.bin.min())
        depth = np.zeros(int(part.bin.max()) - first + 1)
        depth[part.bin.to_numpy() - first] = part.depth
        score = np.convolve(depth, weights)
        score[score < max(1e-12 * score.max(), np.finfo(float).eps)] = 0
        peaks = local_peaks(score)
        kept: list[int] = []
        for p in peaks[np.lexsort((peaks, -score[peaks]))]:
            if all(abs(p - q) > apart for q in kept):
                kept.append(int(p))
        return pd.DataFrame({"contig": part.contig.iloc[0], "strand": part.strand.iloc[0], "bin": [p + first + low for p in sorted(kept)], "score": [score[p] for p in sorted(kept)]})

    blocks = spread(blocks.withColumn("together", F.floor(F.col("island") / TOGETHER)), "contig", "strand", "together")
    return blocks.groupBy("contig", "strand", "together").applyInPandas(run, "contig string, strand string, bin long, score double")
