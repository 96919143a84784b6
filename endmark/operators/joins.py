"""Interval, nearest and band joins: an equality on (contig, strand, bin), then the exact range condition.

The side with fewer rows per bin is copied to the bins its rows can reach, so a bare range join is never planned and no
side needs to be broadcast; a hot bin is a hot key of an equi-join, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import oriented


def _bin(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width))


def reach(points: DataFrame, at: Column, radius: int, width: int, name: str = "_bin") -> DataFrame:
    """A copy of each row for every bin within radius of `at`."""
    return points.withColumn(name, F.explode(F.sequence(_bin(at - radius, width), _bin(at + radius, width))))


def within(left: DataFrame, right: DataFrame, keys: list[str], at: str, to: str, radius: int, how: str = "inner") -> DataFrame:
    """left joined with all rows of right (keys and column `to`, its other names not in left) with |at - to| <= radius."""
    width = max(1, 2 * radius)
    r = reach(right.withColumnsRenamed({k: f"_{k}" for k in keys}), F.col(to), radius, width)
    l = left.withColumn("_own", _bin(F.col(at), width))
    on = (F.col("_own") == F.col("_bin")) & (F.abs(F.col(at) - F.col(to)) <= radius)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return l.join(r, on, how).drop("_own", "_bin", *[f"_{k}" for k in keys])


def nearest_within(left: DataFrame, right: DataFrame, keys: list[str], row: list[str], at: str, to: str, radius: int) -> DataFrame:
    """Each row of left (named by `row`) with the row of right nearest within radius, ties to the lower coordinate; nulls if there is none."""
    near = within(left, right, keys, at, to, radius, "left")
    best = Window.partitionBy(*row).orderBy(F.abs(F.col(at) - F.col(to)).asc_nulls_last(), F.col(to))
    return near.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n")


def band_assign(left: DataFrame, right: DataFrame, kernel: DataFrame, keys: list[str], row: list[str], at: str, to: str, span: int, ratio: float,
                ties: str = "genomic") -> DataFrame:
    """Likelihood-ratio assignment. kernel: (offset, weight), weight > 0; a candidate's offset is oriented(to - at). The best by weight, ties by lower
    (genomic or oriented) coordinate; ambiguous if the second best has a weight above 0 and best < ratio * second. Columns of right come null if ambiguous or none."""
    near = within(left, right, keys, at, to, span, "left").withColumn("offset", oriented(F.col(to) - F.col(at), F.col("strand")))
    near = near.join(kernel, "offset", "left")
    tie = F.col(to) if ties == "genomic" else oriented(F.col(to), F.col("strand"))
    w = Window.partitionBy(*row).orderBy(F.col("weight").desc_nulls_last(), tie)
    near = near.withColumn("_n", F.row_number().over(w)).withColumn("_second", F.lead("weight").over(w)).filter("_n = 1")
    ambiguous = F.coalesce((F.col("_second") > 0) & (F.col("weight") < ratio * F.col("_second")), F.lit(False))
    status = F.when(F.col("weight").isNull(), "unassigned").when(ambiguous, "ambiguous").otherwise("assigned")
    near = near.withColumn("status", status)
    for c in [c for c in right.columns if c not in keys]:
        near = near.withColumn(c, F.when(F.col("status") == "assigned", F.col(c)))
    return near.drop("_n", "_second", "offset", "weight")


def contained(points: DataFrame, features: DataFrame, keys: list[str], at: str, start: str = "start", end: str = "end", width: int = 10_000) -> DataFrame:
    """Points with the features that hold them, both ends included."""
    f = features.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), width), _bin(F.col(end), width)))).withColumnsRenamed({k: f"_{k}" for k in keys})
    on = (_bin(F.col(at), width) == F.col("_bin")) & F.col(at).between(F.col(start), F.col(end))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return points.join(f, on).drop("_bin", *[f"_{k}" for k in keys])


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], ends: tuple[str, str], other: tuple[str, str], width: int = 10_000) -> DataFrame:
    """Pairs of half-open intervals that overlap, each once: a pair counts in the bin where the later of the two starts."""
    l = left.withColumn("_lb", F.explode(F.sequence(_bin(F.col(ends[0]), width), _bin(F.col(ends[1]) - 1, width))))
    r = right.withColumn("_rb", F.explode(F.sequence(_bin(F.col(other[0]), width), _bin(F.col(other[1]) - 1, width)))).withColumnsRenamed({k: f"_{k}" for k in keys})
    on = (F.col("_lb") == F.col("_rb")) & (F.col(ends[0]) < F.col(other[1])) & (F.col(other[0]) < F.col(ends[1])) & (_bin(F.greatest(ends[0], other[0]), width) == F.col("_lb"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return l.join(r, on).drop("_lb", "_rb", *[f"_{k}" for k in keys])


def without_neighbours(left: DataFrame, right: DataFrame, keys: list[str], at: str, to: str, radius: int) -> DataFrame:
    """Rows of left that have no row of right within radius."""
    width = max(1, 2 * radius)
    r = reach(right.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(to).alias("_to")), F.col("_to"), radius, width)
    on = (_bin(F.col(at), width) == F.col("_bin")) & (F.abs(F.col(at) - F.col("_to")) <= radius)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return left.join(r, on, "left_anti")


def nearest_end(points: DataFrame, ends: DataFrame, keys: list[str], at: str, most: int) -> DataFrame:
    """Points with the nearest of ends (keys, end, gene), ties to the lower coordinate and the first gene there; those beyond `most` are dropped."""
    first = ends.groupBy(*keys, "end").agg(F.min("gene").alias("gene"))
    near = within(points.withColumn("_row", F.struct(*points.columns)), first, keys, at, "end", most)
    best = Window.partitionBy("_row").orderBy(F.abs(F.col(at) - F.col("end")), "end")
    return near.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n", "_row")


def prioritised(points: DataFrame, tagged: list[DataFrame], key: str) -> DataFrame:
    """Each point with its matches of the first table that has any; tables are joined results with the point's columns, at most one kind a table."""
    out = None
    for priority, table in enumerate(tagged):
        some = table.withColumn("_priority", F.lit(priority))
        out = some if out is None else out.unionByName(some, allowMissingColumns=True)
    best = Window.partitionBy(key)
    found = out.withColumn("_best", F.min("_priority").over(best)).filter("_priority = _best").drop("_priority", "_best")
    return found.unionByName(points.join(found.select(key), key, "left_anti"), allowMissingColumns=True)


def updated(base: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """base with the columns of new where keys match, nulls included; a key that base lacks is an error."""
    if new.join(base, keys, "left_anti").limit(1).count():
        raise ValueError("an update names an unknown key")
    n = new.select(*keys, F.struct(*columns).alias("_new"))
    out = base.join(n, keys, "left")
    return out.withColumns({c: F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)) for c in columns}).drop("_new")


def comparison_pairs(comparisons: DataFrame) -> DataFrame:
    """Pairs (a < b) of comparisons (stem, control, treatment), related by a shared control, chained (one's treatment is the other's control) or unrelated. Comparisons are few."""
    a = comparisons.select(F.col("stem").alias("a"), F.col("control").alias("ca"), F.col("treatment").alias("ta"))
    b = comparisons.select(F.col("stem").alias("b"), F.col("control").alias("cb"), F.col("treatment").alias("tb"))
    chained = (F.col("ta") == F.col("cb")) | (F.col("tb") == F.col("ca"))
    return a.join(b, F.col("a") < F.col("b")).withColumn("relation", F.when(F.col("ca") == F.col("cb"), "shared_control").when(chained, "chained").otherwise("unrelated"))


def renamed_contigs(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """df with contigs under their target names."""
    al = aliases.select(F.col("alias").alias("_alias"), F.col("target").alias("_target"))
    return df.join(al, F.col("contig") == F.col("_alias"), "left").withColumn("contig", F.coalesce("_target", "contig")).drop("_alias", "_target")
