"""Names, counts and titles as shown in tables and figures, and summaries that skip values that aren't finite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns a gene is coloured by, and the suffix of a pattern that only flagged sites support.
PATTERNS = ("intronic_gain", "intronic_loss", "alternative_last_exon", "utr_shortening", "utr_lengthening", "unclassified_change", "none")
FLAGGED = "_potential_internal_priming"
SEPARATORS = ("_", "-", ".")


def comparison_title(stem: Column) -> Column:
    return F.replace(stem, F.lit("_vs_"), F.lit(" vs "))


def count_text(value: Column) -> Column:
    """Whole numbers with thousands separators; null for null."""
    return F.format_number(F.bround(value.cast("double")), 0)


def plural(count: Column, word: str) -> Column:
    return F.concat(count_text(count), F.lit(" "), F.when(count == 1, word).otherwise(f"{word}s"))


def wrapped_name(name: Column, limit: int = 30) -> Column:
    """name over lines of at most limit characters where it can be broken after `_`, `.` or `-`; a longer part has its own line."""
    length = F.char_length(name)
    # places where a line may end, and of these the ones where it does: the next one lies too far from where the line began
    ends = F.filter(F.sequence(F.lit(1), length), lambda i: (i == length) | F.substr(name, i, F.lit(1)).isin(*SEPARATORS))
    begun = lambda cuts: F.element_at(cuts, -1)
    pairs = F.arrays_zip(ends.alias("here"), F.slice(ends, F.lit(2), F.size(ends)).alias("next"))
    cuts = F.aggregate(pairs, F.array(F.lit(0)), lambda cuts, p: F.when(F.coalesce(p["next"] - begun(cuts) > limit, F.lit(False)), F.array_append(cuts, p["here"])).otherwise(cuts))
    lines = F.transform(cuts, lambda at, k: F.substr(name, at + 1, F.coalesce(F.get(cuts, k + 1), length) - at))
    return F.when(length > 0, F.array_join(lines, "\n")).otherwise(name)


def sample_labels(samples: DataFrame, sample: str = "sample_id", condition: str = "condition") -> DataFrame:
    """samples with `label`: the ids without their condition and its separator if every id starts so and has more to it, else the whole ids."""
    tail = F.expr(f"substr(`{sample}`, char_length(`{condition}`) + 2)")
    rest = F.nullif(F.coalesce(*[F.when(F.startswith(sample, F.concat(condition, F.lit(s))), tail) for s in SEPARATORS]), F.lit(""))
    whole = samples.filter(rest.isNull()).limit(1).count() > 0
    return samples.withColumn("label", F.col(sample) if whole else rest)


def first_pattern(patterns: Column) -> Column:
    """The first of patterns joined by `;`, without the suffix; none for null or an unknown one."""
    first = F.regexp_replace(F.substring_index(patterns, ";", 1), f"{FLAGGED}$", "")
    return F.when(first.isin(*PATTERNS), first).otherwise("none")


def first_flagged(patterns: Column) -> Column:
    """Whether only flagged sites support the first pattern; false for null."""
    return F.coalesce(F.endswith(F.substring_index(patterns, ";", 1), F.lit(FLAGGED)), F.lit(False))


def finite(value: Column) -> Column:
    """value, null if it is NaN or infinite (Spark orders NaN above infinity)."""
    return F.when(F.abs(value) < float("inf"), value)


def median_finite(value: Column) -> Column:
    return F.median(finite(value))


def first_finite(*values: Column) -> Column:
    return F.coalesce(*[finite(v) for v in values])


def nearest_of(value: Column, ordered: Column) -> Column:
    """The element of an array nearest to value, the lower of two as near; null for an empty array."""
    by = F.transform(ordered, lambda x: F.struct(F.abs(x - value).alias("d"), x.alias("x")))
    return F.array_min(by)["x"]

