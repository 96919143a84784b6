"""Validation queries: each returns the offending rows, none if the input is sound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import written

RESERVED = ("all", "control", "treatment", "pac_id", "gene_id")


def sample_sheet(samples: DataFrame, least_replicates: int = 2) -> DataFrame:
    """(problem, item) of a sheet (sample_id, condition, control_condition): duplicate, unsafe or reserved ids, several controls, unknown or own controls, few replicates."""
    s = samples
    ids = s.groupBy("sample_id").agg(F.count("*").alias("n"))
    conditions = s.groupBy("condition").agg(F.count("*").alias("n"), F.count_distinct("control_condition").alias("controls"))
    known = s.select(F.col("condition").alias("_known")).distinct()
    pick = lambda df, problem, item: df.select(F.lit(problem).alias("problem"), F.col(item).alias("item"))
    parts = [
        pick(s.filter("control_condition = condition").select("condition").distinct(), "own_control", "condition"),
        pick(ids.filter("n > 1"), "duplicate_sample", "sample_id"), pick(ids.filter(~F.col("sample_id").rlike("^[A-Za-z0-9._-]+$")), "unsafe_sample", "sample_id"), pick(ids.filter(F.lower("sample_id").isin(*RESERVED)), "reserved_sample", "sample_id"),
        pick(conditions.filter("controls > 1"), "several_controls", "condition"), pick(conditions.filter(F.col("n") < least_replicates), "few_replicates", "condition"),
        pick(s.filter("control_condition is not null").join(known, F.col("control_condition") == F.col("_known"), "left_anti").select("control_condition").distinct(), "unknown_control", "control_condition"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def control_roles(samples: DataFrame) -> DataFrame:
    """(condition, role): control, treatment or treatment_and_control. A condition that names itself or nothing has no control."""
    s = samples.select("condition", "control_condition").distinct()
    used = s.filter("control_condition is not null and control_condition <> condition").select(F.col("control_condition").alias("condition"), F.lit(True).alias("is_control")).distinct()
    has = s.groupBy("condition").agg(F.bool_or(F.coalesce(F.col("control_condition") != F.col("condition"), F.lit(False))).alias("has_control"))
    d = has.join(used, "condition", "left")
    return d.select("condition", F.when(F.col("has_control") & F.col("is_control").isNotNull(), "treatment_and_control").when(F.col("has_control"), "treatment").otherwise("control").alias("role"))


def cyclic(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """Nodes on or above a cycle of child -> parent: what is left after parents' leaves are taken away again and again."""
    left = edges.select(F.col(child).alias("child"), F.col(parent).alias("parent")).filter("parent is not null and child is not null").distinct()
    n = left.count()
    while n:
        left = left.join(left.select(F.col("child").alias("_c")), F.col("parent") == F.col("_c"), "left_semi")
        left = written(left)
        if (m := left.count()) == n:
            break
        n = m
    return left.select(F.col("child").alias("node")).distinct()


def contigs(alignment: DataFrame, genome: DataFrame) -> DataFrame:
    """(contig, problem): contigs of alignments that the genome lacks or gives another length."""
    g = genome.select("contig", F.col("length").alias("_length"))
    d = alignment.join(g, "contig", "left")
    return d.select("contig", F.when(F.col("_length").isNull(), "missing").when(F.col("length") != F.col("_length"), "length").alias("problem")).filter("problem is not null")


def broken_totals(usage: DataFrame) -> DataFrame:
    """(gene_id, sample_id) whose counts don't add up to the total, or whose shares don't to 1."""
    d = usage.groupBy("gene_id", "sample_id").agg(F.sum("count").alias("n"), F.max("gene_total").alias("t"), F.sum("pau").alias("s"))
    return d.filter((F.col("n") != F.col("t")) | ((F.col("t") > 0) & (F.abs(F.col("s") - 1) > 1e-8 + 1e-5))).select("gene_id", "sample_id")


def several_names(features: DataFrame, key: str, name: str) -> DataFrame:
    return features.groupBy(key).agg(F.count_distinct(name).alias("names")).filter("names > 1")


# What a sheet's columns may hold, and the states of a resampled interval.
CHOICES = {
    "layout": ("auto", "SE", "PE"),
    "strandedness": ("auto", "forward", "reverse"),
    "library_profile": ("generic_3prime", "plasmidsaurus_3prime", "exact_boundary"),
    "evidence_source": ("auto", "read_3p", "read_5p", "fragment_3p", "polyA_junction"),
}
INTERVAL_STATES = ("ok", "insufficient_successes", "fit_unavailable", "not_selected", "disabled")
INTERVAL_KEYS = ("comparison", "gene_id", "feature_id")


def sample_fields(samples: DataFrame, covariates: tuple[str, ...] = (), defaults: dict[str, str] | None = None, choices: dict[str, tuple[str, ...]] = CHOICES) -> DataFrame:
    """(sample_id, field, problem): values that a column doesn't allow (empty or null ones stand for the default, else auto or any first choice) and samples
    without a covariate. A covariate that the sheet has no column for is a row of null sample_id. One pass, no shuffle."""
    defaults = defaults or {}
    found = []
    for field, allowed in choices.items():
        given = F.coalesce(F.nullif(F.col(field), F.lit("")), F.lit(defaults.get(field, allowed[0]))) if field in samples.columns else F.lit(defaults.get(field, allowed[0]))
        found.append(F.when(~given.isin(*allowed), F.struct(F.lit(field).alias("field"), F.lit("invalid").alias("problem"))))
    lacking = [c for c in covariates if c not in samples.columns]
    for c in covariates:
        if c not in lacking:
            found.append(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.struct(F.lit(c).alias("field"), F.lit("missing").alias("problem"))))
    out = samples.select("sample_id", F.explode(F.array_compact(F.array(*found))).alias("p")).select("sample_id", "p.field", "p.problem")
    absent = samples.sparkSession.createDataFrame([(None, c, "no_column") for c in lacking], "sample_id string, field string, problem string")
    return out.unionByName(absent.select(F.col("sample_id").cast(out.schema["sample_id"].dataType), "field", "problem")) if lacking else out


def replicates(samples: DataFrame, least: int = 2, policy: str = "error") -> DataFrame:
    """samples with `exploratory`: whether its condition has fewer than least samples. Under the policy error such a condition raises; under warn it stays."""
    few = samples.groupBy("condition").agg(F.count("*").alias("_n")).filter(F.col("_n") < least)
    if policy == "error":
        if short := few.orderBy("condition").limit(20).collect():
            raise ValueError(f"fewer than {least} replicates: " + ", ".join(f"{r.condition}={r._n}" for r in short))
    elif policy != "warn":
        raise ValueError(f"unknown policy: {policy}")
    return samples.join(few.select("condition", F.lit(True).alias("exploratory")), "condition", "left").withColumn("exploratory", F.coalesce("exploratory", F.lit(False)))


def bootstrap_intervals(intervals: DataFrame) -> DataFrame:
    """(comparison, gene_id, feature_id, problem) of resampled intervals: no_key, counts (not whole numbers from 0), perturbed (more than successes), status,
    bounds (low above high) and repeated (a key of several rows). Bounds that aren't numbers are missing, as null ones are."""
    number = lambda c: F.col(c).try_cast("double")
    n, p, low, high = number("bootstrap_successes"), number("bootstrap_perturbed"), number("delta_pau_ci_low"), number("delta_pau_ci_high")
    whole = lambda c: F.coalesce((c >= 0) & (c < float("inf")) & (c == F.floor(c)), F.lit(False))
    lacking = F.lit(False)
    for k in INTERVAL_KEYS:
        lacking = lacking | (F.coalesce(F.col(k).cast("string"), F.lit("")) == "")
    rules = {
        "no_key": lacking, "counts": ~(whole(n) & whole(p)), "perturbed": whole(n) & whole(p) & (p > n),
        "status": ~F.coalesce(F.col("bootstrap_status").isin(*INTERVAL_STATES), F.lit(False)),
        "bounds": ~F.isnan(low) & ~F.isnan(high) & (low > high),
    }
    named = F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    broken = intervals.select(*INTERVAL_KEYS, F.explode(named).alias("problem"))
    twice = intervals.groupBy(*INTERVAL_KEYS).agg(F.count("*").alias("_n")).filter("_n > 1").select(*INTERVAL_KEYS, F.lit("repeated").alias("problem"))
    return broken.unionByName(twice)


def bootstrap_totals(counts: DataFrame, value: str = "count") -> DataFrame:
    """(gene_id, sample_id, total) that can't be resampled: a total that isn't a finite whole number from 0 to 2^31 - 1, within 2^-26 of its size."""
    t = counts.groupBy("gene_id", "sample_id").agg(F.sum(F.col(value).cast("double")).alias("total"))
    good = (F.col("total") >= 0) & (F.col("total") <= 2**31 - 1) & (F.abs(F.col("total") - F.round("total")) <= 2.0**-26 * F.greatest(F.lit(1.0), F.abs("total")))
    return t.filter(~F.coalesce(good, F.lit(False)))
