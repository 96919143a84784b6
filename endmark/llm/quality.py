"""Quality rules with risk-controlled cutoffs.

Every rule gives a document a number that grows with its defects. A labelled holdout picks, per stratum
and rule, the strictest cutoff of a grid fixed beforehand whose rate of rejected good documents is proven
to be at most `alpha`: an exact binomial test at each cutoff, from the loosest to the strictest, stopping
at the first that fails (fixed-sequence testing, no correction needed within a rule), each at level
`delta` / (rules x strata) (Bonferroni over the rest). With probability 1 - delta all cutoffs hold at once.
A rule that cannot be certified for a stratum rejects nothing there.

Only DataFrame functions are used. Null texts count as empty, a null stratum is a stratum of its own,
documents without a label are judged by the cutoffs alone, an empty label table certifies nothing.
A document with several labels is good if all are 1. Repeated rows are judged alike, one result each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, fresh, once, text_of, words_of, written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_shouts")

#: Fixed before any label is seen: rule, its number, cutoffs from the loosest to the strictest.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "repeats": ("n_repeat_words / nullif(n_words, 0)", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
    "symbols": ("n_symbols / nullif(n_words, 0)", (2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.8, 0.7, 0.6, 0.5, 0.4, 0.34)),
    "upper": ("n_upper / greatest(word_chars, 1)", (0.9, 0.7, 0.5, 0.4, 0.3)),
    "shouts": ("n_shouts / nullif(n_words, 0)", (2.0, 1.5, 1.0, 0.5, 0.3, 0.2, 0.1)),
    "long_words": ("word_chars / nullif(n_words, 0)", (40.0, 30.0, 20.0, 15.0)),
}


def _let(value: Column, of) -> Column:
    """of(value) with value computed once."""
    return F.get(F.transform(F.array(value), lambda x: of(x)), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice."""

    def covered(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return _let(ordered, lambda s: _let(pairs(s), starts))

    # neighbours in the sorted list that are equal are the repeated windows
    pairs = lambda s: F.filter(F.arrays_zip(s.alias("a"), F.slice(s, F.lit(2), F.size(s)).alias("b")), lambda p: p["a"]["g"] == p["b"]["g"])

    def starts(p: Column) -> Column:
        return _let(F.sort_array(F.array_distinct(F.flatten(F.transform(p, lambda x: F.array(x["a"]["i"], x["b"]["i"]))))), total)

    def total(at: Column) -> Column:
        gaps = F.zip_with(at, F.slice(at, F.lit(2), F.size(at)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)

    grams = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1), F.lit(" "), F.get(words, i + 2)))
    return _let(grams, covered)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with MEASURES and EXTRA (long) added; columns of these names are replaced."""
    t, w, ls, g, m, marks = fresh(docs.drop(*MEASURES, *EXTRA), "t", "w", "ls", "g", "m", "marks")
    d = docs.withColumn(t, text_of(text)).drop(*MEASURES, *EXTRA)
    d = d.withColumn(w, words_of(F.col(t)))
    d = d.withColumn(ls, F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    # equal windows have equal hashes: only texts with a hash that repeats need the windows themselves
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    d = d.withColumn(g, F.when(F.size(w) >= 3, hashes).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn(marks, F.regexp_replace(t, "[^#*$%&|<>!?\\p{Lu}]+", ""))
    count = lambda keep: F.char_length(F.regexp_replace(marks, keep, ""))
    measures = {
        "n_words": F.size(w),
        "word_chars": F.char_length(F.array_join(w, "")),
        "n_symbols": count("[^#*$%&|<>]+"),
        "n_upper": count("[^\\p{Lu}]+"),
        "n_shouts": count("[^!?]+"),
        "n_lines": F.size(ls),
        "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)),
        "n_repeat_words": F.when(F.size(F.array_distinct(g)) < F.size(g), _repeat_words(F.col(w))).otherwise(0),
    }
    d = once(d, m, F.struct(*[x.cast("long").alias(n) for n, x in measures.items()]))
    return d.withColumns({n: F.col(m)[n] for n in measures}).drop(t, w, ls, g, m, marks)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1, by Stirling's series from x + 8 on."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5))) - 1 / (1680 * F.pow(y, F.lit(7)))
    below = F.log(x)
    for k in range(1, 8):
        below = below + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - below


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p) and k <= n p, summed from the largest term down. Terms fall faster than exp(-j^2 / 2(k + 1)), so those more than
    40 sqrt(k + 1) places below are less than rounding."""
    kd, nd = k.cast("double"), n.cast("double")
    log_term = _log_gamma(nd + 1) - _log_gamma(kd + 1) - _log_gamma(nd - kd + 1) + kd * math.log(p) + (nd - kd) * math.log1p(-p)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(s: Column, j: Column) -> Column:
        term = s["term"] * (kd - j) / (nd - kd + j + 1) * ((1 - p) / p)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(0), F.least(kd - 1, F.ceil(40 * F.sqrt(kd + 1))).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.exp(log_term) * F.aggregate(terms, start, step, lambda s: s["total"])


def calibrate(measured: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", quality: str = "quality",
              alpha: float = 0.005, delta: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff, good, rejected, p_value): the strictest certified cutoff of each stratum and rule.

    measured: documents with their measures. Good documents that the base rule keeps are the holdout.
    """
    good = labels.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.col(quality)).alias("_good")).filter("_good = 1").select(F.col(key).alias("_key"))
    numbers = F.array(*[F.struct(F.lit(name).alias("rule"), F.expr(f"double({number})").alias("x"), F.array(*map(F.lit, cuts)).alias("cuts")) for name, (number, cuts) in RULES.items()])
    held = measured.filter(~base_failed()).select(F.col(key).alias("_key"), F.col(stratum).cast("string").alias("stratum"), numbers.alias("rules"))
    held = held.join(good, "_key", "left_semi")
    cuts = held.select("stratum", F.explode("rules").alias("r")).select("stratum", "r.rule", "r.x", F.posexplode("r.cuts").alias("at", "cutoff"))
    at = cuts.groupBy("stratum", "rule", "at", "cutoff").agg(F.count("*").alias("good"), F.sum((F.col("x") > F.col("cutoff")).cast("long")).alias("rejected"))
    at = written(at)
    strata = max(1, at.select("stratum").distinct().count())
    p = F.when(F.col("rejected") <= F.col("good") * alpha, binomial_cdf(F.col("rejected"), F.col("good"), alpha)).otherwise(1.0)
    at = at.withColumn("p_value", p).withColumn("passes", F.col("p_value") <= delta / (strata * len(RULES)))
    first = Window.partitionBy("stratum", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    at = at.withColumn("so_far", F.min("passes").over(first)).filter("so_far")
    last = Window.partitionBy("stratum", "rule").orderBy(F.desc("at"))
    return at.withColumn("_n", F.row_number().over(last)).filter("_n = 1").select("stratum", "rule", "cutoff", "good", "rejected", "p_value")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """measured with base_failed and kept. The cutoffs table has a row per stratum at most here; Spark broadcasts it
    if its measured size allows and else shuffles, splitting hot strata."""
    at, of = fresh(measured, "stratum", "cutoffs")
    wide = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(of)).withColumnRenamed("stratum", at)
    out = measured.join(wide, F.col(stratum).cast("string").eqNullSafe(F.col(at)), "left")
    fails = F.lit(False)
    for name, (number, _) in RULES.items():
        fails = fails | F.coalesce(F.expr(f"double({number})") > F.col(of)[name], F.lit(False))
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~fails).drop(at, of)


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
                  alpha: float = 0.005, delta: float = 0.05) -> DataFrame:
    """docs with measures, base_failed and kept. Measures are computed twice: in a narrow first pass for the
    cutoffs, and beside the texts in the second, which needs no shuffle."""
    narrow = measure(docs.select(key, stratum, text), text).drop(text)
    cutoffs = written(calibrate(narrow, labels, key, stratum, alpha=alpha, delta=delta))
    return judge(measure(docs, text), cutoffs, stratum)


def quality_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
                   alpha: float = 0.005, delta: float = 0.05) -> DataFrame:
    """(key, stratum, measures, base_failed, kept) without the texts: measures are computed once and kept as a narrow table."""
    narrow = written(measure(docs.select(key, stratum, text), text).drop(text))
    cutoffs = written(calibrate(narrow, labels, key, stratum, alpha=alpha, delta=delta))
    return judge(narrow, cutoffs, stratum)
