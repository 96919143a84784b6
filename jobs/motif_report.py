"""Motifs of sequences, and which motifs a group of sequences has more often than the others.

    python -m jobs.motif_report --texts PATH --out DIR [--config FILE] [--master URL]

`out/sequences/part=G` has a row for each input row of group G: length, share of A, longest run of A, whether its last letters look like a tail of A, how many hits the motif
catalogue has in the whole sequence, the preferred hit and all motifs that occur. `out/enrichment/part=G` has a row for each motif: sequences of
the group with and without it against all other groups, pooled over strata by Cochran-Mantel-Haenszel, with p-value and FDR within the group.

Each run reads all texts and replaces both tables, so what stands there depends on the input alone and a run may be repeated at any time. A null or empty group is `none`
(a group of that name joins it), a null stratum one of its own; null and empty texts are sequences of length 0; equal rows count each. Figures are rounded, so that the order of sums doesn't show.
The sequences table takes no shuffle; the enrichment is aggregated from it as written.
Config: `sequence` (SQL expression), `id`, `group`, `stratum`, `motifs` ([motif, class, priority], letters ACGT), `core` (preferred distances from the end), `tail`.
"""

from __future__ import annotations

import argparse
import json
import logging
import re
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from endmark.functions import sequences
from endmark.operators import annotation, models, testing

LOG = logging.getLogger("jobs.motif_report")
CONFIG = Path(__file__).with_suffix(".json")


def config(path: str | None = None) -> dict:
    """The settings of a config file, by default the one beside this module; motifs must be different and of ACGT."""
    out = json.loads(Path(path or CONFIG).read_text(encoding="utf-8"))
    names = [m for m, _, _ in out["motifs"]]
    if len(set(names)) < len(names) or not all(re.fullmatch("[ACGT]+", m) for m in names):
        raise ValueError(f"motifs must be different and of the letters ACGT: {names}")
    return out


def described(texts: DataFrame, settings: dict) -> DataFrame:
    """The sequences table, `part` being the group."""
    rows = texts.select(F.col(settings["id"]).alias("id"), F.coalesce(F.nullif(F.col(settings["group"]).cast("string"), F.lit("")), F.lit("none")).alias("part"), F.col(settings["stratum"]).cast("string").alias("stratum"), F.coalesce(F.expr(settings["sequence"]), F.lit("")).alias("seq"))
    seq = F.col("seq")
    motifs = [tuple(m) for m in settings["motifs"]]
    names = sorted(m for m, _, _ in motifs)
    rows = rows.withColumn("turned", F.reverse(seq))
    rows = rows.withColumn("best", sequences.preferred_hit(seq, F.col("turned"), motifs, tuple(settings["core"])))
    return rows.select(
        "id", "stratum", F.char_length(seq).alias("length"), F.round(sequences.base_fraction(seq, "A"), 9).alias("a_fraction"), sequences.longest_run(seq, "A").cast("int").alias("longest_a_run"),
        annotation.priming(F.right(seq, F.lit(settings["tail"]))).alias("tail_of_a"), sequences.motif_count(seq, names).alias("n_hits"), F.coalesce("best.motif", F.lit("no_recognized_motif")).alias("primary_motif"), F.col("best.motif_class").alias("motif_class"),
        F.col("best.distance").cast("int").alias("distance"), F.concat_ws(",", *[F.when(seq.contains(m), m) for m in names]).alias("motifs"), "part")


def enriched(rows: DataFrame, settings: dict) -> DataFrame:
    """The enrichment table of a sequences table."""
    known = rows.withColumn("stratum", F.coalesce(F.concat(F.lit("="), "stratum"), F.lit("")))
    sizes = known.groupBy("part", "stratum").agg(F.count("*").alias("n"))
    seen = known.withColumn("motif", F.explode(F.split("motifs", ","))).groupBy("part", "stratum", "motif").agg(F.count("*").alias("a"))
    # a row for each group, stratum and motif; both sides are counts of few groups
    grid = sizes.withColumn("motif", F.explode(F.array(*[F.lit(m) for m, _, _ in settings["motifs"]]))).join(seen, ["part", "stratum", "motif"], "left").withColumn("a", F.coalesce("a", F.lit(0)))
    every = Window.partitionBy("stratum", "motif")
    strata = grid.withColumn("b", F.col("n") - F.col("a")).withColumns({"c": F.sum("a").over(every) - F.col("a"), "d": F.sum("b").over(every) - F.col("b")})
    pooled = testing.mantel_haenszel(strata, ["part", "motif"])
    tested = testing.benjamini_hochberg(pooled.withColumn("p", models.chi_square_tail(F.col("chi_square"), F.lit(1))), "p", "fdr", ["part"])
    counts = strata.groupBy("part", "motif").agg(F.sum("a").alias("with_motif"), F.sum("n").alias("n_sequences"))
    out = counts.join(tested.select("part", "motif", "strata", "odds_ratio", "chi_square", "p", "fdr"), ["part", "motif"], "left")
    figures = [F.round(name, digits).alias(name) for name, digits in (("odds_ratio", 9), ("chi_square", 9), ("p", 7), ("fdr", 7))]
    return out.select("motif", "n_sequences", "with_motif", F.coalesce("strata", F.lit(0)).cast("long").alias("strata"), *figures, "part")


def _replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(path)


def report(spark: SparkSession, texts: str, out: str, settings: dict) -> dict[str, int]:
    """Write both tables; what was read and written."""
    rows = described(spark.read.parquet(texts), settings)
    observed = Observation()
    _replace(rows.observe(observed, F.count("*").alias("n"), F.coalesce(F.sum("n_hits"), F.lit(0)).alias("hits")), f"{out}/sequences")
    found = enriched(spark.read.schema(rows.schema).parquet(f"{out}/sequences"), settings)
    _replace(found, f"{out}/enrichment")
    log = {"rows_read": observed.get["n"], "hits": observed.get["hits"], "enrichment_rows": spark.read.schema(found.schema).parquet(f"{out}/enrichment").count()}
    LOG.info("read %(rows_read)d sequences with %(hits)d hits; wrote them and %(enrichment_rows)d rows of enrichment", log)
    return log


def result(spark: SparkSession, out: str, settings: dict) -> DataFrame:
    """Both tables in one, `table` telling them apart."""
    kinds = {"sequences": "id long, stratum string, length int, a_fraction double, longest_a_run int, tail_of_a boolean, n_hits int, primary_motif string, motif_class string, distance int, motifs string, part string",
             "enrichment": "motif string, n_sequences long, with_motif long, strata long, odds_ratio double, chi_square double, p double, fdr double, part string"}
    tables = [spark.read.schema(kind).parquet(f"{out}/{name}").withColumn("table", F.lit(name)) for name, kind in kinds.items()]
    tables[0] = tables[0].withColumn("tail_of_a", F.col("tail_of_a").cast("int"))  # nulls of the other table join it
    return tables[0].unionByName(tables[1], allowMissingColumns=True)


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("texts", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config")
    p.add_argument("--master")
    a = p.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    builder = SparkSession.builder.appName("motif_report")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    try:
        report(spark, a.texts, a.out, config(a.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
