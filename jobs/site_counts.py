"""Site usage of samples, kept up to date while files of read ends arrive.

    python -m jobs.site_counts --reads DIR --atlas DIR --out DIR --checkpoint DIR [--config FILE] [--master URL]

A file stream takes the files that its checkpoint doesn't know yet, counts their read ends by sample and place, and lands each micro-batch under
`out/landed/batch=N/sample_id=S`; a batch that is done again replaces its own files. Then the samples with landed batches that
`out/published` doesn't name are counted anew from all their batches: each read end goes to the nearest site of the atlas within the radius (ties to the lower
coordinate), and `out/usage/sample_id=S` gets a row for every site, with reads, the gene's reads and the share. Dynamic partition overwrite replaces those samples alone. The
mark is written last, so a run that stopped anywhere is made good by the next one, and a run without new files changes nothing.

Rows whose sample, place or count is null or empty, or whose count is not positive, are left out and reported. Only one run at a time may use an output folder.
Config: `columns` (SQL expressions over the files' columns for sample_id, contig, strand, coordinate, count, poly_a_clip_count), `radius`, `files_at_once`.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from endmark.operators import aggregates, joins

LOG = logging.getLogger("jobs.site_counts")
CONFIG = Path(__file__).with_suffix(".json")
PLACE = ["sample_id", "contig", "strand", "coordinate"]
USAGE = "pac_id string, gene_id string, contig string, strand string, coordinate long, count long, gene_total long, pau double, sample_id string"
LANDED = "contig string, strand string, coordinate long, count long, poly_a_clip_count long, rows long, unusable long, batch long, sample_id string"


def config(path: str | None = None) -> dict:
    """The settings of a config file, by default the one beside this module."""
    return json.loads(Path(path or CONFIG).read_text(encoding="utf-8"))


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of this job's, empty before anything is written. A table that is there but can't be read is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def landed(batch: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A batch's read ends, counted by place. Rows that can't be used are counted at a place that is null."""
    ends = batch.select(*[F.expr(e).alias(name) for name, e in columns.items()])
    good = F.coalesce(F.col("count") > 0, F.lit(False))
    for name in PLACE:
        good = good & (F.coalesce(F.col(name).cast("string"), F.lit("")) != "")
    ends = ends.withColumn("_good", good).withColumns({name: F.when(F.col("_good"), F.col(name)) for name in PLACE})
    return ends.groupBy(*PLACE).agg(
        F.sum(F.when(F.col("_good"), F.col("count"))).cast("long").alias("count"), F.sum(F.when(F.col("_good"), F.col("poly_a_clip_count"))).cast("long").alias("poly_a_clip_count"),
        F.count("*").alias("rows"), F.count_if(~F.col("_good")).alias("unusable"))


def usage(evidence: DataFrame, atlas: DataFrame, names: list[str], radius: int) -> DataFrame:
    """Every site with its reads in each of the named samples. atlas: pac_id, gene_id, contig, strand, coordinate."""
    sites = atlas.select("pac_id", "gene_id", "contig", "strand", F.col("coordinate").alias("site"))
    near = joins.nearest_within(evidence, sites, ["contig", "strand"], PLACE, "coordinate", "site", radius)
    counts = near.filter("pac_id IS NOT NULL").groupBy("pac_id", "gene_id", "sample_id").agg(F.sum("count").alias("count"))
    samples = evidence.sparkSession.createDataFrame([(n,) for n in names], "sample_id string")
    whole = aggregates.complete(counts, atlas.select("pac_id", "gene_id", "contig", "strand", "coordinate"), samples, ["pac_id", "gene_id"])
    return aggregates.usage(whole).select("pac_id", "gene_id", "contig", "strand", F.col("coordinate").cast("long").alias("coordinate"), "count", "gene_total", "pau", "sample_id")


def _stream(spark: SparkSession, path: str, most: int) -> DataFrame:
    """A stream of the files at a path: of a folder as they arrive, or of one file, which file streams take as a pattern only."""
    table = spark.read.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    one = table.select("_metadata.file_name").first()
    if one is not None and one.file_name == name:
        path = f"{folder}/{name[:-1]}[{name[-1]}]"
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", most).parquet(path)


def update(spark: SparkSession, reads: str, atlas: str, out: str, checkpoint: str, settings: dict) -> dict[str, int]:
    """Take the new files in and bring the samples they touch up to date; what was read and written."""

    def land(batch: DataFrame, number: int) -> None:
        landed(batch, settings["columns"]).write.mode("overwrite").partitionBy("sample_id").parquet(f"{out}/landed/batch={number}")

    query = _stream(spark, reads, settings["files_at_once"]).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

    every, done = _table(spark, f"{out}/landed", LANDED), _table(spark, f"{out}/published", "batch long")
    new = every.join(done, "batch", "left_anti")
    told = new.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"), F.coalesce(F.sum("unusable"), F.lit(0)).alias("rows_unusable")).first()
    batches = [r.batch for r in new.select("batch").distinct().collect()]  # a row a micro-batch since the last run
    names = sorted(r.sample_id for r in new.filter("sample_id IS NOT NULL").select("sample_id").distinct().collect())  # samples are few
    log = {"batches": len(batches), "rows_read": told.rows_read, "rows_unusable": told.rows_unusable, "samples": len(names), "rows_written": 0}
    if names:
        evidence = every.filter(F.col("sample_id").isin(names)).groupBy(*PLACE).agg(F.sum("count").alias("count"))
        sites = spark.read.parquet(atlas)
        target = f"{out}/usage"
        usage(evidence, sites, names, settings["radius"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sample_id").parquet(target)
        log["rows_written"] = spark.read.schema(USAGE).parquet(target).filter(F.col("sample_id").isin(names)).count()
    if batches:
        spark.createDataFrame([(b,) for b in batches], "batch long").coalesce(1).write.mode("append").parquet(f"{out}/published")
    LOG.info("read %(rows_read)d rows (%(rows_unusable)d unusable) of %(batches)d new batches; wrote %(rows_written)d rows of %(samples)d samples", log)
    return log


def result(spark: SparkSession, out: str) -> DataFrame:
    """The usage table as it stands."""
    return _table(spark, f"{out}/usage", USAGE)


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("reads", "atlas", "out", "checkpoint"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config")
    p.add_argument("--master")
    a = p.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    builder = SparkSession.builder.appName("site_counts")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    try:
        update(spark, a.reads, a.atlas, a.out, a.checkpoint, config(a.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
