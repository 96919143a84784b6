"""Read-end counts kept up to date from a growing directory of read ends. Counting is associative and keyed by place, so no watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.aggregates import read_end_counts

SCHEMA = "sample_id string, contig string, strand string, coordinate long, evidence_source string, poly_a_clip boolean"


def read_end_stream(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """Read ends from Parquet files as they arrive."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_at_once).parquet(path)


def counted(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each batch's counts, aggregated first, appended below out under its number. A batch that is done again after a failure replaces its own files, so
    nothing counts twice; `total` adds the batches up."""

    def add(batch: DataFrame, number: int) -> None:
        read_end_counts(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def total(spark: SparkSession, out: str) -> DataFrame:
    """Evidence so far."""
    keys = ["sample_id", "contig", "strand", "coordinate", "evidence_source"]
    return spark.read.parquet(out).groupBy(*keys).agg(F.sum("count").alias("count"), F.sum("poly_a_clip_count").alias("poly_a_clip_count"))
