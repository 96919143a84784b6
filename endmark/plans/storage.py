"""Tables that cut a plan: in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset a temporary folder serves local mode, whose executors run in the
    driver; on a cluster it is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='endmark_')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: later stages survive lost executors and skip its plan."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that `written` returned, once no plan that will still run reads them."""
    for df in tables:
        path = df._written_at
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys into the session's number of shuffle partitions. Adaptive execution merges partitions that are small in bytes, which would leave groups
    that cost much time to one task; a stated number stays."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
