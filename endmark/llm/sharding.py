"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 to n-1 in the order of `order` (ties among equal rows are interchangeable). The keyed
permutation sends row number r to place p; its shard is p mod shards and its slot p div shards, so shard
sizes differ by one at most (law `rows`), slots have no gaps, and shard and slot can be computed from r
alone, as r can from them (`row_at`). The result doesn't depend on files or partitions.

Nulls sort first, null texts count as empty, an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, written
from .feistel import permute


def number_rows(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """df with global row numbers in the order given, and the row count.

    One range shuffle; the only thing gathered is a count for each partition. Equal rows are told apart by
    their place in the scan, so a key with many equal rows spreads over partitions too.
    """
    place, tie = fresh(df, "place", "tie")
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order] + [F.col(tie)]
    # in a sorted partition the id is partition << 33 | place
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop(tie)
    placed = written(dealt.withColumn(place, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(place), 33)
    counts = dict(placed.groupBy(part.alias("part")).count().collect())  # one row a partition
    starts, n = [], 0
    for k in range(max(counts, default=-1) + 1):
        starts.append(n)
        n += counts.get(k, 0)
    start = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts] or [F.lit(0).cast("long")]), (part + 1).cast("int"))
    return placed.withColumn(name, start + F.col(place).bitwiseAND((1 << 33) - 1)).drop(place), n


def shard_rows(df: DataFrame, shards: int, seed: int, order: list[str]) -> DataFrame:
    """df with row_number, shard (int) and slot (long)."""
    if shards < 1:
        raise ValueError("shards must be positive")
    place = fresh(df, "p")[0]
    numbered, n = number_rows(df.drop("row_number", "shard", "slot"), order)

    @F.pandas_udf("long")
    def placed(r: pd.Series) -> pd.Series:
        return pd.Series(permute(r.to_numpy(), n, seed))

    out = numbered.withColumn(place, placed("row_number"))
    return out.withColumn("shard", (F.col(place) % shards).cast("int")).withColumn("slot", F.floor(F.col(place) / F.lit(shards)).cast("long")).drop(place)


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The row number that stands in a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), n, seed, forward=False)[0])
