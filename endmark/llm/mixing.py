"""Mixing sources to target weights with exact block quotas.

Weights go to the sources in code-point order (null last). Together the sources are to give `share` times
all words; a source's target stops at `most` times its size and the excess goes to the others by weight.
A document's keyed digest places it in its source's permuted sequence, which is cut into blocks at
digest prefixes, 16 a shard or more. A source that is to give q words gives its sequence as often as q allows, then a last part:
whole blocks, of the block at the cut whole sub-blocks, then whole documents as long as that brings the words nearer to
the target; so each source misses its target by half a document at most (half a group of equal rows where one lies on the cut).

The blocks that each source gives are dealt among the output shards by a splitting tree: at each node a
multivariate hypergeometric draw, seeded by the node, splits exact block counts between the two halves of
the shards. Each shard then takes the next blocks of the permuted sequence, so draws are disjoint, and a
keyed order shuffles it locally. What depends on it is decided from digests alone: reruns and retried tasks agree.

Gathered on the driver is a row a source and, for each, a block count a shard; sources are to be few. Executors turn these into a table of a
row for each source and block, which documents are joined to.
Null texts have no words; repeated rows are drawn alike; an empty table gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, fresh, text_of, written

LEAST, SUB = 3, 3  # hex digits of a block's number at least, and of a sub-block's within it
WEIGHTS = (5, 2, 1)
SHARDS, SHARD_WORDS = 64, 1 << 26


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long")


def digest(key: Column, text: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), text))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) with weight and target; one row a source, ranked in one partition."""
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    at = F.array(*[F.lit(float(x)) for x in weights])
    ranked = ranked.withColumn("weight", F.element_at(at, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))).withColumn("full", most * F.col("source_size"))
    # sources fill up in order of full / weight; the first that doesn't sets the level for all that follow
    by = Window.orderBy(F.col("full") / F.col("weight"), "rank")
    before, after, every = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing), by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    ranked = ranked.withColumn("level", F.when(level < F.col("full") / F.col("weight"), level)).withColumn("level", F.first("level", ignorenulls=True).over(every))
    return ranked.withColumn("target", F.least(F.col("full"), F.coalesce(F.col("level") * F.col("weight"), F.col("full")))).select("source", "source_size", "rank", "target")


def split_quotas(blocks: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(sources, shards): how many blocks of each source each shard gets. Rows add up to blocks; shard totals differ by one at most."""
    out = np.zeros((len(blocks), shards), dtype=np.int64)
    todo = [(0, shards, np.asarray(blocks, dtype=np.int64))]
    while todo:
        low, high, have = todo.pop()
        if high - low == 1:
            out[:, low] = have
            continue
        mid, total = (low + high) // 2, int(have.sum())
        each, rest = divmod(total, high - low)
        take = each * (mid - low) + min(rest, mid - low)
        left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(have, take, method="marginals") if total else have
        todo += [(low, mid, left), (mid, high, have - left)]
    return out


def block_digits(shards: int) -> int:
    """Hex digits of a block's number: 16 blocks or more for each shard."""
    return max(LEAST, math.ceil(math.log(max(shards, 1), 16) + 1))


def block_shards(spark: SparkSession, source_nos: list[int], ends: np.ndarray, blocks: int, epochs: int) -> DataFrame:
    """(at_source int, at_block int, shards array<int>): the shard that takes a source's block in each epoch, 0 to epochs. ends: (sources, shards), up to
    which number of given blocks each shard takes."""
    held = spark.sparkContext.broadcast((np.array(source_nos), ends))  # shards x sources longs

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, bounds = held.value
        for part in parts:
            k, block = part["id"].to_numpy() // blocks, part["id"].to_numpy() % blocks
            out = np.empty((len(part), epochs + 1), dtype=np.int64)
            for one in np.unique(k):
                own = np.flatnonzero(k == one)
                for epoch in range(epochs + 1):
                    out[own, epoch] = np.searchsorted(bounds[one], epoch * blocks + block[own], side="right")
            yield pd.DataFrame({"at_source": numbers[k], "at_block": block, "shards": list(out)})

    return spark.range(len(source_nos) * blocks).mapInPandas(run, "at_source int, at_block int, shards array<int>")


def _block(column: str, at: int, digits: int) -> Column:
    return F.conv(F.substring(column, at, digits), 16, 10).cast("int")


def _cut(words: DataFrame, at: str, rest: Column) -> DataFrame:
    """Per source, the first `at` whose words reach beyond rest, with the words still to take there; none if rest is 0."""
    so_far = Window.partitionBy("source_no").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    before = words.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    return before.filter((F.col("before") < rest) & (F.col("before") + F.col("words") >= rest)).select("source_no", F.col(at).alias(f"cut_{at}"), (rest - F.col("before")).alias(f"rest_{at}"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", shards: int | None = None, seed: int = 7,
        weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, keep_text: bool = True) -> DataFrame:
    """docs with size, source_size (long), target (double), taken (long) and draws: an array of (epoch int, shard int,
    place string, words long), one for each copy the mix takes; place orders a shard's copies. keep_text=False: without the text.
    Without a number of shards there are SHARDS, or more where one would take over SHARD_WORDS words."""
    added = ("size", "source_size", "target", "taken", "draws")
    docs = docs.drop(*[c for c in added if c not in (key, text, source)])
    h, s, at_source, at_no, at_h, part, last, of, b_source, b_block, b_shards = fresh(docs, "h", "s", "at_source", "at_no", "at_h", "part", "last", "plan", "b_source", "b_block", "b_shards")
    sized = docs.withColumn("size", word_count(text_of(text))).withColumn(h, digest(F.col(key), text_of(text), str(seed))).withColumn(s, F.col(source).cast("string"))
    if not keep_text:
        sized = written(sized.drop(text))
        narrow = sized.select(F.col(s).alias("source"), "size", F.col(h).alias("h"))
    else:
        narrow = written(sized.select(F.col(s).alias("source"), "size", F.col(h).alias("h")))

    # one row a source, small; joins to it are broadcast if its measured size allows
    plan = written(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
                   .withColumn("quota", F.round("target").cast("long"))
                   .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0).cast("int"))
                   .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("source_size")).withColumnRenamed("rank", "source_no"))
    # the sources: few, as the weights by rank say
    rows = plan.select("source_no", "epochs", "quota", "rest").orderBy("source_no").collect()
    shards = shards or max(SHARDS, -(-sum(r.quota for r in rows) // SHARD_WORDS))
    digits = block_digits(shards)
    blocks = 16**digits
    sources = plan.select(F.col("source").alias("_source"), "source_no", "rest")
    ranked = narrow.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    b1 = ranked.groupBy("source_no", "rest", _block("h", 1, digits).alias("b1")).agg(F.sum("size").alias("words"))
    plan = written(plan.join(_cut(b1, "b1", F.col("rest")), "source_no", "left"))
    inner = narrow.join(plan.filter("cut_b1 is not null").select(F.col("source").alias("_source"), "source_no", "cut_b1", "rest_b1"), F.col("source").eqNullSafe(F.col("_source")) & (_block("h", 1, digits) == F.col("cut_b1")))
    b2 = inner.groupBy("source_no", "rest_b1", _block("h", 1 + digits, SUB).alias("b2")).agg(F.sum("size").alias("words"))
    plan = written(plan.join(_cut(b2, "b2", F.col("rest_b1")), "source_no", "left"))

    # exact block quotas, dealt to the shards
    cut = {r.source_no: r.cut_b1 for r in plan.select("source_no", "cut_b1").collect()}
    given = np.array([r.epochs * blocks + (0 if cut[r.source_no] is None else cut[r.source_no] + 1) for r in rows], dtype=np.int64)
    ends = np.cumsum(split_quotas(given, shards, seed), axis=1) if rows else np.zeros((0, shards), dtype=np.int64)
    most_epochs = max((r.epochs for r in rows), default=0)
    bounds = written(block_shards(docs.sparkSession, [r.source_no for r in rows], ends, blocks, most_epochs)).toDF(b_source, b_block, b_shards)

    # the few documents of the sub-block at the cut
    edge = inner.join(plan.filter("cut_b2 is not null").select("source_no", "cut_b2", "rest_b2"), "source_no").filter(_block("h", 1 + digits, SUB) == F.col("cut_b2"))
    edge = edge.groupBy("source_no", "h", "rest_b2").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    so_far = Window.partitionBy("source_no").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("left", F.col("rest_b2") - F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    # whole where that brings the words nearer to the target
    edge = written(edge.filter(2 * F.col("left") >= F.col("words")).select(F.col("source_no").alias(at_no), F.col("h").alias(at_h), F.lit(True).alias(part)))

    out = sized.join(plan.select(F.col("source").alias(at_source), F.struct("source_no", "source_size", "target", "epochs", "cut_b1", "cut_b2").alias(of)), F.col(s).eqNullSafe(F.col(at_source)), "left")
    out = out.join(edge, (F.col(of)["source_no"] == F.col(at_no)) & (F.col(h) == F.col(at_h)), "left")
    c1, c2, epochs = _block(h, 1, digits), _block(h, 1 + digits, SUB), F.col(of)["epochs"]
    out = out.join(bounds, (F.col(of)["source_no"] == F.col(b_source)) & (c1 == F.col(b_block)), "left")
    whole = (c1 < F.col(of)["cut_b1"]) | ((c1 == F.col(of)["cut_b1"]) & (c2 < F.col(of)["cut_b2"]))
    out = out.withColumn(last, F.when(whole | F.coalesce(part, F.lit(False)), F.col("size")).otherwise(0).cast("long"))
    copies = F.filter(F.transform(F.sequence(F.lit(0), epochs), lambda k: F.struct(
        k.alias("epoch"), F.get(b_shards, k).alias("shard"),
        F.md5(F.concat(F.lit(f"{seed}:place:"), k.cast("string"), F.col(h))).alias("place"), F.when(k < epochs, F.col("size")).otherwise(F.col(last)).alias("words"))), lambda x: x["words"] > 0)
    out = out.withColumns({"source_size": F.col(of)["source_size"], "target": F.col(of)["target"], "taken": epochs * F.col("size") + F.col(last), "draws": copies})
    return out.drop(h, s, at_source, at_no, at_h, part, last, of, b_source, b_block, b_shards)


def draw(mixed: DataFrame, shuffle: bool = True) -> DataFrame:
    """A row for each copy the mix takes, with shard and place added. With shuffle, a shard's rows lie together in the order of place."""
    one = fresh(mixed, "draw")[0]
    out = mixed.withColumn(one, F.explode("draws"))
    out = out.withColumn("shard", F.col(one)["shard"]).withColumn("place", F.col(one)["place"]).drop(one, "draws", "size", "source_size", "target", "taken")
    return out.repartition("shard").sortWithinPartitions("shard", "place") if shuffle else out
