"""Token ids in files: independent rANS blocks under one shared frequency table, with checkpoints and checksums.

A folder holds four Parquet tables, written by Spark and readable from any store:

* `format` - one row: version, lanes, steps between checkpoints, scale.
* `frequencies` - id, freq: the table that all blocks share, from the counts of all ids. At most one row an id of the vocabulary, which bounds
  what is sent to the workers.
* `blocks` - part, block, at (ids before it in its part), documents (key and number of ids, in order), words (uint32, little-endian), word_counts,
  states (uint64) and word_crc32 of each segment, ids_crc32 of the block. A block decodes by itself, and so does each
  segment of a block.
* `parts` - part, first (ids before the part), n_ids, n_documents: a row for each task that wrote blocks.

Documents stand in ascending order of their key, nulls first; rows of one key by a digest of their ids, then as scanned. A block holds whole documents and BLOCK ids at least, but for the last of a part; a
longer document is one block of many segments. Null and empty texts hold the end id alone; rows are never merged; an empty table gives empty tables.
Columns other than the key and the text are not written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe, piecewise, rans
from .common import forget, shared_dir, written

VERSION = 1
BLOCK = 4 * rans.SEGMENT
AT_ONCE = 24  # blocks that are encoded or decoded together
SLICE = 12 << 20  # bytes of texts whose pieces are told apart together
COUNT = "id int, n long"
PACKED = "<u4"


def packing(tokenizer: str) -> str:
    """The type that ids have between the steps: two bytes where the vocabulary allows."""
    return "<u2" if bpe.encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def packed(docs: DataFrame, tokenizer: str, key: str, end: int, text: str = "text") -> DataFrame:
    """(key, ids, counts): the packed token ids of each text and the end id. A row with counts, one a task, has how often each id occurs in the task's rows instead: 64-bit numbers by id."""
    kind = np.dtype(packing(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total, keys = bpe.encoder(tokenizer), np.zeros(0, np.int64), None
        for batch in batches:
            keys = batch.column(0).type
            for low, rows in piecewise.slices(batch.column(1), SLICE):
                part = batch.slice(low, rows)
                ids, at = piecewise.encoded(own, tokenizer, part.column(1))
                whole = np.insert(ids, at[1:], end).astype(kind)
                ends = at + np.arange(len(at))
                found = np.bincount(whole)
                total = np.pad(total, (0, max(0, len(found) - len(total))))
                total[: len(found)] += found
                column = pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(ends * kind.itemsize), pa.py_buffer(whole)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), column, pa.array([False] * rows)], ["key", "ids", "counts"])
        if keys is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, keys), pa.array([total.tobytes()]), pa.array([True])], ["key", "ids", "counts"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("ids"))
    return rows.mapInArrow(run, T.StructType([rows.schema["key"], T.StructField("ids", T.BinaryType()), T.StructField("counts", T.BooleanType())]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n) of rows with counts."""
    for batch in batches:
        for ids in batch.column("ids"):
            total = np.frombuffer(ids.as_buffer(), np.int64)
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["id", "n"])


def _model(frequencies: DataFrame) -> rans.Model:
    rows = frequencies.orderBy("id").toPandas()  # a row an id of the vocabulary
    return rans.Model.of(rows["id"].to_numpy(np.int64), rows["freq"].to_numpy(np.uint32))


def _block_schema(key: T.DataType) -> T.StructType:
    document = T.StructType([T.StructField("key", key), T.StructField("n", T.LongType())])
    return T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("n_ids", T.LongType()), T.StructField("documents", T.ArrayType(document)),
        T.StructField("words", T.BinaryType()), T.StructField("word_counts", T.ArrayType(T.IntegerType())), T.StructField("states", T.BinaryType()), T.StructField("word_crc32", T.ArrayType(T.LongType())),
        T.StructField("ids_crc32", T.LongType()),
    ])


def _rows(model: rans.Model, ready: list[tuple[list, list[np.ndarray]]], part: int, block: int, at: int, key: pa.DataType) -> pa.RecordBatch:
    """Block rows of (keys, ids) lists."""
    plain = [np.concatenate(ids).astype(PACKED) for _, ids in ready]
    coded = rans.encode(model, [model.symbols(x) for x in plain])
    sizes = [len(x) for x in plain]
    words = [[w.astype("<u4").tobytes() for w in c.words] for c in coded]
    counts = [[len(x) for x in ids] for _, ids in ready]
    documents = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, counts)]), pa.int32()),
        pa.StructArray.from_arrays([pa.array([k for keys, _ in ready for k in keys], key), pa.array([n for x in counts for n in x], pa.int64())], ["key", "n"]))
    return pa.RecordBatch.from_arrays([
        pa.array([part] * len(ready), pa.int32()), pa.array(range(block, block + len(ready)), pa.int32()), pa.array(at + np.cumsum([0, *sizes[:-1]]), pa.int64()), pa.array(sizes, pa.int64()), documents,
        pa.array([b"".join(x) for x in words], pa.binary()), pa.array([[len(w) // 4 for w in x] for x in words], pa.list_(pa.int32())), pa.array([c.states.astype("<u8").tobytes() for c in coded], pa.binary()),
        pa.array([[zlib.crc32(w) for w in x] for x in words], pa.list_(pa.int64())), pa.array([zlib.crc32(x.tobytes()) for x in plain], pa.int64()),
    ], ["part", "block", "at", "n_ids", "documents", "words", "word_counts", "states", "word_crc32", "ids_crc32"])


def _blocks(model: rans.Model, kind: str):
    """A task's documents, in order, as blocks. kind: the type of their packed ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, at = TaskContext.get().partitionId(), 0, 0
        keys, ids, have, ready, of = [], [], 0, [], pa.null()
        for batch in batches:
            of = batch.column("key").type
            for key, own in zip(batch.column("key").to_pylist(), batch.column("ids"), strict=True):
                keys.append(key)
                ids.append(np.frombuffer(own.as_py(), kind))
                have += len(ids[-1])
                if have >= BLOCK:
                    ready.append((keys, ids))
                    keys, ids, have = [], [], 0
                if len(ready) == AT_ONCE or ready and len(ready[-1][1][-1]) > 16 * BLOCK:
                    yield (out := _rows(model, ready, part, block, at, of))
                    block, at, ready = block + len(ready), at + sum(out.column("n_ids").to_pylist()), []
        if keys:
            ready.append((keys, ids))
        if ready:
            yield _rows(model, ready, part, block, at, of)

    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str, key: str = "doc_id", end: int = 1, text: str = "text") -> None:
    """Write the token ids of each text, and `end` behind each, into a new folder."""
    spark = docs.sparkSession
    made = written(packed(docs, tokenizer, key, end, text))
    coded = made.filter("not counts").drop("counts")
    counts = made.filter("counts").select("ids").mapInArrow(_counted, COUNT).groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toPandas()  # a row an id of the vocabulary
    freq = rans.frequencies(counts["n"].to_numpy())
    spark.createDataFrame([(int(i), int(f)) for i, f in zip(counts["id"], freq, strict=True)], "id int, freq int").coalesce(1).write.parquet(f"{path}/frequencies")
    spark.createDataFrame([(VERSION, rans.LANES, rans.CHECK, rans.SCALE)], "version int, lanes int, check int, scale int").coalesce(1).write.parquet(f"{path}/format")
    model = rans.Model.of(counts["id"].to_numpy(np.int64), freq)
    order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("tie")]
    tied = coded.withColumns({"digest": F.xxhash64("ids"), "tie": F.monotonically_increasing_id()})  # rows of one key may be many: they are dealt too
    dealt = tied.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    schema = _block_schema(coded.schema["key"].dataType)
    dealt.select("key", "ids").mapInArrow(_blocks(model, packing(tokenizer)), schema).write.parquet(f"{path}/blocks")
    parts = spark.read.schema(schema).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.size("documents")).alias("n_documents"))
    first, rows = 0, []
    for part in sorted(parts.collect()):  # a row for each task that wrote
        rows.append((part.part, first, part.n_ids, part.n_documents))
        first += part.n_ids
    spark.createDataFrame(rows, "part int, first long, n_ids long, n_documents long").coalesce(1).write.parquet(f"{path}/parts")
    forget(made)


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, rans.Model]:
    """The blocks with the place of their first id, and the shared model."""
    told = spark.read.parquet(f"{path}/format").first()
    if (told.version, told.lanes, told.check, told.scale) != (VERSION, rans.LANES, rans.CHECK, rans.SCALE):
        raise ValueError(f"unknown format {told}")
    parts = spark.read.parquet(f"{path}/parts").select("part", F.col("first").alias("_first"))
    blocks = spark.read.parquet(f"{path}/blocks").join(parts, "part").withColumn("first", F.col("_first") + F.col("at")).drop("_first")
    return blocks, _model(spark.read.parquet(f"{path}/frequencies"))


def _segments(row: dict, low: int = 0, high: int | None = None) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """What decodes segments low to high of a block, checksums tested."""
    words, states = np.frombuffer(row["words"], "<u4"), np.frombuffer(row["states"], "<u8").reshape(-1, rans.LANES)
    ends = np.cumsum([0, *row["word_counts"]])
    out = []
    for g in range(low, len(states) if high is None else high):
        own = words[ends[g] : ends[g + 1]]
        if zlib.crc32(own.tobytes()) != row["word_crc32"][g]:
            raise ValueError(f"part {row['part']}, block {row['block']}, segment {g}: the words do not match their checksum")
        out.append((own, states[g], min(rans.SEGMENT, row["n_ids"] - g * rans.SEGMENT)))
    return out


def _plain(model: rans.Model, rows: list[dict]) -> list[bytes]:
    """The packed ids of whole blocks, checksums tested. All segments of all rows are decoded side by side."""
    parts = [_segments(r) for r in rows]
    flat = iter(rans.decode(model, [s for x in parts for s in x]))
    out = []
    for row, own in zip(rows, parts, strict=True):
        ids = b"".join(model.ids[next(flat)].astype(PACKED).tobytes() for _ in own)
        if zlib.crc32(ids) != row["ids_crc32"]:
            raise ValueError(f"part {row['part']}, block {row['block']}: the ids do not match their checksum")
        out.append(ids)
    return out


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows, some at a time: AT_ONCE usual blocks or one long one."""
    for batch in batches:
        held, have = [], 0
        for k in range(len(batch)):
            held.append({name: batch.column(j)[k].as_py() for j, name in enumerate(batch.schema.names)})
            have += held[-1]["n_ids"]
            if have >= AT_ONCE * BLOCK:
                yield held
                held, have = [], 0
        if held:
            yield held


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids): a row for each document; ids holds four little-endian bytes an id. A damaged block is an error."""
    blocks, model = _opened(spark, path)
    kind = blocks.schema["documents"].dataType.elementType["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _few(batches):
            keys, starts, sizes, ids = [], [], [], []
            for row, plain in zip(rows, _plain(model, rows), strict=True):
                own = [d["n"] for d in row["documents"]]
                edges = np.cumsum([0, *own])
                keys += [d["key"] for d in row["documents"]]
                starts += (row["first"] + edges[:-1]).tolist()
                sizes += own
                ids += [plain[4 * a : 4 * b] for a, b in zip(edges, edges[1:], strict=False)]
            field = out_schema.field("key")
            yield pa.RecordBatch.from_arrays([pa.array(keys, field.type), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())], ["key", "start", "n_tokens", "ids"])

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("key", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    out_schema = to_arrow_schema(schema)
    return blocks.mapInArrow(run, schema).withColumnRenamed("key", key)


def read_window(spark: SparkSession, path: str, start: int, count: int) -> DataFrame:
    """(position, id): the ids at positions start to start + count of the whole stream. Only the segments that hold them are decoded."""
    blocks, model = _opened(spark, path)
    blocks = blocks.filter((F.col("first") < start + count) & (F.col("first") + F.col("n_ids") > start)).drop("documents")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _few(batches):
            for row in rows:
                low, high = max(0, start - row["first"]), min(row["n_ids"], start + count - row["first"])
                g = low // rans.SEGMENT
                ids = model.ids[np.concatenate(rans.decode(model, _segments(row, g, -(-high // rans.SEGMENT))))][low - g * rans.SEGMENT : high - g * rans.SEGMENT]
                yield pa.RecordBatch.from_arrays([pa.array(row["first"] + np.arange(low, high), pa.int64()), pa.array(ids, pa.int32())], ["position", "id"])

    return blocks.mapInArrow(run, "position long, id int")


def new_folder(spark: SparkSession) -> str:
    """A path for a new folder of token files in the shared folder."""
    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
