"""Near copies by the Jaccard similarity of word shingles: SimHash fingerprints and MinHash bands propose, exact similarity decides.

A text is the set of its shingles of `shingle` words (words as in simhash, ASCII case folded; fewer words are one shingle). Texts
with the same words in the same order are one node, so groups of exact copies cost one row however large. Two sources propose pairs:

* SimHash: a node's fingerprint over its shingles, repeats included. simhash's vantage-point trees find all fingerprints within REACH bits; what they connect is one bucket. REACH is the
  largest radius at which one of the four quarters is within 1 bit still, so it costs the trees no more than 4 bits do.
* MinHash, for pairs up to the bound whose fingerprints lie further apart: BANDS bands of ROWS minima each, a bucket a band; two nodes of similarity s share no band
  with probability (1 - s^ROWS)^BANDS, 3e-6 at 0.8.

Each pair of nodes that share a bucket is linked if its exact similarity reaches the bound, unless links in its bucket already connect it. No bucket is capped; buckets with equal members are
searched once, and in larger ones bitmaps rule out pairs whose exact similarity can't reach the bound. Components come from the rounds of hooking and pointer jumping in simhash.

Null texts are empty texts, which are near copies of each other alone. Null doc_ids take part as links, are never the smallest id, and get
their component's id (null if it has none). Every input row gives a row. `keep_one` keeps one row of each component, as in simhash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, looked_up, spread, written
from .simhash import FIRST, LOWER, Links, _roots, components, digest, fingerprint_links, firsts, forest, majority, one_each, rooted

BANDS, ROWS, BLOCK = 24, 4, 4096
REACH = 7
#: Buckets of more sets get bitmaps.
FEW = 16
_RNG = np.random.default_rng(17)
# Multipliers (odd) and offsets of the permutations.
_TIMES = _RNG.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: bytes, shingle: int = 5, seed: int = 42) -> tuple[int, np.ndarray]:
    """(node, XXH64 hashes of the word shingles, repeats included); equal word lists have equal nodes."""
    import xxhash

    words = text.translate(LOWER).split()
    one = xxhash.xxh64_intdigest
    node = one(b" ".join(words), seed + 1)
    if not words:
        return node, np.zeros(0, dtype=np.uint64)
    grams = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
    return node, np.array([one(g, seed) for g in grams], dtype=np.uint64)


def bands(grams: np.ndarray) -> list[int]:
    """A key for each band, none for an empty text."""
    import xxhash

    if not len(grams):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(grams), BLOCK):  # bounded memory for any length
        least = np.minimum(least, (grams[None, low : low + BLOCK] * _TIMES + _PLUS).min(axis=1))
    return [xxhash.xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)]


def bitmaps(grams: list[np.ndarray], width: int) -> np.ndarray:
    """A row of width bits (a power of two) for each set: those named by its members' low bits."""
    out = np.zeros((len(grams), width // 64), dtype=np.uint64)
    for k, g in enumerate(grams):
        row = np.zeros(width, dtype=bool)
        row[(g & np.uint64(width - 1)).astype(np.int64)] = True
        out[k] = np.packbits(row).view(np.uint64)
    return out


def bucket_links(grams: list[np.ndarray], similarity: float) -> np.ndarray:
    """Smallest row of each row's component, where pairs of sorted sets with at least this Jaccard similarity are linked. In a larger bucket bitmaps rule out most
    other pairs: a bit that only one of two sets has stands for a member that only it has, so their common members are at most its size less such bits."""
    n = len(grams)
    size = np.array([len(g) for g in grams])
    links = Links(n)
    bits = ones = None
    if n > FEW:
        bits = bitmaps(grams, 1 << min(16, max(6, int(8 * size.mean()).bit_length())))
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    for k in range(n - 1):
        root = links.parent = _roots(links.parent)
        if not root.any():
            break
        others = np.arange(k + 1, n)
        others = others[root[k + 1 :] != root[k]]
        others = others[np.minimum(size[others], size[k]) >= similarity * np.maximum(size[others], size[k]) - 1e-9]
        if bits is not None and len(others):
            both = np.concatenate([np.bitwise_count(bits[some] & bits[k]).sum(axis=1, dtype=np.int64) for some in np.array_split(others, -(-len(others) // FEW**2))])
            most = np.minimum(size[k] - ones[k], size[others] - ones[others]) + both
            others = others[most >= similarity * (size[others] + size[k] - most) - 1e-9]
        if not len(others):
            continue
        flat = np.concatenate([grams[j] for j in others])
        at = np.minimum(np.searchsorted(grams[k], flat), size[k] - 1)
        common = np.add.reduceat(grams[k][at] == flat, np.concatenate([[0], np.cumsum(size[others])[:-1]]), dtype=np.int64)
        near = others[common >= similarity * (size[others] + size[k] - common) - 1e-9]
        links.add(np.full(len(near), k), near)
    return _roots(links.parent)


def _each(docs: DataFrame, text: str, of, fields: dict[str, T.DataType]) -> DataFrame:
    """docs with the text replaced by the columns that of(text) returns, unsigned numbers or lists of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            kept = [k for k in range(batch.num_columns) if k != at]
            for low in range(0, batch.num_rows, 256):  # lists are many times as large as keys: small pieces bound a worker's memory
                part = batch.slice(low, 256)
                rows = [of(x.as_py() or b"") for x in part.column(at).cast(pa.large_binary())]
                columns = []
                for values, kind in zip(zip(*rows, strict=True), fields.values(), strict=True):
                    if isinstance(kind, T.ArrayType):
                        columns.append(pa.array([np.asarray(v, dtype=np.uint64).view(np.int64) for v in values], type=pa.list_(pa.int64())))
                    else:
                        columns.append(pa.array(np.array(values, dtype=np.uint64).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in kept], *columns], names=[*[part.schema.names[k] for k in kept], *fields])

    out = T.StructType([f for f in docs.schema if f.name != text])
    for name, kind in fields.items():
        out = out.add(name, kind)
    return docs.mapInArrow(run, out)


def fingerprint_buckets(nodes: DataFrame, reach: int = REACH) -> DataFrame:
    """(bucket, node): a bucket for all nodes (node long, fp long) whose fingerprints steps of at most reach bits connect."""
    fps = written(nodes.select("fp").distinct())
    links = fingerprint_links(fps, reach)
    roots = components(links)
    # different texts may share a fingerprint without being near any other
    out = looked_up(nodes.select("node", "fp"), "fp", roots.select(F.col("node").alias("fp"), "root"), "root")
    out = written(out.select(F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("bucket"), "node"))
    forget(fps, links, roots)
    return out


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """(key, component_id, kept, mark), for every row of docs: the smallest key of the documents that pairs of at least this similarity connect, whether the
    row is the component's first, as in simhash, and its digest."""
    longs = T.ArrayType(T.LongType())
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), digest(key, text).alias("mark"))

    def sign(x: bytes) -> tuple[int, int, list[int]]:
        node, grams = shingles(x, shingle)
        return node, majority(grams), bands(np.unique(grams))

    def members_of(x: bytes) -> tuple[int, np.ndarray]:
        node, grams = shingles(x, shingle)
        return node, np.unique(grams)

    marked = written(_each(docs, "text", sign, {"node": T.LongType(), "fp": T.LongType(), "bands": longs}))
    nodes = written(firsts(marked, "key", "node", "mark", "fp", "bands"))
    # the empty text is near itself alone
    near = fingerprint_buckets(nodes.filter(F.size("bands") > 0))
    rows = nodes.select(F.explode("bands").alias("bucket"), "node").unionByName(near)
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y")).filter("n > 1")
    shared = written(shared.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket"))
    members = written(rows.join(shared, "bucket").select("bucket", "node"))

    # the sets of the nodes in question, from one document each
    asked = written(members.select("node").distinct().join(nodes.select("node", "mark"), "node"))
    picked = docs.join(asked.select("mark"), "mark", "left_semi")
    sets = written(_each(picked.select("text"), "text", members_of, {"node": T.LongType(), "grams": longs}).dropDuplicates(["node"]))

    def link(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        node = part.node.to_numpy()
        a, b = forest(bucket_links([np.ascontiguousarray(g, dtype=np.int64).view(np.uint64) for g in part.grams], similarity))
        return pd.DataFrame({"a": node[a], "b": node[b]})

    pairs = written(spread(members.join(sets, "node"), "bucket").groupBy("bucket").applyInPandas(link, "a long, b long").distinct())
    ids = rooted(nodes.drop("fp", "bands"), pairs, FIRST).select(F.col("node").alias("at"), "of")
    forget(nodes, near, shared, members, asked, sets, pairs)
    # groups of copies make one node hot on the left; the right has it once, so the join can be split
    out = marked.join(ids, F.col("node") == F.col("at"))
    return out.select(F.col("key").alias(key), F.col("of.first").alias("component_id"), (F.col("mark") == F.col("of.mark")).alias("kept"), "mark")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """The first row of each component of docs, as simhash.keep_one."""
    return one_each(docs, near_copies(docs, key, text, similarity, shingle).filter("kept").select("mark"), key, text)
