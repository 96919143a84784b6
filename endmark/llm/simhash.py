"""SimHash near-duplicates: vantage-point trees over fingerprints, sharded by Hamming distance.

Fingerprints of 64 bits that differ in at most `radius` bits are linked; a component's id is the smallest
doc_id that links reach. Equal fingerprints are one node, so groups of copies cost one row however large.

Candidate pairs come from vantage-point trees. Hamming distances between whole fingerprints crowd around
32, where bounds prune little, so the fingerprint is read as four quarters of 16 bits. Two fingerprints
within 4 bits are within 1 bit on at least one quarter (in general radius // 4), and each quarter's
distance is a metric with its own tree. The upper levels of a tree are built from a bounded sample and cut
the quarter's space into shards: a node sends a fingerprint inside its vantage point's median distance to
the inner side and any other to the outer side. One inside, but so near the boundary that the triangle
inequality allows a partner outside, also visits the outer side, and a visitor visits each side that can hold a
partner; so every pair meets in the shard where one of the two is at home. In a shard a
local tree over the different quarter values is searched in the same way; its leaves name the values near each other, and
the rows of these are compared on all 64 bits. Within a shard links are merged at once and only a spanning forest leaves it. Rows at home are
counted by shard; a crowded shard (equal quarters can't be split) is dealt again by the trees of the other quarters, on one
of which its pairs are near too, and so on until shards are small or all quarters are named. Visitors don't count: they grow with the number of shards
(on 16 bits a row visits 2 of 48 and 5 of 236), so dealing again for their sake would multiply them. Shards take large shares for the same reason, and what
goes to a shard is packed, many fingerprints a row.

Components over the whole corpus come from rounds of hooking and pointer jumping on DataFrames; each
round is a written table. Nothing but a count and the sample reaches the driver.

Null texts are empty texts; texts without words have fingerprint zero and link like others. Null doc_ids
take part as links, are never the smallest id, and get their component's id (null if it has none). Every input row gives a row.
`keep_one` keeps one row of each component: the one with the smallest key (null last), of several the least by digest of key and text; which
of rows equal in both but not in other columns is not defined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, fresh, looked_up, spread, written

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
QUARTERS = 4
#: Rows that the upper trees are built from, rows at home wished for in a shard, most shards of a tree, values of a local tree's leaves, pairs compared or
#: linked at once, rows dealt at once.
SAMPLE, SHARD, SHARDS, LEAF, BLOCK, DEAL = 20_000, 60_000, 1024, 128, 1 << 18, 100_000
#: A shard of over CROWD times the rows wished for is dealt again by the other quarters. WAYS: links of a row in the forest a shard returns, about.
CROWD, WAYS = 4, 16


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Bits set in over half of the XXH64 hashes of the text's word shingles, repeats included."""
    import xxhash

    words = text.translate(LOWER).split()  # bytes split at exactly U+0020 and U+0009 to U+000D
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
    one = xxhash.xxh64_intdigest
    return majority(np.array([one(g, seed) for g in grams], dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; zero of none."""
    ones = np.zeros(64, dtype=np.int64)
    for low in range(0, len(hashes), 65536):  # bounded memory for any length
        bits = np.unpackbits(hashes[low : low + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = 4) -> DataFrame:
    """docs without the text, with its fingerprint as a long of the same 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column = batch.column(at).cast(pa.large_binary())
            fps = np.array([fingerprint(x.as_py() or b"", shingle) for x in column], dtype=np.uint64).view(np.int64)
            kept = [k for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], pa.array(fps)], schema=pa.schema([*[batch.schema.field(k) for k in kept], pa.field(out, pa.int64())]))

    return docs.mapInArrow(run, T.StructType([f for f in docs.schema if f.name != text]).add(out, T.LongType()))


def _away(values: np.ndarray, vantage: int) -> np.ndarray:
    return np.bitwise_count(values ^ np.uint16(vantage)).astype(np.int8)


def _vantage(values: np.ndarray, rng: np.random.Generator) -> tuple[int, int] | None:
    """A vantage point and boundary (inside: distance <= boundary) that leave the fewest on the larger side and the shell; None if nothing splits."""
    best = None
    for v in rng.choice(values, size=min(8, len(values)), replace=False):
        away = np.bincount(_away(values, v), minlength=17)
        inside = np.cumsum(away)
        for b in range(16):
            if 0 < inside[b] < len(values):
                cost = max(inside[b], len(values) - inside[b]) + 0.5 * away[b]
                if best is None or cost < best[0]:
                    best = (cost, int(v), b)
    return best and best[1:]


class Tree:
    """The upper levels of a quarter's tree: nodes (vantage, boundary, inner child, outer child), children below zero being shards -1 - k."""

    def __init__(self, sample: np.ndarray, shards: int, seed: int):
        rng = np.random.default_rng(seed)
        self.nodes: list[list[int]] = []
        self.shards = 0
        todo = [(np.asarray(sample, dtype=np.uint16), shards, None)]
        while todo:
            values, want, at = todo.pop()
            split = _vantage(values, rng) if want > 1 and len(values) > 1 else None
            if split is None:
                self._join(at, -1 - self.shards)
                self.shards += 1
                continue
            self.nodes.append([*split, 0, 0])
            self._join(at, k := len(self.nodes) - 1)
            inside = _away(values, split[0]) <= split[1]
            inner = min(want - 1, max(1, round(want * inside.mean())))
            todo += [(values[inside], inner, (k, 2)), (values[~inside], want - inner, (k, 3))]

    def _join(self, at: tuple[int, int] | None, child: int) -> None:
        if at:
            self.nodes[at[0]][at[1]] = child

    def route(self, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, rows at home, rows visiting) for all shards that get any."""
        rows = np.arange(len(values))
        todo = [(0 if self.nodes else -1, rows, rows[:0])]
        while todo:
            at, home, visits = todo.pop()
            if not len(home) and not len(visits):
                continue
            if at < 0:
                yield -1 - at, home, visits
                continue
            vantage, b, inner, outer = self.nodes[at]
            own, seen = _away(values[home], vantage), _away(values[visits], vantage)
            shell = home[(own <= b) & (own > b - radius)]
            todo.append((inner, home[own <= b], visits[seen <= b + radius]))
            todo.append((outer, home[own > b], np.concatenate([visits[seen > b - radius], shell])))


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


class Links:
    """Union of rows; a root is the smallest of its rows."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            self.parent = _roots(self.parent)
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if len(a):
                np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def shard_links(fps: np.ndarray, quarter: np.ndarray, home: np.ndarray, radius: int, near: int, links: Links) -> None:
    """Link all pairs of rows within `near` on the quarter and `radius` on the whole, one of them at home: a local vantage-point tree over the quarter's
    different values, whose leaves name the values within `near` of each other; the rows of these are compared on all bits."""
    rng = np.random.default_rng(len(fps))
    order = np.lexsort((~home, quarter))  # a value's rows at home come first
    fps = fps[order]
    values, first, count = np.unique(quarter[order], return_index=True, return_counts=True)
    own = np.add.reduceat(home[order], first, dtype=np.int64) if len(first) else first
    found: list[np.ndarray] = []

    def flush() -> None:
        if found:
            links.add(*order[np.concatenate(found, axis=1)])
            found.clear()

    todo, held = [(np.flatnonzero(own), np.arange(len(values)))], 0
    while todo:
        members, asking = todo.pop()
        if not len(members) or not len(asking):
            continue
        split = _vantage(values[members], rng) if len(members) > LEAF else None
        if split is None:
            close = np.bitwise_count(values[members][:, None] ^ values[asking][None, :]) <= near
            for m, there in zip(members, close, strict=True):
                to = asking[there]
                n = count[to]
                rows = np.arange(n.sum()) + np.repeat(first[to] - np.cumsum(n) + n, n)
                end, step = first[m] + own[m], max(1, BLOCK // len(rows))
                for low in range(first[m], end, step):
                    for at in range(0, len(rows), BLOCK):
                        some = rows[at : at + BLOCK]
                        a, b = np.nonzero(np.bitwise_count(fps[low : min(low + step, end)][:, None] ^ fps[some][None, :]) <= radius)
                        a, b = a + low, some[b]
                        apart = a != b
                        if apart.any():
                            found.append(np.stack([a[apart], b[apart]]))
                            held += found[-1].shape[1]
                            if held > BLOCK:  # not more often: a union passes over all rows
                                flush()
                                held = 0
            continue
        vantage, b = split
        mine, seen = _away(values[members], vantage), _away(values[asking], vantage)
        todo.append((members[mine <= b], asking[seen <= b + near]))
        todo.append((members[mine > b], asking[seen > b - near]))
    flush()


def fingerprint_links(nodes: DataFrame, radius: int = 4, shard: int = SHARD) -> DataFrame:
    """(a long, b long): links that connect all fingerprints of nodes (distinct longs in fp) that pairs within radius connect; a < b as unsigned numbers."""
    n = nodes.count()
    sample = nodes.sample(min(1.0, SAMPLE / max(n, 1)), seed=1).limit(2 * SAMPLE).collect()  # the limit is a guard: about SAMPLE rows are expected
    quarters = np.array([r.fp for r in sample], dtype=np.int64).view(np.uint64).view(np.uint16).reshape(-1, QUARTERS)

    def deal(near: int, most: int):
        """most: rows to be dealt of one key."""
        trees = [Tree(quarters[:, q], min(SHARDS, max(16, -(-most // shard))), q) for q in range(QUARTERS)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """By every quarter that a row's key doesn't name yet; a key is the quarters and shards so far, q:shard/. What goes to a shard from a batch is one row or two."""
            for batch in batches:
                for key in batch.column(0).unique().to_pylist():
                    part = batch.column(1).filter(pc.equal(batch.column(0), key))
                    fps = part.to_numpy() if pa.types.is_int64(part.type) else np.frombuffer(b"".join(part.to_pylist()), dtype=np.int64)
                    for low in range(0, len(fps), DEAL):
                        some = fps[low : low + DEAL]
                        own = some.view(np.uint64).view(np.uint16).reshape(-1, QUARTERS)
                        for q, tree in enumerate(trees):
                            if f"{q}:" in key:
                                continue
                            out = [(f"{key}{q}:{at}/", here, some[rows].tobytes()) for at, *sides in tree.route(np.ascontiguousarray(own[:, q]), near) for here, rows in zip((True, False), sides, strict=True) if len(rows)]
                            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.string(), pa.bool_(), pa.binary()), strict=True)], names=["shard", "home", "fps"])

        return run

    def join(part: pd.DataFrame) -> pd.DataFrame:
        fps = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in part.fps])
        home = np.repeat(part.home.to_numpy(dtype=bool), part.fps.str.len() // 8)
        order = np.argsort(fps)
        fps, home = fps[order], home[order]
        key = part["shard"].iloc[0].rstrip("/").split("/")
        q, near = int(key[-1].split(":")[0]), radius // (QUARTERS + 1 - len(key))
        links = Links(len(fps))
        shard_links(fps, np.ascontiguousarray(fps.view(np.uint16).reshape(-1, QUARTERS)[:, q]), home, radius, near, links)
        a, b = forest(_roots(links.parent))
        whole = fps.view(np.int64)
        return pd.DataFrame({"a": whole[a], "b": whole[b]})

    todo, links, tables, most = nodes.select(F.lit("").alias("shard"), "fp"), None, [], n
    for level in range(QUARTERS):
        dealt = written(todo.mapInArrow(deal(radius // (QUARTERS - level), most), "shard string, home boolean, fps binary"))
        tables.append(dealt)
        big = None
        if level < QUARTERS - 1:
            # visitors don't make a shard crowded: finer shards would have more of them
            rows = F.octet_length("fps") / 8
            counts = dealt.groupBy("shard").agg(F.sum(rows).alias("n"), F.sum(F.when(F.col("home"), rows)).alias("own")).filter(F.col("own") > CROWD * shard)
            big = written(counts.select("shard", "n"))
            tables.append(big)
            most = int(big.agg(F.max("n")).first()[0] or 0)
            if not most:
                big = None
        few = dealt if big is None else dealt.join(big, "shard", "left_anti")
        found = written(spread(few, "shard").groupBy("shard").applyInPandas(join, "a long, b long"))
        tables.append(found)
        links = found if links is None else links.unionByName(found)
        if big is None:
            break
        # pairs of a crowded shard are near on one of the other quarters too, one of the two at home there
        todo = dealt.join(big, "shard", "left_semi").select("shard", "fps")
    out = written(links.distinct())
    forget(*tables)
    return out


def forest(roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b), a < b, that connect rows of equal root: each row to the one WAYS times nearer its component's start, so that no row has many."""
    order = np.argsort(roots, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(roots[order]) != 0]) if len(order) else order
    start = np.repeat(first, np.diff(np.r_[first, len(order)]))
    place = np.arange(len(order)) - start
    linked = np.flatnonzero(place > 0)
    return order[start[linked] + (place[linked] - 1) // WAYS], order[linked]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node (signed) reached. Hooking to the smallest
    neighbouring root and pointer jumping, one written table a round; the rounds grow with the logarithm of a path."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")).select("node", "root"))
    while True:
        # the smallest root next to each root, its own included
        far = both.join(label.select(F.col("node").alias("b"), F.col("root").alias("far")), "b").select("a", "far")
        near = far.join(label.select(F.col("node").alias("a"), "root"), "a")
        hooks = near.filter("far < root").groupBy("root").agg(F.min("far").alias("hook"))
        new = written(looked_up(label, "root", hooks, "hook").select("node", F.coalesce("hook", "root").alias("root")))
        # only roots that others name are looked up
        ups = new.select("root").distinct().join(new.select(F.col("node").alias("root"), F.col("root").alias("up")), "root").filter("up < root")
        jumped = written(looked_up(new, "root", ups, "up").select("node", F.coalesce("up", "root").alias("root")))
        changed = not jumped.join(label.withColumnRenamed("root", "old"), "node").filter("root != old").isEmpty()
        forget(label, new)
        label = jumped
        if not changed:
            forget(both)
            return label


def rooted(nodes: DataFrame, links: DataFrame, least: tuple[str, ...]) -> DataFrame:
    """nodes (node long, and the columns of least) with, for each of these, the smallest struct of them in a node's component as `of`."""
    own = F.struct(*least)
    roots = components(links)
    named = nodes.join(roots, "node", "left")
    linked = named.filter("root is not null").select("node", "root", own.alias("own"))
    firsts = linked.groupBy("root").agg(F.min("own").alias("of"))
    of = looked_up(linked.select("node", "root"), "root", firsts, "of").select("node", "of")
    out = written(named.filter("root is null").select("node", own.alias("of")).unionByName(of))
    forget(roots)
    return out


def digest(key: str, text: str) -> Column:
    """What tells a row from others of another key or text."""
    name = F.col(key).cast("string")
    return F.md5(F.concat(F.coalesce(F.concat(F.char_length(name).cast("string"), F.lit(":"), name), F.lit("-:")), F.coalesce(F.col(text), F.lit(""))))


#: A component's first row has the smallest key, null last, then the smallest digest.
FIRST = ("unnamed", "first", "mark")


def firsts(marked: DataFrame, key: str, node: str, mark: str, *also: str) -> DataFrame:
    """(node, unnamed, first, mark) of each node's first row, with the columns of also, which are equal in a node."""
    own = F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("first"), F.col(mark).alias("mark"))
    return marked.groupBy(F.col(node).alias("node")).agg(F.min(own).alias("own"), *[F.any_value(c).alias(c) for c in also]).select("node", "own.*", *also)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 4, shingle: int = 4) -> DataFrame:
    """docs without the text, with fp (long) and component_id: the smallest key of the documents that links reach; and `kept`: whether the row is the
    component's first (rows equal in key and text are all first)."""
    fp, mark, node, of = fresh(docs, "fp", "mark", "node", "of")
    docs = docs.drop(*[c for c in ("fp", "component_id", "kept") if c not in (key, text)])
    marked = written(fingerprints(docs.withColumn(mark, digest(key, text)), text, fp, shingle))
    nodes = written(firsts(marked, key, fp, mark))
    links = fingerprint_links(nodes.select(F.col("node").alias("fp")), radius)
    ids = rooted(nodes, links, FIRST).select(F.col("node").alias(node), F.col("of").alias(of))
    forget(nodes, links)
    # groups of copies make one fingerprint hot on the left; the right has it once, so the join can be split
    out = marked.join(ids, F.col(fp) == F.col(node)).withColumns({"component_id": F.col(of)["first"], "kept": F.col(mark) == F.col(of)["mark"]})
    return out.drop(node, of, mark).withColumnsRenamed({fp: "fp"})


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 4, shingle: int = 4) -> DataFrame:
    """The first row of each component of docs. Different documents of one key are told apart by their texts."""
    return one_each(docs, near_duplicates(docs.select(key, text).withColumn("__mark", digest(key, text)), key, text, radius, shingle).filter("kept").select("__mark"), key, text)


def one_each(docs: DataFrame, kept: DataFrame, key: str, text: str) -> DataFrame:
    """One row of docs for each digest in kept (one column), with all its columns."""
    mark, one, nth = fresh(docs, "mark", "one", "nth")
    kept = written(kept.toDF(one).distinct())
    named = docs.withColumn(mark, digest(key, text)).join(kept, F.col(mark) == F.col(one), "left_semi")
    return named.withColumn(nth, F.row_number().over(Window.partitionBy(mark).orderBy(F.lit(1)))).filter(F.col(nth) == 1).drop(mark, nth)
