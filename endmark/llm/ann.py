"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Each vector is projected on a few Gaussian directions. For two vectors at distance d the squared distance of
their projections is d^2 times a chi-square variable with as many degrees of freedom as there are directions. A kd-tree over
the projections yields rows in the order of their projected distance, nearest boxes first; each is verified by
its true distance, until the projected distance reached, squared, exceeds `confidence`'s chi-square quantile
times the squared distance of the k-th best found: a true neighbour not seen yet has at most probability 1 - confidence.

The upper levels of the kd-tree come from a bounded sample and deal all rows into shards by their projected place. A query
first searches its own shard; with the k-th best distance found there it goes on to the shards whose boxes the stopping test doesn't
rule out, and that distance is the test's first bound in each of them. Shards are counted: one with more rows than fit a
task (equal vectors can't be split by place) is dealt by the digest of the id, and where many queries meet a shard they come in blocks.
All rows are indexed. Distances are Euclidean in double precision on the original vectors.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows with a null id; only
vectors of the query's length are compared (lengths are to be few). A query's own id is never its neighbour; queries equal in id and vector count once.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, spread, written

DIRECTIONS, CONFIDENCE, LEAF = 10, 0.95, 64
#: Rows that the upper tree of a vector length is built from, rows wished for in a shard, most shards of a length, queries of a block.
SAMPLE, SHARD, SHARDS, QUERIES = 20_000, 16_384, 4096, 2048


def chi_square_cdf(x: float, m: int) -> float:
    """For an even number m of degrees of freedom."""
    term = total = math.exp(-x / 2)
    for j in range(1, m // 2):
        term *= x / 2 / j
        total += term
    return 1 - total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, m) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, m) < p else (low, mid)
    return high


def directions(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, m]).standard_normal((dim, m))


def _slack(point: np.ndarray) -> float:
    """What rounding may add to the squared distance of equal projections."""
    return 1e-18 * (1 + float(point @ point))


class KdTree:
    """Median splits on the widest side into at most `most` leaves (fewer where `leaf` rows or equal points are left). A node is (low, high, left, right,
    from, to): its box, its children (-1 for a leaf) and the places of its points in `rows`."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, most: int | None = None):
        self.rows = np.arange(len(points))
        self.left, self.right, self.start, self.end, boxes = [], [], [], [], []
        self.cut: dict[int, tuple[int, float]] = {}
        todo = [(0, len(points), most or len(points), None)]
        while todo:
            a, b, want, of = todo.pop()
            if of is not None:
                (self.left if of[1] else self.right)[of[0]] = len(boxes)
            own = self.rows[a:b]
            low, high = (points[own].min(axis=0), points[own].max(axis=0)) if b > a else (np.full(points.shape[1], np.inf),) * 2
            at = len(boxes)
            boxes.append((low, high))
            self.left.append(-1)
            self.right.append(-1)
            self.start.append(a)
            self.end.append(b)
            if b - a <= leaf or want < 2 or not (high - low).max() > 0:
                continue
            side, mid = int((high - low).argmax()), (a + b) // 2
            order = np.argpartition(points[own, side], mid - a)
            self.rows[a:b] = own[order]
            self.cut[at] = (side, float(points[self.rows[mid], side]))
            todo += [(mid, b, want - want // 2, (at, False)), (a, mid, want // 2, (at, True))]
        self.low, self.high = np.array([x for x, _ in boxes]), np.array([x for _, x in boxes])

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf (node number) on whose side of all cuts each point lies."""
        out, todo = np.zeros(len(points), dtype=np.int64), [(0, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            if at not in self.cut or not len(rows):
                out[rows] = at
                continue
            side, value = self.cut[at]
            inner = points[rows, side] < value
            todo += [(self.left[at], rows[inner]), (self.right[at], rows[~inner])]
        return out

    def away(self, point: np.ndarray, nodes: list[int] | np.ndarray) -> np.ndarray:
        """Squared distance of the nodes' boxes."""
        gap = np.maximum(np.maximum(self.low[nodes] - point, point - self.high[nodes]), 0.0)
        return (gap * gap).sum(axis=1)

    def nearest(self, point: np.ndarray, at_once: int = 8) -> Iterator[tuple[float, np.ndarray]]:
        """(bound, places of points) a few leaves at a time, nearest boxes first; no point still to come lies nearer than bound, squared."""
        heap = [(0.0, 0)]
        found: list[np.ndarray] = []
        while heap:
            _, at = heapq.heappop(heap)
            if self.left[at] < 0:
                found.append(np.arange(self.start[at], self.end[at]))
            else:
                both = [self.left[at], self.right[at]]
                for bound, node in zip(self.away(point, both).tolist(), both, strict=True):
                    heapq.heappush(heap, (bound, node))
            if len(found) == at_once or (found and not heap):
                yield (heap[0][0] if heap else math.inf), np.concatenate(found)
                found = []


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, confidence: float, seed: int, m: int = DIRECTIONS,
           within: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """For each query: its id, the ids of its k nearest found, their distances, and how many vectors were verified; ties to smaller ids.
    within: distances beyond which nothing is wanted."""
    onto = directions(vectors.shape[1], m, seed)
    points = vectors @ onto
    tree, enough = KdTree(points), chi_square_quantile(confidence, m)
    ids, vectors, points = ids[tree.rows], vectors[tree.rows], points[tree.rows]  # leaves lie together
    within = np.full(len(queries), np.inf) if within is None else within
    for own, query, point, most in zip(query_ids, queries, queries @ onto, within * within * (1 + 1e-12), strict=True):
        best_d, best_id = np.zeros(0), np.zeros(0, dtype=np.int64)
        wait_at, wait_d, seen, slack = np.zeros(0, dtype=np.int64), np.zeros(0), 0, _slack(point)
        for bound, places in tree.nearest(point):
            gap = points[places] - point
            wait_at, wait_d = np.concatenate([wait_at, places]), np.concatenate([wait_d, np.einsum("ij,ij->i", gap, gap)])
            while True:
                limit = enough * min(most, best_d[-1] if len(best_d) >= k else math.inf) + slack
                still = wait_d <= limit  # the limit only falls
                wait_at, wait_d = wait_at[still], wait_d[still]
                due = np.flatnonzero(wait_d <= bound)
                if not len(due):
                    break
                if len(due) > LEAF:
                    due = due[np.argpartition(wait_d[due], LEAF)[:LEAF]]
                rows = wait_at[due]
                wait_at, wait_d = np.delete(wait_at, due), np.delete(wait_d, due)
                rows = rows[ids[rows] != own]
                seen += len(rows)
                away = vectors[rows] - query
                d, i = np.concatenate([best_d, np.einsum("ij,ij->i", away, away)]), np.concatenate([best_id, ids[rows]])
                first = np.lexsort((i, d))[:k]
                first = first[d[first] <= most]
                best_d, best_id = d[first], i[first]
            if bound > limit:
                break
        yield own, best_id, np.sqrt(best_d), seen


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & F.exists(vector, lambda x: x != 0) & ~F.exists(vector, bad), F.lit(False))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, confidence: float = CONFIDENCE, seed: int = 11,
                       m: int = DIRECTIONS, shard: int = SHARD, block: int = QUERIES, verified: bool = False) -> DataFrame:
    """(query_id long, rank int, vec_id long, score double): the k nearest found of each query among the rows of vectors. With verified, also how many
    true distances the query took."""
    take = lambda df: df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    rows = take(vectors)
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}  # one row a vector length
    picked = rows.sampleBy("dim", {d: min(1.0, SAMPLE / n) for d, n in sizes.items()}, seed=1)
    samples: dict[int, list] = {}
    for r in picked.limit(2 * SAMPLE * max(1, len(sizes))).toLocalIterator():  # the limit is a guard: about SAMPLE a length are expected
        samples.setdefault(r["dim"], []).append(r["v"])
    trees = {d: KdTree(np.array(v) @ directions(d, m, seed), 1, min(SHARDS, -(-sizes[d] // shard))) for d, v in samples.items()}
    trees |= {d: KdTree(np.zeros((1, m)), 1, 1) for d in sizes if d not in trees}
    enough = chi_square_quantile(confidence, m)

    def dealt(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for dim, own in part.groupby("dim"):
                if dim in trees:
                    yield own.assign(shard=trees[dim].home(np.stack(own.v.to_list()) @ directions(dim, m, seed)))

    rows = written(rows.mapInPandas(dealt, "id long, v array<double>, dim int, shard int"))
    # the boxes that hold all rows of a shard, and the parts of large ones: one row a shard, at most SHARDS for each length
    onto = {d: directions(d, m, seed) for d in sizes}

    def boxes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for (dim, at), own in part.groupby(["dim", "shard"]):
                points = np.stack(own.v.to_list()) @ onto[dim]
                yield pd.DataFrame({"dim": dim, "shard": at, "n": len(own), "side": np.arange(m), "low": points.min(axis=0), "high": points.max(axis=0)})

    held = rows.mapInPandas(boxes, "dim int, shard int, n long, side int, low double, high double").groupBy("dim", "shard", "side").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    box: dict[int, dict[int, tuple]] = {}
    for r in held.orderBy("dim", "shard", "side").collect():
        of = box.setdefault(r["dim"], {}).setdefault(r["shard"], (-(-r["n"] // (2 * shard)), [], []))
        of[1].append(r["low"])
        of[2].append(r["high"])
    known = {d: (np.array(list(x)), np.array([p for p, _, _ in x.values()]), np.array([a for _, a, _ in x.values()]), np.array([b for _, _, b in x.values()])) for d, x in box.items()}

    def visits(first: bool):
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """A row for each shard and part that a query searches: one part of the nearest box first, then what the test leaves."""
            for part in parts:
                for query, v, within in zip(part.id, part.v, part.within, strict=True):
                    if len(v) not in known:
                        continue
                    at, pieces, low, high = known[len(v)]
                    point = np.asarray(v) @ onto[len(v)]
                    gap = np.maximum(np.maximum(low - point, point - high), 0.0)
                    away = (gap * gap).sum(axis=1)
                    own = int(np.lexsort((((point - (low + high) / 2) ** 2).sum(axis=1), away))[0])
                    mine = query % int(pieces[own])
                    go = [own] if first else np.flatnonzero(away <= enough * (np.inf if np.isnan(within) else within) ** 2 + _slack(point))
                    pairs = [(x, p) for x in go for p in range(int(pieces[x])) if (x == own and p == mine) == first]
                    if pairs:
                        yield pd.DataFrame({"id": query, "v": [v] * len(pairs), "within": within, "dim": len(v), "shard": [int(at[x]) for x, _ in pairs], "part": [p for _, p in pairs]})

        return run

    pieces = F.create_map(*[F.lit(x) for d, x_ in box.items() for s_, (p, _, _) in x_.items() for x in (f"{d}:{s_}", p) if p > 1]) if any(p > 1 for x in box.values() for p, _, _ in x.values()) else None
    name = F.concat_ws(":", "dim", "shard")
    rows = rows.withColumn("part", F.lit(0) if pieces is None else F.pmod(F.xxhash64("id"), F.coalesce(pieces[name], F.lit(1))).cast("int"))
    keys = ("dim", "shard", "part", "block")

    def find(near: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        if len(near) and len(asking):
            limits = np.where(asking.within.isna(), np.inf, asking.within)
            found = search(near.id.to_numpy(), np.stack(near.v.to_list()), asking.id.to_numpy(), np.stack(asking.v.to_list()), k, confidence, seed, m, limits)
            # a last row without a score tells how many were verified
            out += [(np.full(len(i) + 1, q), np.r_[i, -1], np.r_[d, np.nan], np.r_[np.zeros(len(i), np.int64), seen]) for q, i, d, seen in found]
        q, i, d, seen = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"query_id": q, "vec_id": i, "score": d, "verified": seen, "part": int(near["shard"].iloc[0]) % 64 if len(near) else 0})

    def searched(asked: DataFrame, first: bool) -> DataFrame:
        go = written(asked.mapInPandas(visits(first), "id long, v array<double>, within double, dim int, shard int, part int"))
        asked_of = go.groupBy("dim", "shard", "part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        many = F.coalesce("blocks", F.lit(1))
        near = rows.join(asked_of, ["dim", "shard", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0), many - 1))).drop("blocks")
        own = go.join(asked_of, ["dim", "shard", "part"]).withColumn("block", F.pmod(F.xxhash64("id"), many).cast("int")).drop("blocks")
        return written(spread(near, *keys).groupBy(*keys).cogroup(spread(own, *keys).groupBy(*keys)).applyInPandas(find, "query_id long, vec_id long, score double, verified long, part int"))

    def best(found: DataFrame) -> DataFrame:
        for by in (("query_id", "part"), ("query_id",)):
            found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("score", "vec_id"))).filter(F.col("rank") <= k)
        return found

    asked = written(take(queries).distinct().withColumn("within", F.lit(float("nan"))))
    home = searched(asked, True)
    kth = best(home.filter("score is not null")).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    rest = searched(asked.join(kth, "id", "left").select("id", "v", F.coalesce("kth", "within").alias("within")), False)
    both = home.unionByName(rest)
    out = best(both.filter("score is not null")).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    if verified:
        out = out.join(both.groupBy("query_id").agg(F.sum("verified").alias("verified")), "query_id")
    forget(asked)
    return out
