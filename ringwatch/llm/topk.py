"""Exact top-k by inner product with a KD-tree per shard of vectors.

Shards are built once, each by one task from its own vectors: median splits, and for each node a tight
bounding box. Queries run in two rounds. First each query searches the shard it belongs to, which gives
a bound on its kth score; then blocks of queries, each with its bound, search the other shards. A
traversal takes boxes best first by the largest inner product that any point of the box could have and stops as
soon as that cannot reach the kth score, so the result is exact.

Cases: vectors that are null or hold null or non-finite components, and rows with a null id, take no
part; a query meets no row of its own id; repeated rows are candidates each, repeated queries count once;
vectors of unequal length are filled up with zeros; ties go to the smaller id; fewer candidates than k
give fewer rows; an empty table gives an empty result; further columns are not read. Components
are scaled to integers of at most 2^31 in size; scores are exact 64-bit integers as long as they fit.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import batch_of, cut, longs, mapped, pick

#: Vectors of a shard, of a leaf, and queries of a block.
SHARD_ROWS = 8_192
LEAF_ROWS = 256
BLOCK_ROWS = 512


def scaled(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v: the usable vectors, each component x as floor(scale * x), x as double."""
    values = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return pick(vectors, "vec_id", "embedding").filter(F.col("vec_id").isNotNull() & fine).select("vec_id", values.alias("v"))


class Tree:
    """Median splits of integer points with ids, boxes tight around each node's points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.nodes: list[tuple] = []
        if len(ids):
            self._split(np.arange(len(ids)))

    def _split(self, rows: np.ndarray) -> int:
        own = self.points[rows]
        low, high, place = own.min(0), own.max(0), len(self.nodes)
        self.nodes.append(())
        axis = int(np.argmax(high - low)) if own.shape[1] else 0
        if len(rows) <= LEAF_ROWS or not own.shape[1] or high[axis] == low[axis]:
            rows = np.sort(rows)
            self.nodes[place] = (low, high, int(self.ids[rows].min()), rows, None)
            return place
        by = np.argsort(own[:, axis], kind="stable")
        half = len(rows) // 2
        left, right = self._split(rows[by[:half]]), self._split(rows[by[half:]])
        self.nodes[place] = (low, high, int(self.ids[rows].min()), left, right)
        return place

    def _bound(self, place: int, q: np.ndarray) -> tuple[int, int]:
        low, high, first, _, _ = self.nodes[place]
        return -int(np.maximum(q * low, q * high).sum()), first

    def best(self, query_id: int, q: np.ndarray, k: int, kth: int | None) -> list[tuple[int, int]]:
        """Up to k of (-score, id), ascending, that may belong to the query's best; ``kth``: a score k other rows reach."""
        found: list[tuple[int, int]] = []
        waiting = [(*self._bound(0, q), 0)] if self.nodes else []
        while waiting:
            bound, first, place = heapq.heappop(waiting)
            if kth is not None and -bound < kth or len(found) == k and (bound, first) > found[-1]:
                break
            _, _, _, left, right = self.nodes[place]
            if right is not None:
                for child in (left, right):
                    heapq.heappush(waiting, (*self._bound(child, q), child))
                continue
            scores = self.points[left] @ q
            ids = self.ids[left]
            keep = np.nonzero(ids != query_id)[0]
            if kth is not None:
                keep = keep[scores[keep] >= kth]
            if len(keep) > k:
                keep = keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
            found = sorted(found + [(-int(s), int(i)) for s, i in zip(scores[keep], ids[keep])])[:k]
        return found


def _points(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _padded(points: np.ndarray, width: int) -> np.ndarray:
    return np.pad(points, ((0, 0), (0, width - points.shape[1]))) if points.shape[1] < width else points


def top_k(vectors: DataFrame, k: int = 5, query_divisor: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k highest scores; queries: ids divisible by ``query_divisor``."""
    rows = cut(scaled(vectors, scale))
    n_rows = rows.count()
    n_shards = max(1, math.ceil(n_rows / SHARD_ROWS))
    in_shards = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_shards)).cast("int"))
    asked = in_shards.filter(F.col("vec_id") % query_divisor == 0)
    # Queries repeated with the same vector count once, and each knows the shard that holds it.
    asked = asked.dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "shard")
    asked = cut(asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(
        max(1, math.ceil(n_rows / query_divisor / BLOCK_ROWS)))).cast("int")))
    home = _search(in_shards, asked.select("query_id", "q", F.col("shard").alias("at"), F.lit(None).cast("long").alias("kth")),
                   k, n_shards)
    home = cut(home)
    if n_shards > 1:
        kth = home.groupBy("query_id", "q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
        bounded = asked.join(kth, ["query_id", "q"], "left").select(
            "query_id", "q", "shard", F.when(F.col("n") >= k, F.col("low")).alias("kth"))
        # Each query goes to every other shard by name: a stated query set against all rows.
        others = bounded.select(
            "query_id", "q", "kth", F.explode(F.filter(
                F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: s != F.col("shard"))).alias("at"))
        found = home.unionByName(_search(in_shards, others, k, n_shards))
    else:
        found = home
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    # At most k rows of each shard meet here.
    merged = found.groupBy("query_id", "q").agg(best.alias("best"))
    return merged.select("query_id", F.posexplode("best").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))


def _search(in_shards: DataFrame, asked: DataFrame, k: int, n_shards: int) -> DataFrame:
    """query_id, q, vec_id, score: the best of each query in the shard it was sent to."""
    vectors = in_shards.select(
        "shard", F.lit(0).alias("kind"), F.col("vec_id").alias("id"), F.col("v").alias("x"), F.lit(None).cast("long").alias("kth"))
    queries = asked.select(F.col("at").alias("shard"), F.lit(1).alias("kind"), F.col("query_id").alias("id"), F.col("q").alias("x"), "kth")
    together = vectors.unionByName(queries).repartition(n_shards, "shard").sortWithinPartitions("shard", "kind")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, tree = None, [], None
        for batch in batches:
            marks = batch.column("shard").to_numpy() * 2 + batch.column("kind").to_numpy()
            edges = [0, *(np.nonzero(np.diff(marks))[0] + 1).tolist(), len(marks)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                own = batch.slice(a, b - a)
                if marks[a] // 2 != shard:
                    shard, held, tree = marks[a] // 2, [], None
                ids, points = own.column("id").to_numpy(), _points(own.column("x"))
                if marks[a] % 2 == 0:
                    held.append((ids, points))
                    continue
                if tree is None:
                    wide = max((p.shape[1] for _, p in held), default=0)
                    tree = Tree(
                        np.concatenate([i for i, _ in held]) if held else ids[:0],
                        np.concatenate([_padded(p, wide) for _, p in held]) if held else points[:0])
                yield from _answers(tree, own, ids, points, k)

    return mapped(together, work, "query_id long, q array<long>, vec_id long, score long")


def _answers(tree: Tree, own: pa.RecordBatch, ids: np.ndarray, points: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    wide = max(tree.points.shape[1], points.shape[1])
    if tree.points.shape[1] < wide:
        points = points[:, :tree.points.shape[1]]  # further components meet zeros only
    points = _padded(points, tree.points.shape[1])
    kths = own.column("kth").to_pylist()
    of, hits, scores = [], [], []
    for i in range(len(ids)):
        for s, v in tree.best(int(ids[i]), points[i], k, kths[i]):
            of.append(i)
            hits.append(v)
            scores.append(-s)
    at = pa.array(of, pa.int64())
    yield batch_of(query_id=own.column("id").take(at), q=own.column("x").take(at), vec_id=longs(hits), score=longs(scores))
