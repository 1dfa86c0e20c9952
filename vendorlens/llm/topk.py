"""Exact top-k search by inner product: a KD-tree per shard.

Vectors are dealt to shards by a hash; each shard's task builds a KD-tree
(median split of the widest dimension, tight bounding boxes) and stores it as
one bounded record. Queries travel in blocks to every shard. Each query walks
a shard's tree best-first: a box is opened in falling order of the largest
inner product any point in it could have, and the walk ends when that bound
is below the query's k-th best score. The k-th score is propagated from shard
to shard: queries visit 1, 1, 2, 4, ... shards in rounds, each block from a shard
of its own on, and start each round with the k-th best of all scores found
before, which no later shard may fall short of. So half of the shards are
searched with what the other half gave, in a number of rounds that grows with
the logarithm of the shards; only each query's k best go on to the next round.

Defined cases: vectors that are null, or hold null or non-finite components,
take no part; vectors of different lengths never meet; a null id takes no
part; repeated ids are different rows (of equal rows k are looked at), and a row
never meets a row of its own id; queries of one id share one answer; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import read, stored, with_workers

# Vectors in one shard on average, in one leaf, and queries in one block.
SHARD_ROWS = 8192
LEAF_ROWS = 256
BLOCK_ROWS = 512
QUERY_EVERY = 50


class Tree:
    """A KD-tree as flat arrays. Node i has the box (low[i], high[i]) and
    either the rows first[i]:last[i] (leaf, left[i] = -1) or the children
    left[i] and left[i] + 1."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf_rows: int):
        order = np.arange(len(ids))
        low, high, first, last, left = [points.min(0)], [points.max(0)], [0], [len(ids)], [-1]
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = first[node], last[node]
            if b - a <= leaf_rows:
                continue
            wide = high[node] - low[node]
            rows, mid = order[a:b], (b - a) // 2
            if wide.size and wide.max() > 0:  # equal points need no order
                rows = rows[np.argpartition(points[rows, int(wide.argmax())], mid)]
                order[a:b] = rows
            left[node] = len(left)
            for x, y in ((a, a + mid), (a + mid, b)):
                part = points[order[x:y]]
                todo.append(len(left))
                low.append(part.min(0)), high.append(part.max(0))
                first.append(x), last.append(y), left.append(-1)
        self.points, self.ids = points[order], ids[order]
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.last, self.left = first, last, left

    def __getstate__(self) -> dict:
        return self.__dict__ | {x: packed(self.__dict__[x]) for x in ("points", "low", "high")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {x: unpacked(state[x]) for x in ("points", "low", "high")}

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product of every query with any point of every box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own: int, k: int, bounds: np.ndarray, floor) -> list[tuple]:
        """The k best (score, -id), ids other than ``own``, no score under ``floor``."""
        best: list[tuple] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < floor:
                break
            child = self.left[node]
            if child >= 0:
                for c in (child, child + 1):
                    if bounds[c] >= floor:
                        heapq.heappush(heap, (-bounds[c], c))
                continue
            a, b = self.first[node], self.last[node]
            scores = self.points[a:b] @ query
            ids = self.ids[a:b]
            good = np.flatnonzero((scores >= floor) & (ids != own))
            if len(good) > k:  # ties to the smaller id
                good = good[np.lexsort((ids[good], -scores[good]))[:k]]
            best = heapq.nlargest(k, best + [(scores[i], -ids[i]) for i in good.tolist()])
            if len(best) == k:
                floor = max(floor, best[-1][0])
        return best


def exact_numbers(values: np.ndarray) -> np.ndarray:
    """Whole numbers in a type in which every inner product is exact: float64
    while none can reach 2^53, else Python's own."""
    top = float(np.abs(values).max()) if values.size else 0.0
    if top < 2 ** 26 and top * top * max(1, values.shape[1]) < 2 ** 53:
        return values.astype(np.float64)
    return np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


def packed(points: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type, to travel."""
    if points.dtype == object or not points.size:
        return points
    top = np.abs(points).max()
    return points.astype(np.int16 if top < 2 ** 15 else np.int32)


def unpacked(points: np.ndarray) -> np.ndarray:
    return points if points.dtype == object else points.astype(np.float64)


def scaled(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v: floor(256 x) per component) of the rows that take part."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * 256).cast("double"))
    ok = F.forall(F.col(f"`{vector}`"), lambda x: F.coalesce(
        x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return df.where(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{vector}`").isNotNull() & ok).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v"))


def few_copies(rows: DataFrame, k: int) -> DataFrame:
    """At most k of the rows that are equal: no k best can hold more, and all
    of them would go to one shard or block."""
    counted = rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k))))
    return counted.select("vec_id", "v", copy.alias("copy")).drop("copy")


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    flat = [np.asarray(chunk.flatten()) for chunk in table["v"].chunks]
    return np.concatenate(flat or [np.zeros(0)]).reshape(table.num_rows, dim)


def search(vectors: DataFrame, queries: DataFrame, k: int, n: int, shard_rows: int = SHARD_ROWS,
           leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``scaled`` queries against ``scaled``
    vectors; ``n``: the number of vectors, which sizes the shards."""
    with_workers(vectors.sparkSession)
    shards = max(1, ceil(n / shard_rows))

    def build(key, table):
        dim, shard = (x.as_py() for x in key)
        tree = Tree(exact_numbers(_matrix(table, dim)), table["vec_id"].to_numpy(), leaf_rows)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int64()),
                         "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    def block(key, table):
        dim, number = (x.as_py() for x in key)
        body = pickle.dumps((packed(exact_numbers(_matrix(table, dim))), table["vec_id"].to_numpy()))
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([number], pa.int64()),
                         "queries": pa.array([body], pa.binary())})

    dim, h = F.size("v").alias("dim"), F.xxhash64("vec_id", "v")
    trees = stored(few_copies(vectors, k).select("vec_id", "v", dim, F.pmod(h, F.lit(shards)).alias("shard")).groupBy(
        "dim", "shard").applyInArrow(build, "dim int, shard bigint, tree binary"))
    blocks = max(1, ceil(queries.count() / block_rows))
    asked = stored(few_copies(queries, k).select("vec_id", "v", dim, F.pmod(h, F.lit(blocks)).alias("block")).groupBy(
        "dim", "block").applyInArrow(block, "dim int, block bigint, queries binary"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, number, tree, body, floors in zip(*(batch.column(c) for c in ("dim", "block", "tree", "queries", "floors"))):
                tree = pickle.loads(tree.as_py())
                points, ids = pickle.loads(body.as_py())
                points = unpacked(points)
                start = [float("-inf")] * len(ids)
                for known in floors.as_py() or ():
                    start[known["nth"]] = known["score"]
                bounds = tree.bounds(points)
                rows = [(nth, int(own), int(-minus), int(score))
                        for nth, (query, own, bound, floor) in enumerate(zip(points, ids.tolist(), bounds, start))
                        for score, minus in tree.search(query, own, k, bound, floor)]
                nth, own, vec, score = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d.as_py()] * len(rows), pa.int32()), pa.array([number.as_py()] * len(rows), pa.int64()),
                     pa.array(nth, pa.int32()), *[pa.array(x, pa.int64()) for x in (own, vec, score)]],
                    ["dim", "block", "nth", "query_id", "vec_id", "score"])

    def leading(found: DataFrame) -> DataFrame:
        """Every query's k best."""
        place = F.expr("row_number() OVER (PARTITION BY dim, block, nth ORDER BY score DESC, vec_id)")
        return found.withColumn("place", place).where(F.col("place") <= k)

    kinds = "dim int, block bigint, nth int, query_id bigint, vec_id bigint, score bigint"
    found, since, until = None, 0, 1
    while since < shards:
        todo = asked
        if found is None:
            todo = todo.withColumn("floors", F.lit(None).cast("array<struct<nth:int,score:bigint>>"))
        else:  # the k-th scores of the queries that have k
            floors = found.where(F.col("place") == k).groupBy("dim", "block").agg(F.collect_list(F.struct("nth", "score")).alias("floors"))
            todo = todo.join(floors, ["dim", "block"], "left")
        steps = F.explode(F.sequence(F.lit(since).cast("long"), F.lit(min(until, shards) - 1).cast("long")))
        todo = todo.withColumn("step", steps).withColumn("shard", F.pmod(F.col("block") + F.col("step"), F.lit(shards)))
        new = todo.join(trees, ["dim", "shard"]).select("dim", "block", "tree", "queries", "floors").mapInArrow(visit, kinds)
        found = stored(leading(new if found is None else new.unionByName(found.drop("place"))))
        since, until = until, 2 * until
    ranked = found.withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk_inner_product(spark, sf_dir: str) -> DataFrame:
    vectors = scaled(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")
    queries = vectors.where(F.col("vec_id") % QUERY_EVERY == 0)
    return search(vectors, queries, 5, vectors.count())


ORACLE = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
