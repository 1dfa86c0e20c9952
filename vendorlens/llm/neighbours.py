"""Approximate nearest neighbours: an adaptive scan of dimensions in lists.

Vectors are dealt to lists by their nearest centroid. Each list is kept in
parts of bounded size, and each part holds its vectors rotated by one random
orthogonal matrix, in blocks of columns, beside the original ones. After a
random rotation the first d of D coordinates hold about d / D of a squared
distance, whatever the data. So a query reads a list block by block, and a
hypothesis test after each block abandons the candidates whose partial
distance says that they lie beyond the query's k-th nearest so far. Those that
pass the last block are measured on the original vectors, in double precision.

A query's k-th distance comes from its nearest list, which it visits first;
then it goes to its other lists with it. How many lists a query probes is
calibrated: the fewest that hold ``RECALL`` of the nearest neighbours within
the sample that the centroids are fitted on.

The sample is bounded (``SAMPLE_ROWS``, those with the smallest hashes); every
row is indexed. Equal vectors are first reduced, exactly: of their ids only the
k + 1 smallest can be among any query's k nearest.

Defined cases: vectors that are null, zero, or hold null or non-finite
components, and rows without an id, take no part; vectors of different lengths
never meet; repeated rows are candidates each; a row never meets a row of its
own id, and the rows of one id are one query. Fewer than k candidates give
fewer rows. Lengths that the sample lacks have one list.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vendorlens.llm.common import read, stored, with_workers

QUERY_EVERY = 100
SAMPLE_ROWS = 16384
LIST_ROWS, MOST_LISTS = 512, 1024
# Share of the sample's neighbours that the probed lists must hold.
RECALL = 0.97
# Vectors in a part and queries in a block at most, on average; pairs measured at once.
PART_ROWS, BLOCK_ROWS, PAIRS = 4096, 512, 1 << 17
# Width of a column block, and how sure a test must be: a candidate goes if its
# distance, estimated from d coordinates, is over (1 + SURE / sqrt(d)) times the k-th.
COLUMNS, SURE = 16, 2.1
# Rounding of 32-bit coordinates, relative to the squared lengths.
SLACK = 1e-5
SEED = 12


def eligible(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return df.where(F.col(f"`{vec_id}`").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [np.asarray(c.flatten()) for c in chunks]
    return np.concatenate(flat or [np.zeros(0)]).reshape(-1, dim)


def squared_gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


class Lists:
    """Centroids of the vectors of one length, and how many lists to probe."""

    def __init__(self, sample: np.ndarray, lists: int, k: int, recall: float, rounds: int = 12):
        rng = np.random.default_rng(SEED)
        points = np.unique(sample, axis=0)
        self.centroids = points[np.sort(rng.permutation(len(points))[:lists])].astype(np.float64)
        for _ in range(rounds):
            near = self.order(sample, 1)[:, 0]
            size = np.bincount(near, minlength=len(self.centroids))
            total = np.zeros_like(self.centroids)
            np.add.at(total, near, sample)
            self.centroids[size > 0] = total[size > 0] / size[size > 0, None]
        self.probes = self._calibrated(sample, k, recall)

    def order(self, points: np.ndarray, many: int) -> np.ndarray:
        """The ``many`` nearest lists of every point, nearest first."""
        gaps = squared_gaps(points.astype(np.float64), self.centroids)
        return np.argsort(gaps, axis=1, kind="stable")[:, :many] if many > 1 else gaps.argmin(1)[:, None]

    def _calibrated(self, sample: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
        asked = sample[:queries]
        gaps = squared_gaps(asked, sample)
        gaps[np.arange(len(asked)), np.arange(len(asked))] = np.inf
        near = np.argsort(gaps, axis=1, kind="stable")[:, :min(k, len(sample) - 1)]
        if not near.size:
            return 1
        rank = np.argsort(self.order(asked, len(self.centroids)), axis=1)
        needed = np.sort(np.take_along_axis(rank, self.order(sample, 1)[:, 0][near], 1).ravel())
        return int(needed[ceil(recall * len(needed)) - 1]) + 1


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, always the same for a length."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Part:
    """Vectors of a list: ids, copies, original vectors, and the rotated ones
    as blocks of columns."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        self.ids, self.copies, self.vectors = ids, copies, vectors
        turned = vectors.astype(np.float64) @ rotation(vectors.shape[1])
        if np.abs(turned).max() < 1e30:
            turned = turned.astype(np.float32)
        self.blocks = [np.ascontiguousarray(turned[:, a:a + COLUMNS]) for a in range(0, turned.shape[1], COLUMNS)]

    def passing(self, queries: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) that no test abandons. ``limits``: the k-th
        distances."""
        dim = self.vectors.shape[1]
        turned = queries @ rotation(dim)
        square = (queries * queries).sum(1)
        lengths = (self.vectors.astype(np.float64) ** 2).sum(1)
        slack = SLACK * (square + lengths.max())
        who = row = partial = None
        for n, block in enumerate(self.blocks):
            seen = min(dim, (n + 1) * COLUMNS)
            part = turned[:, n * COLUMNS:n * COLUMNS + COLUMNS]
            # over all coordinates the estimate is the distance, and nothing is left to chance
            sure = (1 + SURE / np.sqrt(seen)) ** 2 if seen < dim else 1.0
            bound = limits ** 2 * (seen / dim) * sure + slack
            if who is None:
                partial = squared_gaps(part, block.astype(np.float64))
                who, row = np.nonzero(partial <= bound[:, None])
                partial = partial[who, row]
            else:
                gap = block[row] - part[who]
                partial = partial + (gap * gap).sum(1)
                keep = partial <= bound[who]
                who, row, partial = who[keep], row[keep], partial[keep]
        return who, row

    def nearest(self, queries: np.ndarray, own: np.ndarray, limits: np.ndarray, k: int) -> Iterator[tuple]:
        """(query, rows, distances): each query's k nearest within its limit,
        ids other than its own, by distance, then id."""
        step = max(1, PAIRS // len(self.ids))
        for at in range(0, len(queries), step):
            some = queries[at:at + step]
            who, row = self.passing(some, limits[at:at + step])
            other = self.ids[row] != own[at:at + step][who]
            who, row = who[other], row[other]
            gap = self.vectors[row].astype(np.float64) - some[who]
            far = np.sqrt((gap * gap).sum(1))
            order = np.lexsort((self.ids[row], far, who))
            who, row, far = who[order], row[order], far[order]
            first = np.searchsorted(who, np.arange(len(some) + 1))
            for q, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                b = min(b, a + k)
                if a < b:
                    yield at + q, row[a:b], far[a:b]


def reduced(vectors: DataFrame, k: int) -> DataFrame:
    """(vec_id, v, copies): rows that are equal as one, and of equal vectors
    those with the k + 1 smallest ids."""
    once = vectors.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))
    once = once.withColumn("h", F.xxhash64("v"))
    rank = F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))
    return once.withColumn("r", rank).where(F.col("r") <= k + 1).select("vec_id", "v", F.least("copies", F.lit(k)).alias("copies"))


def fitted(vectors: DataFrame, n: int, k: int, list_rows: int, recall: float) -> dict[int, Lists]:
    """Lists by length of vector, from a bounded sample."""
    sample = vectors.orderBy(F.xxhash64("v", "vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").toPandas()["v"]
    by_dim: dict[int, list] = {}
    for v in sample:
        by_dim.setdefault(len(v), []).append(v)
    lists = lambda rows: max(1, min(MOST_LISTS, n * rows // len(sample) // list_rows))
    return {d: Lists(np.array(vs, np.float64), lists(len(vs)), k, recall) for d, vs in by_dim.items()}


def search(vectors: DataFrame, queries: DataFrame, k: int, n: int, list_rows: int = LIST_ROWS, recall: float = RECALL,
           part_rows: int = PART_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``eligible`` queries against
    ``eligible`` vectors; ``n``: the number of vectors, which sizes the lists."""
    spark = vectors.sparkSession
    with_workers(spark)
    model = spark.sparkContext.broadcast(fitted(vectors, n, k, list_rows, recall))  # MOST_LISTS vectors a length
    kind = vectors.schema["v"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch], probe: bool) -> Iterator[pa.RecordBatch]:
        """Rows with their list, or with all lists to probe by rank."""
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                lists = model.value.get(dim)
                many = lists.probes if lists and probe else 1
                points = matrix(part.column("v"), dim)
                order = lists.order(points, many) if lists else np.zeros((len(points), 1), np.int64)
                rows = part.take(pa.array(np.repeat(np.arange(len(points)), many)))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(order.ravel(), pa.int32()), pa.array(np.tile(np.arange(many), len(points)), pa.int32())],
                    [*rows.schema.names, "list", "probe"])

    def body_of_part(key, table):
        dim, number, part = (x.as_py() for x in key)
        body = Part(table["vec_id"].to_numpy(), table["copies"].to_numpy(), matrix(table["v"], dim))
        return pa.table({"dim": pa.array([dim], pa.int32()), "list": pa.array([number], pa.int32()),
                         "part": pa.array([part], pa.int64()), "body": pa.array([pickle.dumps(body)], pa.binary())})

    def body_of_block(key, table):
        dim, number = key[0].as_py(), key[1].as_py()
        body = matrix(table["v"], dim).astype(np.float64), table["vec_id"].to_numpy(), table["limit"].to_numpy()
        return pa.table({"dim": pa.array([dim], pa.int32()), "list": pa.array([number], pa.int32()),
                         "queries": pa.array([pickle.dumps(body)], pa.binary())})

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, asked in zip(batch.column("body"), batch.column("queries")):
                part, (points, ids, limits) = pickle.loads(body.as_py()), pickle.loads(asked.as_py())
                found = list(part.nearest(points, ids, limits, k))
                rows = np.concatenate([r for _, r, _ in found] or [np.zeros(0, np.int64)])
                of = np.repeat([q for q, _, _ in found], [len(r) for _, r, _ in found]).astype(np.int64)
                far = np.concatenate([x for _, _, x in found] or [np.zeros(0)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[of], pa.int64()), pa.array(part.ids[rows], pa.int64()), pa.array(far, pa.float64()),
                     pa.array(part.copies[rows], pa.int64())], ["query_id", "vec_id", "score", "copies"])

    dealt = stored(reduced(vectors, k).withColumn("dim", F.size("v")).mapInArrow(
        lambda b: placed(b, False), f"vec_id bigint, v {kind}, copies bigint, dim int, list int, probe int"))
    # as many rows as there are lists
    sizes = stored(dealt.groupBy("dim", "list").agg(F.ceil(F.count(F.lit(1)) / part_rows).alias("parts")))
    parts = stored(dealt.join(F.broadcast(sizes), ["dim", "list"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts"))).select("dim", "list", "part", "vec_id", "copies", "v").groupBy(
        "dim", "list", "part").applyInArrow(body_of_part, "dim int, list int, part bigint, body binary"))
    asked = stored(queries.distinct().withColumn("dim", F.size("v")).mapInArrow(
        lambda b: placed(b, True), f"vec_id bigint, v {kind}, dim int, list int, probe int"))

    def visit(rows: DataFrame) -> DataFrame:
        """What queries (with a limit) find in the parts of their lists."""
        blocks = stored(rows.groupBy("dim", "list").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks")))
        bodies = rows.join(F.broadcast(blocks), ["dim", "list"]).withColumn(
            "block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks"))).select("dim", "list", "block", "vec_id", "v", "limit").groupBy(
            "dim", "list", "block").applyInArrow(body_of_block, "dim int, list int, queries binary")
        every = bodies.join(F.broadcast(sizes), ["dim", "list"]).select(
            "dim", "list", "queries", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        return every.join(parts, ["dim", "list", "part"]).select("body", "queries").mapInArrow(
            scanned, "query_id bigint, vec_id bigint, score double, copies bigint")

    def best(found: DataFrame) -> DataFrame:
        each = found.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    home = stored(best(visit(asked.where("probe = 0").withColumn("limit", F.lit(float("inf"))))))
    limits = home.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("limit"))
    others = asked.where("probe > 0").join(limits, "vec_id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    away = visit(stored(others)).where(F.col("score") < float("inf"))
    return best(home.select("query_id", "vec_id", "score", F.lit(1).cast("long").alias("copies")).unionByName(away))


def op12_adaptive_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = eligible(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")
    return search(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0), 10, vectors.count())
