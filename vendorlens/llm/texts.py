"""What the two exact substring operators share: distinct texts, and rows
that meet by a hash after local combining.

A document is (doc, alt): its doc_id (null: the largest long, which is last)
and a 64-bit hash of its text, so rows that repeat a doc_id stay apart (of n
different texts under one doc_id, or under none, about n * n / 2**65 pairs
meet). Rows that are equal in both are the same document. A place is
(doc, pos, alt), in this order, with the position in a column of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import with_workers
from vendorlens.llm.runs import whole_runs

LAST = (1 << 63) - 1
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
# Rows that a task combines before they are shuffled.
CHUNK_ROWS = 1 << 20
PLACE = ("doc", "pos", "alt")
PLACE_KINDS = "doc bigint, pos int, alt bigint"


def place(doc: int, alt: int, positions: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of places in one document."""
    n = len(positions)
    return {"doc": np.full(n, doc, np.int64), "pos": positions.astype(np.int32), "alt": np.full(n, alt, np.int64)}


def positions_of(places: DataFrame) -> DataFrame:
    """(doc, alt, positions) of the different places of each document."""
    return places.groupBy("doc", "alt").agg(F.collect_set("pos").alias("positions"))


def documents(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """(doc, alt, text, more) with null texts empty."""
    with_workers(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(body).alias("alt"), body.alias("text"), *more)


def copies(table: DataFrame) -> DataFrame:
    """(sha, n, first): every content that several rows have, how many, and
    the first document with it. A pre-aggregated count."""
    return table.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "alt")).alias("first")
                                    ).where("n > 1")


def local_firsts(columns: dict[str, np.ndarray], keys: list[str]) -> dict[str, np.ndarray]:
    """Sort rows by keys and place; add ``first`` (of its key here) and
    ``known`` (another row here has its key)."""
    order = np.lexsort([columns["alt"], columns["pos"], columns["doc"], *[columns[k] for k in reversed(keys)]])
    out = {c: v[order] for c, v in columns.items()}
    if len(order) > 1:  # one place once, also of a document whose row repeats
        again = np.zeros(len(order), bool)
        again[1:] = np.logical_and.reduce([out[k][1:] == out[k][:-1] for k in (*keys, *PLACE)])
        out = {c: v[~again] for c, v in out.items()}
    n = len(out["doc"])
    first = np.ones(n, bool)
    if n > 1:
        first[1:] = False
        for k in keys:
            first[1:] |= out[k][1:] != out[k][:-1]
    alone_after = np.append(first[1:], True)
    return out | {"first": first, "known": ~(first & alone_after)}


def combined(batches: Iterator[pa.RecordBatch], rows_of: Callable, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of every chunk of texts, combined by key: a key's first row
    stands for it in the shuffle (``route`` is its key); the others are
    already known to repeat, and are routed by their own place."""
    held, count = [], 0

    def flush() -> pa.RecordBatch:
        columns = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
        columns = local_firsts(columns, keys)
        own = columns["pos"].astype(np.int64) * np.int64(-7046029254386353131) ^ columns["doc"] ^ columns["alt"]
        route = np.where(columns["first"], columns[keys[0]], own)
        names = ["route", *keys[1:], *PLACE, "first", "known"]
        columns["route"] = route
        return pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in names], names)

    for batch in batches:
        for rows in rows_of(batch):
            held.append(rows)
            count += len(rows["doc"])
            if count >= CHUNK_ROWS:
                yield flush()
                held, count = [], 0
    if count:
        yield flush()


def met(rows: DataFrame, keys: list[str], later_only: bool) -> DataFrame:
    """Shuffle combined rows by key; (doc, alt, positions) of those whose key
    occurs at several places, or ``later_only`` at an earlier place. A key
    brings one row of each chunk, however often it occurs."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in whole_runs(batches, ["first", *keys]):
            same = run.same_as_last()
            if later_only:
                # rows that are the same place as the first (equal documents) aren't later
                starts = np.flatnonzero(~same)
                head = starts[np.searchsorted(starts, np.arange(len(same)), "right") - 1]
                later = np.logical_or.reduce([run[c] != run[c][head] for c in PLACE])
                out = np.where(run["first"], later, run["known"])
            else:
                out = run["known"] | same | np.append(same[1:], False)
            yield pa.RecordBatch.from_arrays([pa.array(run[c][out]) for c in PLACE], list(PLACE))

    dealt = rows.repartition(*keys).sortWithinPartitions("first", *keys, *PLACE)
    return positions_of(dealt.mapInArrow(pick, PLACE_KINDS))
