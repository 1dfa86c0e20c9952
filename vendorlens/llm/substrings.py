"""Substring dedup by difference-cover anchors.

A window is 20 consecutive words. Positions modulo 13 that lie in the
difference cover {0, 1, 3, 9} are anchors: for any two positions some shift
below 13 takes both to the cover, so two equal windows share an equal anchor,
the 8 words from it on. Anchors that occur at several places are extended:
every window that could hold one is compared by all its 20 words (a 128-bit
hash), and a window that starts anywhere later than the first is removed.

Texts with the same words are collapsed first. Anchors and windows are
combined inside each task before they are shuffled, so a passage that a third
of all documents share sends one row per task and key.

Defined cases: a null or empty text has no words; a null doc_id is after all
others; rows of one doc_id and different texts are different documents, of
which the smaller start, then the smaller hash of the text, is earlier; rows
equal in both are one document, with one answer; documents of under 20 words lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import join_measured, read, stored
from vendorlens.llm.texts import EMPTY_SHA256, LAST, PLACE_KINDS, combined, copies, documents, met, place

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)


def spans(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in the words joined by single spaces."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return starts, ends


def anchors(words: list[bytes], window: int, period: int, cover: tuple) -> tuple[list[int], list[int]]:
    """Positions of the anchors, and hashes of the words from each on."""
    width = window - period + 1
    places = np.sort(np.concatenate([np.arange(c, len(words) - width + 1, period) for c in cover]))
    body = b" ".join(words)
    starts, ends = spans(words)
    h = xxhash.xxh3_64_intdigest
    return places, [h(body[a:b]) for a, b in zip(starts[places].tolist(), ends[places + width - 1].tolist())]


def covered(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) of words that windows from ``starts`` cover."""
    starts = np.sort(starts.astype(np.int64))
    cuts = np.flatnonzero(np.diff(starts) > window) + 1
    return starts[np.append(0, cuts)], starts[np.append(cuts, len(starts)) - 1] + window


RUNS = "doc bigint, alt bigint, start array<bigint>, end array<bigint>"


def _as_runs(batches: Iterator[pa.RecordBatch], width: int, before: int = 0) -> Iterator[pa.RecordBatch]:
    """(doc, alt, start, end): the few runs that the ``width`` places from
    ``before`` each position on cover."""
    for batch in batches:
        start, end = zip(*[covered(np.asarray(p.values) - before, width) for p in batch.column("positions")])
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("alt"), pa.array(start, lists),
                                          pa.array(end, lists)], ["doc", "alt", "start", "end"])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
          period: int = PERIOD, cover: tuple = COVER) -> DataFrame:
    """(doc, alt, n_words, n_removed, kept_sha256, kept) for every row; kept
    is the remaining text, or null where nothing is removed."""
    rows = documents(docs, doc_id, text)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.as_py().encode().split() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("alt"), pa.array(list(map(len, words)), pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words])], ["doc", "alt", "n_words", "sha"])

    table = stored(rows.mapInArrow(measure, "doc bigint, alt bigint, n_words bigint, sha string"))
    repeated = stored(copies(table.where(F.col("n_words") >= window)))
    member = join_measured(table, repeated, ["sha"], "inner", 120)
    later = stored(member.where(F.struct("doc", "alt") != F.col("first")).select("doc", "alt").distinct())
    single = join_measured(rows, later, ["doc", "alt"], "left_anti", 16)

    def anchor_rows(batch: pa.RecordBatch):
        for doc, alt, body in zip(*(batch.column(c) for c in ("doc", "alt", "text"))):
            words = body.as_py().encode().split()
            if len(words) >= window:
                places, hashes = anchors(words, window, period, cover)
                yield place(doc.as_py(), alt.as_py(), places) | {"route": np.array(hashes, np.uint64).view(np.int64)}

    kinds = f"{PLACE_KINDS}, first boolean, known boolean"
    shared = single.mapInArrow(lambda b: combined(b, anchor_rows, ["route"]), f"route bigint, {kinds}")
    # starts of all windows with a shared anchor at a shift below the period
    shared = stored(met(shared, ["route"], later_only=False).mapInArrow(
        lambda b: _as_runs(b, period, period - 1), RUNS))
    wide = F.size("start") * 16 + 72
    held = join_measured(single, shared, ["doc", "alt"], "inner", wide)

    def window_rows(batch: pa.RecordBatch):
        digest = xxhash.xxh3_128_digest
        for doc, alt, body, start, end in zip(*(batch.column(c) for c in ("doc", "alt", "text", "start", "end"))):
            words = body.as_py().encode().split()
            stop = len(words) - window + 1
            places = np.concatenate([np.arange(max(a, 0), min(b, stop)) for a, b in zip(start.as_py(), end.as_py())])
            if len(places):
                text, (starts, ends) = b" ".join(words), spans(words)
                hashes = b"".join([digest(text[a:b]) for a, b in zip(
                    starts[places].tolist(), ends[places + window - 1].tolist())])
                high, low = np.frombuffer(hashes, "<i8").reshape(-1, 2).T
                yield place(doc.as_py(), alt.as_py(), places) | {"route": high, "low": low}

    again = held.mapInArrow(lambda b: combined(b, window_rows, ["route", "low"]), f"route bigint, low bigint, {kinds}")
    again = stored(met(again, ["route", "low"], later_only=True).mapInArrow(
        lambda b: _as_runs(b, window), RUNS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, start, end, copy in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "end", "copy"))):
                words = body.encode().split()
                kept, at = [], 0
                for a, b in zip(start or (), end or ()):
                    kept += words[at:a]
                    at = b
                kept = b"" if copy else b" ".join(kept + words[at:])
                gone = len(words) if copy else sum(end or ()) - sum(start or ())
                out.append((len(words), gone, hashlib.sha256(kept).hexdigest(), kept.decode() if gone else None))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("alt"), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                ["doc", "alt", "n_words", "n_removed", "kept_sha256", "kept"])

    out = join_measured(rows, again, ["doc", "alt"], "left", wide)
    out = join_measured(out, later.withColumn("copy", F.lit(True)), ["doc", "alt"], "left", 32)
    return out.mapInArrow(cut, "doc bigint, alt bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(F.nullif("doc", F.lit(LAST)).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
