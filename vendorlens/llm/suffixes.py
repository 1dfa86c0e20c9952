"""Suffix-array dedup: bytes of 400-byte strings that occur twice or more.

Every 400-byte window has one anchor, the place of the smallest hash of a
32-byte string in it, so equal windows have equal anchors. Only anchors that
occur at several places can hold a repeat; the windows of such an anchor at
one place form one segment of text. Segments are dealt to shards by their
anchor's hash, equal segments of one task as one, and each shard sorts all
its suffixes with their common-prefix lengths by induction: a window is
repeated if its suffix shares 400 bytes with a neighbour.

An anchor with more text than a shard takes (a passage with many different
surroundings) is dealt again, by what equal windows also share: the distance
from their start to the anchor, in classes, and the bytes that all windows of
a class have around it. Classes get narrower until each key's text fits; in
the last one a key is one whole window.

Whole texts that repeat are found first, by their checksum.

Defined cases: a null text is empty and has no windows; doc_ids may be null or
repeat; a row that repeats another is another document, so all of it goes if
it is long enough; texts are valid UTF-8.
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
from vendorlens.llm.induce import Suffixes
from vendorlens.llm.texts import EMPTY_SHA256, LAST, PLACE_KINDS, combined, copies, documents, met, place

LENGTH = 400
GRAM = 32
# Windows of one text that are anchored together, bytes of text that a task
# combines before it sends them, and bytes that one shard sorts at once (more
# only where one key has more).
BLOCK = 1 << 22
COMBINE_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
# Text that one key may have, and widths of the classes of distances by which
# the keys that have more are dealt again.
CROWD_BYTES = 4 << 20
CLASSES = (93, 24, 6, 1)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a multiple of 8) from each position."""
    word = data.astype(np.uint64)
    for step in (1, 2, 4):
        word = word[:-step] | word[step:] << np.uint64(8 * step)
    n = len(data) - gram + 1
    h = np.full(n, gram, np.uint64)
    for at in range(0, gram, 8):
        h = (h ^ word[at:at + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def segments(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, hash): runs of window starts with the same anchor, and
    the anchor's hash. Of equal hashes in a window the leftmost anchors it."""
    out = []
    data = np.frombuffer(text, np.uint8)
    span = length - gram + 1
    for base in range(0, len(data) - length + 1, BLOCK):
        h = gram_hashes(data[base:base + BLOCK + length - 1], gram)
        windows = len(h) - span + 1
        # the upper bits of the hash, then the place: the least is the leftmost of the least
        key = h >> np.uint64(23) << np.uint64(23) | np.arange(len(h), dtype=np.uint64)
        pad = np.append(key, np.full(-len(key) % span, (1 << 64) - 1, np.uint64)).reshape(-1, span)
        ahead = np.minimum.accumulate(pad, axis=1).ravel()
        behind = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = np.minimum(behind[:windows], ahead[span - 1:span - 1 + windows])
        first = np.append(0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
        at = (anchor[first] & np.uint64((1 << 23) - 1)).astype(np.int64)
        out.append((first + base, np.append(first[1:], windows) - 1 + base, h[at]))
    return tuple(np.concatenate(x) for x in zip(*out))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by [start, end) intervals."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(new[1:], True)]


def _merged_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, alt, start, end): a document's repeated bytes as maximal runs."""
    for batch in batches:
        runs = [merged(*(np.asarray(p.values.field(c)) for c in ("start", "end"))) for p in batch.column("spans")]
        start, end = zip(*runs)
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("alt"), pa.array(start, lists),
                                          pa.array(end, lists)], ["doc", "alt", "start", "end"])


KINDS = "route bigint, body binary, doc bigint, pos bigint, alt bigint, size bigint, known boolean"


def _combined_pieces(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Pieces (key, body, doc, pos, alt, known); of those with equal key and
    bytes, the first goes to its key's shard and the others are known to
    repeat whole."""
    found: dict[tuple, list] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        rows = []
        for (h, body), places in found.items():
            for i, (doc, pos, alt, known) in enumerate(places):
                route = h if not i else hash((doc, pos, alt, h))
                rows.append((route, b"" if i else body, doc, pos, alt, len(body), known or len(places) > 1))
        columns = zip(*rows)
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          [k.split()[0] for k in KINDS.split(", ")])

    for key, body, doc, pos, alt, known in pieces:
        places = found.setdefault((key, body), [])
        if (doc, pos, alt, known) not in places[-1:]:  # a repeated row is handled as a copy
            places.append((doc, pos, alt, known))
        held += len(body)
        if held > COMBINE_BYTES:
            yield flush()
            found, held = {}, 0
    if found:
        yield flush()


def _segment_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Segments whose anchor repeats."""

    def pieces() -> Iterator[tuple]:
        for batch in batches:
            for doc, alt, body, positions in zip(*(batch.column(c) for c in ("doc", "alt", "text", "positions"))):
                doc, alt, body = doc.as_py(), alt.as_py(), body.as_py().encode()
                first, last, h = segments(body, length)
                mine = np.flatnonzero(np.isin(first, np.asarray(positions.values)))
                for a, b, key in zip(first[mine].tolist(), last[mine].tolist(), h[mine].view(np.int64).tolist()):
                    yield key, body[a:b + length], doc, a, alt, False

    return _combined_pieces(pieces())


def by_distance(body: bytes, width: int, length: int, gram: int = GRAM) -> Iterator[tuple[int, int, bytes]]:
    """(first, last, key): the windows of a segment by classes of ``width``
    distances from their start to their anchor; the key is the class and the
    bytes that every window of it has, also where this segment has only some."""
    far = length - gram
    # the windows have one anchor: that of the first, by the order of ``segments``
    anchor = int(np.argmin(gram_hashes(np.frombuffer(body[:length], np.uint8), gram) >> np.uint64(23)))
    for n in range(max(0, anchor - (len(body) - length)) // width, anchor // width + 1):
        near, most = n * width, min(n * width + width - 1, far)
        yield (max(0, anchor - most), min(len(body) - length, anchor - near),
               b"%d " % n + body[anchor - near:anchor - most + length])


def _split_rows(batches: Iterator[pa.RecordBatch], width: int, length: int) -> Iterator[pa.RecordBatch]:
    """Crowded segments in pieces by class of distance."""

    def pieces() -> Iterator[tuple]:
        for batch in batches:
            for row in batch.to_pylist():
                body = row["body"]
                for a, b, key in by_distance(body, width, length):
                    route = xxhash.xxh3_64_intdigest(key) - (1 << 63)
                    yield route, body[a:b + length], row["doc"], row["pos"] + a, row["alt"], row["known"]

    return _combined_pieces(pieces())


def uncrowded(pieces: DataFrame, length: int = LENGTH, crowd: int = CROWD_BYTES) -> DataFrame:
    """The stored rows of segments, dealt again as long as the different texts
    of a key have over ``crowd`` bytes. Rows without a body (known to repeat)
    are routed by place, each alone."""
    done = []
    for width in CLASSES:
        crowded = stored(pieces.groupBy("route").agg(F.sum("size").alias("n")).where(F.col("n") > crowd).select("route"))
        if crowded.isEmpty():
            break
        marked = join_measured(pieces, crowded.withColumn("crowded", F.lit(True)), ["route"], "left", 16)
        again = F.col("crowded").isNotNull() & (F.octet_length("body") > 0)
        done.append(marked.where(~again).select(*pieces.columns))
        pieces = stored(marked.where(again).select(*pieces.columns).mapInArrow(
            lambda b, w=width: _split_rows(b, w, length), KINDS))
    for part in done:
        pieces = pieces.unionByName(part)
    return pieces


def _sorted_shards(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(doc, alt, start, end) of all repeated bytes of the shards' segments."""
    places: dict[bytes, list] = {}  # of the keys before
    own: dict[bytes, list] = {}  # of the key at hand
    anchor, held, mine = None, 0, 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in np.array(rows, np.int64).reshape(-1, 4).T], ["doc", "alt", "start", "end"])

    def flush() -> pa.RecordBatch:
        rows = []
        strings = list(places)
        for body, at in zip(strings, Suffixes(strings, length).repeated() if strings else ()):
            if len({p[:3] for p in places[body]}) > 1 or places[body][0][3]:
                rows += [(doc, alt, pos, pos + len(body)) for doc, pos, alt, _ in places[body]]
            elif len(at):
                a, b = merged(at, at + length)
                doc, pos, alt, _ = places[body][0]
                rows += [(doc, alt, pos + x, pos + y) for x, y in zip(a.tolist(), b.tolist())]
        return batch_of(rows)

    for batch in batches:
        known = []
        for row in batch.to_pylist():
            if row["route"] != anchor:
                if held and held + mine > SHARD_BYTES:  # the key just ended opens the next shard
                    yield flush()
                    places, held = {}, 0
                for body, at in own.items():
                    places.setdefault(body, []).extend(at)
                anchor, held, own, mine = row["route"], held + mine, {}, 0
            if not row["body"]:
                known.append((row["doc"], row["alt"], row["pos"], row["pos"] + row["size"]))
                continue
            at = own.setdefault(row["body"], [])
            if not at:
                mine += len(row["body"])
            at.append((row["doc"], row["pos"], row["alt"], row["known"]))
        if known:
            yield batch_of(known)
    if held + mine > SHARD_BYTES and held:
        yield flush()
        places = {}
    for body, at in own.items():
        places.setdefault(body, []).extend(at)
    yield flush()


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
          crowd: int = CROWD_BYTES) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row;
    kept holds the remaining bytes, or null where they are all or none."""
    rows = documents(docs, doc_id, text)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha = [hashlib.sha256(t.as_buffer()).hexdigest() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("alt"), batch.column("n_bytes"),
                                              pa.array(sha)], ["doc", "alt", "n_bytes", "sha"])

    table = stored(rows.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(
        measure, "doc bigint, alt bigint, n_bytes bigint, sha string"))
    repeated = stored(copies(table.where(F.col("n_bytes") >= length)))
    member = join_measured(table, repeated, ["sha"], "inner", 120)
    member = stored(member.select("doc", "alt", (F.struct("doc", "alt") != F.col("first")).alias("later")).distinct())
    single = join_measured(rows, member.where("later").select("doc", "alt"), ["doc", "alt"], "left_anti", 16)
    single = single.where(F.octet_length("text") >= length)

    def anchor_rows(batch: pa.RecordBatch):
        for doc, alt, body in zip(*(batch.column(c) for c in ("doc", "alt", "text"))):
            first, _, h = segments(body.as_py().encode(), length)
            yield place(doc.as_py(), alt.as_py(), first) | {"route": h.view(np.int64)}

    shared = single.mapInArrow(lambda b: combined(b, anchor_rows, ["route"]),
                               f"route bigint, {PLACE_KINDS}, first boolean, known boolean")
    shared = stored(met(shared, ["route"], later_only=False))
    held = join_measured(single, shared, ["doc", "alt"], "inner", F.size("positions") * 4 + 56)
    pieces = uncrowded(stored(held.mapInArrow(lambda b: _segment_rows(b, length), KINDS)), length, crowd)
    dealt = pieces.repartition("route").sortWithinPartitions("route")
    found = dealt.mapInArrow(lambda b: _sorted_shards(b, length), "doc bigint, alt bigint, start bigint, end bigint")
    again = found.groupBy("doc", "alt").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    again = stored(again.mapInArrow(_merged_spans, "doc bigint, alt bigint, start array<bigint>, end array<bigint>"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, start, end, copy in zip(*(batch.column(c) for c in ("text", "start", "end", "copy"))):
                body, a, b = text.as_buffer(), start.as_py(), end.as_py()
                n = body.size
                if copy.as_py():
                    out.append((n, n, 1, EMPTY_SHA256, None))
                elif a is None:
                    out.append((n, 0, 0, hashlib.sha256(body).hexdigest(), None))
                else:
                    view = memoryview(body)
                    kept = b"".join([view[x:y] for x, y in zip([0, *b], [*a, n])])
                    out.append((n, n - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept or None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = join_measured(rows, again, ["doc", "alt"], "left", F.size("start") * 16 + 72)
    whole = stored(member.select("doc", "alt", F.lit(True).alias("copy")).distinct())
    out = join_measured(out, whole, ["doc", "alt"], "left", 32)
    return out.mapInArrow(
        cut, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def op1_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(F.nullif("doc", F.lit(LAST)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
