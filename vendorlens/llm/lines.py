"""Line dedup: a line goes if an equal or nearly equal line stands earlier.

Lines are compared without white space at their ends. A line with a word goes
if it stands earlier exactly; one of at least 20 characters also if it stands
earlier nearly, that is with an edit distance of at most 2 (in shorter lines,
two edits are a large part). Every such line is cut into three segments, of which two edits leave one whole:
a line is indexed under (its length, segment number, segment) and probes the
segments of lines up to two characters shorter at the few places where such
edits can have moved them. Lines that meet under a key are verified by banded
bit-parallel edit distance, each against the earlier ones until one is near.

Equal lines are found first, combined inside each task before they are
shuffled, so that a line that a third of all documents share is one row per
task, and the join sees every different line once. A key with very many
different lines is dealt to several tasks, part against part.

Order is (doc_id, line number); a null doc_id is last, and rows that repeat a
doc_id with other texts follow by line number, then a hash of the text. Rows
equal in doc_id and text are one document, with one answer. A null text has no
lines and stays null; an empty one has one empty line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import join_measured, read, stored
from vendorlens.llm.edits import within
from vendorlens.llm.texts import LAST, PLACE, PLACE_KINDS, combined, documents, met, place, positions_of

MIN_CHARS = 20
EDITS = 2
# Lines that one task compares under one key, rows and bytes that it settles
# together, pairs that it looks at together, keys that it sends together, and
# hashes of lines that it remembers to have sent.
BLOCK = 2048
GROUP_ROWS, GROUP_BYTES = 8192, 4 << 20
PAIRS = 1 << 18
KEYS = 1 << 16
SEEN = 100_000
WHITE = " \t\n\x0b\x0c\r"


def cut(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of the segments of a line of ``length``, the longer last."""
    small, long_ = length // parts, length % parts
    out, at = [], 0
    for i in range(parts):
        size = small + (i >= parts - long_)
        out.append((at, size))
        at += size
    return out


def probes(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(indexed length, segment, start, size) of the substrings that a line of
    ``length`` looks up. A segment can only be met at a start that leaves few
    enough edits for both sides of it."""
    out = []
    for shorter in range(edits + 1):
        indexed = length - shorter
        for i, (at, size) in enumerate(cut(indexed, edits + 1)):
            low = max(0, at - i, at + shorter - (edits - i))
            high = min(length - size, at + i, at + shorter + (edits - i))
            out += [(indexed, i, start, size) for start in range(low, high + 1)]
    return out


class Keys:
    """Index and probe keys of lines; the places for a length are kept."""

    def __init__(self, edits: int):
        self.edits, self.plans = edits, {}

    def __call__(self, line: str) -> tuple[list[int], list[int]]:
        n = len(line)
        if n not in self.plans:
            number = lambda length, i: length * (self.edits + 1) + i
            self.plans[n] = ([(number(n, i), a, a + s) for i, (a, s) in enumerate(cut(n, self.edits + 1))],
                             [(number(l, i), a, a + s) for l, i, a, s in probes(n, self.edits)])
        h = xxhash.xxh3_64_intdigest
        index, probe = self.plans[n]
        index = [h(line[a:b], seed) for seed, a, b in index]
        return index, list({h(line[a:b], seed) for seed, a, b in probe}.difference(index))


def judged(text: str, min_chars: int) -> Iterator[tuple[int, str]]:
    """(number, stripped line) of the lines that count."""
    for i, line in enumerate(text.split("\n")):
        line = line.strip(WHITE)
        if len(line) >= min_chars:
            yield i, line


def _occurrences(batch: pa.RecordBatch) -> Iterator[dict]:
    digest = xxhash.xxh3_128_digest
    for doc, alt, text in zip(*(batch.column(c) for c in ("doc", "alt", "text"))):
        found = list(judged(text.as_py(), 1))
        if found:
            high, low = np.frombuffer(b"".join([digest(line) for _, line in found]), "<i8").reshape(-1, 2).T
            number = np.array([i for i, _ in found], np.int64)
            yield place(doc.as_py(), alt.as_py(), number) | {"route": high, "low": low}


def _keyed(batches: Iterator[pa.RecordBatch], min_chars: int, edits: int) -> Iterator[pa.RecordBatch]:
    """(key, line, indexed) of the lines of a task, each different line once in
    a while; ``line`` is a hash of it. A line has a key once."""
    keys, seen = Keys(edits), set()
    key, line_of, indexed = [], [], []

    def send() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(np.array(line_of, np.int64)),
             pa.array(indexed, pa.bool_())], ["key", "line", "indexed"])
        key.clear(), line_of.clear(), indexed.clear()
        return out

    for batch in batches:
        for text in batch.column("text"):
            for _, line in judged(text.as_py(), min_chars):
                name = int.from_bytes(xxhash.xxh3_128_digest(line)[:8], "little", signed=True)
                if name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                index, probe = keys(line)
                key += index
                key += probe
                line_of += [name] * (len(index) + len(probe))
                indexed += [True] * len(index) + [False] * len(probe)
                if len(key) >= KEYS:
                    yield send()
    if key:
        yield send()


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, line) where several lines meet under a key, one at least indexed.
    Rows come by key, indexed ones first, then by line. However many lines a
    key has, only its first is held until a second comes."""
    key = line = first = None  # the last row's, and a first line that still is alone
    anchored = several = False
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        k, l, i = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "line", "indexed"))
        start = np.append(key is None or k[0] != key, k[1:] != k[:-1])
        new = start | np.append(line is None or l[0] != line, l[1:] != l[:-1])
        group = np.cumsum(start)  # 0: the key of the batch before
        heads = np.flatnonzero(start)
        held = np.append(anchored, i[heads])
        lines = np.bincount(group, new, minlength=len(heads) + 1)
        lines[0] += several * 2 + (first is not None)
        out = new & (held & (lines > 1))[group]
        keys, found = k[out], l[out]
        if first is not None and held[0] and lines[0] > 1:
            keys, found = np.append(key, keys), np.append(first, found)
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.int64())], ["key", "line"])
        key, line, anchored, several = k[-1], l[-1], bool(held[-1]), bool(lines[-1] > 1)
        if several:
            first = None
        elif len(heads):
            first = l[heads[-1]]


def _too_different(counts: np.ndarray, a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    """True where the letters of two lines alone show more than ``edits``."""
    out = np.empty(len(a), bool)
    for i in range(0, len(a), 1 << 16):
        gap = counts[a[i:i + (1 << 16)]] - counts[b[i:i + (1 << 16)]]
        more, fewer = np.maximum(gap, 0).sum(1), np.maximum(-gap, 0).sum(1)
        out[i:i + (1 << 16)] = np.maximum(more, fewer) > edits
    return out


def later_near(lines: list[str], group: np.ndarray, edits: int) -> np.ndarray:
    """True for every line with an earlier one of its group within ``edits``.
    Lines come by group, in order. All lines not yet settled are compared with
    the first of their group, then with the next two, the next four and so on:
    lines of one group are mostly near its first ones."""
    n = len(lines)
    near = np.zeros(n, bool)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    start = starts[np.searchsorted(starts, np.arange(n), "right") - 1]
    size = np.fromiter(map(len, lines), np.int64, n)
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.bincount(np.repeat(np.arange(n) * 32, size) + codes % 32, minlength=32 * n).reshape(n, 32).astype(np.int32)
    low, high = 0, 1
    while True:
        waiting = np.flatnonzero(~near & (np.arange(n) - start > low))
        if not len(waiting):
            return near
        for i in range(0, len(waiting), max(1, PAIRS // (high - low))):  # bounded, however large the groups
            part = waiting[i:i + max(1, PAIRS // (high - low))]
            many = np.minimum(part - start[part], high) - low
            a = np.repeat(part, many)
            b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + start[a] + low
            fit = np.abs(size[a] - size[b]) <= edits
            a, b = a[fit], b[fit]
            fit = ~_too_different(counts, a, b, edits)
            a, b = a[fit], b[fit]
            near[a[within([lines[x] for x in a], [lines[x] for x in b], edits)]] = True
        low, high = high, 2 * high + 1


def _verified(batches: Iterator[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """Places of first occurrences that have an earlier near line. Rows come
    sorted by (key, sub, doc, pos, alt); groups are settled many at a time."""
    held: list[pa.RecordBatch] = []
    size = 0

    def settle(table: pa.Table) -> pa.RecordBatch:
        key, sub = table["key"].to_numpy(), table["sub"].to_numpy()
        group = np.cumsum(np.append(False, (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])))
        near = later_near(table["body"].to_pylist(), group, edits)
        return pa.RecordBatch.from_arrays([pa.array(table[c].to_numpy()[near]) for c in PLACE], list(PLACE))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if sum(b.num_rows for b in held) < GROUP_ROWS and size < GROUP_BYTES:
            continue
        table = pa.Table.from_batches(held)
        key, sub = table["key"].to_numpy(), table["sub"].to_numpy()
        last = np.flatnonzero((key != key[-1]) | (sub != sub[-1]))  # the last group may go on
        cut_at = int(last[-1]) + 1 if len(last) else 0
        if cut_at:
            yield settle(table.slice(0, cut_at))
            held = table.slice(cut_at).to_batches()
            size = sum(b.nbytes for b in held)
    if held:
        yield settle(pa.Table.from_batches(held))


def removed_lines(rows: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS, block: int = BLOCK) -> DataFrame:
    """(doc, alt, positions): numbers of the lines to remove, for documents
    (doc, alt, text) that lose any. ``min_chars`` is the least length of a line
    that is compared beyond equality."""
    kinds = f"route bigint, low bigint, {PLACE_KINDS}, first boolean, known boolean"
    places = stored(rows.mapInArrow(lambda b: combined(
        b, _occurrences, ["route", "low"]), kinds))
    repeats = met(places, ["route", "low"], later_only=True)

    keyed = rows.mapInArrow(lambda b: _keyed(b, min_chars, edits), "key bigint, line bigint, indexed boolean")
    meetings = stored(keyed.repartition("key").sortWithinPartitions("key", F.desc("indexed"), "line").mapInArrow(
        _meetings, "key bigint, line bigint"))
    wanted = stored(meetings.select("line").distinct())
    # a line's first place, and that document's line as its text
    first = places.where("first").withColumnRenamed("route", "line").groupBy("line", "low").agg(
        F.min(F.struct(*PLACE)).alias("place"))
    first = join_measured(first, wanted, ["line"], "left_semi", 8).select("line", "low", "place.*")
    first = stored(first)
    of_doc = stored(first.groupBy("doc", "alt").agg(
        F.collect_list(F.struct("line", "pos")).alias("lines")))
    texts = join_measured(rows, of_doc, ["doc", "alt"], "inner", F.size("lines") * 40 + 56).dropDuplicates(["doc", "alt"])
    texts = texts.withColumn("all", F.split("text", "\n"))
    body = lambda x: F.when(x["pos"] < F.size("all"), F.get("all", x["pos"]))
    texts = texts.select("doc", "alt", F.explode(F.transform("lines", lambda x: F.struct(
        x["line"].alias("line"), x["pos"].alias("pos"), F.trim(body(x), F.lit(WHITE)).alias("body")))).alias("l")).select(
        "l.line", "doc", "l.pos", "alt", "l.body")
    texts = stored(texts)

    many = stored(meetings.groupBy("key").count().where(F.col("count") > block).select(
        "key", F.ceil(F.col("count") / block).cast("int").alias("parts")))
    met_lines = meetings.withColumn("sub", F.lit(0))
    if not many.isEmpty():
        met_lines = meetings.join(many, "key", "left")
        parts = F.coalesce("parts", F.lit(1))
        own = F.pmod(F.xxhash64("line"), parts).cast("int")
        pairs = F.transform(F.filter(F.sequence(F.lit(0), parts - 1), lambda j: (j != own) | (parts == 1)),
                            lambda j: F.least(own, j) * parts + F.greatest(own, j))
        met_lines = met_lines.select("key", "line", F.explode(pairs).alias("sub"))
    grouped = join_measured(met_lines, texts, ["line"], "inner", F.octet_length("body") + 48)
    near = grouped.select("key", "sub", *PLACE, "body").repartition("key", "sub").sortWithinPartitions(
        "key", "sub", *PLACE).mapInArrow(lambda b: _verified(b, edits), PLACE_KINDS)
    near = positions_of(near)
    both = repeats.unionByName(near).groupBy("doc", "alt").agg(
        F.array_distinct(F.flatten(F.collect_list("positions"))).alias("positions"))
    return stored(both)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
          edits: int = EDITS) -> DataFrame:
    """The rows of ``docs`` (same columns, same number) with their text
    without the removed lines, and the column n_removed_lines."""
    removed = removed_lines(documents(docs, doc_id, text), min_chars, edits)
    keyed = documents(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                  F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("body")), "id", "body", "row")
    out = join_measured(keyed, removed, ["doc", "alt"], "left", F.size("positions") * 4 + 56)
    out = out.withColumn("lines", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "positions")
    kept = F.array_join(F.transform(left, lambda i: F.when(i < F.size("lines"), F.get("lines", i))), "\n")
    body = F.when(F.col("positions").isNull(), F.col(f"row.`{text}`")).otherwise(kept)
    return out.select(*[body.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns],
                      F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_removed_lines"))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed_lines and the remaining text's checksum."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    out = dedup(docs.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")))
    return out.select("doc_id", "n_lines", "n_removed_lines",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
