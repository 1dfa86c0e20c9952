"""Trie of conversations' common prefixes, by digests of fixed-length blocks.

A conversation's turns are cut into blocks of four. One pass over its turns'
digests chains them, so a block is known by a digest of everything up to its
end. Conversations are grouped by these digests at all levels at once, in one
pre-aggregated count, so copies of a conversation are one row a task. Only
where a prefix is followed by several different blocks are these refined: each
different block (not each conversation) brings the digests at its turns'
boundaries, and these are grouped again. Elsewhere all turns of the block have
the same members and need no grouping.

A node's smallest member owns it. The nodes that one conversation owns are a
path down to its end, and each path hangs from a node of an earlier one, so
sums over subtrees are sums along paths; totals of paths are carried to the
paths above by doubling the distance in each round.

Defined cases: rows without a conv_id take no part; null role and text are
empty; turns are in order of turn (null first), then role, then the text's
first 64 characters, then its digest; repeated rows are turns of their own.
One conversation's digests (28 bytes a turn) go through one task in a stream,
since the chain is one; nothing of it is collected but the block at hand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vendorlens.llm.common import join_measured, read, stored, with_workers

# Turns in a block, and bytes of ids that are hashed together.
BLOCK = 4
IDS_BYTES = 1 << 16
DIGEST = 16
ROOT = bytes(DIGEST)


def digests(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, digest, chars): every turn's place in its conversation, a
    digest of role and text, and the text's code points."""
    said, by = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (text, role))
    whole = F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said)
    short = rows.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), by.alias("role"),
        F.left(said, F.lit(64)).alias("head"), F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST).alias("digest"),
        F.length(said).cast("long").alias("chars"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "head", "digest")
    return short.select("conv", (F.row_number().over(order) - 1).alias("pos"), "digest", "chars")


def shared_turns(conv: Column) -> Column:
    """How many turns a rebuilt conversation takes from its base."""
    return (F.crc32(conv.cast("string")) % 6).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convs, turns): every conversation's id, and its turns with the first
    ones taken from its base conversation. ``pos`` keeps the order; it may
    have a gap where the base is short."""
    convs = turns.select("conv").distinct()
    wanted = convs.select(F.col("conv").alias("to"), (F.col("conv") - F.col("conv") % 100).alias("conv"),
                          shared_turns(F.col("conv")).alias("n"))
    first = turns.where((F.col("conv") % 100 == 0) & (F.col("pos") < 5))
    taken = first.join(wanted, "conv").where("pos < n").select(F.col("to").alias("conv"), "pos", "digest", "chars")
    own = turns.where(F.col("pos") >= shared_turns(F.col("conv")))
    return convs, own.unionByName(taken)


def chained(ids: bytes, turns: bytes) -> bytes:
    return hashlib.sha256(ids + turns).digest()[:DIGEST]


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """One row for every block of every conversation: conv, level, the digests
    of the prefix before it and up to its end, its turns' digests and lengths,
    and whether the conversation ends in it. Rows come by (conv, pos)."""
    conv, level, before, held, chars = None, 0, ROOT, [], []
    names = ["conv", "level", "before", "after", "turns", "chars", "last"]
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.bool_())
    out: list[tuple] = []

    def close(last: bool) -> bytes:
        turns = b"".join(held)
        after = chained(before, turns)
        out.append((conv, level, before, after, turns, list(chars), last))
        held.clear(), chars.clear()
        return after

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        out.clear()
        return batch

    for batch in batches:
        for c, digest, n in zip(batch.column("conv").to_pylist(), batch.column("digest").to_pylist(),
                                batch.column("chars").to_pylist()):
            if c != conv:
                if held:
                    close(True)
                conv, level, before = c, 0, ROOT
            elif len(held) == block:  # known now not to be the last
                before = close(False)
                level += 1
            held.append(digest)
            chars.append(n)
        if len(out) >= 4096:
            yield flush()
    if held:
        close(True)
    if out:
        yield flush()


def _turn_ends(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """The nodes of different blocks: key, parent, depth and length of each turn."""
    names = ["key", "parent", "depth", "conv", "n", "chars", "shared"]
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            parent = row["before"]
            for t, chars in enumerate(row["chars"], 1):
                key = chained(row["before"], row["turns"][:t * DIGEST])
                out.append((key, parent, row["level"] * block + t, row["conv"], row["n"], chars, row["shared"]))
                parent = key
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def trie(convs: DataFrame, blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, parent, depth, conv, n, chars) of every node: its digest and its
    parent's, its smallest member, its members and its last turn's length."""
    different = stored(blocks.groupBy("after").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"),
        *[F.first(c).alias(c) for c in ("level", "before", "turns", "chars")]))
    # prefixes that several different blocks follow: only there do turns decide
    diverging = stored(different.groupBy("before").count().where("count > 1").select("before", F.lit(True).alias("shared")))
    marked = join_measured(different, diverging, ["before"], "left", 2 * DIGEST).withColumn(
        "shared", F.coalesce("shared", F.lit(False)))
    ends = marked.mapInArrow(
        lambda b: _turn_ends(b, block),
        "key binary, parent binary, depth bigint, conv bigint, n bigint, chars bigint, shared boolean")
    one = ["key", "parent", "depth", "conv", "n", "chars"]
    ends = stored(ends)
    refined = ends.where("shared").groupBy("key").agg(
        *[F.first(c).alias(c) for c in ("parent", "depth", "chars")], F.min("conv").alias("conv"), F.sum("n").alias("n"))
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where("n > 0").select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        "conv", "n", F.lit(0).cast("long").alias("chars"))
    return stored(ends.where("not shared").select(one).unionByName(refined.select(one)).unionByName(root))


def _id_texts(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of ids that end at a node, joined by commas: key, first id, text."""
    key, first, held, size = None, 0, [], 0
    out: list[tuple] = []
    for batch in batches:
        for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
            if k != key or size > limit:
                if held:
                    out.append((key, first, ",".join(held)))
                key, first, held, size = k, conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
        if out:
            yield _id_batch(out)
            out = []
    if held:
        yield _id_batch([(key, first, ",".join(held))])


def _id_batch(rows: list[tuple]) -> pa.RecordBatch:
    key, first, ids = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(first, pa.int64()), pa.array(ids)],
                                      ["key", "first", "ids"])


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A node's texts in order, as one digest."""
    key, digest = None, None
    out: list[tuple] = []
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k == key:
                digest.update(b",")
            else:
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "ends_sha256"])
            out = []
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])


def end_digests(ends: DataFrame, limit: int = IDS_BYTES) -> DataFrame:
    """(key, ends_sha256) from (key, conv): of a node's many ids, tasks join
    ranges into texts, and only those texts meet in the one digest."""
    texts = ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInArrow(
        lambda b: _id_texts(b, limit), "key binary, first bigint, ids string")
    return texts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        _id_digests, "key binary, ends_sha256 string")


def path_totals(paths: DataFrame) -> DataFrame:
    """(path, up, depth, leaves, saved) with leaves and saved summed over the
    path and all paths below. In each round a path adds the sums of those at
    the distance reached so far and then looks twice as far up."""
    now = stored(paths.withColumn("far", F.col("up")))
    while not now.where(F.col("far").isNotNull()).isEmpty():
        below = now.where(F.col("far").isNotNull()).groupBy(F.col("far").alias("path")).agg(
            F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        further = now.select(F.col("path").alias("far"), F.col("far").alias("next"))
        step = now.join(below, "path", "left").select(
            "path", "up", "depth", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), "far")
        now = stored(join_measured(step, stored(further), ["far"], "left", 16).select(
            "path", "up", "depth", "leaves", "saved", F.col("next").alias("far")))
    return now


def prefix_trie(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    with_workers(rows.sparkSession)
    convs, turns = rebuilt(stored(digests(rows, conv_id, turn, role, text)))
    convs = stored(convs)
    blocks = stored(turns.repartition("conv").sortWithinPartitions("conv", "pos").select("conv", "digest", "chars").mapInArrow(
        lambda b: _blocks(b, block), "conv bigint, level int, before binary, after binary, turns binary, "
                                     "chars array<bigint>, last boolean"))
    nodes = trie(convs, blocks, block)
    # the conversation that owns a node's parent; the root's children are many, and root is one row
    above = stored(nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children")).where("key IS NOT NULL"))
    counted = stored(join_measured(nodes, above, ["key"], "left", 24).withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    parents = stored(counted.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv")))
    placed = stored(join_measured(counted, parents, ["parent"], "left", 24).select(
        "key", "depth", "conv", "parent_conv", "n", "n_children", (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved")))
    # the path of the nodes that one conversation owns, and where it hangs
    paths = placed.groupBy(F.col("conv").alias("path")).agg(
        F.min(F.struct("depth", "parent_conv")).alias("top"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = path_totals(paths.select("path", F.col("top.parent_conv").alias("up"), (F.col("top.depth") - 1).alias("depth"),
                                      "leaves", "saved"))
    own = placed.select("conv", "depth", "leaves", "saved")
    hung = totals.where("up IS NOT NULL").select(F.col("up").alias("conv"), "depth", "leaves", "saved")
    down = Window.partitionBy("conv").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    sums = own.unionByName(hung).groupBy("conv", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    sums = sums.select("conv", "depth", F.sum("leaves").over(down).alias("n_leaves"), F.sum("saved").over(down).alias("saved_tokens"))
    ended = blocks.where("last").select(F.col("after").alias("key"), "conv")
    ended = ended.unionByName(convs.join(blocks.select("conv").distinct(), "conv", "left_anti").select(F.lit(ROOT).alias("key"), "conv"))
    out = placed.join(sums, ["conv", "depth"]).join(end_digests(ended), "key", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
                      F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


ORACLE = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
grouped AS (SELECT c, list([role, body] ORDER BY pos) AS turns FROM t GROUP BY c),
conv AS (
  SELECT c, turns,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda acc, b: list_reduce(list_prepend(xor(acc, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
                                     lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) % 6 AS h
  FROM grouped),
rebuilt AS (
  SELECT v.c, list_concat(coalesce(b.turns[:v.h], []), v.turns[v.h + 1:]) AS turns
  FROM conv v LEFT JOIN conv b ON b.c = v.c - v.c % 100),
prefix AS (
  SELECT c, n, depth, turns[:depth] AS key, coalesce(length(turns[depth][2]), 0) AS chars
  FROM (SELECT c, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt)),
node AS (
  SELECT key, depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256
  FROM prefix GROUP BY key, depth),
children AS (SELECT key[:depth - 1] AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
placed AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM node n LEFT JOIN children USING (key)),
up AS (SELECT key[:d] AS key, saved, n_children FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM placed)),
sums AS (SELECT key, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM up GROUP BY key)
SELECT p.conv_id, p.depth, q.conv_id AS parent_conv_id, p.n_convs, p.n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, p.ends_sha256
FROM placed p JOIN sums USING (key) LEFT JOIN node q ON q.key = p.key[:p.depth - 1] AND p.depth = q.depth + 1
"""
