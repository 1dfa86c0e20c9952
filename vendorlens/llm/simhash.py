"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in at most d bits are cut into d // 2 + 1 segments,
so that at least one segment differs in at most one bit. Every segment is
indexed once for each of its bits, with that bit deleted; fingerprints that
meet under a key are verified on all 64 bits. Copies share a fingerprint and
are one node. Under a key, only a spanning forest of the verified links
leaves the task; a key with very many fingerprints is dealt to several tasks,
block against block. Connected components are found on Spark.

Defined cases: a null or empty text has no words and fingerprint zero, linked
like any other; null doc_ids take part, and a component's id is its smallest
doc_id that is not null (null if there is none); rows may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import join_measured, read, stored, with_workers
from vendorlens.llm.components import components
from vendorlens.llm.runs import whole_runs

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Fingerprints that a task verifies together. Keys with more are dealt out.
BLOCK = 4096


def fingerprint(text: str, shingle: int) -> int:
    """64 majority bits of the shingles' hashes, as a signed number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    body, width = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends[:len(words) - width + 1] - [len(w) + 1 for w in words[:len(words) - width + 1]]).tolist()
    hashed = xxhash.xxh64_intdigest
    hashes = np.array([hashed(body[a:b], SEED) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):  # 4 MB of bits at a time
        ones += np.unpackbits(hashes[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp): th is a hash of the text that tells rows of one
    doc_id apart."""
    with_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py() or "", shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(fps, pa.int64())], ["doc_id", "th", "fp"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("th"),
                       F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, th bigint, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def segments(max_bits: int) -> list[tuple[int, int]]:
    """Bit ranges [low, high) of the segments."""
    n = max_bits // 2 + 1
    return [(64 * i // n, 64 * (i + 1) // n) for i in range(n)]


def variants(fp: Column, max_bits: int) -> Column:
    """The keys of a fingerprint: for every bit, a hash of that bit's place
    and of its segment without it."""
    keys = []
    for low, high in segments(max_bits):
        part = (1 << high) - (1 << low)
        keys += [F.xxhash64(F.lit(bit), fp.bitwiseAND(F.lit(_signed(part & ~(1 << bit))))) for bit in range(low, high)]
    return F.array(*keys)


def crowded_keys(fps: DataFrame, max_bits: int, block: int) -> DataFrame | None:
    """(key, parts) of keys that may hold more than ``block`` fingerprints, or
    None. A key joins two values of a segment, so only values with over half a
    block count; they are counted by a pre-aggregated sum."""
    values = F.array(*[F.struct(F.lit(low).alias("low"), F.col("fp").bitwiseAND(
        F.lit(_signed((1 << high) - (1 << low)))).alias("value")) for low, high in segments(max_bits)])
    many = stored(fps.select(F.explode(values).alias("s")).groupBy("s.low", "s.value").count()
                     .where(F.col("count") > block // 2))
    if many.isEmpty():
        return None
    keys = None
    for low, high in segments(max_bits):
        of_segment = F.array(*[F.xxhash64(F.lit(bit), F.col("value").bitwiseAND(F.lit(_signed(~(1 << bit) & (1 << 64) - 1))))
                               for bit in range(low, high)])
        part = many.where(F.col("low") == low).select(F.explode(of_segment).alias("key"), "count")
        keys = part if keys is None else keys.unionByName(part)
    return stored(keys.groupBy("key").agg(F.ceil((F.sum("count") + block // 2) / block).cast("int").alias("parts")))


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which signed fingerprints differ (a count of a signed number's
    bits would be that of its absolute value)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, breadth
    first over those not reached yet."""
    edges, waiting = [], fps
    while len(waiting):
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            one = queue.pop()
            near = differing(waiting, one) <= max_bits
            if near.any():
                reached = waiting[near]
                edges += [(int(one), x) for x in reached.tolist()]
                queue.extend(reached)
                waiting = waiting[~near]
    return edges


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp``: a spanning forest of
    all pairs that differ in at most ``max_bits`` bits."""
    rows = fps.select("fp", F.explode(variants(F.col("fp"), max_bits)).alias("key"))
    crowded = crowded_keys(fps, max_bits, block)
    if crowded is None:
        rows = rows.withColumn("sub", F.lit(0))
    else:
        # a crowded key's parts meet two by two; each pair of parts is one group
        rows = rows.join(crowded, "key", "left")
        parts, own = F.coalesce("parts", F.lit(1)), F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
        pairs = F.transform(F.filter(F.sequence(F.lit(0), parts - 1), lambda j: (j != own) | (parts == 1)),
                            lambda j: F.least(own, j) * parts + F.greatest(own, j))
        rows = rows.select("fp", "key", F.explode(pairs).alias("sub"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in whole_runs(batches, ["key", "sub"]):
            fp = run["fp"]
            same = run.same_as_last()
            near = differing(fp[1:], fp[:-1]) <= max_bits
            chained = same[1:] & near
            a, b = [fp[:-1][chained]], [fp[1:][chained]]
            # groups of three or more that neighbours in order don't link throughout
            broken = np.flatnonzero(same[1:] & ~near) + 1
            firsts = np.flatnonzero(~same)
            ends = np.append(firsts[1:], len(fp))
            for g in np.unique(np.searchsorted(firsts, broken, "right") - 1):
                if ends[g] - firsts[g] > 2:
                    edges = forest(fp[firsts[g]:ends[g]], max_bits)
                    a.append(np.array([e[0] for e in edges], np.int64))
                    b.append(np.array([e[1] for e in edges], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    grouped = rows.repartition("key", "sub").sortWithinPartitions("key", "sub", "fp")
    return grouped.mapInArrow(verify, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(documents, nodes): (doc_id, th, fp) of every row, and for every
    fingerprint (fp, root, component_id, keeper): the smallest doc_id of its
    component, and the (is null, doc_id, th) that comes first."""
    table = stored(fingerprints(docs, doc_id, text, shingle))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("th"))
    nodes = stored(table.groupBy("fp").agg(F.min(first).alias("first")))
    roots = components(links(nodes.select("fp"), max_bits))
    nodes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("first").alias("keeper"))
    nodes = nodes.join(least, "root").select("fp", "root", F.col("keeper.doc_id").alias("component_id"), "keeper")
    return table, stored(nodes)


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (same columns) without near-duplicates: of each
    component the row with the smallest doc_id stays."""
    table, nodes = near_duplicates(docs, doc_id, text, shingle, max_bits)
    as_key = F.coalesce(F.col("keeper.doc_id").cast("string"), F.lit("null"))
    keep = stored(nodes.select(as_key.alias("id"), F.col("keeper.th").alias("th")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")).alias("id"),
                       F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("th"))
    kept = join_measured(rows, keep, ["id", "th"], "left_semi", F.length("id") + 24)
    own = table.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), "th")
    if not own.groupBy("id", "th").count().where("count > 1").limit(1).isEmpty():
        kept = kept.dropDuplicates(["id", "th"])  # rows that repeat whole
    return kept.select("row.*")


def op4_simhash_components(spark, sf_dir: str) -> DataFrame:
    table, nodes = near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    out = join_measured(table, nodes.select("fp", "component_id"), ["fp"], "inner", 24)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
