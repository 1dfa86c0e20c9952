"""Mixing sources to target weights along a time-varying curriculum.

Sources in code-point order (null last) weigh 5, 2, 1, repeating. They share
150 % of all words by weight; a target stops at twice its source's words and
the excess is shared again by weight. Along the training time t in [0, 1] a
source's weight runs linearly from (1 + tilt) to (1 - tilt) times its mean,
so its integrated demand is target * (t + tilt * t * (1 - t)); tilts alternate
over the sources from +TILT to -TILT, so that the mix changes while each
source still meets its target. A document's place in its source's
(shuffled) stream is a demand, and the inverse of the integral is its
training position. Documents are range-sorted by position.

A source's stream passes over its documents once, then again; it ends at the
target, so the document at the end may be taken in part.

Defined cases: a null text has size 0; a null source is the last source;
rows may repeat, each is a document of its own (equal rows are summed as one,
then told apart by their number); a source without words has
target 0; no rows give no rows. Reruns agree: the shuffle is a hash of doc_id
and text, and equal rows share what they take in any order.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import join_measured, read, stored, words
from vendorlens.plans.sizing import number_rows

WEIGHTS = [5.0, 2.0, 1.0]
SHARE = 1.5
MOST = 2.0
TILT = 0.5
# Documents in one bucket of a source's stream: the window that sums inside a
# bucket holds about this many rows, whatever the size of the source; and equal
# rows that are told apart in one step.
BUCKET_ROWS = 4096
COPIES = 1024


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add ``weight``, ``tilt`` and ``target`` to (source, source_size).

    A target is min(most * source_size, weight * level). Each round raises
    the level to what the sources below their stop must share, until no more
    sources reach their stop; a round is one aggregate over the sources."""
    null_last = sizes.withColumn("is_null", F.col("source").isNull())
    numbered = stored(number_rows(null_last, ["is_null", "source"], "rank", 0))
    i = F.col("rank") % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (i + 1).cast("int"))
    table = numbered.withColumn("weight", weight).withColumn("stop", F.lit(most) * F.col("source_size"))
    wanted = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        at_stop = F.col("stop") <= F.col("weight") * F.lit(level)
        n, fixed, open_weight = table.agg(
            F.count(F.when(at_stop, 1)), F.coalesce(F.sum(F.when(at_stop, F.col("stop"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~at_stop, F.col("weight"))), F.lit(0.0))).first()
        if n == stopped or not open_weight:
            break
        stopped, level = n, (wanted - fixed) / open_weight
    target = F.when(at_stop, F.col("stop")).otherwise(F.col("weight") * F.lit(level))
    tilt = F.when(F.col("rank") % 2 == 0, F.lit(TILT)).otherwise(F.lit(-TILT))
    return table.select("source", "source_size", "weight", tilt.alias("tilt"), target.alias("target"))


def demand(t: Column, target: Column, tilt: Column) -> Column:
    """Words a source has given by training time t."""
    return target * (t + tilt * t * (1 - t))


def training_time(place: Column, target: Column, tilt: Column) -> Column:
    """Inverse of ``demand``: the root in [0, 1] of tilt t^2 - (1 + tilt) t + place / target."""
    u, b = place / target, 1 + tilt
    return 2 * u / (b + F.sqrt(F.greatest(b * b - 4 * tilt * u, F.lit(0.0))))


def place(docs: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From (source, size, order hash ``shuffle``, payload ...) to the same
    rows with source_size, target, tilt, ``before`` (words before the row in
    one pass over its source) and ``taken``.

    The running sum is taken in two steps, so that a source with a third of
    all rows is summed by many tasks: sums per (source, bucket of the shuffle
    hash), a running sum over those, then one inside each bucket."""
    payload = docs.columns
    docs = docs.groupBy(*payload).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("words", F.col("size") * F.col("n_rows"))
    docs = stored(docs)
    buckets = max(1, ceil(docs.count() / BUCKET_ROWS))
    docs = docs.withColumn("bucket", F.pmod("shuffle", F.lit(buckets)))
    sums = docs.groupBy("source", "bucket").agg(F.sum("words").alias("words")).withColumn(
        "base", F.expr("coalesce(sum(words) OVER (PARTITION BY source ORDER BY bucket "
                       "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"))
    sums = stored(sums.drop("words"))
    table = stored(targets(docs.groupBy("source").agg(F.sum("words").alias("source_size")), share, most))
    # null sources meet by a key that is never null
    key = lambda c: F.coalesce(F.concat(F.lit("s"), F.col(c)), F.lit("n"))
    keyed = lambda df: df.withColumn("key", key("source")).drop("source")
    both = join_measured(keyed(sums), keyed(table), ["key"], "inner", F.length("key") + 48)
    both = stored(both.select("key", "bucket", "base", "source_size", "target", "tilt"))
    out = docs.withColumn("key", key("source"))
    out = join_measured(out, both, ["key", "bucket"], "inner", F.length("key") + 64)
    out = out.withColumn("before", F.col("base") + F.expr(
        "coalesce(sum(words) OVER (PARTITION BY key, bucket ORDER BY shuffle, tie "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"))
    # equal rows apart again: some thousand at a time, dealt to all tasks
    many = F.lit(COPIES).cast("long")
    out = out.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1, many))).repartition("shuffle", "at")
    upto = F.least(F.col("at") + many, F.col("n_rows")) - 1
    out = out.withColumn("copy", F.explode(F.sequence("at", upto))).withColumn(
        "before", F.col("before") + F.col("copy") * F.col("size"))
    taken = sum((taken_in_pass(k) for k in range(1, ceil(most))), taken_in_pass(0))
    return out.withColumn("taken", taken).select(*payload, "source_size", "target", "tilt", "before", "taken")


def taken_in_pass(k: int) -> Column:
    """Words of the row that pass k (from 0) takes; targets are met to the
    word, rounded down."""
    end = F.floor("target") - F.lit(k) * F.col("source_size") - F.col("before")
    return F.least(F.greatest(end, F.lit(0).cast("long")), F.col("size"))


def passes(placed: DataFrame, most: float = MOST) -> DataFrame:
    """One row per pass that takes any words of a row: adds ``pass``,
    ``pass_words`` and ``position`` (training time of its first word)."""
    takes = F.array(*[F.struct(F.lit(k).alias("k"), taken_in_pass(k).alias("n")) for k in range(ceil(most))])
    out = placed.withColumn("take", F.explode(F.filter(takes, lambda x: x["n"] > 0)))
    start = F.col("take.k") * F.col("source_size") + F.col("before")
    return (out.withColumn("pass", F.col("take.k")).withColumn("pass_words", F.col("take.n"))
               .withColumn("position", training_time(start, F.col("target"), F.col("tilt"))).drop("take"))


def sorted_by_position(df: DataFrame, *ties: str) -> DataFrame:
    """Range partitions by training position, sorted inside: the files of a
    written result are the training order."""
    order = ["position", *ties]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def shuffled(docs: DataFrame, doc_id: str, text: str, source: str, hashed: list[str]) -> DataFrame:
    """(source, size, shuffle, tie) of every row; ``shuffle`` hashes the
    columns ``hashed``, ``tie`` is the doc_id as text."""
    col = lambda c: F.col(f"`{c}`")
    return docs.select(
        col(source).alias("source"), F.size(words(col(text))).cast("long").alias("size"),
        F.xxhash64(*map(col, hashed)).alias("shuffle"),
        F.coalesce(col(doc_id).cast("string"), F.lit("null")).alias("tie"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mixed corpus: the rows of ``docs`` (same columns) as often as they
    are taken, in training order. A document taken in part keeps its first
    words, joined by single spaces.

    The plan is made from sizes alone; the texts join it by a hash of the
    whole row and the doc_id, and move once, when they are range-sorted. Equal
    rows are one row with several places in the plan."""
    names = [f for f, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    keyed = shuffled(docs, doc_id, text, source, names)
    plan = passes(place(stored(keyed), share, most), most)
    plan = stored(plan.select("shuffle", "tie", "size", "pass", "pass_words", "position"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("shuffle"),
                       F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")).alias("tie"))
    repeats = plan.groupBy("shuffle", "tie", "pass").count().where("count > 1").limit(1).count()
    if repeats:
        rows = rows.dropDuplicates(["shuffle", "tie"])
    out = join_measured(rows, plan, ["shuffle", "tie"], "inner", F.length("tie") + 56)
    body = F.col(f"row.`{text}`")
    cut = F.when(F.col("pass_words") < F.col("size"), F.array_join(
        F.slice(words(body), 1, F.col("pass_words").cast("int")), " ")).otherwise(body)
    out = sorted_by_position(out.withColumn("cut", cut), "tie", "pass")
    return out.select(*[F.col("cut").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op9_curriculum_mix(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    sizes = shuffled(docs, "doc_id", "text", "source", ["doc_id", "text"])
    placed = place(stored(sizes.withColumn("doc_id", F.expr("CASE WHEN tie <> 'null' THEN CAST(tie AS BIGINT) END"))))
    for k, name in enumerate(["position", "second_position"]):  # of a document's first word in each pass
        start = F.lit(k) * F.col("source_size") + F.col("before")
        placed = placed.withColumn(name, F.when(
            taken_in_pass(k) > 0, training_time(start, F.col("target"), F.col("tilt"))))
    return sorted_by_position(placed, "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "position", "second_position")
