"""Size-checked broadcasting and hot-key splitting.

A side is broadcast only after its row count has been measured: the small
side is first written to the shared checkpoint folder (which also cuts its
lineage, so the count and the join read the same stored rows instead of
recomputing an aggregate twice), counted, and broadcast when under the
limit.

Beyond the limit the join becomes a shuffle join in which a key with more than
``HOT_ROWS`` rows - a number of rows that a task can hold, not a share of the
table - is dealt to as many tasks as it needs: its rows of the large side get a
salt, its rows of the other side one copy for each salt. So no task receives a
hot key's rows whole, also where both sides repeat it. Rows without a key match
nothing and take no part in the shuffle. The result is exactly the join's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Broadcast limits for derived tables (dimension/category sized): rows, and
# estimated bytes (rows x per-row width from the schema; strings counted at
# their measured mean length).
DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
# Rows of one key that go to one task of a shuffle join.
HOT_ROWS = 500_000
# Joins whose hot/cold split keeps the result exact.
SPLITTABLE = {"inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "left_anti", "leftanti"}


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder named by the session."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    stored, n, _ = measure(df)
    return stored, n


def _width(t) -> int:
    from pyspark.sql import types as T

    if isinstance(t, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(t, T.ShortType):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    if isinstance(t, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    return 64  # nested values: a generous flat guess


def measure(df: DataFrame) -> tuple[DataFrame, int, float]:
    """Store ``df`` in the shared folder, then one aggregate over the stored
    rows gives the row count and the mean row width (fixed-width fields by
    type, strings and binaries by their measured mean length)."""
    from pyspark.sql import types as T

    stored = materialize(df)
    var = [f.name for f in stored.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = sum(_width(f.dataType) for f in stored.schema.fields if f.name not in var)
    row = stored.agg(F.count(F.lit(1)).alias("__n"),
                     *[F.avg(F.octet_length(F.col(f"`{c}`"))).alias(f"__l{i}") for i, c in enumerate(var)]).first()
    width = float(fixed + 8 + sum((row[f"__l{i}"] or 0.0) + 8 for i in range(len(var))))
    return stored, row["__n"], width


def fits_broadcast(n: int, row_bytes: float, max_rows: int = DEFAULT_MAX_ROWS,
                   max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """Row count within ``max_rows`` and estimated size within ``max_bytes``."""
    return n <= max_rows and n * row_bytes <= max_bytes


def join_small(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "inner",
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Join ``big`` with a side expected to be small; broadcast it only when
    its measured row count is at most ``max_rows``, else split hot keys."""
    small, n, width = measure(small)
    if fits_broadcast(n, width, max_rows):
        return big.join(F.broadcast(small), on, how)
    return skew_split_join(big, small, on, how, max_rows)


def _key_names(on) -> list[str] | None:
    if isinstance(on, str):
        return [on]
    if isinstance(on, (list, tuple)) and all(isinstance(k, str) for k in on):
        return list(on)
    return None


def skew_split_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
                    max_rows: int = DEFAULT_MAX_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Exact shuffle join of two large sides with the hot keys of ``big``
    salted (see module docstring). ``big`` is read twice, so it should be
    stored or a scan; its rows' salts come from their place in it. Falls back
    to a plain join (AQE's skew splitting) for expression conditions, or join
    types where the split would not be exact, or more hot keys than can be
    broadcast."""
    keys = _key_names(on)
    kind = how.lower().replace("_", "")
    if keys is None or how.lower() not in SPLITTABLE:
        return big.join(small, on, how)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(f"`{k}`").isNotNull()
    counts = big.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
    hot, n_hot, width = measure(counts.select(*keys, F.ceil(F.col("__n") / hot_rows).alias("__parts")))
    if n_hot and not fits_broadcast(n_hot, width, max_rows):
        return big.join(small, on, how)
    keyed = big.where(whole)
    if n_hot:
        hot_keys = F.broadcast(hot.select(*keys))
        salted = keyed.join(F.broadcast(hot), keys, "inner").withColumn(
            "__salt", F.pmod(F.monotonically_increasing_id(), F.col("__parts"))).drop("__parts")
        copies = small.join(F.broadcast(hot), keys, "inner").withColumn(
            "__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1))).drop("__parts")
        hot_part = salted.join(copies, [*keys, "__salt"], how).drop("__salt")
        cold = keyed.join(hot_keys, keys, "left_anti").join(small.join(hot_keys, keys, "left_anti"), on, how)
        out = cold.unionByName(hot_part)
    else:
        out = keyed.join(small, on, how)
    if kind in ("left", "leftouter", "leftanti"):  # rows without a key stay as they are
        out = out.unionByName(big.where(~whole), allowMissingColumns=True)
    return out


def scalars(agg_df: DataFrame):
    """Turn a one-row aggregate into a scalar subquery returning a struct of
    its columns; fields are read with ``.getField``. The planner runs it
    once and uses the value as a constant, so nothing is joined or
    broadcast."""
    return agg_df.select(F.struct(*agg_df.columns).alias("s")).scalar()


def ensure_parallelism(df: DataFrame, factor: int = 1) -> DataFrame:
    """Spread ``df`` over at least ``factor`` x the default parallelism when
    it arrives in fewer partitions (a small file with few row groups). On
    large inputs, which already have many more splits than cores, this adds
    nothing - no shuffle; it only keeps CPU-heavy per-row work (joins in one
    stage, row expansions) from running in one or two tasks."""
    want = max(1, df.sparkSession.sparkContext.defaultParallelism * factor)
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def number_rows(df: DataFrame, order: list[str], name: str = "row_id", start: int = 1) -> DataFrame:
    """Consecutive numbers in the total order of ``order`` (ties broken by
    the remaining columns), computed without a global window.

    The rows are range-partitioned and sorted within partitions, then
    stored (checkpoint), which fixes each partition's contents and order.
    One small aggregate counts rows per partition (one row per partition
    reaches the driver) to get each partition's offset; a row's number is
    its partition's offset plus its position inside the partition, read
    from ``monotonically_increasing_id`` (partition id in the upper bits,
    position in the lower 33)."""
    cols = list(order) + [c for c in df.columns if c not in order]
    parts = max(1, df.sparkSession.sparkContext.defaultParallelism)
    stored = materialize(df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols))
    tagged = stored.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    sizes = sorted((r["__pid"], r["n"]) for r in
                   tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, run = [], start
    for pid, n in sizes:
        offsets.append((pid, run))
        run += n
    off = F.broadcast(df.sparkSession.createDataFrame(offsets, "__pid int, __off long"))
    return tagged.join(off, "__pid").select(
        (F.col("__off") + F.col("__pos")).alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )
