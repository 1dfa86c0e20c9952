"""Profiling and previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import exact_quantiles_many
from ..plans.sizing import join_small
from .clean import null_counts, numeric_columns


def profile_shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def profile_dtypes(df: DataFrame) -> DataFrame:
    """(column, dtype) - schema metadata only."""
    spark = df.sparkSession
    return spark.createDataFrame(df.dtypes, "column string, dtype string")


def profile_nulls(df: DataFrame) -> DataFrame:
    """(column, null_count) for columns holding at least one null; one pass."""
    wide = null_counts(df).drop("__rows")
    cols = wide.columns
    if not cols:
        return wide
    long = wide.select(*[F.col(f"`{c}`").cast("long").alias(c) for c in cols]) \
        .unpivot([], cols, "column", "null_count")
    return long.where(F.col("null_count") > 0)


def profile_describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, q25, q50, q75, max per numeric column.
    Moments from one grouped aggregate over (column, value) cells;
    quantiles exact (a few passes for all columns together)."""
    cols = columns or numeric_columns(df)
    qs = exact_quantiles_many(df, {c: [0.25, 0.5, 0.75] for c in cols})
    vals = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    long = df.select(F.posexplode(vals).alias("k", "x"))
    moments = long.groupBy("k").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )
    names = df.sparkSession.createDataFrame(
        [(k, c, *qs[c]) for k, c in enumerate(cols)],
        "k int, column string, q25 double, q50 double, q75 double",
    )
    return names.join(F.broadcast(moments), "k", "left").select(
        "column", F.coalesce("count", F.lit(0)).cast("long").alias("count"), "mean", "std", "min",
        "q25", "q50", "q75", "max",
    )


def row_hashes(df: DataFrame) -> list:
    """Two 64-bit hashes of a whole row; which columns are null counts too."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return [F.xxhash64(F.lit(seed), nulls, *cols).alias(f"__h{seed}") for seed in (1, 2)]


def dup_rows(df: DataFrame) -> DataFrame:
    """Rows identical to an earlier row (one row, one count). Hashes of the
    rows are counted first; only rows whose hash repeats are compared whole."""
    hashed = df.select("*", *row_hashes(df))
    again = hashed.groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("__h1", "__h2")
    same = join_small(hashed, again, ["__h1", "__h2"], "left_semi")
    g = same.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def dup_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key repeats an earlier key; null keys count as equal."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_keys"))


def _slot_value(c, dt: T.DataType):
    """(slot, value): an injective encoding of the column's values as a long
    (i), a double (d) or a text (s)."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "i", c.cast("bigint")
    if isinstance(dt, T.BooleanType):
        return "i", c.cast("int").cast("bigint")
    if isinstance(dt, T.DecimalType) and dt.precision <= 18:
        # unscaled value: exact and a plain long
        return "i", (c * F.lit(10 ** dt.scale)).cast("bigint")
    if isinstance(dt, T.DateType):
        return "i", F.unix_date(c).cast("bigint")
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "d", c.cast("double")
    return "s", c.cast("string")


def profile_cardinality(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column, distinct_count) of non-null values, ascending.

    Exact: each column's values, encoded injectively as a long, a double or a
    text, are de-duplicated by themselves (map-side first, then one shuffle of
    the distinct values) and counted, so a task holds values of one column and
    reads no other. Every column is a pass of its own: ``df`` should be stored
    or a scan. ``approx`` uses HyperLogLog sketches in a single aggregate
    instead."""
    if approx:
        wide = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).cast("long").alias(c) for c in df.columns])
        long = wide.unpivot([], wide.columns, "column", "distinct_count")
        return long.orderBy("distinct_count", "column")
    parts = []
    for f in df.schema.fields:
        _, value = _slot_value(F.col(f"`{f.name}`"), f.dataType)
        values = df.select(value.alias("v")).where(F.col("v").isNotNull()).distinct()
        parts.append(values.agg(F.count(F.lit(1)).alias("distinct_count")).select(F.lit(f.name).alias("column"), "distinct_count"))
    return reduce(DataFrame.unionAll, parts).orderBy("distinct_count", "column")


def key_range_profile(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.min(key).alias("min_key"), F.max(key).alias("max_key"),
        F.count_distinct(key).alias("distinct_keys"), F.count(F.lit(1)).alias("row_count"),
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def band_distribution(scores: DataFrame, col: str = "risk_band") -> DataFrame:
    return scores.groupBy(col).agg(F.count(F.lit(1)).alias("vendors")).orderBy(F.desc("vendors"), col)


def preview_limit(df: DataFrame, columns: list[str], n: int = 10, where=None, order: list[str] | None = None) -> DataFrame:
    """First n rows under a stated order (a bare LIMIT is not repeatable)."""
    out = df.select(*columns)
    if where is not None:
        out = out.where(where)
    return out.orderBy(*(order or columns)).limit(n)


def preview_topn(df: DataFrame, by: str, n: int = 10, tie: list[str] | None = None) -> DataFrame:
    return df.orderBy(F.desc(by), *(tie or [])).limit(n)


# Size of a cardinality sketch (2^SKETCH_LOG slots): its standard error is about
# 0.8 / sqrt(2^SKETCH_LOG), 0.6 %.
SKETCH_LOG = 14
SKETCH_ERROR = 0.8 / 2 ** (SKETCH_LOG / 2)


def cardinality_sketches(df: DataFrame, by: list[str]) -> DataFrame:
    """(by, column, sketch): a mergeable sketch of every column's values for
    each group of rows, such as a month. Stored, they answer any union of
    groups; a new group adds its own sketches and no old row is read again."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in df.columns if c not in by]
    values = {}
    for c in cols:
        slot, value = _slot_value(F.col(f"`{c}`"), types[c])
        values[c] = value.cast("string") if slot == "d" else value
    wide = df.select(*[F.col(f"`{c}`") for c in by], *[v.alias(f"v{i}") for i, v in enumerate(values.values())]).groupBy(*by).agg(
        *[F.hll_sketch_agg(f"v{i}", F.lit(SKETCH_LOG)).alias(c) for i, c in enumerate(cols)])
    return wide.unpivot(by, cols, "column", "sketch")


def cardinality_from_sketches(sketches: DataFrame) -> DataFrame:
    """(column, distinct_count): estimates for all groups of stored sketches
    together, from the sketches alone."""
    return sketches.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"))
