"""Exploratory statistics: the data behind the histograms, density curves,
box plots and correlation heatmap (charts themselves are not drawn)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles_many
from ..plans.sizing import ensure_parallelism, join_small

# Metrics plotted by the reference (fixed values).
HIST_METRICS = ["lead_time_days", "sales_per_customer", "order_item_quantity", "delivery_delay_days"]
BOX_METRICS = ["sales_per_customer", "lead_time_days", "order_item_quantity", "spend_per_order"]
DEFAULT_BINS = 10
GRID_POINTS = 200
# Points that values are binned on before a density curve, units of a binned
# value's weight, and rows that a correlation's centre is taken from.
DENSITY_BINS = 1000
BIN_UNITS = 1 << 20
CENTRE_ROWS = 1000
WHISKER = 1.5


def melt(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, v) rows, v as double, nulls removed."""
    wide = df.select(*[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot([], metrics, "metric", "v").where(F.col("v").isNotNull())


def histogram(df: DataFrame, metrics: list[str] = HIST_METRICS, bins: int = DEFAULT_BINS) -> DataFrame:
    """Equal-width bin counts per metric between its min and max (the max
    falls in the last bin). One pass for the ranges, one for the counts."""
    long = melt(df, metrics)
    rng = long.groupBy("metric").agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    j = join_small(long, rng, "metric", "inner")
    width = F.col("mx") - F.col("mn")
    raw_bin = F.floor((F.col("v") - F.col("mn")) * F.lit(float(bins)) / width) + F.lit(1)
    b = F.when(width == 0, F.lit(1)).otherwise(F.least(raw_bin, F.lit(bins))).cast("int")
    g = j.groupBy("metric", b.alias("bucket"), "mn", "mx").agg(F.count(F.lit(1)).alias("n"))
    step = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    return g.select(
        "metric", "bucket",
        (F.col("mn") + (F.col("bucket") - 1) * step).alias("lower"),
        (F.col("mn") + F.col("bucket") * step).alias("upper"),
        "n",
    )


def binned(df: DataFrame, metrics: list[str], bins: int) -> tuple[DataFrame, DataFrame]:
    """(weights, ranges): linear binning of each metric on ``bins`` points from
    its min to its max. A value gives its two neighbouring points a share each,
    by nearness, in whole units of 1 / BIN_UNITS, so sums are exact in any
    order. At most ``bins`` rows a metric come out, whatever the values."""
    long = melt(df, metrics)
    ranges = long.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"), F.stddev_samp("v").alias("sd"))
    width = (F.col("mx") - F.col("mn")) / F.lit(float(bins - 1))
    at = F.when(F.col("mx") > F.col("mn"), (F.col("v") - F.col("mn")) / width).otherwise(F.lit(0.0))
    placed = join_small(long, ranges, "metric", "inner").select("metric", at.alias("at"))
    low = F.least(F.floor("at"), F.lit(bins - 1)).cast("int")
    share = F.round((F.col("at") - low) * F.lit(float(BIN_UNITS))).cast("long")
    both = placed.select("metric", F.explode(F.array(
        F.struct(low.alias("b"), (F.lit(BIN_UNITS) - share).alias("w")),
        F.struct((low + 1).alias("b"), share.alias("w")))).alias("p")).where("p.w > 0")
    return both.groupBy("metric", F.col("p.b").alias("b")).agg(F.sum("p.w").alias("w")), ranges


def density_curve(df: DataFrame, metrics: list[str] = HIST_METRICS, points: int = GRID_POINTS,
                  bandwidth: dict | None = None, bins: int = DENSITY_BINS) -> DataFrame:
    """Gaussian kernel density on an evenly spaced grid from min to max.

    The values are reduced to at most ``bins`` weighted points a metric (linear
    binning), which the kernel is convolved with at every grid point: after one
    aggregate over the rows, the work is bins x grid points however many
    distinct values there are. Bandwidth defaults to Scott's rule, sample std *
    n^(-1/5), from the values themselves."""
    weights, ranges = binned(df, metrics, bins)
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    if bandwidth:
        h = F.coalesce(*[F.when(F.col("metric") == m, F.lit(float(bw))) for m, bw in bandwidth.items()], h)
    j = join_small(weights, ranges.withColumn("h", h), "metric", "inner")
    j = j.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("mn") + F.col("i") * (F.col("mx") - F.col("mn")) / F.lit(float(points - 1))
    v = F.col("mn") + F.col("b") * ((F.col("mx") - F.col("mn")) / F.lit(float(bins - 1)))
    u = (x - v) / F.col("h")
    k = F.col("w") * F.exp(F.lit(-0.5) * u * u)
    g = j.groupBy("metric", "i").agg(
        F.first(x).alias("x"), F.sum(k).alias("k"), F.first("n").alias("n"), F.first("h").alias("h")
    )
    dens = F.col("k") / (F.lit(float(BIN_UNITS)) * F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return g.select("metric", "i", "x", dens.alias("density"))


def box_stats(df: DataFrame, metrics: list[str] = BOX_METRICS, whisker: float = WHISKER) -> DataFrame:
    """q1, median, q3, IQR, whisker ends (most extreme values within
    1.5 IQR of the quartiles) and outlier count per metric."""
    qs = exact_quantiles_many(df, {m: [0.25, 0.5, 0.75] for m in metrics})
    aggs = []
    for m in metrics:
        q1, q2, q3 = qs[m]
        if q1 is None:
            continue
        iqr = q3 - q1
        lo, hi = q1 - whisker * iqr, q3 + whisker * iqr
        x = F.col(m).cast("double")
        aggs.append(F.struct(
            F.lit(m).alias("metric"), F.lit(q1).alias("q1"), F.lit(q2).alias("median"),
            F.lit(q3).alias("q3"), F.lit(iqr).alias("iqr"),
            F.min(F.when(x >= F.lit(lo), x)).alias("whisker_low"),
            F.max(F.when(x <= F.lit(hi), x)).alias("whisker_high"),
            F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias("outliers"),
        ).alias(m))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.col(m) for m in wide.columns])).alias("s")).select("s.*")


def _cross_products(batches: Iterator[pa.RecordBatch], centre: list[float]) -> Iterator[pa.RecordBatch]:
    """One partition's matrices of counts, sums and products over the rows in
    which both columns have a value, as a row per pair of columns."""
    m = len(centre)
    n, s, ss, xy = (np.zeros((m, m)) for _ in range(4))
    for batch in batches:
        x = np.column_stack([np.asarray(c.fill_null(np.nan)) for c in batch.columns]) - centre
        here = ~np.isnan(x)
        x[~here] = 0
        seen = here.astype(float)
        n += seen.T @ seen
        s += x.T @ seen
        ss += (x * x).T @ seen
        xy += x.T @ x
    i, j = np.triu_indices(m, 1)
    columns = {"i": i, "j": j, "n": n[i, j], "sx": s[i, j], "sy": s[j, i], "sxx": ss[i, j], "syy": ss[j, i], "sxy": xy[i, j]}
    yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson r for every pair (x before y in column order) of numeric
    columns, over the rows in which both have a value.

    Every partition reduces its rows to one small matrix of cross-products, and
    the matrices are added: no row is expanded, and the shuffle has one row a
    pair and partition. Values are taken from a centre near them (the mean of a
    few rows), since products of large ids would cancel."""
    from .clean import numeric_columns

    cols = columns or numeric_columns(df)
    base = ensure_parallelism(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]))
    near = base.limit(CENTRE_ROWS).agg(*[F.avg(c).alias(c) for c in base.columns]).first()
    centre = [float(near[c] or 0.0) if near[c] == near[c] else 0.0 for c in base.columns]
    sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    parts = base.mapInArrow(lambda b: _cross_products(b, centre),
                            "i bigint, j bigint, " + ", ".join(f"{c} double" for c in sums))
    whole = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    spread = F.sqrt((F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")) * (F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")))
    r = F.when(spread > 0, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / spread)
    name = F.array(*map(F.lit, cols))
    return whole.select(F.get(name, F.col("i").cast("int")).alias("x"), F.get(name, F.col("j").cast("int")).alias("y"), r.alias("r"))
