"""Exact quantiles that scale: selection of many ranks on Spark.

Spark's exact ``percentile`` holds every distinct value of a group in one
buffer, which a global quantile over billions of distinct values cannot
afford. Here the wanted ranks of all columns are found in three passes:

1. one pass counts the values and, with ``percentile_approx``, proposes per
   quantile a bracket [a, b] of values around it;
2. one pass counts the values below a, at a, between, at b. A rank among the
   copies of a or of b is found; a value that fills much of the column is such
   an end, so a heavy value never has to be searched for;
3. ranks strictly between the ends (or outside, where a sketch missed) are
   ranked on Spark: the few values of their brackets are counted, dealt to
   range partitions, and a rank is looked up in the partition that the
   partitions' counts point to.

There is no further round, whatever the data. The driver gets brackets, the
row counts of range partitions, and one value per rank; never a list of
values.

All columns are handled together in a "melted" form - (column, value) rows -
so every pass is one small grouped aggregate whatever the number of columns.
Whole numbers and decimals are compared as decimals, so they stay exact where
a double would not.

Interpolation is "linear": with h = (n - 1) * p,
q = x[floor(h)] + (h - floor(h)) * (x[floor(h) + 1] - x[floor(h)]).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.sizing import materialize

# Accuracy of the sketch: a bracket holds about 5 / ACCURACY of the rows.
ACCURACY = 10_000
SLACK = 2.5 / ACCURACY

FLOATING = (T.FloatType, T.DoubleType)


def _scale(t: T.DataType) -> int:
    return t.scale if isinstance(t, T.DecimalType) else 0


def _melt(df: DataFrame, cols: list[str]) -> DataFrame:
    """(c, x): column position and value, nulls dropped; x is a double if any
    column is one, else a decimal wide enough for all."""
    types = [df.schema[c].dataType for c in cols]
    kind = "double" if any(isinstance(t, FLOATING) for t in types) else f"decimal(38,{max(map(_scale, types))})"
    vals = F.array(*[F.col(f"`{c}`").cast(kind) for c in cols])
    return df.select(F.posexplode(vals).alias("c", "x")).where(F.col("x").isNotNull())


def _table(long: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small driver-built table of brackets; bounds have the values' type."""
    kinds = {"lo": long.schema["x"].dataType, "hi": long.schema["x"].dataType, "a": long.schema["x"].dataType,
             "b": long.schema["x"].dataType, "rank": T.LongType()}
    schema = T.StructType([T.StructField(n, kinds.get(n, T.IntegerType())) for n in names])
    return F.broadcast(long.sparkSession.createDataFrame(rows, schema))


def _sketches(long: DataFrame, probs: list[float]) -> dict[int, tuple[int, list]]:
    """{column position: (rows, bracket ends)}: two ends per probability."""
    ends = [min(1.0, max(0.0, p + s)) for p in probs for s in (-SLACK, SLACK)]
    rows = long.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", ends, ACCURACY).alias("q")).collect()
    return {r["c"]: (r["n"], r["q"]) for r in rows}


def _ranked(long: DataFrame, jobs: list[tuple]) -> dict[tuple, object]:
    """{(range, rank): value} for jobs (range, column, above, below, rank):
    the rank-th value of a column strictly between two bounds (None: open)."""
    ranges = {j[:4] for j in jobs}
    inside = long.join(_table(long, sorted(ranges, key=str), ["g", "c", "lo", "hi"]), "c").where(
        (F.col("lo").isNull() | (F.col("x") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("x") < F.col("hi"))))
    counted = inside.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    # a value is one row, however often it occurs; a checkpoint keeps the range partitions
    dealt = materialize(counted.repartitionByRange("g", "x")).withColumn("part", F.spark_partition_id())
    sizes = sorted((r["g"], r["part"], r["n"]) for r in
                   dealt.groupBy("g", "part").agg(F.sum("n").alias("n")).collect())
    picks = []
    for g, _, _, _, rank in jobs:
        before = 0
        for _, part, n in (s for s in sizes if s[0] == g):
            if rank < before + n:
                picks.append((g, part, rank - before, rank))
                break
            before += n
    wanted = long.sparkSession.createDataFrame(picks, "g int, part int, at long, rank long")
    upto = F.sum("n").over(Window.partitionBy("g", "part").orderBy("x"))
    # only the partitions that hold a rank are sorted
    held = dealt.join(F.broadcast(wanted.select("g", "part").distinct()), ["g", "part"], "left_semi")
    found = held.withColumn("upto", upto).join(F.broadcast(wanted), ["g", "part"]).where(
        (F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("n")))
    return {(r["g"], r["rank"]): r["x"] for r in found.select("g", "rank", "x").collect()}


def _order_stats(long: DataFrame, wanted: dict[tuple[int, float], list[int]], sketches: dict) -> dict[tuple[int, int], object]:
    """{(column, rank): value} for the ranks of every (column, probability)."""
    probs = sorted({p for _, p in wanted})
    keys = list(wanted)
    ends = {}
    for c, p in keys:
        a, b = sketches[c][1][2 * probs.index(p):2 * probs.index(p) + 2]
        ends[c, p] = (a, b)
    x, a, b = F.col("x"), F.col("a"), F.col("b")
    rows = long.join(_table(long, [(c, g, *ends[c, p]) for g, (c, p) in enumerate(keys)], ["c", "g", "a", "b"]), "c").groupBy("g").agg(
        F.count_if(x < a).alias("below"), F.count_if(x == a).alias("at_a"),
        F.count_if((x > a) & (x < b)).alias("between"), F.count_if((x == b) & (a < b)).alias("at_b")).collect()
    out, jobs = {}, []
    for r in rows:
        g = r["g"]
        (c, p), (lo, hi) = keys[g], ends[keys[g]]
        steps = [(r["below"], None, lo), (r["at_a"], lo, lo), (r["between"], lo, hi), (r["at_b"], hi, hi),
                 (sketches[c][0], hi, None)]
        for rank in wanted[c, p]:
            before = 0
            for i, (n, above, below) in enumerate(steps):
                if rank < before + n or i == 4:
                    if i in (1, 3):
                        out[c, rank] = above
                    else:
                        jobs.append((5 * g + i, c, above, below, rank - before, rank))
                    break
                before += n
    if jobs:
        found = _ranked(long, [j[:5] for j in jobs])
        out |= {(c, rank): found[g, at] for g, c, _, _, at, rank in jobs}
    return out


def _between(low, high, h: float) -> float:
    """Linear interpolation; the gap of exact values is exact."""
    return float(low) if h == 0 or low == high else float(low) + float(high - low) * h


def exact_quantiles_many(df: DataFrame, spec: dict) -> dict:
    """spec: {column: [p, ...]} -> {column: [q, ...]} (None if no values)."""
    out = {}
    floats = [c for c in spec if isinstance(df.schema[c].dataType, FLOATING)]
    for cols in (floats, [c for c in spec if c not in floats]):
        if not cols:
            continue
        long = _melt(df, cols)
        probs = sorted({p for c in cols for p in spec[c]})
        sketches = _sketches(long, probs)
        places, wanted = {}, {}
        for pos, c in enumerate(cols):
            n = sketches.get(pos, (0, None))[0]
            for p in spec[c]:
                if n:
                    h = (n - 1) * p
                    k = int(math.floor(h))
                    places[c, p] = (k, min(k + 1, n - 1), h - k)
                    wanted[pos, p] = sorted({k, min(k + 1, n - 1)})
        stats = _order_stats(long, wanted, sketches) if wanted else {}
        for pos, c in enumerate(cols):
            out[c] = [_between(stats[pos, places[c, p][0]], stats[pos, places[c, p][1]], places[c, p][2])
                      if (c, p) in places else None for p in spec[c]]
    return out


def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> list:
    return exact_quantiles_many(df, {column: list(probs)})[column]
