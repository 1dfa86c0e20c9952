"""Disruption modelling: the top vendor of each category, its lead-time
statistics within that category, a distributed breach estimate, exposure,
and the dual-sourcing short list.

The reference loops over targets in one process, filtering the whole table
twice per target and drawing 10,000 normals with a global seed. Here the
targets are joined to the items once, the statistics come from one
aggregate, and every draw is a pure function of (seed, category, draw
index), so the estimate is the same however Spark splits the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import (
    counter_hash,
    mean_of,
    round_float,
    sample_std,
    standard_normal,
    uniform_closed_open,
)
from ..plans.sizing import join_small, materialize
from .features import CATEGORY, SPEND, VENDOR
from .scoring import LEAD, category_vendor_spend, market_share

# Fixed values of the method.
N_SIMULATIONS = 10_000
SEED = 42
SIGMA_FALLBACK = 1.0
THRESHOLD_SIGMAS = 2.0
MIN_RECORDS = 2
TOP_N = 12
RECOMMENDATION = "Dual-source: add secondary vendor"
PROJECTED_REDUCTION_PCT = 30.0

# Draws per target are spread over this many chunks so that a few targets
# still give every core work.
DRAW_CHUNKS = 64


def top_vendor_per_category(df: DataFrame, category=CATEGORY, vendor=VENDOR, spend=SPEND) -> DataFrame:
    """(category, vendor, vendor_spend, market_share) of the vendor with the
    highest share in each category; ties go to the larger spend, then the
    smaller vendor id. A max over a struct aggregates on the map side, so a
    hot category never gathers its rows in one task."""
    shares = market_share(category_vendor_spend(df, category, vendor, spend))
    best = shares.groupBy("category").agg(
        F.max(
            F.struct(
                F.col("market_share"),
                F.col("vendor_spend"),
                (-F.col("vendor")).alias("neg_vendor"),
                F.col("vendor"),
            )
        ).alias("b")
    )
    return best.select(
        "category",
        F.col("b.vendor").alias("vendor"),
        F.col("b.vendor_spend").alias("vendor_spend"),
        F.col("b.market_share").alias("market_share"),
    )


def share_range(targets: DataFrame) -> DataFrame:
    """Number of categories and the lowest and highest top share."""
    return targets.agg(
        F.count(F.lit(1)).alias("categories"),
        F.min("market_share").alias("min_share"),
        F.max("market_share").alias("max_share"),
    )


def target_lead_stats(df: DataFrame, targets: DataFrame, category=CATEGORY, vendor=VENDOR, spend=SPEND) -> DataFrame:
    """For each target: record count, mean and sample std of lead time and
    spend, all restricted to that vendor within that category. Targets are
    category-sized and joined broadcast after their size is measured; a
    left join from the targets keeps targets with no rows (n = 0)."""
    items = df.select(
        F.col(category).alias("category"),
        F.col(vendor).alias("vendor"),
        F.col(LEAD).cast("long").alias("x"),
        F.col(spend).alias("spend"),
    )
    t = targets.select("category", "vendor", "market_share")
    matched = join_small(items, t.select("category", "vendor"), ["category", "vendor"], "left_semi")
    agg = matched.groupBy("category", "vendor").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("x").alias("s"),
        F.sum(F.col("x") * F.col("x")).alias("ss"),
        F.sum("spend").alias("spend_at_risk"),
    )
    stats = t.join(agg, ["category", "vendor"], "left").select(
        "category",
        "vendor",
        "market_share",
        F.coalesce("n", F.lit(0)).alias("record_count"),
        mean_of("s", "n").alias("mu"),
        sample_std("n", "s", "ss").alias("std"),
        "spend_at_risk",
    )
    sigma = F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(SIGMA_FALLBACK))
    return stats.withColumn("sigma", sigma).withColumn(
        "threshold", F.col("mu") + F.lit(THRESHOLD_SIGMAS) * F.col("sigma")
    )


def skipped_targets(stats: DataFrame) -> DataFrame:
    """Targets with fewer than two records: (vendor, category, record_count)."""
    return stats.where(F.col("record_count") < MIN_RECORDS).select(
        "vendor", "category", "record_count"
    )


def simulated_targets(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("record_count") >= MIN_RECORDS)


def spend_at_risk(stats: DataFrame) -> DataFrame:
    """(category, vendor, spend_at_risk) of each target."""
    return stats.select("category", "vendor", "spend_at_risk")


def _draw_index(targets: DataFrame, n_sim: int, chunks: int) -> DataFrame:
    """One row per (target, draw index). Each target is exploded into chunks
    first and the chunks are spread over partitions, then each chunk into
    its draws - no join and no pairing of rows."""
    chunks = max(1, min(chunks, n_sim))
    per = -(-n_sim // chunks)
    c = targets.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    # An explicit partition count: AQE leaves it alone, so the (tiny) chunk
    # rows are not coalesced back into one task before the heavy explode.
    parts = max(1, targets.sparkSession.sparkContext.defaultParallelism)
    c = c.repartition(parts, "category", "chunk")
    lo = F.col("chunk") * F.lit(per)
    hi = F.least(lo + F.lit(per), F.lit(n_sim)) - F.lit(1)
    return c.where(lo <= F.lit(n_sim - 1)).withColumn("i", F.explode(F.sequence(lo, hi))).drop("chunk")


def breach_estimate(stats: DataFrame, n_sim: int = N_SIMULATIONS, seed: int = SEED, chunks: int = DRAW_CHUNKS) -> DataFrame:
    """Fraction of N normal(mu, sigma) draws strictly above the threshold,
    per simulated target. Draw i of a category uses the standard normal
    from md5(seed|category|i) (Box-Muller), scaled by mu and sigma."""
    t = simulated_targets(stats).select("category", "vendor", "mu", "sigma", "threshold")
    draws = _draw_index(t, n_sim, chunks)
    z = standard_normal(seed, F.col("category"), F.col("i"))
    x = F.col("mu") + F.col("sigma") * z
    return draws.groupBy("category", "vendor").agg(
        (F.count_if(x > F.col("threshold")) / F.lit(float(n_sim))).alias("breach_probability")
    )


def breach_empirical(df: DataFrame, stats: DataFrame, n_sim: int = N_SIMULATIONS, seed: int = SEED,
                     category=CATEGORY, vendor=VENDOR, chunks: int = DRAW_CHUNKS) -> DataFrame:
    """Resampling variant: each draw picks one of the target's observed lead
    times uniformly (index = floor(u * n)), and the breach probability is
    the share of draws above the same threshold.

    Lead times are whole days within the 0..90 filter, so each target's
    observations reduce to at most 91 (value, count) pairs; the draw finds
    its value by counting cumulative counts at or below its index, an array
    operation of bounded size per draw."""
    t = simulated_targets(stats).select("category", "vendor", "record_count", "threshold")
    items = df.select(
        F.col(category).alias("category"), F.col(vendor).alias("vendor"),
        F.col(LEAD).cast("long").alias("x"),
    )
    items = join_small(items, t.select("category", "vendor"), ["category", "vendor"], "left_semi")
    hist = items.groupBy("category", "vendor", "x").agg(F.count(F.lit(1)).alias("c"))
    # <= 91 rows per target: the per-target window and array stay bounded.
    w = Window.partitionBy("category", "vendor").orderBy("x")
    hist = hist.withColumn("cum", F.sum("c").over(w))
    packed = hist.groupBy("category", "vendor").agg(
        F.array_sort(F.collect_list(F.struct("cum", "x"))).alias("h")
    )
    tt = t.join(packed, ["category", "vendor"], "inner")
    draws = _draw_index(tt, n_sim, chunks)
    u = uniform_closed_open(counter_hash(seed, F.col("category"), F.col("i")), 1)
    j = F.floor(u * F.col("record_count").cast("double"))
    # index of the first bucket whose cumulative count exceeds j
    pos = F.size(F.filter("h", lambda e: e["cum"] <= j))
    value = F.element_at("h", pos + 1)["x"]
    return draws.groupBy("category", "vendor").agg(
        (F.count_if(value.cast("double") > F.col("threshold")) / F.lit(float(n_sim))).alias(
            "breach_probability"
        )
    )


def monte_carlo_results(stats: DataFrame, probs: DataFrame) -> DataFrame:
    """The result table: rounded figures per simulated target plus exposure
    (rounded probability x rounded spend at risk)."""
    j = simulated_targets(stats).join(probs, ["category", "vendor"], "inner")
    out = j.select(
        "vendor",
        "category",
        round_float("market_share", 4).alias("market_share"),
        round_float("mu", 2).alias("avg_lead_time"),
        round_float("sigma", 2).alias("lead_time_std"),
        round_float("threshold", 2).alias("breach_threshold"),
        round_float("breach_probability", 4).alias("breach_probability"),
        F.round("spend_at_risk", 2).alias("spend_at_risk"),
    )
    return disruption_exposure(out)


def disruption_exposure(results: DataFrame) -> DataFrame:
    return results.withColumn(
        "disruption_exposure",
        F.col("breach_probability") * F.col("spend_at_risk").cast("double"),
    )


def require_rows(df: DataFrame, what: str = "simulation results") -> DataFrame:
    """Fail when the result is empty (checked at the action boundary)."""
    if df.isEmpty():
        raise ValueError(f"{what}: empty, so no target had enough records; nothing was stored")
    return df


def dual_sourcing_topn(results: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n largest exposures, ranked 1..n (ties: category, then vendor),
    with the fixed recommendation and projected reduction. The top-k keeps
    n rows per partition before merging; ranking touches only those n."""
    top = results.orderBy(F.desc("disruption_exposure"), "category", "vendor").limit(n)
    w = Window.orderBy(F.desc("disruption_exposure"), "category", "vendor")
    return top.withColumn("rank_order", F.row_number().over(w)).withColumn(
        "recommendation", F.lit(RECOMMENDATION)
    ).withColumn("projected_risk_reduction_pct", F.lit(PROJECTED_REDUCTION_PCT))


def target_record_counts(df: DataFrame, targets: DataFrame, vendor=VENDOR) -> DataFrame:
    """Records held per target vendor across all categories."""
    counts = df.groupBy(F.col(vendor).alias("vendor")).agg(F.count(F.lit(1)).alias("record_count"))
    t = targets.select("category", "vendor")
    return t.join(counts, "vendor", "left").select(
        "category", "vendor", F.coalesce("record_count", F.lit(0)).alias("record_count")
    )


def disruption_model(df: DataFrame, n_sim: int = N_SIMULATIONS, seed: int = SEED):
    """targets, stats, results: the whole chain, with the small target
    tables stored once in the shared folder."""
    targets = materialize(top_vendor_per_category(df))
    stats = materialize(target_lead_stats(df, targets))
    results = monte_carlo_results(stats, breach_estimate(stats, n_sim, seed))
    return targets, stats, results
