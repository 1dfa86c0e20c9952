"""Spend concentration (HHI) and composite vendor risk, computed from the
cleaned order items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mean_of, minmax, risk_band as band_expr, safe_ratio, sample_std
from ..plans.sizing import join_small, materialize
from .features import CATEGORY, SPEND, VENDOR

LEAD = "lead_time_days"
LATE = "late_delivery_flag"

# Composite weights (fixed values of the method; parameters below).
W_LEAD = 0.4
W_LATE = 0.6


def category_vendor_spend(df: DataFrame, category=CATEGORY, vendor=VENDOR, spend=SPEND) -> DataFrame:
    """(category, vendor, vendor_spend): spend per category and vendor."""
    return df.groupBy(
        F.col(category).alias("category"), F.col(vendor).alias("vendor")
    ).agg(F.sum(spend).alias("vendor_spend"))


def category_totals(cvs: DataFrame) -> DataFrame:
    """(category, category_total) from the (category, vendor) sums."""
    return cvs.groupBy("category").agg(F.sum("vendor_spend").alias("category_total"))


def market_share(cvs: DataFrame) -> DataFrame:
    """Adds category_total, market_share and share_squared.

    Totals have one row per category; they are joined back broadcast after
    their size is measured, so the (category, vendor) rows never shuffle on
    the few category keys (a hot category would land in one task)."""
    joined = join_small(cvs, category_totals(cvs), "category", "inner")
    share = safe_ratio("vendor_spend", "category_total")
    return joined.withColumn("market_share", share).withColumn(
        "share_squared", F.col("market_share") * F.col("market_share")
    )


def hhi_exact(shares: DataFrame) -> DataFrame:
    """(category, hhi_score) = sum of unrounded squared shares."""
    return shares.groupBy("category").agg(F.sum("share_squared").alias("hhi_score"))


def vendor_item_stats(df: DataFrame, vendor=VENDOR) -> DataFrame:
    """One pass per vendor: item count, lead-time sum and sum of squares,
    late count. Everything per vendor below derives from these."""
    x = F.col(LEAD).cast("long")
    return df.groupBy(F.col(vendor).alias("vendor")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("s"),
        F.sum(x * x).alias("ss"),
        F.sum(F.col(LATE).cast("long")).alias("late"),
    )


def vendor_lead_stats(df: DataFrame, vendor=VENDOR) -> DataFrame:
    """(vendor, avg_lead_time, lead_time_std): mean and sample std; a vendor
    with one item gets std 0."""
    st = vendor_item_stats(df, vendor)
    return st.select(
        "vendor",
        mean_of("s", "n").alias("avg_lead_time"),
        F.coalesce(sample_std("n", "s", "ss"), F.lit(0.0)).alias("lead_time_std"),
    )


def minmax_score(df: DataFrame, col: str, out: str, eps: float = 1e-9) -> DataFrame:
    """(x - min) / (max - min + eps) over the whole frame. The extremes come
    from one global aggregate (partial per task, one row at the end) and
    enter the projection as constants - no unpartitioned window, and no
    scalar subqueries nesting when normalisations are chained."""
    ext = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo = F.lit(ext["lo"]).cast("double")
    hi = F.lit(ext["hi"]).cast("double")
    return df.withColumn(out, minmax(col, lo, hi, eps))


def vendor_late_rate_py(df: DataFrame, vendor=VENDOR) -> DataFrame:
    """(vendor, late_delivery_rate): mean late flag, 0..1."""
    st = vendor_item_stats(df, vendor)
    return st.select("vendor", mean_of("late", "n").alias("late_delivery_rate"))


def composite_risk(df: DataFrame, vendor=VENDOR, w_lead: float = W_LEAD, w_late: float = W_LATE) -> DataFrame:
    """Per vendor: lead-time stats, variance score, late rate and the
    composite score, min-max normalised again. One aggregate over the items
    feeds all of it (the reference's two group-bys and merge are fused)."""
    st = vendor_item_stats(df, vendor)
    # vendor-sized; stored once so both normalisations (a one-row aggregate
    # each) read it instead of re-aggregating the items each time
    base = materialize(st.select(
        "vendor",
        mean_of("s", "n").alias("avg_lead_time"),
        F.coalesce(sample_std("n", "s", "ss"), F.lit(0.0)).alias("lead_time_std"),
        mean_of("late", "n").alias("late_delivery_rate"),
    ))
    scored = minmax_score(base, "lead_time_std", "lead_time_variance_score")
    raw = scored.withColumn(
        "raw_score",
        F.lit(w_lead) * F.col("lead_time_variance_score") + F.lit(w_late) * F.col("late_delivery_rate"),
    )
    return minmax_score(raw, "raw_score", "composite_risk_score").select(
        "vendor", "avg_lead_time", "lead_time_std", "lead_time_variance_score",
        "late_delivery_rate", "composite_risk_score",
    )


def risk_band(scores: DataFrame, col: str = "composite_risk_score") -> DataFrame:
    """<0.25 Low, <0.50 Medium, <0.75 High, else Critical."""
    return scores.withColumn("risk_band", band_expr(col))


def vendor_risk_scores(df: DataFrame, vendor=VENDOR) -> DataFrame:
    """The exported score table: composite risk plus band."""
    return risk_band(composite_risk(df, vendor))
