"""Data sets behind the dashboard visuals (the dashboard file itself is not
in the reference; these are the queries its pages describe)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import join_small

TOP_VENDORS = 10
# What-if multiplier grid: 0.50 to 1.00 in steps of 0.05 (step is our choice).
WHAT_IF_FROM, WHAT_IF_TO, WHAT_IF_STEP = 50, 100, 5


def top_vendors_by_spend(risk_master: DataFrame, n: int = TOP_VENDORS) -> DataFrame:
    return risk_master.select("vendor_id", "vendor_name", "total_spend", "risk_band") \
        .orderBy(F.desc("total_spend"), "vendor_id").limit(n)


def spend_trend_by_tier(fact: DataFrame, dim_vendor: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Spend per (year, month, vendor tier). Reduced to (vendor, date) sums
    before the two dimension joins."""
    vd = fact.groupBy("vendor_id", "order_date").agg(F.sum("spend_per_order").alias("spend"))
    dd = dim_date.select(F.col("date_id").alias("order_date"), "year", "month")
    vm = join_small(vd, dd, "order_date", "inner").groupBy("vendor_id", "year", "month").agg(
        F.sum("spend").alias("spend")
    )
    j = vm.join(dim_vendor.select("vendor_id", "vendor_tier"), "vendor_id", "inner")
    return j.groupBy("year", "month", "vendor_tier").agg(F.sum("spend").alias("total_spend"))


def risk_vs_spend(risk_master: DataFrame) -> DataFrame:
    return risk_master.select("vendor_id", "composite_risk_score", "total_spend", "risk_band")


def exposure_by_category(mc_imported: DataFrame) -> DataFrame:
    return mc_imported.groupBy("category").agg(
        F.sum("disruption_exposure").alias("disruption_exposure")
    ).orderBy(F.desc("disruption_exposure"))


def breach_vs_spend(mc_imported: DataFrame) -> DataFrame:
    return mc_imported.select("category", "vendor", "breach_probability", "spend_at_risk",
                              "disruption_exposure")


def what_if_grid(top12_imported: DataFrame) -> DataFrame:
    """Exposure after intervention for each sourcing multiplier. The grid is
    generated per row (explode), not joined."""
    steps = F.sequence(F.lit(WHAT_IF_FROM), F.lit(WHAT_IF_TO), F.lit(WHAT_IF_STEP))
    g = top12_imported.select("category", "vendor", "disruption_exposure",
                              F.explode(steps).alias("pct"))
    mult = (F.col("pct").cast("decimal(5,2)") / F.lit(100)).cast("decimal(3,2)")
    return g.select(
        "category", "vendor", mult.alias("multiplier"), "disruption_exposure",
        (F.col("disruption_exposure") * mult).alias("exposure_after"),
    )


def _after(pct_col="projected_risk_reduction_pct"):
    return F.lit(1.0) - F.col(pct_col).cast("double") / F.lit(100.0)


def before_after_risk(top12_imported: DataFrame) -> DataFrame:
    return top12_imported.select(
        "rank_order", "category", "vendor",
        F.col("disruption_exposure").alias("exposure_before"),
        (F.col("disruption_exposure").cast("double") * _after()).alias("exposure_after"),
    )


def projected_saving(top12_imported: DataFrame) -> DataFrame:
    return top12_imported.select(
        "rank_order", "category", "vendor", "spend_at_risk",
        (F.col("spend_at_risk").cast("double") * F.col("projected_risk_reduction_pct").cast("double")
         / F.lit(100.0)).alias("projected_saving"),
    )
