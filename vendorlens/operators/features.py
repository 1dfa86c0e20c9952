"""Feature engineering on the cleaned order items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import floor_days
from ..functions.quantiles import exact_quantiles
from ..plans.sizing import join_small, materialize

VENDOR = "order_customer_id"
CATEGORY = "category_name"
SPEND = "spend_per_order"

# Tier names and spend-quantile edges (fixed values).
TIER_STRATEGIC = "Strategic"
TIER_PREFERRED = "Preferred"
TIER_TRANSACTIONAL = "Transactional"
TIER_UPPER_Q = 0.66
TIER_LOWER_Q = 0.33


def lead_time_days(df: DataFrame, order_col="order_date_dateorders", ship_col="shipping_date_dateorders") -> DataFrame:
    """Whole elapsed days from order to shipping (floor of 24 h periods)."""
    return df.withColumn("lead_time_days", floor_days(order_col, ship_col))


def late_delivery_flag(df: DataFrame, status_col="delivery_status") -> DataFrame:
    """1 when the lower-cased status contains 'late', else 0."""
    return df.withColumn(
        "late_delivery_flag", F.lower(F.col(status_col)).contains("late").cast("int")
    )


def spend_per_order(df: DataFrame, sales_col="sales_per_customer", qty_col="order_item_quantity") -> DataFrame:
    """sales per customer x quantity, money kept as decimal(12,2)."""
    return df.withColumn(
        SPEND, (F.col(sales_col) * F.col(qty_col)).cast("decimal(12,2)")
    )


def delivery_delay_days(df: DataFrame, real="days_for_shipping_real", sched="days_for_shipment_scheduled") -> DataFrame:
    return df.withColumn("delivery_delay_days", (F.col(real) - F.col(sched)).cast("int"))


def calendar_features(df: DataFrame, ts="order_date_dateorders") -> DataFrame:
    t = F.col(ts)
    return (
        df.withColumn("order_year", F.year(t))
        .withColumn("order_month", F.month(t))
        .withColumn("order_quarter", F.quarter(t))
        .withColumn("order_weekday", F.date_format(t, "EEEE"))
    )


def vendor_spend_totals(df: DataFrame, vendor=VENDOR, spend=SPEND) -> DataFrame:
    return df.groupBy(vendor).agg(F.sum(spend).alias("vendor_total_spend"))


def tier_edges(totals: DataFrame) -> tuple[float, float]:
    """q66 and q33 of spend over vendors, exact, linear interpolation."""
    q66, q33 = exact_quantiles(totals, "vendor_total_spend", [TIER_UPPER_Q, TIER_LOWER_Q])
    return q66, q33


def tier_expr(total_col, q66: float, q33: float):
    s = F.col(total_col).cast("double")
    return (
        F.when(s >= F.lit(q66), TIER_STRATEGIC)
        .when(s >= F.lit(q33), TIER_PREFERRED)
        .otherwise(TIER_TRANSACTIONAL)
    )


def vendor_tiers(df: DataFrame, vendor=VENDOR, spend=SPEND) -> DataFrame:
    """(vendor, vendor_total_spend, vendor_tier): one row per vendor."""
    # Stored once in the shared folder: the quantile passes and the tier
    # map then read vendor-sized rows instead of re-aggregating the items.
    totals = materialize(vendor_spend_totals(df, vendor, spend))
    q66, q33 = tier_edges(totals)
    return totals.withColumn("vendor_tier", tier_expr("vendor_total_spend", q66, q33))


def vendor_tier(df: DataFrame, vendor=VENDOR, spend=SPEND) -> DataFrame:
    """Left-join the vendor's tier back onto every row. The tier map has one
    row per vendor; it is broadcast only when its measured size allows."""
    tiers = vendor_tiers(df, vendor, spend).select(vendor, "vendor_tier")
    return join_small(df, tiers, vendor, "left")
