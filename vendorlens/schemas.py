"""Declared table schemas (the reference's typed tables) and the cast that
mirrors loading a result file into such a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.columns import round_float

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
TS = T.TimestampNTZType()
D = T.DateType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Cleaned order items as a typed table (54 columns; ids widened to long).
STAGING_ORDERS = struct(
    ("type", S), ("days_for_shipping_real", I), ("days_for_shipment_scheduled", I),
    ("benefit_per_order", dec(12, 2)), ("sales_per_customer", dec(12, 2)),
    ("delivery_status", S), ("late_delivery_risk", I), ("category_id", I),
    ("category_name", S), ("customer_city", S), ("customer_country", S),
    ("customer_id", L), ("customer_segment", S), ("customer_state", S),
    ("customer_zipcode", S), ("department_id", I), ("department_name", S),
    ("latitude", dec(10, 6)), ("longitude", dec(10, 6)), ("market", S),
    ("order_city", S), ("order_country", S), ("order_customer_id", L),
    ("order_date_dateorders", TS), ("order_id", L), ("order_item_cardprod_id", L),
    ("order_item_discount", dec(12, 2)), ("order_item_discount_rate", dec(6, 4)),
    ("order_item_id", L), ("order_item_product_price", dec(12, 2)),
    ("order_item_profit_ratio", dec(10, 4)), ("order_item_quantity", I),
    ("sales", dec(12, 2)), ("order_item_total", dec(12, 2)),
    ("order_profit_per_order", dec(12, 2)), ("order_region", S), ("order_state", S),
    ("order_status", S), ("product_card_id", L), ("product_category_id", I),
    ("product_name", S), ("product_price", dec(12, 2)), ("product_status", I),
    ("shipping_date_dateorders", TS), ("shipping_mode", S), ("lead_time_days", I),
    ("late_delivery_flag", I), ("spend_per_order", dec(12, 2)),
    ("delivery_delay_days", I), ("order_year", I), ("order_month", I),
    ("order_quarter", I), ("order_weekday", S), ("vendor_tier", S),
)

DIM_VENDOR = struct(("vendor_id", L), ("vendor_name", S), ("vendor_tier", S),
                    ("country", S), ("region", S))
DIM_PRODUCT = struct(("product_id", L), ("product_name", S), ("category_name", S),
                     ("sub_category", S))
DIM_REGION = struct(("region_id", I), ("region_name", S), ("country", S), ("market", S))
DIM_DATE = struct(("date_id", D), ("year", I), ("quarter", I), ("month", I),
                  ("month_name", S), ("week", I))
FACT_ORDERS = struct(
    ("order_id", L), ("order_item_id", L), ("vendor_id", L), ("product_id", L),
    ("region_id", I), ("order_date", D), ("shipping_date", D), ("lead_time_days", I),
    ("order_quantity", I), ("spend_per_order", dec(12, 2)), ("late_delivery_flag", I),
    ("delivery_status", S), ("shipping_mode", S),
)

VENDOR_RISK_SCORES = struct(
    ("vendor", L), ("avg_lead_time", dec(10, 2)), ("lead_time_std", dec(10, 2)),
    ("lead_time_variance_score", dec(10, 6)), ("late_delivery_rate", dec(10, 6)),
    ("composite_risk_score", dec(10, 6)), ("risk_band", S),
)
MONTE_CARLO_RESULTS = struct(
    ("vendor", L), ("category", S), ("market_share", dec(10, 4)),
    ("avg_lead_time", dec(10, 2)), ("lead_time_std", dec(10, 2)),
    ("breach_threshold", dec(10, 2)), ("breach_probability", dec(10, 4)),
    ("spend_at_risk", dec(14, 2)), ("disruption_exposure", dec(14, 4)),
)
TOP12_DUAL_SOURCING = struct(
    *[(f.name, f.dataType) for f in MONTE_CARLO_RESULTS.fields],
    ("rank_order", I), ("recommendation", S), ("projected_risk_reduction_pct", dec(5, 1)),
)
VALIDATION_REPORT = struct(("negative_spend", L), ("lead_time_outliers", L),
                           ("duplicate_orders", L))

TABLES = {
    "staging_orders": STAGING_ORDERS,
    "dim_vendor": DIM_VENDOR,
    "dim_product": DIM_PRODUCT,
    "dim_region": DIM_REGION,
    "dim_date": DIM_DATE,
    "fact_orders": FACT_ORDERS,
    "vendor_risk_scores": VENDOR_RISK_SCORES,
    "monte_carlo_results": MONTE_CARLO_RESULTS,
    "top12_dual_sourcing": TOP12_DUAL_SOURCING,
    "validation_report": VALIDATION_REPORT,
}


def _cast(df: DataFrame, name: str, to: T.DataType):
    src = df.schema[name].dataType
    c = F.col(name)
    if isinstance(to, T.DecimalType) and isinstance(src, (T.DoubleType, T.FloatType)):
        # round the binary value explicitly first (half away from zero), then
        # store it: the same rule whichever engine loads the file
        c = round_float(c, to.scale)
    return c.cast(to)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in order, cast to the declared types;
    columns the frame lacks come out as typed nulls."""
    have = set(df.columns)
    return df.select(*[
        (_cast(df, f.name, f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def as_imported(df: DataFrame, table: str) -> DataFrame:
    """What a typed table holds after the result file is loaded into it:
    each column cast to its declared type (decimals round half up)."""
    return conform(df, TABLES[table])
