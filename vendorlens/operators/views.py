"""The reporting views over the star schema, one function each.

Pattern throughout: the fact is reduced once to mergeable partial aggregates
per (month, product, vendor), and every view merges those (counts and sums are
added, extremes compared) before it joins a dimension. For an inner join on a
unique dimension key this equals joining first and grouping after. A view
function takes the fact itself or its partials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import concentration_band, mean_of, pop_std, round_float, round_ratio, safe_ratio
from ..plans.sizing import join_small, scalars

SHARE_T = "decimal(10,4)"


# Partial aggregates by how two of them merge.
ADDED = ["n_items", "n_spend", "spend", "units", "n_lead", "s_lead", "ss_lead", "n_late", "s_late"]
LEAST, MOST = "min_lead", "max_lead"
PARTIAL_KEYS = ["order_month", "product_id", "vendor_id"]


def fact_partials(fact: DataFrame) -> DataFrame:
    """One row per (month, product, vendor) with everything that the views
    need. ``order_month`` (year * 100 + month) is the partition to rebuild when
    items of a month change."""
    x = F.col("lead_time_days").cast("long")
    month = (F.year("order_date") * 100 + F.month("order_date")).alias("order_month")
    return fact.groupBy(month, "product_id", "vendor_id").agg(
        F.count("order_item_id").alias("n_items"), F.count("spend_per_order").alias("n_spend"),
        F.sum("spend_per_order").alias("spend"), F.sum("order_quantity").alias("units"),
        F.count("lead_time_days").alias("n_lead"), F.sum(x).alias("s_lead"), F.sum(x * x).alias("ss_lead"),
        F.count("late_delivery_flag").alias("n_late"), F.sum("late_delivery_flag").alias("s_late"),
        F.min("lead_time_days").alias(LEAST), F.max("lead_time_days").alias(MOST),
    )


def merged(partials: DataFrame, *keys: str) -> DataFrame:
    """Partials merged by ``keys``."""
    return partials.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ADDED], F.min(LEAST).alias(LEAST), F.max(MOST).alias(MOST))


def _partials(source: DataFrame) -> DataFrame:
    return source if "n_items" in source.columns else fact_partials(source)


def _vendor_fact_stats(source: DataFrame) -> DataFrame:
    """Everything the vendor views need, one row per vendor."""
    return merged(_partials(source), "vendor_id").select(
        "vendor_id", F.col("n_items").alias("total_orders"), F.col("spend").alias("total_spend"), "n_spend",
        F.col("units").alias("total_units_ordered"), "n_lead", "s_lead", "ss_lead",
        F.col(LEAST).alias("min_lead_time"), F.col(MOST).alias("max_lead_time"),
        F.col("s_late").alias("late_orders"), "n_late",
    )


def _with_vendor(stats: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    dv = dim_vendor.select("vendor_id", "vendor_name", "vendor_tier")
    return stats.join(dv, "vendor_id", "inner")


def _spend_cols():
    return [
        "total_orders",
        "total_spend",
        mean_of("total_spend", "n_spend").alias("avg_spend_per_order"),
    ]


def _lead_cols():
    return [
        round_ratio("s_lead", "n_lead", 2).alias("avg_lead_time"),
        round_float(pop_std("n_lead", "s_lead", "ss_lead"), 2).alias("std_lead_time"),
    ]


def _late_pct(digits: int = 2):
    return round_ratio("100 * late_orders", "n_late", digits).alias("late_delivery_rate_pct")


def vw_vendor_spend(source: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """Items, total and mean spend, units per vendor (items, not orders)."""
    j = _with_vendor(_vendor_fact_stats(source), dim_vendor)
    return j.select("vendor_id", "vendor_name", "vendor_tier", *_spend_cols(), "total_units_ordered")


def vw_vendor_lead_time(source: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """Count, mean, population std, min and max lead time per vendor."""
    j = _with_vendor(_vendor_fact_stats(source), dim_vendor)
    return j.select(
        "vendor_id", "vendor_name", F.col("total_orders").alias("order_count"), *_lead_cols(),
        "min_lead_time", "max_lead_time",
    )


def vw_vendor_late_rate(source: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    j = _with_vendor(_vendor_fact_stats(source), dim_vendor)
    return j.select("vendor_id", "vendor_name", "total_orders", "late_orders", _late_pct())


def late_rate_by_shipping_mode(fact: DataFrame) -> DataFrame:
    """Items, late items and late percent per shipping mode, highest first."""
    g = fact.groupBy("shipping_mode").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("late_delivery_flag").alias("late_orders"),
    )
    pct = round_ratio("100 * late_orders", "total_orders", 2)
    return g.withColumn("Late_delivery_rate", pct).orderBy(F.desc("Late_delivery_rate"))


def category_vendor(source: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Partials per (category, vendor) through the product dimension. They are
    merged to (product, vendor) first, so the join to the product dimension
    moves one row per pair instead of one per item."""
    pv = merged(_partials(source), "product_id", "vendor_id")
    j = pv.join(dim_product.select("product_id", "category_name"), "product_id", "inner")
    return merged(j, "category_name", "vendor_id")


def _by_category_vendor(source: DataFrame, dim_product: DataFrame) -> DataFrame:
    stored = "category_name" in source.columns and "n_items" in source.columns
    return source if stored else category_vendor(source, dim_product)


def vw_category_hhi(source: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Per (category, vendor): spend, share (4 dp) and squared share (4 dp).
    Category totals are category-sized and broadcast after measurement."""
    vcs = _by_category_vendor(source, dim_product).select("category_name", "vendor_id", F.col("spend").alias("vendor_spend"))
    totals = vcs.groupBy("category_name").agg(F.sum("vendor_spend").alias("category_total"))
    j = join_small(vcs, totals, "category_name", "inner")
    share = safe_ratio("vendor_spend", "category_total")
    return j.select(
        "category_name",
        "vendor_id",
        F.round("vendor_spend", 2).alias("vendor_spend"),
        round_float(share, 4).cast(SHARE_T).alias("market_share"),
        round_float(share * share, 4).cast(SHARE_T).alias("share_squared"),
    )


def vw_hhi_by_category(category_hhi: DataFrame) -> DataFrame:
    """HHI as the sum of the rounded squared shares, vendor count, band."""
    g = category_hhi.groupBy("category_name").agg(
        F.sum("share_squared").alias("ss"), F.count("vendor_id").alias("vendor_count")
    )
    return g.select(
        "category_name",
        F.round("ss", 4).alias("hhi_score"),
        "vendor_count",
        concentration_band("ss").alias("concentration_band"),
    )


def vw_single_source(category_hhi: DataFrame, hhi_by_category: DataFrame) -> DataFrame:
    """Top vendor by rounded share per category (ties: larger spend, then
    smaller vendor id); ``category_spend`` is that vendor's spend."""
    best = category_hhi.groupBy("category_name").agg(
        F.max(F.struct("market_share", "vendor_spend", (-F.col("vendor_id")).alias("nv"), "vendor_id")).alias("b")
    )
    top = best.select(
        "category_name",
        F.col("b.vendor_id").alias("sole_vendor_id"),
        F.col("b.market_share").alias("market_share"),
        F.col("b.vendor_spend").alias("category_spend"),
    )
    return top.join(hhi_by_category.select("category_name", "vendor_count"), "category_name", "inner")


def vw_disruption_exposure(single_source: DataFrame, source: DataFrame, dim_vendor: DataFrame,
                           hhi_by_category: DataFrame) -> DataFrame:
    """Top vendor per category with its vendor-wide lead time and late rate
    and the category's HHI."""
    ss = single_source.select("category_name", F.col("sole_vendor_id").alias("vendor_id"),
                              "market_share", F.col("category_spend").alias("spend_at_risk"))
    st = _with_vendor(_vendor_fact_stats(source), dim_vendor).select(
        "vendor_id", "vendor_name", "vendor_tier", *_lead_cols(), _late_pct()
    )
    h = hhi_by_category.select("category_name", "hhi_score", "concentration_band")
    return ss.join(st, "vendor_id", "inner").join(h, "category_name", "inner").select(
        "category_name", "vendor_id", "vendor_name", "vendor_tier", "market_share", "spend_at_risk",
        "avg_lead_time", "std_lead_time", "late_delivery_rate_pct", "hhi_score", "concentration_band",
    )


def vw_vendor_risk_master(source: DataFrame, dim_vendor: DataFrame, scores_imported: DataFrame) -> DataFrame:
    """Spend, lead time and late rate per vendor (one fused aggregate), left
    joined to the imported risk scores."""
    j = _with_vendor(_vendor_fact_stats(source), dim_vendor)
    base = j.select(
        "vendor_id", "vendor_name", "vendor_tier", *_spend_cols(), *_lead_cols(), _late_pct()
    )
    sc = scores_imported.select(F.col("vendor").alias("vendor_id"), "composite_risk_score", "risk_band")
    return base.join(sc, "vendor_id", "left")


def vw_dual_sourcing_recommendations(top12_imported: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    t = top12_imported
    dv = dim_vendor.select(F.col("vendor_id").alias("vendor"), "vendor_name", "vendor_tier")
    return join_small(t, dv, "vendor", "left").select(
        "rank_order", "category", "vendor", "vendor_name", "vendor_tier", "market_share",
        "breach_probability", "spend_at_risk", "disruption_exposure",
        "projected_risk_reduction_pct", "recommendation",
    ).orderBy("rank_order")


def vw_kpi_summary(source: DataFrame, dim_product: DataFrame, mc_imported: DataFrame,
                   scores_imported: DataFrame, top12_imported: DataFrame) -> DataFrame:
    """One row of headline figures from the (category, vendor) partials; the
    trailing figures are scalar subqueries over the result tables. Vendors at
    critical risk count if the fact has items of theirs."""
    cv = _by_category_vendor(source, dim_product)
    mc_n = mc_imported.agg(F.count(F.lit(1)).alias("v")).scalar()
    critical = scores_imported.where(F.col("risk_band") == "Critical").select(F.col("vendor").alias("vendor_id"))
    crit = critical.join(cv.select("vendor_id"), "vendor_id", "left_semi").agg(F.count(F.lit(1))).scalar()
    t12 = scalars(top12_imported.agg(
        F.round(F.sum("spend_at_risk"), 0).alias("sar"),
        F.round(F.sum("disruption_exposure"), 0).alias("exp"),
    ))
    return cv.agg(
        F.count_distinct("vendor_id").alias("total_vendors"),
        F.count_distinct("category_name").alias("total_categories"),
        F.round(F.sum("spend"), 0).alias("total_spend"),
        F.sum("s_lead").alias("s_lead"), F.sum("n_lead").alias("n_lead"),
        F.sum("s_late").alias("s_late"), F.sum("n_late").alias("n_late"),
    ).select(
        "total_vendors", "total_categories", "total_spend",
        round_ratio("s_lead", "n_lead", 1).alias("avg_lead_time_days"),
        round_ratio("100 * s_late", "n_late", 1).alias("overall_late_rate_pct"),
        mc_n.alias("categories_simulated"),
        crit.alias("critical_risk_vendors"),
        t12.getField("sar").alias("total_spend_at_risk"),
        t12.getField("exp").alias("total_disruption_exposure"),
    )


def vw_category_concentration(source: DataFrame, dim_product: DataFrame, dim_vendor: DataFrame,
                              hhi_by_category: DataFrame, single_source: DataFrame) -> DataFrame:
    """HHI, top vendor and the category's spend, mean lead time and late
    percent, the category's figures merged from its vendors' partials."""
    per_cat = merged(_by_category_vendor(source, dim_product), "category_name")
    head = hhi_by_category.join(single_source.select("category_name", "market_share", "sole_vendor_id"),
                                "category_name", "inner") \
        .join(dim_vendor.select(F.col("vendor_id").alias("sole_vendor_id"), "vendor_name"), "sole_vendor_id", "inner")
    return head.join(per_cat, "category_name", "inner").select(
        "category_name", "hhi_score", "vendor_count", "concentration_band",
        F.col("market_share").alias("top_vendor_share"),
        F.col("sole_vendor_id").alias("top_vendor_id"),
        F.col("vendor_name").alias("top_vendor_name"),
        F.round("spend", 2).alias("total_category_spend"),
        round_ratio("s_lead", "n_lead", 2).alias("avg_category_lead_time"),
        round_ratio("100 * s_late", "n_late", 2).alias("category_late_rate_pct"),
    )


def yearly_vendor_spend(fact: DataFrame, dim_vendor: DataFrame, dim_date: DataFrame) -> DataFrame:
    """(vendor_id, vendor_name, year, annual_spend). The fact is reduced to
    (vendor, date) sums before the date dimension (calendar-sized, measured)
    supplies the year."""
    vd = fact.groupBy("vendor_id", "order_date").agg(F.sum("spend_per_order").alias("spend"))
    dd = dim_date.select(F.col("date_id").alias("order_date"), "year")
    vy = join_small(vd, dd, "order_date", "inner").groupBy("vendor_id", "year").agg(
        F.sum("spend").alias("annual_spend")
    )
    return vy.join(dim_vendor.select("vendor_id", "vendor_name"), "vendor_id", "inner")


def vw_yoy_spend(fact: DataFrame, dim_vendor: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Yearly spend per vendor against the previous calendar year (null when
    the vendor had no spend that year); growth guarded against zero.

    One pass over the fact: the year table has one row per vendor and year,
    so a window over a vendor's years holds a handful of rows, however many
    items the vendor has."""
    ys = yearly_vendor_spend(fact, dim_vendor, dim_date)
    years = Window.partitionBy("vendor_id").orderBy("year")
    before = F.when(F.lag("year").over(years) == F.col("year") - 1, F.lag("annual_spend").over(years))
    j = ys.withColumn("prev", before)
    change = F.col("annual_spend") - F.col("prev")
    # exact on cents: (cur - prev) * 100 / prev, rounded half away from zero
    growth = round_ratio("(annual_spend - prev) * 10000", "prev * 100", 2)
    return j.select(
        "vendor_id", "vendor_name", "year",
        F.round("annual_spend", 2).alias("current_year_spend"),
        F.round("prev", 2).alias("prev_year_spend"),
        F.round(change, 2).alias("yoy_spend_change"),
        growth.alias("yoy_growth_pct"),
    ).orderBy("vendor_id", "year")
