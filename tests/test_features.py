import datetime as dt
from decimal import Decimal


from vendorlens.functions.columns import floor_days, week_sunday
from vendorlens.operators import features as FE


def test_floor_days(spark):
    T = dt.datetime
    rows = [
        (T(2020, 1, 1, 23), T(2020, 1, 2, 1)),       # crosses midnight, 2 h -> 0
        (T(2020, 1, 1, 12), T(2020, 1, 1, 11)),      # one hour back -> -1
        (T(2020, 1, 1), T(2020, 3, 31)),             # exactly 90 days
        (T(2020, 1, 1), T(2020, 4, 1)),              # 91 days
        (T(2020, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "o timestamp_ntz, s timestamp_ntz")
    got = [r[0] for r in df.select(floor_days("o", "s")).collect()]
    assert got == [0, -1, 90, 91, None]


def test_floor_days_ignores_session_zone(spark):
    T = dt.datetime
    df = spark.createDataFrame([(T(2021, 3, 13, 12), T(2021, 3, 14, 12))], "o timestamp_ntz, s timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # DST starts 2021-03-14
        assert df.select(floor_days("o", "s")).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_late_flag_text_rule(spark):
    df = spark.createDataFrame([("Late delivery",), ("LATE",), ("Shipping on time",), ("",)], "delivery_status string")
    assert [r[0] for r in FE.late_delivery_flag(df).select("late_delivery_flag").collect()] == [1, 1, 0, 0]


def test_week_is_sunday_based(spark):
    days = [dt.date(2017, 1, 1), dt.date(2018, 1, 1), dt.date(2017, 12, 31), dt.date(2019, 6, 15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(week_sunday("d")).collect()]
    assert got == [int(d.strftime("%U")) for d in days]


def test_vendor_tiers_interpolated_edges(spark):
    rows = [(1, 1.0), (2, 2.0), (3, 4.0), (4, 9.0)]
    df = spark.createDataFrame(rows, "order_customer_id long, spend_per_order double")
    q66, q33 = FE.tier_edges(FE.vendor_spend_totals(df))
    assert abs(q66 - 3.96) < 1e-12 and abs(q33 - 1.99) < 1e-12
    tiers = {r[0]: r[2] for r in FE.vendor_tiers(df).collect()}
    assert tiers == {1: "Transactional", 2: "Preferred", 3: "Strategic", 4: "Strategic"}
    # left join back keeps every row
    assert FE.vendor_tier(df).count() == 4


def test_spend_and_calendar(spark):
    df = spark.createDataFrame([(Decimal("10.25"), 3, dt.datetime(2018, 1, 1, 5))],
                               "sales_per_customer decimal(12,2), order_item_quantity int, order_date_dateorders timestamp_ntz")
    out = FE.calendar_features(FE.spend_per_order(df)).first()
    assert str(out["spend_per_order"]) == "30.75"
    assert (out["order_year"], out["order_month"], out["order_quarter"], out["order_weekday"]) == (2018, 1, 1, "Monday")
