import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from vendorlens.operators import star as ST
from vendorlens.operators import views as V


def test_dedupe_keeps_first_by_order(spark):
    rows = [(1, 9, "b"), (1, 3, "a"), (2, 5, "c")]
    df = spark.createDataFrame(rows, "order_item_id long, order_customer_id long, delivery_status string")
    got = {r[0]: r[1] for r in ST.dedupe_items(df).collect()}
    assert got == {1: 3, 2: 5}


def test_dim_region_numbering_and_market(spark):
    rows = [("EU", "FR", "m1"), ("EU", "FR", "m2"), ("AF", "KE", "m1")]
    df = spark.createDataFrame(rows, "order_region string, order_country string, market string")
    out = [tuple(r) for r in ST.dim_region(df).orderBy("region_id").collect()]
    assert out == [(1, "AF", "KE", "m1"), (2, "EU", "FR", "m1"), (3, "EU", "FR", "m2")]


def test_fk_orphans(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99)], "order_item_id long, vendor_id long")
    dim = spark.createDataFrame([(10,)], "vendor_id long")
    r = ST.fk_check(fact, {"vendor_id": (dim, "vendor_id")}).first()
    assert r["orphan_rows"] == 1


def test_pk_check_counts(spark):
    t = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k long")
    r = ST.pk_check({"t": (t, "k")}).first()
    assert (r["row_count"], r["null_keys"], r["duplicate_keys"]) == (4, 1, 1)


def test_yoy_gap_zero_and_single_year(spark):
    d = dt.date
    fact = spark.createDataFrame([
        (1, d(2015, 3, 1), Decimal("100.00")), (1, d(2016, 3, 1), Decimal("150.00")),
        (1, d(2018, 3, 1), Decimal("10.00")),                                     # gap year 2017
        (2, d(2015, 1, 1), Decimal("0.00")), (2, d(2016, 1, 1), Decimal("5.00")),  # zero base
        (3, d(2016, 1, 1), Decimal("7.00")),
    ], "vendor_id long, order_date date, spend_per_order decimal(12,2)")
    dv = spark.createDataFrame([(1, "Vendor_1"), (2, "Vendor_2"), (3, "Vendor_3")], "vendor_id long, vendor_name string")
    dd = spark.createDataFrame([(x, x.year) for x in {d(2015, 3, 1), d(2016, 3, 1), d(2018, 3, 1), d(2015, 1, 1), d(2016, 1, 1)}],
                               "date_id date, year int")
    out = {(r["vendor_id"], r["year"]): r for r in V.vw_yoy_spend(fact, dv, dd).collect()}
    assert out[(1, 2016)]["yoy_growth_pct"] == 50.0
    assert out[(1, 2018)]["prev_year_spend"] is None            # gap, not 2016
    assert out[(2, 2016)]["yoy_growth_pct"] is None             # zero guard
    assert out[(3, 2016)]["prev_year_spend"] is None


def test_number_rows_matches_row_number(spark):
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from vendorlens.plans.sizing import number_rows

    rnd = random.Random(2)
    rows = [(rnd.choice("abcde"), rnd.randint(0, 50), rnd.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a string, b int, c double").repartition(13)
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("a", "b", "c")))
    got = number_rows(df, ["a", "b"], "rid")
    assert sorted(map(tuple, got.select("rid", "a", "b", "c").collect())) == \
        sorted(map(tuple, want.select("rid", "a", "b", "c").collect()))


def test_yoy_negative_base(spark):
    fact = spark.createDataFrame([(1, dt.date(2016, 1, 1), -100), (1, dt.date(2017, 1, 1), 150)],
                                 "vendor_id long, order_date date, spend_per_order int").withColumn(
        "spend_per_order", F.col("spend_per_order").cast("decimal(12,2)"))
    dv = spark.createDataFrame([(1, "v")], "vendor_id long, vendor_name string")
    dd = spark.createDataFrame([(dt.date(2016, 1, 1), 2016), (dt.date(2017, 1, 1), 2017)], "date_id date, year int")
    out = {r["year"]: r for r in V.vw_yoy_spend(fact, dv, dd).collect()}
    assert out[2017]["yoy_spend_change"] == 250 and out[2017]["yoy_growth_pct"] == -250.0
