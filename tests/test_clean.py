import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from vendorlens.operators import clean as C
from vendorlens.operators import star as ST


def test_normalise_names(spark):
    df = spark.createDataFrame([(1, 2, dt.datetime(2020, 1, 1))],
                               ["Order Id", " Days for shipping (real) ", "Order date (DateOrders)"])
    assert C.normalise_columns(df).columns == ["order_id", "days_for_shipping_real", "order_date_dateorders"]


def sparse(spark):
    rows = [
        (None, 1.0, "x"), (None, None, "y"), (2.0, 3.0, None), (4.0, 5.0, "z"),
    ]
    return spark.createDataFrame(rows, "a double, b double, c string")


def test_drop_sparse_is_strict(spark):
    df = sparse(spark)  # a: 50% null -> dropped; b: 25% -> kept
    assert C.drop_sparse_columns(df).columns == ["b", "c"]
    assert C.drop_sparse_columns(df, threshold=0.51).columns == ["a", "b", "c"]


def test_impute_exact_median_then_drop(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (2.0, "c"), (10.0, None), (3.0, "e")],
                               "v double, s string")
    out = C.impute_median(df)
    vals = sorted(r["v"] for r in out.collect())
    assert vals == [1.0, 2.0, 2.5, 3.0, 10.0]  # median of 1,2,3,10 = 2.5
    assert C.drop_null_rows(out).count() == 4


def test_impute_integral_becomes_double(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    out = C.impute_median(df)
    assert dict(out.dtypes)["k"] == "double"
    assert sorted(r["k"] for r in out.collect()) == [1.0, 1.5, 2.0]


def test_validation_report_counts(spark):
    rows = [(1, 5.0, 3), (1, -1.0, 95), (None, 2.0, -2), (None, 2.0, 10), (2, 1.0, 90)]
    df = spark.createDataFrame(rows, "order_item_id long, sales_per_customer double, days_for_shipping_real int")
    r = C.validation_report(df).first().asDict()
    assert r == {"negative_spend": 1, "lead_time_outliers": 2, "duplicate_orders": 2}


def test_drop_pii_ignores_missing(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, customer_email string, product_image string")
    assert C.drop_pii(df).columns == ["id"]


def test_parse_timestamps_formats(spark):
    df = spark.createDataFrame([("2017-01-31 22:56:00",), ("1/31/2017 22:56",), ("12/1/2017 0:05:09",), (None,)], "d string")
    out = C.parse_timestamps(df, columns=("d",))
    assert dict(out.dtypes)["d"] == "timestamp_ntz"
    assert [r[0] for r in out.collect()] == [dt.datetime(2017, 1, 31, 22, 56), dt.datetime(2017, 1, 31, 22, 56),
                                             dt.datetime(2017, 12, 1, 0, 5, 9), None]


def test_parse_timestamps_bad_text_raises_or_is_counted(spark):
    df = spark.createDataFrame([("2017-01-31 22:56:00",), ("not a date",), (None,)], "d string")
    with pytest.raises(Exception, match="not a timestamp: not a date"):
        C.parse_timestamps(df, columns=("d",)).collect()
    assert [r[0] for r in C.parse_timestamps(df, columns=("d",), on_error="null").collect()] == [
        dt.datetime(2017, 1, 31, 22, 56), None, None]
    assert C.unparsed_timestamps(df, columns=("d",)).first()[0] == 1


def test_text_dates_keep_their_rows(spark):
    from vendorlens.operators import features as FE

    df = spark.createDataFrame([("1/2/2018 9:00", "1/5/2018 10:00"), ("2018-01-02 09:00:00", "2018-01-05 10:00:00")],
                               "order_date_dateorders string, shipping_date_dateorders string")
    out = C.filter_lead_time(FE.lead_time_days(C.parse_timestamps(df)))
    assert [r.lead_time_days for r in out.collect()] == [3, 3]


def test_filter_lead_time_inclusive(spark):
    df = spark.createDataFrame([(-1,), (0,), (90,), (91,), (None,)], "lead_time_days int")
    assert sorted(r[0] for r in C.filter_lead_time(df).collect()) == [0, 90]


def test_nulls_in_the_sources_are_cleaned(spark):
    from vendorlens.plans.catalog import clean_order_items
    from vendorlens.sources.orders import raw_order_items

    raw = raw_order_items(spark, "/root/testdata/sf0.001").cache()
    n, prices = raw.count(), [float(r[0]) for r in raw.select("Sales").collect()]
    holes = raw.withColumn("Sales", F.expr("if(`Order Item Id` % 3 = 0, null, Sales)")).withColumn(
        "Market", F.expr("if(`Order Item Id` % 5 = 0, null, Market)")).withColumn("Product Name", F.expr(
            "if(`Order Item Id` % 4 > 0, null, `Product Name`)"))
    items, validated = clean_order_items(holes)
    assert "product_name" not in items.columns  # three quarters are null
    assert 0 < validated.count() == holes.where("Market IS NOT NULL").count() < n
    left = [float(r[0]) for r in holes.select("Sales").dropna().collect()]
    filled = {float(r[0]) for r in validated.where("order_item_id % 3 = 0").select("sales").collect()}
    assert len(filled) == 1 and len(left) < len(prices)
    assert abs(filled.pop() - statistics.median(left)) < 0.006  # in the column's two decimals
    whole, every = clean_order_items(raw)
    assert every.count() == n and "product_name" in whole.columns


def test_case_and_accents_do_not_split_a_key(spark):
    rows = [(1, "FRANCE", "Paris"), (2, "France", "paris"), (3, "france", "PARIS"), (4, "Éire", "Cork"), (5, "eire", "Córk"),
            (6, None, "cork"), (7, "Peru", None)]
    out = C.canonical_spellings(spark.createDataFrame(rows, "id long, country string, city string"), ["country", "city"])
    assert out.columns == ["id", "country", "city"]
    got = {r.id: (r.country, r.city) for r in out.collect()}
    assert got == {1: ("FRANCE", "PARIS"), 2: ("FRANCE", "PARIS"), 3: ("FRANCE", "PARIS"), 4: ("eire", "Cork"), 5: ("eire", "Cork"),
                   6: (None, "Cork"), 7: ("Peru", None)}
    clean = out.selectExpr("country AS order_country", "city AS order_region", "'m' AS market")
    assert ST.dim_region(clean).where("country = 'FRANCE'").count() == 1


def test_sketches_of_groups_merge(spark):
    from vendorlens.operators import profile as P

    df = spark.range(0, 60_000).selectExpr("id % 7 AS g", "id % 20000 AS a", "cast(id % 30 as double) AS b", "concat('t', id) AS c",
                                           "if(id % 2 = 0, null, id) AS d")
    sketches = P.cardinality_sketches(df, ["g"]).cache()
    assert sketches.count() == 7 * 4
    got = {r["column"]: r.distinct_count for r in P.cardinality_from_sketches(sketches).collect()}
    for c, n in {"a": 20_000, "b": 30, "c": 60_000, "d": 30_000}.items():
        assert abs(got[c] - n) <= 4 * P.SKETCH_ERROR * n + 1
    some = P.cardinality_from_sketches(sketches.where("g < 2"))
    assert abs({r["column"]: r.distinct_count for r in some.collect()}["c"] - 60_000 * 2 / 7) < 600


def test_parse_timestamps_query_keeps_pending_orders(spark, tmp_path):
    import os

    from vendorlens.plans.registry import queries

    src = "/root/testdata/sf0.001"
    for t in ("lineitem", "part", "customer", "nation", "region"):
        os.symlink(f"{src}/{t}.parquet", tmp_path / f"{t}.parquet")
    # every order pending, at a time with seconds that the shortest format cannot hold
    orders = spark.read.parquet(f"{src}/orders.parquet").withColumn("o_orderstatus", F.lit("P")).withColumn(
        "o_orderdate", F.expr("o_orderdate + INTERVAL '1:02:03.5' HOUR TO SECOND"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    q = queries()
    got = q["parse_timestamps"](spark, str(tmp_path)).collect()
    assert len(got) == spark.read.parquet(f"{src}/lineitem.parquet").count()
    assert all(r.order_date_dateorders.microsecond == 500000 for r in got)
    assert q["quarantined_rows"](spark, str(tmp_path)).count() == len(got)


def test_formats_are_tried_only_on_texts_of_their_shape(spark):
    texts = ["1/2/2018", " 1/2/2018", "1/2/2018 9:0", "1/2/2018 9:00", "1/2/2018 09:00:01", "01/2/+12018", "1/2", "1/2/2018 9:00 x", ""]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    for f in C.TIMESTAMP_FORMATS[1:]:
        plain = F.try_to_timestamp(F.col("d"), F.lit(f)).cast("timestamp_ntz").cast("string")
        got = df.select(C._parsed(F.col("d"), f).cast("string").alias("e"), plain.alias("p")).collect()
        assert [r.e for r in got] == [r.p for r in got]
    assert C._shape("yyyy-MM-dd") is None and C._shape("M/d/yyyy H:mm")


def _tables_with_nulls(spark, folder):
    """The small tables with nulls in every column, some keys included."""
    from vendorlens.sources.orders import SOURCE_COLUMNS

    for i, t in enumerate(SOURCE_COLUMNS):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        part = 5 if t in ("nation", "region") else 40
        cols = [F.when(F.pmod(F.xxhash64(F.lit(k + 100 * i), F.col(df.columns[0]), F.monotonically_increasing_id()), F.lit(part)) != 0, F.col(c)).alias(c)
                for k, c in enumerate(df.columns)]
        df.select(*cols).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


def test_presence_has_the_nulls_of_the_raw_items(spark, tmp_path):
    from vendorlens.sources.orders import raw_order_items, raw_presence

    d = _tables_with_nulls(spark, tmp_path)
    for vendor, category, full in (("supplier", "type", True), ("customer", "brand", False)):
        raw = raw_order_items(spark, d, vendor, category, full)
        there = raw_presence(spark, d, vendor, category, full)
        assert there.columns == raw.columns
        mask = [F.col(f"`{c}`").isNotNull() for c in raw.columns]
        count = lambda df: {tuple(r)[:-1]: r[-1] for r in df.groupBy(*[m.alias(f"m{i}") for i, m in enumerate(mask)]).count().collect()}
        assert count(raw) == count(there) and C.null_counts(raw).first() == C.null_counts(there).first()
        assert raw.count() > 100


def test_items_are_built_without_a_wide_copy_of_the_raw_rows(spark):
    from vendorlens.plans.catalog import Catalog

    cat = Catalog(spark, "/root/testdata/sf0.001")
    assert cat.items.count() > 0 and "raw_stored" not in cat.__dict__
    # the tables that grow with the items are joined alike at every size
    plan = cat.raw._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and plan.count("BroadcastHashJoin") == 1
