import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendorlens.operators import clean as C
from vendorlens.operators import star as ST
from vendorlens.plans.catalog import catalog_for
from vendorlens.plans.publish import CheckFailed, TableStore, references, unique_key
from vendorlens.sources import files


def test_csv_quirks(spark):
    d = tempfile.mkdtemp(prefix="vendorlens-test-")
    p = os.path.join(d, "raw.csv")
    with open(p, "wb") as f:
        f.write(b'Order Id,Customer City,Sales\r\n1,"Ath\xe8nes, GR",10.5\r\n2,Plain,3\r\n')
    schema = T.StructType([T.StructField("Order Id", T.IntegerType()), T.StructField("Customer City", T.StringType()),
                           T.StructField("Sales", T.DoubleType())])
    rows = files.scan_raw_csv(spark, p, schema).orderBy("Order Id").collect()
    assert rows[0]["Customer City"] == "Athènes, GR" and rows[0]["Sales"] == 10.5
    assert rows[1]["Customer City"] == "Plain"           # CRLF stripped
    q = os.path.join(d, "clean.csv")
    with open(q, "wb") as f:
        f.write("﻿a,b\r\n1,x\r\n".encode("utf-8"))
    back = files.scan_clean_csv(spark, q, T.StructType([T.StructField("a", T.IntegerType()),
                                                         T.StructField("b", T.StringType())])).collect()
    assert [tuple(r) for r in back] == [(1, "x")]


def test_typed_load_is_positional(spark):
    d = tempfile.mkdtemp(prefix="vendorlens-test-")
    p = os.path.join(d, "scores.csv")
    with open(p, "w") as f:
        f.write("whatever,names\n7,0.1234567\n")
    schema = T.StructType([T.StructField("vendor", T.LongType()), T.StructField("score", T.DecimalType(10, 6))])
    r = files.load_typed_csv(spark, p, schema).first()
    assert r["vendor"] == 7 and str(r["score"]) == "0.123457"


def test_fact_does_not_fan_out_on_two_markets(spark):
    clean = spark.createDataFrame(
        [(1, "EU", "FR", "m1"), (2, "EU", "FR", "m2")],
        "order_item_id long, order_region string, order_country string, market string")
    cols = {"order_id": "1", "order_customer_id": "5", "product_card_id": "6",
            "order_date_dateorders": "timestamp_ntz'2020-01-01 00:00:00'",
            "shipping_date_dateorders": "timestamp_ntz'2020-01-02 00:00:00'", "lead_time_days": "1",
            "order_item_quantity": "1", "spend_per_order": "cast(1 as decimal(12,2))", "late_delivery_flag": "0",
            "delivery_status": "'x'", "shipping_mode": "'m'"}
    for c, e in cols.items():
        clean = clean.withColumn(c, F.expr(e))
    fact = ST.fact_orders(clean, ST.dim_region(clean))
    assert fact.count() == 2 and fact.select("region_id").distinct().count() == 2


def test_sql_views_by_name(spark):
    cat = catalog_for(spark, "/root/testdata/sf0.001")
    names = cat.register_views()
    assert "vw_kpi_summary" in names and "fact_orders" in names
    n = spark.sql("SELECT count(*) FROM vw_vendor_risk_master").first()[0]
    assert n == cat.dim_vendor.count()
    assert spark.sql("SELECT total_vendors FROM vw_kpi_summary").first()[0] == n


def test_cli_build_writes_every_artifact(spark):
    from vendorlens.__main__ import build

    out = tempfile.mkdtemp(prefix="vendorlens-test-")
    counts = build(spark, "/root/testdata/sf0.001", out + "/a", "supplier", "type")
    assert counts["staging_orders"] == 226 and counts["fact_orders"] == 223
    for name in ("validation_report", "staging_orders", "fact_orders", "top12_dual_sourcing"):
        assert os.path.isdir(os.path.join(out, "a", name))
    back = spark.read.parquet(out + "/a/staging_orders")
    assert back.count() == 226 and "order_year" in back.columns


def test_staging_load_tolerates_bom_crlf_and_quotes(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                           T.StructField("c", T.DecimalType(6, 2))])
    p = tmp_path / "f.csv"
    p.write_bytes('\ufeffx,y,z\r\n1,"Athens, ""GR""",2.50\r\n2,,\r\n'.encode())
    rows = [tuple(map(str, r)) for r in files.load_typed_csv(spark, str(p), schema).collect()]
    assert rows == [("1", 'Athens, "GR"', "2.50"), ("2", "None", "None")]
    back = str(tmp_path / "again")
    files.write_csv(files.load_typed_csv(spark, str(p), schema), back, line_end="\r\n")
    assert sorted(map(str, files.load_typed_csv(spark, back, schema).collect())) == sorted(
        map(str, files.load_typed_csv(spark, str(p), schema).collect()))


def test_staging_load_refuses_other_types_and_widths(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    p = tmp_path / "f.csv"
    p.write_text("a,b\n1,x\nmany,y\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        files.load_typed_csv(spark, str(p), schema).collect()
    q = tmp_path / "g.csv"
    q.write_text("a,b,c\n1,x,z\n")
    with pytest.raises(ValueError, match="3 columns"):
        files.load_typed_csv(spark, str(q), schema)


def test_malformed_records_and_dates_are_set_aside_in_one_pass(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_bytes(b"Order Id,Order Date,City\n1,1/31/2017 22:56,Ath\xe8nes\nx2,2017-01-01,B\n3,31.1.2017,C\n4,2017-02-01,\n")
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("order_date", T.StringType()),
                           T.StructField("city", T.StringType())])
    raw = files.scan_with_rejects(spark, str(p), schema)
    good, bad = files.set_aside(C.parse_timestamps(raw, ["order_date"], on_error="quarantine"))
    assert sorted((r.order_id, str(r.order_date), r.city) for r in good.collect()) == [
        (1, "2017-01-31 22:56:00", "Athènes"), (4, "2017-02-01 00:00:00", None)]
    reasons = sorted(r.reject_reason for r in bad.collect())
    assert reasons[0].startswith("malformed record: x2,") and reasons[1] == "order_date: not a timestamp: 31.1.2017"
    report = C.validation_report(good.selectExpr("order_id", "1 AS s", "2 AS d"), "s", "d", "order_id", rejected=bad).first()
    assert report.rejected_rows == 2 and report.duplicate_orders == 0


def test_a_version_that_breaks_a_key_is_not_published(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    with pytest.raises(LookupError):
        store.read("dim")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    store.publish("dim", dim, [unique_key("id")])
    first = store.current("dim")
    with pytest.raises(CheckFailed, match="id: 1 values repeat"):
        store.publish("dim", dim.union(dim.limit(1)), [unique_key("id")])
    fact = spark.createDataFrame([(1, 1), (2, 5)], "item long, dim_id long")
    with pytest.raises(CheckFailed, match="dim_id: 1 rows match no id"):
        store.publish("fact", fact, [unique_key("item"), references("dim_id", store.read("dim"), "id")])
    assert store.current("dim") == first and store.read("dim").count() == 2 and store.current("fact") is None


def test_versions_expire_and_lost_writers_leave_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    for i in range(4):
        store.publish("t", spark.range(i + 1))
    spark.range(9).write.parquet(f"{store.root}/t/lost")           # written, never published
    os.makedirs(f"{store.root}/t/_claims", exist_ok=True)
    open(f"{store.root}/t/_claims/000000000005", "w").close()       # claimed, never published
    old = store.manifests("t")
    assert len(store.expire("t", keep=2)) == 3 and [n for n, _ in store.manifests("t")] == [3, 4]
    assert store.read("t").count() == 4 and store.read("t", old[2][1]).count() == 3
    store.publish("t", spark.range(7))
    assert store.manifests("t")[-1][0] == 6 and store.read("t").count() == 7


def test_catalog_follows_its_tables(spark, tmp_path):
    from vendorlens.plans.catalog import catalog_for
    from vendorlens.sources.orders import SOURCE_COLUMNS

    data = str(tmp_path / "data")
    for t in SOURCE_COLUMNS:
        df = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        (df.where("l_linenumber = 1") if t == "lineitem" else df).write.parquet(f"{data}/{t}.parquet")
    cat = catalog_for(spark, data)
    n = cat.raw_stored.count()
    assert catalog_for(spark, data + "/") is cat
    more = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_linenumber = 2")
    more.write.mode("append").parquet(f"{data}/lineitem.parquet")
    fresh = catalog_for(spark, data)
    assert fresh is not cat and fresh.raw_stored.count() > n and cat.raw_stored.count() == n


def test_rows_are_set_aside_without_a_sort_by_folder(spark):
    df = spark.range(20).select("id", F.when(F.col("id") % 4 == 0, F.lit("bad")).alias(files.REASON))
    good, bad = files.set_aside(df)
    assert (good.count(), bad.count()) == (15, 5)
    assert good.columns == ["id"] and bad.columns == ["id", files.REASON]
    assert not any("rejected=" in f for f in good.inputFiles())
