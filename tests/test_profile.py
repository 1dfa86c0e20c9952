import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vendorlens.operators import eda as E
from vendorlens.operators import profile as P


def dups(spark):
    rows = [(None, "a"), (None, "b"), (1, "x"), (1, "x"), (1, "y"), (2, "z")]
    return spark.createDataFrame(rows, "k long, v string")


def test_dup_rows_and_keys_null_is_a_key(spark):
    df = dups(spark)
    assert P.dup_rows(df).first()["duplicate_rows"] == 1          # (1, x) twice
    assert P.dup_keys(df, "k").first()["duplicate_keys"] == 3     # null twice, 1 thrice


def test_profile_nulls_only_positive(spark):
    df = spark.createDataFrame([(None, 1.0, "a"), (None, None, "b"), (3, 2.0, "c")], "a long, b double, c string")
    got = {r["column"]: r["null_count"] for r in P.profile_nulls(df).collect()}
    assert got == {"a": 2, "b": 1}


def test_cardinality_excludes_nulls_and_sorts(spark):
    df = dups(spark).withColumn("d", F.lit(None).cast("decimal(12,2)"))
    got = [(r["column"], r["distinct_count"]) for r in P.profile_cardinality(df).collect()]
    assert got == [("d", 0), ("k", 2), ("v", 5)]
    approx = {r["column"]: r["distinct_count"] for r in P.profile_cardinality(df, approx=True).collect()}
    assert approx["k"] == 2


def test_describe_matches_numpy(spark):
    vals = [1.0, 2.0, 2.0, 3.5, 10.0, 7.25]
    df = spark.createDataFrame([(v, int(v)) for v in vals], "x double, i int")
    r = {row["column"]: row for row in P.profile_describe(df).collect()}["x"]
    assert r["count"] == 6 and abs(r["mean"] - np.mean(vals)) < 1e-12
    assert abs(r["std"] - np.std(vals, ddof=1)) < 1e-12
    assert [r["q25"], r["q50"], r["q75"]] == list(np.quantile(vals, [0.25, 0.5, 0.75]))


def test_histogram_puts_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "m double")
    got = {r["bucket"]: r["n"] for r in E.histogram(df, ["m"], bins=5).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}


def test_box_whiskers_and_outliers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([(float(v),) for v in vals], "m double")
    r = E.box_stats(df, ["m"]).first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (r["q1"], r["q3"]) == (q1, q3)
    assert r["outliers"] == 1 and r["whisker_high"] == 8.0 and r["whisker_low"] == 1.0


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in vals], "m double")
    pts = sorted((r["x"], r["density"]) for r in E.density_curve(df, ["m"], points=400).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
    assert 0.9 < area < 1.0     # grid spans min..max only; the tails lie outside


def test_correlation_pairs(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1, float((-1) ** i)) for i in range(20)], "a double, b double, c double")
    got = {(r["x"], r["y"]): r["r"] for r in E.correlation_matrix(df).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert abs(got[("a", "b")] - 1.0) < 1e-12


def test_density_close_to_the_kernel_sum_over_all_values(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), rng.uniform(4, 6, 1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "m double")
    got = {r["i"]: r["density"] for r in E.density_curve(df, ["m"], points=50).collect()}
    h = vals.std(ddof=1) * len(vals) ** -0.2
    grid = np.linspace(vals.min(), vals.max(), 50)
    want = np.exp(-0.5 * ((grid[:, None] - vals) / h) ** 2).sum(1) / (len(vals) * h * np.sqrt(2 * np.pi))
    assert np.allclose([got[i] for i in range(50)], want, rtol=2e-4, atol=1e-6)


def test_density_reads_at_most_the_bins(spark):
    df = spark.range(0, 20_000).select((F.col("id") * 0.37).alias("m"))
    weights, _ = E.binned(df, ["m"], 100)
    rows = weights.collect()
    assert len(rows) == 100 and sum(r["w"] for r in rows) == 20_000 * E.BIN_UNITS


def test_density_of_one_value(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "m double")
    assert E.binned(df, ["m"], 10)[0].count() == 1 and E.density_curve(df, ["m"], points=3).count() == 3


def test_correlation_with_nulls_and_large_ids_equals_pandas(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"a": rng.normal(size=900), "b": rng.integers(10 ** 12, 10 ** 12 + 500, 900).astype(float)})
    frame["c"] = frame["a"] * 0.3 + rng.normal(size=900)
    frame["d"] = 5.0
    frame.loc[rng.random(900) < 0.2, "a"] = None
    frame.loc[rng.random(900) < 0.3, "c"] = None
    rows = [tuple(None if pd.isna(x) else x for x in r) for r in frame.itertuples(index=False)]
    got = {(r["x"], r["y"]): r["r"] for r in E.correlation_matrix(
        spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)).collect()}
    want = frame.assign(b=frame["b"] - 10 ** 12).corr()  # pandas itself loses digits of large ids
    for (x, y), r in got.items():
        assert (r is None) == pd.isna(want[x][y]) and (r is None or abs(r - want[x][y]) < 1e-9)
    assert len(got) == 6


def test_cardinality_takes_one_column_at_a_time(spark):
    df = spark.createDataFrame([(1, 0.5, "a", True), (1, float("nan"), "b", None), (2, float("nan"), None, True)],
                               "i int, d double, s string, b boolean")
    out = P.profile_cardinality(df)
    assert [(r["column"], r["distinct_count"]) for r in out.collect()] == [("b", 1), ("d", 2), ("i", 2), ("s", 2)]
    # no row is expanded into a cell per column
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
