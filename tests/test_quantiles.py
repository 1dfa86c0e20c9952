import numpy as np
import pytest
from pyspark.sql import functions as F

from vendorlens.functions import quantiles as Q

PROBS = [0.0, 0.25, 0.33, 0.5, 0.66, 0.75, 1.0]


@pytest.fixture
def rough(monkeypatch):
    """A coarse sketch, so that brackets hold many values."""
    monkeypatch.setattr(Q, "ACCURACY", 100)
    monkeypatch.setattr(Q, "SLACK", 0.025)


def values():
    rng = np.random.default_rng(7)
    return np.concatenate([rng.normal(size=3000), np.full(500, 0.25), rng.integers(0, 5, 400)])


def check(spark, vals, probs=PROBS, kind="double", cast=float):
    df = spark.createDataFrame([(cast(v),) for v in vals] + [(None,)], f"x {kind}")
    assert np.allclose(Q.exact_quantiles(df, "x", probs), np.quantile(np.array(vals, float), probs), rtol=1e-15, atol=1e-12)


def test_exact_quantiles_match_numpy(spark):
    check(spark, values())


def test_with_a_rough_sketch(spark, rough):
    check(spark, values())


@pytest.mark.parametrize("off", [-0.2, 0.2])
def test_ranks_outside_a_wrong_bracket_are_found(spark, monkeypatch, off):
    right = Q._sketches
    monkeypatch.setattr(Q, "_sketches", lambda long, probs: right(long, [min(1.0, max(0.0, p + off)) for p in probs]))
    check(spark, values())


def test_a_heavy_value_takes_no_search_and_no_value_list(spark, monkeypatch, rough):
    calls, rows = [], []
    frame = type(spark.range(1))
    right, collect = Q._ranked, frame.collect
    monkeypatch.setattr(Q, "_ranked", lambda long, jobs: calls.append(len(jobs)) or right(long, jobs))
    monkeypatch.setattr(frame, "collect", lambda self: rows.append(collect(self)) or rows[-1])
    vals = [5] * 6000 + list(range(10, 6010))
    check(spark, vals, [0.1, 0.25, 0.4], "bigint", int)
    assert calls == []  # all ranks lie among the copies of one value
    check(spark, vals, [0.1, 0.5, 0.75], "bigint", int)
    assert len(calls) == 1
    # brackets, partitions' counts and one value per rank: nothing grows with the 12,000 values
    assert max(map(len, rows)) <= 6 * 16


def test_whole_numbers_beyond_doubles(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(big + i,) for i in range(1, 100)], "x bigint")
    long = Q._melt(df, ["x"])
    sketches = Q._sketches(long, [0.5])
    assert int(Q._order_stats(long, {(0, 0.5): [48, 49]}, sketches)[0, 49]) == big + 50


def test_many_columns_of_different_kinds(spark):
    rng = np.random.default_rng(8)
    rows = [(float(a), int(b), None) for a, b in zip(rng.normal(size=400), rng.integers(0, 50, 400))]
    df = spark.createDataFrame(rows, "a double, b int, c double").withColumn("d", (F.col("b") / 7).cast("decimal(12,2)"))
    got = Q.exact_quantiles_many(df, {"a": [0.5], "b": [0.25, 0.5], "c": [0.5], "d": [0.9]})
    a, b = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    d = np.array([float(r.d) for r in df.select("d").collect()])
    assert got["a"][0] == pytest.approx(np.quantile(a, 0.5)) and got["c"] == [None]
    assert got["b"] == pytest.approx(list(np.quantile(b, [0.25, 0.5]))) and got["d"][0] == pytest.approx(np.quantile(d, 0.9))


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert Q.exact_quantiles(df, "x", [0.5]) == [None]
