"""Operator 12 against brute force: recall, and exact where all lists are probed."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendorlens.llm import neighbours

KINDS = "vec_id long, embedding array<double>"


def brute(rows, every, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v)
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in sorted({i for i, _ in ok if i % every == 0}):
        mine = {tuple(v) for i, v in ok if i == q}
        found = [(float(np.sqrt(((v - np.array(m)) ** 2).sum())), c) for m in mine for c, v in ok if c != q and len(v) == len(m)]
        if found:
            out[q] = sorted(found)[:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [c for _, c in got[q]] == [c for _, c in want[q]], q
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12, atol=0)


@pytest.mark.parametrize("list_rows,part_rows,block_rows", [(10_000, 4096, 512), (20, 8, 3), (50, 1, 1)])
def test_all_lists_are_exact(spark, list_rows, part_rows, block_rows, monkeypatch):
    monkeypatch.setattr(neighbours, "SURE", 50.0)  # tests that never err
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(20)]) for i in range(200)]
    rows += [(300 + i, rows[10][1]) for i in range(40)] + [(400, rows[10][1])] * 30  # a hot vector, a hot row
    rows += [(500, None), (510, [1.0, None]), (520, [float("nan")] * 20), (530, [float("inf")] * 20), (540, [0.0] * 20),
             (550, [1.0, 2.0]), (551, [1.0, 2.5]), (552, [4.0, 2.5]), (None, [0.1] * 20), (560, []), (570, [1e-30] * 20),
             (580, [1e12] * 20), (590, [3.0]), (20, [rng.gauss(0, 1) for _ in range(20)])]
    df = spark.createDataFrame(rows, KINDS).withColumn("dim", F.lit("x")).withColumn("part", F.lit(1))
    vectors = neighbours.eligible(df, "vec_id", "embedding")
    out = neighbours.search(vectors, vectors.where("vec_id % 10 = 0"), 10, vectors.count(), list_rows, 1.0, part_rows, block_rows)
    same(answers(out), brute(rows, 10, 10))


def test_recall(spark):
    rng = np.random.default_rng(10)
    centre = rng.normal(size=(12, 48))
    points = centre[rng.integers(0, 12, 6000)] + rng.normal(size=(6000, 48))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    vectors = neighbours.eligible(spark.createDataFrame(rows, KINDS), "vec_id", "embedding")
    got = answers(neighbours.search(vectors, vectors.where("vec_id % 100 = 0"), 10, 6000, 200))
    want = brute(rows, 100, 10)
    assert got.keys() == want.keys() and all(len(got[q]) == 10 for q in got)
    assert np.mean([len({c for _, c in got[q]} & {c for _, c in want[q]}) / 10 for q in want]) >= 0.93
    for q, found in got.items():
        assert all(abs(s - np.linalg.norm(points[q] - points[c])) < 1e-12 for s, c in found) and found == sorted(found)


def test_tests_abandon_candidates_early_and_keep_near_ones():
    rng = np.random.default_rng(11)
    points = rng.normal(size=(4000, 128))
    part = neighbours.Part(np.arange(4000), np.ones(4000, np.int64), points)
    asked = points[:20] + 0.3 * rng.normal(size=(20, 128))
    far = np.sqrt(neighbours.squared_gaps(asked, points))
    limits = np.sort(far, 1)[:, 9]
    who, row = part.passing(asked, limits)
    near = {(q, r) for q, r in zip(*np.nonzero(far <= limits[:, None] * (1 - 1e-9)))}
    assert len(near & set(zip(who.tolist(), row.tolist()))) >= 0.97 * len(near)
    assert len(who) < 1.1 * len(near) + 20


def test_neighbours_of_nothing(spark):
    v = neighbours.eligible(spark.createDataFrame([], KINDS), "vec_id", "embedding")
    assert neighbours.search(v, v, 10, 0).count() == 0
    one = neighbours.eligible(spark.createDataFrame([(100, [1.0])], KINDS), "vec_id", "embedding")
    assert neighbours.search(one, one, 10, 1).count() == 0
