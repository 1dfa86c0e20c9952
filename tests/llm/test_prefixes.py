"""Operator 13 against a plain trie, in Python and in SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from vendorlens.llm import prefixes

KINDS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = plain.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        full = tuple(base[:h] + own[h:])
        for d in range(len(full) + 1):
            members[full[:d]].append(c)
        ends[full].append(c)
    children = defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, cs in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(cs) - 1) * len(key[-1][1]) if key else 0
    return sorted((min(cs), len(key), min(members[key[:-1]]) if key else None, len(cs), children[key], leaves[key],
                   saved[key], hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest())
                  for key, cs in members.items())


def found(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


@pytest.fixture
def talks():
    """Conversations with shared beginnings, copies, ties, nulls, gaps and a long one."""
    rng = random.Random(7)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(201, 240), *range(-120, -90), 500]:
        script = rng.choice(["abcabcab", "abcdabce", "xyz", "aaaaaaaaaaaa", "abcabcabx"])
        n = rng.randint(1, len(script))
        for turn in range(n):
            rows.append((c, turn * 2, rng.choice(["user", "user", "user", "tool"]), script[turn] * 5))
    rows += [(c, t, "user", "copy %d" % t) for c in range(300, 390) for t in range(9)]
    rows += [(400, t, "user" if t % 2 else "bot", "é" * (t % 7)) for t in range(300)]
    rows += [(400 + c, t, "user", "late" * (t // 6)) for c in range(1, 9) for t in range(30 - c)]
    rows += [(600, None, "user", "b"), (600, None, "user", "a"), (600, 1, None, "q"), (600, 1, "", None), (600, 1, "user", "q"),
             (600, 1, "user", "q"), (601, None, None, None), (None, 1, "user", "x"), (None, None, None, None),
             (602, 1, "user", "long" * 5000), (603, 1, "user", "long" * 5000), (604, 1, "a", "bc"), (605, 1, "ab", "c")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1, 4, 7])
def test_trie(spark, talks, block):
    df = spark.createDataFrame(talks, KINDS).withColumn("key", F.lit(1)).withColumn("conv", F.lit("x")).withColumn("pos", F.lit(0))
    assert found(prefixes.prefix_trie(df, block=block)) == brute(talks)


def test_trie_without_broadcasts(spark, talks, monkeypatch):
    monkeypatch.setattr("vendorlens.llm.common.BROADCAST_BYTES", 0)
    assert found(prefixes.prefix_trie(spark.createDataFrame(talks, KINDS))) == brute(talks)


def test_trie_in_sql(spark, talks, tmp_path):
    spark.createDataFrame(talks, KINDS).coalesce(1).write.parquet(str(tmp_path / "c"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    names = db.sql(prefixes.ORACLE).columns
    rows = [tuple(r[names.index(c)] for c in COLUMNS) for r in db.sql(prefixes.ORACLE).fetchall()]
    assert sorted(rows) == brute(talks)


def test_trie_of_nothing_and_of_turnless(spark):
    assert prefixes.prefix_trie(spark.createDataFrame([], KINDS)).count() == 0
    alone = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(alone, 1, "user", "gone"), (alone, 2, "bot", "gone")]
    assert found(prefixes.prefix_trie(spark.createDataFrame(rows, KINDS))) == brute(rows) == [
        (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_ids_in_many_texts_have_one_digest(spark):
    ids = list(range(-500, 9000, 3))
    ends = spark.createDataFrame([(b"k", i) for i in ids] + [(b"l", 4)], "key binary, conv long").repartition(5)
    got = {bytes(r.key): r.ends_sha256 for r in prefixes.end_digests(ends, limit=100).collect()}
    assert got == {b"k": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"l": hashlib.sha256(b"4").hexdigest()}


def test_path_totals(spark):
    rng = random.Random(8)
    up = {0: None} | {i: rng.randrange(max(0, i - 3), i) for i in range(1, 200)}
    paths = spark.createDataFrame([(i, u, 1, 1, i) for i, u in up.items()], "path long, up long, depth long, leaves long, saved long")
    want = {i: [1, i] for i in up}
    for i in sorted(up, reverse=True):
        if up[i] is not None:
            want[up[i]] = [x + y for x, y in zip(want[up[i]], want[i])]
    assert {r.path: [r.leaves, r.saved] for r in prefixes.path_totals(paths).collect()} == want
