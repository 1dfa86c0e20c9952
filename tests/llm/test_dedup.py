"""Operators 1 to 4 against brute force, and their kernels."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vendorlens.llm import common, components, edits, induce, lines, mixing, quality, simhash, substrings, suffixes
from vendorlens.llm.texts import LAST


def key(row):
    return tuple((v is None, str(v)) for v in row)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


def test_induced_suffixes_equal_counting():
    rng = random.Random(1)
    for trial in range(300):
        letters = b"abcdefgh"[:rng.choice([1, 2, 3, 8])]
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        cap = rng.choice([1, 2, 5, 9])
        count = {}
        for s in strings:
            for i in range(len(s) - cap + 1):
                count[s[i:i + cap]] = count.get(s[i:i + cap], 0) + 1
        want = [[i for i in range(len(s) - cap + 1) if count[s[i:i + cap]] > 1] for s in strings]
        spilled = rng.choice([0, 1 << 20])  # all queues on disk, or none
        assert [x.tolist() for x in induce.Suffixes(strings, cap, spilled).repeated()] == want


def test_segments_hold_every_window_once_and_follow_content():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abc ") for _ in range(3000))
    first, last, h = suffixes.segments(text, 400)
    assert first[0] == 0 and last[-1] == len(text) - 400
    assert (first[1:] == last[:-1] + 1).all()
    shifted = suffixes.segments(b"zz" + text[500:1500], 400)
    of = {s: x for a, b, x in zip(first.tolist(), last.tolist(), h.tolist()) for s in range(a, b + 1)}
    for a, b, x in zip(*(v.tolist() for v in shifted)):
        assert all(of[s + 498] == x for s in range(max(a, 2), b + 1))


def test_suffix_dedup(make_docs, prose):
    out = suffixes.dedup(make_docs(prose))
    got = rows_of(out.withColumn("doc", F.nullif("doc", F.lit(LAST))), "doc", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = sorted(brute.repeated_bytes(prose), key=key)
    assert got == want
    assert sum(r[2] > 0 for r in got) > 10


@pytest.fixture
def passages():
    """Passages of 32 to 700 bytes, each in many documents with different text around it."""
    rng = random.Random(6)
    some = lambda n: "".join(rng.choice("abcdefghij klmn") for _ in range(n))
    rows = []
    for size in (40, 200, 390, 399, 400, 401, 700):
        passage = some(size)
        rows += [(size * 100 + i, some(rng.randint(300, 500)) + passage + some(rng.randint(300, 500))) for i in range(14)]
    rows += [(None, rows[0][1][:-1]), (None, rows[80][1][90:]), (1, rows[3][1]), (2, rows[3][1])]
    rng.shuffle(rows)
    return rows


def test_suffix_dedup_of_crowded_anchors(make_docs, passages):
    out = suffixes.dedup(make_docs(passages), crowd=1500).withColumn("doc", F.nullif("doc", F.lit(LAST)))
    got = rows_of(out, "doc", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.repeated_bytes(passages), key=key)
    assert sum(r[2] > 0 for r in got) > 50


def test_no_key_of_crowded_anchors_has_much_text(spark, passages):
    pieces = []
    for doc, text in passages:
        body = text.encode()
        for a, b, h in zip(*(x.tolist() for x in suffixes.segments(body))):
            pieces.append((h - (1 << 63), body[a:b + 400], doc or 0, a, 0, b + 400 - a, False))
    table = spark.createDataFrame(pieces, suffixes.KINDS)
    most = lambda df: max(r.n for r in df.groupBy("route").agg(
        F.sum(F.octet_length("body")).alias("n")).collect())
    whole = lambda df: {r.doc << 20 | r.pos + i for r in df.collect() for i in range(r.size - 399)}
    out = suffixes.stored(suffixes.uncrowded(suffixes.stored(table), 400, 1500))
    assert most(table) > 5000
    # a key may only go on having more if it is one window (of every task)
    assert most(out.where("size > 400")) <= 1500
    assert out.where("length(body) = 400").groupBy("route").agg(F.count_distinct("body").alias("n")).where("n > 3").isEmpty()
    assert whole(out) == whole(table)


def test_suffix_dedup_null_and_repeated_ids(make_docs):
    a, b = "x y z " * 100, "".join(chr(97 + i % 26) + str(i) for i in range(300))
    docs = [(None, a), (None, a + "q"), (7, b), (7, b), (7, b[:410] + "tail"), (8, None)]
    out = suffixes.dedup(make_docs(docs))
    got = rows_of(out.withColumn("doc", F.nullif("doc", F.lit(LAST))), "doc", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.repeated_bytes(docs), key=key)


def test_substring_dedup(make_docs, prose):
    out = substrings.dedup(make_docs(prose))
    got = rows_of(out.withColumn("doc", F.nullif("doc", F.lit(LAST))), "doc", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.repeated_windows(prose), key=key)
    assert sum(r[2] > 0 for r in got) > 10


def test_substring_dedup_repeated_rows_have_one_answer(make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    out = rows_of(substrings.dedup(make_docs([(1, text), (1, text), (2, text), (None, text)])), "doc", "n_removed")
    assert [r[1] for r in out] == [0, 0, 40, 40]


def test_texts_without_ids_stay_apart_where_half_their_hash_is_equal(spark, make_docs):
    word = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.concat(F.lit("n"), F.col("id"), F.lit("x"), i))
    texts = spark.range(400_000).select(F.array_join(word, " ").alias("text"))
    half = F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("half")
    pairs = texts.select("text", half).groupBy("half").agg(F.sort_array(F.collect_list("text")).alias("t"))
    alone, copied = pairs.where(F.size("t") == 2).first()["t"]
    docs = [(5, copied), (None, alone), (None, copied)]
    out = suffixes.dedup(make_docs(docs)).withColumn("doc", F.nullif("doc", F.lit(LAST)))
    assert rows_of(out, "doc", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(
        brute.repeated_bytes(docs), key=key)
    out = substrings.dedup(make_docs(docs)).withColumn("doc", F.nullif("doc", F.lit(LAST)))
    assert rows_of(out, "doc", "n_words", "n_removed", "kept_sha256") == sorted(brute.repeated_windows(docs), key=key)
    left = sorted((r.text, r.n_removed_lines) for r in lines.dedup(make_docs(docs)).collect())
    assert left == sorted([(copied, 0), (alone, 0), ("", 1)])


def test_difference_cover_meets_every_shift():
    cover, period = set(substrings.COVER), substrings.PERIOD
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_simhash(make_docs, prose):
    table, nodes = simhash.near_duplicates(make_docs(prose))
    out = table.join(nodes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id")
    assert rows_of(out, "doc_id", "f", "component_id") == sorted(brute.simhash(prose), key=key)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_simhash_links_lose_none(spark, bits):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(40)}
    fps |= {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in list(fps) for _ in range(4)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for block in (4, 4096):  # with crowded keys dealt out, and without
        edges = [(r.a, r.b) for r in simhash.links(df, bits, block).distinct().collect()]
        place = {f: i for i, f in enumerate(signed)}
        got = brute.groups(len(fps), [(place[a], place[b]) for a, b in edges])
        want = brute.groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i)
                                       if (fps[i] ^ fps[j]).bit_count() <= bits])
        assert got == want


def test_simhash_null_ids_and_keepers(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (5, text), (3, text), (3, text), (9, "other words here for all"), (None, "alone " * 9), (1, ""), (2, None)]
    kept = simhash.keep_one_of_each(make_docs(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=key) == sorted(
        [(3, text), (9, "other words here for all"), (None, "alone " * 9), (1, "")], key=key)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(5, 5)]
    random.Random(0).shuffle(edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 50)}}


def test_edit_distance_band():
    rng = random.Random(3)
    for limit in (0, 1, 2, 5):
        a = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 30))) for _ in range(200)]
        b = []
        for x in a:
            x = list(x)
            for _ in range(rng.randint(0, 5)):
                i = rng.randrange(len(x) + 1)
                x[i:i + rng.randint(0, 1)] = rng.choice(["", "a", "c"])
            b.append("".join(x))
        assert edits.within(a, b, limit).tolist() == [brute.edit_distance(x, y) <= limit for x, y in zip(a, b)]


def test_edits_of_long_strings_go_along_diagonals(monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(edits, "LONG", 0)
    for _ in range(400):
        limit = rng.choice([0, 1, 2, 4])
        a = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 14))) for _ in range(4)]
        b = [x if rng.random() < 0.2 else x[:k] + rng.choice("abc") + x[k + rng.randint(0, 2):]
             for x in a for k in [rng.randint(0, len(x))]]
        assert edits.within(a, b, limit).tolist() == [brute.edit_distance(x, y) <= limit for x, y in zip(a, b)]


def test_one_long_pair_beside_many_short_ones_takes_little_memory():
    rng = random.Random(13)
    long_line = "".join(rng.choices("abcdefgh ", k=1_000_000))
    left = ["short line %d of many others" % i for i in range(4000)] + [long_line, long_line, long_line]
    right = ["short line %d of many othars" % i for i in range(4000)] + [
        long_line[:500] + "XY" + long_line[500:], long_line[:10] + long_line[11:-1], long_line[:7] + "!" + long_line[10:]]
    tracemalloc.start()
    near = edits.within(left, right, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert near.tolist() == [True] * 4002 + [False] and peak < 200 << 20


@pytest.mark.parametrize("rows_each", [1, 2, 5, 1000])
def test_meetings_hold_one_line_of_a_key(rows_each):
    rng = random.Random(14)
    rows = sorted({(rng.randint(0, 40), rng.random() < 0.7, rng.randint(0, 6)) for _ in range(200)})
    rows = [(k, not probe, line) for k, probe, line in rows if (k, not probe, line) and not (probe and (k, False, line) in rows)]
    rows = [r for r in rows for _ in range(rng.randint(1, 3))]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], t) for j, t in enumerate((pa.int64(), pa.bool_(), pa.int64()))],
                                          ["key", "indexed", "line"])
               for part in (rows[i:i + rows_each] for i in range(0, len(rows), rows_each))]
    got = sorted((k, l) for b in lines._meetings(iter(batches)) for k, l in zip(b["key"].to_pylist(), b["line"].to_pylist()))
    of = {}
    for k, indexed, line in rows:
        of.setdefault(k, (set(), []))[0].add(line)
        of[k][1].append(indexed)
    assert got == sorted((k, l) for k, (ls, at) in of.items() if len(ls) > 1 and any(at) for l in ls)


def test_short_lines_go_only_when_exactly_repeated(make_docs):
    rows = [(1, "Read more\nRead mor\n\n  \n你好"), (2, "Read more \nRead Mora\n你好\n\n"), (3, "你们\nRead more")]
    out = {r.doc_id: (r.text, r.n_removed_lines) for r in lines.dedup(make_docs(rows)).collect()}
    assert out == {1: (rows[0][1], 0), 2: ("Read Mora\n\n", 2), 3: ("你们", 1)}


def test_line_dedup(make_docs):
    rng = random.Random(4)
    pool = ["".join(rng.choice("abcde fgh") for _ in range(rng.randint(15, 60))) for _ in range(40)]

    def line():
        x = list(rng.choice(pool))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            i = rng.randrange(len(x))
            x[i:i + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
        return rng.choice(["", " "]) + "".join(x)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 8)))) for i in range(40)]
    rows += [(100, ""), (101, None), (102, "\n\n"), (103, rows[0][1])]
    want = dict(zip([r[0] for r in rows], brute.line_dedup(rows)))
    for block in (3, 2048):
        removed = lines.removed_lines(lines.documents(make_docs(rows), "doc_id", "text"), block=block)
        gone = {r.doc: set(r.positions) for r in removed.collect()}
        for doc, text in rows:
            if text is not None:
                assert "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone.get(doc, ())) == want[doc]
    out = {r.doc_id: r.text for r in lines.dedup(make_docs(rows)).collect()}
    assert out == want


@pytest.mark.parametrize("run", [
    lambda d: suffixes.dedup(d), lambda d: substrings.dedup(d), lambda d: lines.dedup(d),
    lambda d: simhash.keep_one_of_each(d)])
def test_empty_tables(make_docs, run):
    assert run(make_docs([])).count() == 0


def test_clashing_columns_survive(make_docs):
    docs = make_docs([(1, "some words that are here\nsome words that are here"), (2, None)]).withColumns(
        {c: F.lit(i) for i, c in enumerate(["doc", "alt", "th", "fp", "row", "id", "positions", "lines", "key"])})
    assert lines.dedup(docs).drop("n_removed_lines").columns == docs.columns
    assert simhash.keep_one_of_each(docs).columns == docs.columns
    assert simhash.keep_one_of_each(docs).count() == 2


def test_checksum_of_nothing():
    from vendorlens.llm.texts import EMPTY_SHA256

    assert hashlib.sha256(b"").hexdigest() == EMPTY_SHA256
    assert np.bitwise_count(np.uint8(3)) == 2


@pytest.mark.parametrize("run", [
    lambda d: suffixes.dedup(d, length=60), lambda d: substrings.dedup(d), lambda d: lines.dedup(d),
    lambda d: simhash.keep_one_of_each(d),
    lambda d: quality.keep_good(d), lambda d: mixing.mix(d)])
def test_shuffled_hot_keys_give_what_broadcasts_give(make_docs, prose, monkeypatch, run):
    rows = [(d, t, f"h{i % 3}") for i, (d, t) in enumerate(prose)]
    docs = make_docs(rows)
    want = sorted(map(str, run(docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    assert sorted(map(str, run(docs).collect())) == want
