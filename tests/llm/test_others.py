"""Operators 5 to 10 and the pipeline against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vendorlens.llm import licenses, mixing, packing, quality, topk, urls

PARTS = "doc_id long, text string, lang string, source string, n_chars long"


def key(row):
    return tuple((v is None, str(v)) for v in row)


# --- search -------------------------------------------------------------

def best(rows, every, k):
    out = {}
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, a in ok:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q and len(b) == len(a))
            out[q] = [(c, -s) for s, c in scores[:k]]
    return out


@pytest.mark.parametrize("shard_rows,leaf_rows,block_rows", [(1000, 8, 100), (30, 4, 2), (7, 1, 1)])
def test_topk(spark, shard_rows, leaf_rows, block_rows):
    rng = random.Random(6)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), 0.5, 0.0]) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(300, None), (310, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (320, [float("nan")] * 6), (330, [float("inf")] * 6),
             (340, [0.25, 0.5]), (350, [1.0, 1.0]), (None, [0.1] * 6), (360, []), (370, [3e8] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("dim", F.lit("x"))
    vectors = topk.scaled(df, "vec_id", "embedding")
    found = topk.search(vectors, vectors.where("vec_id % 10 = 0"), 5, 180, shard_rows, leaf_rows, block_rows)
    got = defaultdict(list)
    for r in sorted(found.collect()):
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    want = {q: x for q, x in best(rows, 10, 5).items() if x}
    assert got == want


def test_topk_of_a_row_that_repeats(spark):
    df = spark.range(20_000).selectExpr("if(id < 15000, 50, id) AS vec_id", "if(id < 15000, array(0.5D, 0.25D), "
                                        "array(id % 97 / 97D, id % 89 / 89D)) AS embedding")
    v = topk.scaled(df, "vec_id", "embedding")
    assert topk.few_copies(v, 5).where("vec_id = 50").count() == 5
    asked = v.where("vec_id IN (50, 15001)")
    got = sorted(map(tuple, topk.search(v, asked, 5, 20_000, 512, 64, 8).collect()))
    v.createOrReplaceTempView("repeats")
    asked.distinct().createOrReplaceTempView("asked_once")
    want = spark.sql("""
        SELECT query_id, rank, vec_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
            SELECT q.vec_id AS query_id, r.vec_id, CAST(q.v[0] * r.v[0] + q.v[1] * r.v[1] AS BIGINT) AS score
            FROM asked_once q JOIN repeats r ON r.vec_id <> q.vec_id)) WHERE rank <= 5 AND query_id = 15001""")
    assert [r for r in got if r[0] == 15001] == sorted(map(tuple, want.collect()))
    assert [r[1] for r in got if r[0] == 50] == [1, 2, 3, 4, 5]


def test_topk_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    v = topk.scaled(df, "vec_id", "embedding")
    assert topk.search(v, v, 5, 0).count() == 0


# --- quality ------------------------------------------------------------

def test_quality(make_docs, prose):
    rows = [(d, t, f"h{i % 4}") for i, (d, t) in enumerate(prose)]
    rows += [(500 + i, "bad # page", "junk") for i in range(30)] + [(530 + i, "word%d next " % i * 40, None) for i in range(4)]
    rows += [(540, " ".join(f"w{i}" for i in range(80)), "junk")]
    docs = make_docs(rows)
    measured = quality.stored(quality.measure(docs))
    got = quality.judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                         "base_failed", "kept")
    want = brute.quality(rows)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {r[0] for r in want if r[7]}
    assert 540 not in {r[0] for r in want if r[7]}  # its host is rejected


def test_quality_edges(make_docs):
    assert quality.keep_good(make_docs([])).count() == 0
    docs = make_docs([(1, "a b c " * 9), (1, None), (None, "")]).withColumn("host", F.lit(1)).withColumn("row", F.lit(2))
    assert quality.keep_good(docs).columns == docs.columns


# --- licences -----------------------------------------------------------

def license_brute(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, base = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        at = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    s = " " + " ".join(ws) + " " if ws else " "
    found = []
    for n, (priority, label, word, pattern, confidence) in enumerate(licenses.rules()):
        if word in s:
            found += [(priority, m.start(), m.end(), n, label, confidence) for m in re.finditer(pattern, s)]
    left = [d for d in found if not any(
        o is not d and o[0] <= d[0] and o[1] <= d[1] and o[2] >= d[2] and ((o[1], o[2]) != (d[1], d[2]) or (o[0], o[3]) < (d[0], d[3]))
        for o in found)]
    score = max([0.5 if starts else 0.0, *[d[5] for d in left]])
    return (len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {d[4] for d in left})), score, len(left))


def test_licenses(make_docs):
    texts = ["Licensed under CC BY-NC 4.0, all rights reserved.", "This work is licensed under the GNU General Public License, version 3.",
             "Licensed under the Apache License, Version 2.0 (the License); MIT License MIT License", "Released under the MIT License.",
             "CC BY CC BY cc by-sa 3.0 cc  by", "no words of that kind, reserved seats", "", None, "¡Ünïcode! CC BY " + "x " * 3000 + "gpl v2",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "!!! ---",
             "SPDX-License-Identifier: GPL-2.0 or Apache 2.0; copyright (c) 2020 all rights reserved", "BSD 3-clause license", "cc0"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, texts[0]), (3, texts[1])]
    got = licenses.scan(make_docs(rows)).collect()
    want = [(i, *license_brute(t)) for i, t in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert len(licenses.rules()) > 200


def test_license_gate_lets_every_rule_through():
    import re

    for _, _, word, _, _ in licenses.rules():
        assert re.search(licenses.gate(), f" {word}"), word


def matched_by(pattern, rng):
    """A random text that a rule's pattern matches."""
    from re import _constants as op, _parser

    def some(items):
        out = ""
        for kind, value in items:
            if kind is op.LITERAL:
                out += chr(value)
            elif kind is op.NOT_LITERAL:
                out += "q"
            elif kind is op.IN:
                what, c = rng.choice(value)
                out += chr(c if what is op.LITERAL else rng.randint(*c))
            elif kind is op.BRANCH:
                out += some(rng.choice(value[1]))
            elif kind is op.SUBPATTERN:
                out += some(value[3])
            elif kind is op.MAX_REPEAT:
                out += "".join(some(value[2]) for _ in range(rng.randint(value[0], min(value[1], 3))))
            else:
                assert kind in (op.ASSERT, op.ASSERT_NOT), kind
        return out

    return some(_parser.parse(pattern))


def test_license_keywords_and_gate_drop_no_match():
    import re

    rng, gate = random.Random(7), licenses.gate()
    for _, _, word, pattern, _ in licenses.rules():
        for _ in range(20):
            s = f" {matched_by(pattern, rng)} "
            assert re.search(pattern, s), (pattern, s)
            assert f" {word}" in s and re.search(gate, s), (word, s)


def test_no_license_rule_repeats_another():
    found = [(label, pattern) for _, label, _, pattern, _ in licenses.rules()]
    assert len(set(found)) == len(found) and len(licenses.WORDING) > 200
    assert not any("licensed under cc" in pattern for _, pattern in found)


def test_licenses_equal_matching_without_keyword_and_gate(make_docs, monkeypatch):
    named = {"Creative Commons Attribution-ShareAlike": "cc-by-sa", "Creative Commons Attribution-NonCommercial": "cc-by-nc",
             "Creative Commons Attribution-NoDerivatives": "cc-by-nd", "Creative Commons Attribution Share Alike": "cc-by-sa",
             "Creative Commons Attribution-NonCommercial-ShareAlike": "cc-by-nc-sa", "under GPLv3.": "gpl-3.0",
             "Creative Commons Attribution-NonCommercial-NoDerivs": "cc-by-nc-nd", "the GPLv2 or": "gpl-2.0",
             "LGPLv2.1": "lgpl-2.1", "AGPLv3": "agpl-3.0", "GNU LGPL": "lgpl", "the AGPL": "agpl", "GPL": "gpl",
             "Licensed under the BSD license": "bsd", "ISC-licensed": "isc", "the MIT licence": "mit",
             "dual licensed MIT/Apache-2.0": "apache-2.0,mit", "GPL-2.0-or-later": "gpl-2.0-or-later", "GFDL 1.3": "fdl-1.3", "MPL 2.0": "mpl-2.0", "Apache2": "apache-2.0", "a simple example": ""}
    full = [f"{w} under the {t}MIT license" for w in ("licensed", "distributed", "available", "released")
            for t in ("", "terms of the ")]
    rng = random.Random(8)
    texts = [*named, *full, *[matched_by(r[3], rng) for r in licenses.rules()]]
    got = sorted(map(tuple, licenses.scan(make_docs(list(enumerate(texts)))).collect()))
    assert [r[6] for r in got[:len(named)]] == list(named.values())
    assert {(r[6], r[7]) for r in got[len(named):len(named) + len(full)]} == {("mit", 1.0)}
    everywhere = [(p, label, "", pattern, c) for p, label, _, pattern, c in licenses.rules()]
    monkeypatch.setattr(licenses, "rules", lambda: everywhere)
    assert got == [(i, *license_brute(t)) for i, t in enumerate(texts)]


# --- packing ------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def test_word_ids_equal_whole_texts(tokenizer, prose):
    cache = packing.WordIds(packing.default_tokenizer())
    odd = ["It's. don't, 'S 12.5 a.b. …ÀÉ. x.\ny,\tz", "<|endoftext|> <|ENDOFTEXT|>", "e\u0301. ﬁne, Straße ΑΣ.", "a\x0bb\x1cc d\u00a0e",
           "....,,, a.. b,.", "\u2028x İ.", "z." * 50]
    texts = [t or "" for _, t in prose] + odd
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for _ in range(2):
        assert cache.of_texts(texts) == want
        assert [cache.of_texts([t])[0] for t in texts] == want


def test_word_ids_of_a_mark_that_joins_small_letters_only(tokenizer):
    texts = ["T\u0308 t\u0308 H\u0331x J\u030c W\u030a Y\u030a", "T\u0316\u0308.", "E\u0308 e\u0308 u\u0308ber T"]
    got = packing.WordIds(packing.default_tokenizer()).of_texts(texts)
    assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_word_ids_encode_a_stem_once(tokenizer, monkeypatch):
    seen = []
    encode = packing.WordIds._encode
    monkeypatch.setattr(packing.WordIds, "_encode", lambda self, *ways: seen.extend(w for x in ways for w in x[1]) or encode(self, *ways))
    texts = ["hedge hedge. hedge, hedge%%% hedge!! (hedge) hedge's don't", "a@b.c 12.5 'tis ''s it's' x're\x1fy\x7f\0z",
             "Éclair Éclair, éclair; größer Größe größe. ß ß.", "ÿ Ÿ. naïve×naïve ñ+ K. Å Ω's", "слово слово, «слово» 日本語。", "\u00a0 \u0085 a",
             "Hedge Éclair hedge."]
    cache = packing.WordIds(packing.default_tokenizer())
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert cache.of_texts(texts) == want and [cache.of_texts([t])[0] for t in texts] == want
    assert max(seen.count(w) for w in ("hedge", "éclair", "größe", "слово", ".", "%%%")) <= 2  # Éclair and éclair are two words
    assert seen.count("hedge") == seen.count("%%%") == 1
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    assert [cache.of_texts([t])[0] for t in texts] == want


def check_packing(rows, out, tokenizer, length):
    docs = {d: brute.tokens(tokenizer, t) for d, t in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in out:
        ids = docs[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == brute.crc(ids[r.start:r.start + r.length]) and r.length > 0
        pieces[r.doc_id].append((r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == docs.keys()
    for d, parts in pieces.items():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
        assert at == len(docs[d])
    padding = 0
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


@pytest.mark.parametrize("length,group_docs", [(64, 4096), (256, 10), (2048, 4096)])
def test_packing(make_docs, prose, tokenizer, length, group_docs):
    out = packing.pack(make_docs(prose), length=length, group_docs=group_docs).collect()
    padding = check_packing(prose, out, tokenizer, length)
    assert padding <= 0.02 * sum(r.length for r in out) + length * len(prose) // group_docs


def test_first_fit_decreasing_takes_the_first_bin():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 60, 300)
    got, left = packing.first_fit_decreasing(sizes, [64] * 300)
    room = [64] * 300
    for i in np.argsort(-sizes, kind="stable"):
        b = next(j for j, r in enumerate(room) if r >= sizes[i])
        room[b] -= sizes[i]
        assert got[i] == b
    assert left == room
    assert packing.first_fit_decreasing(np.array([5]), [4])[0].tolist() == [-1]


def test_packing_edges(make_docs, tokenizer):
    assert packing.pack(make_docs([])).count() == 0
    out = packing.pack(make_docs([(None, "a b"), (None, "a b"), (1 << 60, None)]).withColumn("grp", F.lit(1))).collect()
    assert sum(r.length for r in out) == 3 + 3 + 1 and {r.doc_id for r in out} == {None, 1 << 60}


def test_packing_spreads_equal_rows_over_all_groups(spark, tokenizer):
    path = packing.default_tokenizer()
    same = spark.range(0, 20_000, 1, 6).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    dealt = packing.measured(same, "doc_id", "text", path, 2048, 1, 5).groupBy("grp").agg(F.sum("copies").alias("n")).collect()
    assert len(dealt) == 5 and sum(r.n for r in dealt) == 20_000 and all(2800 < r.n < 5200 for r in dealt)
    out = packing.pack(same.limit(3000).unionByName(spark.createDataFrame([(1, "a b")], same.schema)), group_docs=700).collect()
    assert sum(r.length for r in out) == 3003 and sum(r.doc_id is None for r in out) == 3000


# --- mixing -------------------------------------------------------------

def wanted_targets(size):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, total, target = set(names), 1.5 * sum(size.values()), {}
    while left:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if 2 * size[s] <= weight[s] * level}
        if not full:
            return target | {s: weight[s] * level for s in left}
        target |= {s: 2.0 * size[s] for s in full}
        left -= full
    return target


@pytest.mark.parametrize("bucket_rows", [4096, 5])
def test_mixing(make_docs, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 50), rng.choice(["a", "a", "a", "b", "é", "Z", None, "zz"])) for i in range(120)]
    rows += [(500, None, "empty"), (501, "x y z", "zz"), (501, "x y z", "zz")]
    docs = make_docs(rows)
    sizes = mixing.stored(mixing.shuffled(docs, "doc_id", "text", "source", ["doc_id", "text"]))
    got = mixing.place(sizes).collect()
    total = defaultdict(int)
    for _, t, s in rows:
        total[s] += len((t or "").split())
    target = wanted_targets(total)
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == total[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in total:
        assert abs(taken[s] - target[s]) < 1
    out = mixing.mix(docs).collect()
    words = defaultdict(int)
    for r in out:
        words[r.source] += len((r.text or "").split())
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}
    again = mixing.mix(docs).collect()
    assert sorted(map(tuple, out), key=key) == sorted(map(tuple, again), key=key)


def test_training_time_inverts_demand(spark):
    df = spark.range(0, 101).select((F.col("id") / 100).alias("t"))
    for tilt in (-0.5, 0.0, 0.5, 0.9):
        d = mixing.demand(F.col("t"), F.lit(700.0), F.lit(tilt))
        back = df.select("t", mixing.training_time(d, F.lit(700.0), F.lit(tilt)).alias("u")).collect()
        assert all(r.u == pytest.approx(r.t, abs=1e-9) for r in back)


@pytest.mark.parametrize("most", [1.0, 2.5, 3.0])
def test_mixing_takes_as_many_passes_as_it_may(make_docs, most):
    docs = make_docs([(i, " ".join(f"w{i}x{k}" for k in range(10)), "only") for i in range(6)])
    taken = sum(len(r.text.split()) for r in mixing.mix(docs, share=most, most=most).collect())
    assert taken == int(60 * most)


def test_mixing_follows_the_schedule_in_order(make_docs):
    rng = random.Random(15)
    rows = [(i, "w " * rng.randint(1, 20), rng.choice("abcd")) for i in range(400)] + [(1000, "same words here", "b")] * 30
    docs = make_docs(rows)
    sizes = mixing.stored(mixing.shuffled(docs, "doc_id", "text", "source", ["doc_id", "text"]))
    plan = mixing.passes(mixing.place(sizes))
    got = plan.withColumn("share", mixing.demand(F.col("position"), F.col("target"), F.col("tilt"))).collect()
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append((r.position, r.share, r.pass_words, r.size))
    for passed in by_source.values():
        words = 0
        for _, share, n, _ in sorted(passed):  # all that came before has just met the demand of its time
            assert abs(share - words) < 1e-6
            words += n
    ends = mixing.sorted_by_position(plan, "tie", "pass").select("position").collect()
    assert [r.position for r in ends] == sorted(r.position for r in got)


def test_equal_rows_are_told_apart_in_many_buckets(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 7)
    docs = make_docs([(None, "one two", "s")] * 100 + [(1, "three", "t")])
    sizes = mixing.stored(mixing.shuffled(docs, "doc_id", "text", "source", ["doc_id", "text"]))
    placed = mixing.place(sizes).where("source = 's'").collect()
    assert sorted(r.before for r in placed) == list(range(0, 200, 2))
    assert sum(r.taken for r in placed) == int(placed[0].target)


def test_mixing_gives_a_position_for_each_pass(spark, make_docs, tmp_path):
    make_docs([(i, "a b c", "only") for i in range(10)]).write.parquet(str(tmp_path / "documents.parquet"))
    out = mixing.op9_curriculum_mix(spark, str(tmp_path)).collect()
    assert all((r.position is not None) == (r.taken > 0) and (r.second_position is not None) == (r.taken > 3) for r in out)
    assert any(r.second_position for r in out)


def test_mixing_edges(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert mixing.mix(make_docs([(1, None), (2, "")])).count() == 0


# --- URLs ---------------------------------------------------------------

def test_urls(spark):
    cases = {
        "http://a.example.net/en/1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://casino.example.net/en/": ("casino.example.net", "/en/", "example.net/en/", "allow"),
        "https://EXAMPLE.COM/de/x?y": ("example.com", "/de/x", "example.com/de/", "block"),
        "https://badexample.com/de/x": ("badexample.com", "/de/x", None, "allow"),
        "https://x.org/fr/casino": ("x.org", "/fr/casino", "org/fr/", "allow"),
        "https://x.net": ("x.net", "", None, "allow"),
        "https://net/": ("net", "/", "net/", "block"),
        "https://x.com/best-casino": ("x.com", "/best-casino", None, "block"),
        "https://x.com/casinos": ("x.com", "/casinos", None, "block"),
        "https://escort.com": ("escort.com", "", None, "block"), "https://nudes.com/": ("nudes.com", "/", None, "block"),
        "https://adult-videos.com/a": ("adult-videos.com", "/a", None, "block"),
        "https://online-poker.com/": ("online-poker.com", "/", None, "block"),
        "https://x.com/essex-classes/analysis": ("x.com", "/essex-classes/analysis", None, "allow"),
        "https://x.com/adult-education": ("x.com", "/adult-education", None, "allow"),
        "https://x.com/free": ("x.com", "/free", None, "allow"),
        "https://x.com/free/free": ("x.com", "/free/free", None, "allow"),
        "https://FREE.com/pills#a://b": ("free.com", "/pills", None, "block"),
        "no scheme xxx": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        "a://": ("", "", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(99, None), (99, None)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect()}
    assert got == cases | {None: ("", "", None, "allow")}
    assert urls.judge_urls(df.limit(0)).count() == 0


# --- pipeline -----------------------------------------------------------

def test_pipeline(spark, make_docs, prose, tokenizer, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    rows = [(d, t, f"s{rng.randrange(3)}") for d, t in prose]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = quality.stored(stage(spark, docs, str(tmp_path)))
        seen.append((name, docs.count()))
        if name != "pack_sequences":
            assert docs.columns == [c.split()[0] for c in PARTS.split(", ")]
        if name == "quality_rules":
            assert {r.doc_id for r in docs.collect()} == {r[0] for r in brute.quality(rows) if r[7]}
    assert len(seen) == 5 and all(n for _, n in seen)
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) for _ in range(2))
    assert a == b and len(a) == seen[-1][1]


def test_pipeline_of_nothing(spark, make_docs, tmp_path):
    import corpus_pipeline

    make_docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
