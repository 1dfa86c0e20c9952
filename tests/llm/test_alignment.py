"""Operator 11 against plain tokenization and a plain merge."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from vendorlens.llm import alignment

STRANGE = ["a", "b", " ", " ", "\n", "\t", "　", "\x1c", "\x85", "'s", "Z0", ".", "<|endoftext|>", "<s>", "日", "🙂", "é",
           "\r\n", "​", "\xa0", " the", "\x00"]


def brute(texts):
    pair = alignment.Pair(*alignment.default_paths())
    out, count = [], Counter()
    for text in texts:
        a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pair.b.encode(text) if text else []
        body = (" " + (text or "")).encode()
        if any(b"".join(spelt[i] for i in ids) != body for spelt, ids in ((pair.bytes_a, a), (pair.bytes_b, b))):
            a, b = [], []
        end_a, end_b = ({int(e): n for n, e in enumerate(np.cumsum([len(s[i]) for i in ids]))}
                        for s, ids in ((pair.bytes_a, a), (pair.bytes_b, b)))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(end_a) & set(end_b)):
            x, y = end_a[end] + 1, end_b[end] + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        count.update(links)
        out.append((a, b, groups, links))
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    return [(len(a), len(b), len(g), len(l), sum(count[x] == best[x[1]] for x in l), sum(count[x] for x in l),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for a, b, g, l in out]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_shared_ends_equal_set_intersection():
    rng = random.Random(3)
    for _ in range(400):
        a, b = (np.array(sorted(rng.sample(range(50), rng.randint(0, 30))), np.int64) for _ in range(2))
        i, j = alignment.shared_ends(a, b, rng.choice([1, 2, 3, 7, 100]))
        assert a[i].tolist() == b[j].tolist() == sorted({*a.tolist()} & {*b.tolist()})


def test_pieces_have_equal_work():
    a, b = np.arange(0, 900, 3), np.arange(0, 4000, 2)
    i, j = alignment.diagonal_cuts(a, b, 100)
    assert set(np.diff(i + j).tolist()) == {100} and i[-1] == len(a) and j[-1] == len(b)


def test_units_spell_what_whole_texts_do():
    rng = random.Random(4)
    pair = alignment.Pair(*alignment.default_paths())
    texts = ["".join(rng.choices(STRANGE, k=rng.randint(1, 25))) for _ in range(3000)]
    for text, ids in zip(texts, alignment.Units(pair).of_texts(texts)):
        want = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
        assert tuple(np.frombuffer(x, "<u4").tolist() for x in ids) == want, text


def test_alignment(make_docs, prose, monkeypatch):
    rng = random.Random(5)
    rows = prose + [(500 + i, "".join(rng.choices([*STRANGE, "▁"], k=15))) for i in range(40)]
    rows += [(None, "a b"), (None, "a b"), (402, "a"), (700, " "), (701, " a "), (702, "▁"), (703, "x" * 30_000)]
    want = sorted((str(r[0]), *x) for r, x in zip(rows, brute([t for _, t in rows])))
    docs = make_docs(rows).withColumn("link", F.lit(1)).withColumn("row", F.lit(2))
    got = alignment.align(docs)
    assert sorted((str(r.doc_id), *[r[c] for c in COLUMNS]) for r in got.collect()) == want
    monkeypatch.setattr("vendorlens.llm.common.BROADCAST_BYTES", 0)
    again = alignment.align(docs)
    assert sorted((str(r.doc_id), *[r[c] for c in COLUMNS]) for r in again.collect()) == want


def test_alignment_of_nothing(make_docs):
    assert alignment.align(make_docs([])).count() == 0
    assert [tuple(r)[1:8] for r in alignment.align(make_docs([(1, None), (2, "")])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
