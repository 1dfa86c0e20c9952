import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC)
    return make


@pytest.fixture
def prose():
    """Documents with copies, near copies, shared passages, ties, nulls and long texts."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 8))) for _ in range(300)]

    def text(n):
        out = []
        for i in range(n):
            out.append(rng.choice(vocabulary))
            out.append("\n" if rng.random() < 0.06 else " ")
        return "".join(out)

    shared = text(90)
    rows = [(i, text(rng.randint(1, 200))) for i in range(60)]
    rows += [(100 + i, text(30) + shared + text(rng.randint(0, 40))) for i in range(8)]
    base = text(150)
    rows += [(200 + i, base) for i in range(5)]
    near = base.split(" ")
    for i in range(8):
        changed = list(near)
        changed[rng.randrange(len(changed))] = "changed%d" % i
        rows.append((300 + i, " ".join(changed)))
    long_text = text(6000)
    rows += [(400, ""), (401, None), (402, "a"), (403, "   \n\t\n "), (404, long_text), (405, "one two " * 300), (406, "é" * 900),
             (407, "A b  C\tb\x0bc"), (408, "a B c b C")]
    rng.shuffle(rows)
    return rows
