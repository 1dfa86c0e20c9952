"""Plain answers to the operators' contracts, for small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def words(text):
    return (text or "").encode().split()


def repeated_bytes(rows, length=400):
    count = Counter()
    for _, text in rows:
        body = (text or "").encode()
        count.update(body[i:i + length] for i in range(len(body) - length + 1))
    out = []
    for doc, text in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        for i in range(len(body) - length + 1):
            if count[body[i:i + length]] > 1:
                gone[i:i + length] = True
        gone = gone[:len(body)]
        kept = bytes(b for b, g in zip(body, gone) if not g)
        runs = int(np.sum(gone & ~np.append(False, gone[:-1]))) if len(body) else 0
        out.append((doc, len(body), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_windows(rows, window=20):
    """rows have different, non-null doc_ids, or null ids with different texts in hash-free order."""
    first = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ws = words(text)
        for p in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[p:p + window]), (doc, p))
    out = []
    for doc, text in rows:
        ws = words(text)
        gone = [False] * len(ws)
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p:p + window])] != (doc, p):
                gone[p:p + window] = [True] * window
        kept = b" ".join(w for w, g in zip(ws, gone) if not g)
        out.append((doc, len(ws), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text, shingle=3):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    shingles = [b" ".join(ws[i:i + shingle]) for i in range(max(1, len(ws) - shingle + 1))]
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(n, linked):
    """Root of every index under the links (i, j)."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in linked:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(rows, bits=3):
    fps = [fingerprint(t) for _, t in rows]
    roots = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i)
                               if (fps[i] ^ fps[j]).bit_count() <= bits])
    least = defaultdict(list)
    for (doc, _), root in zip(rows, roots):
        if doc is not None:
            least[root].append(doc)
    return [(doc, f"{fp:016x}", min(least[root], default=None)) for (doc, _), fp, root in zip(rows, fps, roots)]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_dedup(rows, min_chars=20, edits=2):
    """Texts left, by row; rows in order, with different ids."""
    seen, out = [], []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        kept = []
        for line in text.split("\n"):
            body = line.strip(" \t\n\x0b\x0c\r")
            if body and body in seen:
                continue
            if 0 < len(body) < min_chars:
                seen.append(body)
            if len(body) >= min_chars:
                near = any(abs(len(body) - len(s)) <= edits and edit_distance(body, s) <= edits for s in seen)
                seen.append(body)
                if near:
                    continue
            kept.append(line)
        out.append("\n".join(kept))
    return out


def quality(rows):
    """rows: (doc, text, host)."""
    out, host = [], defaultdict(lambda: [0, 0])
    for doc, text, source in rows:
        ws = [w.decode() for w in words(text)]
        grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        count = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
        host[source][0] += 1
        host[source][1] += failed
        out.append([doc, len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"),
                    len(lines) - len(set(lines)), len(covered), failed, source])
    if not out:
        return []
    rates = np.array([f / n for n, f in host.values()])
    m, v = rates.mean(), rates.var()
    k = min(max(m * (1 - m) / v - 1, 1.0), 1000.0) if v > 0 else 1000.0
    good = {h: (f + m * k) / (n + k) <= 0.8 for h, (n, f) in host.items()}
    return [(*r[:7], not r[6] and good[r[7]]) for r in out]


def tokens(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
