"""Edit distance of many pairs at once: a bit-parallel band (Hyyro 2003) in
numpy, one 64-bit word per pair. Pairs go by length, so that few cells of a
batch are padding, and a batch has a bounded number of cells. Pairs of very
long strings, for which a step per character costs too much, go one by one
along the band's diagonals, from one difference to the next (Landau and
Vishkin 1989)."""

from __future__ import annotations

import numpy as np

# Cells of a batch, and the length from which a pair goes alone.
CELLS = 1 << 19
LONG = 4096


def _codes(strings: list[str], before: int, after: int, pad: int) -> np.ndarray:
    """Code points, one row per string, padded on both sides."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    out = np.full((len(strings), before + int(sizes.max()) + after), pad, np.int32)
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4")
    rows = np.repeat(np.arange(len(strings)), sizes)
    columns = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + before
    out[rows, columns] = flat
    return out


def within(left: list[str], right: list[str], limit: int) -> np.ndarray:
    """True where the edit distance of a pair is at most ``limit`` (under 31)."""
    sizes = np.fromiter((max(len(x), len(y)) for x, y in zip(left, right)), np.int64, len(left))
    out = np.zeros(len(left), bool)
    order = np.argsort(sizes, kind="stable")
    short = int(np.searchsorted(sizes[order], LONG))
    for i in order[short:].tolist():
        out[i] = _along_diagonals(left[i], right[i], limit)
    at = 0
    while at < short:
        # as many as fit at the length of the last of them
        cells = (sizes[order[at:short]] + 4 * limit + 2) * np.arange(1, short - at + 1)
        many = max(1, int(np.searchsorted(cells, CELLS, "right")))
        some = order[at:at + many]
        out[some] = _band([left[i] for i in some], [right[i] for i in some], limit)
        at += many
    return out


def _along_diagonals(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance is at most ``limit``: how far each diagonal
    of the band is reached with no edit, with one, and so on."""
    x, y = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4") for s in (a, b))
    m, n = len(x), len(y)

    def further(i: int, d: int) -> int:
        step = 64
        while i < m and i + d < n:
            k = min(step, m - i, n - i - d)
            gap = np.flatnonzero(x[i:i + k] != y[i + d:i + d + k])
            if len(gap):
                return i + int(gap[0])
            i, step = i + k, step * 4
        return i

    if abs(m - n) > limit:
        return False
    reached = {0: further(0, 0)}
    for _ in range(limit):
        if reached.get(n - m, -1) >= m:
            return True
        found = {}
        for d in range(min(reached) - 1, max(reached) + 2):
            i = max(reached.get(d, -2) + 1, reached.get(d + 1, -2) + 1, reached.get(d - 1, -2))
            if i >= 0 and 0 <= i + d:
                i = min(i, m, n - d)
                if i >= 0:
                    found[d] = further(i, d)
        reached = found
    return reached.get(n - m, -1) >= m


def _band(left: list[str], right: list[str], limit: int) -> np.ndarray:
    """Column by column of the matrix, bit 63 stands for the lowest row of the
    band and bit 63 - 2 limit for the highest. The distance is followed down
    the band's lower edge, then along the last row."""
    m, n = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))
    out = np.zeros(len(left), bool)
    short = np.minimum(m, n) <= limit
    for i in np.flatnonzero(short):  # shorter than the band: a plain table
        out[i] = _plain(left[i], right[i]) <= limit
    go = np.flatnonzero(~short & (np.abs(m - n) <= limit))
    if not len(go):
        return out
    m, n = m[go], n[go]
    pattern = _codes([left[i] for i in go], limit, int(n.max()) + 2 * limit + 1, -1)
    text = _codes([right[i] for i in go], 0, 1, -2)
    one, top = np.uint64(1), np.uint64(63)
    vp = np.full(len(go), (2 ** 64 - 1) << (63 - limit) & 2 ** 64 - 1, np.uint64)
    vn = np.zeros(len(go), np.uint64)
    distance = np.full(len(go), limit, np.int64)
    bits = [np.uint64(63 - 2 * limit + k) for k in range(2 * limit + 1)]
    for j in range(int(n.max())):
        match = np.zeros(len(go), np.uint64)
        for k, bit in enumerate(bits):
            match |= (pattern[:, j + k] == text[:, j]).astype(np.uint64) << bit
        d0 = (((match & vp) + vp) ^ vp) | match | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        falling = j < m - limit
        distance += (falling & (j < n)) & (d0 >> top == 0)
        along = ~falling & (j < n)
        row = np.where(along, 62 - (j - (m - limit)), 0).astype(np.uint64)
        distance += along * ((hp >> row & one).astype(np.int64) - (hn >> row & one).astype(np.int64))
        vp, vn = hn | ~((d0 >> one) | hp), (d0 >> one) & hp
    out[go] = distance <= limit
    return out


def _plain(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
