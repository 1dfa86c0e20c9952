"""Induced sorting of suffixes with their common-prefix lengths, in numpy.

The suffixes of a set of strings are sorted from their leftmost-S suffixes:
those are sorted through their substrings' names, all L suffixes are induced
from them left to right, and all S suffixes from the L ones right to left. The
priority queue of this order is one first-in-first-out queue per leading byte,
because suffixes are taken out in order and so arrive in order; a whole queue
is taken out at once, and one array operation induces what it precedes. Each
entry carries the length of the prefix that it shares with the entry before
it: one more than the least length between their parents. Queues beyond a
memory limit go to a temporary file that ends with the task.

The reduced string of names is ranked by doubling: its strings are short
(they hold one window's worth of names), and arrays of large alphabets have no
queues worth taking at once.
"""

from __future__ import annotations

import tempfile

import numpy as np

QUEUE_BYTES = 64 << 20
BATCH = 1 << 16


class Store:
    """Arrays kept in memory up to a limit, then in one temporary file."""

    def __init__(self, limit: int):
        self.left, self.file = limit, None

    def keep(self, array: np.ndarray | None):
        if array is None or array.nbytes <= self.left:
            self.left -= 0 if array is None else array.nbytes
            return array
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(array.tobytes())
        return at, len(array), array.dtype

    def load(self, kept) -> np.ndarray | None:
        if not isinstance(kept, tuple):
            self.left += 0 if kept is None else kept.nbytes
            return kept
        at, n, kind = kept
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * kind.itemsize), kind)


def least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first..last]) for many ranges, by a table of powers of two."""
    out = np.empty(len(first), values.dtype)
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    row = values
    for j in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == j)
        out[at] = np.minimum(row[first[at]], row[last[at] - (1 << j) + 1])
        row = np.minimum(row[:-(1 << j)], row[1 << j:])
    return out


class Suffixes:
    """Suffixes of byte strings; each string ends in a byte of its own that is
    smaller than all others, so no common prefix runs past a string."""

    def __init__(self, strings: list[bytes], cap: int, queue_bytes: int = QUEUE_BYTES):
        self.cap, self.store = cap, Store(queue_bytes)
        text = np.frombuffer(b"".join([b"\xff", *[s + b"\xff" for s in strings]]) + b"\xff" * 8, np.uint8) + np.uint8(1)
        self.text, self.n = text, len(text) - 8
        self.ends = np.cumsum([0, *[len(s) + 1 for s in strings]])  # of the strings, where the small bytes stand
        different = text[:self.n] != text[1:self.n + 1]
        different[-1] = True
        # the next position whose byte differs from the one after it decides the type
        decides = np.where(different, np.arange(self.n), self.n)
        decides = np.minimum.accumulate(decides[::-1])[::-1]
        self.small = text[decides] < text[decides + 1]
        self.small[-1] = True
        del decides, different
        self.lms = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1

    def _spread(self, queues: list, carry: np.ndarray, pos: np.ndarray, lcp: np.ndarray | None, small: bool) -> None:
        """Queue the suffixes one longer than those at ``pos`` (in order) that
        are S, or L. ``carry``: for each byte, the least length among parents
        since its queue last grew."""
        for i in range(0, len(pos), BATCH):
            part = pos[i:i + BATCH]
            byte, own = self.text[part - 1], self.text[part]
            if small:
                chosen = np.flatnonzero((byte > 0) & ((byte < own) | ((byte == own) & self.small[part])))
            else:
                chosen = np.flatnonzero(byte >= own)
            order = chosen[np.argsort(byte[chosen], kind="stable")]
            bytes_ = byte[order]
            cuts = np.flatnonzero(bytes_[1:] != bytes_[:-1]) + 1
            firsts = np.concatenate([[0], cuts]) if len(order) else cuts
            lasts = np.append(firsts[1:], len(order)) - 1 if len(order) else cuts
            shared = None
            if lcp is not None:
                length = lcp[i:i + BATCH]
                before = np.minimum.accumulate(length)
                if len(order):
                    after = np.append(np.minimum.accumulate(length[::-1])[::-1], np.int16(self.cap))
                    shared = np.empty(len(order), np.int16)
                    shared[firsts] = np.minimum(carry[bytes_[firsts]], before[order[firsts]])
                    follow = np.ones(len(order), bool)
                    follow[firsts] = False
                    follow = np.flatnonzero(follow)
                    shared[follow] = least_between(length, order[follow - 1] + 1, order[follow])
                    shared = np.minimum(shared + np.int16(1), np.int16(self.cap))
                np.minimum(carry, before[-1], out=carry)
                if len(order):
                    carry[bytes_[lasts]] = after[order[lasts] + 1]
            child = part[order] - 1
            for a, b in zip(firsts.tolist(), (lasts + 1).tolist()):
                queues[bytes_[a]].append((self.store.keep(child[a:b]),
                                          self.store.keep(None if shared is None else shared[a:b])))

    def _take(self, queue: list) -> tuple[np.ndarray, np.ndarray | None]:
        """Everything in a queue now, in order."""
        parts = [(self.store.load(p), self.store.load(x)) for p, x in queue]
        queue.clear()
        lcp = None if parts[0][1] is None else np.concatenate([x for _, x in parts])
        return np.concatenate([p for p, _ in parts]), lcp

    def _run(self, pos: int) -> int:
        """How often the byte at ``pos`` stands there in a row, to the cap."""
        window = self.text[pos:pos + self.cap]
        other = np.flatnonzero(window != window[0])
        return int(other[0]) if len(other) else len(window)

    def induced(self, lms: np.ndarray, lms_lcp: np.ndarray | None):
        """From leftmost-S suffixes, grouped by leading byte in rising order,
        yield all suffixes but the empty ones in falling order, as arrays of
        positions and of the lengths shared with the one yielded before."""
        with_lcp = lms_lcp is not None
        leading = self.text[lms]
        group = np.searchsorted(leading, np.arange(257))
        queues, done = [[] for _ in range(256)], [[] for _ in range(256)]
        carry = np.full(256, -1, np.int16)
        for c in range(256):
            last = None
            while queues[c]:
                pos, lcp = self._take(queues[c])
                done[c].append((self.store.keep(pos), self.store.keep(lcp)))
                self._spread(queues, carry, pos, lcp, False)
                last = int(pos[-1])
            pos = lms[group[c]:group[c + 1]]
            if len(pos):
                lcp = lms_lcp[group[c]:group[c + 1]].copy() if with_lcp else None
                if with_lcp:
                    lcp[0] = 0 if last is None or not c else min(self._run(last), self._run(int(pos[0])))
                self._spread(queues, carry, pos, lcp, False)
        queues, carry = [[] for _ in range(256)], np.full(256, -1, np.int16)
        for c in range(255, 0, -1):
            last = None
            while queues[c]:
                pos, lcp = self._take(queues[c])
                yield pos, lcp
                self._spread(queues, carry, pos, lcp, True)
                last = int(pos[-1])
            edge = None
            for kept in reversed(done[c]):
                pos, lcp = self.store.load(kept[0])[::-1], self.store.load(kept[1])
                if with_lcp:
                    if edge is None:
                        edge = 0 if last is None else min(self._run(last), self._run(int(pos[0])))
                    lcp, edge = np.concatenate([[edge], lcp[:0:-1]]).astype(np.int16), int(lcp[0])
                yield pos, lcp
                self._spread(queues, carry, pos, lcp, True)

    def sorted_lms(self) -> np.ndarray:
        """Leftmost-S suffixes in rising order."""
        lms, text = self.lms, self.text
        by_byte = lms[np.argsort(text[lms], kind="stable")]
        empty = self.ends[1:]
        ranked = [pos[self.small[pos] & ~self.small[pos - 1]] for pos, _ in self.induced(by_byte, None)]
        order = np.concatenate([empty, np.concatenate([np.zeros(0, np.int64), *ranked])[::-1]])
        # name the substrings: neighbours are equal if length and bytes are, and no string ends in them
        of_position = np.empty(self.n, np.int32)
        of_position[lms] = np.arange(len(lms), dtype=np.int32)
        number = of_position[order]
        del of_position
        stop = lms[np.minimum(number + 1, len(lms) - 1)]
        size = np.where(text[order] == 0, 0, stop - order + 1)
        a, b = order[:-1], order[1:]
        same = (size[1:] == size[:-1]) & (size[1:] > 0) & (text[stop[1:]] > 0)
        at = np.flatnonzero(same)
        k = 0
        while len(at):
            differ = text[a[at] + k] != text[b[at] + k]
            same[at[differ]] = False
            k += 1
            at = at[~differ & (size[1:][at] > k)]
        new = np.append(True, ~same)
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        rank = np.empty(len(lms), np.int64)
        rank[number] = first
        return lms[self._doubled(rank)]

    @staticmethod
    def _doubled(rank: np.ndarray) -> np.ndarray:
        """Order of the suffixes of a string of ranks. A rank is the number of
        smaller names; equal names are told apart by what follows them, at
        twice the distance in each round."""
        m, step = len(rank), 1
        order = np.argsort(rank, kind="stable")
        sorted_ranks = rank[order]
        tied = np.zeros(m, bool)
        if m > 1:
            equal = sorted_ranks[1:] == sorted_ranks[:-1]
            tied[1:] |= equal
            tied[:-1] |= equal
        slots = np.flatnonzero(tied)  # places in the order that ties share
        while len(slots):
            who = order[slots]
            major, minor = rank[who], rank[who + step]
            within = np.argsort(major * m + minor)
            who, major, minor = who[within], major[within], minor[within]
            order[slots] = who
            new = np.ones(len(slots), bool)
            new[1:] = (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])
            rank[who] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
            alone = new & np.append(new[1:], True)
            slots = slots[~alone]
            step *= 2
        return order

    def shared_by_neighbours(self, order: np.ndarray) -> np.ndarray:
        """Length of the prefix each suffix shares with the one before, up to
        the cap, eight bytes at a time."""
        words = np.ndarray(len(self.text) - 7, "<u8", self.text, strides=(1,))
        out = np.zeros(len(order), np.int64)
        at = np.flatnonzero(self.text[order[1:]] == self.text[order[:-1]]) + 1
        done = 0
        while len(at) and done < self.cap:
            a, b = order[at - 1] + done, order[at] + done
            inside = np.maximum(a, b) < len(words)
            at, a, b = at[inside], a[inside], b[inside]
            x = words[a] ^ words[b]
            out[at] = done + np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3)
            at = at[x == 0]
            done += 8
        room = self.ends[np.searchsorted(self.ends, order)] - order
        room[1:] = np.minimum(room[1:], room[:-1])
        out = np.minimum(np.minimum(out, room), self.cap)
        out[0] = 0
        return out.astype(np.int16)

    def repeated(self) -> list[np.ndarray]:
        """For every string, the positions whose suffix shares at least the
        cap's length with another suffix."""
        flags = np.zeros(self.n, bool)
        order = self.sorted_lms()
        last = None
        for pos, lcp in self.induced(order, self.shared_by_neighbours(order)):
            hit = np.flatnonzero(lcp >= self.cap)
            flags[pos[hit]] = True
            flags[pos[hit[hit > 0] - 1]] = True
            if len(hit) and hit[0] == 0:
                flags[last] = True
            last = pos[-1]
        return [np.flatnonzero(flags[a + 1:b]) for a, b in zip(self.ends[:-1], self.ends[1:])]
