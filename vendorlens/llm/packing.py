"""Packing documents into training sequences.

Documents are dealt into randomised groups by a hash; rows that repeat are
counted first and dealt as a few copies each, so they spread over all groups.
Each group is packed on its own, by first-fit decreasing over a tournament tree of the bins' free
room. Full blocks of a long document are sequences by themselves; the rest of
each document is one item. What first-fit leaves is small, and it is used up
by cutting a few items: the emptiest bins are dissolved, their items cut into
powers of two, and the cuts put into the room of the other bins.

Only lengths and checksums move: a task that tokenises a document also takes
the checksum of every piece that the document may be cut into, so token ids
are never shuffled.

Defined cases: a null text is an empty one, whose only token is the end
token; doc_ids may be null or repeat, each row is packed; no rows give no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice
from math import ceil
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import read, with_workers

LENGTH = 2048
END_ID = 1
# Documents in a group on average: what one packing task holds in memory.
GROUP_DOCS = 4096
# Equal rows that are dealt together.
COPIES = 64
# Distinct words whose ids a task remembers.
CACHE_WORDS = 400_000
# Texts whose new words are encoded in one go, and words in one call.
TEXTS, TOGETHER = 256, 500


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Lower-case letters whose capital differs by one bit of their last byte.
LATIN = re.compile("[a-zà-öø-þ]+")
# Marks with which a small letter is one character and its capital is not, and such a capital with a mark.
SMALL_ONLY = "\u0308\u030a\u030c\u0331"
LOST = re.compile("[HJTWY][^\\0-\u02ff]")
# The tokenizer's split of a word of ASCII, and marks that join no letter before them.
ASCII_PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
MARKS = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


class Words:
    """A tokenizer, which of its tokens close a word, and a faster encoder of
    its merges. There, a word's last letter is written as a capital: its last
    byte is then another than inside a word, as this tokenizer has it."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core
        from tokenizers import Tokenizer

        self.path, self.tokenizer = path, Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.latin = self._latin(vocabulary)

    def _latin(self, vocabulary: dict[str, int]):
        """None where ids are not in the order of the merges."""
        model = json.loads(self.tokenizer.to_str())["model"]
        order = [vocabulary["".join(m.split() if isinstance(m, str) else m)] for m in model.get("merges", [])]
        if model.get("end_of_word_suffix") != "</w>" or order != sorted(order):
            return None
        import tiktoken

        from vendorlens.llm.alignment import byte_letters

        letter, ranks = byte_letters(), {}
        for token, i in vocabulary.items():
            stem = token.removesuffix("</w>")
            if stem and all(x in letter and (0x61 <= letter[x] <= 0x7A or letter[x] == 0xC3 or 0xA0 <= letter[x] < 0xC0)
                            for x in stem):
                body = bytes(letter[x] for x in stem)
                ranks[body[:-1] + bytes([body[-1] - 32]) if stem != token else body] = i
        return tiktoken.Encoding("words", pat_str=r"\p{L}+", mergeable_ranks=ranks, special_tokens={})


def letters_only(word: bytes) -> bool:
    """Whether the tokenizer sees one run of letters in the word."""
    return word.isalpha() or not word.isascii() and normalize("NFC", word.decode()).lower().isalpha()


def ends_in_letter(word: bytes) -> bool:
    """Whether the tokenizer sees a letter at the word's end."""
    return word[-1:].isalpha() or word[-1] > 127 and normalize("NFC", word.decode()[-1]).lower()[-1].isalpha()


def parts_of(word: bytes) -> list[bytes]:
    """An ASCII-lower-cased word cut between the tokenizer's runs: at all of
    them in ASCII, else only where marks follow the last letter."""
    if word.isascii():
        return ASCII_PARTS.findall(word)
    stem = word.rstrip(MARKS)
    return [stem, word[len(stem):]] if len(stem) < len(word) and ends_in_letter(stem) else [word]


def numbering() -> defaultdict:
    """Gives each new key the next number, from 0."""
    return defaultdict(count().__next__)


def whole_only(text: str) -> bool:
    """Whether lower-casing the text first might change its ids: it may hold a
    special token, which only exact case makes one, or a mark that joins the
    small letter alone."""
    return "<|" in text or not text.isascii() and any(m in text for m in SMALL_ONLY) and LOST.search(text) is not None


class WordIds:
    """ids (little-endian bytes) of ASCII-lower-cased words, remembered.

    This tokenizer lower-cases, drops white space and merges within runs of
    letters only, so a text's ids are those of its words in order, and a word's
    are those of its parts. Words are numbered as they are met, and the ids of
    all are kept in one array; new words of several texts are encoded together.
    Words of one run are told apart by the token that closes each, which spares
    the offsets; others by offsets. When full, all words are forgotten."""

    def __init__(self, path: str):
        self.words = words_of(path)
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.fresh, self.n_ids = numbering(), [], 0
        self.ids, self.starts, self.sizes = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words, and where each word's begin, with the end."""
        self.ids, self.fresh = np.concatenate([self.ids, *self.fresh]), []
        sizes = self.sizes[numbers]
        cuts = np.append(0, np.cumsum(sizes))
        return self.ids[np.repeat(self.starts[numbers] - cuts[:-1], sizes) + np.arange(cuts[-1])], cuts

    def _keep(self, numbers: list[int], ids: np.ndarray, cuts: np.ndarray) -> None:
        self.starts[numbers], self.sizes[numbers] = cuts[:-1] + self.n_ids, np.diff(cuts)
        self.fresh.append(ids)
        self.n_ids += len(ids)

    def _learn(self) -> None:
        """Encode the words that have a number but no ids yet."""
        number = len(self.starts)
        latin, plain, mixed = ([], []), ([], []), ([], [])  # numbers, words
        joined, parts_in, of_parts = [], [0], []
        while number < len(self.numbers):  # the parts of words may be new words
            words = list(islice(reversed(self.numbers), len(self.numbers) - number))[::-1]
            smalls = b" ".join(words).decode().lower().split(" ")
            for word, small in zip(words, smalls):
                if self.words.latin and LATIN.fullmatch(small):
                    way = latin
                elif len(parts := parts_of(word)) == 1:
                    way, small = plain if word.isascii() or letters_only(word) else mixed, word.decode()
                else:
                    joined.append(number)
                    parts_in.append(len(parts))
                    of_parts.extend(map(self.numbers.__getitem__, parts))
                    number += 1
                    continue
                way[0].append(number)
                way[1].append(small)
                number += 1
        self.starts, self.sizes = (np.append(x, np.zeros(number - len(x), np.int64)) for x in (self.starts, self.sizes))
        self._encode(latin, plain, mixed)
        ids, cuts = self._ids_of(np.array(of_parts, np.int64))
        self._keep(joined, ids, cuts[np.cumsum(parts_in)])

    def _encode(self, latin: tuple, plain: tuple, mixed: tuple) -> None:
        """Words with their numbers, by the way that they take."""
        tokenizer = self.words.tokenizer
        latin, plain = ([[x[i:i + TOGETHER] for x in way] for i in range(0, len(way[0]), TOGETHER)] for way in (latin, plain))
        found = []
        for numbers, words in latin:
            text = np.frombuffer((" ".join(words) + " ").encode(), np.uint8).copy()
            text[np.flatnonzero(text == 32) - 1] -= 32  # the last letters as capitals
            found.append((numbers, words, self.words.latin.encode_ordinary(text.tobytes().decode())))
        texts = tokenizer.encode_batch_fast([" ".join(words) for _, words in plain], add_special_tokens=False)
        found += [(*part, text.ids) for part, text in zip(plain, texts)]
        for numbers, words, ids in found:
            ids = np.array(ids, "<u4")
            cuts = np.append(0, np.flatnonzero(self.words.closing[ids]) + 1)
            if len(cuts) == len(words) + 1:
                self._keep(numbers, ids, cuts)
            else:
                mixed = mixed[0] + numbers, mixed[1] + words
        for i in range(0, len(mixed[0]), TOGETHER):
            numbers, words = (x[i:i + TOGETHER] for x in mixed)
            starts = np.cumsum([0, *[len(w) + 1 for w in words[:-1]]])
            text = tokenizer.encode(" ".join(words), add_special_tokens=False)
            cuts = np.searchsorted(np.array([a for a, _ in text.offsets], np.int64), starts)
            self._keep(numbers, np.array(text.ids, "<u4"), np.append(cuts, len(text.ids)))

    def of_texts(self, texts: list[str]) -> list[bytes]:
        if len(self.numbers) >= CACHE_WORDS:
            self._forget()
        whole = [whole_only(t) for t in texts]
        split = [() if w else t.encode().lower().split() for t, w in zip(texts, whole)]
        ends = np.cumsum([0, *map(len, split)])
        here = numbering()  # few words, so looked up faster than all words
        places = np.fromiter(map(here.__getitem__, chain.from_iterable(split)), np.int64, ends[-1])
        numbers = np.fromiter(map(self.numbers.__getitem__, here), np.int64, len(here))
        self._learn()
        ids, cuts = self._ids_of(numbers[places])
        cuts = cuts[ends].tolist()
        return [np.array(self.words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if w
                else ids[a:b].tobytes() for text, w, a, b in zip(texts, whole, cuts, cuts[1:])]


_words: Words | None = None


def words_of(path: str) -> Words:
    """Kept by a worker for its next task, without any ids."""
    global _words
    if _words is None or _words.path != path:
        _words = Words(path)
    return _words


def powers(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pieces_of(ids: bytes, length: int) -> tuple[list[int], list[int], list[int]]:
    """(full, rest, cuts): checksums of the full blocks, of the rest as a
    whole (none or one), and of the rest cut into powers of two."""
    n, step = len(ids) // 4, 4 * length
    blocks = n // length
    full = [zlib.crc32(ids[k * step:(k + 1) * step]) for k in range(blocks)]
    rest = ids[blocks * step:]
    cuts, at = [], 0
    for size in powers(len(rest) // 4):
        cuts.append(zlib.crc32(rest[at:at + 4 * size]))
        at += 4 * size
    return full, [zlib.crc32(rest)] if rest else [], cuts


class FreeRoom:
    """A tournament tree over bins: each inner node knows the most room below
    it, so the first bin with enough room is found from the root."""

    def __init__(self, room: list[int]):
        self.leaves = 1 << max(0, (len(room) - 1).bit_length())
        self.tree = [0] * self.leaves + room + [0] * (self.leaves - len(room))
        for i in range(self.leaves - 1, 0, -1):
            self.tree[i] = max(self.tree[2 * i], self.tree[2 * i + 1])

    def first_fit(self, size: int) -> int:
        """Take ``size`` from the first bin with that room; -1 if none has."""
        tree, i = self.tree, 1
        if tree[1] < size:
            return -1
        while i < self.leaves:
            i *= 2
            if tree[i] < size:
                i += 1
        bin_ = i - self.leaves
        tree[i] -= size
        while i > 1:
            i //= 2
            tree[i] = max(tree[2 * i], tree[2 * i + 1])
        return bin_


def first_fit_decreasing(sizes: np.ndarray, room: list[int]) -> tuple[np.ndarray, list[int]]:
    """The bin of every item (-1: no room), largest items first, and the room
    left in each bin."""
    free, bins = FreeRoom(room), np.full(len(sizes), -1, np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        bins[i] = free.first_fit(int(sizes[i]))
    return bins, free.tree[free.leaves:free.leaves + len(room)]


def pack_items(sizes: np.ndarray, length: int) -> list[list[tuple[int, int, int]]]:
    """Bins of items: each bin a list of (item, start in the item, size).
    Items are at most ``length``; all but the last pieces keep every bin
    full, and what is left over is split into sequences that are powers of
    two."""
    if not len(sizes):
        return []
    # first-fit opens no bin while another has room, so it needs under 2 x total / length + 1
    bins, room = first_fit_decreasing(sizes, [length] * (2 * int(sizes.sum()) // length + 2))
    packed = [[] for _ in room]
    for i, b in enumerate(bins):
        packed[b].append((i, 0, int(sizes[i])))
    order = sorted((b for b in range(len(room)) if 0 < room[b] < length), key=lambda b: (-room[b], b))
    gaps, broken = sum(room[b] for b in order), []
    while order and sum(s for b in broken for _, _, s in packed[b]) < gaps:
        broken.append(order[0])  # the emptiest first
        gaps -= room[order.pop(0)]
    cuts = []
    for b in broken:
        for item, _, size in packed[b]:
            at = 0
            for part in powers(size):
                cuts.append((item, at, part))
                at += part
        packed[b] = []
    part_sizes = np.array([c[2] for c in cuts], np.int64)
    where, _ = first_fit_decreasing(part_sizes, [room[b] for b in order])
    left = []
    for cut, w in zip(cuts, where):
        (packed[order[w]] if w >= 0 else left).append(cut)
    out = [p for p in packed if p]
    if left:
        left_sizes = np.array([c[2] for c in left], np.int64)
        bins, _ = first_fit_decreasing(left_sizes, [length] * (int(left_sizes.sum()) // length + 1))
        full: dict[int, list] = {}
        for cut, b in zip(left, bins):
            full.setdefault(int(b), []).append(cut)
        for parts in full.values():
            # powers of two fill all bins but the last, whose parts are sequences by themselves
            out += [parts] if sum(p[2] for p in parts) == length else [[p] for p in parts]
    return out


def measured(docs: DataFrame, doc_id: str, text: str, path: str, length: int, end_id: int, groups: int) -> DataFrame:
    """Documents by equal doc_id, doc_tokens and checksums of the possible
    pieces: these, their group, and how many they are (COPIES at most, the
    rest in rows of their own)."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordIds(path)
        for batch in batches:
            rows = []
            for i in range(0, batch.num_rows, TEXTS):
                texts = [t or "" for t in batch.column("text").slice(i, TEXTS).to_pylist()]
                for ids in cache.of_texts(texts):
                    ids += end
                    rows.append((len(ids) // 4, *pieces_of(ids, length)))
            tokens, full, rest, cuts = zip(*rows) if rows else ((), (), (), ())
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(tokens, pa.int64()),
                 pa.array(full, lists), pa.array(rest, lists), pa.array(cuts, lists)],
                ["doc_id", "h", "doc_tokens", "full", "rest", "cuts"])

    h = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("h")
    kind = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), h, F.col(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id {kind}, h bigint, doc_tokens bigint, full array<bigint>, rest array<bigint>, cuts array<bigint>")
    each = ["doc_id", "h", "doc_tokens", "full", "rest", "cuts"]
    counted = rows.groupBy(*each).agg(F.count(F.lit(1)).alias("n"))
    some = counted.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    return some.select("doc_id", F.pmod(F.xxhash64("h", "at"), F.lit(groups)).alias("grp"), "doc_tokens", "full", "rest", "cuts",
                       F.least(F.col("n") - F.col("at"), F.lit(COPIES)).alias("copies"))


def pack_group(table: pa.Table, length: int) -> pa.Table:
    """All pieces of one group's documents, with their sequences."""
    table = table.take(pa.array(np.repeat(np.arange(table.num_rows), table["copies"].to_numpy())))
    table = table.sort_by([("doc_tokens", "ascending"), ("doc_id", "ascending")])
    first, out, sequence = table["grp"][0].as_py() << 32, [], 0
    tokens = table["doc_tokens"].to_numpy()
    full, rest, cuts = (table[c].to_pylist() for c in ("full", "rest", "cuts"))
    for row, blocks in enumerate(full):
        for k, crc in enumerate(blocks):
            out.append((row, k * length, length, crc, first + sequence, 0))
            sequence += 1
    rests = tokens % length
    items = np.flatnonzero(rests)
    for parts in pack_items(rests[items], length):
        offset = 0
        for item, at, size in parts:
            row = int(items[item])
            whole = int(rests[row])
            if size == whole:
                crc = rest[row][0]
            else:  # the cut that starts here, in falling order
                crc = cuts[row][int(np.searchsorted(np.cumsum([0, *powers(whole)]), at))]
            out.append((row, int(tokens[row]) - whole + at, size, crc, first + sequence, offset))
            offset += size
        sequence += 1
    row, start, size, crc, seq, offset = (np.array(x, np.int64) for x in zip(*out))
    return pa.table({"doc_id": table["doc_id"].take(pa.array(row)), "start": start, "length": size, "ids_crc32": crc,
                     "doc_tokens": tokens[row], "sequence_id": seq, "offset": offset})


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
         length: int = LENGTH, end_id: int = END_ID, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. ``path`` is a tokenizer file present on every
    executor."""
    with_workers(docs.sparkSession)
    groups = max(1, ceil(docs.count() / group_docs))
    table = measured(docs, doc_id, text, path or default_tokenizer(), length, end_id, groups)
    kind = table.schema["doc_id"].dataType.simpleString()
    return table.groupBy("grp").applyInArrow(
        lambda rows: pack_group(rows, length),
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint")


def op8_pack_sequences(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents", "doc_id", "text"))
