"""Cross-tokenizer alignment: where two tokenizations of a text end together.

A text's tokens are two rising lists of byte ends, one of each tokenizer. Many
documents' lists are laid end to end, and the merge of the two lists is cut
into pieces of equal work: a binary search along each diagonal (so many tokens
merged in all) finds how many come from either side. Pieces are independent,
wherever documents begin and end; each emits the ends that its tokens share,
and a shared end that a cut divides is stitched from the two pieces beside it.
Shared ends cut the tokens into groups and link the two tokens that end there.

Tokens come by units: a text is cut before each space that follows something
other than white space. Neither tokenizer has a token across such a cut, so a
unit's ids don't depend on its text, and new units of many texts are encoded
together. Ids of a link are counted over the whole corpus by a pre-aggregated
count of each document's different links.

Defined cases: a null or empty text, or one that the pieces don't spell (it
holds U+2581), has no tokens: zeros and an empty digest. Special tokens' names
in a text are plain text. doc_ids may be null or repeat: each row is answered.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vendorlens.llm.common import join_measured, read, stored, with_workers

# Tokens merged in one piece, bytes of text aligned at once, bytes of units
# that a task remembers, and units that are encoded in one call.
PIECE = 1 << 15
CHUNK_BYTES = 2 << 20
CACHE_BYTES = 48 << 20
TOGETHER = 400

SPACE_AFTER_WHITE = re.compile(r"\s ")
CUT = re.compile(r"(?<=\S)(?= )")
MARK = "▁"
# Fixed value: how a byte-level tokenizer splits a text before it merges bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable Latin-1 stands for itself, the other bytes, in order, for the
    letters from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def closed(unit: str) -> bool:
    """Whether a unit is a Latin letter's word and a full stop or comma."""
    return len(unit) > 1 and unit[-1] in ".," and unit[-2] < "\u0250" and unit[-2].isalpha()


class Pair:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.paths = (path_a, path_b)
        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        letter = byte_letters()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letter[x] for x in token) if all(x in letter for x in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in xs], np.int64) for xs in (self.bytes_a, self.bytes_b))
        # a piece that goes on after its space would lie across a cut
        self.cuts_hold = not any(MARK in p.lstrip(MARK) for p in pieces)
        # nor may one go on after a Latin letter with a full stop or comma, if those are units of their own
        self.tails_hold = not any(closed(p[:i + 1]) for p in pieces for i in range(1, len(p)))
        self.merges = self._merges()
        # every id as text, followed by each of the separators; B's come after A's
        self.texts = [b"%d%c" % (i, s) for xs in (self.bytes_a, self.bytes_b) for i in range(len(xs)) for s in b",|;"]
        self.from_b = 3 * len(self.bytes_a)

    def _merges(self):
        """A faster encoder of the same merges, where A's ids are their order
        and it splits texts in the usual way; else None."""
        made = json.loads(self.a.to_str())
        model, vocabulary = made["model"], self.a.get_vocab(with_added_tokens=False)
        usual = made["normalizer"] is None and made["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        ids = [vocabulary["".join(m.split() if isinstance(m, str) else m)] for m in model.get("merges", [])]
        if not usual or model["type"] != "BPE" or ids != sorted(ids) or len(ids) + 256 < len(vocabulary) - 1:
            return None
        import tiktoken

        added = {x["id"] for x in made["added_tokens"]}
        return tiktoken.Encoding("merges", pat_str=SPLIT, special_tokens={}, mergeable_ranks={
            self.bytes_a[i]: i for i in vocabulary.values() if i not in added})

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for texts, to which B puts a space."""
        if not texts:
            return
        if self.merges:
            found = map(self.merges.encode_ordinary, texts)
        else:
            found = (x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False))
        # B puts a space before a text, but not before an empty one: a letter goes ahead
        other = self.b.encode(["x" + t for t in texts], num_threads=1)
        for x, y in zip(found, other):
            y = np.array(y, np.int64)
            ahead = int(np.searchsorted(np.cumsum(self.size_b[y]), 2)) + 1
            yield np.array(x, np.int64), y[ahead:]


_pair: Pair | None = None


def pair_of(path_a: str, path_b: str) -> Pair:
    global _pair
    if _pair is None or _pair.paths != (path_a, path_b):
        _pair = Pair(path_a, path_b)
    return _pair


class Units(dict):
    """(ids of A, ids of B) as bytes of units without their first space; False
    where a tokenizer doesn't spell the unit. Ends with its task."""

    def __init__(self, pair: Pair):
        self.pair, self.held = pair, 0
        # what stands after a letter follows "x" and what is put ahead of it
        self.closing = {c: (a.astype("<u4").tobytes(), b.astype("<u4").tobytes())
                        for c, (a, b) in zip(".,", pair.encode([".", ","]))}

    def _keep(self, units: list[str], body: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        """Remember the ids of units whose text is ``body``, if both
        tokenizers spell it and have a token's end where each unit ends."""
        pair, raw, cuts = self.pair, [], []
        sizes = np.fromiter(map(len, units) if body.isascii() else (len(u.encode()) for u in units), np.int64, len(units)) + 1
        ends = np.cumsum(sizes)
        for ids, spelt, size in ((a, pair.bytes_a, pair.size_a), (b, pair.bytes_b, pair.size_b)):
            reached = np.cumsum(size[ids])
            cut = np.searchsorted(reached, ends)
            if not len(ids) or cut[-1] >= len(ids) or (reached[cut] != ends).any() or b"".join(
                    [spelt[i] for i in ids.tolist()]) != body:
                return False
            raw.append(ids.astype("<u4").tobytes())
            cuts.append((4 * np.append(0, cut + 1)).tolist())
        (x, y), (p, q) = raw, cuts
        for u, p0, p1, q0, q1 in zip(units, p, p[1:], q, q[1:]):
            self[u] = x[p0:p1], y[q0:q1]
        self.held += 300 * len(units) + 2 * len(body) + len(x) + len(y)
        return True

    def _encode(self, units: list[str]) -> None:
        # a unit that ends in white space could join the next one's; those go alone
        alone, plain, tails = [], {}, []
        for u in units:
            if not u or u[-1].isspace() or MARK in u:
                alone.append(u)
            elif self.pair.tails_hold and closed(u):
                tails.append(u)
                if u[:-1] not in self:
                    plain[u[:-1]] = None
            else:
                plain[u] = None
        plain = list(plain)
        parts = [plain[i:i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        texts = [" " + " ".join(p) for p in parts]
        for part, text, (a, b) in zip(parts, texts, self.pair.encode(texts)):
            if not self._keep(part, text.encode(), a, b):
                alone += part
        for u, (a, b) in zip(alone, self.pair.encode([" " + u for u in alone])):
            if not self._keep([u], (" " + u).encode(), a, b):
                self[u] = False
        for u in tails:
            stem, (x, y) = self[u[:-1]], self.closing[u[-1]]
            self[u] = stem and (stem[0] + x, stem[1] + y)
        self.held += 300 * len(tails)

    def of_texts(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both as bytes; None for an empty text or one not spelled."""
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif not self.pair.cuts_hold:
                split.append([t])
            elif SPACE_AFTER_WHITE.search(t) or t[0] == " ":
                split.append([u[1:] for u in CUT.split(" " + t)])
            else:
                split.append(t.split(" "))
        found = [list(map(self.get, units)) for units in split]
        self._encode(list({u for units, ids in zip(split, found) if None in ids
                           for u, x in zip(units, ids) if x is None}))
        out = []
        for units, ids in zip(split, found):
            if None in ids:
                ids = [self[u] if x is None else x for u, x in zip(units, ids)]
            if not ids or False in ids:
                out.append(None)
            else:
                a, b = zip(*ids)
                out.append((b"".join(a), b"".join(b)))
        return out


def diagonal_cuts(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of a and of b come before each cut of their merge into pieces
    of ``piece`` (first and last cut included). Equal values: a's come first."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, diagonal - low
        middle = (low[open_] + high[open_]) // 2
        before = a[middle] <= b[diagonal[open_] - middle - 1]
        low[open_[before]] = middle[before] + 1
        high[open_[~before]] = middle[~before]


def shared_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of equal values in two strictly rising arrays, piece by piece."""
    cut_a, cut_b = diagonal_cuts(a, b, piece)
    found = []
    for i, j, i_end, j_end in zip(cut_a[:-1].tolist(), cut_b[:-1].tolist(), cut_a[1:].tolist(), cut_b[1:].tolist()):
        x, y = a[i:i_end], b[j:j_end]
        at = np.searchsorted(y, x)
        hit = np.flatnonzero(at < len(y))
        hit = hit[y[at[hit]] == x[hit]]
        found.append((hit + i, at[hit] + j))
        # stitch: a's end before the cut, b's after it
        if i_end and j_end < len(b) and a[i_end - 1] == b[j_end]:
            found.append((np.array([i_end - 1]), np.array([j_end])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def aligned(pair: Pair, encoded: list[tuple[bytes, bytes]], piece: int = PIECE) -> list[tuple]:
    """(n_a, n_b, n_groups, digest, pairs, times) of each text's ids."""
    if not encoded:
        return []
    a, b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in zip(*encoded))
    last_a, last_b = (np.cumsum([len(e[k]) // 4 for e in encoded]) for k in (0, 1))
    i, j = shared_ends(np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b]), piece)
    groups = np.searchsorted(i, last_a - 1) + 1  # a text's last tokens end together
    # texts of groups: A's tokens of group g stand after B's of the groups before it
    before_b, upto_a = np.append(0, j[:-1] + 1), i + 1
    of_a, of_b = np.searchsorted(i, np.arange(len(a))), np.searchsorted(j, np.arange(len(b)))
    text_a, text_b, written = 3 * a, 3 * b + pair.from_b, np.empty(len(a) + len(b), np.int64)
    text_a[i] += 1
    text_b[j] += 2
    written[np.arange(len(a)) + before_b[of_a]] = text_a
    written[np.arange(len(b)) + upto_a[of_b]] = text_b
    words = [pair.texts[x] for x in written.tolist()]
    # each text's different links and how often it has them
    link, text = a[i] << 32 | b[j], np.repeat(np.arange(len(encoded)), np.diff(groups, prepend=0))
    order = np.lexsort((link, text))
    link, text = link[order], text[order]
    new = np.flatnonzero(np.append(True, (link[1:] != link[:-1]) | (text[1:] != text[:-1])))
    times, link = np.diff(np.append(new, len(link))), link[new]
    ends = np.searchsorted(text[new], np.arange(len(encoded)), "right")
    out, from_a, from_b, from_g, from_l = [], 0, 0, 0, 0
    for to_a, to_b, to_g, to_l in zip(last_a.tolist(), last_b.tolist(), groups.tolist(), ends.tolist()):
        digest = hashlib.sha256(b"".join(words[from_a + from_b:to_a + to_b])[:-1]).hexdigest()
        out.append((to_a - from_a, to_b - from_b, to_g - from_g, digest, link[from_l:to_l], times[from_l:to_l]))
        from_a, from_b, from_g, from_l = to_a, to_b, to_g, to_l
    return out


NOTHING = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


def _aligned_rows(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    pair = pair_of(*paths)
    units = Units(pair)
    for batch in batches:
        sizes = np.array(batch.column("size").to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:  # a chunk has CHUNK_BYTES and at most one more text
            upto = at + int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK_BYTES)) + 1
            part = batch.slice(at, upto - at)
            ids = units.of_texts([t or "" for t in part.column("text").to_pylist()])
            rows = iter(aligned(pair, [x for x in ids if x]))
            n_a, n_b, n_groups, digest, links, times = zip(*[next(rows) if x else NOTHING for x in ids])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)], pa.array(digest),
                 pa.array(links, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "link", "times"])
            at = upto


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, and its different links (a << 32 | b) with their times.
    ``paths`` are files of a byte-level and a piece tokenizer, present on every
    executor."""
    with_workers(docs.sparkSession)
    paths = paths or default_paths()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).alias("size"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    table = stored(rows.mapInArrow(
        lambda b: _aligned_rows(b, paths),
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, link array<bigint>, "
        "times array<bigint>").withColumn("row", F.monotonically_increasing_id()))
    links = table.select("row", F.explode(F.arrays_zip("link", "times")).alias("x")).select("row", "x.*")
    counted = links.groupBy("link").agg(F.sum("times").alias("n"))
    of_b = Window.partitionBy(F.col("link").bitwiseAND((1 << 32) - 1))
    counted = stored(counted.withColumn("best", (F.col("n") == F.max("n").over(of_b)).cast("long")))
    sums = join_measured(links, counted, ["link"], "inner", 24).groupBy("row").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return table.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256", "link", "times")


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align(read(spark, sf_dir, "documents", "doc_id", "text")).drop("link", "times")
