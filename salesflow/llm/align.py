"""Alignment of two tokenizers' tokens over the bytes of one text.

Tokenizer A is a byte-level BPE, B a piece model that puts a space before the text; both see a space and the text. The byte offsets at which
their tokens end are two ascending lists. The shorter one drives an exponential and then binary search into the longer one; offsets found
in both cut the tokens into groups, and the differences of the ranks found give the tokens of one side that overlap a token of the other.

What is linked stands at a common end, so of two linked tokens one is a suffix of the other: the table of linked id pairs is bounded by
the two vocabularies, whatever the corpus (at most the lengths of all tokens, twice). It is counted by grouped sums that tasks
pre-aggregate, and only this table is sent to all tasks.

Edge cases: a text that is null, empty, or whose tokens' bytes differ from space and text (it holds U+2581, say) has no tokens; special
tokens in a text are plain text; rows with equal or null ids stay rows of their own; a text of any length is aligned whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from bisect import bisect_left
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesflow.llm.bpe import LONGEST_REMEMBERED, REMEMBERED, grouped, listed, once
from salesflow.llm.shared import stored
from salesflow.llm.wordhash import text_slices

MARK = "▁"


def gallop(short: list[int], long: list[int]) -> list[int]:
    """For each value of ``short`` the number of smaller ones in ``long``; both ascend."""
    at, n = 0, len(long)
    long = [*long, float("inf")]

    def further(value: int, at: int) -> int:
        step = 1
        while at + step < n and long[at + step] < value:
            step += step
        return bisect_left(long, value, at + (step >> 1) + 1, min(at + step, n))

    # The search doubles its step from where the last one ended; the first two places are looked at in line.
    return [at := at if long[at] >= value else at + 1 if long[at + 1] >= value else further(value, at + 1) for value in short]


def common(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices in both strictly ascending lists of the values that stand in both."""
    swapped = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swapped else (ends_a, ends_b)
    rank = np.array(gallop(short.tolist(), long.tolist()), np.int64)
    own = np.flatnonzero(np.append(long, -1)[rank] == short)
    return (rank[own], own) if swapped else (own, rank[own])


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A the first and last token of B that share a byte with it; both lists end together."""
    if len(ends_a) <= len(ends_b):
        last = np.array(gallop(ends_a.tolist(), ends_b.tolist()), np.int64)
    else:  # ranks the other way round, counted up
        below = np.array(gallop(ends_b.tolist(), ends_a.tolist()), np.int64)
        equal = ends_a[np.minimum(below, len(ends_a) - 1)] == ends_b
        last = np.cumsum(np.bincount(below + equal, minlength=len(ends_a) + 1))[:len(ends_a)]
    ended = np.minimum(last, len(ends_b) - 1)
    after = last + (ends_b[ended] == ends_a)
    return np.concatenate(([0], after[:-1])), last


class ByteLevel:
    """Tokenizer A, from a JSON file."""

    def __init__(self, packed: bytes):
        self._library = Tokenizer.from_str(packed.decode())
        self._library.encode_special_tokens = True
        # The characters that stand for bytes in byte-level vocabularies.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(c): b for b, c in [*zip(shown, shown), *((b, 256 + k) for k, b in enumerate(hidden))]}
        self.tokens = [b""] * self._library.get_vocab_size()
        for token, i in json.loads(packed)["model"]["vocab"].items():
            self.tokens[i] = bytes(byte_of.get(c, 0) for c in token)
        self.lengths = np.array(list(map(len, self.tokens)), np.int64)
        # Without a normaliser and with a token for every byte, the tokens' bytes are those of any text.
        self.whole = self._library.normalizer is None and not set(map(lambda b: bytes([b]), range(256))) - set(self.tokens)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]


class Pieces:
    """Tokenizer B, a piece model without normalisation; every text begins with the space that the model adds by itself.

    ``apart``: no piece holds a space behind another character, so what two texts yield is the same apart and joined.
    """

    def __init__(self, packed: bytes):
        self._library = sentencepiece.SentencePieceProcessor(model_proto=packed)
        shown = [self._library.id_to_piece(i) for i in range(self._library.get_piece_size())]
        self.tokens = [bytes([int(p[3:-1], 16)]) if self._library.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(shown)]
        self.lengths = np.array(list(map(len, self.tokens)), np.int64)
        self.apart = not any(MARK in p.lstrip(MARK) for p in shown)
        # Signs that no piece holds behind a letter or digit: between the two, nothing is ever joined.
        inside = {y for p in shown for x, y in zip(p, p[1:]) if x.isascii() and x.isalnum()}
        self.signs = [ord(c) for c in ",.;:!?)" if c not in inside] if self.apart else []
        self._space = [self._library.piece_to_id(MARK)]
        self._lead = len(self._library.encode("a"))

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of each text; one that begins with a sign is encoded behind a letter, whose ids are left out."""
        spaced = [t.startswith(b" ") for t in texts]
        found = self._library.encode([t[1:].decode() if own else "a" + t.decode() for t, own in zip(texts, spaced)], num_threads=1)
        return [ids or self._space if own else ids[self._lead:] for ids, own in zip(found, spaced)]


def words(data: bytes, starts: np.ndarray, signs: list[int]) -> np.ndarray:
    """Where words begin: at ``starts``, at spaces between two characters that are no blanks, and at ``signs`` behind an ASCII letter or
    digit; neither tokenizer joins across these places.

    Characters whose first byte any other blank has count as blanks.
    """
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(1, np.uint8)))
    at = np.flatnonzero(raw[:-1] == 32)
    blank = np.zeros(256, bool)
    blank[[0, *range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True
    inner = at[at >= 3]
    inner = inner[~(blank[raw[inner + 1]] | (blank & (np.arange(256) < 128))[raw[inner - 1]] | (raw[inner - 2] == 0xC2) | ((raw[inner - 3] >= 0xE1) & (raw[inner - 3] <= 0xE3)))]
    kind = np.zeros(256, np.uint8)
    kind[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
    kind[signs] = 2
    shown = kind[raw[:-1]]
    sign = np.flatnonzero((shown[1:] == 2) & (shown[:-1] == 1)) + 1
    return np.unique(np.concatenate((inner, starts, sign)))


class Pair:
    """Both tokenizers, the ids of words that both have seen, and the parts that groups are written with."""

    def __init__(self, packed_a: bytes, packed_b: bytes):
        self.a, self.b = once("byte-level", packed_a, ByteLevel), once("pieces", packed_b, Pieces)
        # Each id in decimal, followed by what may follow it.
        self.parts = [f"{i}{sign}".encode() for n, signs in ((len(self.a.lengths), ",|"), (len(self.b.lengths), ",;")) for sign in signs for i in range(n)]
        self.known: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.older: dict[bytes, tuple[bytes, bytes] | None] = {}  # what was known before ``known`` was last full

    def _encoded(self, texts: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """The ids of both for each text, packed; nothing where the bytes of the tokens are not those of the text."""
        both = zip(texts, self.a.encode(texts), self.b.encode(texts))
        of_b = self.b.tokens.__getitem__
        return [(array("i", x).tobytes(), array("i", y).tobytes()) if b"".join(map(of_b, y)) == t and (self.a.whole or self.a.joined(x) == t) else None for t, x, y in both]

    def tokens(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of a space and each text; none where the bytes of the tokens are not those."""
        out, mark = [(np.zeros(0, np.int32),) * 2] * len(texts), MARK.encode()
        plain = [i for i, t in enumerate(texts) if t and mark not in t]
        if not plain:
            return out
        lead = [b" " + texts[i] for i in plain]
        data, sizes = b"".join(lead), np.array(list(map(len, lead)))
        ends = np.cumsum(sizes)
        start = words(data, ends - sizes, self.b.signs) if self.b.apart else ends - sizes
        pieces = [data[a:b] for a, b in zip(start.tolist(), [*start[1:].tolist(), len(data)])]
        known = self.known
        found = [known.get(piece, known) for piece in pieces]
        if gaps := [i for i, ids in enumerate(found) if ids is known]:
            wanted, older = {pieces[i] for i in gaps}, self.older
            new = {piece: older[piece] for piece in wanted if piece in older}
            missing = list(wanted - new.keys())
            new.update(zip(missing, self._encoded(missing)))
            for i in gaps:
                found[i] = new[pieces[i]]
            if len(known) + len(new) > REMEMBERED:
                self.older, self.known = known, {}
            self.known.update((piece, ids) for piece, ids in new.items() if len(piece) <= LONGEST_REMEMBERED)
        bounds = np.searchsorted(start, np.concatenate(([0], ends)))
        whole = None not in found
        for i, text, low, high in zip(plain, lead, bounds[:-1].tolist(), bounds[1:].tolist()):
            part = found[low:high]
            if not whole and None in part:  # the bytes of one word differ, so those of the text may
                part = self._encoded([text])
                if part[0] is None:
                    continue
            out[i] = tuple(np.frombuffer(b"".join(side), np.int32) for side in zip(*part))
        return out

    def aligned(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the last token of A and of B in each group."""
        return common(np.cumsum(self.a.lengths[ids_a]), np.cumsum(self.b.lengths[ids_b]))

    def written(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        ended_a, ended_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        ended_a[last_a], ended_b[last_b] = 1, 1
        before_a, before_b = np.cumsum(ended_a) - ended_a, np.cumsum(ended_b) - ended_b  # groups that lie before a token
        size_a, size_b = np.diff(np.concatenate(([-1], last_a))), np.diff(np.concatenate(([-1], last_b)))
        many_a, many_b = np.concatenate(([0], np.cumsum(size_a))), np.concatenate(([0], np.cumsum(size_b)))
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + many_b[before_a]] = ids_a + len(self.a.lengths) * ended_a
        order[np.arange(len(ids_b)) + many_a[before_b + 1]] = ids_b + 2 * len(self.a.lengths) + len(self.b.lengths) * ended_b
        return b"".join(map(self.parts.__getitem__, order.tolist()))[:-1]


def _opened(spark, *paths: str):
    return [spark.sparkContext.broadcast(Path(p).read_bytes()) for p in paths]  # files of fixed size


def _pair(files) -> Pair:
    packed = [f.value for f in files]
    return once("pair", b"".join(packed), lambda _: Pair(*packed))


def alignments(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document: doc_id, a_ids, b_ids, a_ends, b_ends (number of tokens up to the end of each group), b_from, b_to (for each token
    of A the first and last token of B that overlap it)."""
    files = _opened(documents.sparkSession, path_a, path_b)

    def build(batches):
        both = _pair(files)
        for keys, texts in grouped(text_slices(batches)):
            columns = [[] for _ in range(6)]
            for ids_a, ids_b in both.tokens(texts):
                last_a, last_b = both.aligned(ids_a, ids_b)
                first, last = overlaps(np.cumsum(both.a.lengths[ids_a]), np.cumsum(both.b.lengths[ids_b])) if len(ids_a) else (last_a, last_b)
                for column, values in zip(columns, (ids_a, ids_b, last_a + 1, last_b + 1, first, last)):
                    column.append(values)
            arrays = [listed(np.concatenate(c), np.concatenate(([0], np.cumsum(list(map(len, c))))), pa.int32()) for c in columns]
            yield pa.RecordBatch.from_arrays([keys, *arrays], names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends", "b_from", "b_to"])

    lists = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_ends", "b_ends", "b_from", "b_to"))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, f"doc_id long, {lists}")


def _linked(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document with its counts and digest, and its distinct linked id pairs (A's id in the upper half) with their numbers."""
    files = _opened(documents.sparkSession, path_a, path_b)

    def build(batches):
        both, row = _pair(files), TaskContext.get().partitionId() << 40
        for keys, texts in grouped(text_slices(batches)):
            rows, pairs, times, sizes = [], [], [], [0]
            for ids_a, ids_b in both.tokens(texts):
                last_a, last_b = both.aligned(ids_a, ids_b)
                digest = hashlib.sha256(both.written(ids_a, ids_b, last_a, last_b)).hexdigest() if len(ids_a) else ""
                pair, n = np.unique(ids_a[last_a].astype(np.int64) << 32 | ids_b[last_b], return_counts=True)
                rows.append((row, len(ids_a), len(ids_b), len(last_a), int(n.sum()), digest))
                pairs.append(pair)
                times.append(n)
                sizes.append(len(pair))
                row += 1
            bounds = np.cumsum(sizes)
            columns = [pa.array(c) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([keys, *columns, listed(np.concatenate(pairs), bounds, pa.int64()), listed(np.concatenate(times), bounds, pa.int32())],
                                             names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "times"])

    shape = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<long>, times array<int>"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, shape)


def link_counts(linked: DataFrame) -> DataFrame:
    """For every linked id pair of the corpus: pair, total, and ``best``, whether no other pair of its B id is linked more often."""
    one = linked.select(F.explode(F.arrays_zip("pair", "times")).alias("l"))
    total = stored(one.groupBy(F.col("l.pair").alias("pair")).agg(F.sum("l.times").alias("total")), "pairs")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = total.groupBy(b_id.alias("b_id")).agg(F.max("total").alias("highest"))
    met = total.withColumn("b_id", b_id).join(highest, "b_id")
    return met.select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def link_report(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``count_sum`` adds up, over the document's links, how often the corpus links the id pair; ``n_best`` counts the links whose number is
    the highest of their B id.
    """
    linked = stored(_linked(documents, path_a, path_b), "linked")
    counts = link_counts(linked)
    own = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    one = linked.where("n_links > 0").select("row", F.explode(F.arrays_zip("pair", "times")).alias("l")).select("row", F.col("l.pair").alias("pair"), F.col("l.times").alias("times"))
    # Bounded by the vocabularies: of a linked pair one token is a suffix of the other.
    met = one.join(F.broadcast(counts), "pair")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("total")).alias("count_sum"))
    found = linked.select(*own).join(sums, "row", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
