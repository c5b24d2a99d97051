"""Byte-level BPE encoding and decoding.

Texts are cut into words by a scan over codepoint classes (``pretokens``), the words' slices are merged once and remembered, and every
token's byte offset is kept, so that ids can be followed back into the text and decoded. The vocabulary is a file of base64 tokens with
their ranks; merging joins the adjacent pair of lowest rank, the leftmost first, and a slice that is itself a token is that token.

Edge cases: a null text counts as empty and has no tokens; text that looks like a special token is plain text; a word of any length is
merged whole, in n log n steps; a text of any length is read in blocks whose state goes on; repeated rows and reused or null ids give a row
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.pretokens import boundaries
from salesflow.llm.wordhash import text_slices

REMEMBERED = 1 << 18
SHORT = 48
_NONE = 1 << 62
LONGEST_REMEMBERED = 128
GROUP_BYTES = 1 << 20
_made: dict[tuple[str, bytes], object] = {}


def once(kind: str, packed: bytes, make: Callable[[bytes], object]):
    """What ``make`` builds of the bytes, built once in a process."""
    key = kind, hashlib.sha256(packed).digest()
    if key not in _made:
        _made[key] = make(packed)
    return _made[key]


def read_ranks(packed: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, packed.splitlines())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: a heap of adjacent pairs, lowest rank first and then leftmost, over a linked list of parts."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    after, before, ends = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))  # by start; ends[i] = 0: no longer a part
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if ends[i] else n
        if j == n or ends[j] != end:
            continue  # one of its parts has been merged meanwhile
        ends[i], ends[j], after[i] = end, 0, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (rank := ranks.get(word[i:ends[after[i]]])) is not None:
                heapq.heappush(heap, (rank, i, ends[after[i]]))
        if before[i] >= 0 and (rank := ranks.get(word[before[i]:end])) is not None:
            heapq.heappush(heap, (rank, before[i], end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:ends[i]]])
        i = after[i]
    return out


class Merger:
    """Merges many words side by side: every round joins the leftmost pair of lowest rank of each."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        joined = [(a << 32 | b, rank) for token, rank in ranks.items() for k in range(1, len(token))
                  if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None]
        self._pairs, self._rank = (np.array(x, np.int64) for x in zip(*sorted(joined))) if joined else (np.zeros(0, np.int64),) * 2
        self._byte = np.array([ranks.get(bytes([b]), 0) for b in range(256)], np.int64)

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self._pairs):
            return np.full(len(left), _NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._rank[at], _NONE)

    def __call__(self, words: list[bytes]) -> list[list[int]]:
        out = [[rank] if (rank := self.ranks.get(word)) is not None else merge(word, self.ranks) if len(word) > SHORT else None for word in words]
        number = np.array([i for i, ids in enumerate(out) if ids is None], np.int64)
        ids = self._byte[np.frombuffer(b"".join(words[i] for i in number), np.uint8)]
        sizes = np.array([len(words[i]) for i in number], np.int64)
        rank = np.append(self._ranked(ids[:-1], ids[1:]), _NONE) if len(ids) else ids
        rank[np.cumsum(sizes) - 1] = _NONE
        while len(number):
            start = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank, start)
            done = least == _NONE
            if done.any():
                ended, part = np.flatnonzero(done), np.repeat(done, sizes)
                lists, at = ids[part].tolist(), 0
                for i, size in zip(number[ended].tolist(), sizes[ended].tolist()):
                    out[i] = lists[at:at + size]
                    at += size
                ids, rank, number, sizes, least = ids[~part], rank[~part], number[~done], sizes[~done], least[~done]
                continue
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            owner = np.repeat(np.arange(len(sizes)), sizes)[hit]
            hit = hit[np.concatenate(([True], owner[1:] != owner[:-1]))]
            ids[hit] = rank[hit]
            rank[hit] = rank[hit + 1]  # a word's last part stays one
            stays = np.ones(len(ids), bool)
            stays[hit + 1] = False
            ids, rank, sizes, hit = ids[stays], rank[stays], sizes - 1, hit - np.arange(len(hit))
            start = start - np.arange(len(start))
            inner = hit[hit < start + sizes - 1]
            rank[inner] = self._ranked(ids[inner], ids[inner + 1])
            rank[hit[hit == start + sizes - 1]] = _NONE
            earlier = hit[hit > start] - 1
            rank[earlier] = self._ranked(ids[earlier], ids[earlier + 1])
        return out


class Codec:
    """Encodes and decodes with one vocabulary; remembers the ids of up to ``REMEMBERED`` words, packed."""

    def __init__(self, ranks: dict[bytes, int], encode_words: Callable[[list[bytes]], list[list[int]]] | None = None):
        self.encode_words = encode_words or Merger(ranks)
        self.known: dict[bytes, bytes] = {}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self._begin = np.concatenate(([0], np.cumsum(self.lengths)[:-1])) if tokens else np.zeros(0, np.int64)
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def packed(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word as 32-bit numbers in one byte string."""
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            gaps = [i for i, ids in enumerate(found) if ids is None]
            missing = list({words[i] for i in gaps})
            if len(known) + len(missing) > REMEMBERED:
                known.clear()
            new = dict(zip(missing, (array("i", ids).tobytes() for ids in self.encode_words(missing))))
            for i in gaps:
                found[i] = new[words[i]]
            known.update((word, ids) for word, ids in new.items() if len(word) <= LONGEST_REMEMBERED)
        return found

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and for text i its place ``bounds[i]:bounds[i + 1]`` among them."""
        data = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        start = boundaries(data, (ends - sizes)[sizes > 0])
        words = [data[a:b] for a, b in zip(start.tolist(), [*start[1:].tolist(), len(data)])]
        packed = self.packed(words)
        counts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)) >> 2)))
        return np.frombuffer(b"".join(packed), np.int32), np.concatenate(([0], counts[np.searchsorted(start, ends)]))

    def starts(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of every token of one text."""
        sizes = self.lengths[ids]
        return np.cumsum(sizes) - sizes

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.lengths[ids]
        shift = np.repeat(self._begin[ids] - (np.cumsum(sizes) - sizes), sizes)
        return self._bytes[shift + np.arange(len(shift))].tobytes()


def grouped(slices: Iterator[tuple[pa.Array, list[bytes | None]]], size: int = GROUP_BYTES) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Slices cut into groups of about ``size`` bytes of text, null as empty; a longer text is a group of its own."""
    for keys, texts in slices:
        texts = [t or b"" for t in texts]
        at = 0
        while at < len(texts):
            end, total = at + 1, len(texts[at])
            while end < len(texts) and total + len(texts[end]) <= size:
                total += len(texts[end])
                end += 1
            yield keys.slice(at, end - at), texts[at:end]
            at = end


def listed(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def encoded(documents: DataFrame, ranks_path: str) -> DataFrame:
    """A row per document: doc_id, ids, starts (byte offset of every token in the text)."""
    vocabulary = documents.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())  # a file of fixed size

    def build(batches):
        codec = once("ranks", vocabulary.value, lambda packed: Codec(read_ranks(packed)))
        for keys, texts in grouped(text_slices(batches)):
            ids, bounds = codec.encode(texts)
            offsets = codec.starts(ids)
            begin = np.concatenate(([0], np.cumsum([len(t) for t in texts])))[:-1]
            offsets = offsets - np.repeat(begin, np.diff(bounds))
            yield pa.RecordBatch.from_arrays([keys, listed(ids, bounds, pa.int32()), listed(offsets, bounds, pa.int64())], names=["doc_id", "ids", "starts"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, "doc_id long, ids array<int>, starts array<long>")


def decoded(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of ``tokens`` (doc_id, ids) with ``bytes``, the concatenated bytes of the tokens; null ids count as none."""
    vocabulary = tokens.sparkSession.sparkContext.broadcast(Path(ranks_path).read_bytes())

    def build(batches):
        codec = once("ranks", vocabulary.value, lambda packed: Codec(read_ranks(packed)))
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                back = [codec.decode(np.array(ids.values, np.int64) if ids.is_valid else np.zeros(0, np.int64)) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(back, pa.binary())], names=["doc_id", "ids", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(build, "doc_id long, ids array<int>, bytes binary")
