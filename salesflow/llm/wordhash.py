"""Words and shingles of many texts as 64-bit hashes, computed on whole byte blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from salesflow.llm.shared import blocks

BLANKS = b" \t\n\x0b\x0c\r"
GROUP_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n modulo 2**64."""
    if base not in _powers or len(_powers[base]) <= n:
        steps = np.full(max(n, 1 << 16) + 1, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base]


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of one block."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate(([True], _IS_BLANK[raw], [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate((raw.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(raw))[:len(raw)])))
    value = (total[end] - total[start]) * _power(_INVERSE, len(raw))[start]
    return start, mixed(value + (end - start).astype(np.uint64) * _STEP)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and for text i its place ``bounds[i]:bounds[i + 1]`` among them."""
    parts, counts, group, size = [], np.zeros(len(texts), np.int64), [], 0

    def flush() -> None:
        if group:
            start, value = _words(b"\n".join(texts[i] for i in group))
            ends = np.cumsum([len(texts[i]) + 1 for i in group])
            counts[group] = np.bincount(np.searchsorted(ends, start, side="right"), minlength=len(group))
            parts.append(value)
            group.clear()

    for i, text in enumerate(texts):
        if len(text) > GROUP_BYTES:
            flush()
            size = 0
            pieces = [_words(piece)[1] for piece in blocks(text, BLANKS, GROUP_BYTES)]
            counts[i] = sum(map(len, pieces))
            parts.extend(pieces)
            continue
        if size + len(text) > GROUP_BYTES:
            flush()
            size = 0
        group.append(i)
        size += len(text) + 1
    flush()
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(counts)))


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; with fewer words the whole sequence is one, without words there is none."""
    value, bounds = word_hashes(texts)
    rolled = np.zeros(max(0, len(value) - words + 1), np.uint64)
    for k in range(words):
        rolled = rolled * _STEP + value[k:k + len(rolled)]
    rolled = mixed(rolled)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            yield np.unique(rolled[a:b - words + 1])
        elif b > a:
            short = np.uint64(b - a)
            for v in value[a:b]:
                short = np.uint64((int(short) * int(_STEP) + int(v)) & 0xFFFFFFFFFFFFFFFF)
            yield mixed(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """First column, and second column as bytes, of a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column(0), part.column(1).cast(pa.binary()).to_pylist()
