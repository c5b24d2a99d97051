"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word (a run of letters, lowered, with the vocabulary's
word mark before it) has the probability of all its segmentations into pieces together, summed by the forward algorithm; a text has that
of all its words. Piece probabilities are fitted by expectation maximisation: forward-backward over the word counts of the training texts,
distributed, three times from a uniform start; they are then mixed with the pooled and the uniform distribution.

The model is fitted on at most ``SAMPLE`` labelled texts, those with the least hashed ids, whole; every text is then scored whole, in
slices. A vocabulary file is read on the driver only; its letter pieces travel with the tasks.

Edge cases: null texts and texts without a letter are ``und`` with score 0; so are all texts if nothing could be learned; a letter outside
the vocabulary has one small probability in every language; runs of letters of any length are scored whole, their forward values scaled so
that none underflows; in fitting, a run of more than ``RUN`` letters counts in pieces of RUN letters; ties go to the language first by code
point; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.shared import crc_remainder

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE, STEPS = 6_000, 3
RUN, UNKNOWN = 48, 1e-7
POOLED, UNIFORM = 0.04, 0.01
CACHE_WORDS, SLICE_CHARS = 400_000, 1 << 20
GROUP_LETTERS, SCALE_EVERY = 1 << 18, 8
UNDETERMINED = "und"
_MARK = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x100000001B3)
_COUNTS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """The lower-case letter pieces of a vocabulary file, with the word mark where they have it."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_byte(i) and not model.is_unknown(i))
    return sorted({p for p in pieces if p == _MARK or (p.removeprefix(_MARK).isalpha() and p == p.lower())})


def _hash(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(codes.shape[0], np.uint64)
    for k in range(codes.shape[1]):
        out = out * _BASE + codes[:, k]
    return out


class Pieces:
    """Looks up substrings of many words at once by rolling hash."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        hashes = np.array([int(_hash(_codes([p]))[0]) for p in pieces], np.uint64)
        self.order = np.argsort(hashes).astype(np.int64)
        self.hashes = hashes[self.order]
        self.none = len(pieces)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers; ``none`` where there is no such piece."""
        if not len(self.hashes):
            return np.full(len(hashes), self.none)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], self.none)


def _codes(words: list[str]) -> np.ndarray:
    """Code points, one word of equal length a row."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for places in groups.values():
        for at in range(0, len(places), 4096):
            part = places[at:at + 4096]
            yield np.array(part), [words[i] for i in part]


def _lattice(pieces: Pieces, words: list[str]) -> dict[tuple[int, int], np.ndarray]:
    """For words of equal length: piece numbers of every substring (start, end) that can be a piece or a single letter."""
    codes = _codes(words)
    n = codes.shape[1]
    prefix = np.zeros((n + 1, len(words)), np.uint64)
    for k in range(n):
        prefix[k + 1] = prefix[k] * _BASE + codes[:, k]
    power = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, _BASE))))
    return {(i, j): pieces.ids(prefix[j] - prefix[i] * power[j - i]) for j in range(1, n + 1) for i in range(max(0, j - pieces.longest), j)}


def _chances(model: np.ndarray, ids: np.ndarray, single: bool) -> np.ndarray:
    """Probabilities (words, languages) of one substring; an unknown single letter has UNKNOWN."""
    out = model[ids]
    if single:
        out = np.where((ids == len(model) - 1)[:, None], UNKNOWN, out)
    return out


def log_likelihoods(pieces: Pieces, model: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each marked word in each language, all segmentations summed; ``model`` has a zero row for no piece."""
    out = np.zeros((len(words), model.shape[1]))
    for places, group in _by_length(words):
        out[places] = _forward_logs(pieces, model, _codes(group))
    return out


def _forward_logs(pieces: Pieces, model: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The forward algorithm over words of equal length (words, letters), a stretch of letters at a time.

    ``forward`` holds the values at the last ``longest`` places and those of the stretch. Every SCALE_EVERY letters the
    values still needed are divided by the latest and its logarithm is kept, so words of any length neither underflow nor
    fill the memory. A letter lowers a value by UNKNOWN at most, so the values of a reach stay far from the least number.
    """
    count, n = codes.shape
    reach, logs = pieces.longest, np.zeros((count, model.shape[1]))
    stretch = max(1, GROUP_LETTERS // count)
    power = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(reach, _BASE))))
    tail = np.zeros((reach, count, model.shape[1]))
    tail[-1] = 1.0
    for start in range(0, n, stretch):
        first, end = max(0, start + 1 - reach), min(n, start + stretch)
        prefix = np.zeros((end - first + 1, count), np.uint64)
        for k in range(first, end):
            prefix[k - first + 1] = prefix[k - first] * _BASE + codes[:, k]
        # ids[j, reach - k]: the piece of k letters that ends after letter start + j.
        ids = np.full((end - start, reach, count), pieces.none, np.int32)
        for k in range(1, min(reach, end) + 1):
            low = max(start + 1, k)
            if low <= end:
                hashes = prefix[low - first:] - prefix[low - k - first:end - k - first + 1] * power[k]
                ids[low - start - 1:, reach - k] = pieces.ids(hashes.ravel()).reshape(hashes.shape)
        forward = np.concatenate((tail, np.zeros((end - start, count, model.shape[1]))))
        for j in range(end - start):
            chances = model[ids[j]]
            chances[-1][ids[j, -1] == pieces.none] = UNKNOWN
            forward[reach + j] = np.einsum("kwl,kwl->wl", chances, forward[j:reach + j])
            if (start + j + 1) % SCALE_EVERY == 0:
                scale = np.maximum(forward[reach + j], 1e-300)
                logs += np.log(scale)
                forward[j + 1:reach + j + 1] /= scale
        tail = forward[-reach:]
    return logs + np.log(np.maximum(tail[-1], 1e-300))


def expected_counts(pieces: Pieces, model: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece by language, for words with counts (words, languages)."""
    total = np.zeros_like(model)
    for places, group in _by_length(words):
        lattice, n = _lattice(pieces, group), len(group[0])
        step = {(i, j): _chances(model, ids, j - i == 1) for (i, j), ids in lattice.items()}
        forward, backward = [np.ones((len(group), model.shape[1]))], [None] * n + [np.ones((len(group), model.shape[1]))]
        for j in range(1, n + 1):
            forward.append(sum(forward[i] * step[i, j] for i in range(max(0, j - pieces.longest), j)))
        for i in range(n - 1, -1, -1):
            backward[i] = sum(step[i, j] * backward[j] for j in range(i + 1, min(n, i + pieces.longest) + 1))
        share = counts[places] / np.maximum(forward[n], 1e-300)
        for (i, j), ids in lattice.items():
            weight = forward[i] * step[i, j] * backward[j] * share
            for language in range(model.shape[1]):
                total[:, language] += np.bincount(ids, weight[:, language], minlength=len(model))
    total[-1] = 0.0
    return total


def _words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _words_to_fit(text: str) -> list[str]:
    """The words of a text, long runs of letters cut at RUN."""
    found = _words(text)
    if any(len(w) > RUN for w in found):
        found = [w[at:at + RUN] for w in found for at in range(0, len(w), RUN)]
    return found


def _pieces_of(text: str) -> Iterator[str]:
    """Slices of about SLICE_CHARS that end after a word."""
    start = 0
    while start < len(text):
        end = start + SLICE_CHARS
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[start:end]
        start = end


@dataclass
class Model:
    pieces: list[str]
    languages: list[str]
    chances: np.ndarray  # (pieces + 1, languages), the last row zero

    def identify(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, lang_pred, score for (doc_id, text)."""
        table = Pieces(self.pieces)
        known: dict[str, int] = {}
        values = np.zeros((0, len(self.languages)))

        def likelihood(words: list[str]) -> np.ndarray:
            nonlocal values
            new = [w for w in words if w not in known]
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                values, new = np.zeros((0, len(self.languages))), words
            if new:
                known.update((w, len(values) + k) for k, w in enumerate(new))
                values = np.concatenate((values, log_likelihoods(table, self.chances, [_MARK + w for w in new])))
            return values[[known[w] for w in words]]

        for batch in batches:
            sums, letters = np.zeros((batch.num_rows, len(self.languages))), np.zeros(batch.num_rows, bool)
            words: list[str] = []
            owner: list[tuple[int, int]] = []

            def flush() -> None:
                if words:
                    codes, distinct = pd.factorize(np.array(words, dtype=object))
                    found = likelihood(list(distinct))[codes]
                    rows = np.repeat([r for r, _ in owner], [n for _, n in owner])
                    for language in range(len(self.languages)):
                        sums[:, language] += np.bincount(rows, found[:, language], minlength=batch.num_rows)
                words.clear()
                owner.clear()

            for row, text in enumerate(batch["text"].to_pylist()):
                for part in _pieces_of(text or ""):
                    found = _words(part)
                    letters[row] |= any(c.isalpha() for w in found for c in w)
                    words += found
                    owner.append((row, len(found)))
                    if len(words) > 200_000:
                        flush()
            flush()
            best = sums.argmax(axis=1) if self.languages else np.zeros(batch.num_rows, int)
            spread = np.exp(sums - sums.max(axis=1, keepdims=True)) if self.languages else np.ones((batch.num_rows, 1))
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array([self.languages[b] if ok and self.languages else UNDETERMINED for b, ok in zip(best, letters)], pa.string()),
                pa.array(np.where(letters & bool(self.languages), 1.0 / spread.sum(axis=1), 0.0), pa.float64()),
            ], names=["doc_id", "lang_pred", "score"])


def _word_counts(sample: DataFrame) -> DataFrame:
    """lang, word, n over the sample."""

    def count(batches):
        for batch in batches:
            found: dict[str, Counter] = {}
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                for part in _pieces_of(text):
                    found.setdefault(lang, Counter()).update(_words_to_fit(part))
            for lang, words in found.items():
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(words), "word": list(words), "n": list(words.values())}, schema=_COUNTS)

    return sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(documents: DataFrame, pieces: list[str], size: int = SAMPLE, steps: int = STEPS) -> Model:
    """Piece probabilities by language from at most ``size`` documents (doc_id, text, lang) with a language and a text."""
    usable = documents.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = usable.select(F.col("doc_id").alias("of")).orderBy(F.xxhash64(F.lit("language"), "of"), "of").limit(size)
    sample = usable.join(F.broadcast(chosen.distinct()), usable["doc_id"] == F.col("of")).select("text", "lang")  # at most ``size`` numbers
    counts = _word_counts(sample).cache()
    try:
        languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())  # at most ``size`` names
        number = {lang: k for k, lang in enumerate(languages)}
        model = np.full((len(pieces) + 1, len(languages)), 1.0 / max(1, len(pieces)))
        model[-1] = 0.0
        for _ in range(steps if languages else 0):
            model = _maximised(_expected(counts, pieces, model, number))
    finally:
        counts.unpersist()
    return Model(pieces, languages, model)


def _expected(counts: DataFrame, pieces: list[str], model: np.ndarray, number: dict[str, int]) -> np.ndarray:
    """Expected counts (pieces + 1, languages), summed by Spark per language and piece: as many rows as the model has numbers."""

    def expect(batches):
        table, total = Pieces(pieces), np.zeros_like(model)
        for batch in batches:
            words, distinct = pd.factorize(batch["word"])
            amount = np.zeros((len(distinct), len(number)))
            np.add.at(amount, (words, batch["lang"].map(number).to_numpy()), batch["n"].to_numpy())
            total += expected_counts(table, model, [_MARK + w for w in distinct], amount)
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "lang": lang, "n": total[piece, lang]})

    rows = counts.mapInPandas(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros_like(model)
    out[rows["piece"].to_numpy(int), rows["lang"].to_numpy(int)] = rows["n"]
    return out


def _maximised(counts: np.ndarray) -> np.ndarray:
    """Probabilities from expected counts, mixed with the pooled and the uniform distribution."""
    own = counts / np.maximum(counts.sum(axis=0), 1e-300)
    pooled = own.mean(axis=1, keepdims=True)
    out = (1 - POOLED - UNIFORM) * own + POOLED * pooled + UNIFORM / max(1, len(counts) - 1)
    out[-1] = 0.0
    return out


def identified(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """A row per document: doc_id, held_out, lang_pred, score; learned from ids whose CRC-32 modulo 5 is not 0."""
    remainder = crc_remainder(F.col("doc_id"), 5)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs.where(remainder != 0), vocabulary(path))
    out = docs.select("doc_id", "text").mapInArrow(model.identify, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
