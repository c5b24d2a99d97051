"""Best-first search against scoring every document."""

import math
import random
import re

import numpy as np

from salesflow.llm import lexical
from salesflow.llm.lexical import TERM


def fold(text):
    return re.findall(TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def scores(docs, items, k):
    """By the formula: (item, rank, doc, score) of all."""
    terms = [fold(t) for _, t in docs]
    n, total = sum(bool(t) for t in terms), sum(map(len, terms))
    out = []
    for name, text in items:
        scored = []
        for (identifier, _), held in zip(docs, terms):
            if held:
                m = 100 - 75 + (75 * len(held) * n) // total
                s = 0
                for term in fold(text):
                    tf = held.count(term)
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * sum(term in h for h in terms) + 1)))
                    s += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
                if s > 0:
                    scored.append((-s, identifier is None, identifier or 0, identifier))
        out += [(name, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k, parts=3):
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, term string, shard int").repartition(parts)
    asked = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, block int")
    return sorted((tuple(r) for r in lexical.search(lexical.index(table), asked, k).collect()), key=str)


def test_ranks_of_random_texts(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 150)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 4)
    draw = random.Random(8)
    vocabulary = [f"w{int(draw.paretovariate(0.7))}" for _ in range(300)]
    text = lambda n: draw.choice(" .\n-").join(draw.choice(vocabulary) for _ in range(n))
    docs = [(i, text(draw.choice([1, 3, 10, 40, 200]))) for i in range(160)]
    docs += [(1000 - i, docs[7][1]) for i in range(40)]  # many copies
    items = [(i, text(draw.choice([1, 2, 8, 30]))) for i in range(15)]
    assert found(spark, docs, items, 10) == scores(docs, items, 10)
    assert found(spark, docs, items, 3, parts=1) == scores(docs, items, 3)


def test_rows_of_every_kind(spark):
    docs = [(1, "Äpfel and Birnen"), (2, None), (3, ""), (4, "..."), (5, "apfel äpfel"), (5, "Äpfel"), (None, "and AND and"), (6, "and " * 5000 + "birnen"), (7, "other"), (8, "more words"), (9, "x" * 100000)]
    items = [(1, "and birnen, birnen"), (1, "Äpfel"), (2, None), (3, ""), (4, "unknown"), (None, "other x" + "x" * 99999)]
    assert found(spark, docs, items, 10) == scores(docs, items, 10)
    empty = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(lexical.index(empty), asked, 10).count() == 0
    assert lexical.search(lexical.index(spark.createDataFrame(docs, "doc_id long, text string")), asked.limit(0), 10).count() == 0


def test_a_term_of_all_documents_weighs_nothing(spark):
    docs = [(i, "same words") for i in range(600)]
    assert found(spark, docs, [(1, "same")], 10) == scores(docs[:600], [(1, "same")], 10)


def test_highest_of_every_range():
    draw = np.random.default_rng(3)
    docs = [np.sort(draw.choice(200, n, replace=False)) for n in (150, 31, 8, 1)]
    impacts = [draw.integers(0, 9, len(d)) for d in docs]
    lists = lexical.Lists(docs, impacts, 200)
    for t, values in enumerate(impacts):
        for a in range(len(values)):
            for b in range(a + 1, len(values) + 1):
                assert lists.highest(lists.start[[t]] + a, lists.start[[t]] + b)[0] - lists.start[t] == a + int(np.argmax(values[a:b]))


def test_copies_of_the_best_cost_no_extra_intervals(monkeypatch):
    tries = []
    real = lexical.Lists.find
    monkeypatch.setattr(lexical.Lists, "find", lambda self, own, doc: tries.append(len(doc)) or real(self, own, doc))
    lists = lexical.Lists([np.arange(5000)], [np.full(5000, 7)], 5000)
    assert lexical.best_first(lists, [(np.array([0]), np.array([1]))], 10)[0] == [(7, i) for i in range(10)]
    assert sum(tries) < 100
