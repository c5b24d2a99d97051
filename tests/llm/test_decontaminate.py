import math
import random
import re
from collections import Counter

import duckdb
import pytest

from salesflow.llm import decontaminate as ops

DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def shingles(w, n):
    return Counter(tuple(w[k:k + n]) for k in range(len(w) - n + 1))


def brute(docs, items):
    """All aligned windows of every document against every item."""
    of = {}
    for i, t in sorted(items):
        if words(t) and tuple(words(t)) not in of:
            of[tuple(words(t))] = i
    grams = {w: shingles(w, min(5, len(w))) for w in of}
    holders = Counter(g for c in grams.values() for g in c)
    weight = {g: 1 + math.log(len(of) / n) for g, n in holders.items()}
    out = {}
    for d, t, *_ in docs:
        w, best = words(t), {}
        for item, i in of.items():
            n, whole = min(5, len(item)), sum(weight[g] * k for g, k in grams[item].items())
            held = shingles(w, n)
            for at in range(max(1, len(w) - n + 1)) if any(g in held for g in grams[item]) else ():
                there = shingles(w[at:at + len(item)], n)
                common = sum(weight[g] * min(k, there[g]) for g, k in grams[item].items())
                if 100 * common / whole >= 80 - 1e-9:
                    best[i] = True
        out[d] = sorted(best)
    return out


def made():
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 15, 30, 55])))) for i in range(25)] + [(90, None), (91, " .,"), (92, "solo")]
    items.append((95, items[4][1].upper()))
    docs = []
    for d in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 60, 400]))]
        if d % 2:
            passage = rng.choice(items[:25])[1].split()
            if d % 6 == 1 and len(passage) > 20:
                passage[len(passage) // 2] = "changed"
            if d % 6 == 3:
                passage = passage[: len(passage) // 2]
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        docs.append((d, (", " if d % 3 else " ").join(text), "x"))
    return docs + [(100, None, "x"), (101, "", "x"), (102, "... solo!", "x")], items


@pytest.mark.parametrize("rows", [500_000, 0])
def test_as_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(ops, "BROADCAST_ROWS", rows)
    docs, items = made()
    out = ops.decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {r["doc_id"]: r["item_ids"] for r in out} == brute(docs, items)
    assert all(r["contaminated"] == bool(r["item_ids"]) == (not r["kept"]) and (r["similarity"] >= 0.8) == r["contaminated"] for r in out)


def shared_prompt(own, foreign, lost):
    """Items of a common prompt and ``own`` words each; documents hold an item's part of the prompt and question among other words."""
    prompt = [f"p{k}" for k in range(40)]
    items = [(i, " ".join([*prompt, *[f"q{i}x{k}" for k in range(own)]])) for i in range(60)]
    docs = []
    for d in range(0, 60, 4):
        kept = items[d][1].split()[foreign:40 + own - lost]
        docs.append((d, " ".join([*[f"f{d}x{k}" for k in range(foreign)], *kept, *[f"g{d}x{k}" for k in range(30)]]), "x"))
    return docs, items


@pytest.mark.parametrize("own, foreign, lost", [(12, 16, 0), (1, 0, 1)])
def test_shared_prompt_as_brute_force(spark, own, foreign, lost):
    docs, items = shared_prompt(own, foreign, lost)
    out = ops.decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    expected = brute(docs, items)
    assert {r["doc_id"]: r["item_ids"] for r in out} == expected and any(expected.values())


def test_empty_sides_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", ""), (1, "a b c d e f g", ""), (None, "q", "")], DOCS)
    clean = ops.decontaminate(docs, spark.createDataFrame([], ITEMS)).collect()
    assert len(clean) == 3 and all(r["kept"] for r in clean)
    items = spark.createDataFrame([(7, "A b c, d e f g"), (8, "a b c d e f g")], ITEMS)
    assert [r["item_ids"] for r in ops.decontaminate(docs, items).orderBy("doc_id").collect()] == [[], [7], [7]]
    assert ops.decontaminate(docs.where("false"), items).collect() == []
    left = ops.drop_contaminated(docs, items)
    assert left.columns == docs.columns and [r["doc_id"] for r in left.collect()] == [None]


def test_query_on_small_tables(spark):
    from salesflow.llm import queries

    d = "/root/testdata/sf0.001"
    read = lambda t, c: duckdb.sql(f"SELECT {c}, text FROM '{d}/{t}.parquet'").fetchall()
    out = queries.op4_decontaminate(spark, d).collect()
    expected = brute(read("documents", "doc_id"), read("benchmark", "item_id"))
    assert {r["doc_id"]: r["item_ids"] for r in out} == expected and any(expected.values())
