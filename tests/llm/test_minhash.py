import random

import duckdb
import pytest

from salesflow.llm import minhash

SCHEMA = "doc_id long, text string, extra string"


def brute(rows, words, percent):
    sets = {}
    for i, t, *_ in rows:
        w = "".join(c.lower() if c.isascii() else c for c in (t or "")).split()
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(s), find(i), i == find(i)) for i, s in sets.items())


def made(words, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 90, 300]))]
        for copy in range(rng.choice([1, 3, 9])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text) if copy % 3 else " ".join(text).upper() + " \n")
    rows += [None, "", " \t\n", "one two", "One\x0btwo", "three", "ä Ä", "ä ä", "x " * 50, "x " * 60]
    rng.shuffle(rows)
    return [(10 * i + 3, t, "e") for i, t in enumerate(rows)]


@pytest.mark.parametrize("words", [4, 5])
def test_as_brute_force(spark, words):
    rows = made(words)
    out = minhash.near_groups(spark.createDataFrame(rows, SCHEMA), words)
    assert sorted(map(tuple, out.collect())) == brute(rows, words, 80)


@pytest.mark.parametrize("hot", [1, 6, 32])
def test_family_of_edited_copies(spark, monkeypatch, hot):
    monkeypatch.setattr(minhash, "HOT", hot)
    rng = random.Random(hot)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(70):
        text = list(base[rng.randrange(12):120 - rng.randrange(12)])
        for _ in range(rng.choice([1, 3, 5, 6, 7, 8])):
            text[rng.randrange(len(text))] = rng.choice(["same", f"own{i}{rng.random()}"])
        rows.append((i, " ".join(text), ""))
    out = minhash.near_groups(spark.createDataFrame(rows, SCHEMA), 4)
    assert sorted(map(tuple, out.collect())) == brute(rows, 4, 80)


def test_chain_of_links_is_one_group(spark):
    base = [f"c{k}" for k in range(200)]
    rows = [(i, " ".join(base[4 * i:4 * i + 100]), "") for i in range(20)]
    out = minhash.near_groups(spark.createDataFrame(rows, SCHEMA), 4)
    assert {r["component_id"] for r in out.collect()} == {0}


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e f", ""), (None, "a b c d e f", ""), (5, "a b c d e f", ""), (5, "a b c d e f", ""), (9, "A B c d e f", "")]
    out = minhash.near_groups(spark.createDataFrame(rows, SCHEMA), 4).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in out if r["doc_id"]) == [(5, 5, True), (5, 5, True), (9, 5, False)]
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)] * 2


def test_empty_table(spark):
    assert minhash.near_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_text_in_blocks(spark):
    long = " ".join(f"t{k % 5000}" for k in range(300_000))
    out = minhash.near_groups(spark.createDataFrame([(1, long, ""), (2, long + " end", ""), (3, "short one", "")], SCHEMA), 4)
    assert sorted(map(tuple, out.collect())) == [(1, 5000, 1, True), (2, 5001, 1, False), (3, 1, 3, True)]


def test_stage_keeps_columns(spark):
    rows = [(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, None, "z")]
    out = minhash.drop_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "extra"] and sorted(r["doc_id"] for r in out.collect()) == [1, 3]


def test_stage_tells_rows_apart_by_id_and_text(spark):
    one, other, third = (" ".join(f"{c}{k}" for k in range(60)) for c in "xyz")
    rows = [(5, one, ""), (5, other, ""), (2, one + " end", ""), (9, other + " end", ""), (7, third, ""), (7, third, ""), (None, third + " end", ""), (8, " ", ""), (8, " ", "")]
    out = minhash.drop_near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted([(2, one + " end"), (5, other), (7, third), (8, " "), (8, " ")])


def test_query_on_small_tables(spark):
    from salesflow.llm import queries

    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    out = queries.op1_near_dedup(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, out.collect())) == brute(rows, 4, 80)


@pytest.mark.parametrize("parts", [1, 2, 3, 5])
def test_a_reused_id_has_the_links_of_all_its_texts(spark, parts):
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(1, a), (5, b), (5, a), (9, a + " more"), (10, b + " more"), (11, "alone"), (5, None), (None, a), (12, "alone too")]
    out = minhash.near_groups(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(parts)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in out), key=str) == sorted([(1, 1), (5, 1), (5, 1), (5, 1), (9, 1), (10, 1), (11, 11), (None, None), (12, 12)], key=str)
    assert all(r.kept == (r.doc_id == r.component_id and r.doc_id is not None or r.doc_id is None) for r in out)
