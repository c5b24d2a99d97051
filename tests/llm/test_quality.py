import duckdb
import pytest

from salesflow.llm import quality as ops


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "h", "p", 0.1), (2, "", None, None, 0.1), (None, "good words here", "h", None, 0.1), (2, "", None, None, 0.1), (5, "x " * 500_000, "h", "p", 0.1)],
                                 "doc_id long, text string, host string, path string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    out = ops.judged(docs, labels).collect()
    assert len(out) == 5 and all(r["evidence"] == 0.0 and r["score"] == pytest.approx(0.5) for r in out)
    assert ops.judged(docs.where("false"), labels).collect() == []


def test_measures():
    m = dict(zip(ops.MEASURES, ops.measures(b"Ab |12 ab% ab%")))
    assert m["upper"] == 1 / 14 and m["digits"] == 2 / 14 and m["bars"] == 1 / 14 and m["symbols"] == 3 / 14 and m["distinct_words"] == 0.75 and m["length"] == 14


def test_sparse_sites_shrink_to_the_level_above(spark):
    bad = "%%% $$$ ### &&& *** %%% " * 20
    good = "some plain words that make a quiet sentence of their own kind " * 5
    rows = [(i, bad if i % 2 else good, "low" if i % 2 else "high", "p") for i in range(400)]
    lone = [(1000, good, "low", "p"), (1001, good, "high", "p"), (1002, good, "new", "p"), (1003, bad, "new2", "p")]
    docs = spark.createDataFrame(rows + lone, "doc_id long, text string, host string, path string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(400)], "doc_id long, quality int")
    out = {r["doc_id"]: r for r in ops.judged(docs, labels).collect()}
    assert out[1000]["prior"] < out[1002]["prior"] < out[1001]["prior"]
    assert out[1002]["evidence"] == out[1001]["evidence"] > 0 > out[1003]["evidence"] and out[1003]["predicted"] == 0


def test_held_out_accuracy(spark):
    from salesflow.llm import queries

    d = "/root/testdata/sf0.01"
    out = {r["doc_id"]: r for r in queries.op5_quality(spark, d).collect()}
    held = [(out[i]["predicted"], q) for i, q in duckdb.sql(f"SELECT doc_id, quality FROM '{d}/labels.parquet'").fetchall() if out[i]["held_out"]]
    assert len(out) == 1000 and len(held) > 50 and sum(a == b for a, b in held) >= 0.93 * len(held)


def shrunk(rows, labels):
    """(evidence, prior, score) per row by loops, sites recounted without the row: (doc_id, text, host, path) rows and their labels."""
    import math
    import zlib
    from collections import Counter

    import numpy as np

    bins = [[int(np.searchsorted(ops._EDGES.get(m, ops._SHARE), x, side="right")) for m, x in zip(ops.MEASURES, ops.measures((t or "").encode()))] for _, t, _, _ in rows]
    counts = [Counter(), Counter()]
    for (i, *_), b in zip(rows, bins):
        if i in labels and zlib.crc32(str(i).encode()) % 5:
            counts[labels[i]].update(enumerate(b))
    bad, good = (sum(n for (k, _), n in c.items() if k == 0) for c in counts)
    given = [sum(math.log((counts[1][key] + 1) / (good + ops.BINS)) - math.log((counts[0][key] + 1) / (bad + ops.BINS)) for key in enumerate(b)) for b in bins]
    p = [1 / (1 + math.exp(-e - math.log(good / bad))) for e in given]
    mean = sum(p) / len(p)

    def members(*site):
        return [x for x, (_, _, h, q) in zip(p, rows) if (h, q)[:len(site)] == site]

    def strength(sites, centre):
        between = sampling = 0.0
        for site in sites:
            x = members(*site)
            m = sum(x) / len(x)
            between += len(x) * (m - centre(site)) ** 2
            sampling += sum((y - m) ** 2 for y in x) / len(x)
        between, sampling = between / len(p), sampling / len(p)
        return ops.STRONGEST if between <= sampling else min(max(mean * (1 - mean) / (between - sampling) - 1, 1.0), ops.STRONGEST)

    of_hosts = strength({(h,) for _, _, h, _ in rows}, lambda site: mean)
    host_mean = lambda h: (sum(members(h)) + of_hosts * mean) / (len(members(h)) + of_hosts)
    of_paths = strength({(h, q) for _, _, h, q in rows}, lambda site: host_mean(site[0]))
    out = []
    for own, e, (_, _, h, q) in zip(p, given, rows):
        host, path = members(h), members(h, q)
        above = (sum(host) - own + of_hosts * mean) / (len(host) - 1 + of_hosts)
        prior = (sum(path) - own + of_paths * above) / (len(path) - 1 + of_paths)
        safe = min(max(prior, 1e-6), 1 - 1e-6)
        out.append((e, prior, 1 / (1 + math.exp(-e - math.log(safe / (1 - safe))))))
    return out


def test_shrinkage_as_brute_force(spark):
    import random

    rng = random.Random(5)
    words = "some plain words that make a quiet sentence of their own kind".split()
    rows = []
    for i in range(300):
        host, path = rng.choice(["a", "b", "b", "c", None, f"lone{i}"]), rng.choice(["x", "y", None])
        noise = {"a": 0.2, "b": 0.5, "c": 0.8}.get(host, 0.5) + (0.2 if path == "y" else 0.0)
        text = " ".join(rng.choice(["%%%", "$|$", "A1B"]) if rng.random() < 0.6 * noise else rng.choice(words) for _ in range(rng.choice([0, 3, 40, 200])))
        rows.append((i, rng.choice([text, text, text, None]) if i % 50 == 0 else text, host, path))
    labels = {i: int(rng.random() < (0.9 if (t or "").count("%") + (t or "").count("$") < 3 else 0.1)) for i, t, _, _ in rows if i % 3}
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string").repartition(5)
    out = {r["doc_id"]: (r["evidence"], r["prior"], r["score"]) for r in ops.judged(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int")).collect()}
    expected = shrunk(rows, labels)
    assert len(out) == len(rows) and max(abs(x - y) for (i, *_), e in zip(rows, expected) for x, y in zip(out[i], e)) < 1e-6
    assert len({round(prior, 3) for _, prior, _ in expected}) > 20
