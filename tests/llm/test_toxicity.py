import duckdb

from salesflow.llm import toxicity as ops


def test_folding():
    assert ops.folded("ＩＤ１ＯＴ іdіоt ÍDÏÖT id​iot") == "idiot idiot idiot idiot"
    assert ops.folded("tr@sh $cum clown$$$ 1d10t!!").split() == ["trash", "scum", "clown", "idiot"]


def test_matches_and_exceptions():
    lexicon = ops.Lexicon({"clown": 2.0, "^moro": 1.0}, ["clown fish"])
    assert [m[2] for m in lexicon.matches("a clown, moronic; clowns tomoro clown fish moro")] == [2.0, 1.0, 1.0]
    assert lexicon.measure(None) == lexicon.measure("") == 0.0


def test_long_text_is_read_whole():
    lexicon = ops.Lexicon({"scum": 3.0}, [], 0.0, 1.0)
    text = "word " * 200_000 + "scum"
    assert sum(len(p) for p in ops.pieces(text)) == len(text) and lexicon.measure(text) > 0


def test_pruning_keeps_the_longest_equal_beginning():
    rows = [("^low", 40, 0), ("^lowe", 40, 0), ("^lowei", 40, 0), ("^loweie", 12, 0), ("loweiä", 12, 0), ("^idi", 30, 0), ("^idio", 30, 0), ("^idiot", 30, 0), ("idiot", 30, 0)]
    assert set(ops._pruned(rows, 100, 900)) == {"^lowei", "idiot"}


def test_degenerate_tables(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a", "x"), (2, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = ops.judged(docs, labels).collect()
    assert len(out) == 4 and {(r["score"], r["predicted"]) for r in out} == {(0.0, 0)}
    assert ops.judged(docs.where("false"), labels).collect() == []
    assert ops.drop_toxic(docs, labels).columns == docs.columns and ops.drop_toxic(docs, labels).count() == 4


def test_held_out_accuracy(spark):
    from salesflow.llm import queries

    d = "/root/testdata/sf0.1"
    out = {r["doc_id"]: r for r in queries.op3_toxicity(spark, d).collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{d}/labels.parquet'").fetchall()
    held = [(out[i]["predicted"], t) for i, t in labels if out[i]["held_out"]]
    wrong = [x for x in held if x[0] != x[1]]
    assert len(held) > 500 and len(wrong) <= 0.03 * len(held), (len(held), wrong)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_lexicon_as_brute_force(spark):
    """Entries and weights from plain counts over the training rows."""
    import math
    import zlib

    d = "/root/testdata/sf0.01"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{d}/documents.parquet'").fetchall())
    labels = [(i, t) for i, t in duckdb.sql(f"SELECT doc_id, toxic FROM '{d}/labels.parquet'").fetchall() if zlib.crc32(str(i).encode()) % 4 != 2]
    count, total = {}, [0, 0]
    for i, toxic in labels:
        total[toxic] += 1
        for gram in ops._grams(texts[i] or ""):
            count.setdefault(gram, [0, 0])[toxic] += 1
    weight = {g: math.log((t + 0.5) / (total[1] + 1)) - math.log((c + 0.5) / (total[0] + 1)) for g, (c, t) in count.items() if t >= ops.SUPPORT}
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    lexicon = ops.learn(docs, spark.read.parquet(f"{d}/labels.parquet"))
    fit = {g for g, w in weight.items() if w >= ops.RATIO}
    assert set(lexicon.weights) <= fit and fit and all(abs(w - weight[g]) < 1e-9 for g, w in lexicon.weights.items())
    kept, missed = ({g.removeprefix("^") for g in x} for x in (lexicon.weights, fit - set(lexicon.weights)))
    assert all(any(k.startswith(m) or m.startswith(k) for k in kept) for m in missed)


def test_held_out_labels_enter_no_choice(spark):
    import zlib

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{d}/labels.parquet").collect()]
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in rows]
    tables = [spark.createDataFrame(x, "doc_id long, toxic int") for x in (rows, other)]
    assert rows != other
    assert ops.cross_validated(docs, tables[0], [(2, 2.0)], 2) == ops.cross_validated(docs, tables[1], [(2, 2.0)], 2)
    assert ops.learn(docs, tables[0]) == ops.learn(docs, tables[1])
