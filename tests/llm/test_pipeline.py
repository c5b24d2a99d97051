import duckdb

import corpus_pipeline
from salesflow.llm import toxicity
from salesflow.llm.oracle import OP8
from salesflow.llm.shared import stored
from test_decontaminate import brute as leaks
from test_minhash import brute as near

D = "/root/testdata/sf0.001"


def test_stages_as_brute_force(spark):
    """Each stage on its own input: the same documents stay as by brute force; the mix as by SQL."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns, benchmark = docs.columns, duckdb.sql(f"SELECT item_id, text FROM '{D}/benchmark.parquet'").fetchall()
    rows = {r["doc_id"]: r for r in docs.collect()}
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{D}/labels.parquet"))

    def exact(left):
        last = {}
        for i, r in sorted(left.items()):
            last["".join(c.lower() if c.isascii() else c for c in r["text"] or "")] = i
        return set(last.values())

    expected = [
        lambda left: {i for i, r in left.items() if lexicon.score(r["text"]) < toxicity.THRESHOLD},
        exact,
        lambda left: {i for i, _, _, kept in near([(i, r["text"]) for i, r in left.items()], 5, 80) if kept},
        lambda left: {i for i, items in leaks([(i, r["text"]) for i, r in left.items()], benchmark).items() if not items},
    ]
    for (name, stage), kept in zip(corpus_pipeline.STAGES, expected):
        docs = stored(stage(spark, docs, D), name)
        assert docs.columns == columns, name
        stay = kept(rows)
        assert {r["doc_id"] for r in docs.collect()} == stay, name
        rows = {i: r for i, r in rows.items() if i in stay}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, D)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, r["text"], r["source"]) for i, r in rows.items()])
    taken = {i: t // s for i, s, _, _, t in con.execute(OP8).fetchall() if t}
    out = {r["doc_id"]: r["copies"] for r in mixed.collect()}
    assert mixed.columns == [*columns, "copies"] and {i: c for i, c in out.items() if rows[i]["text"].split()} == taken


def test_nulls_clashes_and_empty_table(spark, tmp_path):
    rows = [(1, None, None, None, None, "x"), (None, "a b c d e f", "en", "s", 3, "x"), (2, "a b c d e f", "en", "s", 3, "x"), (2, "a b c d e f", "en", "s", 3, "x"), (3, "A b c d e f", "en", None, 3, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    for part, given in (("some", rows), ("none", [])):
        d = str(tmp_path / part)
        spark.createDataFrame(given, schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        out = corpus_pipeline.run(spark, d)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept", "copies"]
        found = out.collect()
        assert bool(found) == bool(given) and {r["doc_id"] for r in found} <= {1, None, 2, 3}


def test_entry_point_without_the_text_operators(tmp_path):
    """The other queries are there when both folders and the pipeline file are gone."""
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(corpus_pipeline.__file__).parent
    for name in ("parity", "salesflow"):
        for source in (root / name).rglob("*.py"):
            if "llm" not in source.relative_to(root).parts:
                target = tmp_path / source.relative_to(root)
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_bytes(source.read_bytes())
    (tmp_path / "__spark_entry__.py").write_bytes((root / "__spark_entry__.py").read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and set(e.oracle_sql()) <= set(q) and not [x for x in q if x.startswith('op')]"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}).returncode == 0
