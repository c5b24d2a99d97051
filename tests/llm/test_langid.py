import duckdb
import numpy as np
import pytest

from salesflow.llm import langid as ops

PIECES = ["a", "ab", "b", "ba", "bab", ops._MARK, ops._MARK + "a", "c"]


def brute(word, chance):
    """Sum over all segmentations, by recursion."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        p = chance.get(word[:k], ops.UNKNOWN if k == 1 else 0.0)
        total += p * brute(word[k:], chance)
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    model = np.vstack((rng.random((len(PIECES), 3)), np.zeros((1, 3))))
    words = [ops._MARK + w for w in ("abab", "a", "babab", "zab", "cz", "aaab", "babc")]
    found = ops.log_likelihoods(ops.Pieces(PIECES), model, words)
    for w, row in zip(words, found):
        for k in range(3):
            assert row[k] == pytest.approx(np.log(brute(w, dict(zip(PIECES, model[:, k])))))


def plain_log(word, chance):
    """The forward algorithm in logarithms, letter by letter."""
    values = [0.0]
    for j in range(1, len(word) + 1):
        terms = [values[i] + np.log(chance.get(word[i:j], ops.UNKNOWN if j - i == 1 else 0.0)) for i in range(max(0, j - 3), j) if chance.get(word[i:j]) or j - i == 1]
        values.append(np.logaddexp.reduce(terms))
    return values[-1]


def test_long_words_keep_their_evidence(monkeypatch):
    model = np.vstack((np.random.default_rng(3).random((len(PIECES), 2)) / 1000, np.zeros((1, 2))))
    words = [ops._MARK + w for w in ("z" * 44 + "aaa", "z" * 30 + "aaa", "z" * 4000 + "ab", "abcz" * 300, "ba" * 5)]
    for letters in (ops.GROUP_LETTERS, 7):
        monkeypatch.setattr(ops, "GROUP_LETTERS", letters)
        found = ops.log_likelihoods(ops.Pieces(PIECES), model, words)
        for w, row in zip(words, found):
            for k in range(2):
                assert row[k] == pytest.approx(plain_log(w, dict(zip(PIECES, model[:, k]))), rel=1e-9)
        assert found[0, 0] - found[0, 1] == pytest.approx(found[1, 0] - found[1, 1])


def test_expected_counts_by_differentiation():
    model = np.vstack((np.random.default_rng(2).random((len(PIECES), 2)), np.zeros((1, 2))))
    words, counts = [ops._MARK + "abab", ops._MARK + "bac"], np.array([[2.0, 1.0], [3.0, 0.0]])
    found = ops.expected_counts(ops.Pieces(PIECES), model, words, counts)
    for piece in range(len(PIECES)):
        raised = model.copy()
        raised[piece] *= 1 + 1e-6
        gain = ((ops.log_likelihoods(ops.Pieces(PIECES), raised, words) - ops.log_likelihoods(ops.Pieces(PIECES), model, words)) * counts).sum(axis=0) / 1e-6
        assert found[piece] == pytest.approx(gain, abs=1e-4)


def test_edges(spark):
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate([
        ("the cat and the dog", "en"), ("the house of the king", "en"), ("der hund und die katze", "de"), ("das haus und der baum", "de")] * 4)]
    rows += [(100, None, "en", "x"), (101, "123 _ !", "en", "x"), (102, "", None, "x"), (103, "the " * 400_000, None, "x"), (104, "z" * 5000, None, "x"), (None, "the dog", "en", "x"), (103, "the " * 400_000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = ops.identified(docs).collect()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert len(out) == len(rows) and by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[103] == ("en", pytest.approx(1.0)) and by[None][0] == "en" and by[104][0] in ("de", "en")
    assert ops.identified(docs.where("false")).collect() == []
    none = ops.identified(docs.withColumn("lang", docs["lang"].substr(1, 0)).selectExpr("doc_id", "text", "cast(null AS string) AS lang"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_held_out_accuracy(spark):
    from salesflow.llm import queries

    d = "/root/testdata/sf0.01"
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{d}/documents.parquet'").fetchall())
    out = queries.op2_language(spark, d).collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(truth) and len(held) > 100
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
