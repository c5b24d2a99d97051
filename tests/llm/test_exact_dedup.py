import hashlib
import random

from salesflow.llm import exact_dedup as ops

SCHEMA = "doc_id long, text string, kept string"


def brute(rows):
    plain = [(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for i, t, *_ in rows]
    out = []
    for i, t in plain:
        same = [j for j, u in plain if u == t]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_as_brute_force(spark):
    long = " ".join(f"w{k % 977}" for k in range(60_000))
    texts = [None, "", " ", "Same Text", "same text", "SAME tExt", "ÄB", "äB", "Äb", long, long.upper(), long[:-1], "x" * 100_000, "x" * 100_001, "x" * 100_000]
    rows = [(7 * i, t, "clash") for i, t in enumerate(texts)] + [(21, "Same Text", "clash"), (None, "none", "c"), (None, "none", "c"), (None, "same text", "c")]
    out = ops.exact_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, out), key=str) == brute(rows)
    assert ops.exact_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_chunks_make_up_the_text_and_follow_the_content():
    rng = random.Random(4)
    data = bytes(rng.randrange(97, 123) for _ in range(3_000_000))
    cut = ops.chunks(data)
    assert b"".join(cut) == data and all(ops.SMALLEST <= len(c) <= ops.LARGEST for c in cut[:-1])
    shifted = ops.chunks(b"inserted" + data)
    assert len(set(cut) & set(shifted)) > 0.95 * len(set(cut))
    assert ops.chunks(b"") == [] and ops.chunks(b"ab") == [b"ab"]


def test_clashing_digests_are_made_anew(spark, monkeypatch):
    """A digest of one byte clashes; the next key's digests are whole."""
    monkeypatch.setattr(ops, "_digest", lambda chunk, key: hashlib.blake2b(chunk, digest_size=16, key=key).digest()[: 1 if key.endswith(b"0") else 16])
    rows = [(i, f"text {i % 700}", "") for i in range(1400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert not ops._clashes(docs.select("doc_id", "text"), b"chunk recipe 0").isEmpty()
    out = ops.exact_groups(docs).collect()
    assert all(r["keep_id"] == r["doc_id"] % 700 + 700 and r["group_size"] == 2 for r in out) and len(out) == 1400


def test_stage_keeps_columns(spark):
    rows = [(1, "a", "x"), (2, "A", "y"), (None, "q", "z"), (None, "q", "z")]
    out = ops.drop_copies(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "kept"] and sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "None", "None"]


def test_stage_tells_rows_apart_by_id_and_text(spark):
    rows = [(5, "x", "a"), (5, "y", "a"), (9, "x", "a"), (7, "z", "a"), (7, "z", "a"), (None, "y", "a"), (3, "w", "a"), (3, "W", "b"), (None, "v", "a")]
    out = ops.drop_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r["doc_id"], r["text"].lower()) for r in out), key=str) == [(3, "w"), (5, "y"), (7, "z"), (9, "x"), (None, "v")]
