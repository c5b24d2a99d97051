import base64
import gzip
import hashlib
import random

import duckdb

from salesflow.llm import warc as ops

SCHEMA = "page_id long, url string, html string, record string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(pages):
    first = {}
    for i, _, t, *_ in pages:
        first[t or ""] = min(i, first.get(t or "", i))
    return sorted((i, len((t or "").encode()), digest(t), "response" if first[t or ""] == i else "revisit", None if first[t or ""] == i else first[t or ""]) for i, _, t, *_ in pages)


def test_round_trip(spark):
    texts = ["<p>é ü</p>", None, "", "WARC/1.1\r\nWARC-Type: fake\r\n\r\n", "a\r\n\r\nb", "x" * 300_000, "\x1f\x8b\x08 zip", "<p>é ü</p>", "tail\r\n"]
    pages = [(3 * i + 1, f"http://h/{i}\r\nX: y" if i % 2 else None, t, "clash") for i, t in enumerate(texts)]
    out = ops.archived(spark.createDataFrame(pages, SCHEMA)).collect()
    assert sorted((tuple(r) for r in out)) == expected(pages)
    assert ops.archived(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_urls(spark):
    pages = [(1, "http://h/" + "u" * 100_000, "same", ""), (2, "http://h/2", "same", ""), (3, "http://h/" + "é" * 500_000, "other", "")]
    assert sorted(tuple(r) for r in ops.archived(spark.createDataFrame(pages, SCHEMA)).collect()) == expected(pages)


def test_header_without_end():
    parts = [record(1, b"one", b"X: " + b"y" * 200_000 + b"\r\n"), record(2, b"two")]
    assert read(b"".join(parts)) == (list("12"), [])
    assert read(parts[0] + b"WARC/1.0\r\nX: " + b"y" * 100_000) == (["1"], [(len(parts[0]), 100_013, "header without end")])
    assert read(b"WARC/1.0\r\nX: " + b"y" * 100_000 + b"\r\n" + parts[1]) == (["2"], [(0, 100_015, "malformed header")])


def test_null_and_repeated_ids(spark):
    pages = [(None, "u", "same", ""), (None, "u", "lone", ""), (4, "u", "same", ""), (4, "u", "same", ""), (9, "u", "same", "")]
    out = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in ops.archived(spark.createDataFrame(pages, SCHEMA)).collect())
    assert out == [(0, "response", None, 4), (0, "revisit", 4, 4), (4, "response", None, 4), (4, "response", None, 4), (9, "revisit", 4, 4)]


def record(i, payload, extra=b""):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    named = base64.b32encode(hashlib.sha1(payload).digest())
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Type: application/http\r\nWARC-Payload-Digest: sha1:%s\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, named, extra, len(block), block)


def read(data):
    found = list(ops.salvage(data))
    return [x.headers["warc-record-id"][10:-1] for x in found if isinstance(x, ops.Record)], [x for x in found if not isinstance(x, ops.Record)]


def test_salvage_after_damage():
    parts = [record(i, b"payload %d " % i * 9) for i in range(6)]
    whole = b"".join(parts)
    assert read(whole) == (list("012345"), [])
    bad = bytearray(whole)
    bad[len(parts[0]) + len(parts[1]) - 10] ^= 1  # a payload byte of record 1
    bad[sum(map(len, parts[:4])) + 2] ^= 1  # the version line of record 4
    ids, gaps = read(bytes(bad))
    assert ids == list("0235") and gaps == [(len(parts[0]), len(parts[1]), "wrong digest"), (sum(map(len, parts[:4])), len(parts[4]), "no version line")]
    assert read(whole[:-7])[0] == list("01234") and read(whole[:-7])[1][0][2] == "truncated"
    assert read(b"junk" + whole[5:])[0] == list("12345")
    assert read(whole.replace(b"Content-Length: ", b"Content-Length: 1", 1))[0] == list("12345")


def test_salvage_of_gzip_members():
    parts = [gzip.compress(record(i, bytes(random.Random(i).randrange(256) for _ in range(500)))) for i in range(5)]
    assert read(b"".join(parts)) == (list("01234"), [])
    bad = bytearray(b"".join(parts))
    bad[len(parts[0]) + 60] ^= 255
    ids, gaps = read(bytes(bad))
    assert ids == list("0234") and [g[:2] for g in gaps] == [(len(parts[0]), len(parts[1]))]


def test_random_damage_accounts_for_every_byte():
    parts = [record(i, b"p%d" % i * 30) if i % 2 else gzip.compress(record(i, b"p%d" % i * 30)) for i in range(12)]
    whole = b"".join(parts)
    for seed in range(40):
        rng, bad = random.Random(seed), bytearray(whole)
        for _ in range(3):
            bad[rng.randrange(len(bad))] ^= 1 + rng.randrange(255)
        found = [(x.offset, x.length) if isinstance(x, ops.Record) else x[:2] for x in ops.salvage(bytes(bad))]
        assert [a for a, _ in found] == [0, *[a + n for a, n in found][:-1]] and sum(n for _, n in found) == len(bad)
        assert sum(isinstance(x, ops.Record) for x in ops.salvage(bytes(bad))) >= 9


def test_gaps_are_rows(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(1, b"one") + b"noise" + record(2, b"two"))
    (tmp_path / "b.warc").write_bytes(b"")
    out = ops.read_archives(spark, str(tmp_path)).orderBy("offset").collect()
    assert [(r["kind"], r["reason"], r["payload"] and bytes(r["payload"])) for r in out] == [("record", None, b"one"), ("gap", "no version line", None), ("record", None, b"two")]


def test_query_on_small_tables(spark):
    from salesflow.llm import queries

    d = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{d}/pages.parquet'").fetchall()
    assert sorted(tuple(r) for r in queries.op6_warc(spark, d).collect()) == expected(rows)


def plain(data):
    return [bytes(x.payload) for x in ops.salvage(data) if isinstance(x, ops.Record)]


def covered(data):
    spans = [(x.offset, x.length) if isinstance(x, ops.Record) else x[:2] for x in ops.salvage(data)]
    return [a for a, _ in spans] == [0, *[a + n for a, n in spans][:-1]] and sum(n for _, n in spans) == len(data)


def test_members_of_many_records():
    parts = [record(i, b"payload %d " % i * 40) for i in range(5)]
    whole = b"".join(parts)
    packed = gzip.compress(whole)
    rows = list(ops.salvage(packed + parts[0] + packed))
    assert [x.headers["warc-record-id"][10:-1] for x in rows] == list("01234") + ["0"] + list("01234") and covered(packed + parts[0] + packed)
    assert [(x.offset, x.length, x.inner_offset, x.inner_length) for x in rows[:6]] == [
        *[(0, len(packed) if i == 4 else 0, sum(map(len, parts[:i])), len(parts[i])) for i in range(5)], (len(packed), len(parts[0]), None, None)]
    noisy = gzip.compress(parts[0] + b"noise" + parts[1] + whole.replace(b"payload 3", b"payload X", 1) + b"rest")
    ids, gaps = read(noisy)
    assert ids == list("0101") + list("24") and [g[2] for g in gaps] == ["no version line", "wrong digest", "no version line"] and covered(noisy)
    assert [g[3:] for g in gaps] == [(len(parts[0]), 5), (len(parts[0]) + 5 + len(parts[1]) + sum(map(len, parts[:3])), len(parts[3])), (len(parts[0]) + 5 + len(parts[1]) + len(whole), 4)]
    assert read(gzip.compress(b"") + packed)[0] == list("01234") and read(gzip.compress(b""))[1][0][2] == "empty member"
    assert read(gzip.compress(b"text") + packed)[0] == list("01234") and covered(gzip.compress(b"text") + packed)


def test_truncated_and_broken_members():
    rng = random.Random(1)
    parts = [record(i, rng.randbytes(700)) for i in range(500)]
    for level in (0, 6):
        packed = gzip.compress(b"".join(parts), level)
        cut = packed[:len(packed) // 2]
        ids, gaps = read(cut)
        assert ids == [str(i) for i in range(len(ids))] and 240 <= len(ids) <= 250 and gaps == [(0, len(cut), "truncated member")]
        other = [record(1000 + i, rng.randbytes(700)) for i in range(50)]
        lost_bytes = cut + gzip.compress(b"".join(other), level)  # the decoder runs on into the next member
        found = read(lost_bytes)[0]
        assert found[:len(ids)] == ids and sorted(found[len(ids):]) == [str(1000 + i) for i in range(50)] and covered(lost_bytes)
        bad = bytearray(packed)
        bad[-6] ^= 1  # the check sum
        ids, gaps = read(bytes(bad) + parts[0])
        assert ids[:500] == [str(i) for i in range(500)] and ids[-1] == "0" and {g[2] for g in gaps} == {"broken member"} and covered(bytes(bad) + parts[0])
        assert len(ids) == 501 or not level  # where the border of an uncompressed block changes a header, a record comes twice


def test_large_members_are_held_in_pieces():
    import tracemalloc

    small = record(1, b"a" * 1000)
    packed = gzip.compress(small * 60_000)  # 70 MB inflated
    tracemalloc.start()
    assert sum(isinstance(x, ops.Record) for x in ops.salvage(packed)) == 60_000
    assert tracemalloc.get_traced_memory()[1] < 24 << 20
    tracemalloc.stop()
    big = record(2, b"b" * 5_000_000)
    assert [len(x) for x in plain(gzip.compress(small + big + small))] == [1000, 5_000_000, 1000]
    claims = small.replace(b"Content-Length: ", b"Content-Length: 99999", 1)
    assert read(gzip.compress(claims + small + claims + big))[0] == ["1", "2"] and read(claims + small)[0] == ["1"]


def test_records_across_pieces():
    rng = random.Random(3)
    parts = [record(i, rng.randbytes(rng.choice([0, 10, 70_000, ops.PIECE - 300, ops.PIECE + 1]))) for i in range(40)]
    noise = [b"z" * rng.choice([0, 0, 3, ops.PIECE]) for _ in parts]
    ids, gaps = read(gzip.compress(b"".join(n + p for n, p in zip(noise, parts)), 1))
    assert ids == [str(i) for i in range(40)] and sum(g[4] for g in gaps) == sum(map(len, noise))


def test_random_damage_to_members_of_many_records():
    parts = [record(i, random.Random(i).randbytes(300)) for i in range(30)]
    whole = b"".join(gzip.compress(b"".join(parts[at:at + 10])) for at in range(0, 30, 10))
    for seed in range(30):
        rng, bad = random.Random(seed), bytearray(whole)
        bad[rng.randrange(len(bad))] ^= 1 + rng.randrange(255)
        found = plain(bytes(bad))
        assert covered(bytes(bad)) and len(found) >= 19 and len(set(found)) == len(found)
        assert set(found) <= {random.Random(i).randbytes(300) for i in range(30)}


def test_sizes_do_not_swell_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ops, "ARCHIVE_BYTES", 200_000)
    pages = [(i, "http://h", ("x%d " % i) * (50 if i % 20 else 40_000), "") for i in range(300)]
    frame = spark.createDataFrame(pages, SCHEMA).coalesce(1)
    assert ops.write_archives(frame, str(tmp_path / "w")) == 300
    sizes = [f.stat().st_size for f in (tmp_path / "w").rglob("part-*")]
    assert max(sizes) <= 2 * 200_000 and ops.read_archives(spark, str(tmp_path / "w")).where("kind = 'record'").count() == 300
