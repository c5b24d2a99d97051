"""Boundaries, merging and decoding against the tokenizer library."""

import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from salesflow.llm import bpe, pretokens

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "é", "你", "1", "²", "!", "…", " ", "　", "x", "<|endoftext|>", "𝔸", "'ll", "l", "r"]


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return bpe.read_ranks(file.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_texts(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choice(PIECES) for _ in range(draw.choice([0, 1, 2, 3, 5, 20, 120]))) for _ in range(n)]


@pytest.mark.parametrize("block, columns", [(1 << 18, 256), (64, 8), (5, 3)])
def test_boundaries_are_those_of_the_pattern(block, columns, monkeypatch):
    monkeypatch.setattr(pretokens, "BLOCK_BYTES", block)
    monkeypatch.setattr(pretokens, "COLUMNS", columns)
    texts = [t for t in some_texts(block, 300) if t]
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(t) for t in data])
    got = pretokens.boundaries(b"".join(data), ends - [len(t) for t in data]).tolist()
    want, at = [], 0
    for text in texts:
        for word in regex.findall(public_tokenizers.PATTERN, text):
            want.append(at)
            at += len(word.encode())
    assert got == want


def test_ids_and_bytes_are_those_of_the_library(ranks, library):
    codec = bpe.Codec(ranks)
    for seed in range(150):
        texts = some_texts(seed, 4)
        ids, bounds = codec.encode([t.encode() for t in texts])
        for k, text in enumerate(texts):
            own = ids[bounds[k]:bounds[k + 1]]
            assert own.tolist() == library.encode_ordinary(text)
            assert codec.decode(own) == text.encode()
            starts = codec.starts(own)
            assert [text.encode()[a:b] for a, b in zip(starts, [*starts[1:], len(text.encode())])] == [codec.decode(own[i:i + 1]) for i in range(len(own))]


def test_long_words_and_a_full_memory(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    codec = bpe.Codec(ranks)
    draw = random.Random(1)
    words = ["".join(draw.choice("abcdeinrst") for _ in range(n)) for n in (47, 48, 49, 200, 5000)] + ["a" * 3000]
    for word in words + words:
        assert codec.encode([word.encode()])[0].tolist() == library.encode_ordinary(word)
        assert len(codec.known) <= 20


def test_a_vocabulary_of_single_bytes():
    codec = bpe.Codec({bytes([b]): b for b in range(256)})
    assert codec.encode(["ab é".encode(), b"", b"c"])[0].tolist() == [97, 98, 32, 0xC3, 0xA9, 99]


def test_rows_of_every_kind(spark, library):
    long = "one two's  three\n" * 20000
    rows = [(1, "Hello world's  end"), (2, None), (3, ""), (3, "again"), (None, "again"), (4, long), (1, "Hello world's  end")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id int, text string, ids int, starts string").repartition(3)
    found = bpe.encoded(docs, PATH).collect()
    want = sorted((i if i is not None else -1, tuple(library.encode_ordinary(t or ""))) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, tuple(r.ids)) for r in found) == want
    assert all(len(r.ids) == len(r.starts) for r in found)
    back = bpe.decoded(bpe.encoded(docs, PATH), PATH).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((t or "").encode() for _, t in rows)
    assert bpe.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first().bytes == b""
    assert bpe.encoded(docs.limit(0), PATH).count() == 0
