"""Galloping intersection, groups and corpus counts against plain loops over the tokenizer libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from salesflow.llm import align

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
PIECES = ["'", "s", "re", "ll", " ", "  ", "\n", "\t", "a", "é", "你", "1", "²", "!", "…", " ", "　", "\x00", "<|endoftext|>", "<s>", "<0x41>", "𝔸", "▁", "the", " and", "ing", "́", "ﬁ", "à", " "]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


@pytest.fixture(scope="module")
def pair():
    return align.Pair(*(open(p, "rb").read() for p in PATHS))


def expected(text, libraries, pair):
    """Ids of both, ends of both, and the groups as text; None without tokens."""
    a, b = libraries[0].encode(" " + (text or ""), add_special_tokens=False).ids, libraries[1].encode(text or "")
    bytes_a, bytes_b = [pair.a.tokens[i] for i in a], [pair.b.tokens[i] for i in b]
    if not text or not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
        return None
    ends_a, ends_b = (list(np.cumsum(list(map(len, x)))) for x in (bytes_a, bytes_b))
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        i2, j2 = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((a[i:i2], b[j:j2]))
        i, j = i2, j2
    return a, b, ends_a, ends_b, groups


def shown(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def test_gallop_counts_smaller_values():
    draw = random.Random(2)
    for _ in range(300):
        short, long = (sorted(draw.sample(range(400), draw.randrange(n))) for n in (40, 300))
        assert align.gallop(short, long) == [sum(x < v for x in long) for v in short]
        a, b = align.common(np.array(short, int), np.array(long, int))
        assert [(short[i], long[j]) for i, j in zip(a, b)] == [(v, v) for v in sorted(set(short) & set(long))]
        b, a = align.common(np.array(long, int), np.array(short, int))
        assert [(short[i], long[j]) for i, j in zip(a, b)] == [(v, v) for v in sorted(set(short) & set(long))]


def test_tokens_groups_and_overlaps(libraries, pair):
    draw = random.Random(4)
    for _ in range(250):
        texts = ["".join(draw.choice(PIECES) for _ in range(draw.choice([0, 1, 2, 5, 20, 60]))) for _ in range(draw.choice([1, 3]))]
        for text, (ids_a, ids_b) in zip(texts, pair.tokens([t.encode() for t in texts])):
            want = expected(text, libraries, pair)
            assert (ids_a.tolist(), ids_b.tolist()) == (want[:2] if want else ([], []))
            if not want:
                continue
            _, _, ends_a, ends_b, groups = want
            last_a, last_b = pair.aligned(ids_a, ids_b)
            assert pair.written(ids_a, ids_b, last_a, last_b).decode() == shown(groups)
            first, last = align.overlaps(np.array(ends_a), np.array(ends_b))
            for i, end in enumerate(ends_a):
                met = [j for j in range(len(ends_b)) if ([0, *ends_b][j]) < end and ends_b[j] > [0, *ends_a][i]]
                assert (met[0], met[-1]) == (first[i], last[i])


def test_report_over_rows_of_every_kind(spark, libraries, pair):
    texts = ["the cat and the hat", "the cat", "the cat", None, "", "a▁b", "naïve café  à la\tcarte", " ", "x" * 3000, "the thing's <s> 12 " * 3000]
    rows = [(i if i != 6 else None, t, "z", 5) for i, t in enumerate(texts)] + [(1, "the cat", "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, pair string, row int").repartition(3)
    counted, found = Counter(), []
    for identifier, text, *_ in rows:
        want = expected(text, libraries, pair)
        groups = want[4] if want else []
        counted.update((x[-1], y[-1]) for x, y in groups)
        found.append((identifier, want, groups))
    highest = {}
    for (_, b), n in counted.items():
        highest[b] = max(n, highest.get(b, 0))
    want = []
    for identifier, tokens, groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        digest = hashlib.sha256(shown(groups).encode()).hexdigest() if tokens else ""
        want.append((identifier, len(tokens[0]) if tokens else 0, len(tokens[1]) if tokens else 0, len(groups), len(links),
                     sum(counted[x] == highest[x[1]] for x in links), sum(counted[x] for x in links), digest))
    got = [tuple(r) for r in align.link_report(docs, *PATHS).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    general = {r.doc_id: r for r in align.alignments(docs, *PATHS).collect()}
    assert general[0].a_ends[-1] == len(general[0].a_ids) and len(general[0].b_from) == len(general[0].a_ids) and general[3].a_ids == []
    assert align.link_report(docs.limit(0), *PATHS).count() == 0
