import random

import pytest

from salesflow.llm import licenses as ops


def runs(templates):
    return {tuple(w[a:b]) for w in templates for a in range(len(w)) for b in range(a + 1, len(w) + 1)}


def statistics(words, known):
    """Longest known run that ends at each word, by trying all."""
    return [max((n for n in range(1, e + 1) if tuple(words[e - n:e]) in known), default=0) for e in range(1, len(words) + 1)]


@pytest.mark.parametrize("seed", range(30))
def test_matching_statistics_as_brute_force(seed):
    rng = random.Random(seed)
    letters = "abc"[: rng.choice([2, 3])]
    templates = {f"t{k}": ["".join(rng.choice(letters) + " " for _ in range(rng.randrange(1, 14)))] for k in range(4)}
    scanner = ops.Scanner(templates, {})
    words = [rng.choice(letters + "z").encode() for _ in range(60)]
    known = runs(scanner.words)
    expected = statistics(words, known)
    ends = [i for i, n in enumerate(expected) if n >= ops.LEAST and (i + 1 == len(words) or expected[i + 1] != n + 1)]
    _, _, matches = scanner.scan(b" ".join(words))
    assert [(i + 1 - expected[i], i + 1) for i in ends] == [(a, b) for a, b, _ in matches]
    for a, b, state in matches:
        assert scanner.automaton.ends[state] == {(t, e) for t, w in enumerate(scanner.words) for e in range(b - a, len(w) + 1) if w[e - (b - a):e] == words[a:b]}


def brute_base(text):
    words = ops.tokens((text or "").encode())
    out = [(i, label) for label, p in ops.BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.encode().split()]
    return len(words), sorted(out)


def test_labels_and_places(spark):
    texts = [None, "", "Released under the MIT License.", "foo Licensed under CC BY-NC 4.0. bar", "MIT-License mit license apache  LICENSE general public\nlicense",
             "Permission is hereby granted, free of charge, to any one person obtaining a copy of this software", "clean text of the people", "limit license", "ümit license", "x " * 300_000 + "general public license"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(4, texts[4], "clash"), (None, "mit license", "clash")]
    out = ops.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    for i, t in enumerate(texts):
        n, places = brute_base(t)
        starts = [s for s, _ in places]
        assert (by[i]["n_words"], by[i]["n_base"], by[i]["first_word"], by[i]["last_word"]) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert by[i]["base_labels"] == sorted({label for _, label in places})
    assert by[2]["labels"] == ["mit"] and by[2]["score"] == 1.0 and by[3]["labels"] == ["cc-by-nc"] and by[3]["base_labels"] == []
    assert by[5]["labels"] == ["mit"] and by[5]["spans"][0]["covered"] == 16 and by[6]["labels"] == [] and by[6]["score"] == 0.0
    assert ops.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_phrase_over_block_border(monkeypatch):
    monkeypatch.setattr(ops, "BLOCK_BYTES", 7)
    scanner = ops.Scanner(ops.TEMPLATES, ops.BASE)
    n, places, matches = scanner.scan(b"a bb General Public   License, released under the MIT License")
    assert (n, places) == (10, [(2, "gpl"), (8, "mit")]) and (5, 10) in [m[:2] for m in matches]


NOTICES = {
    "Licensed under CC BY-SA 4.0": ["cc-by-sa"], "Licensed under CC BY-NC-SA 4.0": ["cc-by-nc-sa"], "Licensed under CC BY 4.0": ["cc-by"], "Licensed under CC BY-XX 4.0": [],
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["cc-by-sa"],
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation": ["agpl"],
    "this project is licensed under the terms of our own proprietary agreement": [],
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that": ["isc"],
    "without any express or implied warranty. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely": ["zlib"],
    "We provide the software as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability": [],
}


@pytest.mark.parametrize("text", NOTICES)
def test_deciding_words(text):
    found = ops.default_scanner().report(text.encode())
    phrases = [label for label, phrase in ops.BASE.items() if phrase in text.lower()]
    assert found[5] == sorted({*NOTICES[text], *phrases}) and (found[6] > 0) == bool(NOTICES[text])


def test_every_template_names_its_label():
    scanner = ops.default_scanner()
    for label, texts in ops.TEMPLATES.items():
        for text in texts:
            n, _, _, _, base, labels, score, _ = scanner.report(text.encode())
            assert label in labels and set(labels) <= {label, *base} and score == 1.0
