import re

from pyspark.sql import functions as F

from salesflow.llm import url_rules as ops


def brute_listed(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in ops.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = ["http://A.example.ORG/es/1", "http://example.org/en/12?q", "http://example.org/en/2#x", "https://x.com/fr/a/b?p=1&r=2", "https://com/de/", "http://notcom/de/", "ftp://b.example.com", "no scheme", "", None,
        "http://h?x=/a/://z", "://only", "http://é.Com/DE/1", "http://a.com/de", "x\ny://q.com/fr/\n1", "http://xorg/", "http://example.org/en/1://www"]


def test_listed_rules_as_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS * 2)], "page_id long, url string, verdict string")
    out = ops.judged(pages, spark.createDataFrame([], "url string, blocked boolean")).collect()
    assert len(out) == 2 * len(URLS)
    for r in out:
        host, path, rule, verdict = brute_listed((URLS * 2)[r["page_id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")


def test_later_scheme_is_no_host(spark):
    urls = ["http://a.com?u=http://b.com/de/x", "http://a.com#http://b.com/de/x", "http://example.org?://y/es/", "://?://x/de/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r["page_id"]: r for r in ops.judged(pages, spark.createDataFrame([], "url string, blocked boolean")).collect()}
    for i, url in enumerate(urls):
        host, path, rule, verdict = brute_listed(url)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) == (host, path, rule, verdict or "allow") and path == ""


def test_mined_rules_match_as_brute_force(spark):
    rows = [(f"http://{'bad' if i % 3 == 0 else 'good'}.example.net/{'en' if i % 2 else 'de'}/{i}{'?ad=1' if i % 5 == 0 else ''}", i % 3 == 0 and i % 2 == 0 or i % 5 == 0) for i in range(400)]
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    rules = [(set(r["antecedent"]), r["confidence"], r["support"], r["anchor"]) for r in ops.mined_rules(labelled).collect()]
    sets = [(set(r["t"]), r["blocked"]) for r in labelled.select(ops.tokens_of(labelled["url"]).alias("t"), "blocked").collect()]
    base = sum(b for _, b in sets) / len(sets)
    assert rules
    for antecedent, confidence, support, anchor in rules:
        held = [b for t, b in sets if antecedent <= t]
        assert abs(confidence - sum(held) / len(held)) < 1e-9 and abs(support - sum(held) / len(sets)) < 1e-9 and anchor in antecedent
        assert confidence >= max(ops.CONFIDENCE, ops.LIFT * base) and support >= ops.SUPPORT
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)] + [(900, "http://other.example.net/xx/1"), (901, None)], "page_id long, url string")
    for r in ops.judged(pages, labelled).collect():
        has = sets[r["page_id"]][0] if r["page_id"] < 900 else {"host=other", "host=example", "host=net", "domain=example.net", "path=xx", "path=#"} if r["page_id"] == 900 else set()
        best = max((c for a, c, _, _ in rules if a <= has), default=None)
        assert (r["confidence"] is None) == (best is None) and (r["verdict"] == "block") == (best is not None)


def test_empty_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert ops.judged(none, spark.createDataFrame([("http://a.net/x", None)], "url string, blocked boolean")).collect() == []


def shared_names(n, names):
    """Urls of which some share query names; the shared ones are mostly blocked."""
    tail = "?" + "&".join(f"n{k:02d}=1" for k in range(names))
    return [(f"http://h{i % 7}.net/p{tail if i % 10 == 0 else ''}", i % 10 == 0 and i % 50 != 0 or i % 7 == 3) for i in range(n)]


def test_folding_gives_the_rules_of_all_subsets(spark):
    """All subsets of frequent tokens as rules, pruned by one token less, against the folded rules with each class's tokens put in."""
    from itertools import combinations, product

    labelled = spark.createDataFrame(shared_names(280, 3), "url string, blocked boolean")
    sets = [(frozenset(r["t"]), r["blocked"]) for r in labelled.select(ops.tokens_of(labelled["url"]).alias("t"), "blocked").collect()]
    base = sum(b for _, b in sets) / len(sets)
    counts = {}
    for t, b in sets:
        for k in range(1, len(t) + 1):
            for x in combinations(sorted(t), k):
                n, hit = counts.get(x, (0, 0))
                counts[x] = n + 1, hit + b
    sure = {x: hit / n for x, (n, hit) in counts.items() if hit >= ops.SUPPORT * len(sets) and hit / n >= max(ops.CONFIDENCE, ops.LIFT * base)}
    kept = {(x, round(c, 9)) for x, c in sure.items() if not any(sure.get(tuple(y for y in x if y != z), -1) >= c for z in x)}
    found = ops.mined_rules(labelled).collect()
    expanded = {(tuple(sorted(choice)), round(r["confidence"], 9)) for r in found for choice in product(*r["members"])}
    assert kept and expanded == kept and all(a in m for r in found for a, m in zip(r["antecedent"], r["members"]))


def test_many_names_that_stand_together(spark):
    """40 shared names have 2 ** 40 subsets; any one of them still names its pages."""
    rows = shared_names(600, 40)
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    assert ops.mined_rules(labelled).count() < 20
    pages = spark.createDataFrame([(1, "http://new.org/x?n17=5"), (2, "http://new.org/x?m17=5"), (3, rows[10][0]), (4, "http://new.net/" + "a/" * 50_000 + "?n39")], "page_id long, url string")
    out = {r["page_id"]: r["verdict"] for r in ops.judged(pages, labelled).collect()}
    assert out[2] == "allow" and out[3] == "block" and out[4] == "block"


def test_tokens_that_part_in_one_row_are_not_folded(spark):
    rows = [("http://a.net/x?p=1&q=1", True)] * 10 + [("http://a.net/x?p=1", True), ("http://b.net/y", False)] * 3
    tokens = spark.createDataFrame(rows, "url string, blocked boolean").select(ops.tokens_of(F.col("url")).alias("tokens"))
    classes = {r["token"]: r["one"] for r in ops.folded(tokens, 1).collect()}
    assert classes == {"host=a": "domain=a.net", "domain=a.net": "domain=a.net", "path=x": "domain=a.net", "query=p": "domain=a.net", "query=q": "query=q",
                       "host=net": "host=net", "host=b": "domain=b.net", "domain=b.net": "domain=b.net", "path=y": "domain=b.net"}
