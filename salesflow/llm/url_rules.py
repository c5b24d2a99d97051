"""URL verdicts: a rule list by host and path, and association rules mined by FP-growth.

DataFrame functions and Spark's FP-growth only. A list rule fits its host and all subdomains if the path starts with the rule's; the
longest rule wins. Pages without a fitting rule get the verdict of the mined rules: FP-growth finds frequent combinations of URL tokens and
the label token among labelled URLs. Tokens that stand in exactly the same URLs are folded into the least of them first, as otherwise every
subset of them would be mined; this loses nothing, since a rule holds alike for each token of such a class. Combinations that imply ``block`` with at least ``CONFIDENCE`` and ``LIFT`` over the base rate are
kept, and one that is implied by a smaller rule of no less confidence is pruned. Kept rules are indexed by their rarest token. URLs are reduced
to the tokens that occur in rules, equal reduced sets are matched once, and a set takes the rule of highest confidence. Without a
matching rule a page is allowed.

Tokens: labels of the host with their kind, the public suffix last; path segments with digits as ``#``; the file extension; query names.

Edge cases: very long urls and many tokens are read whole, and tokens too rare for any rule are left out before URLs are mined; a null url or one without ``://`` has empty host and path, no list rule and no token, and is allowed; labels that are null,
or of no page, train nothing; without block labels nothing is mined; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.shared import ascii_lower, stored

SUPPORT, CONFIDENCE, LIFT = 0.003, 0.5, 1.5
BLOCK_TOKEN = "label=block"
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty for null or no ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if the host is not followed by ``/``, whatever comes later."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A(?>.*?://)[^/?#]*+(/[^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule (most characters of host and path), else null; the list is tried longest first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens of a url; empty for null or no ``://``."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    tokens = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host="), x)),
        F.when(F.size(labels) > 1, F.array(F.concat(F.lit("domain="), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array().cast("array<string>")),
        F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path="), F.regexp_replace(ascii_lower(x), "[0-9]+", "#"))),
        F.transform(F.filter(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)"), 1), lambda x: x != ""), lambda x: F.concat(F.lit("query="), x)),
        F.when(F.coalesce(url, F.lit("")).contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(tokens)))


def folded(rows: DataFrame, least: float) -> DataFrame:
    """token, one: tokens in at least ``least`` of the ``items`` rows (``of`` them alike), and the least token that stands in exactly the same rows.

    Sums of two hashes of the rows' token sets propose the classes. A class of which some row holds a part only, as equal sums by chance
    would make, is not folded. There are at most as many tokens as stand in a row on average, over the share asked for.
    """
    sets = stored(rows.groupBy("tokens").agg(F.count(F.lit(1)).alias("of")).withColumn("set_key", F.sha2(F.array_join("tokens", "\n"), 256)), "sets")
    each = sets.select("set_key", "of", F.explode("tokens").alias("token"))
    added = lambda c: F.sum(c.cast("decimal(20,0)"))
    marks = each.groupBy("token").agg(F.sum("of").alias("n"), added(F.xxhash64("set_key")).alias("h"), added(F.xxhash64(F.lit(1), "set_key")).alias("g"))
    marks = stored(marks.where(F.col("n") >= least), "frequent")
    classes = marks.groupBy("n", "h", "g").agg(F.min("token").alias("one"), F.count(F.lit(1)).alias("members"))
    proposed = stored(marks.join(classes, ["n", "h", "g"]).select("token", "one", "members"), "proposed")
    several = proposed.where("members > 1")
    torn = each.join(several, "token").groupBy("set_key", "one").agg(F.count(F.lit(1)).alias("here"), F.first("members").alias("members"))
    torn = torn.where("here < members").select("one").distinct().withColumn("torn", F.lit(True))
    return stored(proposed.join(torn, "one", "left").select("token", F.when(F.col("torn"), F.col("token")).otherwise(F.col("one")).alias("one")), "folded")


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT) -> DataFrame:
    """antecedent (sorted tokens, each for its class), members (of each antecedent token the tokens of its class), confidence, support,
    anchor (rarest token) from (url, blocked) rows."""
    rows = labelled.where(F.col("blocked").isNotNull()).select(tokens_of(F.col("url")).alias("tokens"), "blocked").where(F.size("tokens") > 0)
    rows = stored(rows, "tokens")
    shape = "antecedent array<string>, members array<array<string>>, confidence double, support double, anchor string"
    if rows.where("blocked").isEmpty():
        return rows.sparkSession.createDataFrame([], shape)
    total = rows.count()
    base = rows.where("blocked").count() / total
    classes = folded(rows, support * total)
    # Each different set of tokens is reduced once.
    different = rows.select("tokens").distinct()
    reduced = different.select("tokens", F.explode("tokens").alias("token")).join(classes, "token").groupBy("tokens").agg(F.collect_set("one").alias("ones"))
    items = F.coalesce("ones", F.array().cast("array<string>"))
    rows = stored(rows.join(reduced, "tokens", "left").select(F.when(F.col("blocked"), F.array_append(items, F.lit(BLOCK_TOKEN))).otherwise(items).alias("items")), "labelled")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows)
    sets = stored(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    with_label = sets.where(F.array_contains("items", BLOCK_TOKEN) & (F.size("items") > 1)).select(F.array_remove("items", BLOCK_TOKEN).alias("antecedent"), F.col("freq").alias("both"))
    plain = sets.where(~F.array_contains("items", BLOCK_TOKEN)).select(F.col("items").alias("antecedent"), "freq")
    rules = with_label.join(plain, "antecedent").select("antecedent", (F.col("both") / F.col("freq")).alias("confidence"), (F.col("both") / F.lit(float(total))).alias("support"))
    strong = stored(rules.where((F.col("confidence") >= confidence) & (F.col("confidence") >= lift * base)), "strong")
    # A rule is superfluous if a rule with one token less is at least as sure.
    shorter = strong.select("antecedent", "confidence", F.explode("antecedent").alias("without")).select("antecedent", "confidence", F.array_remove("antecedent", F.col("without")).alias("part"))
    parts = strong.select(F.col("antecedent").alias("part"), F.col("confidence").alias("surer"))
    idle = shorter.join(parts, "part").where("surer >= confidence").select("antecedent").distinct()
    kept = strong.join(idle, "antecedent", "left_anti")
    single = plain.where(F.size("antecedent") == 1).select(F.col("antecedent")[0].alias("token"), "freq")
    alike = classes.groupBy(F.col("one").alias("token")).agg(F.array_sort(F.collect_list("token")).alias("alike"))
    anchored = kept.select("*", F.explode("antecedent").alias("token")).join(single, "token").join(alike, "token").groupBy("antecedent").agg(
        F.first("confidence").alias("confidence"), F.first("support").alias("support"), F.min(F.struct("freq", "token"))["token"].alias("anchor"),
        F.array_sort(F.collect_list(F.struct("token", "alike")))["alike"].alias("members"))
    return stored(anchored.select("antecedent", "members", "confidence", "support", "anchor"), "rules")


def judged(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """A row per page: page_id, host, path, rule (of the list, else null), verdict, confidence (of the mined rule that blocked it)."""
    mined = mined_rules(labelled)
    pairs = mined.select(F.explode(F.arrays_zip("antecedent", "members")).alias("x"))
    known = stored(pairs.select(F.col("x.antecedent").alias("one"), F.explode("x.members").alias("token")).distinct(), "tokens")
    url = F.col("url")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    faced = base.withColumn("listed", listed_rule(F.col("host"), F.col("path"), rules))
    # Different token sets among pages without a listed rule; each keeps the tokens that rules know, under the name of their class, and is matched through the index.
    sets = stored(faced.where("listed IS NULL").select("tokens").distinct().withColumn("set_key", F.sha2(F.array_join("tokens", "\n"), 256)), "token_sets")
    useful = sets.select("set_key", F.explode("tokens").alias("token")).join(known, "token").groupBy("set_key").agg(F.collect_set("one").alias("has"))
    found = useful.select("set_key", "has", F.explode("has").alias("anchor")).join(mined, "anchor").where(F.size(F.array_except("antecedent", "has")) == 0)
    best = stored(found.groupBy("set_key").agg(F.max("confidence").alias("confidence")), "matched")
    keyed = faced.withColumn("set_key", F.sha2(F.array_join("tokens", "\n"), 256)).drop("tokens")
    out = keyed.join(best, "set_key", "left")
    confidence = F.when(F.col("listed").isNull(), F.col("confidence"))
    verdict = F.coalesce(F.col("listed.verdict"), F.when(confidence.isNotNull(), F.lit("block")), F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"), confidence.alias("confidence"))


def labelled_pages(spark: SparkSession, pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url, blocked: labelled bad (quality 0 or toxic 1) by the label of the page's id."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    known = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(F.max(bad).alias("blocked"))
    return pages.join(known, pages["page_id"] == known["doc_id"]).select("url", "blocked")
