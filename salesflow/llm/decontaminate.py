"""Benchmark decontamination: SimHash of item-sized windows, found by multi-index Hamming blocks and verified by weighted shingles.

DataFrame functions only. Words are runs of ASCII letters, digits and non-ASCII characters, lowered. Every window that can pass the
verification shares a shingle with an item, so windows are laid where a document has a shingle of an item: as long as the item, aligned by
the shingle's place in it. Their 64-bit SimHash, over weighted shingles that some item holds, is looked up among the items' by
``RADIUS + 1`` blocks: two fingerprints within ``RADIUS`` bits agree on a block at least (pigeonhole), so none within the radius is missed.
A found pair is verified exactly: the weight of the item's shingles that the window holds, against the weight of all the item's shingles,
must reach ``PERCENT``. A shingle weighs 1 + ln(items / items that hold it), so that phrases of many items count less.

A fingerprint weighs its shingles by their squares, so a window that lacks a few heavy shingles can pass the verification outside the
radius. Such pairs come from an index of each item's leading shingles: the heaviest ones that together weigh more than 100 - ``PERCENT``
percent. A window without any of them cannot pass, so no pair is missed.

Shingle places of the benchmark are counted first: up to ``BROADCAST_ROWS`` (about 30 MB) they are sent to all tasks and windows are cut while
a text is read; beyond, narrow shingle rows are shuffled by key and only texts with a hit are read again.

Edge cases: a null or wordless text is clean; null and wordless items match nothing; an item shorter than ``WORDS`` words is one shingle of
its own length; repeated items are folded to the least item_id, which stands in ``item_ids``; an empty benchmark leaves all documents
clean; rows with one ``doc_id`` count as one document; a row without ``doc_id`` is judged alone only in so far as all rows without one share
their verdict. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.shared import stored

WORDS, PERCENT, RADIUS, BITS = 5, 80, 20, 64
BROADCAST_ROWS = 500_000
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, lowered; empty strings at its borders are cut off by ``_trimmed`` bounds of the pattern."""
    return F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"^{SEPARATORS}|{SEPARATORS}\\z", ""), SEPARATORS)


def _shingle(words: Column, at: Column, length: int) -> Column:
    """Hash of the ``length`` words from ``at`` (from 0)."""
    return F.xxhash64(F.lit(length), *[F.get(words, at + k) for k in range(length)])


def _item_shingles(benchmark: DataFrame) -> DataFrame:
    """item_id, n_words, length, at, shingle: every shingle of every distinct item with its place."""
    worded = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("words"))
    worded = worded.where("words[0] <> ''").groupBy("words").agg(F.min("item_id").alias("item_id")).withColumn("n_words", F.size("words"))
    long = worded.where(F.col("n_words") >= WORDS).select("item_id", "n_words", F.lit(WORDS).alias("length"), "words", F.posexplode("words").alias("at", "word"))
    parts = long.where(f"at <= n_words - {WORDS}").select("item_id", "n_words", "length", "at", _shingle(F.col("words"), F.col("at"), WORDS).alias("shingle"))
    for n in range(1, WORDS):
        few = worded.where(F.col("n_words") == n)
        parts = parts.union(few.select("item_id", "n_words", F.lit(n).alias("length"), F.lit(0).alias("at"), _shingle(F.col("words"), F.lit(0), n).alias("shingle")))
    return parts


def _simhash(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fingerprint`` of rows (keys, shingle, weight)."""
    signed = [F.sum(F.when(F.shiftrightunsigned("shingle", b).bitwiseAND(F.lit(1)) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"s{b}") for b in range(BITS)]
    bits = None
    for b in range(BITS):
        bit = F.when(F.col(f"s{b}") > 0, F.lit((1 << b) if b < 63 else -(1 << 63))).otherwise(F.lit(0).cast("long"))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return weighted.groupBy(*keys).agg(*signed).select(*keys, bits.alias("fingerprint"))


def _blocks(fingerprint: Column) -> Column:
    """(number, bits) of RADIUS + 1 blocks that together cover all bits."""
    edges = [BITS * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    return F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits")) for k, (a, b) in enumerate(zip(edges, edges[1:]))])


def _windows_in_place(worded: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """Windows (doc_id, n_words, length, window) around shingles of items, cut while the text is read; ``places`` is small enough to send."""
    placed = worded.select("doc_id", "words", F.posexplode("words").alias("pos", "word"))
    keyed = placed.select("doc_id", "words", "pos", _shingle(F.col("words"), F.col("pos"), length).alias("hash"))
    hits = keyed.join(F.broadcast(places), "hash")
    return hits.select("doc_id", "n_words", F.lit(length).alias("length"), F.slice("words", F.greatest(F.lit(0), F.col("pos") - F.col("at")) + 1, F.col("n_words")).alias("window"))


def _windows_by_key(worded: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """The same for a benchmark of any size: narrow shingle rows meet ``places`` by key, then the windows are cut from the texts that have any."""
    placed = worded.select("doc_id", F.posexplode(F.transform("words", lambda w, i: _shingle(F.col("words"), i, length))).alias("pos", "hash"))
    begins = placed.join(places, "hash").select("doc_id", "n_words", F.greatest(F.lit(0), F.col("pos") - F.col("at")).alias("begin")).distinct()
    hits = stored(begins.withColumnRenamed("doc_id", "hit_id"), "begins")
    return worded.join(hits, worded["doc_id"].eqNullSafe(hits["hit_id"])).select("doc_id", "n_words", F.lit(length).alias("length"), F.slice("words", F.col("begin") + 1, F.col("n_words")).alias("window"))


def _leading(item_shingles: DataFrame) -> DataFrame:
    """The heaviest shingles of each item whose weight exceeds what a passing window may lack: item_id, n_words, length, shingle."""
    of_item = Window.partitionBy("item_id")
    mass = F.col("weight") * F.col("times")
    heavier = F.coalesce(F.sum(mass).over(of_item.orderBy(F.desc("weight"), "shingle").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ranked = item_shingles.select("item_id", "n_words", "length", "shingle", heavier.alias("heavier"), F.sum(mass).over(of_item).alias("whole"))
    return ranked.where(F.col("heavier") * 100 <= F.col("whole") * (100 - PERCENT) + 1e-6).select("item_id", "n_words", "length", "shingle")


def contaminated_pairs(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity (0.8 to 1): items that a document holds."""
    parts = stored(_item_shingles(benchmark), "item_shingles")
    folded = parts.groupBy("item_id", "n_words", "length", "shingle").agg(F.count(F.lit(1)).alias("times"))
    seen = parts.select("item_id", "shingle").distinct().groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"))
    n_items = parts.select("item_id").distinct().count()
    weights = stored(seen.select("shingle", (F.lit(1.0) + F.log(F.lit(float(max(1, n_items))) / F.col("holders"))).alias("weight")), "weights")
    places = stored(parts.select("length", "shingle", "n_words", "at").distinct(), "places")
    lengths = sorted(r[0] for r in places.select("length").distinct().collect())  # at most WORDS numbers
    worded = documents.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    few = places.count() <= BROADCAST_ROWS
    windows = None
    for length in lengths:
        of = places.where(F.col("length") == length).select(F.col("shingle").alias("hash"), "n_words", "at")
        laid = (_windows_in_place if few else _windows_by_key)(worded, of, length)
        windows = laid if windows is None else windows.union(laid)
    if windows is None:
        return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity")).where("false")
    # One row for each different window; the same passage in many documents is fingerprinted once.
    held = stored(windows.distinct(), "windows").withColumn("window_id", F.xxhash64("length", F.array_join("window", " ")))
    each = held.select("window_id", "n_words", "length", "window").distinct()
    pieces = each.select("window_id", "n_words", "length", "window", F.posexplode("window").alias("pos", "word")).where(F.col("pos") <= F.size("window") - F.col("length"))
    by_length = F.coalesce(*[F.when(F.col("length") == n, _shingle(F.col("window"), F.col("pos"), n)) for n in lengths])
    held_shingles = pieces.select("window_id", "n_words", "length", by_length.alias("shingle"))
    window_shingles = stored(held_shingles.groupBy("window_id", "n_words", "length", "shingle").agg(F.count(F.lit(1)).alias("times")).join(weights, "shingle"), "window_shingles")
    item_shingles = stored(folded.join(weights, "shingle"), "weighted_items")

    keys = ["n_words", "length"]
    weighted = F.col("weight") * F.col("times")
    of_windows = _simhash(window_shingles.withColumn("weight", weighted), ["window_id", *keys])
    of_items = _simhash(item_shingles.withColumn("weight", weighted), ["item_id", *keys])
    w = of_windows.select("window_id", *keys, "fingerprint", F.inline(_blocks(F.col("fingerprint"))))
    i = of_items.select("item_id", *keys, F.col("fingerprint").alias("of_item"), F.inline(_blocks(F.col("fingerprint"))))
    near = w.join(i, [*keys, "block", "bits"]).where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("of_item"))) <= RADIUS)
    led = window_shingles.join(_leading(item_shingles), [*keys, "shingle"])
    found = stored(near.select("window_id", "item_id").union(led.select("window_id", "item_id")).distinct(), "near")

    whole = item_shingles.groupBy("item_id").agg(F.sum(weighted).alias("whole"))
    a = window_shingles.select("window_id", "shingle", F.col("times").alias("there"))
    b = item_shingles.select("item_id", "shingle", "weight", "times")
    common = found.join(a, "window_id").join(b, ["item_id", "shingle"]).groupBy("window_id", "item_id").agg(F.sum(F.col("weight") * F.least("times", "there")).alias("common"))
    alike = common.join(whole, "item_id").withColumn("similarity", F.least(F.lit(1.0), F.col("common") / F.col("whole"))).where(F.col("similarity") * 100 >= PERCENT - 1e-9)
    verified = stored(alike.select("window_id", "item_id", "similarity"), "verified")
    return held.select("doc_id", "window_id").distinct().join(verified, "window_id").groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document: doc_id, contaminated, n_items, item_ids (sorted), similarity (largest, 0 if clean), kept."""
    pairs = contaminated_pairs(documents, benchmark)
    by_doc = stored(pairs.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("similarity")), "contaminated")
    found = by_doc.withColumnRenamed("doc_id", "hit_id")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    out = docs.join(found, docs["doc_id"].eqNullSafe(found["hit_id"]), "left")
    hit = F.col("item_ids").isNotNull()
    return out.select("doc_id", hit.alias("contaminated"), F.when(hit, F.size("item_ids")).otherwise(0).alias("n_items"),
                      F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"), (~hit).alias("kept"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that hold a benchmark item, columns as they are."""
    gone = stored(contaminated_pairs(documents, benchmark).select(F.col("doc_id").alias("hit_id")).distinct(), "contaminated")
    return documents.join(gone, documents["doc_id"].cast("long").eqNullSafe(gone["hit_id"]), "left_anti").select(*documents.columns)
