"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Two fixed permutations make all coordinates of a signature: the first spreads shingle hashes over a circle of 2**20 places, the second
ranks the places; coordinate k is the least rank of the text's places after turning the circle by k. ``ROWS`` coordinates make a band
key, and texts that agree on one of ``BANDS`` keys are candidates: a pair at Jaccard 0.8 is missed with probability (1 - 0.8**7)**48, about
1e-5; at 0.4 one pair in fourteen becomes a candidate. Links are confirmed on full shingle sets.

Work stays linear in copies: texts with one shingle set are folded first; then each text is compared with one leader of its buckets and
linked texts are joined into components; members of *different* components that still share a bucket remain. Those near the middle of a
family of edited copies are compared with that middle, and of the pairs still left only those are compared that can reach the
similarity: see ``_open_pairs``. No candidate link is lost and nothing is capped.

Edge cases: a text without words has no shingles, is linked with nothing and stays; with fewer words than a shingle the whole sequence is
one; rows with one ``doc_id`` are one document that has the links of all its texts; a row without ``doc_id`` is linked with nothing, has a null component and stays; an
empty table gives an empty result; other columns are ignored; a text of any length is hashed whole, in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.components import components
from salesflow.llm.shared import ascii_lower, stored, text_key, without
from salesflow.llm.wordhash import mixed, shingle_sets, text_slices

ROWS, BANDS = 7, 48
PLACE_BITS = 20
STEP_ROWS = 1024
HOT = 32
_SPREAD = np.uint64(0x5851F42D4C957F2D)
_ranks: list[np.ndarray] = []


def _turns() -> np.ndarray:
    """Row v holds the ranks of places v, v + 1, ... on the circle: coordinate k of a place is its column k."""
    if not _ranks:
        rank = np.random.default_rng(7919).permutation(1 << PLACE_BITS).astype(np.uint32)
        _ranks.append(np.lib.stride_tricks.sliding_window_view(np.concatenate((rank, rank[:ROWS * BANDS])), ROWS * BANDS))
    return _ranks[0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """ROWS * BANDS least ranks of a non-empty shingle set."""
    place = (mixed(shingles ^ _SPREAD) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
    turns = _turns()
    out = None
    for at in range(0, len(place), STEP_ROWS):
        least = turns[place[at:at + STEP_ROWS]].min(axis=0)
        out = least if out is None else np.minimum(out, least)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A key per band and signature; keys of different bands never mean the same."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    for k in range(ROWS):
        key = mixed(key + parts[:, :, k])
    return key.view(np.int64)


def _signed(docs: DataFrame, words: int) -> DataFrame:
    def build(batches):
        for ids, texts in text_slices(batches):
            sets = list(shingle_sets(texts, words))
            filled = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(np.stack([signature(sets[i]) for i in filled])) if filled else np.zeros((0, BANDS), np.int64)
            lengths = np.zeros(len(sets) + 1, np.int32)
            lengths[1:][filled] = BANDS
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(keys.ravel(), pa.int64())),
            ], names=["doc_id", "n_shingles", "digest", "bands"])

    return docs.mapInArrow(build, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def build(batches):
        for ids, texts in text_slices(batches):
            sets = list(shingle_sets(texts, words))
            places = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(values, pa.int64()))], names=["rep", "shingles"])

    return docs.mapInArrow(build, "rep long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(left, "a").join(right, "b").where(common * 100 >= (F.size("of_a") + F.size("of_b") - common) * percent).select("a", "b")


def _ranked(waiting: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The shingles that several waiting texts hold: rep, n_shingles, shingle, holders, hot, leads.

    ``hot`` is how many of the text's shingles more than HOT texts hold. ``leads`` marks those among the first
    n - ceil(percent * n / 100) + 1 when shingles are ordered rarest first.
    """
    texts = stored(waiting.select("rep", "n_shingles").distinct(), "texts")
    held = texts.join(sets, "rep").select("rep", "n_shingles", F.explode("shingles").alias("shingle"))
    common = stored(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1"), "holders")
    of_text = Window.partitionBy("rep")
    several = F.count(F.lit(1)).over(of_text)
    place = F.col("n_shingles") - several + F.row_number().over(of_text.orderBy("holders", "shingle"))
    leading = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    hot = F.count(F.when(F.col("holders") > HOT, 1)).over(of_text)
    return stored(held.join(common, "shingle").select("rep", "n_shingles", "shingle", "holders", hot.alias("hot"), (place <= leading).alias("leads")), "ranked")


def _bounded(waiting: DataFrame, ranked: DataFrame, percent: int) -> DataFrame:
    """Waiting rows of texts that are mostly hot, with ``core`` (their hot share) and ``most``.

    Two texts that share hot shingles only have an intersection no larger than either's ``hot``; with it, ``most`` is the largest number of
    shingles that a partner of the text may have.
    """
    hot = ranked.where(f"hot * 100 >= n_shingles * {percent}").select("rep", "hot").distinct()
    most = F.floor(F.col("hot") * (100 + percent) / percent) - F.col("n_shingles")
    return stored(waiting.join(hot, "rep").select("key", "rep", "n_shingles", "part", (F.col("hot") / F.col("n_shingles")).alias("core"), most.alias("most")), "bounded")


def _central_pairs(bounded: DataFrame) -> DataFrame:
    """Each text with the text of its bucket that holds the largest share of hot shingles: the middle of a family of edited copies."""
    middle = bounded.groupBy("key").agg(F.max(F.struct("core", (-F.col("rep")).alias("minus"), "n_shingles", "part", "most")).alias("m"))
    met = bounded.join(stored(middle, "middle"), "key").where("part <> m.part AND n_shingles <= m.most AND m.n_shingles <= most")
    other = -F.col("m.minus")
    return met.select(F.least("rep", other).alias("a"), F.greatest("rep", other).alias("b")).distinct()


def _open_pairs(bounded: DataFrame, ranked: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different parts that can be similar enough.

    Two texts that are similar enough share a leading shingle. Either one that at most HOT texts hold is shared there: those pairs come
    from an index of rare leading shingles, at most HOT of them to a row. Or all that the two share is hot: then the bound of
    ``_bounded`` holds for both, which few pairs of a large family of edited copies satisfy.
    """

    def met(rows: DataFrame, on: str, further: str = "true") -> DataFrame:
        one, other = (rows.select(F.col(on).alias(f"{on}_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != on]) for side in "ab")
        fits = f"n_shingles_a * 100 >= n_shingles_b * {percent} AND n_shingles_b * 100 >= n_shingles_a * {percent}"
        return one.join(other, F.expr(f"{on}_a = {on}_b AND rep_a < rep_b AND part_a <> part_b AND {fits} AND {further}")).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))

    leading = ranked.where(f"leads AND holders <= {HOT}").select("shingle", "rep", "n_shingles")
    rare = met(stored(leading.join(parts, "rep").select("shingle", "rep", "n_shingles", "part"), "leading"), "shingle")
    placed = stored(bounded.drop("part").join(parts, "rep"), "bounded")
    # A row whose bucket has no other part, or no partner so small, is done.
    least = stored(placed.groupBy("key").agg(F.min("n_shingles").alias("least"), F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key", "least"), "least")
    left = stored(placed.join(least, "key").where("most >= least").select("key", "rep", "n_shingles", "part", "most"), "left")
    return rare.union(met(left, "key", "n_shingles_b <= most_a AND n_shingles_a <= most_b")).distinct()


def near_groups(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id (least id reachable over links of ``percent`` similarity), kept.

    Where an id is reused, its document has the links of all its texts, and each row the number of its own shingles.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))
    if docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return _groups(docs, words, percent)
    unnamed = _groups(docs.where("doc_id IS NULL"), words, percent)
    keyed = docs.where("doc_id IS NOT NULL").withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    pairs = keyed.groupBy("doc_id", "key").agg(F.max("text").alias("text"))
    own = stored(pairs.orderBy("doc_id", "key").withColumn("row", F.monotonically_increasing_id()), "numbered")
    groups = stored(_groups(own.select(F.col("row").alias("doc_id"), "text"), words, percent).select(F.col("doc_id").alias("row"), "n_shingles", "component_id"), "groups")
    rows = stored(own.select("row", "doc_id", "key").join(groups, "row"), "rows")
    first = rows.groupBy("doc_id").agg(F.min("row").alias("first"))
    linked = components(rows.join(first, "doc_id").select("row", "first").union(rows.select("row", "component_id")))
    # Rows are numbered in the order of ids, so the least row of a component has its least id.
    least = linked.join(rows.select(F.col("row").alias("component"), F.col("doc_id").alias("least_id")), "component").select(F.col("node").alias("row"), "least_id")
    found = rows.join(least, "row", "left").select("doc_id", "key", "n_shingles", F.coalesce("least_id", "doc_id").alias("component_id"))
    met = keyed.select("doc_id", "key").join(found, ["doc_id", "key"])
    return met.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")).union(unnamed)


def _groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``near_groups`` of lowered texts with distinct or null ids."""
    signed = stored(_signed(docs, words), "signed")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Texts with one shingle set: the least id stands for all.
    alike = stored(usable.groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "alike")
    folded = usable.join(alike, "digest", "left").withColumn("rep", F.coalesce("least_id", "doc_id"))
    members = folded.where("doc_id = rep").select("rep", "n_shingles", F.explode("bands").alias("key"))

    shared = members.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last").select("key", "leader")
    bucketed = stored(members.join(stored(shared, "buckets"), "key"), "bucketed")
    candidates = stored(bucketed.select("rep").distinct(), "candidates")
    sets = stored(_sets(docs.join(candidates, docs["doc_id"] == candidates["rep"]).select("rep", "text"), words).dropDuplicates(["rep"]), "sets")

    led = bucketed.where("leader < rep").groupBy("rep").agg(F.min("leader").alias("leader"))
    first = stored(_confirmed(led.select(F.col("leader").alias("a"), F.col("rep").alias("b")), sets, percent), "links")
    joined = components(first)

    placed = stored(bucketed.join(joined, bucketed["rep"] == joined["node"], "left").select("key", "rep", "n_shingles", F.coalesce("component", "rep").alias("part")), "placed")
    open_keys = stored(placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key"), "open")
    waiting = stored(placed.join(open_keys, "key"), "waiting")
    ranked = _ranked(waiting, sets, percent)
    bounded = _bounded(waiting, ranked, percent)
    central = stored(_confirmed(_central_pairs(bounded), sets, percent), "links")
    if not central.isEmpty():
        joined = components(central.union(joined.select("node", "component")))
    texts = waiting.select("rep").distinct()
    parts = stored(texts.join(joined, texts["rep"] == joined["node"], "left").select("rep", F.coalesce("component", "rep").alias("part")), "parts")
    pairs = stored(_open_pairs(bounded, ranked, parts, percent), "pairs")
    second = stored(_confirmed(pairs, sets, percent), "links")
    final = joined if second.isEmpty() else components(second.union(joined.select("node", "component")))

    rep = signed.join(alike, "digest", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("least_id", "doc_id")).otherwise(F.col("doc_id")).alias("rep"))
    found = rep.join(final, rep["rep"] == final["node"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with the least id of each group of near copies, columns as they are.

    Where ids are missing or reused, each different pair of id and text is a document of its own, in the order of id (null last) and
    text key, and of equal pairs one row stays unless it is wordless.
    """
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key(F.col("text")).alias("key"))
    reused = documents.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if reused.isEmpty():
        gone = stored(near_groups(documents, words, percent).where(~F.col("kept")).select(F.col("doc_id").alias("dropped_id")), "dropped")
        return documents.join(gone, documents["doc_id"] == gone["dropped_id"], "left_anti").select(*documents.columns)
    pairs = keyed.groupBy(F.col("doc_id").alias("dropped_id"), F.col("key").alias("dropped_key")).agg(F.count(F.lit(1)).alias("n"), F.max("text").alias("text"))
    placed = pairs.orderBy(F.asc_nulls_last("dropped_id"), "dropped_key").withColumn("row_id", F.monotonically_increasing_id())
    own = stored(placed, "numbered")
    groups = stored(near_groups(own.select(F.col("row_id").alias("doc_id"), "text"), words, percent).select(F.col("doc_id").alias("row_id"), "n_shingles", "kept"), "groups")
    judged = own.drop("text").join(groups, "row_id")
    marks = lambda which: judged.where(which).select("dropped_id", "dropped_key")
    return without(documents, stored(marks("NOT kept"), "dropped"), stored(marks("kept AND n > 1 AND n_shingles > 0"), "repeated"))
