"""Ranked lexical search: best-first document intervals bounded by range-maximum sparse tables.

``index`` cuts the documents into shards of a bounded number of postings. Within a shard documents are numbered by id, and each term has a
posting list. ``search`` brings a shard's lists of the wanted terms together, turns frequencies into impacts and builds a sparse table
over each list. An item's search starts with the interval of all documents. The highest impacts of its terms within an interval, found by
two table lookups each and added up, bound every score in it. The interval of highest bound is scored at one document, that of its
highest impact, and split there; both rests get bounds of their own. Intervals are dropped once no document in them can reach the best
``k``. Items of a block go side by side. The best of all shards are ranked.

A shard's best are exact, so the result does not depend on how documents were cut into shards. Shards and blocks of items bound what a
task holds; a term that stands in every document has a list in every shard, none longer than a shard has documents.

Edge cases: a text without terms is in no list and is never found; a null or wordless item has no rows; every row is a document or an item
of its own where ids repeat, null ids come last among equal scores; equal scores rank by id; equal texts share scores; a long text counts
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.shared import ascii_lower, stored
from salesflow.llm.wordhash import text_slices

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARD_POSTINGS = 1 << 21
BLOCK_ITEMS = 256
ROWS = 4096
# Fixed values of the score: weights are in thousandths, impacts in units of 1 / 1,000,000.
WEIGHT_UNIT, IMPACT_UNIT, FREQUENCY_UNIT, LENGTH_UNIT, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 75
_FOLD = bytes((b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32) for b in range(256))


class _Codes(dict):
    """Numbers terms as they are met."""

    def __missing__(self, term: bytes) -> int:
        self[term] = len(self)
        return self[term]


class _Shard:
    def __init__(self, number: int):
        self.number, self.codes = number, _Codes()
        self.ids, self.lengths, self.code, self.doc, self.times = [], [], array("i"), array("i"), array("i")

    def add(self, identifier: int | None, text: bytes) -> None:
        terms = text.translate(_FOLD).split()
        if terms:
            counted = Counter(terms)
            self.code.extend(map(self.codes.__getitem__, counted))
            self.times.extend(counted.values())
            self.doc.extend([len(self.ids)] * len(counted))
            self.ids.append(identifier)
            self.lengths.append(len(terms))

    def rows(self):
        """Batches of one column set for both tables: the documents of the shard, then its lists."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        yield pa.RecordBatch.from_arrays([
            pa.array([self.number], pa.int64()), pa.array([None], pa.string()), pa.array([[]], pa.list_(pa.int32())), pa.array([[self.lengths[i] for i in order]], pa.list_(pa.int32())),
            pa.array([len(order)], pa.int64()), pa.array([[self.ids[i] for i in order]], pa.list_(pa.int64())), pa.array([sum(self.lengths)], pa.int64()),
        ], names=["shard", "term", "docs", "times", "held", "ids", "n_terms"])
        code, doc, times = (np.frombuffer(x, np.int32) for x in (self.code, self.doc, self.times))
        doc = place[doc]
        by = np.lexsort((doc, code))
        code, doc, times = code[by], doc[by], times[by]
        bounds = np.searchsorted(code, np.arange(len(self.codes) + 1))
        terms = pa.array([t.decode() for t in self.codes], pa.string())
        for at in range(0, len(terms), ROWS):
            cut = bounds[at:at + ROWS + 1]
            n = len(cut) - 1
            lists = [pa.ListArray.from_arrays(pa.array(cut - cut[0], pa.int32()), pa.array(x[cut[0]:cut[-1]])) for x in (doc, times)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, self.number)), terms.slice(at, n), *lists, pa.array(np.diff(cut).astype(np.int64)),
                pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64()),
            ], names=["shard", "term", "docs", "times", "held", "ids", "n_terms"])


def index(documents: DataFrame) -> DataFrame:
    """The index of whole texts: a row per shard and term, and for each shard one with a null term, its ids and lengths.

    Columns: shard, term, docs (numbers within the shard, ascending), times, held (how many documents), ids (by number), n_terms. In the row
    without a term ``times`` are the documents' lengths in terms.
    """

    def build(batches):
        number = TaskContext.get().partitionId() << 32
        shard = _Shard(number)
        for keys, texts in text_slices(batches):
            for identifier, text in zip(keys.to_pylist(), texts):
                shard.add(identifier, text or b"")
                if len(shard.code) >= SHARD_POSTINGS:
                    yield from shard.rows()
                    number += 1
                    shard = _Shard(number)
        if shard.ids:
            yield from shard.rows()

    shape = "shard long, term string, docs array<int>, times array<int>, held long, ids array<long>, n_terms long"
    return stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, shape), "index")


class Lists:
    """The posting lists of one shard, longest first, one after another, with a sparse table over them.

    Level j holds, for each place, the place of the highest impact among the 2 ** j from it on, the leftmost of equals. It reaches only as
    far as lists of that length do.
    """

    def __init__(self, docs: list[np.ndarray], impacts: list[np.ndarray], n_docs: int):
        sizes = np.array(list(map(len, docs)), np.int64)
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        self.n_docs = n_docs
        self.docs = np.concatenate(docs).astype(np.int64)
        self.impact = np.concatenate(impacts)
        self.key = self.docs + np.repeat(np.arange(len(sizes)), sizes) * n_docs  # ascends
        levels, width = [np.arange(len(self.docs), dtype=np.int32)], 1
        while width * 2 <= sizes[0]:
            n = int(self.end[sizes >= width * 2][-1]) - 2 * width + 1
            left, right = levels[-1][:n], levels[-1][width:width + n]
            levels.append(np.where(self.impact[left] >= self.impact[right], left, right))
            width *= 2
        self.table = np.concatenate(levels)
        self.level = np.cumsum([0, *map(len, levels)])
        self.log = np.zeros(int(sizes[0]) + 1, np.int8)
        for j in range(1, len(levels)):
            self.log[1 << j:] = j

    def highest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of the highest impact in each non-empty range of one list."""
        depth = self.log[high - low].astype(np.int64)
        at = self.level[depth]
        left, right = self.table[at + low], self.table[at + high - (1 << depth)]
        return np.where(self.impact[left] >= self.impact[right], left, right)

    def find(self, lists: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each document stands or would stand in a list, and whether it stands there."""
        wanted = lists * self.n_docs + doc
        at = np.searchsorted(self.key, wanted)
        return at, self.key[np.minimum(at, len(self.key) - 1)] == wanted


def best_first(lists: Lists, items: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[int, int]]]:
    """For each item, given as its lists and how often it names their terms, up to ``k`` (score, document) with score above 0, best first
    and by number where scores are equal."""
    top = [[] for _ in items]  # heaps of (score, -document): the worst first
    open_ = [[] for _ in items]  # heaps of (-bound, first document, split, low, high)

    def hopeless(item: int, bound: int, first: int) -> bool:
        best = top[item]
        return bound <= 0 or len(best) == k and (bound, -first) < best[0]

    def enter(owners: list[int], firsts: list[int], low: np.ndarray, high: np.ndarray) -> None:
        """Bounds and opens intervals, given by their place in each list of the item."""
        own = np.concatenate([items[i][0] for i in owners])
        weight = np.concatenate([items[i][1] for i in owners])
        sizes = np.array([len(items[i][0]) for i in owners])
        begin = np.cumsum(sizes) - sizes
        filled = high > low
        place = np.where(filled, lists.highest(np.where(filled, low, 0), np.where(filled, high, 1)), 0)
        value = np.where(filled, lists.impact[place] * weight, 0)
        bounds = np.add.reduceat(value, begin)
        highest = np.maximum.reduceat(value, begin)
        peak = np.flatnonzero(value == np.repeat(highest, sizes))
        _, one = np.unique(np.repeat(np.arange(len(sizes)), sizes)[peak], return_index=True)
        split = lists.docs[place[peak[one]]]
        for i, first, bound, doc, a, n in zip(owners, firsts, bounds.tolist(), split.tolist(), begin.tolist(), sizes.tolist()):
            if not hopeless(i, bound, first):
                heapq.heappush(open_[i], (-bound, first, doc, low[a:a + n], high[a:a + n]))

    filled = [i for i, (own, _) in enumerate(items) if len(own)]
    if filled:
        every = np.concatenate([items[i][0] for i in filled])
        enter(filled, [0] * len(filled), lists.start[every], lists.end[every])
    wide = 1
    while True:
        taken = []
        for i, heap in enumerate(open_):
            for _ in range(wide):
                if not heap:
                    break
                interval = heapq.heappop(heap)
                if hopeless(i, -interval[0], interval[1]):
                    if -interval[0] < (top[i][0][0] if len(top[i]) == k else 1):
                        heap.clear()  # bounds only fall from here
                        break
                    continue
                taken.append((i, interval))
        if not taken:
            return [sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1])) for best in top]
        owners = [i for i, _ in taken]
        own = np.concatenate([items[i][0] for i in owners])
        weight = np.concatenate([items[i][1] for i in owners])
        sizes = np.array([len(items[i][0]) for i in owners])
        low, high = (np.concatenate([t[1][side] for t in taken]) for side in (3, 4))
        at, hit = lists.find(own, np.repeat(np.array([t[1][2] for t in taken]), sizes))
        scores = np.add.reduceat(np.where(hit, lists.impact[np.where(hit, at, 0)] * weight, 0), np.cumsum(sizes) - sizes).tolist()
        for (i, interval), score in zip(taken, scores):
            if not hopeless(i, score, interval[2]):
                (heapq.heappushpop if len(top[i]) == k else heapq.heappush)(top[i], (score, -interval[2]))
        firsts = [t[1][1] for t in taken], [t[1][2] + 1 for t in taken]
        enter(owners * 2, [*firsts[0], *firsts[1]], np.concatenate((low, at + hit)), np.concatenate((at, high)))
        wide = min(2 * wide, 64)


def _searched(n_docs: int, n_terms: int, k: int):
    """Searches one block of items in one shard; rows: see ``search``."""

    def build(rows: pa.Table) -> pa.Table:
        term = rows.column("term").combine_chunks()
        own = rows.filter(term.is_null()).slice(0, 1).to_pylist()[0]
        lengths = np.array(own["times"], np.int64)
        wanted = rows.filter(term.is_valid())
        norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n_docs) // n_terms
        made = []
        for r in range(wanted.num_rows):
            docs, times, items, repeats = (wanted.column(c)[r].values.to_numpy() for c in ("docs", "times", "items", "repeats"))
            weight = wanted.column("weight")[r].as_py()
            made.append((docs, weight * ((IMPACT_UNIT * times.astype(np.int64)) // (FREQUENCY_UNIT * times.astype(np.int64) + LENGTH_UNIT * norm[docs])), items, repeats))
        made.sort(key=lambda m: -len(m[0]))
        out = [], [], []
        if made:
            names, number = np.unique(np.concatenate([m[2] for m in made]), return_inverse=True)
            owner = np.repeat(np.arange(len(made)), [len(m[2]) for m in made])
            repeats = np.concatenate([m[3] for m in made]).astype(np.int64)
            by = np.argsort(number, kind="stable")
            cut = np.searchsorted(number[by], np.arange(len(names) + 1))
            items = [(owner[by[a:b]], repeats[by[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
            lists = Lists([m[0] for m in made], [m[1] for m in made], len(lengths))
            for name, found in zip(names.tolist(), best_first(lists, items, k)):
                for score, doc in found:
                    for column, value in zip(out, (name, own["ids"][doc], score)):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["item", "doc_id", "score"])

    return build


def search(found: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of the index ``found`` for each item (item_id, text): item_id, rank, doc_id, score."""
    asked = stored(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    own = found.where("term IS NULL").agg(F.coalesce(F.sum("held"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n_terms")).first()
    blocks = max(1, -(-asked.count() // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")
    terms = asked.select("item", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))).alias("term"))
    counted = terms.groupBy("item", "term").agg(F.count(F.lit(1)).alias("repeats"))
    by_term = counted.groupBy("term", block).agg(F.collect_list(F.struct("item", "repeats")).alias("of"))  # at most a block's items
    by_term = stored(by_term.select("term", "block", F.col("of.item").alias("items"), F.col("of.repeats").alias("repeats")), "wanted")
    listed = found.where("term IS NOT NULL")
    frequency = listed.select("term", "held").join(by_term.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("held").alias("df"))
    weight = F.floor(WEIGHT_UNIT * F.log((2 * F.lit(own["n_docs"]) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = stored(by_term.join(frequency.select("term", weight.alias("weight")), "term"), "weighted")
    lists = listed.select("shard", "term", "docs", "times").join(weighted, "term")
    heads = found.where("term IS NULL").select("shard", "times", "ids").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    rows = lists.unionByName(heads, allowMissingColumns=True)
    best = rows.groupBy("shard", "block").applyInArrow(_searched(own["n_docs"], own["n_terms"], k), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
