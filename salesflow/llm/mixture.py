"""Mixing sources to target weights with hash-threshold histograms; DataFrame functions only.

Every source gets a word budget by weight; none may exceed ``MAX_REPEATS`` times its own words, and what it cannot use is shared again by
weight. A budget of k whole passes and a rest takes every document k times, and once more those whose hash lies below a threshold. The
threshold is found from histograms: words by source and leading hash digits, then, level by level, only within the bucket in which the
budget runs out, down to single hash values. What the first threshold leaves over is smaller than the document at the threshold; two
further rounds fill it from the documents that still fit, and the document at the last threshold is taken if that comes nearer. Nothing is
sorted or sampled, and no draw depends on partitioning, so reruns agree.

Edge cases: a null text has size 0; the null source comes last; equal ``doc_id``s share a hash and are taken together; a null id is
hashed as empty text; sources without words get target 0; an empty table gives an empty result. Sources themselves (one row each) meet in
one window, documents never do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.shared import WHITE_SPACE, stored

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
DIGIT_BITS, DIGITS, ROUNDS = 12, 5, 3


def size_in_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII blanks; 0 for null."""
    at_border = [F.when(text.rlike(edge), 1).otherwise(0) for edge in (f"^{WHITE_SPACE}", f"{WHITE_SPACE}\\z")]
    return F.when(F.length(text) > 0, F.size(F.split(text, WHITE_SPACE)) - at_border[0] - at_border[1]).otherwise(0).cast("long")


def hash60(identifier: Column) -> Column:
    """The first 60 bits of the MD5 of the identifier as text: the same number in any engine."""
    return F.conv(F.substring(F.md5(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, hash."""
    return documents.select(F.col("doc_id").cast("long"), "source", size_in_words(F.col("text")).alias("size"), hash60(F.col("doc_id")).alias("hash"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target: all words shared by weight, none above MAX_REPEATS times its source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    cap = F.lit(float(MAX_REPEATS)) * F.col("source_size")
    sources = sources.withColumn("weight", weight).withColumn("cap", cap)
    # Sources reach their cap in the order of cap per weight; before each, the level that the rest would get.
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = sources.withColumn("level", rest / open_weight).withColumn("open", F.col("cap") > F.col("weight") * F.col("level"))
    final = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"]
    share = F.when(F.col("open"), F.least(F.col("weight") * final, F.col("cap"))).otherwise(F.col("cap"))
    return level.select("source", "source_size", share.alias("target"))


def _same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def _threshold(pool: DataFrame, budgets: DataFrame) -> DataFrame:
    """``budgets`` (source, budget) with ``border``: the smallest hash at which the pool's running words exceed the budget, null if never;
    ``below``: the words below it; ``at``: those at it.
    """
    state = budgets.select("source", "budget", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("prefix"), F.lit(None).cast("long").alias("at"))
    for digit in range(DIGITS):
        shift = DIGIT_BITS * (DIGITS - 1 - digit)
        s = state.withColumnRenamed("source", "of")
        inside = pool.join(s, pool["source"].eqNullSafe(s["of"]) & F.col("prefix").isNotNull()
                           & (F.shiftright("hash", shift + DIGIT_BITS) == F.col("prefix")))
        histogram = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.first("budget").alias("budget"), F.first("below").alias("under"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        crossed = (histogram.withColumn("to_here", F.col("under") + running).where(F.col("to_here") > F.col("budget"))
                   .groupBy("source").agg(F.min(F.struct("bucket", (F.col("to_here") - F.col("words")).alias("below"), "words")).alias("b")))
        whole = pool.groupBy("source").agg(F.sum("size").alias("all_words")) if digit == 0 else None
        c = crossed.withColumnRenamed("source", "of")
        joined = state.drop("prefix", "at").join(c, state["source"].eqNullSafe(c["of"]), "left").drop("of")
        if whole is not None:
            w = whole.withColumnRenamed("source", "of")
            joined = joined.join(w, joined["source"].eqNullSafe(w["of"]), "left").drop("of")
        never = F.coalesce(F.col("all_words"), F.lit(0)) if whole is not None else F.col("below")
        state = stored(joined.select("source", "budget", F.when(F.col("b").isNull(), never).otherwise(F.col("b.below")).cast("long").alias("below"),
                                     F.col("b.bucket").alias("prefix"), F.col("b.words").alias("at")), "threshold")
    return state.select("source", "budget", "below", F.col("prefix").alias("border"), "at")


def _plan(pool: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """A row per source: its name as ``of``, source_size, target, passes, and the limits and rests of all rounds."""
    goal = stored(targets(pool, weights), "targets")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budget = F.when(F.col("source_size") > 0, F.col("target") - passes * F.col("source_size")).otherwise(F.lit(0.0))
    budgets = goal.select("source", budget.alias("budget"))
    bounds = None
    rest = pool
    for turn in range(1, ROUNDS + 1):
        found = _threshold(rest, budgets)
        last = turn == ROUNDS
        # At the end, the document at the threshold comes in if the sum is then nearer to the budget.
        nearer = (F.col("below") + F.col("at") - F.col("budget")) < (F.col("budget") - F.col("below"))
        limit = F.when(F.col("border").isNull(), F.lit((1 << 60))).otherwise(F.col("border") + (F.when(nearer, 1).otherwise(0) if last else F.lit(0)))
        step = stored(found.select("source", F.col("budget").alias(f"fits{turn}"), limit.alias(f"limit{turn}"), (F.col("budget") - F.col("below")).alias(f"left{turn}")), "limits")
        if bounds is None:
            bounds = step
        else:
            o = step.withColumnRenamed("source", "of")
            bounds = stored(bounds.join(o, bounds["source"].eqNullSafe(o["of"]), "left").drop("of"), "bounds")
        budgets = step.select("source", F.col(f"left{turn}").alias("budget"))
        if not last:
            b = bounds.withColumnRenamed("source", "of")
            left = pool.join(b, pool["source"].eqNullSafe(b["of"]))
            rest = left.where(~_taken(turn) & (F.col("size") <= F.col(f"left{turn}"))).select(*[pool[c] for c in pool.columns])
    b = bounds.withColumnRenamed("source", "of")
    g = goal.withColumnRenamed("source", "named").withColumn("passes", passes)
    return stored(b.join(g, b["of"].eqNullSafe(g["named"])).drop("named"), "plan")


def _copies(of: str = "") -> Column:
    """How many times a row is read, from its hash and size and its source's plan; ``of`` precedes all their names."""
    once_more = F.when(_taken(ROUNDS, of), 1).otherwise(0)
    return F.least(F.lit(MAX_REPEATS), F.col(f"{of}passes") + once_more).cast("int")  # only a wordless text could go beyond


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken (words), copies (whole times the mix takes it)."""
    pool = stored(sized(documents), "sizes")
    per_source = _plan(pool, weights)
    out = pool.join(per_source, pool["source"].eqNullSafe(per_source["of"]))
    copies = _copies()
    return out.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", (copies * F.col("size")).cast("long").alias("taken"), copies.alias("copies"))


def _taken(turns: int, of: str = "") -> Column:
    """Whether one of the first ``turns`` thresholds takes the document; later rounds offer only what fits."""
    mine = lambda name: F.col(f"{of}{name}")
    out = mine("hash") < mine("limit1")
    for turn in range(2, turns + 1):
        out = out | ((mine("size") <= mine(f"left{turn - 1}")) & (mine("hash") < mine(f"limit{turn}")))
    return out


def take_mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents that the mix takes, columns as they are, and ``copies``: how many times each is to be read.

    Every row is judged where it is read, by its own size and hash and the plan of its source; rows with equal ids that differ in size may be
    taken differently often. A clashing column ``copies`` of the input is replaced. Rows with a null id are hashed like any other.
    """
    per_source = _plan(stored(sized(documents), "sizes"), weights)
    plan = per_source.select(F.struct(*per_source.columns).alias("_mix"))
    own = F.struct("_mix.*", size_in_words(F.col("text")).alias("size"), hash60(F.col("doc_id")).alias("hash"))
    met = documents.join(plan, documents["source"].eqNullSafe(plan["_mix"]["of"])).withColumn("_mix", own).withColumn("_copies", _copies("_mix."))
    return met.where("_copies > 0").select(*[documents[x] for x in documents.columns if x != "copies"], F.col("_copies").alias("copies"))
