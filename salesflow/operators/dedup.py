"""One row per key, without ever gathering the copies of a key in one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# A key with more rows than this in a sample of one row in a hundred is kept out of the windows; the choice changes the plan, not the result.
SAMPLED, FREQUENT, MOST = 0.01, 1000, 1000
# Rows of a task that sorts whole rows, so that it stays in memory; fewer tasks than these are left to adaptive execution.
TASK_ROWS, FEW_TASKS = 200_000, 16


def _ordering(df: DataFrame, key: str, first_by: Sequence[str]) -> list[str]:
    ordering = [c for c in first_by if c != key]
    return ordering + [c for c in df.columns if c != key and c not in ordering]


def first_per_key(df: DataFrame, key: str, first_by: Sequence[str] = ()) -> DataFrame:
    """The first row of each key, and ``copies``, the number of rows it stands for.

    ``first_by`` orders the copies (NULLs first), then the remaining columns do,
    NULLs last, so that of otherwise equal copies the fuller one stays.
    The minimum of a struct is combined on the map side, so a key holding a third
    of all rows reaches the shuffle as one row per task. NULL keys form a single
    group of their own.
    """
    ordering = _ordering(df, key, first_by)
    flags = [F.col(f"`{c}`").isNull().alias(f"_null_{i}") for i, c in enumerate(ordering) if c not in first_by]
    ranked = [F.col(f"`{c}`") for c in ordering[:len(ordering) - len(flags)]]
    ranked += [part for flag, c in zip(flags, ordering[len(ranked):]) for part in (flag, F.col(f"`{c}`"))]
    grouped = df.groupBy(key).agg(
        F.min(F.struct(*ranked)).alias("_first"),
        F.count(F.lit(1)).alias("copies"),
    )
    kept = [F.col(key) if c == key else F.col("_first")[c].alias(c) for c in df.columns]
    return grouped.select(*kept, "copies")


def any_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key when every copy is identical and the survivor does not matter."""
    return df.dropDuplicates([key])


def dropped_copies(df: DataFrame, key: str, first_by: Sequence[str] = ()) -> DataFrame:
    """The rows ``first_per_key`` leaves out, equal rows folded into one with ``copies``.

    Only rows of a repeated key take part; a count per key finds them, which reads
    the key alone.
    """
    repeated = df.groupBy(key).count().filter("count > 1")
    return _all_but_first(df.join(repeated.select(key), key, "left_semi").select(*df.columns), key, first_by)


def _all_but_first(df: DataFrame, key: str, first_by: Sequence[str]) -> DataFrame:
    """Each distinct row counts +1 per occurrence and -1 when it is the survivor.

    Grouping by the whole row spreads the copies of a hot key and folds equal ones before the shuffle.
    """
    survivors = first_per_key(df, key, first_by).drop("copies")
    signed = df.withColumn("copies", F.lit(1)).unionByName(survivors.withColumn("copies", F.lit(-1)))
    return signed.groupBy(*df.columns).agg(F.sum("copies").alias("copies")).filter("copies > 0")


def frequent_keys(df: DataFrame, key: str) -> list[str]:
    """Keys that hold so many rows that one task should not get them all, by a sample of the key alone."""
    return sampled_keys(df, key)[0]


def sampled_keys(df: DataFrame, key: str) -> tuple[list[str], int]:
    """``frequent_keys`` and about how many rows have a key, from one pass over a sample of the key."""
    sampled = df.filter(F.col(key).isNotNull()).select(key).sample(SAMPLED, seed=1).groupBy(key).count()
    often = F.when(F.col("count") > FREQUENT, F.struct("count", F.col(key).alias("key")))  # one in a hundred thousand rows at most
    found = sampled.agg(F.slice(F.sort_array(F.collect_list(often), asc=False), 1, MOST).alias("often"), F.sum("count").alias("rows")).first()
    return [row["key"] for row in found["often"]], int((found["rows"] or 0) / SAMPLED)


def spread(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """``df``, which has about ``rows`` rows, dealt by ``columns`` in as many partitions as its size asks for, whatever the session's number."""
    wanted = ceil(rows / TASK_ROWS)
    if wanted <= FEW_TASKS:
        return df.repartition(*columns)
    return df.repartition(max(wanted, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *columns)


def listed_copies(
    df: DataFrame, key: str, first_by: Sequence[str] = (), frequent: Sequence[str] = (), near: Sequence[str] = (), rows: int | None = None,
) -> DataFrame:
    """What ``first_per_key`` keeps and what it leaves out, equal rows of these folded, told apart by ``replaced``.

    One shuffle without an aggregation before it: every row moves once, and a window over its key tells its place. Rows of
    ``frequent`` keys are combined before they move instead, so that no task gets all rows of such a key. Keys must not be NULL.
    ``near`` names columns that the key determines: rows that already lie by them do not move again. Without it, ``rows``, if known, gives the
    number of partitions.
    """
    if frequent:
        among = F.col(key).isin(*frequent)
        busy = df.filter(among)
        kept = first_per_key(busy, key, first_by).withColumn("replaced", F.lit(False))
        lost = _all_but_first(busy, key, first_by).withColumn("replaced", F.lit(True))
        return listed_copies(df.filter(~among), key, first_by, near=near, rows=rows).unionByName(kept).unionByName(lost)
    ordered = [F.asc_nulls_first(f"`{c}`") if c in first_by else F.asc_nulls_last(f"`{c}`") for c in _ordering(df, key, first_by)]
    if rows is not None and not near:
        df = spread(df, rows, key)
    by_key = Window.partitionBy(*near, key).orderBy(*ordered)
    one = F.count(F.lit(1))
    placed = df.withColumns({
        "_place": F.row_number().over(by_key), "_rank": F.rank().over(by_key),
        "_equal": one.over(by_key.rangeBetween(Window.currentRow, Window.currentRow)),
        "_all": one.over(by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    }).filter("_place = _rank")  # the first of equal rows stands for them
    survivor = F.struct(F.col("_all").alias("copies"), F.lit(False).alias("replaced"))
    others = F.struct((F.col("_equal") - F.when(F.col("_place") == 1, 1).otherwise(0)).alias("copies"), F.lit(True).alias("replaced"))
    listed = F.when(F.col("_place") > 1, F.array(others)).when(F.col("_equal") > 1, F.array(survivor, others)).otherwise(F.array(survivor))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(listed))


def unseen_keys(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key is not among the keys ``seen`` earlier.

    The long key history is first cut down to the keys of the batch, so only
    batch-sized data takes part in the anti join.
    """
    batch_keys = df.select(key).distinct()
    repeated = seen.select(key).join(batch_keys, key, "left_semi").distinct()
    return df.join(repeated, key, "left_anti")


def with_resends(df: DataFrame, resends: DataFrame) -> DataFrame:
    """Append re-sent rows to a batch; columns are matched by name."""
    return df.unionByName(resends)
