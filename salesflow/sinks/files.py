"""File sinks: classified zone, partitioned fact, KPI files, CSV, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.numbers import nan_to_null
from salesflow.rules import TIMESTAMP_FORMAT

FACT_PARTITIONS = ("year", "month", "day")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory of any store Spark reaches; none if it is absent."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in store.listStatus(place)] if store.exists(place) else []


def remove_partitions(spark: SparkSession, path: str, columns: Sequence[str], values: Sequence[Sequence]) -> None:
    """Delete directories of a partitioned dataset that have no rows any more; those already gone are left alone."""
    for row in values:
        place = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{c}={v}" for c, v in zip(columns, row))]))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_classified(checked: DataFrame, path: str) -> None:
    """Classified rows in one write, a directory per reason; ``reason=ok`` is the cleansed zone.

    Rows stay where the dedup shuffle put them, so a task writes at most a file per
    reason; adaptive execution has merged small tasks by then.
    """
    checked.write.mode("overwrite").partitionBy("reason").parquet(path)


def _by_day(fact: DataFrame) -> DataFrame:
    """Rows of a day together, ready to be written.

    Adaptive execution balances bytes: small days share a task, and a day too big
    for one task is split over several.
    """
    return fact.hint("rebalance", *[F.col(c) for c in FACT_PARTITIONS])


def write_fact(fact: DataFrame, path: str, *, replace_days_only: bool = False) -> None:
    """Fact rows by year, month and day.

    ``replace_days_only`` overwrites the days present in ``fact`` and leaves all
    others as they are.
    """
    mode = "dynamic" if replace_days_only else "static"
    writer = _by_day(fact).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*FACT_PARTITIONS).parquet(path)


def write_months(df: DataFrame, path: str, *, all_months: bool) -> None:
    """A rollup by year and month; unless ``all_months``, months that ``df`` lacks stay as they are."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static" if all_months else "dynamic")
    writer.partitionBy("year", "month").parquet(path)


def append_fact(fact: DataFrame, path: str) -> None:
    """Add rows to their days without touching what is there."""
    _by_day(fact).write.mode("append").partitionBy(*FACT_PARTITIONS).parquet(path)


def write_small(df: DataFrame, path: str) -> None:
    """A report-sized frame (one row per category, month or region) as a single Parquet file."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """CSV with header and landing-format timestamps; ``single_file`` is for report-sized frames."""
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("timestampFormat", TIMESTAMP_FORMAT).csv(path)


def cluster(df: DataFrame, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """Range-partitioned and sorted on ``keys``, so file statistics skip data on the leading keys.

    Lead with a column of many values: ranges over a handful of values would
    leave most tasks idle, while further keys split a value that dominates.
    """
    columns = [F.col(k) for k in keys]
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def rewrite_days(spark: SparkSession, path: str, staging: str, days: DataFrame, sort_by: Sequence[str]) -> None:
    """Compact and re-sort the listed days (``year``, ``month``, ``day``).

    The result is staged first: a path is never overwritten by a plan reading it.
    """
    chosen = spark.read.parquet(path).join(days.select(*FACT_PARTITIONS).distinct(), list(FACT_PARTITIONS), "left_semi")
    write_fact(chosen, staging)
    ordered = _by_day(spark.read.parquet(staging)).sortWithinPartitions(*FACT_PARTITIONS, *sort_by)
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*FACT_PARTITIONS).parquet(path)


def report_lines(sections: Mapping[str, DataFrame]) -> DataFrame:
    """Report sections as ``section`` and ``body``, a JSON object per row, NaN written as null."""
    parts = [
        nan_to_null(df).select(
            F.lit(name).alias("section"),
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("body"),
        )
        for name, df in sections.items()
    ]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return lines


def write_report(sections: Mapping[str, DataFrame], path: str) -> None:
    """The report bundle: JSON lines under one directory per section. Sections are report-sized."""
    report_lines(sections).coalesce(1).write.mode("overwrite").partitionBy("section").text(path)
