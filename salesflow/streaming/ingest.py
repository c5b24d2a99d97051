"""Incremental landing input, stateless cleansing, dedup and windowed revenue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from salesflow.operators.cleanse import standardise, typed_projection, with_key, with_timestamp, with_valid_amount
from salesflow.rules import CONTRACT_COLUMNS, MONEY, MONEY_TOTAL, TEXT_SCHEMA, CleansingRules
from salesflow.sources.landing import CORRUPT, parse_landing_lines, split_corrupt


def stream_landing_csv(
    spark: SparkSession, path: str, schema: T.StructType = TEXT_SCHEMA, files_per_batch: int | None = None,
) -> DataFrame:
    """New landing CSV files as text columns; a file with another header fails the batch."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"')
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def stream_landing_lines(spark: SparkSession, path: str, columns: Sequence[str] = CONTRACT_COLUMNS, files_per_batch: int | None = None) -> DataFrame:
    """New landing CSV files as text columns, malformed lines kept in ``_corrupt_record``; see ``parse_landing_lines``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_landing_lines(reader.text(path), columns)


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, pattern: str | None = None,
) -> DataFrame:
    """New Parquet files of a known schema in a directory; ``pattern`` limits the file names."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def clean_stream(stream: DataFrame, rules: CleansingRules = CleansingRules()) -> DataFrame:
    """Every rule that needs no state: typing, validity, domains, imputation."""
    valid = with_timestamp(with_valid_amount(with_key(typed_projection(stream, rules)), rules))
    return standardise(valid, rules)


def dedup_stream(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First arrival per key among rows no more than ``delay`` apart; rows with a NULL key are no copies and all stay.

    State is dropped once the watermark passes it, so it does not grow without bound.
    """
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    timed = stream.withWatermark(event_time, delay)
    return timed.filter(keyed).dropDuplicatesWithinWatermark(list(keys)).union(timed.filter(~keyed))


def windowed_revenue(
    stream: DataFrame, event_time: str, amount: str, keys: Sequence[str], window: str = "1 day", delay: str = "1 day",
) -> DataFrame:
    """Revenue and count per time window and key. In append mode a window appears once the watermark closes it."""
    timed = stream.withWatermark(event_time, delay)
    return timed.groupBy(F.window(event_time, window), *keys).agg(
        F.sum(F.col(amount).cast(MONEY)).cast(MONEY_TOTAL).alias("total_revenue"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def windowed_customers(
    stream: DataFrame, event_time: str, customer: str, keys: Sequence[str], window: str = "1 day", delay: str = "1 day", lg_k: int = 12,
) -> DataFrame:
    """A mergeable sketch of the distinct customers per time window and key.

    The state of a window is one sketch, however many customers it has. The relative standard error of an
    estimate is about 0.83 / sqrt(2 ** lg_k), 1.3 percent by default.
    """
    timed = stream.withWatermark(event_time, delay)
    return timed.groupBy(F.window(event_time, window), *keys).agg(F.hll_sketch_agg(F.col(customer), lg_k).alias("customers"))


def merged_customers(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimated distinct customers under coarser keys: sketches of windows, batches or runs are united, no customer counts twice."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("unique_customers"))


def closing_windows(totals: DataFrame) -> DataFrame:
    """Windowed totals with the window as ``window_start`` and ``window_end``, as a file sink in append mode takes them."""
    return totals.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in totals.columns if c != "window"])


def _run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process the input present now and return.

    A new checkpoint fixes the number of state partitions at the session's
    ``spark.sql.shuffle.partitions``.
    """
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there now into Parquet, exactly once per input file."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    _run_available(writer, checkpoint)


def append_with_rejects(stream: DataFrame, path: str, rejects: str, checkpoint: str, rules: CleansingRules = CleansingRules()) -> None:
    """Process what is there now: well-formed rows, typed, to ``path`` and malformed lines as they came to ``rejects``.

    Each batch writes directories of its own number in both, so a batch that runs again replaces what it wrote.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_corrupt(batch)
        typed_projection(good, rules).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        bad.select(CORRUPT).write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")

    _run_available(stream.writeStream.foreachBatch(write), checkpoint)


def replace_with_totals(totals: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there now and write the complete totals, replacing those of earlier batches."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = totals.writeStream.outputMode("complete").foreachBatch(write)
    _run_available(writer, checkpoint)
