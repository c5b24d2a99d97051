"""Incremental refresh: new landing rows into the curated fact and its KPIs.

Layout below ``root``: ``received/`` holds every row with its verdict, by batch: the first copy of each transaction, the copies it replaces
and rows sent again in a later batch as ``duplicate`` (equal ones of a batch folded with their number in ``copies``), and rows without a
key; rejects keep amount and timestamp also as text. ``keys/`` is the bucketed history of transactions; ``ledger/`` the funnel counts of
each batch, which add up; ``sales/`` is the fact; ``rollup/`` the month totals and distinct customers by key; ``kpis/`` the KPIs.

A batch that runs again gives the same result. Its transactions are compared with those of earlier batches only, its ``received``,
``keys`` and ``ledger`` directories are overwritten, fact rows already appended by the first attempt are left out, and the touched
months of the rollup are recomputed from the fact; only customers new to a
category or region are added to the other distinct sets.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.operators import kpis
from salesflow.operators.cleanse import (
    DUPLICATE, FUNNEL_STEPS, OK, PK_NULL, clean_rows, funnel_steps, judged_copies, keyless_rows, listed_counts, restored_text, stamp_audit, standardise_kept,
    typed_projection, with_raw_text,
)
from salesflow.operators.dedup import sampled_keys, unseen_keys
from salesflow.plans.jobs import KPI_CATEGORY, KPI_KEYS, KPI_MONTHLY, KPI_REGIONS, write_kpis
from salesflow.rules import CLEANSED_COLUMNS, KEY, CleansingRules
from salesflow.sinks import files
from salesflow.sinks.files import append_fact
from salesflow.sinks.history import History
from salesflow.sources.landing import ARRIVAL
from salesflow.sources.landing import in_months as _in_months


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A dataset, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def key_history(spark: SparkSession, root: str, before: int) -> History:
    """The transactions received so far. A zone that has none yet gets it from what earlier batches received."""
    history = History(spark, f"{root}/keys", {KEY: "string"}, KEY)
    received = _stored(spark, f"{root}/received") if history.is_new else None
    if received is not None:
        earlier = received.filter((F.col("batch_id") < before) & ~F.col("reason").isin(PK_NULL, DUPLICATE))
        history.fill(earlier.select(KEY, "batch_id"))
    return history


def judged_batch(batch: DataFrame, history: History, batch_id: int, rules: CleansingRules = CleansingRules()) -> DataFrame:
    """Every row of a batch with its verdict; transactions of earlier batches are duplicates."""
    typed = typed_projection(with_raw_text(batch), rules)
    frequent, rows = sampled_keys(typed, KEY)
    keyed = judged_copies(typed, rules, frequent, rows=rows)
    if not history.is_new:
        resent = F.col("_known") & (F.col("reason") != DUPLICATE)
        keyed = history.marked(keyed, batch_id, typed).withColumns({
            "reason": F.when(resent, DUPLICATE).otherwise(F.col("reason")), "copies": F.when(resent, 1).otherwise(F.col("copies")),  # its copies are listed on their own
        }).drop("_known")
    return restored_text(keyed.unionByName(keyless_rows(typed)))


def funnel(spark: SparkSession, root: str) -> DataFrame:
    """The quality funnel over all batches so far."""
    ledger = spark.read.parquet(f"{root}/ledger")
    return funnel_steps(ledger.agg(*[F.sum(step).alias(step) for step in FUNNEL_STEPS]))


def apply_batch(
    batch: DataFrame, batch_id: int, root: str, rules: CleansingRules = CleansingRules()
) -> None:
    """Fold one batch of landing rows into the curated zone below ``root``."""
    spark = batch.sparkSession
    own_path, fact_path, rollup_path = f"{root}/received/batch_id={batch_id}", f"{root}/sales", f"{root}/rollup"

    replayed = _stored(spark, own_path) is not None
    history = key_history(spark, root, batch_id)
    rows = standardise_kept(judged_batch(batch, history, batch_id, rules), rules).drop(*ARRIVAL)
    files.write_classified(stamp_audit(rows, rules), own_path)

    own = _stored(spark, own_path)
    if own is None:
        return
    history.write(own.filter(~F.col("reason").isin(PK_NULL, DUPLICATE)), batch_id)
    files.write_small(listed_counts(own), f"{root}/ledger/batch_id={batch_id}")
    if own.filter(F.col("reason") == OK).isEmpty():
        return
    fresh = kpis.add_date_parts(clean_rows(own).select(*CLEANSED_COLUMNS))
    touched = fresh.select("year", "month").distinct()
    fact = _stored(spark, fact_path)
    to_append = fresh
    if replayed and fact is not None:
        to_append = unseen_keys(fresh, _in_months(fact, touched), KEY)
    append_fact(to_append, fact_path)

    fact = _stored(spark, fact_path)
    if fact is None:
        return
    measures = kpis.measure_form(_in_months(fact, touched))
    by_month = {"totals": kpis.monthly_totals(measures), KPI_MONTHLY: kpis.customer_pairs(measures, KPI_KEYS[KPI_MONTHLY])}
    for name, rows in by_month.items():
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("year", "month").parquet(f"{rollup_path}/{name}")
    for name in (KPI_CATEGORY, KPI_REGIONS):
        # Rows are only ever added, so a customer once met under a key stays: only new pairs are appended.
        pairs = kpis.customer_pairs(kpis.measure_form(fresh), KPI_KEYS[name])
        known = _stored(spark, f"{rollup_path}/{name}")
        new = pairs if known is None else pairs.join(known, pairs.columns, "left_anti")
        new.write.mode("append").parquet(f"{rollup_path}/{name}")
    write_kpis(spark, root)


def refresh_available(
    stream: DataFrame, root: str, checkpoint: str, rules: CleansingRules = CleansingRules()
) -> None:
    """Process the landing rows that arrived since the last call."""
    def fold(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, root, rules)

    writer = stream.writeStream.foreachBatch(fold)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
