"""The cleanse, curate and load jobs, and a whole run from any source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.operators import kpis, profile
from salesflow.operators.cleanse import (
    judged_copies, keyless_rows, quality_counts, quality_funnel, restored_text, stamp_audit, standardise_kept, step_drops, typed_projection, with_raw_text,
)
from salesflow.operators.dedup import sampled_keys
from salesflow.rules import CLEANSED_COLUMNS, KEY, CleansingRules
from salesflow.sinks import catalog, files, warehouse
from salesflow.sinks.history import BATCH, History
from salesflow.sources.landing import ARRIVAL, apply_contract, read_cleansed, read_fact

# KPI directory names.
KPI_CATEGORY, KPI_MONTHLY, KPI_REGIONS = "revenue_per_category", "monthly_sales_growth", "top_regions_by_volume"
KPI_KEYS = {KPI_CATEGORY: ("product_category",), KPI_MONTHLY: ("year", "month"), KPI_REGIONS: ("region",)}


class EmptyResultError(ValueError):
    """No row passed the quality rules."""


def run_timestamp(text: str | None = None) -> Column:
    """One moment for a whole run. Take it once on the driver and pass it to every step.

    Text without a zone is read in the session's zone.
    """
    return F.current_timestamp() if text is None else F.lit(text).cast("timestamp")


def cleanse(
    spark: SparkSession, source: DataFrame, path: str,
    rules: CleansingRules = CleansingRules(), run_ts: Column | None = None, table: str | None = None, frequent: Sequence[str] | None = None,
    near: Sequence[str] = (),
) -> DataFrame:
    """Type, classify, standardise and write the cleansed zone; returns the classified zone.

    Clean rows, rejects and the funnel are read back from what was written, and
    the catalog table points at the clean directory. Every input row is in the
    zone: rejects as they came, with amount and timestamp also as text in
    ``raw_amount`` and ``raw_timestamp``, and the copies that a first one replaces
    under ``reason=duplicate``, equal ones folded with their number in ``copies``.

    Rows move once, by key. Keys of too many rows for one task, which take another
    way to the same result, are those of ``frequent`` or else found in a sample of ``source``.
    A source that already lies by ``near``, columns that the key determines and the zone does not hold, is not moved.
    """
    typed = typed_projection(with_raw_text(apply_contract(source)), rules)
    busy, rows = sampled_keys(typed, KEY) if frequent is None else (frequent, None)
    judged = judged_copies(typed, rules, busy, near, rows).unionByName(keyless_rows(typed))
    files.write_classified(stamp_audit(standardise_kept(restored_text(judged), rules).drop(*ARRIVAL, *near), rules, run_ts), path)
    if table:
        catalog.register_files(spark, table, f"{path}/reason=ok", CLEANSED_COLUMNS)
    return spark.read.parquet(path)


def curate(
    spark: SparkSession, cleansed: DataFrame, root: str,
    run_ts: Column | None = None, *, full: bool = False,
) -> dict[str, DataFrame]:
    """Merge the cleansed rows into the partitioned fact, then compute the KPIs from the rollup.

    A transaction stands once: rows replace stored ones with their key, also where these lie on another day. An index of keys and
    their days, bucketed by key, tells which days a batch touches; only those are read and written, and only their months are summed
    up again. ``full`` replaces the whole fact instead. The index is written before the fact and lists every day a key ever had, so a run
    that broke off is made good by running it again.
    """
    dated = kpis.add_date_parts(cleansed)
    index = History(spark, f"{root}/days", {KEY: "string", **dict.fromkeys(files.FACT_PARTITIONS, "int")}, KEY)
    fact_path = f"{root}/sales"
    before = None if full else _fact_so_far(spark, fact_path)
    if before is None:
        index.fill(dated.withColumn(BATCH, F.lit(0)))
        files.write_fact(dated, fact_path)
        _roll_up(spark, root, None)
        return write_kpis(spark, root, run_ts)
    whole_rollup = index.is_new  # of a fact without an index, nothing is known to be summed up by month
    if index.is_new:
        index.write(before.filter(F.col(KEY).isNotNull()), 0)
    _roll_up(spark, root, _merge(spark, dated, before, index, fact_path), all_months=whole_rollup)
    return write_kpis(spark, root, run_ts)


def _merge(spark: SparkSession, new: DataFrame, before: DataFrame, index: History, path: str) -> list[tuple[int, int]]:
    """Replace the days that ``new`` touches; returns their months."""
    days = list(files.FACT_PARTITIONS)
    earlier = index.matching(new.select(KEY, *days)).select(*days)
    touched = new.select(*days, F.lit(True).alias("own")).union(earlier.withColumn("own", F.lit(False))).groupBy(*days).agg(F.max("own").alias("own")).collect()  # bounded by the calendar
    index.write(new.select(KEY, *days), index.next_batch())
    number = (F.col("year") * 12 + F.col("month")) * 31 + F.col("day")
    chosen = before.filter(number.isin([(r.year * 12 + r.month) * 31 + r.day for r in touched]))
    stays = chosen.join(new.select(KEY), KEY, "left_anti")
    left_behind = [(r.year, r.month, r.day) for r in touched if not r.own]
    if left_behind:  # days from which every row has moved have none to be overwritten with
        kept = {tuple(r) for r in stays.select(*days).distinct().collect()}
        left_behind = [day for day in left_behind if day not in kept]
    # The days are written beside the old ones and put in their place when all are done, so the plan may read what it replaces.
    files.write_fact(new.unionByName(stays.select(*new.columns)), path, replace_days_only=True)
    files.remove_partitions(spark, path, days, left_behind)
    return sorted({(r.year, r.month) for r in touched})


def _month_number() -> Column:
    return F.col("year") * 12 + F.col("month")


def _roll_up(spark: SparkSession, root: str, months: list[tuple[int, int]] | None, *, all_months: bool = False) -> None:
    """Month totals, and by month the customers under the key of each KPI, from narrow scans of the given months of the fact (None: all)."""
    fact = read_fact(spark, f"{root}/sales")
    every = months is None or all_months
    if not every:
        fact = fact.filter(_month_number().isin([y * 12 + m for y, m in months]))
    measures = kpis.measure_form(fact)
    files.write_months(kpis.monthly_totals(measures), f"{root}/rollup/totals", all_months=every)
    for name, keys in KPI_KEYS.items():
        files.write_months(kpis.customer_pairs(measures, list(dict.fromkeys(("year", "month", *keys)))), f"{root}/rollup/{name}", all_months=every)
    if not every:
        kept = {tuple(r) for r in fact.select("year", "month").distinct().collect()}
        for name in ("totals", *KPI_KEYS):
            files.remove_partitions(spark, f"{root}/rollup/{name}", ("year", "month"), [m for m in months if m not in kept])


def _fact_so_far(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored fact, or None before its first write."""
    try:
        return read_fact(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_kpis(spark: SparkSession, root: str, run_ts: Column | None = None) -> dict[str, DataFrame]:
    """Compute the three KPIs from the rollup, write them and read them back."""
    totals = spark.read.parquet(f"{root}/rollup/totals")
    pairs = {name: spark.read.parquet(f"{root}/rollup/{name}").select(*keys, "customer_id") for name, keys in KPI_KEYS.items()}
    measures = {name: kpis.rolled_measures(totals, pairs[name]) for name in KPI_KEYS}
    made = {
        KPI_CATEGORY: kpis.revenue_per_category(measures[KPI_CATEGORY]),
        KPI_MONTHLY: kpis.monthly_sales_growth(measures[KPI_MONTHLY]),
        KPI_REGIONS: kpis.top_regions(measures[KPI_REGIONS]),
    }
    for name, kpi in made.items():
        files.write_small(kpis.stamp_computed(kpi, run_ts), f"{root}/kpis/{name}")
    return {name: spark.read.parquet(f"{root}/kpis/{name}") for name in made}


def load(
    spark: SparkSession, root: str, database: str, warehouse_root: str, load_id: str, *,
    months: Sequence[tuple[int, int]] | None = None, raise_on_failure: bool = True,
) -> DataFrame:
    """Load the curated fact and KPIs into the warehouse tables; with ``months``, only these months of the fact are read and replaced."""
    def fact() -> DataFrame:
        rows = read_fact(spark, f"{root}/sales")
        return rows if months is None else rows.filter(_month_number().isin([y * 12 + m for y, m in months]))

    frames = {warehouse.FACT_SALES.name: fact}
    for spec, name in (
        (warehouse.KPI_CATEGORY, KPI_CATEGORY),
        (warehouse.KPI_MONTHLY, KPI_MONTHLY),
        (warehouse.KPI_REGIONS, KPI_REGIONS),
    ):
        frames[spec.name] = lambda name=name: spark.read.parquet(f"{root}/kpis/{name}")
    return warehouse.load_all(spark, frames, database, warehouse_root, load_id, months=months, raise_on_failure=raise_on_failure)


def console_summary(made: dict[str, DataFrame], months: int = 6) -> dict[str, DataFrame]:
    """The excerpts a run prints: category revenue, the last months, the top regions."""
    return {
        KPI_CATEGORY: made[KPI_CATEGORY].orderBy(F.desc("total_revenue"))
        .select("product_category", "total_revenue", "revenue_pct"),
        KPI_MONTHLY: kpis.last_months(made[KPI_MONTHLY], months),
        KPI_REGIONS: made[KPI_REGIONS].orderBy("rank", "region")
        .select("rank", "region", "transaction_count", "volume_share_pct"),
    }


@dataclass
class Report:
    """What a run returns: all frames are report-sized and lazy."""

    funnel: DataFrame
    stats: DataFrame
    summary: DataFrame
    kpis: dict[str, DataFrame]
    preview: DataFrame

    def sections(self) -> dict[str, DataFrame]:
        return {"stats": self.funnel, "summary": self.summary, **self.kpis, "raw_preview": self.preview}

    def write(self, path: str) -> None:
        files.write_report(self.sections(), path)


def run(
    spark: SparkSession, source: DataFrame, root: str,
    rules: CleansingRules = CleansingRules(), run_ts: Column | None = None,
    *, on_missing: str = "add_null", preview_rows: int = 100, frequent: Sequence[str] | None = None, near: Sequence[str] = (),
) -> Report:
    """Contract, cleanse, curate and report, from any source frame.

    Raises when the contract is not met or nothing is left. Curating starts only
    after cleansing wrote its zone.
    """
    source = apply_contract(source, on_missing)
    checked = cleanse(spark, source, f"{root}/cleansed", rules, run_ts, frequent=frequent, near=near)
    stats = quality_counts(checked)
    if stats.first()["final"] == 0:
        raise EmptyResultError("no records remained after cleansing")
    cleansed = read_cleansed(spark, f"{root}/cleansed")
    made = curate(spark, cleansed, f"{root}/curated", run_ts, full=True)
    fact = read_fact(spark, f"{root}/curated/sales")
    preview = profile.format_preview(profile.head(fact, preview_rows, ["timestamp", "transaction_id"]))
    return Report(step_drops(quality_funnel(checked)), stats, profile.run_summary(fact), made, preview)
