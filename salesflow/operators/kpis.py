"""Date parts, the measure form and the three KPIs.

Measure form is what the KPIs aggregate: ``revenue``, ``txns``, ``low``, ``high``
next to the grouping columns and ``customer_id``. Fact rows and the stored rollup
both come in this form, so each KPI is written once. The rollup holds totals
without the customer, a few thousand rows, and for each KPI the distinct pairs of
its key and customer, from which the exact customer counts come. Averages are derived from
sum and count. A distinct count is grouped by (key, customer) first, so neither
a hot key nor the ``UNKNOWN`` customer gathers in one task.

The windows below run over aggregates: one row per category, region or calendar
month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.functions.numbers import average_money, growth_percent, percent_of
from salesflow.functions.text import growth_direction, growth_status, month_label
from salesflow.rules import MONEY, MONEY_TOTAL

ROLLUP_KEYS = ("year", "month", "product_category", "region", "customer_id")


def add_date_parts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """``year``, ``month``, ``day`` of a timestamp."""
    moment = F.col(column)
    return df.withColumns({"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)})


def measure_form(fact: DataFrame) -> DataFrame:
    """Fact rows as measures."""
    amount = F.col("amount").cast(MONEY)
    dimensions = [c for c in ROLLUP_KEYS if c in fact.columns]
    return fact.select(
        *dimensions,
        amount.alias("revenue"),
        F.col("transaction_id").isNotNull().cast("bigint").alias("txns"),
        amount.alias("low"),
        amount.alias("high"),
    )


def monthly_rollup(measures: DataFrame) -> DataFrame:
    """Measures per month, category, region and customer: the one pass over the fact behind all KPIs."""
    return measures.groupBy(*ROLLUP_KEYS).agg(
        F.sum("revenue").cast(MONEY_TOTAL).alias("revenue"),
        F.sum("txns").alias("txns"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


TOTAL_KEYS = ("year", "month", "product_category", "region")


def monthly_totals(measures: DataFrame) -> DataFrame:
    """Measures per month, category and region; they add up to those of any of the three."""
    return measures.groupBy(*TOTAL_KEYS).agg(
        F.sum("revenue").cast(MONEY_TOTAL).alias("revenue"),
        F.sum("txns").alias("txns"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def customer_pairs(measures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each customer once under every key they bought in."""
    return measures.select(*keys, "customer_id").distinct()


def rolled_measures(totals: DataFrame, pairs: DataFrame) -> DataFrame:
    """Measure form from the rollup, for KPIs grouped by the columns of ``pairs`` beside the customer."""
    keys = [c for c in pairs.columns if c != "customer_id"]
    kinds = {f.name: f.dataType for f in totals.schema.fields}
    summed = totals.select(*keys, F.lit(None).cast("string").alias("customer_id"), "revenue", "txns", "low", "high")
    present = pairs.select(*keys, "customer_id", *[F.lit(0 if c == "txns" else None).cast(kinds[c]).alias(c) for c in ("revenue", "txns", "low", "high")])
    return summed.unionByName(present)


def _total_revenue() -> Column:
    return F.sum("revenue").cast(MONEY_TOTAL).alias("total_revenue")


def _transactions() -> Column:
    return F.sum("txns").alias("transaction_count")


def _customers() -> Column:
    return F.countDistinct("customer_id").alias("unique_customers")


def stamp_computed(kpi: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return kpi.withColumn("_computed_at", F.current_timestamp() if run_ts is None else run_ts)


def revenue_per_category(measures: DataFrame) -> DataFrame:
    """Revenue, volume, average, range, customers and revenue share per category."""
    totals = measures.groupBy("product_category").agg(
        _total_revenue(), _transactions(),
        F.min("low").cast(MONEY).alias("min_amount"),
        F.max("high").cast(MONEY).alias("max_amount"),
        _customers(),
    )
    grand_total = F.sum("total_revenue").over(Window.partitionBy())
    return totals.select(
        "product_category", "total_revenue", "transaction_count",
        average_money(F.col("total_revenue"), F.col("transaction_count")).alias("avg_transaction_value"),
        "min_amount", "max_amount", "unique_customers",
        percent_of(F.col("total_revenue"), grand_total).alias("revenue_pct"),
    ).orderBy(F.desc("total_revenue"))


def monthly_base(measures: DataFrame) -> DataFrame:
    """Month totals without the comparison to the month before."""
    return measures.groupBy("year", "month").agg(_total_revenue(), _transactions(), _customers())


def compare_months(monthly: DataFrame) -> DataFrame:
    """Average, label and growth against the previous month present in the data."""
    calendar = Window.orderBy("year", "month")
    previous = F.lag("total_revenue", 1).over(calendar)
    return monthly.select(
        "year", "month", "total_revenue", "transaction_count", "unique_customers",
        average_money(F.col("total_revenue"), F.col("transaction_count")).alias("avg_transaction_value"),
        month_label(F.col("year"), F.col("month")).alias("month_label"),
        previous.alias("prev_month_revenue"),
    ).withColumn(
        "mom_growth_pct", growth_percent(F.col("total_revenue"), F.col("prev_month_revenue"))
    ).orderBy("year", "month")


def monthly_sales_growth(measures: DataFrame) -> DataFrame:
    """Month totals with month-over-month growth."""
    return compare_months(monthly_base(measures))


def regions_by_volume(measures: DataFrame) -> DataFrame:
    """Every region with its volume, revenue and both shares."""
    totals = measures.groupBy("region").agg(_transactions(), _total_revenue(), _customers())
    everywhere = Window.partitionBy()
    return totals.select(
        "region", "transaction_count", "total_revenue",
        average_money(F.col("total_revenue"), F.col("transaction_count")).alias("avg_revenue_per_txn"),
        "unique_customers",
        percent_of(F.col("transaction_count"), F.sum("transaction_count").over(everywhere)).alias("volume_share_pct"),
        percent_of(F.col("total_revenue"), F.sum("total_revenue").over(everywhere)).alias("revenue_share_pct"),
    )


def top_regions(measures: DataFrame, top: int = 5, ties: bool = True) -> DataFrame:
    """The regions with most transactions.

    With ``ties`` equal counts share a rank and more than ``top`` rows can come
    back; without, ranks are 1..n and the region name breaks ties.
    """
    if ties:
        position = F.rank().over(Window.orderBy(F.desc("transaction_count")))
    else:
        position = F.row_number().over(Window.orderBy(F.desc("transaction_count"), "region"))
    ranked = regions_by_volume(measures).withColumn("rank", position)
    return ranked.filter(F.col("rank") <= top).orderBy("rank", "region")


def last_months(monthly: DataFrame, months: int = 6) -> DataFrame:
    """The most recent months, newest first."""
    recent = monthly.orderBy(F.desc("year"), F.desc("month")).limit(months)
    return recent.select("month_label", "total_revenue", "mom_growth_pct")


def sales_summary(measures: DataFrame) -> DataFrame:
    """Volume, revenue, average and customers per month, category and region."""
    keys = ["year", "month", "product_category", "region"]
    totals = measures.groupBy(*keys).agg(_transactions(), _total_revenue(), _customers())
    average = average_money(F.col("total_revenue"), F.col("transaction_count")).alias("avg_order_value")
    return totals.select(*keys, "transaction_count", "total_revenue", average, "unique_customers")


def category_performance(categories: DataFrame) -> DataFrame:
    """Category KPI with its revenue rank."""
    rank = F.rank().over(Window.orderBy(F.desc("total_revenue"))).alias("revenue_rank")
    return categories.select(
        "product_category", "total_revenue", "transaction_count", "avg_transaction_value",
        "revenue_pct", "unique_customers", rank,
    )


def growth_trend(monthly: DataFrame) -> DataFrame:
    """Monthly KPI with a trend word."""
    return monthly.orderBy("year", "month").select(
        "month_label", "total_revenue", "mom_growth_pct",
        growth_status(F.col("mom_growth_pct")).alias("growth_status"),
    )


def growth_flags(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "month_label", "mom_growth_pct", growth_direction(F.col("mom_growth_pct")).alias("direction"),
    )


def size_by_customers(regions: DataFrame, scale: float = 60.0, floor: float = 20.0) -> DataFrame:
    """Marker size of each listed region: its customers against the largest, scaled."""
    largest = F.max("unique_customers").over(Window.partitionBy())
    return regions.withColumn("marker_size", F.col("unique_customers") / largest * scale + floor)
