"""Run summary, distributions, partition inventory, previews and display columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.numbers import average_money
from salesflow.functions.text import compact_currency, full_currency, signed_percent, thousands
from salesflow.rules import CONTRACT_COLUMNS, MONEY, MONEY_TOTAL


def grand_totals(fact: DataFrame) -> DataFrame:
    """Revenue and row count over everything."""
    return fact.agg(
        F.sum(F.col("amount").cast(MONEY)).cast(MONEY_TOTAL).alias("total_revenue"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def run_summary(fact: DataFrame) -> DataFrame:
    """Records, revenue, average and distinct customers of a run."""
    totals = fact.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(F.col("amount").cast(MONEY)).cast(MONEY_TOTAL).alias("total_revenue"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    average = average_money(F.col("total_revenue"), F.col("total_records")).alias("avg_transaction")
    return totals.select("total_records", "total_revenue", average, "unique_customers")


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is not counted."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(F.desc("row_count"), column)


def partition_inventory(fact: DataFrame) -> DataFrame:
    """Number of day partitions and the range of years."""
    days = fact.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))
    return days.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def filter_fact(fact: DataFrame, years: Sequence[int] = (), categories: Sequence[str] = ()) -> DataFrame:
    """Fact rows of the chosen years and categories; the year prunes partitions."""
    if years:
        fact = fact.filter(F.col("year").isin(*years))
    if categories:
        fact = fact.filter(F.col("product_category").isin(*categories))
    return fact


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows under an explicit order."""
    return df.orderBy(*order_by).limit(n)


def format_preview(df: DataFrame) -> DataFrame:
    """Contract columns with the timestamp as text and the amount at two places."""
    shown = df.select(*CONTRACT_COLUMNS)
    return shown.withColumns({
        "timestamp": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"),
        "amount": F.col("amount").cast(MONEY),
    })


def display_categories(categories: DataFrame) -> DataFrame:
    """Category KPI as report text."""
    return categories.select(
        "product_category",
        compact_currency(F.col("total_revenue")).alias("revenue_short"),
        full_currency(F.col("total_revenue")).alias("revenue_text"),
        thousands(F.col("transaction_count")).alias("transactions_text"),
        F.concat(F.col("revenue_pct").cast("string"), F.lit("%")).alias("share_text"),
    )


def display_months(monthly: DataFrame) -> DataFrame:
    """Monthly KPI as report text."""
    return monthly.select(
        "month_label",
        compact_currency(F.col("total_revenue")).alias("revenue_short"),
        thousands(F.col("unique_customers")).alias("customers_text"),
        signed_percent(F.col("mom_growth_pct")).alias("growth_text"),
    )
