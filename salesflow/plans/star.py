"""Sales rows out of an order star schema (lineitem, orders, customer, nation, region, part).

The tables hold no NULLs, so some are derived where a rule needs something to
catch. Cleansing needs the lineitem columns only; the descriptive attributes are
joined to the rows that survive it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.operators.cleanse import classify, clean_rows, standardise
from salesflow.operators.dedup import frequent_keys, spread
from salesflow.operators.kpis import add_date_parts
from salesflow.rules import CONTRACT_COLUMNS, CleansingRules

# Which copy of a transaction came first.
ARRIVAL = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")

# What a transaction's key determines, and most joins go by.
NEAR = "l_orderkey"

# PROMO and AFRICA are left out, so both domain rules have values to replace.
STAR_RULES = CleansingRules(
    categories=("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"),
    regions=("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    first_by=ARRIVAL,
)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _null_every(n: int, number: str, value: Column) -> Column:
    return F.when(F.col(number) % n != 0, value)


def sales_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Key, amount and timestamp of each line, with the foreign keys and the arrival order."""
    return as_sales_lines(table(spark, directory, "lineitem"))


def landing_lines(spark: SparkSession, directory: str, *, near: bool = False) -> DataFrame:
    """Contract rows plus the arrival order. The joins move line columns only; what follows from them is derived behind the joins.

    With ``near`` the rows lie by the order, which stays as a column: they move once for the join with the orders and for the dedup.
    """
    lines = table(spark, directory, "lineitem")
    line = attach_attributes(lines.select("l_orderkey", "l_linenumber", *ARRIVAL), spark, directory, ("product_category",))
    if near:
        line = spread(line, lines.count(), NEAR)  # the count is read from the footers
    attributes = ("customer_id", "product_category", "region")
    full = as_sales_lines(attach_attributes(line, spark, directory, ("customer_id", "region")), *attributes)
    return full.select(*CONTRACT_COLUMNS, *ARRIVAL, *((NEAR,) if near else ()))


def no_order_is_frequent(spark: SparkSession, directory: str) -> bool:
    """Whether no order, and thereby no transaction, holds so many lines that one task should not get them all."""
    return not frequent_keys(table(spark, directory, "lineitem"), NEAR)


def as_sales_lines(line: DataFrame, *further: str) -> DataFrame:
    """The same for any frame of lineitem rows, a streaming one included; ``further`` columns stay."""
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return line.select(
        _null_every(101, "l_orderkey", key).alias("transaction_id"),
        _null_every(89, "l_partkey", F.col("l_extendedprice")).alias("amount"),
        _null_every(83, "l_suppkey", F.col("l_shipdate")).alias("timestamp"),
        "l_orderkey",
        *ARRIVAL,
        *further,
    )


def attach_attributes(
    lines: DataFrame, spark: SparkSession, directory: str,
    columns: Sequence[str] = ("customer_id", "product_category", "region"),
) -> DataFrame:
    """The descriptive columns asked for; a join nobody needs is not planned.

    Each side is looked up by its primary key. Spark broadcasts the sides whose
    measured size allows it and splits skewed partitions of the others. Customers are
    joined to orders, of which there are fewer than lines.
    """
    df = lines
    if "product_category" in columns:
        part = table(spark, directory, "part")
        kind = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product_category"))
        df = df.join(kind, "l_partkey", "left")
    if "customer_id" in columns or "region" in columns:
        orders = table(spark, directory, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        if "region" in columns:
            nation = table(spark, directory, "nation")
            region = table(spark, directory, "region")
            home = (
                table(spark, directory, "customer")
                .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                .select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("region"))
            )
            orders = orders.join(home, "o_custkey", "left")
        df = df.join(orders, "l_orderkey", "left")
    if "customer_id" in columns:
        df = df.withColumn("customer_id", _null_every(97, "o_custkey", F.col("o_custkey").cast("string")))
    return df


def raw_sales(spark: SparkSession, directory: str) -> DataFrame:
    """All lines as rows of the sales contract."""
    return attach_attributes(sales_lines(spark, directory), spark, directory).select(*CONTRACT_COLUMNS)


def checked_lines(spark: SparkSession, directory: str, rules: CleansingRules = STAR_RULES) -> DataFrame:
    """Lines classified by the quality rules."""
    return classify(sales_lines(spark, directory), rules)


def clean_sales(spark: SparkSession, directory: str, columns: Sequence[str] = CONTRACT_COLUMNS) -> DataFrame:
    """Cleansed sales rows with the contract columns asked for."""
    kept = clean_rows(checked_lines(spark, directory))
    attributed = attach_attributes(kept, spark, directory, columns)
    absent = [c for c in ("customer_id", "product_category", "region") if c not in columns]
    filled = attributed.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else attributed
    return standardise(filled, STAR_RULES).select(*columns)


def sales_fact(spark: SparkSession, directory: str, columns: Sequence[str] = CONTRACT_COLUMNS) -> DataFrame:
    """Cleansed rows with year, month and day."""
    return add_date_parts(clean_sales(spark, directory, columns))
