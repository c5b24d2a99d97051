"""The data contract and the business rules, as plain configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names, domains, bounds and tags every zone agrees on.
KEY = "transaction_id"
CONTRACT_COLUMNS = (
    "transaction_id", "customer_id", "product_category", "amount", "timestamp", "region",
)
AUDIT_COLUMNS = ("_ingestion_ts", "_source_system", "_pipeline_version")
CLEANSED_COLUMNS = CONTRACT_COLUMNS + AUDIT_COLUMNS
CATEGORIES = (
    "Electronics", "Clothing", "Books", "Home & Garden", "Sports",
    "Toys", "Automotive", "Food & Beverage", "Health & Beauty", "Office Supplies",
)
CATEGORY_WEIGHTS = (0.20, 0.15, 0.10, 0.12, 0.08, 0.08, 0.07, 0.10, 0.06, 0.04)
REGIONS = (
    "us-east-1", "us-west-2", "eu-west-1", "ap-southeast-1",
    "ap-northeast-1", "sa-east-1", "ca-central-1",
)
REGION_WEIGHTS = (0.30, 0.20, 0.15, 0.12, 0.10, 0.07, 0.06)
AMOUNT_LOW, AMOUNT_HIGH = 1.0, 50_000.0
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
UNKNOWN = "UNKNOWN"
SOURCE_SYSTEM = "sales_csv_landing"
PIPELINE_VERSION = "1.0.0"

MONEY = "decimal(12,2)"
MONEY_TOTAL = "decimal(22,2)"
PERCENT = "decimal(20,2)"

TYPED_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("region", T.StringType()),
])
TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CONTRACT_COLUMNS])


@dataclass(frozen=True)
class CleansingRules:
    """Everything a cleansing run may vary.

    ``first_by`` names the columns that decide which copy of a transaction came
    first; the remaining columns break ties, so the survivor never depends on
    task order. ``prefer_valid_copy`` lets a later valid copy replace an invalid
    first one; the default keeps the first copy whatever its validity.
    """

    categories: tuple[str, ...] = CATEGORIES
    regions: tuple[str, ...] = REGIONS
    amount_low: float = AMOUNT_LOW
    amount_high: float = AMOUNT_HIGH
    timestamp_formats: tuple[str, ...] = (TIMESTAMP_FORMAT,)
    first_by: tuple[str, ...] = ()
    prefer_valid_copy: bool = False
    source_system: str = SOURCE_SYSTEM
    pipeline_version: str = PIPELINE_VERSION
