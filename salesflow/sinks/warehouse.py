"""Typed warehouse tables: conformance, loading by column name, views.

A load writes a new version of the table's files and then points the table at
it, so readers see the old rows until the new ones are complete, and a failed
load leaves the table as it was. The fact is partitioned by month: a load of some
months writes these and points their partitions at the new files.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.operators.cleanse import complex_to_json
from salesflow.sinks.catalog import described, ensure_database
from salesflow.sinks.files import children, cluster


@dataclass(frozen=True)
class TableSpec:
    """A warehouse table: columns with SQL types, required columns, renames, sort key and partitions.

    ``distinguish`` names a column of many values, which splits rows that are equal in the sort key.
    """

    name: str
    columns: Mapping[str, str]
    required: tuple[str, ...]
    renames: Mapping[str, str] = field(default_factory=dict)
    sort_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    distinguish: tuple[str, ...] = ()

    def ddl(self, database: str, location: str) -> str:
        body = ", ".join(
            f"`{c}` {kind}{' NOT NULL' if c in self.required else ''}" for c, kind in self.columns.items()
        )
        parts = f"PARTITIONED BY ({', '.join(self.partition_by)}) " if self.partition_by else ""
        return f"CREATE TABLE IF NOT EXISTS {database}.{self.name} ({body}) USING parquet {parts}LOCATION '{location}'"


# The warehouse tables, their types and their sort keys.
FACT_SALES = TableSpec(
    "fact_sales",
    {
        "transaction_id": "varchar(36)", "customer_id": "varchar(20)", "product_category": "varchar(50)",
        "amount": "decimal(12,2)", "transaction_ts": "timestamp", "region": "varchar(20)",
        "day": "smallint", "_ingestion_ts": "timestamp", "_source_system": "varchar(60)", "_pipeline_version": "varchar(10)",
        "year": "smallint", "month": "smallint",  # Spark keeps the partition columns last
    },
    required=("transaction_id", "customer_id", "product_category", "amount", "transaction_ts", "region",
              "year", "month", "day"),
    renames={"timestamp": "transaction_ts"},
    sort_by=("transaction_ts", "product_category"),
    partition_by=("year", "month"),
    distinguish=("transaction_id",),
)
KPI_CATEGORY = TableSpec(
    "kpi_revenue_per_category",
    {
        "product_category": "varchar(50)", "total_revenue": "decimal(18,2)", "transaction_count": "bigint",
        "avg_transaction_value": "decimal(12,2)", "min_amount": "decimal(12,2)", "max_amount": "decimal(12,2)",
        "unique_customers": "bigint", "revenue_pct": "decimal(6,2)", "_computed_at": "timestamp",
    },
    required=("product_category", "total_revenue", "transaction_count"),
    sort_by=("total_revenue",),
)
KPI_MONTHLY = TableSpec(
    "kpi_monthly_sales_growth",
    {
        "year": "smallint", "month": "smallint", "month_label": "char(7)", "total_revenue": "decimal(18,2)",
        "transaction_count": "bigint", "unique_customers": "bigint", "avg_transaction_value": "decimal(12,2)",
        "prev_month_revenue": "decimal(18,2)", "mom_growth_pct": "decimal(8,2)", "_computed_at": "timestamp",
    },
    required=("year", "month", "month_label", "total_revenue", "transaction_count"),
    sort_by=("year", "month"),
)
KPI_REGIONS = TableSpec(
    "kpi_top_regions_by_volume",
    {
        "rank": "smallint", "region": "varchar(20)", "transaction_count": "bigint", "total_revenue": "decimal(18,2)",
        "avg_revenue_per_txn": "decimal(12,2)", "unique_customers": "bigint", "volume_share_pct": "decimal(6,2)",
        "revenue_share_pct": "decimal(6,2)", "_computed_at": "timestamp",
    },
    required=("rank", "region", "transaction_count", "total_revenue"),
    sort_by=("rank",),
)
TABLES = (FACT_SALES, KPI_CATEGORY, KPI_MONTHLY, KPI_REGIONS)


def _width(kind: str) -> int | None:
    match = re.fullmatch(r"(?:var)?char\((\d+)\)", kind)
    return int(match.group(1)) if match else None


def _storage_type(kind: str) -> str:
    return "string" if _width(kind) else kind


def by_name(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Source columns under their warehouse names; an absent optional column is NULL."""
    df = complex_to_json(df.withColumnsRenamed(dict(spec.renames)))
    absent = {c: F.lit(None) for c in spec.columns if c not in df.columns and c not in spec.required}
    if absent:
        df = df.withColumns(absent)
    return df.select(*spec.columns)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns in table order and types; a value that does not fit becomes NULL."""
    def fitted(name: str, kind: str) -> Column:
        value, width = F.col(name).try_cast(_storage_type(kind)), _width(kind)
        return (F.when(F.length(value) <= width, value) if width else value).alias(name)

    return by_name(df, spec).select(*[fitted(c, kind) for c, kind in spec.columns.items()])


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per column, how many values do not fit and how many required ones are missing; one pass."""
    named = by_name(df, spec)
    counters = []
    for name, kind in spec.columns.items():
        value, width = F.col(name), _width(kind)
        fits = F.length(value) <= width if width else value.try_cast(kind).isNotNull()
        counters.append(F.count_if(value.isNotNull() & ~fits).alias(f"{name}|unfit"))
        missing = value.isNull() if name in spec.required else F.lit(False)
        counters.append(F.count_if(missing).alias(f"{name}|missing"))
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"`{name}|unfit`").alias("unfit"),
            F.col(f"`{name}|missing`").alias("missing"),
        )
        for name in spec.columns
    ])
    return named.agg(*counters).select(F.inline(rows))


def strict(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Like ``conform``, but a value that does not fit or a missing required value fails the write."""
    def checked(name: str, kind: str) -> Column:
        value, width = F.col(name).cast(_storage_type(kind)), _width(kind)
        if width:
            too_long = F.raise_error(F.concat(F.lit(f"{spec.name}.{name} longer than {width}: "), value))
            value = F.when(F.length(value) > width, too_long).otherwise(value)
        if name in spec.required:
            value = F.when(F.col(name).isNull(), F.raise_error(F.lit(f"{spec.name}.{name} is missing"))).otherwise(value)
        return value.alias(name)

    return by_name(df, spec).select(*[checked(c, kind) for c, kind in spec.columns.items()])


def create_tables(spark: SparkSession, database: str, root: str) -> None:
    """The empty typed tables, unless they exist already."""
    ensure_database(spark, database)
    for spec in TABLES:
        spark.sql(spec.ddl(database, f"{root}/{spec.name}/empty"))


def load_table(
    spark: SparkSession, df: DataFrame, spec: TableSpec, database: str, root: str, load_id: str,
    months: Sequence[tuple[int, int]] | None = None,
) -> int:
    """Replace the rows of one table, refresh its statistics and return its row count.

    With ``months`` (year and month), ``df`` holds the rows of these months of a partitioned table, and all others stay as they
    are; a month without rows goes. The count comes from the statistics, which for new files read their footers only.
    """
    version, table = f"{root}/{spec.name}/load={load_id}", f"{database}.{spec.name}"
    rows = strict(df, spec)
    if spec.partition_by:
        ordered = cluster(rows, (*spec.partition_by, *spec.sort_by, *spec.distinguish))
        ordered.write.mode("overwrite").partitionBy(*spec.partition_by).parquet(version)
        spark.sql(spec.ddl(database, f"{root}/{spec.name}/empty"))
        return _swap_partitions(spark, table, spec, version, months)
    if spec.sort_by:
        rows = rows.sortWithinPartitions(*spec.sort_by)
    rows.write.mode("overwrite").parquet(version)
    spark.sql(spec.ddl(database, version))
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    spark.catalog.refreshTable(table)
    _analyse(spark, table)
    return _row_count(described(spark, table, "Statistics"))


def _swap_partitions(spark: SparkSession, table: str, spec: TableSpec, version: str, months: Sequence[tuple[int, int]] | None) -> int:
    """Point the partitions at the files of ``version``; of the others, those that the load covers go. Partitions are months, so the calendar bounds the loops."""
    def named(path: str) -> str:
        return ", ".join(path.split("/"))

    written = {f"{year}/{month}" for year in children(spark, version) if "=" in year for month in children(spark, f"{version}/{year}")}
    present = {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    covered = present if months is None else {"/".join(f"{c}={v}" for c, v in zip(spec.partition_by, m)) for m in months}
    if months is not None and written - covered:
        raise ValueError(f"rows outside the months to load: {sorted(written - covered)}")
    for part in sorted(written & present):
        spark.sql(f"ALTER TABLE {table} PARTITION ({named(part)}) SET LOCATION '{version}/{part}'")
    if written - present:
        added = " ".join(f"PARTITION ({named(part)}) LOCATION '{version}/{part}'" for part in sorted(written - present))
        spark.sql(f"ALTER TABLE {table} ADD {added}")
    gone = (covered & present) - written
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP {', '.join(f'PARTITION ({named(part)})' for part in sorted(gone))}")
    spark.catalog.refreshTable(table)
    if months is None:
        _analyse(spark, f"{table} PARTITION ({', '.join(spec.partition_by)})")
    else:
        for part in sorted(written):
            _analyse(spark, f"{table} PARTITION ({named(part)})")
    kept = (present | written) - gone
    return sum(_row_count(described(spark, table, "Partition Statistics", named(part))) for part in kept)


def _analyse(spark: SparkSession, what: str) -> None:
    """Sizes first: where a size changes but the number of rows does not, one step alone would lose the number."""
    spark.sql(f"ANALYZE TABLE {what} COMPUTE STATISTICS NOSCAN")
    spark.sql(f"ANALYZE TABLE {what} COMPUTE STATISTICS")


def _row_count(statistics: str) -> int:
    """Rows by a table's or partition's statistics, such as ``1024 bytes, 12 rows``."""
    match = re.search(r"(\d+) rows", statistics)
    if not match:
        raise ValueError(f"no row count in the statistics: {statistics!r}")
    return int(match.group(1))


class LoadError(RuntimeError):
    """Some tables did not load; ``status`` tells which and why."""

    def __init__(self, failed: list[str], status: DataFrame):
        super().__init__(f"load failed for: {failed}")
        self.status = status


def load_all(
    spark: SparkSession,
    frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
    database: str,
    root: str,
    load_id: str,
    *,
    months: Sequence[tuple[int, int]] | None = None,
    raise_on_failure: bool = True,
) -> DataFrame:
    """Load every table from a frame or a function that opens it; a failure is recorded, the rest still load, and the failures are raised at the end.

    ``months`` limits the load of partitioned tables to these; the others are replaced.
    """
    ensure_database(spark, database)
    outcome = []
    for spec in TABLES:
        try:
            frame = frames[spec.name]
            rows = load_table(spark, frame() if callable(frame) else frame, spec, database, root, load_id, months if spec.partition_by else None)
            outcome.append((spec.name, "SUCCESS", rows, None))
        except Exception as problem:  # any failure of one table must not stop the others
            outcome.append((spec.name, "FAILED", None, str(problem).splitlines()[0]))
    status = spark.createDataFrame(outcome, "table_name string, status string, row_count bigint, error string")
    failed = [name for name, state, _, _ in outcome if state == "FAILED"]
    if failed and raise_on_failure:
        raise LoadError(failed, status)
    return status


def create_views(spark: SparkSession, database: str) -> None:
    """The three analytical views over the warehouse tables. Order them when reading."""
    spark.sql(f"""
        CREATE OR REPLACE VIEW {database}.v_sales_summary AS
        SELECT year, month, product_category, region,
               count(transaction_id) AS transaction_count,
               sum(amount) AS total_revenue,
               round(sum(amount) / count(amount), 2) AS avg_order_value,
               count(DISTINCT customer_id) AS unique_customers
        FROM {database}.fact_sales
        GROUP BY year, month, product_category, region""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW {database}.v_category_performance AS
        SELECT product_category, total_revenue, transaction_count, avg_transaction_value,
               revenue_pct, unique_customers, rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank
        FROM {database}.kpi_revenue_per_category""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW {database}.v_growth_trend AS
        SELECT month_label, total_revenue, mom_growth_pct,
               CASE WHEN mom_growth_pct > 0 THEN 'GROWTH' WHEN mom_growth_pct < 0 THEN 'DECLINE'
                    WHEN mom_growth_pct = 0 THEN 'FLAT' ELSE 'BASELINE' END AS growth_status
        FROM {database}.kpi_monthly_sales_growth""")
