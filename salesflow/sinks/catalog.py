"""Catalog tables over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def register_files(spark: SparkSession, table: str, path: str, columns: Sequence[str] | None = None) -> None:
    """Create or refresh a table over Parquet files already written; the data is not written again.

    ``columns`` limits what the table shows. New columns in the files are added to
    an existing table, and partitions are recovered. A table over another path is
    made anew over this one; its files stay.
    """
    if spark.catalog.tableExists(table) and _plain_path(_location(spark, table)) != _plain_path(path):
        spark.sql(f"DROP TABLE {table}")
    found = spark.read.parquet(path)
    if columns:
        found = found.select(*columns)
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=found.schema if columns else None)
    else:
        known = set(spark.table(table).columns)
        added = [f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields if f.name not in known]
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def described(spark: SparkSession, table: str, item: str, partition: str | None = None) -> str:
    """One item of the catalog's description of a table or of one of its partitions (``a=1, b=2``); empty if it has none."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}" + (f" PARTITION ({partition})" if partition else ""))
    row = rows.filter(F.col("col_name") == item).first()
    return row["data_type"] if row else ""


def _location(spark: SparkSession, table: str) -> str:
    return described(spark, table, "Location")


def _plain_path(path: str) -> str:
    """A path without the ways to write the local file scheme and a trailing slash."""
    return "/" + path.removeprefix("file:").strip("/") if path.startswith(("/", "file:")) else path.rstrip("/")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables and views of a database by name, with their owner: the database's where the catalog keeps none for tables."""
    found = spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").filter("info_name = 'Owner'").first()
    owner = F.nullif(F.regexp_extract("information", r"(?m)^Owner: (.*)$", 1), F.lit(""))
    listed = spark.sql(f"SHOW TABLE EXTENDED IN {database} LIKE '*'").filter("NOT isTemporary")
    return listed.select("tableName", "namespace", F.coalesce(owner, F.lit(found["info_value"] if found else None)).alias("owner")).orderBy("tableName")
