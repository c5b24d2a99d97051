"""Histories of keys that joins read where they lie.

A history is a bucketed table over files, with a partition for each batch. Its side of a join is neither shuffled nor sorted: the batch
goes to the buckets, however long the history has grown. The folder's name holds the number of buckets, so the table can be declared
again by a session that does not know it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.sinks.files import children

BATCH = "batch_id"
_SUFFIX = "_buckets"


class History:
    """``columns`` (name to SQL type) of what earlier batches held, bucketed by ``key``.

    A new history gets as many buckets as the session has shuffle partitions, so that rows already grouped by the key stay where they are.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Mapping[str, str], key: str):
        self.spark, self.path, self.key, self.columns = spark, path, key, list(columns)
        found = [int(name.removesuffix(_SUFFIX)) for name in children(spark, path) if name.endswith(_SUFFIX)]
        self.is_new = not found
        self.buckets = found[0] if found else int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"history_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
        known = spark.catalog.tableExists(self.table)
        if known and self.is_new:  # its files are gone
            spark.sql(f"DROP TABLE {self.table}")
            known = False
        if not known:
            shape = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
            spark.sql(f"CREATE TABLE {self.table} ({shape}, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH}) "
                      f"CLUSTERED BY (`{key}`) INTO {self.buckets} BUCKETS LOCATION '{path}/{self.buckets}{_SUFFIX}'")
            if not self.is_new:
                spark.catalog.recoverPartitions(self.table)

    def read(self, before: int | None = None) -> DataFrame:
        """What batches earlier than ``before`` held, or all."""
        rows = self.spark.table(self.table)
        return rows if before is None else rows.filter(F.col(BATCH) < before)

    def write(self, rows: DataFrame, batch: int) -> None:
        """The rows of one batch, replacing those it wrote before. Each task writes one bucket."""
        view = f"{self.table}_{batch}"
        rows.select(*self.columns).repartition(self.buckets, self.key).createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION ({BATCH} = {batch}) SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)
        self.is_new = False

    def fill(self, rows: DataFrame) -> None:
        """What stands in ``rows``, which name their batch, and nothing else: the whole history is replaced."""
        ordered = rows.select(*self.columns, F.col(BATCH).cast("bigint").alias(BATCH)).repartition(self.buckets, self.key)
        ordered.write.mode("overwrite").insertInto(self.table)
        self.is_new = False

    def next_batch(self) -> int:
        """One more than the last batch, from the partition names alone."""
        names = [row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()]
        return max((int(name.split("=")[1]) for name in names if name.split("=")[1].isdigit()), default=-1) + 1

    def matching(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """The stored rows of the given keys; only the keys move."""
        wanted = keys.select(self.key).distinct().hint("shuffle_hash")
        return self.read(before).join(wanted, self.key, "left_semi")

    def marked(self, rows: DataFrame, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """``rows`` with ``_known``: whether an earlier batch held their key. A NULL key is never known.

        ``keys``, if given, holds the keys of ``rows`` and is cheaper to read than they are to make.
        """
        met = self.matching(rows if keys is None else keys.filter(F.col(self.key).isNotNull()), before).select(self.key).distinct().withColumn("_met", F.lit(True))
        return rows.join(met, self.key, "left").withColumn("_known", F.coalesce("_met", F.lit(False))).select(*rows.columns, "_known")
