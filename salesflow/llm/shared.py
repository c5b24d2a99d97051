"""What several operators share: intermediate tables, fixed-size hashing, text in bounded blocks."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"
BLOCK = 1 << 20
BATCH_ROWS, BATCH_SETTING = "1000", "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the workers of the session, once: tasks import it wherever the driver was started.

    Nothing is sent when the package itself was shipped as an archive. Batches of rows between executors and their Python workers are
    kept small, unless the session sets their size: whole texts stand in them, on both sides.
    """
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    if context.applicationId in _SHIPPED or not (root / "salesflow").is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "salesflow_package.zip"  # on the driver, which serves it to executors
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted((root / "salesflow").rglob("*.py")):
            packed.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that ``spark.checkpoint.dir`` names.

    Only a session on one machine (master ``local`` or ``local[...]``) may leave the setting empty; it then gets a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends and its size is known to the planner."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_key(text: Column) -> Column:
    """SHA-256 of a text, A-Z lowered and null as empty: with ``doc_id`` it tells rows apart where ids are reused."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def without(documents: DataFrame, gone: DataFrame, repeated: DataFrame) -> DataFrame:
    """``documents`` without the rows of ``gone``, and one row for each of ``repeated``; both are stored (dropped_id, dropped_key) rows.

    Of repeated rows that differ in other columns, the last by all columns as JSON stays.
    """
    columns = documents.columns
    keyed = documents.withColumn("_key", text_key(F.col("text")))

    def joined(rows: DataFrame, marks: DataFrame, how: str) -> DataFrame:
        return rows.join(marks, rows["doc_id"].cast("long").eqNullSafe(marks["dropped_id"]) & (rows["_key"] == marks["dropped_key"]), how)

    left = keyed if gone.isEmpty() else joined(keyed, gone, "left_anti")
    if repeated.isEmpty():
        return left.select(*columns)
    whole = F.struct(*columns)
    one = joined(left, repeated, "left_semi").groupBy(F.col("doc_id").cast("long").alias("_id"), "_key").agg(F.max_by(whole, F.to_json(whole)).alias("_row"))
    return joined(left, repeated, "left_anti").select(*columns).unionByName(one.select("_row.*"))


def crc_remainder(identifier: Column, divisor: int) -> Column:
    """CRC-32 of the identifier as text, modulo ``divisor``; null for a null identifier."""
    return F.crc32(identifier.cast("string")) % F.lit(divisor)


def blocks(data: bytes, separators: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """``data`` cut after separator bytes into pieces of about ``size`` bytes.

    A run without any separator stays whole, however long it is, so no word is ever cut.
    """
    if len(data) <= size:
        yield data
        return
    cut = re.compile(b"[" + re.escape(separators) + b"]")
    start = 0
    while start < len(data):
        found = cut.search(data, start + size) if start + size < len(data) else None
        end = found.end() if found else len(data)
        yield data[start:end]
        start = end
