"""Landing CSV, CSV text, records, Parquet zones and schema discovery."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.operators.cleanse import add_missing_columns, clean_rows, fill_blank_ids, typed_projection
from salesflow.rules import CLEANSED_COLUMNS, CONTRACT_COLUMNS, TEXT_SCHEMA, TYPED_SCHEMA, CleansingRules
from salesflow.sinks.scratch import scratch_path

CORRUPT = "_corrupt_record"
ARRIVAL = ("_arrival_file", "_arrival_block", "_arrival_row")
# ISO 8601 forms read beside the landing format.
ISO_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd")


class ContractError(ValueError):
    """The input does not carry the columns the contract asks for."""


def read_landing_csv(
    spark: SparkSession,
    path: str,
    *,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Landing CSV as text columns named by the header.

    A file whose header differs from the first one (or from ``columns``) fails the
    read instead of shifting values. Rows of the wrong length are padded or
    trimmed; ``keep_corrupt`` adds the raw line of each such row as
    ``_corrupt_record``. ``multi_line`` allows quoted line breaks but makes every
    file one task, so it is off unless asked for; without it, files that hold such
    a break fail the read (one more scan of the text looks for them) unless
    malformed rows are kept apart.
    """
    if not multi_line and not keep_corrupt and not open_quotes(spark, path).isEmpty():
        raise ContractError("a quoted value holds a line break: read with multi_line, or keep_corrupt to set such rows apart")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or csv_header(spark, path)])
    if keep_corrupt:
        schema = schema.add(CORRUPT, T.StringType())
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def open_quotes(spark: SparkSession, path: str) -> DataFrame:
    """Lines with an odd number of quotes: a quoted value is cut there."""
    return spark.read.text(path).filter(_odd_quotes(F.col("value")))


def _odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def with_arrival(df: DataFrame) -> DataFrame:
    """Rows of files with ARRIVAL: file, block and row number, which order them as they stand in the files."""
    return df.withColumns({ARRIVAL[0]: F.col("_metadata.file_path"), ARRIVAL[1]: F.col("_metadata.file_block_start"), ARRIVAL[2]: F.monotonically_increasing_id()})


def with_iso_times(rules: CleansingRules) -> CleansingRules:
    """Rules that also read ISO 8601 timestamps, as uploads and records carry them."""
    return replace(rules, timestamp_formats=(*rules.timestamp_formats, *ISO_FORMATS))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV dataset; reads one line."""
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path).columns


def parse_landing_lines(lines: DataFrame, columns: Sequence[str] = CONTRACT_COLUMNS) -> DataFrame:
    """Lines of landing files in a ``value`` column as text columns, with the raw line of a malformed row in ``_corrupt_record``.

    Malformed is a line of the wrong length, or with an odd number of quotes: a quoted value is cut at a line break there, and
    both its ends are kept apart, so no value shifts. (A line in the middle of such a value that happens to
    hold as many fields as a row cannot be told from one.) Header lines and blank lines go; a header with the
    columns in another order fails the read. Works on batches and streams, a line at a time, so large files are split. Further columns stay.
    """
    schema = ", ".join(f"`{c}` string" for c in (*columns, CORRUPT))
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [c for c in lines.columns if c != "value"]
    text = lines.filter(F.trim("value") != "").select(F.regexp_replace("value", r"\r$", "").alias("_line"), *others)
    parsed = text.withColumn("_row", F.from_csv("_line", F.lit(schema), options))
    values = F.array(*[F.col("_row")[c] for c in columns])
    names = F.array(*[F.lit(c) for c in columns])
    header = F.col("_row")[CORRUPT].isNull() & F.coalesce(F.array_sort(values) == F.array_sort(names), F.lit(False))
    other = F.raise_error(F.concat(F.lit("a file has another header: "), F.col("_line"))).cast("boolean")
    rows = parsed.filter(F.when(~header, True).when(values == names, False).otherwise(other))
    broken = F.col("_row")[CORRUPT].isNotNull() | _odd_quotes(F.col("_line"))
    kept = [F.when(~broken, F.col("_row")[c]).alias(c) for c in columns]
    return rows.select(*kept, *others, F.when(broken, F.col("_line")).alias(CORRUPT))


def read_landing_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landing CSV by lines, in one pass: columns as the first file's header names them, ARRIVAL, and malformed lines in ``_corrupt_record``."""
    columns = csv_header(spark, path)
    lines = with_arrival(spark.read.text(path))
    return parse_landing_lines(lines, columns)


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the malformed rows with their raw line."""
    good = raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, raw.filter(F.col(CORRUPT).isNotNull())


def missing_columns(df: DataFrame, required: Sequence[str] = CONTRACT_COLUMNS) -> list[str]:
    return sorted(set(required) - set(df.columns))


def apply_contract(df: DataFrame, on_missing: str = "fail") -> DataFrame:
    """Check the contract columns: ``fail`` raises, ``add_null`` fills absent ones with NULL."""
    absent = missing_columns(df)
    if absent and on_missing == "fail":
        raise ContractError(f"missing columns: {absent}")
    return add_missing_columns(df).select(*CONTRACT_COLUMNS, *[c for c in df.columns if c not in CONTRACT_COLUMNS])


def read_uploaded_csv(
    spark: SparkSession,
    path: str,
    rules: CleansingRules = CleansingRules(),
    on_missing: str = "fail",
    multi_line: bool = False,
) -> DataFrame:
    """A CSV whose header decides the column order: contract check, then typing."""
    raw = read_landing_csv(spark, path, multi_line=multi_line)
    return typed_projection(apply_contract(raw, on_missing).select(*CONTRACT_COLUMNS), with_iso_times(rules))


def parse_csv_lines(lines: DataFrame, columns: Sequence[str] = CONTRACT_COLUMNS) -> DataFrame:
    """CSV records without a header held in a ``value`` column, one per row, parsed where they lie."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv(F.col("value"), F.lit(schema), {"escape": '"', "mode": "PERMISSIVE"})
    return lines.select(parsed.alias("row")).select("row.*")


def read_csv_payload(spark: SparkSession, path: str, rules: CleansingRules = CleansingRules()) -> DataFrame:
    """Stored CSV payloads, each file with a header in any order, typed; absent contract columns are NULL.

    The header is the first line wherever it stands in quotes or after blanks, and quoted line breaks stay inside their record.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("ignoreLeadingWhiteSpace", True).csv(path)
    named = raw.toDF(*[c.strip().strip('"') for c in raw.columns])
    return typed_projection(apply_contract(named, "add_null").select(*CONTRACT_COLUMNS), with_iso_times(rules))


def read_csv_text(spark: SparkSession, text: str, rules: CleansingRules = CleansingRules()) -> DataFrame:
    """CSV text the caller holds, such as a request body: stored as one payload, then read by Spark."""
    if not text.strip():
        raise ContractError("no rows provided")
    path = scratch_path(spark, "payload")
    spark.createDataFrame([(text.lstrip("\r\n"),)], "value string").coalesce(1).write.text(path)
    return read_csv_payload(spark, path, rules)


def from_records(
    df: DataFrame,
    rules: CleansingRules = CleansingRules(),
    *,
    default_ts: Column | None = None,
    fill_ids: bool = False,
) -> DataFrame:
    """Record rows (JSON, manual entry) as typed rows.

    Timestamps may also be ISO 8601. ``default_ts`` replaces those that are absent or do not parse;
    ``fill_ids`` gives blank transaction ids a fresh UUID.
    """
    if fill_ids:
        df = fill_blank_ids(df)
    typed = typed_projection(apply_contract(df, "add_null"), with_iso_times(rules))
    if default_ts is not None:
        typed = typed.withColumn("timestamp", F.coalesce("timestamp", default_ts))
    return typed


def read_records(spark: SparkSession, path: str, rules: CleansingRules = CleansingRules(), **options) -> DataFrame:
    """JSON lines with the contract names; values may be numbers or text."""
    return from_records(spark.read.schema(TEXT_SCHEMA).json(path), rules, **options)


def records_from_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """A handful of row dicts, as typed in by hand; no rows is an error."""
    if not rows:
        raise ContractError("no rows provided")
    text = [{k: None if v is None else str(v) for k, v in row.items()} for row in rows]
    present = [c for c in CONTRACT_COLUMNS if any(c in row for row in text)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in present])
    return spark.createDataFrame([tuple(row.get(c) for c in present) for row in text], schema)


def read_cleansed(spark: SparkSession, path: str) -> DataFrame:
    """Clean rows of a classified zone; the filter prunes to the ``ok`` directory."""
    return clean_rows(spark.read.parquet(path)).select(*CLEANSED_COLUMNS)


def read_fact(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame:
    """The fact with its partitions discovered from the path.

    ``merge_schema`` combines files of compatible schemas; it opens every footer.
    """
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def in_months(df: DataFrame, months: DataFrame) -> DataFrame:
    """Rows of the listed months. The months are calendar-bounded, so they become a partition filter."""
    wanted = [row.month_no for row in months.select((F.col("year") * 12 + F.col("month")).alias("month_no")).distinct().collect()]
    return df.filter((F.col("year") * 12 + F.col("month")).isin(wanted))


def discover_csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """Types inferred from all rows of a landing CSV, header names included."""
    return spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(path).schema


# The types a column can have, from narrow to wide. Each is a bit; bits a value does not fit are set.
_KINDS = ("int", "bigint", "double", "date", "timestamp", "boolean")
_NUMBERS, _TIMES = ("int", "bigint", "double"), ("date", "timestamp")


def _unfit_kinds(value: Column) -> Column:
    """Bit ``i`` is set where a value does not read as type ``i``; 0 for NULL and blanks, which fit all."""
    trimmed = F.trim(value)
    plain_number = trimmed.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    whole = trimmed.rlike(r"^[+-]?\d+$")
    fits = {
        "int": whole & trimmed.try_cast("int").isNotNull(), "bigint": whole & trimmed.try_cast("bigint").isNotNull(),
        "double": plain_number, "date": trimmed.rlike(r"^\d{4}-\d{2}-\d{2}$") & trimmed.try_cast("date").isNotNull(),
        "timestamp": trimmed.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}.*)?$") & trimmed.try_cast("timestamp").isNotNull(),
        "boolean": F.lower(trimmed).isin("true", "false"),
    }
    bits = F.lit(0)
    for i, kind in enumerate(_KINDS):
        bits = bits + F.when(fits[kind], 0).otherwise(1 << i)
    return F.when(value.isNull() | (trimmed == ""), 0).otherwise(bits)


def _narrowest(unfit: Column) -> Column:
    """The narrowest type that all values fit; ``void`` if every type does, since there was no value."""
    kind = F.when(unfit == 0, "void")
    for i, name in enumerate(_KINDS):
        kind = kind.when(unfit.bitwiseAND(1 << i) == 0, name)
    return kind.otherwise("string")


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """The columns of every CSV file below ``path`` under its own header: ``file``, ``column_name``, ``found_type``, ``unfit``.

    Two passes over the text. The first finds each file's header, its first line, wherever tasks cut the file; the second tests
    every value against every type and keeps a bit per type and column, a fixed-width sum per file. A row's fields beyond
    its file's header are left out.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row_no"))
    first = lines.filter("block = 0").groupBy("file").agg(F.min(F.struct("row_no", "value")).alias("first"))
    headers = first.select("file", F.col("first.row_no").alias("head_no"), _fields("first.value", _widest(first)).alias("names"))
    width = headers.agg(F.max(F.size("names"))).first()[0] or 0
    numbered = lines.join(headers.select("file", "head_no"), "file", "left").filter("NOT (block = 0 AND row_no = head_no) AND trim(value) <> ''")
    values = numbered.select("file", _fields("value", width, keep_short=True).alias("v"))
    masks = values.groupBy("file").agg(*[F.bit_or(_unfit_kinds(F.col("v")[i])).alias(f"c{i}") for i in range(width)])
    found = headers.join(masks, "file", "left").select("file", F.posexplode("names").alias("position", "column_name"), F.array(*[F.col(f"c{i}") for i in range(width)]).alias("masks"))
    unfit = F.coalesce(F.col("masks")[F.col("position")], F.lit(0))
    return found.select("file", F.coalesce(F.trim("column_name"), F.concat(F.lit("_c"), "position")).alias("column_name"), _narrowest(unfit).alias("found_type"), unfit.alias("unfit"))


def _widest(first: DataFrame) -> int:
    """An upper bound of the fields in the first lines: one more than the commas of any."""
    commas = F.length("first.value") - F.length(F.replace(F.col("first.value"), F.lit(","), F.lit("")))
    return (first.agg(F.max(commas)).first()[0] or 0) + 1


def _fields(line: str, width: int, keep_short: bool = False) -> Column:
    """The fields of a CSV line, at most ``width``; without ``keep_short``, the fields after the last present one are cut off."""
    schema = ", ".join(f"c{i} string" for i in range(width)) or "c0 string"
    row = F.from_csv(F.col(line), F.lit(schema), {"escape": '"', "mode": "PERMISSIVE"})
    fields = F.array(*[row[f"c{i}"] for i in range(max(width, 1))])
    last = F.array_max(F.transform(fields, lambda field, i: F.when(field.isNotNull(), i + 1).otherwise(0)))
    return fields if keep_short else F.slice(fields, 1, last)


def _all_of(met: str, family: Sequence[str]) -> Column:
    return F.forall(met, lambda kind: kind.isin(*family))


def combine_schemas(found: DataFrame) -> DataFrame:
    """The schemas of all files as one: per column its joined type, the files that hold it, and whether their types are compatible.

    Numbers widen to ``double``, dates to ``timestamp``, and a column without values takes on any type. Other differences have no
    common type but ``string`` and are listed as not compatible, with the types met.
    """
    joined = found.groupBy("column_name").agg(
        F.bit_or("unfit").alias("_all"), F.count_distinct("file").alias("files"),
        F.array_sort(F.collect_set(F.when(F.col("found_type") != "void", F.col("found_type")))).alias("met"))  # at most seven types
    compatible = _all_of("met", _NUMBERS) | _all_of("met", _TIMES) | (F.size("met") <= 1)
    return joined.select("column_name", F.when(F.size("met") == 0, "string").otherwise(_narrowest(F.col("_all"))).alias("joined_type"),
                         "files", F.array_join("met", ",").alias("types_met"), compatible.alias("compatible"))


def compare_with_contract(spark: SparkSession, found: T.StructType) -> DataFrame:
    """Each contract column with the discovered and the agreed type."""
    kinds = {f.name: f.dataType.simpleString() for f in found.fields}
    rows = [
        (f.name, kinds.get(f.name), f.dataType.simpleString(), kinds.get(f.name) == f.dataType.simpleString())
        for f in TYPED_SCHEMA.fields
    ]
    return spark.createDataFrame(rows, "column_name string, found_type string, contract_type string, matches boolean")
