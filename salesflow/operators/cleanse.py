"""Typing, validation, normalisation and the quality funnel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from salesflow.functions.numbers import ratio_half_up
from salesflow.functions.parsing import to_moment, to_number
from salesflow.operators.dedup import first_per_key, listed_copies
from salesflow.rules import CONTRACT_COLUMNS, KEY, MONEY, UNKNOWN, CleansingRules

# Reasons in the order the rules are applied.
PK_NULL = "pk_null"
DUPLICATE = "duplicate"
AMOUNT_INVALID = "amount_invalid"
TIMESTAMP_NULL = "timestamp_null"
OK = "ok"


def typed_projection(df: DataFrame, rules: CleansingRules = CleansingRules()) -> DataFrame:
    """Cast the contract columns; other columns (such as ``first_by``) pass through."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def typed(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name == "amount":
            return to_number(column, kinds[name]).alias(name)
        if name == "timestamp":
            return to_moment(column, kinds[name], rules.timestamp_formats).alias(name)
        return column.cast("string").alias(name)

    extra = [F.col(f"`{c}`") for c in df.columns if c not in CONTRACT_COLUMNS]
    return df.select(*[typed(c) for c in CONTRACT_COLUMNS if c in kinds], *extra)


def add_missing_columns(df: DataFrame, columns: Sequence[str] = CONTRACT_COLUMNS) -> DataFrame:
    """Each absent contract column as NULL text."""
    absent = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def amount_is_valid(rules: CleansingRules) -> Column:
    """Amount present and within bounds, compared before it is narrowed to cents."""
    return F.coalesce(F.col("amount").between(rules.amount_low, rules.amount_high), F.lit(False))


def with_key(df: DataFrame) -> DataFrame:
    return df.filter(F.col(KEY).isNotNull())


def with_valid_amount(df: DataFrame, rules: CleansingRules = CleansingRules()) -> DataFrame:
    return df.filter(amount_is_valid(rules))


def with_timestamp(df: DataFrame) -> DataFrame:
    return df.filter(F.col("timestamp").isNotNull())


def normalise_domain(df: DataFrame, column: str, domain: Sequence[str] | DataFrame) -> DataFrame:
    """Values outside the domain, and NULL, become ``UNKNOWN``.

    A short list becomes an ``IN`` set. A domain table (one column of values) is
    left-joined; Spark broadcasts it only when its measured size allows.
    """
    if isinstance(domain, DataFrame):
        listed = domain.select(F.col(domain.columns[0]).alias(column)).distinct().withColumn("_listed", F.lit(True))
        joined = df.join(listed, column, "left")
        value = F.when(F.col("_listed"), F.col(column)).otherwise(UNKNOWN)
        return joined.select(*[value.alias(c) if c == column else F.col(c) for c in df.columns])
    value = F.when(F.col(column).isin(*domain), F.col(column)).otherwise(UNKNOWN)
    return df.withColumn(column, value)


def impute_customer(df: DataFrame) -> DataFrame:
    return df.fillna({"customer_id": UNKNOWN})


def standardise(df: DataFrame, rules: CleansingRules = CleansingRules()) -> DataFrame:
    """Normalise both domains, impute the customer and narrow validated amounts to cents.

    An amount too large for the money type, which no valid amount is, becomes NULL.
    """
    df = normalise_domain(df, "product_category", rules.categories)
    df = normalise_domain(df, "region", rules.regions)
    return impute_customer(df).withColumn("amount", F.col("amount").try_cast(MONEY))


def stamp_audit(df: DataFrame, rules: CleansingRules = CleansingRules(), run_ts: Column | None = None) -> DataFrame:
    """Lineage columns. Pass one ``run_ts`` literal so that all outputs of a run agree."""
    return df.withColumns({
        "_ingestion_ts": F.current_timestamp() if run_ts is None else run_ts,
        "_source_system": F.lit(rules.source_system),
        "_pipeline_version": F.lit(rules.pipeline_version),
    })


def classify(df: DataFrame, rules: CleansingRules = CleansingRules()) -> DataFrame:
    """One row per transaction with ``copies`` and the first rule it breaks, or ``ok``.

    ``copies`` is how many input rows the transaction had. Rows without a key are
    no copies of each other: each stays, with reason ``pk_null``, past the shuffle.
    The single shuffle on the key yields the clean rows, the rejects and every
    number of the funnel.
    """
    df, first_by = _ordered_copies(df, rules)
    first = first_per_key(with_key(df), KEY, first_by)
    return first.withColumn("reason", _verdict(rules)).drop("_invalid").unionByName(keyless_rows(df.drop("_invalid")))


def _verdict(rules: CleansingRules) -> Column:
    """The first rule that a first copy breaks, or ``ok``."""
    return F.when(~amount_is_valid(rules), AMOUNT_INVALID).when(F.col("timestamp").isNull(), TIMESTAMP_NULL).otherwise(OK)


def keyless_rows(df: DataFrame) -> DataFrame:
    """Rows without a key: each stays."""
    return df.filter(F.col(KEY).isNull()).withColumns({"copies": F.lit(1).cast("bigint"), "reason": F.lit(PK_NULL)})


def judged_copies(
    df: DataFrame, rules: CleansingRules = CleansingRules(), frequent: Sequence[str] = (), near: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Every row with a key: first copies as ``classify`` gives them, and those they replace as ``duplicate``, equal ones folded with ``copies``.

    One shuffle for both. ``frequent`` names keys of too many rows for one task (``dedup.frequent_keys``); for rows that lie by
    ``near``, columns that the key determines, there is none. ``rows``, if known, is about how many rows there are.
    """
    df, first_by = _ordered_copies(df, rules)
    listed = listed_copies(with_key(df), KEY, first_by, frequent, near, rows)
    return listed.withColumn("reason", F.when(F.col("replaced"), DUPLICATE).otherwise(_verdict(rules))).drop("replaced", "_invalid")


def _ordered_copies(df: DataFrame, rules: CleansingRules) -> tuple[DataFrame, list[str]]:
    """The rows and the columns that say which copy of a transaction comes first."""
    if not rules.prefer_valid_copy:
        return df, list(rules.first_by)
    valid = amount_is_valid(rules) & F.col("timestamp").isNotNull()
    return df.withColumn("_invalid", (~valid).cast("int")), ["_invalid", *rules.first_by]


def with_raw_text(df: DataFrame) -> DataFrame:
    """Amount and timestamp also as text in ``raw_`` columns, for rejects.

    Text that the typed value gives again is left NULL until ``restored_text``, so that it need not move with the row;
    zeros keep theirs, since 0.0 and -0.0 are equal.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    amount, moment = F.col("amount"), F.col("timestamp")
    return df.withColumns({
        "raw_amount": F.when(amount == 0, amount.cast("string")) if isinstance(kinds["amount"], T.DoubleType) else amount.cast("string"),
        "raw_timestamp": F.lit(None).cast("string") if isinstance(kinds["timestamp"], T.TimestampType) else moment.cast("string"),
    })


def restored_text(df: DataFrame) -> DataFrame:
    """``raw_`` columns of typed rows, complete. A typed value without text came as that type."""
    return df.withColumns({f"raw_{c}": F.coalesce(f"raw_{c}", F.col(c).cast("string")) for c in ("amount", "timestamp")})


def standardise_kept(checked: DataFrame, rules: CleansingRules = CleansingRules()) -> DataFrame:
    """``standardise`` for rows that passed; rejects keep their values, and their ``raw_`` text, which kept rows lose.

    Only an amount that the money type cannot hold is NULL in a reject; its text remains.
    """
    kept = F.col("reason") == OK
    after = standardise(checked.withColumns({f"_before_{c}": F.col(c) for c in ("product_category", "region", "customer_id")}), rules)
    after = after.withColumns({c: F.when(kept, F.col(c)).otherwise(F.col(f"_before_{c}")) for c in ("product_category", "region", "customer_id")})
    raw = {c: F.when(~kept, F.col(c)) for c in checked.columns if c.startswith("raw_")}
    return after.withColumns(raw).select(*checked.columns)


def clean_rows(checked: DataFrame) -> DataFrame:
    """Rows of a classified frame that passed every rule."""
    return checked.filter(F.col("reason") == OK).drop("reason", "copies")


def quality_counts(checked: DataFrame) -> DataFrame:
    """The funnel as one row of counts. Rows listed as duplicates are part of their first copy's ``copies``."""
    checked = checked.filter(F.col("reason") != DUPLICATE)
    keyed = F.col("reason") != PK_NULL

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return checked.agg(
        total(F.col("copies")).alias("raw"),
        total(F.when(keyed, F.col("copies"))).alias("after_pk_null_drop"),
        F.count_if(keyed).alias("after_dedup"),
        F.count_if(F.col("reason").isin(TIMESTAMP_NULL, OK)).alias("after_amount"),
        F.count_if(F.col("reason") == OK).alias("after_ts"),
    ).withColumn("final", F.col("after_ts"))


# Names of the funnel steps in order.
FUNNEL_STEPS = ("raw", "after_pk_null_drop", "after_dedup", "after_amount", "after_ts", "final")


def quality_funnel(checked: DataFrame) -> DataFrame:
    """One row per step with the rows left after it."""
    return funnel_steps(quality_counts(checked))


def listed_counts(listed: DataFrame) -> DataFrame:
    """The funnel as one row of counts, from a listing in which every input row stands: duplicates and rows without a key by ``copies``."""
    folded = F.col("reason").isin(PK_NULL, DUPLICATE)
    rows = F.when(folded, F.col("copies")).otherwise(1)

    def total(kept: Column) -> Column:
        return F.coalesce(F.sum(F.when(kept, rows)), F.lit(0)).cast("bigint")

    keyed = F.col("reason") != PK_NULL
    counts = listed.agg(
        total(F.lit(True)).alias("raw"), total(keyed).alias("after_pk_null_drop"), total(~folded).alias("after_dedup"),
        total(F.col("reason").isin(TIMESTAMP_NULL, OK)).alias("after_amount"), total(F.col("reason") == OK).alias("after_ts"),
    )
    return counts.withColumn("final", F.col("after_ts"))


def funnel_steps(counts: DataFrame) -> DataFrame:
    """A row of counts as one row per step."""
    steps = F.array(*[
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(s).alias("step"), F.col(s).alias("row_count"))
        for i, s in enumerate(FUNNEL_STEPS)
    ])
    return counts.select(F.inline(steps))


def step_drops(funnel: DataFrame) -> DataFrame:
    """Rows lost at each step, and the share of raw rows still there in percent, one place."""
    by_step = Window.orderBy("step_no")
    before = F.lag("row_count", 1).over(by_step)
    raw = F.first("row_count").over(by_step)
    retained = ratio_half_up(F.col("row_count") * 100, raw, 1)
    return funnel.select(
        "step_no", "step", "row_count",
        F.greatest(F.coalesce(before, F.col("row_count")) - F.col("row_count"), F.lit(0)).alias("dropped"),
        retained.cast("decimal(6,1)").alias("retained_pct"),
    )


def rejects_by_reason(checked: DataFrame) -> DataFrame:
    """Input rows lost per reason; the rows kept are listed as ``ok``."""
    c = quality_counts(checked)
    lost = F.array(*[
        F.struct(F.lit(r).alias("reason"), n.alias("row_count")) for r, n in (
            (PK_NULL, F.col("raw") - F.col("after_pk_null_drop")),
            (DUPLICATE, F.col("after_pk_null_drop") - F.col("after_dedup")),
            (AMOUNT_INVALID, F.col("after_dedup") - F.col("after_amount")),
            (TIMESTAMP_NULL, F.col("after_amount") - F.col("after_ts")),
            (OK, F.col("final")),
        )
    ])
    return c.select(F.inline(lost))


def null_profile(df: DataFrame, columns: Sequence[str] = CONTRACT_COLUMNS) -> DataFrame:
    """NULL count of each column, one pass."""
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in columns])
    return counted.select(F.inline(rows))


def fill_blank_ids(df: DataFrame) -> DataFrame:
    """A fresh UUID where the key is NULL or blank.

    The seed is drawn when the frame is built, so a task that runs again over the
    same rows repeats its ids. Rows that come out of a shuffle may change order:
    write the filled rows before dedup in that case.
    """
    if KEY not in df.columns:
        return df.withColumn(KEY, F.uuid())
    blank = F.col(KEY).isNull() | (F.trim(F.col(KEY)) == "")
    return df.withColumn(KEY, F.when(blank, F.uuid()).otherwise(F.col(KEY)))


def complex_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[
        (F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields
    ])
