from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.operators import cleanse as ops
from salesflow.operators import dedup
from salesflow.rules import CONTRACT_COLUMNS, CleansingRules

TS = "2024-03-15 10:30:00"


def row(key, amount="10.00", ts=TS, customer="CUST_000001", category="Books", region="us-east-1"):
    return key, customer, category, amount, ts, region


def checked(raw, *rows, rules=CleansingRules()):
    typed = ops.typed_projection(raw(*rows), rules)
    return ops.classify(typed, rules)


def reasons(frame):
    return {r.transaction_id: r.reason for r in frame.collect()}


def test_bad_text_becomes_null_instead_of_failing(raw):
    typed = ops.typed_projection(raw(row("a", "abc"), row("b", "1e3"), row("c", " 8 "), row("d", ts="2024-13-01 00:00:00")))
    got = {r.transaction_id: (r.amount, r.timestamp) for r in typed.collect()}
    assert got["a"][0] is None and got["b"][0] == 1000.0 and got["c"][0] == 8.0 and got["d"][1] is None


@pytest.mark.parametrize("amount, reason", [
    ("1.00", "ok"), ("50000.00", "ok"), ("0.99", "amount_invalid"), ("50000.01", "amount_invalid"),
    ("0.995", "amount_invalid"), ("50000.004", "amount_invalid"), ("NaN", "amount_invalid"),
    ("Infinity", "amount_invalid"), ("abc", "amount_invalid"), (None, "amount_invalid"), ("1e99", "amount_invalid"),
])
def test_amount_bounds_hold_before_narrowing(raw, amount, reason):
    assert reasons(checked(raw, row("a", amount))) == {"a": reason}


@pytest.mark.parametrize("ts", ["2024-01-05", "2024-01-05T10:00:00", "2024-1-5 10:00:00", "2024-01-05 10:00:00.5", "soon", None])
def test_strict_timestamp_format(raw, ts):
    assert reasons(checked(raw, row("a", ts=ts))) == {"a": "timestamp_null"}


def test_fallback_formats_are_tried_in_order(raw):
    rules = CleansingRules(timestamp_formats=("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"))
    assert reasons(checked(raw, row("a", ts="2024-01-05"), rules=rules)) == {"a": "ok"}


def test_dedup_ignores_validity_unless_asked(raw):
    rows = row("a", "-5", "2024-01-01 00:00:00"), row("a", "20", "2024-01-02 00:00:00")
    by_time = CleansingRules(first_by=("timestamp",))
    assert reasons(checked(raw, *rows, rules=by_time)) == {"a": "amount_invalid"}
    valid_first = CleansingRules(first_by=("timestamp",), prefer_valid_copy=True)
    assert reasons(checked(raw, *rows, rules=valid_first)) == {"a": "ok"}


def test_funnel_accounts_for_every_row(raw):
    rows = [row(None), row(None), row("a"), row("a"), row("b", "0"), row("c", ts=None), row("d"), row("d", "11.00")]
    frame = checked(raw, *rows)
    assert [r.row_count for r in ops.quality_funnel(frame).orderBy("step_no").collect()] == [8, 6, 4, 3, 2, 2]
    drops = {r.step: (r.dropped, float(r.retained_pct)) for r in ops.step_drops(ops.quality_funnel(frame)).collect()}
    assert drops["raw"] == (0, 100.0) and drops["after_pk_null_drop"][0] == 2 and drops["final"] == (0, 25.0)
    assert {r.reason: r.row_count for r in ops.rejects_by_reason(frame).collect()} == {
        "pk_null": 2, "duplicate": 2, "amount_invalid": 1, "timestamp_null": 1, "ok": 2}


def test_empty_input(raw, spark):
    frame = ops.classify(ops.typed_projection(raw(row("a")).filter("false")))
    assert [r.row_count for r in ops.quality_funnel(frame).collect()] == [0] * 6
    assert ops.clean_rows(frame).count() == 0


def test_domains_and_imputation(raw):
    df = ops.standardise(ops.clean_rows(checked(
        raw, row("a", category="Gadgets", region=None), row("b", customer=None, category=None), row("c"))))
    got = {r.transaction_id: (r.customer_id, r.product_category, r.region) for r in df.collect()}
    assert got == {
        "a": ("CUST_000001", "UNKNOWN", "UNKNOWN"),
        "b": ("UNKNOWN", "UNKNOWN", "us-east-1"),
        "c": ("CUST_000001", "Books", "us-east-1"),
    }


def test_cleansing_is_idempotent(raw):
    once = ops.standardise(ops.clean_rows(checked(raw, row("a"), row("a"), row("b", "0"), row("c", category="x"))))
    twice = ops.standardise(ops.clean_rows(ops.classify(ops.typed_projection(once))))
    assert Counter(map(tuple, once.collect())) == Counter(map(tuple, twice.collect()))


def test_domain_table_equals_domain_list(raw, spark):
    df = ops.typed_projection(raw(row("a"), row("b", category="Gadgets"), row("c", category=None)))
    table = spark.createDataFrame([("Books",), ("Books",), ("Toys",)], "name string")
    by_table = ops.normalise_domain(df, "product_category", table)
    by_list = ops.normalise_domain(df, "product_category", ("Books", "Toys"))
    assert by_table.columns == by_list.columns
    assert Counter(map(tuple, by_table.collect())) == Counter(map(tuple, by_list.collect()))


def test_survivors_and_dropped_copies_make_up_the_input(raw):
    rows = [row("a", "1.00"), row("a", "2.00"), row("a", "2.00"), row("a", "1.00"), row("b"), row("c"), row("c")]
    df = raw(*rows)
    kept = dedup.first_per_key(df, "transaction_id", ("amount",)).drop("copies")
    lost = dedup.dropped_copies(df, "transaction_id", ("amount",))
    total = Counter(tuple(r) for r in kept.select(*CONTRACT_COLUMNS).collect())
    for r in lost.collect():
        total[tuple(r[c] for c in CONTRACT_COLUMNS)] += r.copies
    assert total == Counter(rows)
    assert {r.transaction_id: r.amount for r in kept.collect()} == {"a": "1.00", "b": "10.00", "c": "10.00"}


def test_survivor_matches_brute_force(spark):
    """A key with a third of all rows, equal and differing copies, NULLs in the order columns."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", (i * 37) % 11 if i % 7 else None, (i * 13) % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, a int, b int").repartition(16)
    expected = {}
    for k, a, b in rows:
        rank = (a is not None, a or 0, b)
        expected[k] = min(expected.get(k, (rank, a, b)), (rank, a, b), key=lambda t: t[0])
    got = dedup.first_per_key(df, "k", ("a",)).collect()
    assert {r.k: (r.a, r.b) for r in got} == {k: (v[1], v[2]) for k, v in expected.items()}
    assert {r.k: r.copies for r in got} == Counter(r[0] for r in rows)


def test_copies_are_combined_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("'hot' AS k", "id AS a")
    plan = dedup.first_per_key(df, "k")._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_min" in below_exchange and "Window" not in plan


def test_unseen_keys(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    seen = spark.createDataFrame([("a",), ("a",), ("z",)], "k string")
    assert sorted(r.k for r in dedup.unseen_keys(batch, seen, "k").collect()) == ["b", "c"]


def test_null_profile_and_missing_columns(raw):
    df = ops.add_missing_columns(raw(row("a"), row(None, None)).drop("region"))
    got = {r.column_name: r.null_count for r in ops.null_profile(df).collect()}
    assert got == {"transaction_id": 1, "customer_id": 0, "product_category": 0, "amount": 1, "timestamp": 0, "region": 2}


def test_blank_ids_get_fresh_uuids(raw):
    frame = ops.fill_blank_ids(raw(row("a"), row("  "), row(None)))
    filled = [r.transaction_id for r in frame.collect()]
    assert filled == [r.transaction_id for r in frame.collect()]
    assert "a" in filled and len(set(filled)) == 3 and sorted(map(len, filled)) == [1, 36, 36]


def test_audit_columns_share_the_run_timestamp(raw):
    stamp = F.lit("2024-06-01 00:00:00").cast("timestamp")
    df = ops.stamp_audit(raw(row("a"), row("b")), run_ts=stamp)
    assert {(str(r._ingestion_ts), r._source_system, r._pipeline_version) for r in df.collect()} == {
        ("2024-06-01 00:00:00", "sales_csv_landing", "1.0.0")}


@pytest.mark.parametrize("frequent", [(), ("hot",), ("hot", "k1", "absent")])
def test_listed_copies_match_brute_force(spark, frequent):
    """First copies and replaced ones in one listing, whichever way a key's rows take."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", (i * 37) % 11 if i % 7 else None, (i * 13) % 5 if i % 4 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, a int, b int").repartition(16)
    rank = lambda r: (r[1] is not None, r[1] or 0, r[2] is None, r[2] or 0)
    expected, left = Counter(), Counter(rows)
    for k, n in Counter(r[0] for r in rows).items():
        first = min((r for r in rows if r[0] == k), key=rank)
        expected[(*first, n, False)] += 1
        left[first] -= 1
    expected.update((*r, n, True) for r, n in left.items() if n)
    assert Counter(map(tuple, dedup.listed_copies(df, "k", ("a",), frequent).select("k", "a", "b", "copies", "replaced").collect())) == expected


def test_listing_moves_rows_once(spark):
    """Once before, the wide rows moved for the first copies and twice more for the replaced ones."""
    df = spark.range(1000).selectExpr("CAST(id % 300 AS string) AS transaction_id", "CAST(id AS double) AS amount", "current_timestamp() AS timestamp")
    plan = ops.judged_copies(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "SortAggregate" not in plan


def test_frequent_keys_are_found(spark):
    df = spark.range(400_000).selectExpr("CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 9 > 0 THEN CAST(id AS string) END AS k", "id AS v")
    assert dedup.frequent_keys(df, "k") == ["hot"] and dedup.frequent_keys(df.limit(1000), "k") == []


def test_raw_text_comes_back(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 0.0D), ('b', -0.0D), ('c', 1.5D), ('d', double('NaN')), ('e', NULL) AS t(transaction_id, amount)").withColumn("timestamp", F.lit(TS).cast("timestamp"))
    got = ops.restored_text(ops.with_raw_text(df)).collect()
    assert {r.transaction_id: r.raw_amount for r in got} == {"a": "0.0", "b": "-0.0", "c": "1.5", "d": "NaN", "e": None}
    assert {r.raw_timestamp for r in got} == {TS}


def test_copies_lie_where_the_join_left_them(spark, monkeypatch):
    monkeypatch.setattr(dedup, "TASK_ROWS", 10)
    df = spark.createDataFrame([(f"{i % 97}-{i % 3}", i % 97, i) for i in range(900)], "k string, part int, b int")
    side = spark.createDataFrame([(i, f"s{i}") for i in range(97)], "part int, name string").hint("merge")
    placed = dedup.spread(df, 900, "part").join(side, "part", "left")
    listed = dedup.listed_copies(placed, "k", ("b",), near=("part",))
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2 and "hashpartitioning(part#" in plan and ", 90), REPARTITION_BY_NUM" in plan
    columns = ["k", "part", "b", "name", "copies", "replaced"]
    expected = dedup.listed_copies(df.join(side, "part", "left"), "k", ("b",)).select(*columns).collect()
    assert Counter(listed.select(*columns).collect()) == Counter(expected)


def test_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(dedup, "TASK_ROWS", 10)
    df = spark.createDataFrame([(f"k{i}", i) for i in range(900)], "k string, b int")
    assert dedup.listed_copies(df, "k", ("b",), rows=900).rdd.getNumPartitions() == 90
    keys, rows = dedup.sampled_keys(spark.range(400_000).selectExpr("if(id % 3 = 0, 'hot', string(id)) k"), "k")
    assert keys == ["hot"] and 300_000 < rows < 500_000
