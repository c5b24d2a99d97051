from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.operators import cleanse as ops
from salesflow.rules import CATEGORIES, CATEGORY_WEIGHTS, CONTRACT_COLUMNS, REGIONS
from salesflow.operators.cleanse import classify, typed_projection
from salesflow.rules import CleansingRules
from salesflow.sources import landing, synthetic

HEADER = ",".join(CONTRACT_COLUMNS)


@pytest.fixture
def dirty(tmp_path):
    lines = [
        HEADER,
        't1,C1,Books,10.00,2024-01-01 00:00:00,us-east-1',
        't2,,Books,10.00,2024-01-01 00:00:00,us-east-1',
        't3,"",Books,10.00,2024-01-01 00:00:00,us-east-1',
        ',C1,Books,10.00,2024-01-01 00:00:00,us-east-1',
        't5,C1,Books,abc,2024-01-01 00:00:00,us-east-1',
        't6,C1,Books,10.00',
        't7,C1,Books,10.00,2024-01-01 00:00:00,us-east-1,more',
        't8,"q ""x"", y",Books,10.00,2024-01-01 00:00:00,us-east-1',
    ]
    path = tmp_path / "landing"
    path.mkdir()
    (path / "sales.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def test_dirty_csv_is_kept_and_typed(spark, dirty):
    typed = ops.typed_projection(landing.read_landing_csv(spark, dirty))
    got = {r.transaction_id: r for r in typed.collect()}
    assert len(got) == 8 and got["t2"].customer_id is None and got["t3"].customer_id is None
    assert got["t6"].region is None and got["t6"].timestamp is None and got["t7"].region == "us-east-1"
    assert got["t8"].customer_id == 'q "x", y'
    funnel = [r.row_count for r in ops.quality_funnel(ops.classify(typed)).orderBy("step_no").collect()]
    assert funnel == [8, 7, 7, 6, 5, 5]


def test_malformed_rows_can_be_split_off(spark, dirty):
    good, bad = landing.split_corrupt(landing.read_landing_csv(spark, dirty, keep_corrupt=True))
    assert sorted(r.transaction_id for r in bad.collect()) == ["t6", "t7"]
    assert "t6" not in [r.transaction_id for r in good.collect()]
    assert any(r._corrupt_record.endswith(",more") for r in bad.collect())


def test_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("amount,transaction_id\n5,t1\n")
    path = str(tmp_path)
    assert landing.read_landing_csv(spark, path).first().transaction_id == "t1"
    (tmp_path / "b.csv").write_text("transaction_id,amount\nt2,6\n")
    with pytest.raises(Exception, match="CSV header"):
        landing.read_landing_csv(spark, path).collect()


def test_multi_line_values(spark, tmp_path):
    (tmp_path / "m.csv").write_text(HEADER + '\nt1,"two\nlines",Books,1,2024-01-01 00:00:00,us-east-1\n')
    rows = landing.read_landing_csv(spark, str(tmp_path / "m.csv"), multi_line=True).collect()
    assert [r.customer_id for r in rows] == ["two\nlines"]


def test_upload_contract(spark, tmp_path):
    (tmp_path / "u.csv").write_text("amount,transaction_id\n5.5,t1\n6,t2\n7,t3\n")
    with pytest.raises(landing.ContractError, match="customer_id"):
        landing.read_uploaded_csv(spark, str(tmp_path / "u.csv"))
    df = landing.read_uploaded_csv(spark, str(tmp_path / "u.csv"), on_missing="add_null")
    assert df.count() == 3 and df.columns == list(CONTRACT_COLUMNS)
    assert {r.region for r in df.collect()} == {None} and df.schema["amount"].dataType.simpleString() == "double"


def test_csv_lines(spark):
    lines = spark.createDataFrame([('t1,"a,b",Books,5,2024-01-01 00:00:00,eu-west-1',)], "value string")
    assert [tuple(r) for r in landing.parse_csv_lines(lines).collect()] == [
        ("t1", "a,b", "Books", "5", "2024-01-01 00:00:00", "eu-west-1")]


def test_open_quotes_fail_the_read(spark, tmp_path):
    (tmp_path / "m.csv").write_text(HEADER + '\nt1,"two\nlines",Books,1,2024-01-01 00:00:00,us-east-1\n')
    with pytest.raises(landing.ContractError, match="line break"):
        landing.read_landing_csv(spark, str(tmp_path / "m.csv"))


def test_iso_times_and_arrival(spark, tmp_path):
    for name, amount in (("a.csv", ""), ("b.csv", "7")):
        (tmp_path / name).write_text(f"{HEADER}\nt1,c,Books,{amount},2024-01-05T10:00:00,us-east-1\n")
    rows = landing.with_arrival(landing.read_landing_csv(spark, str(tmp_path)))
    rules = CleansingRules(first_by=landing.ARRIVAL)
    assert classify(typed_projection(rows, landing.with_iso_times(rules)), rules).collect()[0].reason == "amount_invalid"
    assert classify(typed_projection(rows.drop(*landing.ARRIVAL), landing.with_iso_times(rules))).collect()[0].reason == "ok"
    moment = F.lit("2020-01-01 00:00:00").cast("timestamp")
    records = landing.records_from_rows(spark, [{"transaction_id": "1", "timestamp": "2024-01-05T10:00:00"}, {"transaction_id": "2", "timestamp": "2024-01-05"}, {"transaction_id": "3", "timestamp": "?"}])
    assert [str(r.timestamp) for r in landing.from_records(records, default_ts=moment).orderBy("transaction_id").collect()] == ["2024-01-05 10:00:00", "2024-01-05 00:00:00", "2020-01-01 00:00:00"]


def test_csv_text(spark):
    text = 'amount,transaction_id,customer_id\n5,t1,"two\nlines"\nx,t2,c\n6,t3,c\n'
    got = {r.transaction_id: (r.customer_id, r.amount, r.region) for r in landing.read_csv_text(spark, text).collect()}
    assert got == {"t1": ("two\nlines", 5.0, None), "t2": ("c", None, None), "t3": ("c", 6.0, None)}
    quoted = '"amount", "transaction_id" ,region\n5,t1,r\namount,transaction_id,region\n'
    assert [(r.transaction_id, r.amount) for r in landing.read_csv_text(spark, quoted).collect()] == [("t1", 5.0), ("transaction_id", None)]
    with pytest.raises(landing.ContractError):
        landing.read_csv_text(spark, "  ")


def test_records(spark):
    rows = [{"customer_id": "c", "amount": "12.5", "timestamp": "bad"}, {"customer_id": None, "amount": 3}]
    moment = F.lit("2024-01-15 00:00:00").cast("timestamp")
    df = landing.from_records(landing.records_from_rows(spark, rows), default_ts=moment, fill_ids=True)
    got = df.collect()
    assert [r.amount for r in got] == [12.5, 3.0] and {str(r.timestamp) for r in got} == {"2024-01-15 00:00:00"}
    assert len({r.transaction_id for r in got}) == 2
    with pytest.raises(landing.ContractError):
        landing.records_from_rows(spark, [])


def test_schema_discovery(spark, dirty):
    found = {r.column_name: r.found_type for r in landing.compare_with_contract(
        spark, landing.discover_csv_schema(spark, dirty)).collect()}
    assert found["timestamp"] == "timestamp" and found["amount"] == "string"


@pytest.mark.parametrize("n", [1, 7, 1000, 12_000])
def test_synthetic_funnel(spark, n):
    rows = synthetic.generate_sales(spark, n)
    funnel = [r.row_count for r in ops.quality_funnel(ops.classify(rows)).orderBy("step_no").collect()]
    kept = n - n // 100
    assert funnel == [n + n // 200, n + n // 200, n, kept, kept, kept]


def test_synthetic_rows_do_not_depend_on_partitioning(spark):
    one = synthetic.generate_from_ids(spark.range(0, 500, 1, 1), 500)
    many = synthetic.generate_from_ids(spark.range(0, 500, 1, 9), 500)
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, many.collect()))
    other = synthetic.generate_from_ids(spark.range(500), 500, seed=43)
    assert Counter(map(tuple, one.collect())) != Counter(map(tuple, other.collect()))


def test_synthetic_distributions(spark):
    rows = synthetic.sales_rows(spark.range(40_000)).drop("id")
    n = 40_000
    shares = {r.product_category: r["count"] / n for r in rows.groupBy("product_category").count().collect()}
    for category, weight in zip(CATEGORIES, CATEGORY_WEIGHTS):
        assert abs(shares[category] - weight) < 0.01
    stats = rows.agg(F.avg(F.ln("amount")).alias("mean"), F.stddev(F.ln("amount")).alias("sigma"), F.min("amount").alias("low"),
                     F.max("amount").alias("high"), F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
                     F.countDistinct("transaction_id").alias("keys"), F.countDistinct("region").alias("regions")).first()
    assert abs(stats["mean"] - 4.0) < 0.03 and abs(stats["sigma"] - 1.2) < 0.03
    assert stats["low"] >= 1.0 and stats["high"] <= 50_000.0 and stats["keys"] == n and stats["regions"] == len(REGIONS)
    assert str(stats["t0"]) >= "2022-01-01 00:00:00" and str(stats["t1"]) <= "2024-12-31 23:59:59"


@pytest.mark.parametrize("n", [2, 3, 97, 100, 4096, 30_030])
def test_exact_sample(spark, n):
    for seed in (1, 42, 45):
        ids = spark.range(n)
        assert ids.filter(synthetic.exact_sample(F.col("id"), n, n // 3, seed)).count() == n // 3


def test_exact_sample_step_fits_a_long_at_scale(spark):
    n = 10**12
    top = spark.range(n - 1000, n)
    assert top.filter(synthetic.exact_sample(F.col("id"), n, n // 2, 42)).count() >= 0


def test_serial_style(spark):
    row = synthetic.sales_rows(spark.range(1), style="serial", customers=500_000).first()
    assert row.transaction_id.startswith("TXN-") and len(row.transaction_id) == 20 and row.customer_id.startswith("CUST-")


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n1,"x, ""y""",3\n2,short\n"4\n4",y,z\n5,y,"z\nz"\n\n6,,7\r\n')
    rows = landing.read_landing_lines(spark, str(tmp_path / "a.csv")).drop(*landing.ARRIVAL)
    good, bad = landing.split_corrupt(rows)
    assert sorted(map(tuple, good.collect())) == [("1", 'x, "y"', "3"), ("6", None, "7")]
    assert sorted(r[0] for r in bad.select(landing.CORRUPT).collect()) == ['"4', '2,short', '4",y,z', '5,y,"z', 'z"']
    assert all(r.a is None and r.b is None and r.c is None for r in bad.collect())
    (tmp_path / "b.csv").write_text("b,a,c\n1,2,3\n")
    with pytest.raises(Exception, match="another header"):
        landing.parse_landing_lines(spark.read.text(str(tmp_path)), ["a", "b", "c"]).collect()


def test_schemas_of_files_are_combined(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,when,who,only\n1,2024-01-01,x,\n3000000000,2024-01-02,"y,z",\n')
    (tmp_path / "b.csv").write_text("who,n,when\n7,0.5,2024-01-03 10:00:00\n8,1e3,\n")
    (tmp_path / "c.csv").write_text("n,empty\n")
    found = {r.column_name: tuple(r)[1:] for r in landing.combine_schemas(landing.file_schemas(spark, str(tmp_path))).collect()}
    assert found == {
        "n": ("double", 3, "bigint,double", True), "when": ("timestamp", 2, "date,timestamp", True),
        "who": ("string", 2, "int,string", False), "only": ("string", 1, "", True), "empty": ("string", 1, "", True)}


def test_exact_sample_of_ids_with_gaps(spark):
    ids = spark.range(5000).select((F.col("id") * F.col("id") * 7 + 3).alias("id"))
    hashed = sorted((r.h, r.id) for r in ids.select("id", synthetic.counter_bits(F.col("id"), 5, "sample").alias("h")).collect())
    for size in (0, 1, 37, 2500, 5000, 6000):
        got = {r.id for r in ids.filter(synthetic.smallest_hashes(ids, size, 5)).collect()}
        assert got == {i for _, i in hashed[:size]}
    assert ids.limit(0).filter(synthetic.smallest_hashes(ids.limit(0), 3, 5)).count() == 0
