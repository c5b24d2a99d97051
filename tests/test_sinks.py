import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesflow.__main__ import main
from salesflow.operators import kpis, profile
from salesflow.plans import jobs
from salesflow.sinks import catalog, files, warehouse
from salesflow.sinks.scratch import scratch_path
from salesflow.sources import landing, synthetic

RUN_TS = "2024-06-01 00:00:00"


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    """A small synthetic run over the first days of 2022, curated once for this module."""
    root = str(tmp_path_factory.mktemp("zones"))
    rows = synthetic.generate_sales(spark, 600)
    first_days = F.concat(F.lit("2022-0"), (F.dayofmonth("timestamp") % 3 + 1).cast("string"), F.lit("-05 10:00:00"))
    rows = rows.withColumn("timestamp", first_days.cast("timestamp"))
    checked = jobs.cleanse(spark, rows, f"{root}/cleansed", run_ts=jobs.run_timestamp(RUN_TS))
    made = jobs.curate(spark, landing.read_cleansed(spark, f"{root}/cleansed"), f"{root}/curated", jobs.run_timestamp(RUN_TS))
    return root, checked, made


def simple_fact(spark, *rows):
    df = spark.createDataFrame(rows, "transaction_id string, amount double, moment string")
    return kpis.add_date_parts(df.select("transaction_id", "amount", F.col("moment").cast("timestamp").alias("timestamp")))


def test_cleansed_zone(spark, curated):
    root, checked, _ = curated
    zone = landing.read_cleansed(spark, f"{root}/cleansed")
    assert zone.columns == [
        "transaction_id", "customer_id", "product_category", "amount", "timestamp", "region",
        "_ingestion_ts", "_source_system", "_pipeline_version"]
    assert zone.count() == 594 and dict(zone.dtypes)["amount"] == "decimal(12,2)"
    assert zone.select("_ingestion_ts").distinct().count() == 1
    assert checked.agg(F.sum("copies")).first()[0] == 606 and checked.filter("reason = 'duplicate'").agg(F.sum("copies")).first()[0] == 3
    plan = zone._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reason" in plan


def test_every_input_row_is_in_the_zone(spark, tmp_path):
    rows = [("a", "c", "Books", "1", "2024-01-01 00:00:00", "us-east-1"), ("a", "c", "Books", "2", "2024-01-01 00:00:00", "us-east-1"),
            (None, "x", "Gadgets", "abc", "2024-01-05T10:00:00", "nowhere"), (None, "y", None, "1e300", None, None), (None, "y", None, "1e300", None, None),
            ("b", "c", "Gadgets", "0.5", "bad", "nowhere"), ("d", None, None, None, None, None), ("e", "c", "Books", "7", "bad", "eu-west-1")]
    raw = spark.createDataFrame(rows, "transaction_id string, customer_id string, product_category string, amount string, timestamp string, region string")
    zone = jobs.cleanse(spark, raw, str(tmp_path / "zone"))
    rejects = zone.filter("reason <> 'ok'").collect()
    back = [(r.transaction_id, r.customer_id, r.product_category, r.raw_amount, r.raw_timestamp, r.region) for r in rejects
            for _ in range(r.copies if r.reason in ("duplicate", "pk_null") else 1)]
    assert sorted(back, key=str) == sorted(rows[1:], key=str)
    assert jobs.quality_funnel(zone).collect()[0].row_count == len(rows) and zone.filter("reason = 'ok'").count() == 1


def test_table_follows_its_files(spark, tmp_path):
    catalog.ensure_database(spark, "moved", str(tmp_path / "db"))
    for name, n in (("one", 3), ("two", 5), ("two", 5)):
        spark.range(n).write.mode("overwrite").parquet(str(tmp_path / name))
        catalog.register_files(spark, "moved.t", str(tmp_path / name))
        assert spark.table("moved.t").count() == n


def test_curate_keeps_other_days_and_merges_late_rows(spark, tmp_path):
    root = str(tmp_path / "curated")
    columns = "transaction_id string, customer_id string, product_category string, amount decimal(12,2), moment string, region string"
    make = lambda *rows: spark.createDataFrame([(k, "c", "Books", Decimal(a), m, "us-east-1") for k, a, m in rows], columns).withColumn("timestamp", F.col("moment").cast("timestamp")).drop("moment")
    jobs.curate(spark, make(("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")), root)
    jobs.curate(spark, make(("c", 3, "2024-01-02"), ("d", 4, "2024-02-01")), root)
    jobs.curate(spark, make(("c", 5, "2024-01-02")), root)
    assert {(r.transaction_id, int(r.amount)) for r in landing.read_fact(spark, f"{root}/sales").collect()} == {("a", 1), ("b", 2), ("c", 5), ("d", 4)}
    jobs.curate(spark, make(("z", 9, "2024-05-01")), root, full=True)
    assert landing.read_fact(spark, f"{root}/sales").count() == 1


def test_a_moved_transaction_stands_once(spark, tmp_path):
    root = str(tmp_path / "curated")
    columns = "transaction_id string, customer_id string, product_category string, amount decimal(12,2), moment string, region string"
    make = lambda *rows: spark.createDataFrame([(k, f"c{k}", "Books", Decimal(a), m, "us-east-1") for k, a, m in rows], columns).withColumn("timestamp", F.col("moment").cast("timestamp")).drop("moment")
    rows = lambda: sorted((r.transaction_id, int(r.amount), r.year, r.month, r.day) for r in landing.read_fact(spark, f"{root}/sales").collect())
    months = lambda: sorted((r.month_label, int(r.total_revenue)) for r in spark.read.parquet(f"{root}/kpis/monthly_sales_growth").collect())
    jobs.curate(spark, make(("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"), ("c", 3, "2024-02-01")), root)
    jobs.curate(spark, make(("a", 5, "2024-01-02")), root)
    assert rows() == [("a", 5, 2024, 1, 2), ("b", 2, 2024, 1, 2), ("c", 3, 2024, 2, 1)]
    jobs.curate(spark, make(("c", 4, "2024-03-01"), ("d", 6, "2024-03-01")), root)
    assert rows() == [("a", 5, 2024, 1, 2), ("b", 2, 2024, 1, 2), ("c", 4, 2024, 3, 1), ("d", 6, 2024, 3, 1)]
    assert months() == [("2024-01", 7), ("2024-03", 10)]
    jobs.curate(spark, make(("c", 4, "2024-03-01")), root)
    assert len(rows()) == 4 and not (tmp_path / "curated/merged_days").exists()


def test_curate_reads_only_touched_months(spark, tmp_path):
    """The other months' files may even be unreadable."""
    root = str(tmp_path / "curated")
    columns = "transaction_id string, customer_id string, product_category string, amount decimal(12,2), moment string, region string"
    make = lambda *rows: spark.createDataFrame([(k, "c", "Books", Decimal(a), m, "us-east-1") for k, a, m in rows], columns).withColumn("timestamp", F.col("moment").cast("timestamp")).drop("moment")
    jobs.curate(spark, make(("a", 1, "2024-01-01"), ("b", 2, "2024-02-02")), root)
    for part in (tmp_path / "curated/sales/year=2024/month=2").rglob("part-*"):
        part.write_bytes(b"damaged on purpose")
    for crc in (tmp_path / "curated/sales/year=2024/month=2").rglob(".*.crc"):
        crc.write_bytes(b"")
    made = jobs.curate(spark, make(("c", 3, "2024-01-01")), root)
    assert sorted((r.month_label, int(r.total_revenue)) for r in made[jobs.KPI_MONTHLY].collect()) == [("2024-01", 4), ("2024-02", 2)]


def test_kpis_are_written_once_and_agree(spark, curated):
    _, _, made = curated
    total = {n: f.agg(F.sum("transaction_count")).first()[0] for n, f in made.items()}
    assert total["revenue_per_category"] == total["monthly_sales_growth"] == 594
    assert total["top_regions_by_volume"] <= 594
    shares = made["revenue_per_category"].agg(F.sum("revenue_pct")).first()[0]
    assert abs(float(shares) - 100) < 0.06
    assert all(len(f.inputFiles()) == 1 for f in made.values())
    excerpts = jobs.console_summary(made, months=2)
    assert [r.month_label for r in excerpts["monthly_sales_growth"].collect()] == ["2022-03", "2022-02"]


def test_year_filter_prunes_partitions(spark, curated):
    fact = landing.read_fact(spark, f"{curated[0]}/curated/sales")
    plan = profile.filter_fact(fact, years=(2022,), categories=("Books",))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(year" in plan.replace("isnotnull(year", "(year") and "PushedFilters: [" in plan
    assert "EqualTo(product_category,Books)" in plan


def test_kpi_reads_only_the_columns_it_needs(spark, curated):
    fact = landing.read_fact(spark, f"{curated[0]}/curated/sales")
    plan = kpis.revenue_per_category(kpis.measure_form(fact))._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "region" not in schema and "timestamp" not in schema and "product_category" in schema


def test_dynamic_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    files.write_fact(simple_fact(spark, ("a", 1.0, "2024-01-01"), ("b", 2.0, "2024-01-02")), path)
    files.write_fact(simple_fact(spark, ("c", 3.0, "2024-01-02")), path, replace_days_only=True)
    assert sorted(r.transaction_id for r in landing.read_fact(spark, path).collect()) == ["a", "c"]
    files.append_fact(simple_fact(spark, ("d", 3.0, "2024-01-01")), path)
    assert sorted(r.transaction_id for r in landing.read_fact(spark, path).collect()) == ["a", "c", "d"]
    files.write_fact(simple_fact(spark, ("e", 3.0, "2024-01-09")), path)
    assert [r.transaction_id for r in landing.read_fact(spark, path).collect()] == ["e"]


def test_a_day_too_big_for_one_task_is_split(spark, tmp_path):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64KB")
    try:
        hot = spark.range(200_000).select(
            F.md5(F.col("id").cast("string")).alias("transaction_id"), F.lit(1.0).alias("amount"),
            F.lit("2024-01-01").cast("timestamp").alias("timestamp")).repartition(8)
        path = str(tmp_path / "hot")
        files.write_fact(kpis.add_date_parts(hot), path)
    finally:
        spark.conf.set(setting, before)
    assert len(list(Path(path).rglob("*.parquet"))) > 1
    assert landing.read_fact(spark, path).count() == 200_000


def test_compaction_keeps_rows_and_merges_files(spark, tmp_path):
    path = str(tmp_path / "fact")
    for i in range(4):
        files.append_fact(simple_fact(spark, (f"a{i}", 1.0, "2024-01-01"), (f"b{i}", 1.0, "2024-01-02")), path)
    days = landing.read_fact(spark, path).filter("day = 1").select("year", "month", "day")
    files.rewrite_days(spark, path, str(tmp_path / "staging"), days, ["transaction_id"])
    assert landing.read_fact(spark, path).count() == 8
    assert len(list((tmp_path / "fact/year=2024/month=1/day=1").glob("*.parquet"))) == 1
    assert len(list((tmp_path / "fact/year=2024/month=1/day=2").glob("*.parquet"))) == 4


def test_report_json_has_no_nan(spark, tmp_path):
    numbers = spark.sql("SELECT double('NaN') a, 1 b UNION ALL SELECT 2D, 3")
    files.write_report({"one": numbers, "two": numbers.select("b")}, str(tmp_path / "report"))
    lines = [json.loads(line) for p in (tmp_path / "report").rglob("*.txt") for line in p.read_text().splitlines()]
    assert {"a": None, "b": 1} in lines and len(lines) == 4


def test_whole_run(spark, tmp_path):
    rows = [{"transaction_id": str(i), "customer_id": "c", "product_category": "Books", "amount": str(i),
             "timestamp": "2024-01-01 00:00:00", "region": "us-east-1"} for i in range(5)]
    source = landing.from_records(landing.records_from_rows(spark, rows))
    report = jobs.run(spark, source, str(tmp_path / "run"), preview_rows=3)
    assert report.summary.first().total_records == 4 and report.preview.count() == 3
    assert report.preview.first().timestamp == "2024-01-01 00:00:00"
    with pytest.raises(jobs.EmptyResultError):
        jobs.run(spark, source.withColumn("amount", F.lit(0.5)), str(tmp_path / "empty"))
    with pytest.raises(landing.ContractError):
        jobs.run(spark, source.drop("region"), str(tmp_path / "fail"), on_missing="fail")


def test_catalog_table_gains_new_columns(spark, tmp_path):
    catalog.ensure_database(spark, "cat_test", str(tmp_path / "db"))
    path = str(tmp_path / "files")
    spark.range(2).write.parquet(path)
    catalog.register_files(spark, "cat_test.t", path)
    spark.range(3).withColumn("extra", F.lit("x")).write.mode("overwrite").parquet(path)
    catalog.register_files(spark, "cat_test.t", path)
    assert spark.table("cat_test.t").filter("extra = 'x'").count() == 3
    assert [(r.tableName, r.owner) for r in catalog.list_tables(spark, "cat_test").collect()] == [("t", spark.sparkContext.sparkUser())]


def test_load_by_name_and_views(spark, curated, tmp_path):
    status = jobs.load(spark, f"{curated[0]}/curated", "dw_ok", str(tmp_path), "1")
    assert {r.status for r in status.collect()} == {"SUCCESS"}
    fact = spark.table("dw_ok.fact_sales")
    assert fact.columns == list(warehouse.FACT_SALES.columns) and fact.count() == 594
    assert dict(fact.dtypes)["year"] == "smallint"
    warehouse.create_views(spark, "dw_ok")
    assert spark.table("dw_ok.v_sales_summary").agg(F.sum("transaction_count")).first()[0] == 594
    labels = [r.growth_status for r in spark.table("dw_ok.v_growth_trend").orderBy("month_label").collect()]
    assert labels[0] == "BASELINE"
    assert spark.table("dw_ok.v_category_performance").filter("revenue_rank = 1").count() == 1


def test_a_failing_table_is_isolated_and_keeps_its_rows(spark, curated, tmp_path):
    root = f"{curated[0]}/curated"
    jobs.load(spark, root, "dw_bad", str(tmp_path), "1")
    frames = {s.name: spark.table(f"dw_bad.{s.name}") for s in warehouse.TABLES}
    too_long = frames["fact_sales"].withColumn("region", F.lit("a region name longer than twenty"))
    with pytest.raises(warehouse.LoadError) as failure:
        warehouse.load_all(spark, {**frames, "fact_sales": too_long}, "dw_bad", str(tmp_path), "2")
    status = {r.table_name: r for r in failure.value.status.collect()}
    assert status["fact_sales"].status == "FAILED" and status["fact_sales"].error
    assert [n for n, r in status.items() if r.status == "SUCCESS"] == [s.name for s in warehouse.TABLES[1:]]
    assert spark.table("dw_bad.fact_sales").count() == 594


def test_missing_required_value_fails_the_load(spark, curated, tmp_path):
    fact = landing.read_fact(spark, f"{curated[0]}/curated/sales").withColumn("customer_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="customer_id is missing"):
        warehouse.load_table(spark, fact, warehouse.FACT_SALES, "default", str(tmp_path), "1")


def _fact_rows(spark, start, count, amount):
    """A sale every hour from the given moment on."""
    moment = F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + F.col("id") * 3600)
    rows = spark.range(count).select(
        F.concat(F.lit(f"{start}-"), F.col("id")).alias("transaction_id"), F.lit("c").alias("customer_id"), F.lit("Books").alias("product_category"),
        F.lit(amount).alias("amount"), moment.alias("timestamp"), F.lit("North").alias("region"))
    return kpis.add_date_parts(rows)


def test_a_load_of_one_month_writes_one_month(spark, tmp_path):
    spec = warehouse.FACT_SALES
    first = _fact_rows(spark, "2024-01-01 00:00:00", 24 * 91, 1)  # January to March
    assert warehouse.load_table(spark, first, spec, "default", str(tmp_path), "1") == 24 * 91
    january = _files_of(spark, "default.fact_sales", "month = 1")
    # As many rows as before under another size: the statistics still count them.
    again = _fact_rows(spark, "2024-02-01 00:00:00", 24 * 29, 123456)
    assert warehouse.load_table(spark, again, spec, "default", str(tmp_path), "2", [(2024, 2)]) == 24 * 91
    assert files.children(spark, f"{tmp_path}/fact_sales/load=2/year=2024") == ["month=2"]
    assert _files_of(spark, "default.fact_sales", "month = 1") == january
    assert all("load=2" in name for name in _files_of(spark, "default.fact_sales", "month = 2"))
    sums = {r.month: r.total for r in spark.table("default.fact_sales").groupBy("month").agg(F.sum("amount").alias("total")).collect()}
    assert sums == {1: 24 * 31, 2: 24 * 29 * 123456, 3: 24 * 31}
    assert warehouse.load_table(spark, again.limit(0), spec, "default", str(tmp_path), "3", [(2024, 1)]) == 24 * 60
    with pytest.raises(ValueError, match="outside the months"):
        warehouse.load_table(spark, again, spec, "default", str(tmp_path), "4", [(2024, 3)])
    assert spark.table("default.fact_sales").count() == 24 * 60
    assert warehouse.load_table(spark, again, spec, "default", str(tmp_path), "5") == 24 * 29
    spark.sql("DROP TABLE default.fact_sales")


def test_the_fact_is_clustered_and_pruned(spark, tmp_path):
    rows = _fact_rows(spark, "2024-01-01 00:00:00", 24 * 60, 1).repartition(8)
    ranged = files.cluster(warehouse.strict(rows, warehouse.FACT_SALES), ("year", "month", "transaction_ts", "transaction_id"), 6)
    ranged.write.partitionBy("year", "month").parquet(str(tmp_path / "ranged"))
    found = spark.read.parquet(str(tmp_path / "ranged")).groupBy(F.input_file_name().alias("file")).agg(
        F.min("transaction_ts").alias("low"), F.max("transaction_ts").alias("high")).orderBy("low").collect()
    assert len(found) >= 6 and all(a.high < b.low for a, b in zip(found, found[1:]))  # a span of time lies in few files
    warehouse.load_table(spark, rows, warehouse.FACT_SALES, "default", str(tmp_path), "1")
    february = spark.table("default.fact_sales").filter("year = 2024 AND month = 2 AND transaction_ts >= '2024-02-03'")
    assert february.inputFiles() and all("month=2" in name for name in february.inputFiles())
    spark.sql("DROP TABLE default.fact_sales")


def _files_of(spark, table, where):
    return sorted(r[0] for r in spark.table(table).filter(where).select(F.input_file_name()).distinct().collect())


def test_conform_and_violations(spark):
    df = spark.createDataFrame(
        [("Books", "123.456", "7"), ("x" * 60, "1e30", None)], "product_category string, total_revenue string, transaction_count string")
    got = warehouse.conform(df, warehouse.KPI_CATEGORY).collect()
    assert str(got[0].total_revenue) == "123.46" and got[1].product_category is None and got[1].total_revenue is None
    found = {r.column_name: (r.unfit, r.missing) for r in warehouse.violations(df, warehouse.KPI_CATEGORY).collect()}
    assert found["product_category"] == (1, 0) and found["total_revenue"] == (1, 0) and found["transaction_count"] == (0, 1)


def test_clustered_files_have_disjoint_ranges(spark, tmp_path):
    path = str(tmp_path / "clustered")
    files.cluster(spark.range(10_000).withColumn("c", F.col("id") % 3), ["id", "c"], files=4).write.parquet(path)
    spans = sorted((r.lo, r.hi) for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(
        F.min("id").alias("lo"), F.max("id").alias("hi")).collect())
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_scratch_uses_the_folder_the_cluster_names(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "/shared/work/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    first, second = scratch_path(Session(), "x"), scratch_path(Session(), "x")
    assert first.startswith("/shared/work/x-") and first != second


def test_command_line(spark, tmp_path, capsys):
    landing_dir, cleansed, curated_dir = (str(tmp_path / n) for n in ("landing", "cleansed", "curated"))
    main(["generate", "--rows", "40", "--landing", landing_dir])
    main(["cleanse", "--landing", landing_dir, "--cleansed", cleansed])
    main(["curate", "--cleansed", cleansed, "--curated", curated_dir, "--full"])
    main(["load", "--curated", curated_dir, "--database", "dw_cli", "--warehouse", str(tmp_path / "dw")])
    assert spark.table("dw_cli.fact_sales").count() == 40
    assert "SUCCESS" in capsys.readouterr().out
