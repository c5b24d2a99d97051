from decimal import Decimal
from fractions import Fraction
from random import Random

import pytest
from pyspark.sql import functions as F

from salesflow.functions import numbers, text
from salesflow.operators import kpis, profile


def fact(spark, *rows):
    """(key, customer, category, amount, 'yyyy-mm-dd', region) as dated fact rows."""
    df = spark.createDataFrame(
        [(k, c, p, Decimal(a), d, r) for k, c, p, a, d, r in rows],
        "transaction_id string, customer_id string, product_category string, amount decimal(12,2), day_text string, region string",
    )
    return kpis.add_date_parts(df.withColumn("timestamp", F.col("day_text").cast("timestamp")).drop("day_text"))


def months(spark, *totals):
    rows = [(f"t{i}", "c", "Books", amount, f"{label}-01", "r") for i, (label, amount) in enumerate(totals)]
    return kpis.monthly_sales_growth(kpis.measure_form(fact(spark, *rows))).collect()


def test_ratio_half_up_is_exact(spark):
    random = Random(7)
    pairs = [(random.randint(-10**12, 10**12), random.choice([1, 3, 7, 8, 200, random.randint(1, 10**9)])) for _ in range(300)]
    pairs += [(1, 200), (-1, 200), (3, 200), (5, 1000), (0, 5), (1, 0)]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in pairs], "a decimal(14,0), b decimal(14,0)")
    got = [r[0] for r in df.select(numbers.ratio_half_up(F.col("a"), F.col("b"))).collect()]
    for (a, b), value in zip(pairs, got):
        if b == 0:
            assert value is None
            continue
        units = int(abs(Fraction(a, b)) * 100 + Fraction(1, 2))
        assert value == Decimal(units if a >= 0 else -units) / 100


def test_previous_month_is_the_one_present(spark):
    jan, feb, apr = months(spark, ("2024-01", "100"), ("2024-02", "150"), ("2024-04", "75"))
    assert (jan.prev_month_revenue, jan.mom_growth_pct, jan.month_label) == (None, None, "2024-01")
    assert (feb.mom_growth_pct, apr.prev_month_revenue, apr.mom_growth_pct) == (Decimal("50.00"), Decimal("150.00"), Decimal("-50.00"))


def test_growth_is_null_after_a_month_without_revenue(spark):
    assert [r.mom_growth_pct for r in months(spark, ("2024-01", "0"), ("2024-02", "10"))] == [None, None]


def test_growth_words(spark):
    rows = months(spark, ("2024-01", "10"), ("2024-02", "20"), ("2024-03", "5"), ("2024-04", "5"))
    df = spark.createDataFrame([(r.month_label, r.mom_growth_pct) for r in rows], "m string, g decimal(20,2)")
    got = df.orderBy("m").select(text.growth_status(F.col("g")), text.growth_direction(F.col("g"))).collect()
    assert [tuple(r) for r in got] == [("BASELINE", "none"), ("GROWTH", "up"), ("DECLINE", "down"), ("FLAT", "none")]


def test_rank_keeps_ties_and_ordinal_does_not(spark):
    counts = dict(zip("abcdefg", (9, 8, 7, 6, 5, 5, 1)))
    rows = [(f"{r}{i}", "c", "Books", "1", "2024-01-01", r) for r, n in counts.items() for i in range(n)]
    measures = kpis.measure_form(fact(spark, *rows))
    assert [(r.region, r["rank"]) for r in kpis.top_regions(measures).collect()] == [
        ("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("f", 5)]
    assert [(r.region, r["rank"]) for r in kpis.top_regions(measures, ties=False).collect()] == [
        ("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]


def test_half_cent_average_and_shares(spark):
    measures = kpis.measure_form(fact(
        spark, ("1", "x", "Books", "0.01", "2024-01-01", "r"), ("2", "UNKNOWN", "Books", "0.02", "2024-01-01", "r"),
        ("3", "UNKNOWN", "Toys", "0.06", "2024-01-02", "r")))
    books, toys = sorted(kpis.revenue_per_category(measures).collect())
    assert books.avg_transaction_value == Decimal("0.02") and books.unique_customers == 2
    assert (books.revenue_pct, toys.revenue_pct) == (Decimal("33.33"), Decimal("66.67"))
    assert toys.unique_customers == 1 and (toys.min_amount, toys.max_amount) == (Decimal("0.06"), Decimal("0.06"))


def test_kpis_are_the_same_from_rows_and_from_the_rollup(spark):
    random = Random(3)
    rows = [(str(i), f"c{random.randint(1, 9)}", random.choice(["Books", "Toys"]), f"{random.randint(100, 9999) / 100:.2f}",
             f"2024-0{random.randint(1, 3)}-0{random.randint(1, 9)}", random.choice(["r", "s"])) for i in range(200)]
    measures = kpis.measure_form(fact(spark, *rows))
    rolled = kpis.monthly_rollup(measures)
    for kpi in (kpis.revenue_per_category, kpis.monthly_sales_growth, kpis.top_regions, kpis.sales_summary):
        assert sorted(map(tuple, kpi(measures).collect())) == sorted(map(tuple, kpi(rolled).collect()))


def test_empty_fact_gives_empty_kpis(spark):
    nothing = fact(spark, ("1", "x", "Books", "1", "2024-01-01", "r")).filter("false")
    measures = kpis.measure_form(nothing)
    assert kpis.revenue_per_category(measures).count() == kpis.top_regions(measures).count() == 0
    assert profile.run_summary(nothing).first().total_records == 0


def test_distinct_count_is_grouped_by_customer_before_the_category_shuffle(spark):
    measures = kpis.measure_form(fact(spark, ("1", "x", "Books", "1", "2024-01-01", "r")))
    plan = kpis.revenue_per_category(measures)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(product_category" in plan and "customer_id" in plan.split("hashpartitioning(product_category")[-1][:60]
    assert "Expand" not in plan


def test_rank_filter_is_pushed_into_the_window(spark):
    measures = kpis.measure_form(fact(spark, ("1", "x", "Books", "1", "2024-01-01", "r")))
    assert "WindowGroupLimit" in kpis.top_regions(measures)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("value, expected", [
    ("1234567.00", "$1.23M"), ("1000000", "$1.00M"), ("999999.99", "$1000.0K"), ("1000", "$1.0K"), ("12.30", "$12.30")])
def test_compact_currency(spark, value, expected):
    df = spark.createDataFrame([(Decimal(value),)], "v decimal(22,2)")
    assert df.select(text.compact_currency(F.col("v"))).first()[0] == expected


def test_keys_percent_and_clip(spark):
    df = spark.createDataFrame([(7, Decimal("1.5")), (12345678, Decimal("-0.4")), (1, None)], "n int, p decimal(6,2)")
    got = df.select(text.padded_key("CUST_", F.col("n"), 6), text.signed_percent(F.col("p")),
                    numbers.clip(F.col("n").cast("double"), 2.0, 10.0)).collect()
    assert [tuple(r) for r in got] == [
        ("CUST_000007", "+1.50%", 7.0), ("CUST_12345678", "-0.40%", 10.0), ("CUST_000001", "—", 2.0)]


def test_nan_to_null_reaches_nested_values(spark):
    df = spark.sql("SELECT double('NaN') a, array(double('Infinity'), 1D) b, named_struct('x', float('-Infinity'), 'y', 's') c")
    assert tuple(numbers.nan_to_null(df).first()) == (None, [None, 1.0], (None, "s"))
