"""The same questions in DuckDB SQL, written independently of the Spark code.

Money is whole cents in integers here; ``half_up`` rounds a quotient of integers.
"""

from __future__ import annotations

from salesflow import rules

ARRIVAL = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax"

LINES = """lines AS (
  SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL
              ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS transaction_id,
         CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE l_extendedprice END AS amount,
         CASE WHEN l_suppkey % 83 = 0 THEN NULL ELSE l_shipdate END AS "timestamp",
         *
  FROM lineitem)"""

ATTRIBUTES = """attributed AS (
  SELECT x.*,
         CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         p_type AS product_category, r_name AS region
  FROM {source} x
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey)"""

JUDGED = f"""judged AS (
  SELECT *, CASE WHEN transaction_id IS NULL THEN 'pk_null'
                 WHEN row_number() OVER (PARTITION BY transaction_id ORDER BY {ARRIVAL}) > 1 THEN 'duplicate'
                 WHEN amount IS NULL OR amount < 1 OR amount > 50000 THEN 'amount_invalid'
                 WHEN "timestamp" IS NULL THEN 'timestamp_null'
                 ELSE 'ok' END AS reason
  FROM lines)"""

KEPT = "kept AS (SELECT * FROM judged WHERE reason = 'ok')"

CLEAN = """clean AS (
  SELECT transaction_id,
         coalesce(customer_id, 'UNKNOWN') AS customer_id,
         CASE WHEN product_category IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD')
              THEN product_category ELSE 'UNKNOWN' END AS product_category,
         CAST(round(amount * 100) AS BIGINT) AS cents,
         "timestamp",
         CASE WHEN region IN ('AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') THEN region ELSE 'UNKNOWN' END AS region,
         CAST(year("timestamp") AS INT) AS year, CAST(month("timestamp") AS INT) AS month,
         CAST(day("timestamp") AS INT) AS day
  FROM attributed)"""

W_LINES = f"WITH {LINES}"
W_RAW = f"WITH {LINES}, {ATTRIBUTES.format(source='lines')}"
W_JUDGED = f"WITH {LINES}, {JUDGED}"
W_CLEAN = f"WITH {LINES}, {JUDGED}, {KEPT}, {ATTRIBUTES.format(source='kept')}, {CLEAN}"

LABEL = "CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0')"
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def half_up(numerator: str, denominator: str, digits: int = 0) -> str:
    """Positive integer quotient, rounded half up at ``digits`` places, as an integer of that scale."""
    return f"((2 * {numerator} * {10**digits} + {denominator}) // (2 * {denominator}))"


def hundredths(units: str) -> str:
    return f"(CAST({units} AS DOUBLE) / 100)"


def average(total: str, count: str) -> str:
    return hundredths(half_up(total, count))


def percent(part: str, whole: str) -> str:
    return hundredths(half_up(part, whole, 4))


MEASURES = """CAST(sum(cents) AS HUGEINT) AS total, CAST(count(*) AS BIGINT) AS transaction_count,
         count(DISTINCT customer_id) AS unique_customers"""

CATEGORY = f"""category AS (
  SELECT product_category, {hundredths('total')} AS total_revenue, transaction_count,
         {average('total', 'transaction_count')} AS avg_transaction_value,
         {hundredths('low')} AS min_amount, {hundredths('high')} AS max_amount, unique_customers,
         {percent('total', '(sum(total) OVER ())')} AS revenue_pct
  FROM (SELECT product_category, {MEASURES}, min(cents) AS low, max(cents) AS high FROM clean GROUP BY 1))"""

MONTHLY = f"""monthly AS (
  SELECT year, month, {hundredths('total')} AS total_revenue, transaction_count, unique_customers,
         {average('total', 'transaction_count')} AS avg_transaction_value, {LABEL} AS month_label,
         {hundredths('prev')} AS prev_month_revenue,
         CASE WHEN prev > 0 THEN sign(total - prev) * {percent('abs(total - prev)', 'prev')} END AS mom_growth_pct
  FROM (SELECT *, lag(total) OVER (ORDER BY year, month) AS prev
        FROM (SELECT year, month, {MEASURES} FROM clean GROUP BY 1, 2)))"""

REGIONS = f"""regions AS (
  SELECT region, transaction_count, {hundredths('total')} AS total_revenue,
         {average('total', 'transaction_count')} AS avg_revenue_per_txn, unique_customers,
         {percent('transaction_count', '(sum(transaction_count) OVER ())')} AS volume_share_pct,
         {percent('total', '(sum(total) OVER ())')} AS revenue_share_pct,
         CAST(rank() OVER (ORDER BY transaction_count DESC) AS INT) AS rank,
         CAST(row_number() OVER (ORDER BY transaction_count DESC, region) AS INT) AS ordinal
  FROM (SELECT region, {MEASURES} FROM clean GROUP BY 1))"""

SUMMARY = f"""
  SELECT year, month, product_category, region, transaction_count, {hundredths('total')} AS total_revenue,
         {average('total', 'transaction_count')} AS avg_order_value, unique_customers
  FROM (SELECT year, month, product_category, region, {MEASURES} FROM clean GROUP BY 1, 2, 3, 4)"""

FUNNEL = """counts AS (
  SELECT count(*) AS raw, count(*) FILTER (reason <> 'pk_null') AS keyed,
         count(*) FILTER (reason NOT IN ('pk_null', 'duplicate')) AS single,
         count(*) FILTER (reason IN ('ok', 'timestamp_null')) AS priced,
         count(*) FILTER (reason = 'ok') AS good FROM judged),
funnel AS (
  SELECT 1 AS step_no, 'raw' AS step, raw AS row_count FROM counts
  UNION ALL SELECT 2, 'after_pk_null_drop', keyed FROM counts
  UNION ALL SELECT 3, 'after_dedup', single FROM counts
  UNION ALL SELECT 4, 'after_amount', priced FROM counts
  UNION ALL SELECT 5, 'after_ts', good FROM counts
  UNION ALL SELECT 6, 'final', good FROM counts)"""

CATEGORIES_SQL = f"{W_CLEAN}, {CATEGORY} SELECT * FROM category"
MONTHS_SQL = f"{W_CLEAN}, {MONTHLY} SELECT * FROM monthly"
REGIONS_SQL = f"{W_CLEAN}, {REGIONS} SELECT * EXCLUDE (ordinal) FROM regions WHERE rank <= 5"
PERFORMANCE_SQL = f"""{W_CLEAN}, {CATEGORY} SELECT product_category, total_revenue, transaction_count,
  avg_transaction_value, revenue_pct, unique_customers,
  CAST(rank() OVER (ORDER BY total_revenue DESC) AS INT) AS revenue_rank FROM category"""
TREND_SQL = f"""{W_CLEAN}, {MONTHLY} SELECT month_label, total_revenue, mom_growth_pct,
  CASE WHEN mom_growth_pct > 0 THEN 'GROWTH' WHEN mom_growth_pct < 0 THEN 'DECLINE'
       WHEN mom_growth_pct = 0 THEN 'FLAT' ELSE 'BASELINE' END AS growth_status FROM monthly"""
RAW_TEXT = f"""transaction_id, customer_id, product_category, amount, {STAMP.format('"timestamp"')} AS "timestamp" """
CLEAN_ROWS = f"""transaction_id, customer_id, product_category, {hundredths('cents')} AS amount, "timestamp", region"""


def thousands(value: str) -> str:
    return f"format('{{:,}}', CAST({value} AS BIGINT))"


def places(units: str, digits: int) -> str:
    """An integer of the given scale as text."""
    scale = 10**digits
    return f"(CAST(({units}) // {scale} AS VARCHAR) || '.' || lpad(CAST(({units}) % {scale} AS VARCHAR), {digits}, '0'))"


def compact(cents: str) -> str:
    return f"""CASE WHEN {cents} >= 100000000 THEN '$' || {places(half_up(cents, '1000000'), 2)} || 'M'
      WHEN {cents} >= 100000 THEN '$' || {places(half_up(cents, '10000'), 1)} || 'K'
      ELSE '$' || {places(cents, 2)} END"""


DISPLAY_CATEGORIES = f"""{W_CLEAN}
  SELECT product_category, {compact('total')} AS revenue_short,
         '$' || {thousands('total // 100')} || '.' || lpad(CAST(total % 100 AS VARCHAR), 2, '0') AS revenue_text,
         {thousands('transaction_count')} AS transactions_text,
         {places(half_up('total', '(sum(total) OVER ())', 4), 2)} || '%' AS share_text
  FROM (SELECT product_category, {MEASURES} FROM clean GROUP BY 1)"""

DISPLAY_MONTHS = f"""{W_CLEAN}
  SELECT {LABEL} AS month_label, {compact('total')} AS revenue_short, {thousands('unique_customers')} AS customers_text,
         CASE WHEN prev IS NULL THEN '—' ELSE
           CASE WHEN total >= prev OR {half_up('abs(total - prev)', 'prev', 4)} = 0 THEN '+' ELSE '-' END
           || {places(half_up('abs(total - prev)', 'prev', 4), 2)} || '%' END AS growth_text
  FROM (SELECT *, lag(total) OVER (ORDER BY year, month) AS prev
        FROM (SELECT year, month, {MEASURES} FROM clean GROUP BY 1, 2))"""


STREAMS = [("customer", "customer"), ("amount-1", "amount1"), ("amount-2", "amount2"), ("moment", "moment"), ("category", "category"), ("region", "region")]


def bits(stream: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5('{seed}:{stream}:' || id), 1, 13) AS BIGINT)"


def draw(stream: str) -> str:
    return bits(stream).replace("|| id)", "|| o_orderkey)") + " / 4503599627370496.0"


def picked(u: str, weights: dict[str, float]) -> str:
    """The first value whose cumulated weight lies above the number."""
    reached, cases = 0.0, ""
    for value, weight in list(weights.items())[:-1]:
        reached += weight
        cases += f" WHEN {u} < {reached!r} THEN '{value}'"
    return f"CASE{cases} ELSE '{list(weights)[-1]}' END"


def all_sql() -> dict[str, str]:
    return {
        "raw_sales_map": f"""{W_RAW} SELECT transaction_id, customer_id, product_category, amount, "timestamp", region
            FROM attributed""",
        "typed_projection": f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
            CASE WHEN l_partkey % 89 <> 0 THEN l_extendedprice END AS amount,
            CASE WHEN l_suppkey % 83 <> 0 THEN {STAMP.format('l_shipdate')} END AS "timestamp" FROM lineitem""",
        "timestamp_coercion": f"""SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber % 3 = 2 AND l_suppkey % 83 = 0 THEN NULL ELSE {STAMP.format('l_shipdate')} END AS moment
            FROM lineitem""",
        "pk_filter": f"{W_LINES} SELECT transaction_id, amount FROM lines WHERE transaction_id IS NOT NULL",
        "amount_filter": f"{W_LINES} SELECT transaction_id, amount FROM lines WHERE amount BETWEEN 1 AND 50000",
        "ts_filter": f'{W_LINES} SELECT transaction_id, "timestamp" FROM lines WHERE "timestamp" IS NOT NULL',
        "normalise_domain": f"""{W_RAW} SELECT transaction_id,
            CASE WHEN product_category = 'PROMO' OR product_category IS NULL THEN 'UNKNOWN' ELSE product_category END AS product_category,
            CASE WHEN region = 'AFRICA' OR region IS NULL THEN 'UNKNOWN' ELSE region END AS region FROM attributed""",
        "normalise_domain_table": """SELECT c_custkey, CASE WHEN r_name <> 'AFRICA' THEN n_name ELSE 'UNKNOWN' END AS nation
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "impute_customer": f"{W_RAW} SELECT transaction_id, coalesce(customer_id, 'UNKNOWN') AS customer_id FROM attributed",
        "add_missing_columns": f"""{W_LINES} SELECT transaction_id, CAST(NULL AS VARCHAR) AS customer_id,
            CAST(NULL AS VARCHAR) AS product_category, amount, CAST(NULL AS VARCHAR) AS "timestamp",
            CAST(NULL AS VARCHAR) AS region FROM lines""",
        "key_construction": """SELECT o_orderkey, 'CUST_' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS customer_key,
            'TXN-000042-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS transaction_key FROM orders""",
        "clip_amount": "SELECT o_orderkey, greatest(least(o_totalprice, 50000.0::DOUBLE), 1.0::DOUBLE) AS clipped FROM orders",
        "nan_to_null": """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS value,
            CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS first, value AS second FROM events""",
        "complex_to_json": """SELECT l_orderkey, l_linenumber,
            '{"l_partkey":' || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}' AS item,
            '[' || l_partkey || ',' || l_suppkey || ']' AS ids FROM lineitem""",
        "dedup_first": f"""{W_JUDGED} SELECT transaction_id, amount, "timestamp", l_suppkey,
            n AS copies FROM (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS n FROM judged
            WHERE reason <> 'pk_null') WHERE reason <> 'duplicate'""",
        "dedup_any": f"{W_LINES} SELECT DISTINCT transaction_id FROM lines WHERE transaction_id IS NOT NULL",
        "dropped_copies": f"""{W_LINES} SELECT transaction_id, amount, l_shipdate, l_partkey, l_extendedprice, count(*) AS copies
            FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY l_shipdate, l_partkey, l_extendedprice) AS rn
                  FROM lines WHERE transaction_id IS NOT NULL) WHERE rn > 1 GROUP BY ALL""",
        "incremental_dedup": f"""{W_LINES}, late AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {ARRIVAL}) AS rn
            FROM lines WHERE transaction_id IS NOT NULL AND l_shipdate >= TIMESTAMP '1998-01-01')
            SELECT transaction_id, l_partkey, l_extendedprice FROM late WHERE rn = 1 AND transaction_id NOT IN
            (SELECT transaction_id FROM lines WHERE transaction_id IS NOT NULL AND l_shipdate < TIMESTAMP '1998-01-01')""",
        "union_resends": """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders UNION ALL
            SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'""",
        "cleansed": f"""{W_CLEAN} SELECT {CLEAN_ROWS}, 'sales_csv_landing' AS _source_system, '1.0.0' AS _pipeline_version FROM clean""",
        "cleansed_prefer_valid": f"""{W_LINES}, ranked AS (SELECT *,
              amount BETWEEN 1 AND 50000 AND "timestamp" IS NOT NULL AS valid FROM lines WHERE transaction_id IS NOT NULL)
            SELECT transaction_id, amount, "timestamp" FROM (SELECT *, row_number() OVER
              (PARTITION BY transaction_id ORDER BY {ARRIVAL}) AS rn FROM ranked WHERE valid) WHERE rn = 1""",
        "quality_funnel": f"{W_JUDGED}, {FUNNEL} SELECT * FROM funnel",
        "step_drops": f"""{W_JUDGED}, {FUNNEL} SELECT step_no, step, row_count,
            greatest(lag(row_count, 1, row_count) OVER (ORDER BY step_no) - row_count, 0) AS dropped,
            CAST({half_up('row_count', '(first(row_count) OVER (ORDER BY step_no))', 3)} AS DOUBLE) / 10 AS retained_pct FROM funnel""",
        "rejects_by_reason": f"{W_JUDGED} SELECT reason, count(*) AS row_count FROM judged GROUP BY 1",
        "rejected_rows": f"""{W_JUDGED} SELECT transaction_id, amount, n AS copies, reason FROM
            (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS n FROM judged) WHERE reason IN ('amount_invalid', 'timestamp_null')""",
        "null_profile": f"""{W_RAW}, c AS (SELECT count(*) AS n, count(transaction_id) AS a, count(customer_id) AS b,
              count(product_category) AS c, count(amount) AS d, count("timestamp") AS e, count(region) AS f FROM attributed)
            SELECT 'transaction_id' AS column_name, n - a AS null_count FROM c UNION ALL SELECT 'customer_id', n - b FROM c
            UNION ALL SELECT 'product_category', n - c FROM c UNION ALL SELECT 'amount', n - d FROM c
            UNION ALL SELECT 'timestamp', n - e FROM c UNION ALL SELECT 'region', n - f FROM c""",
        "date_parts": f"{W_CLEAN} SELECT transaction_id, year, month, day FROM clean",
        "month_label": f"{W_CLEAN} SELECT transaction_id, {LABEL} AS month_label FROM clean",
        "grand_totals": f"{W_CLEAN} SELECT {hundredths('sum(cents)')} AS total_revenue, count(*) AS transaction_count FROM clean",
        "kpi_revenue_per_category": CATEGORIES_SQL,
        "kpi_monthly_sales_growth": MONTHS_SQL,
        "kpi_top_regions": REGIONS_SQL,
        "kpi_top_regions_ordinal": f"""{W_CLEAN}, {REGIONS} SELECT * EXCLUDE (rank, ordinal), ordinal AS rank
            FROM regions WHERE ordinal <= 3""",
        "kpi_last_six_months": f"""{W_CLEAN}, {MONTHLY} SELECT month_label, total_revenue, mom_growth_pct FROM monthly
            ORDER BY year DESC, month DESC LIMIT 6""",
        "monthly_rollup": f"""{W_CLEAN} SELECT year, month, product_category, region, customer_id,
            {hundredths('sum(cents)')} AS revenue, count(*) AS txns, {hundredths('min(cents)')} AS low,
            {hundredths('max(cents)')} AS high FROM clean GROUP BY ALL""",
        "share_of_total": f"{W_CLEAN}, {REGIONS} SELECT region, volume_share_pct, revenue_share_pct FROM regions",
        "v_sales_summary": f"{W_CLEAN} {SUMMARY}",
        "v_category_performance": PERFORMANCE_SQL,
        "v_growth_trend": TREND_SQL,
        "growth_direction": f"""{W_CLEAN}, {MONTHLY} SELECT month_label, mom_growth_pct,
            CASE WHEN mom_growth_pct > 0 THEN 'up' WHEN mom_growth_pct < 0 THEN 'down' ELSE 'none' END AS direction FROM monthly""",
        "size_normalised": f"""{W_CLEAN}, {REGIONS} SELECT region, unique_customers,
            round(CAST(unique_customers AS DOUBLE) / max(unique_customers) OVER () * 60 + 20, 6) AS marker_size
            FROM regions WHERE rank <= 5""",
        "run_summary": f"""{W_CLEAN} SELECT transaction_count AS total_records, {hundredths('total')} AS total_revenue,
            {average('total', 'transaction_count')} AS avg_transaction, unique_customers FROM (SELECT {MEASURES} FROM clean)""",
        "category_distribution": f"""{W_RAW} SELECT product_category, count(*) AS row_count FROM attributed
            WHERE product_category IS NOT NULL GROUP BY 1""",
        "partition_inventory": f"""{W_CLEAN} SELECT count(DISTINCT (year, month, day)) AS partitions,
            min(year) AS first_year, max(year) AS last_year FROM clean""",
        "distinct_years": f"{W_CLEAN} SELECT DISTINCT year FROM clean",
        "distinct_categories": f"{W_CLEAN} SELECT DISTINCT product_category FROM clean",
        "fact_preview_filtered": f"""{W_CLEAN} SELECT {CLEAN_ROWS}, year, month, day FROM clean
            WHERE year IN (1996, 1997) AND product_category IN ('LARGE', 'UNKNOWN') ORDER BY "timestamp", transaction_id LIMIT 500""",
        "fact_filtered": f"""{W_CLEAN} SELECT transaction_id, customer_id, {hundredths('cents')} AS amount, region, year, month, day
            FROM clean WHERE year = 1998 AND product_category = 'SMALL'""",
        "raw_head": f"{W_LINES} SELECT l_orderkey, {ARRIVAL} FROM lines ORDER BY l_orderkey, {ARRIVAL} LIMIT 10",
        "preview_format": f"""{W_CLEAN} SELECT transaction_id, customer_id, product_category, {hundredths('cents')} AS amount,
            {STAMP.format('"timestamp"')} AS "timestamp", region FROM clean""",
        "display_categories": DISPLAY_CATEGORIES,
        "display_months": DISPLAY_MONTHS,
        "daily_event_revenue": f"""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
            {hundredths('sum(CAST(round(value * 100) AS BIGINT))')} AS total_revenue, count(*) AS transaction_count FROM events GROUP BY 1, 2""",
        "csv_landing_scan": f"{W_RAW} SELECT {RAW_TEXT}, region FROM attributed",
        "csv_corrupt_rows": """SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS VARCHAR) AS line_number,
            CASE WHEN l_linenumber <> 7 THEN CAST(l_partkey AS VARCHAR) END AS part_key,
            CASE WHEN l_linenumber = 7 THEN l_orderkey || ',' || l_linenumber
                 WHEN l_linenumber = 6 THEN l_orderkey || ',' || l_linenumber || ',' || l_partkey || ',extra' END AS record
            FROM lineitem""",
        "csv_contract_check": f"{W_RAW} SELECT {RAW_TEXT}, CAST(NULL AS VARCHAR) AS region FROM attributed",
        "csv_text_payload": f"{W_RAW} SELECT {RAW_TEXT}, region FROM attributed",
        "csv_line_records": f"{W_RAW} SELECT {RAW_TEXT}, region FROM attributed",
        "csv_quoted_breaks": """SELECT CAST(l_orderkey AS VARCHAR) AS order_key,
            l_returnflag || ', "quoted"' || chr(10) || l_linestatus AS note FROM lineitem""",
        "json_records": f"""SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'generated' ELSE CAST(o_orderkey AS VARCHAR) END AS transaction_id,
            CAST(o_custkey AS VARCHAR) AS customer_id, o_totalprice AS amount,
            CASE WHEN o_orderstatus = 'F' THEN '2024-01-15 00:00:00' ELSE {STAMP.format('o_orderdate')} END AS "timestamp",
            CAST(NULL AS VARCHAR) AS region FROM orders""",
        "schema_discovery": """SELECT column_name, kind AS found_type, kind AS contract_type, true AS matches FROM (VALUES
            ('transaction_id', 'string'), ('product_category', 'string'), ('amount', 'double'), ('timestamp', 'timestamp'),
            ('region', 'string')) t(column_name, kind)
            UNION ALL SELECT 'customer_id', 'int', 'string', false WHERE (SELECT max(o_custkey) FROM orders) < 2147483648""",
        "synthetic_funnel": """WITH n AS (SELECT count(*) AS n FROM orders)
            SELECT 1 AS step_no, 'raw' AS step, n + n // 200 AS row_count FROM n
            UNION ALL SELECT 2, 'after_pk_null_drop', n + n // 200 FROM n UNION ALL SELECT 3, 'after_dedup', n FROM n
            UNION ALL SELECT 4, 'after_amount', n - n // 100 FROM n UNION ALL SELECT 5, 'after_ts', n - n // 100 FROM n
            UNION ALL SELECT 6, 'final', n - n // 100 FROM n""",
        "synthetic_nulls": """WITH n AS (SELECT count(*) AS n FROM orders)
            SELECT 'transaction_id' AS column_name, CAST(0 AS BIGINT) AS null_count UNION ALL SELECT 'customer_id', n // 100 FROM n
            UNION ALL SELECT 'product_category', 0 UNION ALL SELECT 'amount', n // 100 FROM n
            UNION ALL SELECT 'timestamp', 0 UNION ALL SELECT 'region', 0""",
        "synthetic_resends": "SELECT count(*) // 200 AS rows, count(*) // 200 AS keys, 20 AS key_length FROM orders",
        "synthetic_values": f"""WITH drawn AS (SELECT o_orderkey AS id, {', '.join(f"{draw(name)} AS {alias}" for name, alias in STREAMS)} FROM orders)
            SELECT id, 'TXN-332598-' || lpad(CAST(id AS VARCHAR), 9, '0') AS transaction_id,
            'CUST-' || lpad(CAST(CAST(floor(customer * 100000) AS BIGINT) + 1 AS VARCHAR), 6, '0') AS customer_id,
            {picked('category', dict(zip(rules.CATEGORIES, rules.CATEGORY_WEIGHTS)))} AS product_category, {picked('region', dict(zip(rules.REGIONS, rules.REGION_WEIGHTS)))} AS region,
            least(greatest(round(exp(4.0 + 1.2 * sqrt(-2.0 * ln(1.0 - amount1)) * cos(2 * pi() * amount2)), 2), 1.0), 50000.0) AS amount,
            strftime(TIMESTAMP '2022-01-01 00:00:00' + to_seconds(CAST(floor(moment * 94694399) AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS "timestamp"
            FROM drawn""",
        "synthetic_gapped_nulls": f"""WITH ids AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id FROM lineitem), n AS (SELECT count(*) // 100 AS k FROM ids)
            SELECT id, row_number() OVER (ORDER BY {bits('sample', 43)}, id) <= (SELECT k FROM n) AS no_amount,
            row_number() OVER (ORDER BY {bits('sample', 44)}, id) <= (SELECT k FROM n) AS no_customer FROM ids""",
        "synthetic_gapped_resends": f"""WITH ids AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id FROM lineitem), n AS (SELECT count(*) // 200 AS k FROM ids)
            SELECT id FROM ids QUALIFY row_number() OVER (ORDER BY {bits('sample', 45)}, id) <= (SELECT k FROM n)""",
        "schema_combination": """SELECT * FROM (VALUES ('o_orderkey', 'int', CAST(2 AS INT), 'int', true), ('total', 'double', 2, 'double,int', true),
            ('placed', 'date', 1, 'date', true), ('flag', 'string', 2, 'boolean,int', false))
            t(column_name, joined_type, files, types_met, compatible) WHERE (SELECT max(o_orderkey) FROM orders) < 2147483648""",
        "weighted_choice": """SELECT o_orderkey, CASE WHEN o_orderkey * 7919 % 1000 < 500 THEN 'a'
            WHEN o_orderkey * 7919 % 1000 < 800 THEN 'b' ELSE 'c' END AS choice FROM orders""",
        "cleanse_job": f"""{W_CLEAN} SELECT {CLEAN_ROWS},
            'sales_csv_landing' AS _source_system, '1.0.0' AS _pipeline_version FROM clean""",
        "cleanse_job_funnel": f"{W_JUDGED}, {FUNNEL} SELECT * FROM funnel",
        "cleanse_job_rejects": f"""WITH {LINES}, {JUDGED}, {ATTRIBUTES.format(source='judged')}
            SELECT transaction_id, customer_id, product_category, amount, {STAMP.format('"timestamp"')} AS "timestamp", region, reason,
            count(*) AS row_count FROM attributed WHERE reason <> 'ok' GROUP BY ALL""",
        "catalog_cleansed_table": f"""{W_CLEAN} SELECT product_category, count(*) AS row_count,
            {hundredths('sum(cents)')} AS total_revenue FROM clean GROUP BY 1""",
        "fact_partition_overwrite": f"""{W_CLEAN} SELECT year, month, count(*) AS row_count,
            {hundredths('sum(CASE WHEN year = 1997 AND month <= 3 THEN 2 * cents ELSE cents END)')} AS total_revenue FROM clean GROUP BY 1, 2""",
        "partition_discovery": f"{W_CLEAN} SELECT year, month, day, count(*) AS row_count FROM clean GROUP BY 1, 2, 3",
        "curate_job_categories": CATEGORIES_SQL,
        "curate_job_months": MONTHS_SQL,
        "curate_job_regions": REGIONS_SQL,
        "curate_two_batches": MONTHS_SQL,
        "curate_moved_day": f"""{W_CLEAN}, moved AS (SELECT *, "timestamp" >= DATE '1997-01-01' AND "timestamp" < DATE '1997-04-01' AS resent FROM clean),
            dated AS (SELECT *, CASE WHEN resent THEN CAST("timestamp" + INTERVAL 45 DAY AS DATE) ELSE CAST("timestamp" AS DATE) END AS on_day FROM moved)
            SELECT transaction_id, customer_id, product_category, {hundredths('CASE WHEN resent THEN 2 * cents ELSE cents END')} AS amount, region,
            CAST(year(on_day) AS INT) AS year, CAST(month(on_day) AS INT) AS month, CAST(day(on_day) AS INT) AS day FROM dated""",
        "curate_moved_months": MONTHS_SQL.replace(
            "FROM attributed)", """FROM (SELECT * REPLACE (CASE WHEN "timestamp" >= DATE '1997-01-01' AND "timestamp" < DATE '1997-04-01'
            THEN "timestamp" + INTERVAL 365 DAY ELSE "timestamp" END AS "timestamp") FROM attributed))""", 1),
        "console_summary_categories": f"{W_CLEAN}, {CATEGORY} SELECT product_category, total_revenue, revenue_pct FROM category",
        "console_summary_months": f"""{W_CLEAN}, {MONTHLY} SELECT month_label, total_revenue, mom_growth_pct FROM monthly
            ORDER BY year DESC, month DESC LIMIT 6""",
        "console_summary_regions": f"{W_CLEAN}, {REGIONS} SELECT rank, region, transaction_count, volume_share_pct FROM regions WHERE rank <= 5",
        "csv_export": f"{W_CLEAN}, {MONTHLY} SELECT month_label, total_revenue, prev_month_revenue, mom_growth_pct FROM monthly",
        "report_bundle": f"""{W_CLEAN}, {REGIONS} SELECT 'summary' AS section, CAST(NULL AS VARCHAR) AS region,
            CAST(NULL AS BIGINT) AS transaction_count, CAST(NULL AS DOUBLE) AS revenue_share_pct, count(*) AS total_records,
            {hundredths('sum(cents)')} AS total_revenue FROM clean
            UNION ALL SELECT 'top_regions_by_volume', region, transaction_count, revenue_share_pct, NULL, total_revenue
            FROM regions WHERE rank <= 5""",
        "report_sections": f"""{W_CLEAN}, {REGIONS}
            SELECT 'stats' AS section, 'dropped,retained_pct,row_count,step,step_no' AS fields, CAST(6 AS BIGINT) AS row_count
            UNION ALL SELECT 'summary', 'avg_transaction,total_records,total_revenue,unique_customers', 1
            UNION ALL SELECT 'revenue_per_category',
              '_computed_at,avg_transaction_value,max_amount,min_amount,product_category,revenue_pct,total_revenue,transaction_count,unique_customers',
              count(DISTINCT product_category) FROM clean
            UNION ALL SELECT 'monthly_sales_growth',
              '_computed_at,avg_transaction_value,mom_growth_pct,month,month_label,prev_month_revenue,total_revenue,transaction_count,unique_customers,year',
              count(DISTINCT (year, month)) FROM clean
            UNION ALL SELECT 'top_regions_by_volume',
              '_computed_at,avg_revenue_per_txn,rank,region,revenue_share_pct,total_revenue,transaction_count,unique_customers,volume_share_pct',
              count(*) FROM regions WHERE rank <= 5
            UNION ALL SELECT 'raw_preview', 'amount,customer_id,product_category,region,timestamp,transaction_id', least(count(*), 100) FROM clean""",
        "report_stats": f"""{W_JUDGED}, {FUNNEL} SELECT step_no, step, row_count,
            greatest(lag(row_count, 1, row_count) OVER (ORDER BY step_no) - row_count, 0) AS dropped,
            CAST({half_up('row_count', '(first(row_count) OVER (ORDER BY step_no))', 3)} AS DOUBLE) / 10 AS retained_pct FROM funnel""",
        "report_summary": f"""{W_CLEAN} SELECT count(*) AS total_records, {hundredths('sum(cents)')} AS total_revenue,
            {average('CAST(sum(cents) AS HUGEINT)', 'count(*)')} AS avg_transaction, count(DISTINCT customer_id) AS unique_customers FROM clean""",
        "report_categories": CATEGORIES_SQL,
        "report_months": MONTHS_SQL,
        "report_regions": REGIONS_SQL,
        "report_preview": f"""{W_CLEAN} SELECT transaction_id, customer_id, product_category, {hundredths('cents')} AS amount,
            {STAMP.format('"timestamp"')} AS "timestamp", region FROM clean ORDER BY clean."timestamp", transaction_id LIMIT 100""",
        "warehouse_load_status": f"""{W_CLEAN}, {REGIONS} SELECT 'fact_sales' AS table_name, 'SUCCESS' AS status, count(*) AS row_count FROM clean
            UNION ALL SELECT 'kpi_revenue_per_category', 'SUCCESS', count(DISTINCT product_category) FROM clean
            UNION ALL SELECT 'kpi_monthly_sales_growth', 'SUCCESS', count(DISTINCT (year, month)) FROM clean
            UNION ALL SELECT 'kpi_top_regions_by_volume', 'SUCCESS', count(*) FROM regions WHERE rank <= 5""",
        "warehouse_load_absent": f"""{W_CLEAN} SELECT 'fact_sales' AS table_name, 'SUCCESS' AS status, count(*) AS row_count FROM clean
            UNION ALL SELECT 'kpi_revenue_per_category', 'SUCCESS', count(DISTINCT product_category) FROM clean
            UNION ALL SELECT 'kpi_monthly_sales_growth', 'SUCCESS', count(DISTINCT (year, month)) FROM clean
            UNION ALL SELECT 'kpi_top_regions_by_volume', 'FAILED', NULL""",
        "warehouse_fact": f"""{W_CLEAN} SELECT transaction_id, customer_id, product_category, {hundredths('cents')} AS amount,
            {STAMP.format('"timestamp"')} AS transaction_ts, region, CAST(year AS SMALLINT) AS year,
            CAST(month AS SMALLINT) AS month, CAST(day AS SMALLINT) AS day, 'sales_csv_landing' AS _source_system,
            '1.0.0' AS _pipeline_version FROM clean""",
        "warehouse_month_swap": f"""{W_CLEAN} SELECT transaction_id, product_category, region,
            {hundredths('CASE WHEN year = 1998 AND month = 3 THEN 2 * cents ELSE cents END')} AS amount,
            CAST(year AS SMALLINT) AS year, CAST(month AS SMALLINT) AS month, CAST(day AS SMALLINT) AS day
            FROM clean WHERE NOT (year = 1998 AND month = 4)""",
        "warehouse_monthly": f"""{W_CLEAN}, {MONTHLY} SELECT * REPLACE (CAST(year AS SMALLINT) AS year, CAST(month AS SMALLINT) AS month)
            FROM monthly""",
        "warehouse_categories": CATEGORIES_SQL,
        "warehouse_regions": REGIONS_SQL,
        "warehouse_view_summary": f"""SELECT * REPLACE (CAST(year AS SMALLINT) AS year, CAST(month AS SMALLINT) AS month)
            FROM ({W_CLEAN} {SUMMARY})""",
        "warehouse_view_categories": PERFORMANCE_SQL,
        "warehouse_view_trend": TREND_SQL,
        "warehouse_tables": """SELECT unnest(['fact_sales', 'kpi_revenue_per_category', 'kpi_monthly_sales_growth',
            'kpi_top_regions_by_volume', 'v_sales_summary', 'v_category_performance', 'v_growth_trend']) AS table_name""",
        "warehouse_violations": f"""{W_RAW}, c AS (SELECT count(*) AS n, count(transaction_id) AS a, count(customer_id) AS b,
              count(amount) AS d, count("timestamp") AS e FROM attributed)
            SELECT 'transaction_id' AS column_name, CAST(0 AS BIGINT) AS unfit, n - a AS missing FROM c UNION ALL SELECT 'customer_id', 0, n - b FROM c
            UNION ALL SELECT 'amount', 0, n - d FROM c
            UNION ALL SELECT unnest(['transaction_ts', 'year', 'month', 'day']), 0, n - e FROM c""",
        "warehouse_conform": f"""{W_RAW} SELECT transaction_id, CAST(round(amount * 100) AS DOUBLE) / 100 AS amount, region,
            CAST(year("timestamp") AS SMALLINT) AS year, CAST(month("timestamp") AS SMALLINT) AS month,
            CAST(day("timestamp") AS SMALLINT) AS day FROM attributed""",
        "clustered_layout": f"{W_CLEAN} SELECT transaction_id, product_category, {hundredths('cents')} AS amount, region FROM clean",
        "day_compaction": f"""{W_CLEAN} SELECT year, month, count(*) AS row_count, {hundredths('sum(cents)')} AS total_revenue
            FROM clean GROUP BY 1, 2""",
        "stream_landing_ingest": f"{W_RAW} SELECT {RAW_TEXT}, region FROM attributed",
        "stream_cleanse": f"""{W_RAW} SELECT transaction_id, coalesce(customer_id, 'UNKNOWN') AS customer_id,
            CASE WHEN product_category IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD') THEN product_category ELSE 'UNKNOWN' END AS product_category,
            amount, CASE WHEN region IN ('AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') THEN region ELSE 'UNKNOWN' END AS region
            FROM attributed WHERE transaction_id IS NOT NULL AND amount BETWEEN 1 AND 50000 AND "timestamp" IS NOT NULL""",
        "stream_dedup": "SELECT event_id, user_id, event_type, value FROM events",
        "stream_windowed_revenue": f"""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
            {hundredths('sum(CAST(round(value * 100) AS BIGINT))')} AS total_revenue, count(*) AS transaction_count FROM events GROUP BY 1, 2""",
        "stream_window_customers": """WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, user_id FROM events
            UNION ALL SELECT 'all', event_type, user_id FROM events)
            SELECT day, event_type, count(DISTINCT user_id) AS users, true AS within_five_errors FROM e GROUP BY 1, 2""",
        "stream_malformed_rows": """WITH l AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS k, l_linenumber = 7 AS short,
            l_partkey % 3 AS kind, CAST(l_suppkey AS VARCHAR) AS s FROM lineitem)
            SELECT k AS row_key, CASE kind WHEN 1 THEN 'with, comma' ELSE 'plain' END AS note, s AS supplier, CAST(NULL AS VARCHAR) AS line
            FROM l WHERE kind <> 0 AND NOT short
            UNION ALL SELECT NULL, NULL, NULL, k || ',' || CASE kind WHEN 1 THEN '"with, comma"' ELSE 'plain' END FROM l WHERE kind <> 0 AND short
            UNION ALL SELECT NULL, NULL, NULL, k || ',"first' FROM l WHERE kind = 0
            UNION ALL SELECT NULL, NULL, NULL, k || ' second"' || CASE WHEN short THEN '' ELSE ',' || s END FROM l WHERE kind = 0""",
        "stream_closed_windows": f"""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type,
            {hundredths('sum(CAST(round(value * 100) AS BIGINT))')} AS total_revenue, count(*) AS transaction_count FROM events
            WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2""",
        "stream_kpi_refresh": MONTHS_SQL,
        "refresh_funnel": f"{W_JUDGED}, {FUNNEL} SELECT * FROM funnel",
        "refresh_rejects": f"""WITH {LINES}, {JUDGED}, {ATTRIBUTES.format(source='judged')}
            SELECT transaction_id, customer_id, product_category, amount, {STAMP.format('"timestamp"')} AS "timestamp", region, reason,
            count(*) AS row_count FROM attributed WHERE reason <> 'ok' GROUP BY ALL""",
        "stream_kpi_refresh_categories": CATEGORIES_SQL,
        "stream_kpi_refresh_regions": REGIONS_SQL,
    }
