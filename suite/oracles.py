"""SQL stating what each registered query must return, over the given tables.

A statement is a body plus the common table expressions it names, resolved here in dependency order.
"""

from __future__ import annotations

import re

from tallyhouse import settings as S
from tallyhouse.operators.validation import CUSTOMER_RULES, SALES_RULES

BATCH = "BATCH-20240630120000"
DOLLARS = "DECIMAL(18,2)"


def half_up(x: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"floor(({x}) * {scale}.0 + 0.5) / {scale}.0"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0.0))"


def percent(a: str, b: str) -> str:
    return half_up(f"{ratio(a, b)} * 100.0")


def mean(x: str) -> str:
    return half_up(ratio(f"sum({x})", f"count({x})"))


def dollars(x: str) -> str:
    """Exact amount as the plain number results are compared in."""
    return f"CAST(CAST({x} AS {DOLLARS}) AS DOUBLE)"


def whole(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def moment(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


CTES: dict[str, str] = {}

# --- bronze -----------------------------------------------------------------------------------
PRICE = "CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS DECIMAL(12,2))"
CTES["bronze_sales_raw"] = f"""
SELECT l_orderkey || '-' || l_linenumber AS transaction_id, l_shipdate AS "timestamp",
  CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS customer_id,
  l_partkey AS product_id, l_suppkey AS store_id,
  CASE WHEN (l_orderkey * 7 + l_partkey) % 150 = 0 THEN -2 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
  {PRICE} AS unit_price,
  CASE WHEN (l_orderkey + l_suppkey) % 120 <> 0 THEN
    CASE l_linenumber % 3 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'PayPal' ELSE 'Cash' END END AS payment_method,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Online'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'Mobile App' ELSE 'In-Store' END AS channel
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
CTES["bronze_customers_raw"] = """
SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
  CASE WHEN c_custkey % 20 <> 5 THEN
    lower(split_part(c_name, '#', 1)) || '.' || split_part(c_name, '#', 2) || copy || '@example.com' END AS email,
  '+1-555-' || (c_custkey % 900 + 100) AS phone,
  strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y-%m-%d') AS signup_date,
  CASE c_custkey % 6 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Platinum'
    WHEN 4 THEN 'VIP' ELSE 'Basic' END AS loyalty_tier,
  'CITY_' || c_nationkey AS city, c_custkey % 119 + 2 AS web_sessions_count,
  c_custkey % 2 = 0 AS opt_in_marketing, copy AS feed_seq
FROM customer JOIN (VALUES (0), (1)) AS copies(copy) ON copy = 0 OR c_custkey % 40 = 0"""
CTES["bronze_products_raw"] = """
SELECT p_partkey AS product_id, p_name || CASE copy WHEN 0 THEN '' ELSE ' (copy)' END AS product_name,
  p_type AS category,
  CAST(floor(p_retailprice * (50 + p_partkey % 36) + 0.5) / 100 AS DECIMAL(12,2)) AS unit_cost,
  CAST(floor(p_retailprice * 100 + 0.5) / 100 AS DECIMAL(12,2)) AS suggested_retail_price,
  p_brand AS supplier, copy AS feed_seq
FROM part JOIN (VALUES (0), (1)) AS copies(copy) ON copy = 0 OR p_partkey % 50 = 0
WHERE p_partkey % 97 <> 0"""
CTES["bronze_stores_raw"] = """
SELECT s_suppkey AS store_id, s_name AS store_name, 'CITY_' || (s_suppkey % 7) AS city, n_name AS state,
  r_name AS region, s_suppkey * 37 % 35001 + 15000 AS square_feet, s_suppkey % 9 + 2015 AS opened_year
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
CTES["bronze_inventory_raw"] = """
SELECT l_partkey AS product_id, l_suppkey AS store_id, (l_partkey * 7 + l_suppkey * 13) % 251 AS stock_on_hand,
  (l_partkey + l_suppkey) % 26 + 15 AS reorder_point, (l_partkey * 3 + l_suppkey) % 16 + 10 AS safety_stock,
  strftime(l_shipdate, '%Y-%m-%d') AS last_restock_date
FROM lineitem"""
CTES["retail_lines"] = f"""
SELECT row_seq, CASE WHEN l_orderkey % 50 = 0 THEN 'C' ELSE '' END || l_orderkey AS InvoiceNo,
  CAST(l_partkey AS VARCHAR) AS StockCode,
  CASE WHEN l_partkey % 16 <> 0 THEN p_name END AS Description,
  CAST(CASE WHEN l_orderkey % 50 = 0 OR (l_orderkey + l_suppkey) % 20 = 0
    THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS VARCHAR) AS Quantity,
  CASE (l_orderkey + l_partkey) % 60 WHEN 0 THEN 'INVALID_TIMESTAMP' WHEN 30 THEN '2024-99-99 25:99:99'
    ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS InvoiceDate,
  CASE (l_partkey + l_suppkey) % 70 WHEN 0 THEN '95000.0' WHEN 35 THEN '-15.5'
    ELSE CAST({PRICE} AS VARCHAR) END AS UnitPrice,
  CASE WHEN o_custkey % 12 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS CustomerID,
  CASE o_orderkey % 90 WHEN 18 THEN 'uk' WHEN 36 THEN 'UNKNOWN_COUNTRY' WHEN 54 THEN '  Germany  '
    ELSE n_name END AS Country
FROM (SELECT *, row_number() OVER () - 1 AS row_seq FROM lineitem)
JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

# --- silver -----------------------------------------------------------------------------------
_SALES_ORDER = ", ".join(
    f'{c} NULLS FIRST'
    for c in ('"timestamp"', "product_id", "store_id", "quantity", "unit_price", "customer_id", "payment_method",
              "channel")
)


def _first(table: str, keys: str, order: str) -> str:
    return f"""
SELECT * EXCLUDE (_rank) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rank FROM {table}) WHERE _rank = 1"""


CTES["first_sales"] = _first("bronze_sales_raw", "transaction_id", _SALES_ORDER)
CTES["first_customers"] = _first("bronze_customers_raw", "customer_id", "feed_seq")
CTES["first_products"] = _first("bronze_products_raw", "product_id", "feed_seq")
CTES["first_inventory"] = _first("bronze_inventory_raw", "product_id, store_id", "last_restock_date")
CTES["silver_sales"] = f"""
SELECT * REPLACE (coalesce(payment_method, 'Unknown') AS payment_method),
  CAST("timestamp" AS DATE) AS transaction_date, hour("timestamp") AS transaction_hour,
  CAST(quantity * unit_price AS {DOLLARS}) AS gross_amount
FROM first_sales WHERE quantity > 0"""
EMAIL = "coalesce(email, lower(first_name) || '.' || lower(last_name) || '@placeholder.com')"
CTES["silver_customers"] = f"""
SELECT * REPLACE ({EMAIL} AS email, CAST(signup_date AS DATE) AS signup_date) FROM first_customers"""
CTES["silver_products"] = f"""
SELECT *, {percent('suggested_retail_price - unit_cost', 'suggested_retail_price')} AS profit_margin_pct
FROM first_products"""
CTES["silver_stores"] = "SELECT * FROM bronze_stores_raw"
CTES["silver_inventory"] = """
SELECT *, CASE WHEN stock_on_hand <= reorder_point THEN 'REORDER_NEEDED' ELSE 'HEALTHY' END AS reorder_status
FROM first_inventory"""

# --- gold -------------------------------------------------------------------------------------
CTES["customer_agg"] = f"""
SELECT customer_id, count(DISTINCT transaction_id) AS total_orders, CAST(sum(gross_amount) AS {DOLLARS}) AS total_spend,
  {mean('gross_amount')} AS avg_order_value, max(transaction_date) AS last_purchase_date
FROM silver_sales WHERE customer_id IS NOT NULL GROUP BY customer_id"""
CTES["customer_recency"] = f"""
SELECT c.*, coalesce(total_orders, 0) AS total_orders, coalesce(total_spend, CAST(0 AS {DOLLARS})) AS total_spend,
  coalesce(avg_order_value, 0.0) AS avg_order_value, last_purchase_date,
  coalesce(date_diff('day', last_purchase_date, (SELECT max(transaction_date) FROM silver_sales)), 999)
    AS days_since_last_purchase
FROM silver_customers c LEFT JOIN customer_agg USING (customer_id)"""


def _segment(spends: tuple[int, int, int, int]) -> str:
    champion, loyal, potential, risk = spends
    days = "days_since_last_purchase"
    return (
        f"CASE WHEN total_spend > {champion} AND {days} <= 30 THEN 'Champions' "
        f"WHEN total_spend > {loyal} AND {days} <= 60 THEN 'Loyal Customers' "
        f"WHEN total_spend > {potential} AND {days} <= 90 THEN 'Potential Loyalists' "
        f"WHEN {days} > 90 AND total_spend > {risk} THEN 'At Risk' ELSE 'Recent/Standard' END"
    )


CTES["dim_customers"] = f"""
SELECT customer_id, first_name, last_name, email, loyalty_tier, city, total_orders, total_spend, avg_order_value,
  last_purchase_date, days_since_last_purchase, {_segment((2_500_000, 2_000_000, 1_500_000, 1_000_000))} AS rfm_segment
FROM customer_recency"""
CTES["dim_products"] = "SELECT * EXCLUDE (feed_seq) FROM silver_products"
CTES["dim_stores"] = "SELECT * FROM silver_stores"
CTES["dim_date"] = """
SELECT d AS "date", year(d) AS "year", quarter(d) AS "quarter", month(d) AS "month", day(d) AS "day",
  strftime(d, '%Y-%m') AS year_month
FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(transaction_date)),
  date_trunc('year', max(transaction_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
  FROM silver_sales)"""
CTES["costed_sales"] = f"""
SELECT s.*, p.unit_cost, CAST(quantity * p.unit_cost AS {DOLLARS}) AS cogs,
  CAST(gross_amount - CAST(quantity * p.unit_cost AS {DOLLARS}) AS {DOLLARS}) AS net_profit
FROM silver_sales s LEFT JOIN silver_products p ON s.product_id = p.product_id"""
CTES["fact_sales"] = f"""
SELECT *, CASE WHEN gross_amount > 0 THEN {percent('net_profit', 'gross_amount')} ELSE 0.0 END AS profit_margin_pct
FROM costed_sales"""
CTES["fact_inventory_snapshot"] = f"""
SELECT i.* EXCLUDE (last_restock_date), p.unit_cost, CAST(stock_on_hand * p.unit_cost AS {DOLLARS}) AS inventory_valuation
FROM silver_inventory i LEFT JOIN silver_products p ON i.product_id = p.product_id"""
CTES["gold_category_performance"] = f"""
SELECT category, CAST(sum(gross_amount) AS {DOLLARS}) AS total_revenue, CAST(sum(net_profit) AS {DOLLARS}) AS total_profit,
  sum(quantity) AS total_units_sold, count(transaction_id) AS transaction_count
FROM fact_sales f LEFT JOIN silver_products p ON f.product_id = p.product_id
WHERE category IS NOT NULL GROUP BY category"""

# --- quality and features ---------------------------------------------------------------------
RULES = {
    S.MISSING_CUSTOMER: "CustomerID IS NULL",
    S.MISSING_DESCRIPTION: "Description IS NULL OR trim(Description) = ''",
    S.NEGATIVE_QUANTITY: "TRY_CAST(Quantity AS DOUBLE) IS NULL OR "
    "(TRY_CAST(Quantity AS DOUBLE) < 0 AND InvoiceNo NOT LIKE 'C%')",
    S.BAD_PRICE: "TRY_CAST(UnitPrice AS DOUBLE) IS NULL OR TRY_CAST(UnitPrice AS DOUBLE) <= 0 "
    "OR TRY_CAST(UnitPrice AS DOUBLE) > 50000",
    S.BAD_DATE: "InvoiceDate IS NOT NULL AND TRY_CAST(InvoiceDate AS TIMESTAMP) IS NULL",
    S.BAD_COUNTRY: "Country IN ('uk', 'U.K.', 'UNITED KINGDOM', 'united kingdom', 'UNKNOWN_COUNTRY') "
    "OR trim(Country) <> Country",
}
DUPLICATE = "row_number() OVER (PARTITION BY InvoiceNo, StockCode, InvoiceDate ORDER BY row_seq) > 1"
_REASONS = "[" + ", ".join(f"CASE WHEN {test} THEN '{label}' END" for label, test in RULES.items()) + "]"
CTES["reasoned"] = f"""
SELECT *, [x for x in {_REASONS} if x IS NOT NULL] AS reasons, {DUPLICATE} AS is_duplicate FROM retail_lines"""
CTES["flagged"] = """
SELECT * EXCLUDE (every), len(every) > 0 AS dq_issue_flag,
  CASE WHEN len(every) > 0 THEN array_to_string(every, ', ') END AS dq_issue_reason
FROM (SELECT *, CASE WHEN is_duplicate THEN list_append(reasons, 'Duplicate Row') ELSE reasons END AS every
  FROM reasoned)"""
CTES["amounts"] = """
SELECT *, Q * P AS TotalAmount FROM (
  SELECT *, coalesce(TRY_CAST(Quantity AS DOUBLE), 1.0) AS Q, coalesce(TRY_CAST(UnitPrice AS DOUBLE), 0.0) AS P
  FROM flagged)"""
CTES["features"] = """
SELECT a.row_seq, TotalAmount, Q AS Quantity, P AS UnitPrice, CAST(n AS DOUBLE) AS CustomerPurchaseFrequency,
  CAST(spend AS DOUBLE) AS CustomerTotalSpend, CAST(spend AS DOUBLE) / CAST(n AS DOUBLE) AS AverageTransactionValue,
  CAST(lines AS DOUBLE) AS CountryTransactionCount
FROM amounts a
JOIN (SELECT coalesce(CustomerID, 'GUEST') AS who, count(TotalAmount) AS n,
    sum(CAST(TotalAmount AS DECIMAL(30,6))) AS spend FROM amounts GROUP BY 1) c ON coalesce(a.CustomerID, 'GUEST') = who
JOIN (SELECT upper(trim(coalesce(Country, 'UNKNOWN'))) AS place, count(InvoiceNo) AS lines FROM amounts GROUP BY 1) k
  ON upper(trim(coalesce(a.Country, 'UNKNOWN'))) = place"""
CTES["gappy"] = """
SELECT * REPLACE (CASE WHEN row_seq % 11 <> 3 THEN TotalAmount END AS TotalAmount,
  CASE WHEN row_seq % 11 <> 3 THEN UnitPrice END AS UnitPrice) FROM features"""

# --- anomaly report over an arithmetic score --------------------------------------------------
CTES["stand_in"] = """
SELECT *, -CAST((row_seq * 7919 + CAST(StockCode AS BIGINT) * 104729) % 1000003 AS DOUBLE) / 1000003.0 AS raw_score
FROM amounts"""


def _classified(scored: str, contamination: float) -> str:
    return f"""
SELECT *, {half_up('severity', 4)} AS ml_anomaly_score,
  CASE WHEN pred = -1 THEN 'Anomaly' ELSE 'Normal' END AS ml_anomaly_label,
  CASE WHEN dq_issue_flag THEN 'DATA QUALITY ISSUE' WHEN pred = -1 THEN 'ML-DETECTED ANOMALY' ELSE 'NORMAL' END
    AS system_status
FROM (SELECT s.*, CASE WHEN raw_score < cut THEN -1 ELSE 1 END AS pred,
    coalesce((high - raw_score) / nullif(high - low, 0.0), 0.0) AS severity
  FROM {scored} s CROSS JOIN (SELECT quantile_cont(raw_score, {contamination}) AS cut, min(raw_score) AS low,
    max(raw_score) AS high FROM {scored}))"""


CTES["classified"] = _classified("stand_in", 0.05)
SUSPICIOUS = f"""
SELECT row_seq AS transaction_index, coalesce(InvoiceNo, 'nan') AS invoice_no, coalesce(StockCode, 'nan') AS stock_code,
  coalesce(Description, 'nan') AS description, Q AS quantity, P AS unit_price, {half_up('TotalAmount')} AS total_amount,
  coalesce(CustomerID, 'GUEST') AS customer_id, coalesce(Country, 'nan') AS country, system_status,
  ml_anomaly_label AS anomaly_label, ml_anomaly_score AS anomaly_score, dq_issue_reason AS dq_reason
FROM """
CTES["suspicious"] = SUSPICIOUS + "classified"

# --- the forest, unrolled level by level ------------------------------------------------------
PSI, HEIGHT = S.MAX_SAMPLES, 8
_F = [f"f{i}" for i in range(len(S.FEATURES))]
_FS = ", ".join(_F)


def _unit(text: str, digits: int = 12, start: int = 1) -> str:
    return f"CAST(CAST('0x' || substr(md5({text}), {start}, {digits}) AS BIGINT) AS DOUBLE) / {16**digits}.0"


def _nth(values: list[str], index: str) -> str:
    return f"list_extract([{', '.join(values)}], {index})"


def _forest_ctes(prefix: str, trees: int, seed: int) -> None:
    """Sample, grow and walk ``trees`` trees; result tables ``<prefix>nodes`` and ``<prefix>paths``."""
    named = ", ".join(f"{c} AS f{i}" for i, c in enumerate(S.FEATURES))
    CTES[f"{prefix}points"] = f"SELECT row_seq, {named} FROM features"
    CTES[f"{prefix}grown0"] = f"""
SELECT tree, CAST(0 AS BIGINT) AS node, row_seq, {_FS} FROM (
  SELECT t.tree, p.*, row_number() OVER (PARTITION BY t.tree
    ORDER BY {_unit(f"'{seed}|' || t.tree || '|' || p.row_seq")}, p.row_seq) AS rank
  FROM (SELECT *, CAST(floor({_unit(f"'{seed}|' || row_seq")} * slices) AS BIGINT) AS slice
      FROM {prefix}points CROSS JOIN (SELECT greatest(1, count(*) // {3 * PSI}) AS slices FROM lineitem)) p
  JOIN (SELECT unnest(range({trees})) AS tree) t ON t.tree >= p.slice AND (t.tree - p.slice) % p.slices = 0)
WHERE rank <= {PSI}"""
    lows, highs = [f"lo{i}" for i in range(len(_F))], [f"hi{i}" for i in range(len(_F))]
    ends = ", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in range(len(_F)))
    for level in range(HEIGHT + 1):
        grown = f"{prefix}grown{level}"
        if level:
            CTES[grown] = f"""
SELECT g.tree, 2 * g.node + 1 + CASE WHEN {_nth([f'g.{f}' for f in _F], 's.feature + 1')} > s.split THEN 1 ELSE 0 END
  AS node, g.row_seq, {', '.join(f'g.{f}' for f in _F)}
FROM {prefix}grown{level - 1} g JOIN {prefix}split{level - 1} s ON g.tree = s.tree AND g.node = s.node
WHERE s.feature >= 0"""
        CTES[f"{prefix}split{level}"] = f"""
SELECT tree, node, feature, CASE WHEN feature < 0 THEN NULL WHEN lo + cut * (hi - lo) < hi THEN lo + cut * (hi - lo)
    ELSE lo END AS split, size AS sample_size, {level} AS depth
FROM (SELECT *, {_nth(lows, 'feature + 1')} AS lo, {_nth(highs, 'feature + 1')} AS hi FROM (
  SELECT *, CASE WHEN {level} = {HEIGHT} OR size <= 1 OR len(open) = 0 THEN -1
      ELSE open[CAST(floor(pick * len(open)) AS BIGINT) + 1] END AS feature
  FROM (SELECT *, [i for i in range({len(_F)}) if [{', '.join(highs)}][i + 1] > [{', '.join(lows)}][i + 1]] AS open,
      {_unit(f"'{seed}|' || tree || '|' || node || '|node'", 8)} AS pick,
      {_unit(f"'{seed}|' || tree || '|' || node || '|node'", 8, 9)} AS cut
    FROM (SELECT tree, node, count(*) AS size, {ends} FROM {grown} GROUP BY tree, node))))"""
    union = " UNION ALL ".join(f"SELECT * FROM {prefix}split{level}" for level in range(HEIGHT + 1))
    average = ("(CASE WHEN sample_size <= 1 THEN 0.0 WHEN sample_size = 2 THEN 1.0 ELSE 2.0 * (ln(sample_size - 1.0) "
               "+ 0.5772156649015329) - 2.0 * (sample_size - 1.0) / sample_size END)")
    CTES[f"{prefix}nodes"] = f"""
SELECT *, CASE WHEN feature < 0 THEN CAST(floor((depth + {average}) * 1000000000.0 + 0.5) AS BIGINT) END AS path_nano
FROM ({union})"""
    walked = f"(SELECT row_seq, {_FS}, tree, CAST(0 AS BIGINT) AS node FROM {prefix}points, (SELECT unnest(range({trees})) AS tree))"
    for _ in range(HEIGHT):
        step = f"2 * w.node + 1 + CASE WHEN {_nth([f'w.{f}' for f in _F], 'n.feature + 1')} > n.split THEN 1 ELSE 0 END"
        walked = (
            f"(SELECT w.row_seq, {', '.join(f'w.{f}' for f in _F)}, w.tree, CASE WHEN n.feature < 0 THEN w.node ELSE "
            f"{step} END AS node FROM {walked} w JOIN {prefix}nodes n ON w.tree = n.tree AND w.node = n.node)"
        )
    unit = "(2.0 * (ln(255.0) + 0.5772156649015329) - 2.0 * 255.0 / 256)"
    CTES[f"{prefix}paths"] = f"""
SELECT row_seq, path_sum, -pow(2.0, -(CAST(path_sum AS DOUBLE) / ({trees}.0 * 1000000000.0)) / {unit}) AS raw_score
FROM (SELECT w.row_seq, CAST(sum(n.path_nano) AS BIGINT) AS path_sum
  FROM {walked} w JOIN {prefix}nodes n ON w.tree = n.tree AND w.node = n.node GROUP BY w.row_seq)"""
    CTES[f"{prefix}scored"] = f"SELECT a.*, raw_score FROM amounts a JOIN {prefix}paths USING (row_seq)"


_forest_ctes("a_", 100, 42)
_forest_ctes("b_", 50, 7)
CTES["a_classified"] = _classified("a_scored", 0.05)
CTES["b_classified"] = _classified("b_scored", 0.1)
CTES["b_suspicious"] = SUSPICIOUS + "b_classified"


# --- assembly ---------------------------------------------------------------------------------
def statement(body: str) -> str:
    """Prefix the body with the table expressions it needs, directly or through others."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b{name}\b", sql):
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in ordered)
    return f"WITH {parts}\n{body}"


BODIES: dict[str, str] = {}

# sources and sinks
_SALES_TEXT = f"""SELECT transaction_id, {moment('"timestamp"')} AS "timestamp", CAST(customer_id AS VARCHAR) AS customer_id,
  CAST(product_id AS VARCHAR) AS product_id, CAST(store_id AS VARCHAR) AS store_id, {whole('quantity')} AS quantity,
  CAST(unit_price AS DOUBLE) AS unit_price, payment_method, channel FROM bronze_sales_raw"""
BODIES["sales_csv_source"] = _SALES_TEXT
BODIES["customers_json_source"] = f"""SELECT * EXCLUDE (feed_seq) REPLACE (CAST(customer_id AS VARCHAR) AS customer_id,
  {whole('web_sessions_count')} AS web_sessions_count) FROM bronze_customers_raw"""
BODIES["products_workbook_source"] = """SELECT * EXCLUDE (feed_seq) REPLACE (CAST(product_id AS VARCHAR) AS product_id,
  CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(suggested_retail_price AS DOUBLE) AS suggested_retail_price)
  FROM bronze_products_raw"""
BODIES["retail_lines_source"] = "SELECT * EXCLUDE (row_seq) FROM retail_lines"
BODIES["file_order_sequence"] = f"""SELECT {moment('"timestamp"')} AS "timestamp", count(*) AS n, true AS in_order
  FROM bronze_sales_raw GROUP BY "timestamp\""""
_SILVER_SALES = f"""transaction_id, {moment('"timestamp"')} AS "timestamp", customer_id, product_id, store_id,
  {whole('quantity')} AS quantity, CAST(unit_price AS DOUBLE) AS unit_price, payment_method, channel,
  {day('transaction_date')} AS transaction_date, {whole('transaction_hour')} AS transaction_hour,
  CAST(gross_amount AS DOUBLE) AS gross_amount"""
BODIES["layer_write_and_read"] = (
    f"SELECT {_SILVER_SALES}, strftime(transaction_date, '%Y-%m') AS sales_month FROM silver_sales"
)
BODIES["csv_export"] = """SELECT product_id, ' the "' || product_name || '", new ' AS product_name, category,
  CAST(feed_seq AS BIGINT) AS feed_seq FROM bronze_products_raw"""
BODIES["dataset_catalog"] = """SELECT 'online_retail.csv' AS filename, count(*) AS records, true AS has_size,
  false AS is_dirty_sample FROM bronze_sales_raw
  UNION ALL SELECT 'sample_dirty_data.csv', 0, false, true"""
_GOLD_COUNTS = ("dim_customers", "dim_products", "dim_stores", "dim_date", "fact_sales", "fact_inventory_snapshot",
                "gold_category_performance")
BODIES["table_listing"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, 'ONLINE' AS status FROM {t}" for t in _GOLD_COUNTS
) + """ UNION ALL SELECT 'gold_daily_sales_summary', count(DISTINCT transaction_date), 'ONLINE' FROM fact_sales"""

# bronze
BODIES["audit_columns"] = f"""SELECT * REPLACE ({whole('square_feet')} AS square_feet,
  {whole('opened_year')} AS opened_year), '2024-06-30 12:00:00' AS ingested_at, '{BATCH}' AS batch_id,
  'book.xlsx::Stores_Master' AS source_file FROM bronze_stores_raw"""
_HASHED = " || '|' || ".join(
    f"coalesce({c}, 'nan')"
    for c in ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country")
)
BODIES["row_hash"] = f"SELECT row_seq, substr(sha256({_HASHED}), 1, 16) AS row_hash FROM retail_lines"
BODIES["bronze_summary"] = " UNION ALL ".join(
    f"SELECT '{BATCH}' AS batch_id, '{t}' AS table_name, count(*) AS row_count, 'COMPLETED' AS status FROM {t}"
    for t in ("bronze_sales_raw", "bronze_customers_raw", "bronze_inventory_raw", "bronze_products_raw",
              "bronze_stores_raw")
)

# silver
BODIES["dedup_sales"] = f"""SELECT * REPLACE ({moment('"timestamp"')} AS "timestamp", {whole('quantity')} AS quantity,
  CAST(unit_price AS DOUBLE) AS unit_price) FROM first_sales"""
BODIES["dedup_customers"] = f"""SELECT * REPLACE ({whole('web_sessions_count')} AS web_sessions_count,
  {whole('feed_seq')} AS feed_seq) FROM first_customers"""
_PRODUCT_NUMBERS = "CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(suggested_retail_price AS DOUBLE) AS suggested_retail_price"
BODIES["dedup_products"] = f"""SELECT * REPLACE ({_PRODUCT_NUMBERS}, {whole('feed_seq')} AS feed_seq) FROM first_products"""
_STOCK_NUMBERS = ", ".join(f"{whole(c)} AS {c}" for c in ("stock_on_hand", "reorder_point", "safety_stock"))
BODIES["dedup_inventory"] = f"SELECT * REPLACE ({_STOCK_NUMBERS}) FROM first_inventory"
BODIES["quantity_filter"] = f"""SELECT channel, count(*) AS row_count, {whole('sum(quantity)')} AS quantity
  FROM bronze_sales_raw WHERE quantity > 0 GROUP BY channel"""
BODIES["payment_imputation"] = """SELECT coalesce(payment_method, 'Unknown') AS payment_method, count(*) AS row_count
  FROM bronze_sales_raw GROUP BY 1"""
BODIES["email_imputation"] = f"SELECT customer_id, {whole('feed_seq')} AS feed_seq, {EMAIL} AS email FROM bronze_customers_raw"
BODIES["price_bounds"] = """SELECT count(*) FILTER (unit_price < 1000) AS below, count(*) FILTER (unit_price > 1900) AS above
  FROM bronze_sales_raw"""


def _rule_checks() -> str:
    parts = []
    extra = {
        "sales": {"min_unit_price": "unit_price < 0.01", "max_unit_price": "unit_price > 10000",
                  "min_quantity": "quantity < 1"},
        "inventory": {"min_stock": "stock_on_hand < 0"},
        "customers": {"valid_tiers": "loyalty_tier NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum', 'VIP')"},
    }
    for dataset, columns in S.REQUIRED_COLUMNS.items():
        tests = {f"required column {c}": f'"{c}" IS NULL' for c in columns} | extra[dataset]
        parts += [
            f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, count(*) FILTER ({test}) AS affected_records "
            f"FROM bronze_{dataset}_raw"
            for rule, test in tests.items()
        ]
    return " UNION ALL ".join(parts)


BODIES["rule_checks"] = _rule_checks()
CTES["sales_counts"] = """
SELECT (SELECT count(*) FROM bronze_sales_raw) AS initial_records,
  (SELECT count(*) FROM bronze_sales_raw) - count(*) AS duplicates_removed,
  count(*) FILTER (quantity <= 0) AS invalid_qty_removed, count(*) FILTER (quantity IS NULL) AS missing_qty_removed,
  count(*) FILTER (quantity > 0 AND payment_method IS NULL) AS imputed_fields,
  count(*) FILTER (quantity > 0 AND unit_price < 0.01) AS invalid_price,
  count(*) FILTER (quantity > 0) AS final_records FROM first_sales"""
CTES["customer_counts"] = """
SELECT (SELECT count(*) FROM bronze_customers_raw) AS initial_records,
  (SELECT count(*) FROM bronze_customers_raw) - count(*) AS duplicates_removed,
  count(*) FILTER (email IS NULL) AS emails_imputed, count(*) AS final_records FROM first_customers"""
_PASS = percent("final_records", "initial_records") + " AS pass_rate"
BODIES["sales_metrics"] = f"SELECT *, {_PASS} FROM sales_counts"
BODIES["customer_metrics"] = f"SELECT *, {_PASS} FROM customer_counts"


def _log(batch: str, at: str) -> str:
    parts = []
    for first, dataset, table, rules in ((0, "sales", "sales_counts", SALES_RULES),
                                         (len(SALES_RULES), "customers", "customer_counts", CUSTOMER_RULES)):
        for i, (column, rule, severity, details) in enumerate(rules):
            text = details.replace("'", "''")
            parts.append(
                f"SELECT '{batch}' AS batch_id, CAST({first + i} AS BIGINT) AS seq, '{at}' AS \"timestamp\", "
                f"'Silver' AS layer, '{dataset}' AS dataset, '{rule}' AS rule, '{severity}' AS severity, "
                f"{column} AS affected_records, '{text}' AS details FROM {table}"
            )
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE affected_records > 0"


BODIES["validation_log"] = _log(BATCH, "2024-06-30 12:00:00")
BODIES["latest_validation_logs"] = f"""SELECT * FROM ({_log(BATCH, '2024-06-30 12:00:00')}
  UNION ALL {_log('BATCH-20240701120000', '2024-07-01 12:00:00')})
  ORDER BY "timestamp" DESC, batch_id DESC, seq DESC LIMIT 6"""
BODIES["silver_sales"] = f"SELECT {_SILVER_SALES} FROM silver_sales"
BODIES["silver_customers"] = f"""SELECT * REPLACE ({whole('web_sessions_count')} AS web_sessions_count,
  {whole('feed_seq')} AS feed_seq, {day('signup_date')} AS signup_date) FROM silver_customers"""
BODIES["silver_products"] = f"SELECT * REPLACE ({_PRODUCT_NUMBERS}, {whole('feed_seq')} AS feed_seq) FROM silver_products"
_STORE_NUMBERS = f"{whole('square_feet')} AS square_feet, {whole('opened_year')} AS opened_year"
BODIES["silver_stores"] = f"SELECT * REPLACE ({_STORE_NUMBERS}) FROM silver_stores"
BODIES["silver_inventory"] = f"SELECT * REPLACE ({_STOCK_NUMBERS}) FROM silver_inventory"
BODIES["silver_summary"] = " UNION ALL ".join(
    [f"SELECT '{t}_count' AS name, CAST(count(*) AS DOUBLE) AS value FROM {t}"
     for t in ("silver_sales", "silver_customers", "silver_products", "silver_stores", "silver_inventory")]
    + [f"SELECT 'sales.{c}', CAST({c} AS DOUBLE) FROM sales_counts"
       for c in ("initial_records", "duplicates_removed", "invalid_qty_removed", "missing_qty_removed",
                 "imputed_fields", "invalid_price", "final_records")]
    + [f"SELECT 'customers.{c}', CAST({c} AS DOUBLE) FROM customer_counts"
       for c in ("initial_records", "duplicates_removed", "emails_imputed", "final_records")]
    + [f"SELECT '{d}.pass_rate', {percent('final_records', 'initial_records')} FROM {t}"
       for d, t in (("sales", "sales_counts"), ("customers", "customer_counts"))]
)

# gold
BODIES["customer_aggregate"] = f"""SELECT customer_id, total_orders, CAST(total_spend AS DOUBLE) AS total_spend,
  avg_order_value, {day('last_purchase_date')} AS last_purchase_date FROM customer_agg"""
BODIES["customer_profile"] = f"""SELECT customer_id, total_orders, CAST(total_spend AS DOUBLE) AS total_spend,
  avg_order_value, {day('last_purchase_date')} AS last_purchase_date FROM customer_recency"""
BODIES["customer_recency"] = f"""SELECT customer_id, {day('last_purchase_date')} AS last_purchase_date,
  {whole('days_since_last_purchase')} AS days_since_last_purchase FROM customer_recency"""
BODIES["rfm_segments_default"] = f"""SELECT {_segment((1000, 500, 200, 100))} AS rfm_segment, count(*) AS customers
  FROM customer_recency GROUP BY 1"""
BODIES["dim_customers"] = f"""SELECT * REPLACE (CAST(total_spend AS DOUBLE) AS total_spend,
  {day('last_purchase_date')} AS last_purchase_date,
  {whole('days_since_last_purchase')} AS days_since_last_purchase) FROM dim_customers"""
BODIES["dim_products"] = f"SELECT * REPLACE ({_PRODUCT_NUMBERS}) FROM dim_products"
BODIES["dim_stores"] = f"SELECT * REPLACE ({_STORE_NUMBERS}) FROM dim_stores"
BODIES["dim_date"] = f"""SELECT {day('"date"')} AS "date", {whole('"year"')} AS "year", {whole('"quarter"')} AS "quarter",
  {whole('"month"')} AS "month", {whole('"day"')} AS "day", year_month FROM dim_date"""
BODIES["fact_sales"] = f"""SELECT {_SILVER_SALES}, CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(cogs AS DOUBLE) AS cogs,
  CAST(net_profit AS DOUBLE) AS net_profit, profit_margin_pct FROM fact_sales"""
BODIES["fact_inventory_snapshot"] = f"""SELECT * REPLACE ({_STOCK_NUMBERS}, CAST(unit_cost AS DOUBLE) AS unit_cost,
  CAST(inventory_valuation AS DOUBLE) AS inventory_valuation) FROM fact_inventory_snapshot"""
BODIES["gold_daily_sales_summary"] = f"""SELECT {day('transaction_date')} AS transaction_date,
  {dollars('sum(gross_amount)')} AS total_revenue, {dollars('coalesce(sum(net_profit), 0)')} AS total_net_profit,
  count(DISTINCT transaction_id) AS total_transactions, {whole('sum(quantity)')} AS total_items_sold,
  {mean('gross_amount')} AS avg_order_value FROM fact_sales GROUP BY transaction_date"""
BODIES["gold_category_performance"] = f"""SELECT category, CAST(total_revenue AS DOUBLE) AS total_revenue,
  CAST(total_profit AS DOUBLE) AS total_profit, {whole('total_units_sold')} AS total_units_sold, transaction_count,
  {percent('total_profit', 'total_revenue')} AS profit_margin_pct FROM gold_category_performance"""


def _relation(fact: str, dimension: str, key: str) -> str:
    orphan = f"{key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {dimension})"
    return f"""SELECT '{fact}' AS fact_table, '{dimension}' AS dimension,
  (SELECT count(DISTINCT {key}) FROM {fact} WHERE {orphan}) AS orphan_keys,
  (SELECT count(*) FROM {fact} WHERE {orphan}) AS orphan_rows,
  (SELECT count(*) FROM {fact} WHERE {key} IS NULL) AS null_rows,
  (SELECT count(*) FROM (SELECT {key} FROM {dimension} GROUP BY {key} HAVING count(*) > 1)) AS repeated_dimension_keys"""


BODIES["referential_integrity"] = " UNION ALL ".join(
    _relation(*r) for r in (("fact_sales", "dim_customers", "customer_id"), ("fact_sales", "dim_products", "product_id"),
                            ("fact_sales", "dim_stores", "store_id"),
                            ("fact_inventory_snapshot", "dim_products", "product_id"),
                            ("fact_inventory_snapshot", "dim_stores", "store_id"))
)
_GOLD_SUMMARY = f"""(SELECT {dollars('sum(gross_amount)')} FROM fact_sales) AS total_revenue,
  (SELECT {dollars('sum(net_profit)')} FROM fact_sales) AS total_profit,
  (SELECT count(DISTINCT transaction_id) FROM fact_sales) AS total_transactions,
  (SELECT count(*) FROM fact_inventory_snapshot WHERE reorder_status = 'REORDER_NEEDED') AS items_requiring_reorder,
  (SELECT count(*) FROM fact_sales) AS gold_fact_sales_rows,
  (SELECT count(*) FROM fact_inventory_snapshot) AS gold_fact_inventory_rows,
  (SELECT count(*) FROM dim_customers) AS gold_dim_customers_rows,
  (SELECT count(*) FROM dim_products) AS gold_dim_products_rows,
  (SELECT count(*) FROM dim_stores) AS gold_dim_stores_rows"""
_MEDALLION = ", ".join(
    f"(SELECT count(*) FROM {table}) AS {name}"
    for name, table in (
        ("bronze_sales", "bronze_sales_raw"), ("bronze_customers", "bronze_customers_raw"),
        ("bronze_inventory", "bronze_inventory_raw"), ("silver_sales", "silver_sales"),
        ("silver_customers", "silver_customers"), ("silver_products", "silver_products"),
        ("silver_inventory", "silver_inventory"), ("gold_fact_sales", "fact_sales"),
        ("gold_dim_customers", "dim_customers"), ("gold_dim_products", "dim_products"),
        ("gold_dim_stores", "dim_stores"), ("gold_fact_inventory", "fact_inventory_snapshot"),
    )
)
BODIES["gold_summary"] = f"SELECT {_GOLD_SUMMARY}"
BODIES["medallion_summary"] = f"SELECT {_MEDALLION}"
BODIES["medallion_run"] = f"SELECT {_GOLD_SUMMARY}, {_MEDALLION}"

# KPIs
_MONTHLY = f"""strftime(transaction_date, '%Y-%m') AS sales_month, count(DISTINCT transaction_id) AS total_orders,
  {whole('sum(quantity)')} AS total_units_sold, {dollars('sum(gross_amount)')} AS gross_revenue,
  {dollars('sum(net_profit)')} AS net_profit, {percent('sum(net_profit)', 'sum(gross_amount)')} AS overall_margin_pct"""
BODIES["monthly_performance"] = f"SELECT {_MONTHLY}, {mean('gross_amount')} AS avg_order_value FROM fact_sales GROUP BY 1"
BODIES["preset_mom"] = f"SELECT {_MONTHLY} FROM fact_sales GROUP BY 1"
_DAYS = "days_since_last_purchase"
BODIES["rfm_summary"] = BODIES["preset_rfm"] = f"""SELECT rfm_segment, count(customer_id) AS customer_count,
  {mean('total_spend')} AS avg_lifetime_spend, {dollars('sum(total_spend)')} AS segment_total_spend,
  {half_up(ratio(f'sum({_DAYS})', f'count({_DAYS})'), 1)} AS avg_recency_days FROM dim_customers GROUP BY rfm_segment"""
_REORDER = """FROM (SELECT p.category, p.product_name, s.store_name, s.region, CAST(i.stock_on_hand AS BIGINT) AS stock_on_hand,
    CAST(i.reorder_point AS BIGINT) AS reorder_point, CAST(i.safety_stock AS BIGINT) AS safety_stock,
    CAST(i.reorder_point - i.stock_on_hand AS BIGINT) AS deficit_quantity,
    CAST(i.inventory_valuation AS DOUBLE) AS inventory_valuation
  FROM fact_inventory_snapshot i JOIN dim_products p ON i.product_id = p.product_id
  JOIN dim_stores s ON i.store_id = s.store_id WHERE i.reorder_status = 'REORDER_NEEDED')"""
BODIES["reorder_matrix"] = f"SELECT * {_REORDER}"
BODIES["preset_reorder"] = f"SELECT * EXCLUDE (safety_stock) {_REORDER}"
BODIES["top_margin_products"] = BODIES["preset_margin"] = f"""SELECT p.product_id, p.product_name, p.category,
  {whole('sum(f.quantity)')} AS total_units_sold, {dollars('sum(f.gross_amount)')} AS total_revenue,
  {dollars('sum(f.net_profit)')} AS total_profit, p.profit_margin_pct AS catalog_margin_pct
  FROM fact_sales f JOIN dim_products p ON f.product_id = p.product_id
  GROUP BY p.product_id, p.product_name, p.category, p.profit_margin_pct
  ORDER BY sum(f.net_profit) DESC NULLS LAST, p.product_id LIMIT 10"""
_REGIONAL = f"""st.region, st.store_name, st.city, count(DISTINCT f.transaction_id) AS transaction_count,
  {dollars('sum(f.gross_amount)')} AS store_revenue, {dollars('sum(f.net_profit)')} AS store_profit"""
_REGIONAL_FROM = "FROM fact_sales f JOIN dim_stores st ON f.store_id = st.store_id GROUP BY 1, 2, 3"
BODIES["store_profitability"] = BODIES["store_profitability_exact_distinct"] = (
    f"SELECT {_REGIONAL}, {percent('sum(f.net_profit)', 'sum(f.gross_amount)')} AS store_margin_pct {_REGIONAL_FROM}"
)
BODIES["preset_regional"] = f"SELECT {_REGIONAL} {_REGIONAL_FROM}"
BODIES["financial_kpis"] = f"""SELECT {dollars('coalesce(sum(gross_amount), 0)')} AS total_revenue,
  {dollars('coalesce(sum(net_profit), 0)')} AS total_profit,
  coalesce({ratio('sum(gross_amount)', 'count(gross_amount)')}, 0.0) AS avg_order_value,
  count(DISTINCT transaction_id) AS total_transactions, {whole('coalesce(sum(quantity), 0)')} AS total_units_sold
  FROM fact_sales"""
BODIES["inventory_kpis"] = f"""SELECT count(*) AS total_skus, {whole('coalesce(sum(stock_on_hand), 0)')} AS total_stock,
  {dollars('coalesce(sum(inventory_valuation), 0)')} AS total_inventory_value,
  count(CASE WHEN reorder_status = 'REORDER_NEEDED' THEN 1 END) AS reorder_alerts FROM fact_inventory_snapshot"""
BODIES["rfm_distribution"] = f"""SELECT rfm_segment, count(*) AS "count",
  {dollars('coalesce(sum(total_spend), 0)')} AS spend FROM dim_customers GROUP BY rfm_segment"""
BODIES["monthly_trend"] = f"""SELECT strftime(transaction_date, '%Y-%m') AS "month", {dollars('sum(gross_amount)')} AS revenue,
  {dollars('sum(net_profit)')} AS profit, count(DISTINCT transaction_id) AS orders FROM fact_sales GROUP BY 1"""
BODIES["category_kpis"] = f"""SELECT category, {dollars('sum(total_revenue)')} AS revenue,
  {dollars('sum(total_profit)')} AS profit, {whole('sum(total_units_sold)')} AS units
  FROM gold_category_performance GROUP BY category"""

# measures
_SALES_MEASURES = f"""{dollars('sum(gross_amount)')} AS total_sales, {dollars('sum(cogs)')} AS total_cogs,
  {dollars('sum(net_profit)')} AS total_net_profit,
  {half_up(f"coalesce({ratio('sum(net_profit)', 'sum(gross_amount)')}, 0.0) * 100.0")} AS profit_margin_pct,
  {whole('sum(quantity)')} AS total_units_sold, count(DISTINCT transaction_id) AS total_transactions,
  {half_up(f"coalesce({ratio('sum(gross_amount)', 'count(DISTINCT transaction_id)')}, 0.0)")} AS average_order_value,
  count(DISTINCT customer_id) AS active_customer_count"""
_STOCK_MEASURES = f"""{whole('sum(stock_on_hand)')} AS total_stock_on_hand,
  {dollars('sum(inventory_valuation)')} AS total_inventory_valuation,
  count(*) FILTER (reorder_status = 'REORDER_NEEDED') AS reorder_alert_count"""
_CUSTOMER_MEASURES = f"""{half_up(f"coalesce({ratio('sum(total_spend)', 'count(total_spend)')}, 0.0)")}
  AS avg_customer_lifetime_value, count(*) FILTER (rfm_segment = 'Champions') AS champions_count,
  count(*) FILTER (rfm_segment = 'At Risk') AS at_risk_customers"""
BODIES["sales_measures"] = f"SELECT {_SALES_MEASURES} FROM fact_sales"
BODIES["sales_measures_by_category"] = f"""SELECT category, {_SALES_MEASURES} FROM fact_sales
  LEFT JOIN (SELECT product_id, category FROM dim_products) USING (product_id) GROUP BY category"""
BODIES["sales_measures_by_region_channel"] = f"""SELECT region, channel, {_SALES_MEASURES} FROM fact_sales
  LEFT JOIN (SELECT store_id, region FROM dim_stores) USING (store_id) GROUP BY region, channel"""
BODIES["inventory_measures"] = f"SELECT {_STOCK_MEASURES} FROM fact_inventory_snapshot"
BODIES["inventory_measures_by_region"] = f"""SELECT region, {_STOCK_MEASURES} FROM fact_inventory_snapshot
  LEFT JOIN (SELECT store_id, region FROM dim_stores) USING (store_id) GROUP BY region"""
BODIES["customer_measures"] = f"SELECT {_CUSTOMER_MEASURES} FROM dim_customers"
BODIES["customer_measures_by_tier"] = f"SELECT loyalty_tier, {_CUSTOMER_MEASURES} FROM dim_customers GROUP BY loyalty_tier"
BODIES["stock_turnover_ratio"] = f"""SELECT {half_up(f"coalesce({ratio('(SELECT sum(cogs) FROM fact_sales)',
  '(SELECT sum(inventory_valuation) FROM fact_inventory_snapshot)')}, 0.0)", 4)} AS stock_turnover_ratio"""
BODIES["stock_turnover_ratio_by_category"] = f"""SELECT category,
  {half_up(f"coalesce({ratio('cost', 'worth')}, 0.0)", 4)} AS stock_turnover_ratio
  FROM (SELECT category, sum(cogs) AS cost FROM fact_sales LEFT JOIN (SELECT product_id, category FROM dim_products)
    USING (product_id) GROUP BY category)
  FULL JOIN (SELECT category, sum(inventory_valuation) AS worth FROM fact_inventory_snapshot
    LEFT JOIN (SELECT product_id, category FROM dim_products) USING (product_id) GROUP BY category)
  USING (category)"""
CTES["month_totals"] = f"""
SELECT "date" AS month_start, CAST(coalesce(sum(gross_amount), 0) AS {DOLLARS}) AS total_sales
FROM dim_date LEFT JOIN silver_sales ON date_trunc('month', transaction_date) = "date"
WHERE "day" = 1 AND "date" BETWEEN (SELECT date_trunc('month', min(transaction_date)) FROM silver_sales)
  AND (SELECT max(transaction_date) FROM silver_sales) GROUP BY "date\""""
BODIES["sales_ytd"] = f"""SELECT {day('month_start')} AS month_start, CAST(total_sales AS DOUBLE) AS total_sales,
  {dollars('sum(total_sales) OVER (PARTITION BY year(month_start) ORDER BY month_start)')} AS sales_ytd FROM month_totals"""
_PREVIOUS = "lag(total_sales) OVER (ORDER BY month_start)"
BODIES["sales_previous_month"] = f"""SELECT {day('month_start')} AS month_start, CAST(total_sales AS DOUBLE) AS total_sales,
  CAST({_PREVIOUS} AS DOUBLE) AS sales_previous_month FROM month_totals"""
BODIES["mom_sales_growth"] = f"""SELECT {day('month_start')} AS month_start, CAST(total_sales AS DOUBLE) AS total_sales,
  CAST(previous AS DOUBLE) AS sales_previous_month,
  {half_up(f"coalesce({ratio('total_sales - previous', 'previous')}, 0.0) * 100.0")} AS mom_growth_pct
  FROM (SELECT *, {_PREVIOUS} AS previous FROM month_totals)"""
BODIES["revenue_by_channel"] = f"SELECT channel, {dollars('sum(gross_amount)')} AS total_sales FROM fact_sales GROUP BY channel"
BODIES["top_category_products"] = f"""SELECT category, product_name, {dollars('sum(gross_amount)')} AS total_sales
  FROM fact_sales f JOIN dim_products p ON f.product_id = p.product_id GROUP BY 1, 2
  ORDER BY sum(gross_amount) DESC, category, product_name LIMIT 10"""
BODIES["sales_by_location"] = f"""SELECT state, city, {dollars('sum(gross_amount)')} AS total_sales
  FROM fact_sales f JOIN dim_stores s ON f.store_id = s.store_id GROUP BY 1, 2"""
BODIES["valuation_by_category"] = f"""SELECT category, {dollars('sum(inventory_valuation)')} AS total_inventory_valuation
  FROM fact_inventory_snapshot i JOIN dim_products p ON i.product_id = p.product_id GROUP BY 1"""
BODIES["stock_scatter"] = f"""SELECT product_id, {whole('sum(stock_on_hand)')} AS stock_on_hand,
  {whole('sum(reorder_point)')} AS reorder_point FROM fact_inventory_snapshot GROUP BY product_id"""
BODIES["recency_spend_scatter"] = f"""SELECT customer_id, {whole(_DAYS)} AS {_DAYS},
  CAST(total_spend AS DOUBLE) AS total_spend FROM dim_customers"""
BODIES["customer_roster"] = "SELECT customer_id, email, loyalty_tier, total_orders, rfm_segment FROM dim_customers"

# ad-hoc SQL
BODIES["adhoc_sql"] = f"""SELECT channel, strftime(transaction_date, '%Y-%m') AS sales_month, count(*) AS n_lines,
  {dollars('sum(gross_amount)')} AS revenue FROM fact_sales WHERE quantity > 1
  GROUP BY channel, sales_month HAVING count(*) > 2"""
BODIES["strftime_shim"] = """SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS n FROM events
  WHERE event_type = 'purchase' GROUP BY 1"""
BODIES["purchases_by_hour"] = f"""SELECT {whole('hour(ts)')} AS transaction_hour, count(*) AS purchases,
  {dollars('sum(CAST(value AS DECIMAL(12,2)))')} AS amount FROM events WHERE event_type = 'purchase' GROUP BY 1"""

# quality rules
_RULE_NAMES = ("missing_customer", "missing_description", "negative_quantity", "unit_price_bounds", "invalid_date",
               "inconsistent_country")
for _short, _test in zip(_RULE_NAMES, RULES.values()):
    BODIES[f"rule_{_short}"] = f"SELECT row_seq FROM retail_lines WHERE {_test}"
BODIES["rule_duplicate_row"] = "SELECT row_seq FROM reasoned WHERE is_duplicate"
BODIES["quality_flags"] = "SELECT row_seq, dq_issue_flag, dq_issue_reason FROM flagged"
BODIES["quality_issue_list"] = """SELECT row_seq AS row_index, coalesce(InvoiceNo, 'nan') AS invoice_no,
  coalesce(StockCode, 'nan') AS stock_code, array_to_string(reasons, '|') AS reasons FROM reasoned WHERE len(reasons) > 0"""
BODIES["quality_rule_breakdown"] = """SELECT rule, count(*) AS row_count FROM (SELECT unnest(reasons) AS rule FROM reasoned)
  GROUP BY rule"""
BODIES["quality_rule_breakdown_all"] = """SELECT rule, count(*) AS row_count FROM (SELECT unnest(reasons) AS rule FROM reasoned
  UNION ALL SELECT 'Duplicate Row' FROM reasoned WHERE is_duplicate) GROUP BY rule"""

# features
BODIES["numeric_coercion"] = "SELECT row_seq, Q AS Quantity, P AS UnitPrice FROM amounts"
BODIES["total_amount"] = "SELECT row_seq, TotalAmount FROM amounts"
BODIES["customer_features"] = """SELECT row_seq, CustomerPurchaseFrequency, CustomerTotalSpend, AverageTransactionValue
  FROM features"""
BODIES["country_feature"] = "SELECT row_seq, CountryTransactionCount FROM features"
BODIES["line_features"] = "SELECT * FROM features"


def _six(expressions: dict[str, str]) -> str:
    return ", ".join(f"{half_up(x, 6)} AS {c}" for c, x in expressions.items())


_MEDIANS = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in S.FEATURES)
BODIES["median_imputation"] = f"""SELECT row_seq, {_six({c: f'coalesce({c}, m_{c}, 0.0)' for c in S.FEATURES})}
  FROM gappy CROSS JOIN (SELECT {_MEDIANS} FROM gappy)"""
_POINTS = ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}" for c in S.FEATURES)
_ROBUST = {f"{c}_scaled": f"({c} - q_{c}[2]) / coalesce(nullif(q_{c}[3] - q_{c}[1], 0.0), 1.0)" for c in S.FEATURES}
BODIES["robust_scaling"] = BODIES["robust_scaling_narrowed"] = f"""SELECT row_seq, {_six(_ROBUST)}
  FROM features CROSS JOIN (SELECT {_POINTS} FROM features)"""
_SPREADS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in S.FEATURES)
_STANDARD = {f"{c}_scaled": f"({c} - m_{c}) / coalesce(nullif(s_{c}, 0.0), 1.0)" for c in S.FEATURES}
BODIES["standard_scaling"] = f"""SELECT row_seq, {_six(_STANDARD)}
  FROM features CROSS JOIN (SELECT {_SPREADS} FROM features)"""

# anomaly report
BODIES["anomaly_classification"] = """SELECT row_seq, CAST(pred AS BIGINT) AS ml_anomaly_pred, ml_anomaly_label,
  ml_anomaly_score, system_status FROM classified"""


def _kpis(table: str) -> str:
    return f"""SELECT count(*) AS total_transactions, count(*) FILTER (pred = -1) AS ml_anomalies_count,
  count(*) FILTER (pred = 1) AS normal_transactions_count,
  {percent('count(*) FILTER (pred = -1)', 'count(*)')} AS anomaly_percentage,
  count(*) FILTER (dq_issue_flag) AS rule_based_dq_issues_count,
  {half_up('CAST(sum(CAST(severity AS DECIMAL(18,12))) AS DOUBLE) / count(*)', 4)} AS average_anomaly_score FROM {table}"""


BODIES["anomaly_kpi_summary"] = _kpis("classified")
BODIES["anomaly_score_histogram"] = """SELECT bin / 10.0 AS bin_start, (bin + 1) / 10.0 AS bin_end, count(severity) AS "count",
  (bin + 1) / 10.0 > 0.6 AS flagged
  FROM (SELECT unnest(range(10)) AS bin) LEFT JOIN classified ON least(CAST(floor(severity * 10) AS BIGINT), 9) = bin
  GROUP BY bin"""
BODIES["anomalies_by_country"] = """SELECT Country, count(InvoiceNo) AS anomaly_count FROM classified
  WHERE system_status = 'ML-DETECTED ANOMALY' AND Country IS NOT NULL GROUP BY Country
  ORDER BY anomaly_count DESC, Country LIMIT 10"""
BODIES["anomalies_by_product"] = """SELECT StockCode, Description, count(InvoiceNo) AS anomaly_count FROM classified
  WHERE system_status = 'ML-DETECTED ANOMALY' AND StockCode IS NOT NULL AND Description IS NOT NULL
  GROUP BY ALL ORDER BY anomaly_count DESC, StockCode, Description LIMIT 10"""
BODIES["top_suspicious"] = "SELECT * FROM suspicious ORDER BY anomaly_score DESC, transaction_index LIMIT 100"
BODIES["suspicious_filter"] = """SELECT transaction_index, invoice_no, country, system_status FROM suspicious
  WHERE system_status = 'ML-DETECTED ANOMALY' AND (contains(lower(invoice_no), 'nation_1')
  OR contains(lower(customer_id), 'nation_1') OR contains(lower(country), 'nation_1')
  OR contains(lower(description), 'nation_1') OR contains(lower(stock_code), 'nation_1'))"""
BODIES["transaction_lookup"] = "SELECT * FROM suspicious WHERE transaction_index = 4242"
BODIES["score_bands"] = """SELECT CASE WHEN anomaly_score > 0.65 THEN 'high' WHEN anomaly_score > 0.45 THEN 'medium'
  ELSE 'low' END AS score_band, count(*) AS lines FROM suspicious GROUP BY 1"""
BODIES["forest_nodes"] = """SELECT tree, node, CAST(feature AS BIGINT) AS feature, split, sample_size,
  CAST(depth AS BIGINT) AS depth, path_nano FROM a_nodes"""
BODIES["forest_scores"] = """SELECT row_seq, path_sum, CAST(floor(raw_score * 1000000.0 + 0.5) AS BIGINT) AS raw_score_micro
  FROM a_paths"""
BODIES["anomaly_report_kpis"] = _kpis("a_classified")
BODIES["anomaly_report_top_suspicious"] = (
    "SELECT * FROM b_suspicious ORDER BY anomaly_score DESC, transaction_index LIMIT 100"
)

ORACLES = {name: statement(body) for name, body in BODIES.items()}
