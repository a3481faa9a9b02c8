"""DuckDB statements for the commerce queries, from the raw test tables.

The flaws of the inputs follow from keys, so the clean tables are stated
directly instead of by cleaning.
"""

from __future__ import annotations

_TABLES = """
orders_c AS (
  SELECT 'O' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id,
         CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
         lower(o_orderstatus) AS status,
         CASE WHEN o_orderkey % 41 = 0 THEN -o_totalprice WHEN o_orderkey % 59 <> 0 THEN o_totalprice END AS total_amount,
         CAST(o_orderkey % 20 AS DOUBLE) AS discount_pct,
         (o_orderkey % 41 = 0 AND o_totalprice > 0) AS negative_amount_flag
  FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 97 <> 0),
items_c AS (
  SELECT 'O' || l_orderkey || '-P' || l_partkey AS item_id,
         CASE WHEN l_partkey % 53 = 0 THEN 'O_MISSING_' || l_orderkey ELSE 'O' || l_orderkey END AS order_id,
         'P' || l_partkey AS product_id, p_type AS category, CAST(sum(l_quantity) AS BIGINT) AS quantity,
         p_retailprice AS unit_price
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE (l_orderkey + l_partkey) % 89 <> 0
  GROUP BY l_orderkey, l_partkey, p_type, p_retailprice),
customers_c AS (
  SELECT 'C' || c_custkey AS customer_id,
         CASE WHEN c_custkey % 43 <> 0 THEN 'customer' || c_custkey || '@example.com' END AS email,
         n_name AS country, lower(c_mktsegment) AS customer_tier,
         CASE WHEN c_custkey % 50 = 7 THEN NULL
              ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) END AS signup_date
  FROM customer JOIN nation ON n_nationkey = c_nationkey),
returned AS (
  SELECT l_orderkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS refund,
         CAST(max(l_shipdate) AS DATE) AS day
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
returns_c AS (
  SELECT 'R' || k AS return_id, CASE WHEN k % 29 = 0 THEN 'O_MISSING_' || k ELSE 'O' || k END AS order_id,
         CASE WHEN k % 50 = 7 THEN NULL ELSE day END AS return_date,
         CASE WHEN k % 37 = 0 THEN -refund WHEN k % 31 <> 0 THEN refund END AS refund_amount,
         CASE k % 3 WHEN 0 THEN 'damaged' WHEN 1 THEN 'late' ELSE 'wrong item' END AS reason
  FROM returned WHERE k % 103 <> 0),
paid AS (
  SELECT o.*, email, country, customer_tier, signup_date,
         total_amount * (1 - discount_pct / 100) AS net_amount
  FROM orders_c o JOIN customers_c USING (customer_id)),
enriched AS (
  SELECT p.*, item_id, product_id, category, quantity, unit_price FROM paid p LEFT JOIN items_c USING (order_id)),
once AS (
  SELECT p.order_id, customer_id, country, customer_tier, f.category, net_amount
  FROM paid p LEFT JOIN (SELECT order_id, arg_min(category, item_id) AS category FROM items_c GROUP BY 1) f USING (order_id)),
given_back AS (
  SELECT r.*, customer_id, country, customer_tier, category, net_amount,
         refund_amount > net_amount AS refund_exceeds_order
  FROM returns_c r LEFT JOIN once USING (order_id))
"""

_ENRICHED_COLUMNS = """customer_id, order_id, strftime(order_date, '%Y-%m-%d') AS order_date, status, total_amount,
  discount_pct, negative_amount_flag, email, country, customer_tier, strftime(signup_date, '%Y-%m-%d') AS signup_date,
  round(net_amount, 6) AS net_amount, year(order_date) AS order_year, month(order_date) AS order_month,
  item_id, product_id, category, quantity, unit_price"""


def _exact(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(22,6))) AS DOUBLE)"


def _spend(source: str) -> str:
    return f"""SELECT customer_id, country, round(total, 6) AS total_spent,
      row_number() OVER (PARTITION BY country ORDER BY total DESC NULLS LAST, customer_id) AS rank
    FROM (SELECT customer_id, country, {_exact('net_amount')} AS total FROM {source} GROUP BY 1, 2)"""


def _share(source: str) -> str:
    return f"""SELECT category, round(total, 6) AS total_revenue, round(total / (SELECT {_exact('net_amount')} FROM {source}), 6) AS revenue_share
    FROM (SELECT category, {_exact('net_amount')} AS total FROM {source} GROUP BY 1)"""


def _rate(column: str) -> str:
    return f"""SELECT o.{column}, total_orders, coalesce(n, 0) AS total_returns, round(coalesce(n, 0) / total_orders, 6) AS return_rate
    FROM (SELECT {column}, count(DISTINCT order_id) AS total_orders FROM once GROUP BY 1) o
    LEFT JOIN (SELECT {column}, count(DISTINCT order_id) AS n FROM given_back GROUP BY 1) r ON o.{column} IS NOT DISTINCT FROM r.{column}"""


_RAW_ORDER = """SELECT CASE WHEN o_orderkey % 101 <> 0 THEN 'O' || o_orderkey END AS order_id, o_orderkey AS k
    FROM orders JOIN range(2) copies(i) ON i = 0 OR o_orderkey % 13 = 0"""

_DAILY = "SELECT customer_id, order_date, count(DISTINCT order_id) AS n FROM enriched GROUP BY 1, 2"

_BODIES = {
    "clean_orders": "SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, status, total_amount, discount_pct, negative_amount_flag FROM orders_c",
    "clean_order_items": "SELECT * FROM items_c",
    "clean_customers": "SELECT customer_id, email, country, customer_tier, strftime(signup_date, '%Y-%m-%d') AS signup_date FROM customers_c",
    "csv_customers": "SELECT customer_id, email, country, customer_tier, strftime(signup_date, '%Y-%m-%d') AS signup_date FROM customers_c",
    "clean_returns": "SELECT return_id, order_id, strftime(return_date, '%Y-%m-%d') AS return_date, round(refund_amount, 6) AS refund_amount, reason FROM returns_c",
    "rejected_orders": """SELECT CAST(NULL AS VARCHAR) AS order_id, CASE WHEN k % 97 <> 0 THEN 'C' || o_custkey END AS customer_id,
        CASE WHEN k % 50 = 7 THEN 'soon' WHEN k % 3 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
        lower(o_orderstatus) AS status,
        CASE WHEN k % 41 = 0 THEN -o_totalprice WHEN k % 59 <> 0 THEN o_totalprice END AS total_amount,
        CAST(k % 20 AS DOUBLE) AS discount_pct
      FROM (SELECT *, o_orderkey AS k FROM orders JOIN range(2) copies(i) ON i = 0 OR o_orderkey % 13 = 0 WHERE o_orderkey % 101 = 0)""",
    "reject_counts": """SELECT 'orders' AS table_name, count(*) AS row_count, count_if(k % 101 = 0) AS rejected_count FROM (""" + _RAW_ORDER + """)
      UNION ALL SELECT 'order_items', count(*), count_if((l_orderkey + l_partkey) % 89 = 0) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
      UNION ALL SELECT 'customers', count(*), 0 FROM customer JOIN range(2) copies(i) ON i = 0 OR c_custkey % 11 = 0
      UNION ALL SELECT 'returns', count(*), count_if(k % 103 = 0) FROM returned JOIN range(2) copies(i) ON i = 0 OR k % 17 = 0""",
    "key_violations": "SELECT order_id, count(*) AS copies FROM (" + _RAW_ORDER + ") GROUP BY 1 HAVING order_id IS NULL OR count(*) > 1",
    "reference_violations": "SELECT return_id, order_id, strftime(return_date, '%Y-%m-%d') AS return_date, round(refund_amount, 6) AS refund_amount, reason FROM returns_c WHERE order_id NOT IN (SELECT order_id FROM orders_c)",
    "too_long_names": "SELECT 'first_name' AS column_name, count_if(length(split_part(c_name, '#', 1)) > 50) AS too_long FROM customer UNION ALL SELECT 'last_name', count_if(length(split_part(c_name, '#', 2)) > 8) FROM customer UNION ALL SELECT 'membership_status', count_if(length(c_mktsegment) > 9) FROM customer",
    "orphaned_items": "SELECT i.* FROM items_c i WHERE NOT EXISTS (SELECT 1 FROM orders_c o WHERE o.order_id = i.order_id)",
    "enriched_orders": f"SELECT {_ENRICHED_COLUMNS} FROM enriched",
    "enriched_partitions": "SELECT year(order_date) AS order_year, month(order_date) AS order_month, count(*) AS row_count FROM enriched GROUP BY 1, 2",
    "customer_spend_rank": _spend("enriched"),
    "customer_spend_rank_intent": _spend("once"),
    "rolling_order_count": f"SELECT customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, n AS daily_orders, CAST(sum(n) OVER (PARTITION BY customer_id ORDER BY d.order_date NULLS FIRST ROWS 6 PRECEDING) AS BIGINT) AS rolling_7d_orders FROM ({_DAILY}) d",
    "rolling_order_count_intent": f"SELECT customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, n AS daily_orders, (SELECT CAST(sum(b.n) AS BIGINT) FROM daily b WHERE b.customer_id = d.customer_id AND (b.order_date BETWEEN d.order_date - 6 AND d.order_date OR (b.order_date IS NULL AND d.order_date IS NULL))) AS rolling_7d_orders FROM daily d",
    "category_revenue_share": _share("enriched"),
    "category_revenue_share_intent": _share("once"),
    "commerce_batch": _share("enriched"),
    "orders_once": "SELECT order_id, customer_id, country, customer_tier, category, round(net_amount, 6) AS net_amount FROM once",
    "returns_enriched": "SELECT return_id, order_id, strftime(return_date, '%Y-%m-%d') AS return_date, round(refund_amount, 6) AS refund_amount, reason, customer_id, country, customer_tier, category, round(net_amount, 6) AS net_amount, refund_exceeds_order FROM given_back",
    "return_by_category": "SELECT category, count(DISTINCT order_id) AS total_returns FROM given_back GROUP BY 1",
    "return_by_tier": "SELECT customer_tier, count(DISTINCT order_id) AS total_returns FROM given_back GROUP BY 1",
    "return_rate_by_category": _rate("category"),
    "return_rate_by_tier": _rate("customer_tier"),
    "top_refund_customers": f"SELECT customer_id, round({_exact('refund_amount')}, 6) AS total_refund FROM given_back GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS FIRST LIMIT 10",
}


# The batch job's outputs answer the same questions, through CSV files.
_BODIES |= {f"batch_{name}": _BODIES[name] for name in (
    "customer_spend_rank", "rolling_order_count", "return_by_category", "return_by_tier", "top_refund_customers",
    "enriched_orders", "orphaned_items", "returns_enriched", "rejected_orders", "reject_counts",
)}


def statements() -> dict[str, str]:
    tables = "WITH " + _TABLES.strip()
    return {
        name: f"{tables},\ndaily AS ({_DAILY})\n{body}" for name, body in _BODIES.items()
    }
