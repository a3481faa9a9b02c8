"""DuckDB statements for the retail questions, on the raw test tables.

Money is compared as double, averages to six places, dates as text.
"""

from __future__ import annotations

MARTS = """
customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         'customer' || c_custkey || '@example.com' AS email,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS registration_date,
         lower(c_mktsegment) AS membership_status
  FROM customer),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_brand AS supplier, p_size AS stock_quantity
  FROM part),
inventory AS (SELECT p_partkey AS product_id, p_size AS stock_quantity FROM part),
sales AS (
  SELECT l_orderkey || '-' || l_partkey AS sale_id, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(sum(l_quantity) AS BIGINT) AS quantity_sold, CAST(o_orderdate AS DATE) AS sale_date,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total_amount
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
  GROUP BY l_orderkey, l_partkey, o_custkey, CAST(o_orderdate AS DATE)),
spend AS (
  SELECT customer_id, first_name, last_name, membership_status,
         sum(total_amount) AS total, CAST(sum(quantity_sold) AS BIGINT) AS qty, count(*) AS n
  FROM customers JOIN sales USING (customer_id) GROUP BY ALL),
moved AS (
  SELECT product_id, product_name, category, price,
         sum(total_amount) AS total, CAST(sum(quantity_sold) AS BIGINT) AS qty, count(*) AS n
  FROM products JOIN sales USING (product_id) GROUP BY ALL),
named AS (
  SELECT product_name, sum(total) AS total, CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(n) AS BIGINT) AS n
  FROM moved GROUP BY product_name)
"""


def _sql(body: str, extra: str = "") -> str:
    return "WITH " + MARTS.strip() + (",\n" + extra.strip() if extra else "") + "\n" + body.strip()


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


_1997 = "sale_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"
_DATED = f"customer_id, first_name, {_day('registration_date')}"

_BODIES = {
    "q001": f"SELECT customer_id, first_name, last_name, email, {_day('registration_date')}, membership_status FROM customers",
    "q002": "SELECT count(*) AS total_products FROM part",
    "q003": "SELECT product_name, CAST(price AS DOUBLE) AS price FROM products WHERE price > 950",
    "q004": "SELECT round(avg(p_retailprice), 6) AS average_price FROM part",
    "q005": "SELECT CAST(sum(total_amount) AS DOUBLE) AS total_sales_amount FROM sales",
    "q006": "SELECT membership_status FROM customers GROUP BY 1",
    "q007": "SELECT first_name || ' ' || last_name AS full_name FROM customers",
    "q008": "SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, supplier, stock_quantity FROM products WHERE category = 'ECONOMY'",
    "q009": "SELECT CAST(max(price) AS DOUBLE) AS highest_price FROM products",
    "q010": "SELECT product_id, n AS number_of_sales FROM moved",
    "q011": "SELECT product_id, qty AS total_quantity_sold FROM moved",
    "q012": "SELECT CAST(min(price) AS DOUBLE) AS lowest_price FROM products",
    "q013": "SELECT customer_id, first_name, last_name FROM customers WHERE EXISTS (SELECT 1 FROM sales s JOIN products p USING (product_id) WHERE s.customer_id = customers.customer_id AND p.price > 990)",
    "q014": "SELECT product_name, CAST(total AS DOUBLE) AS total_sales_amount FROM named",
    "q015": "SELECT customer_id, first_name, last_name, CAST(total AS DOUBLE) AS total_spent FROM spend",
    "q016": "SELECT first_name, last_name, product_name, quantity_sold FROM sales JOIN products USING (product_id) JOIN customers USING (customer_id)",
    "q017": "SELECT customer_id AS customer_1_id, first_name AS customer_1_first, membership_status, (SELECT 1 + count(*) FROM customers b WHERE b.membership_status = a.membership_status AND b.customer_id < a.customer_id) AS position, (SELECT count(*) FROM customers b WHERE b.membership_status = a.membership_status AND b.customer_id > a.customer_id) AS pair_count FROM customers a",
    "q018": "SELECT product_name, n AS total_sales_count FROM named",
    "q019": "SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, supplier, stock_quantity FROM products WHERE stock_quantity < 10",
    "q020": "SELECT product_name, qty AS total_sold FROM named WHERE qty > 25000",
    "q021": "SELECT customer_id, first_name FROM customers WHERE customer_id IN (SELECT s.customer_id FROM sales s JOIN products p USING (product_id) WHERE p.category = 'ECONOMY' OR p.category = 'PROMO')",
    "q022": "SELECT product_name, CAST(total AS DOUBLE) AS total_sales_amount FROM named",
    "q023": f"SELECT customer_id, first_name FROM sales JOIN customers USING (customer_id) WHERE {_1997}",
    "q024": f"SELECT customer_id, first_name, CAST(sum(total_amount) AS DOUBLE) AS total_sales FROM sales JOIN customers USING (customer_id) WHERE {_1997} GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 1",
    "q025": "SELECT product_name, CAST(price AS DOUBLE) AS price FROM moved ORDER BY moved.price DESC, product_id LIMIT 1",
    "q026": "SELECT count(*) AS customer_count FROM sales JOIN products USING (product_id) JOIN customers USING (customer_id) WHERE price > 950",
    "q026_intent": "SELECT count(DISTINCT customer_id) AS customer_count FROM sales JOIN products USING (product_id) JOIN customers USING (customer_id) WHERE price > 950",
    "q027": "SELECT count(*) AS total_sales_gold_members FROM sales JOIN customers USING (customer_id) JOIN products USING (product_id) WHERE membership_status = 'building'",
    "q028": "SELECT p.product_name, i.stock_quantity FROM products p JOIN inventory i USING (product_id) WHERE i.stock_quantity < 10",
    "q029": "SELECT customer_id, first_name, last_name, qty AS total_quantity FROM spend WHERE qty > 1000",
    "q030": "SELECT product_id, round(avg(quantity_sold), 6) AS avg_quantity_sold FROM sales GROUP BY 1",
    "q031": "SELECT count(*) AS sales_in_dec_2023 FROM sales WHERE year(sale_date) = 1997 AND month(sale_date) = 12",
    "q032": f"SELECT customer_id, first_name, CAST(sum(total_amount) AS DOUBLE) AS total_spent FROM sales JOIN customers USING (customer_id) WHERE {_1997} GROUP BY 1, 2",
    "q033": "SELECT m.product_name, i.stock_quantity FROM moved m JOIN inventory i USING (product_id) WHERE i.stock_quantity < 5",
    "q034": "SELECT product_name, CAST(total AS DOUBLE) AS total_sales FROM named",
    "q035": f"SELECT DISTINCT {_DATED}, {_day('sale_date')} FROM sales JOIN customers USING (customer_id) WHERE date_diff('day', customers.registration_date, sales.sale_date) BETWEEN 0 AND 7",
    "q036": "SELECT product_name, CAST(price AS DOUBLE) AS price, quantity_sold, CAST(total_amount AS DOUBLE) AS total_amount FROM sales JOIN products USING (product_id) WHERE products.price BETWEEN 920 AND 960",
    "q037": "SELECT customer_id, first_name, n AS purchase_count FROM spend ORDER BY n DESC, customer_id LIMIT 1",
    "q038": "SELECT customer_id, first_name, qty AS total_quantity_sold FROM spend",
    "q039": "SELECT product_id, product_name, stock_quantity, 'highest' AS stock_level FROM products WHERE stock_quantity = (SELECT max(p_size) FROM part) UNION ALL SELECT product_id, product_name, stock_quantity, 'lowest' FROM products WHERE stock_quantity = (SELECT min(p_size) FROM part)",
    "q040": "SELECT product_name, CAST(sum(total_amount) AS DOUBLE) AS total_sales FROM products LEFT JOIN sales USING (product_id) WHERE contains(product_name, 'ring') GROUP BY 1",
    "q041": "SELECT first_name, membership_status, product_name, CAST(sum(total_amount) AS DOUBLE) AS total_sales_amount FROM customers JOIN sales USING (customer_id) JOIN products USING (product_id) WHERE membership_status = 'building' GROUP BY customer_id, first_name, membership_status, product_name",
    "q042": "SELECT category, CAST(sum(total) AS DOUBLE) AS total_sales FROM moved GROUP BY 1",
    "q043": "SELECT product_name, year(sale_date) AS sale_year, month(sale_date) AS sale_month, CAST(sum(total_amount) AS DOUBLE) AS total_sales FROM sales JOIN products USING (product_id) GROUP BY 1, 2, 3",
    "q044": "SELECT DISTINCT m.product_name, i.stock_quantity AS remaining_stock FROM moved m JOIN inventory i USING (product_id) WHERE i.stock_quantity > 0",
    "q045": "SELECT customer_id, first_name, CAST(total AS DOUBLE) AS total_purchases FROM spend ORDER BY total DESC, customer_id LIMIT 5",
    "q046": f"SELECT count(DISTINCT product_id) AS unique_products_sold_2023 FROM sales WHERE {_1997}",
    "q047": "SELECT product_name FROM products p WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.product_id = p.product_id AND s.sale_date >= DATE '2001-02-01')",
    "q048": "SELECT product_name, CAST(price AS DOUBLE) AS price, CAST(sum(qty) AS BIGINT) AS total_quantity_sold FROM moved WHERE moved.price BETWEEN 930 AND 980 GROUP BY 1, 2",
    "q049": f"SELECT customer_id, first_name, CAST(sum(total_amount) AS DOUBLE) AS total_spent FROM sales JOIN customers USING (customer_id) WHERE {_1997} GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 1",
    "q050": "SELECT product_name, CAST(price AS DOUBLE) AS price, CAST(sum(qty) AS BIGINT) AS total_sold_products FROM moved WHERE moved.price > 950 GROUP BY 1, 2 HAVING sum(qty) > 900",
    "q051": "SELECT customer_id, first_name, CAST(total_amount AS DOUBLE) AS total_amount FROM sales JOIN customers USING (customer_id) WHERE sales.total_amount > (SELECT avg(total_amount) FROM sales)",
    "q051_intent": "SELECT customer_id, first_name, CAST(total AS DOUBLE) AS total_spent FROM spend WHERE total > (SELECT avg(total) FROM spend)",
    "q052": "SELECT product_id, product_name, CAST(price AS DOUBLE) AS price FROM products WHERE products.price > (SELECT avg(price) FROM products)",
    "q053": "SELECT customer_id, first_name FROM customers c WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.customer_id = c.customer_id)",
    "q053_in_year": f"SELECT customer_id, first_name FROM customers c WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.customer_id = c.customer_id AND {_1997})",
    "q054": "SELECT product_id, product_name FROM products p WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.product_id = p.product_id)",
    "q054_in_quarter": "SELECT product_id, product_name FROM products p WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.product_id = p.product_id AND s.sale_date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31')",
    "q055": "SELECT customer_id, first_name, CAST(total_amount AS DOUBLE) AS total_amount FROM sales JOIN customers USING (customer_id) WHERE sales.total_amount = (SELECT max(total_amount) FROM sales)",
    "q056": "SELECT product_id, product_name, CAST(total_amount AS DOUBLE) AS total_amount FROM sales JOIN products USING (product_id) WHERE sales.total_amount > (SELECT avg(total_amount) FROM sales)",
    "q056_intent": "SELECT product_id, product_name, CAST(total AS DOUBLE) AS total_amount FROM moved WHERE total > (SELECT avg(total) FROM moved)",
    "q057": f"SELECT {_DATED} FROM customers WHERE date_diff('day', DATE '1970-01-01', customers.registration_date) < (SELECT avg(date_diff('day', DATE '1970-01-01', registration_date)) FROM customers)",
    "q058": "SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price FROM products p WHERE p.price > (SELECT avg(price) FROM products q WHERE q.category = p.category)",
    "q059": "SELECT customer_id, first_name, CAST(total_amount AS DOUBLE) AS total_amount FROM sales JOIN customers USING (customer_id) WHERE sales.total_amount > (SELECT total_amount FROM sales WHERE customer_id = 10 ORDER BY sale_id LIMIT 1)",
    "q059_intent": "SELECT customer_id, first_name, CAST(total AS DOUBLE) AS total_spent FROM spend WHERE total > (SELECT total FROM spend WHERE customer_id = 10)",
    "q060": "SELECT product_id, product_name, quantity_sold FROM sales JOIN products USING (product_id) WHERE quantity_sold > (SELECT avg(quantity_sold) FROM sales)",
    "q060_intent": "SELECT product_id, product_name, qty AS quantity_sold FROM moved WHERE qty > (SELECT avg(qty) FROM moved)",
    "q061": "SELECT customer_id, first_name, CAST(total AS DOUBLE) AS total_spent FROM spend ORDER BY total DESC, customer_id LIMIT 5",
    "q062": "SELECT product_id, product_name, qty AS total_quantity FROM moved ORDER BY qty DESC, product_id LIMIT 3",
    "q063": "SELECT category, CAST(sum(total) AS DOUBLE) AS total_revenue FROM moved GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
    "q064": "SELECT customer_id, first_name, n AS purchase_count FROM spend WHERE n > 1",
    "q064_intent": "SELECT customer_id, first_name, n AS purchase_count FROM spend WHERE n > 2",
    "q065": "SELECT product_id, qty AS total_quantity_sold FROM moved WHERE qty > (SELECT avg(quantity_sold) FROM sales)",
    "q065_intent": "SELECT product_id, qty AS total_quantity_sold FROM moved WHERE qty > (SELECT avg(qty) FROM moved)",
    "q066": "SELECT customer_id, first_name, last_name, CAST(total AS DOUBLE) AS total_spent FROM spend WHERE total > (SELECT avg(total) FROM spend)",
    "q067": "SELECT product_name, CAST(total AS DOUBLE) AS total_revenue FROM named",
    "q068": "SELECT year(sale_date) AS sale_year, month(sale_date) AS sale_month, CAST(sum(total_amount) AS DOUBLE) AS monthly_revenue FROM sales GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1",
    "q069": "SELECT product_id, product_name, count(DISTINCT customer_id) AS unique_customers FROM sales JOIN products USING (product_id) GROUP BY 1, 2 HAVING count(DISTINCT customer_id) > 3",
    "q070": "SELECT product_id, product_name, qty AS total_quantity FROM moved WHERE qty < (SELECT avg(qty) FROM moved)",
    "q071": "SELECT customer_id, first_name, CAST(total_amount AS DOUBLE) AS total_amount, rank() OVER (ORDER BY u.total_amount DESC) AS customer_rank FROM (SELECT DISTINCT customer_id, first_name, total_amount FROM sales JOIN customers USING (customer_id)) u",
    "q071_intent": "SELECT customer_id, first_name, CAST(total AS DOUBLE) AS total_spent, rank() OVER (ORDER BY total DESC) AS customer_rank FROM spend",
    "q072": "SELECT product_id, product_name, quantity_sold, rank() OVER (ORDER BY quantity_sold DESC) AS rank_quantity_sold FROM (SELECT DISTINCT product_id, product_name, quantity_sold FROM sales JOIN products USING (product_id)) u",
    "q072_intent": "SELECT product_id, product_name, qty AS total_quantity, rank() OVER (ORDER BY qty DESC) AS rank_quantity_sold FROM moved",
    "q073": "SELECT customer_id, first_name, CAST(total_amount AS DOUBLE) AS total_amount, rank() OVER (ORDER BY u.total_amount DESC) AS customer_rank FROM (SELECT DISTINCT customer_id, first_name, total_amount FROM sales JOIN customers USING (customer_id)) u QUALIFY customer_rank = 3",
    "q073_intent": "SELECT customer_id, first_name, CAST(total AS DOUBLE) AS total_spent, rank() OVER (ORDER BY total DESC) AS customer_rank FROM spend QUALIFY customer_rank = 3",
    "q074": "SELECT product_id, product_name, CAST(price AS DOUBLE) AS price, rank() OVER (ORDER BY products.price DESC) AS price_rank FROM products QUALIFY price_rank = 2",
    "q074_third": "SELECT product_id, product_name, CAST(price AS DOUBLE) AS price, rank() OVER (ORDER BY products.price DESC) AS price_rank FROM products QUALIFY price_rank = 3",
    "q075": "SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, rank() OVER (PARTITION BY category ORDER BY products.price DESC) AS price_category_rank FROM products",
    "q076": "SELECT customer_id, first_name, n AS purchase_count, rank() OVER (ORDER BY n DESC) AS purchase_rank FROM spend",
    "q077": f"SELECT sale_id, {_day('sale_date')}, CAST(sum(total_amount) OVER (ORDER BY sales.sale_date DESC) AS DOUBLE) AS running_total FROM sales",
    "q077_intent": f"SELECT sale_id, {_day('sale_date')}, CAST(sum(total_amount) OVER (ORDER BY sales.sale_date) AS DOUBLE) AS running_total FROM sales",
    "q078": f"SELECT sale_id, {_day('sale_date')}, CAST(total_amount AS DOUBLE) AS total_amount, CAST(lag(sales.total_amount) OVER (ORDER BY sales.sale_date, sale_id) AS DOUBLE) AS previous_amount FROM sales",
    "q079": f"SELECT sale_id, {_day('sale_date')}, CAST(total_amount AS DOUBLE) AS total_amount, CAST(lead(sales.total_amount) OVER (ORDER BY sales.sale_date, sale_id) AS DOUBLE) AS next_amount FROM sales",
    "q080": "SELECT customer_id, first_name, last_name, CAST(total AS DOUBLE) AS total_spent, ntile(4) OVER (ORDER BY total DESC, customer_id) AS spending_group FROM spend",
    "q081": "SELECT customer_id, first_name, category, count(DISTINCT category) AS category_count FROM sales JOIN customers USING (customer_id) JOIN products USING (product_id) GROUP BY 1, 2, 3 HAVING count(DISTINCT category) > 1",
    "q081_intent": "SELECT customer_id, first_name, count(DISTINCT category) AS category_count FROM sales JOIN customers USING (customer_id) JOIN products USING (product_id) GROUP BY 1, 2 HAVING count(DISTINCT category) > 1",
    "q082": f"SELECT {_DATED}, {_day('sale_date')} FROM sales JOIN customers USING (customer_id) WHERE date_diff('day', customers.registration_date, sales.sale_date) BETWEEN 0 AND 7",
    "q083": "SELECT p.product_id, p.product_name, i.stock_quantity FROM products p JOIN inventory i USING (product_id) WHERE i.stock_quantity < (SELECT avg(stock_quantity) FROM inventory)",
    "q084": "SELECT customer_id, first_name, last_name, product_name, count(*) AS times_purchased FROM sales JOIN customers USING (customer_id) JOIN products USING (product_id) GROUP BY 1, 2, 3, 4 HAVING count(*) > 1",
    "q085": "SELECT category, CAST(sum(total) AS DOUBLE) AS total_revenue FROM moved GROUP BY 1",
    "q086": "SELECT product_name, qty AS total_qty_sold FROM named QUALIFY rank() OVER (ORDER BY qty DESC) <= 3",
    "q087": "SELECT customer_id, first_name, last_name FROM customers WHERE customer_id IN (SELECT customer_id FROM sales JOIN products USING (product_id) WHERE price = (SELECT max(price) FROM products))",
    "q088": "SELECT product_name, count(DISTINCT customer_id) AS unique_customers FROM sales JOIN products USING (product_id) GROUP BY 1",
    "q089": "SELECT DISTINCT customer_id, first_name, last_name, CAST(total_amount AS DOUBLE) AS total_amount FROM sales JOIN customers USING (customer_id) WHERE sales.total_amount > (SELECT avg(total_amount) FROM sales)",
    "q090": "SELECT customer_id, first_name, last_name, qty AS total_qty FROM spend WHERE qty > (SELECT avg(q) FROM (SELECT sum(quantity_sold) AS q FROM sales GROUP BY customer_id))",
    "q091": "SELECT customer_id, first_name, last_name, CAST(total AS DOUBLE) AS total_spent FROM spend QUALIFY ntile(10) OVER (ORDER BY total DESC, customer_id) = 1",
    "q092": "SELECT product_name, CAST(total AS DOUBLE) AS total_revenue FROM (SELECT *, sum(total) OVER (ORDER BY total DESC) AS running, sum(total) OVER () AS grand FROM named) WHERE 2 * (running - total) < grand",
    "q093": "SELECT DISTINCT customer_id, first_name, last_name FROM customers JOIN (SELECT DISTINCT customer_id, date_trunc('month', sale_date) AS m FROM sales) a USING (customer_id) WHERE EXISTS (SELECT 1 FROM sales s WHERE s.customer_id = customers.customer_id AND date_trunc('month', s.sale_date) = a.m + INTERVAL 1 MONTH)",
    "q094": "SELECT product_name, stock_quantity, CAST(coalesce(sum(quantity_sold), 0) AS BIGINT) AS total_sold, CAST(stock_quantity - coalesce(sum(quantity_sold), 0) AS BIGINT) AS stock_difference FROM products LEFT JOIN sales USING (product_id) GROUP BY 1, 2",
    "q095": "SELECT customer_id, first_name, last_name, membership_status, CAST(total AS DOUBLE) AS total_spent, round(tier, 6) AS tier_average FROM (SELECT *, avg(total) OVER (PARTITION BY membership_status) AS tier FROM spend) WHERE total > tier",
    "q096": "SELECT m.product_name, m.category, CAST(m.total AS DOUBLE) AS total_sales, round(a.mean, 6) AS avg_category_sales FROM moved m JOIN (SELECT category, avg(total_amount) AS mean FROM sales JOIN products USING (product_id) GROUP BY 1) a USING (category) WHERE m.total > a.mean",
    "q096_intent": "SELECT product_name, category, CAST(total AS DOUBLE) AS total_sales, round(mean, 6) AS avg_category_sales FROM (SELECT *, avg(total) OVER (PARTITION BY category) AS mean FROM moved) WHERE total > mean",
    "q097": "SELECT customer_id, first_name, last_name, CAST(s.total_amount AS DOUBLE) AS single_purchase, CAST(p.total AS DOUBLE) AS total_spent, round(CAST(s.total_amount AS DOUBLE) / CAST(p.total AS DOUBLE) * 100, 2) AS pct_of_total FROM sales s JOIN spend p USING (customer_id) ORDER BY pct_of_total DESC, customer_id, s.total_amount DESC LIMIT 1",
    "q098": "SELECT product_name, category, qty AS total_qty_sold, rank() OVER (PARTITION BY category ORDER BY qty DESC) AS qty_rank FROM (SELECT product_name, category, CAST(sum(qty) AS BIGINT) AS qty FROM moved GROUP BY 1, 2) QUALIFY qty_rank <= 3",
    "q099": "SELECT customer_id, first_name, last_name, CAST(total AS DOUBLE) AS total_spent FROM spend WHERE total = (SELECT max(total) FROM spend)",
    "q100": "SELECT p.product_name FROM products p JOIN sales s USING (product_id) GROUP BY product_id, p.product_name HAVING count(DISTINCT year(s.sale_date)) = (SELECT count(DISTINCT year(sale_date)) FROM sales)",
}


def statements() -> dict[str, str]:
    return {name: _sql(body) for name, body in _BODIES.items()}
