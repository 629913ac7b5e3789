"""Plain SQL with the same results as the catalogue, for checking it on another engine.

Amounts are summed as decimals, so the totals do not depend on row order. The
linear model is fitted by the same coordinate descent, as a recursive query.
"""

from __future__ import annotations

DELIVERED = "SELECT * FROM orders WHERE o_orderstatus LIKE '%F%'"


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({money(x)} / COUNT({x}))"


def wide(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,4))) AS DOUBLE)"


def pct2(part: str, whole: str) -> str:
    """Percentage rounded half up to two decimals, in integers."""
    return f"CAST(({part} * 20000 + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


TOTAL = money("o_totalprice")
AVG = mean("o_totalprice")

DAILY = f"""
SELECT CAST(o_orderdate AS DATE) AS date_jour, COUNT(*) AS nb_commandes,
       COUNT(DISTINCT o_custkey) AS clients_uniques,
       {TOTAL} AS total_ventes_day, {AVG} AS panier_moyen_day
FROM ({DELIVERED}) GROUP BY 1"""

MONTHLY = f"""
SELECT strftime(o_orderdate, '%Y-%m') AS year_month, {TOTAL} AS total_sales,
       COUNT(*) AS order_count, {AVG} AS avg_sale
FROM ({DELIVERED}) GROUP BY 1"""

HISTORY = f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, {TOTAL} AS daily_sales
FROM ({DELIVERED})
WHERE o_orderdate >= (SELECT MAX(o_orderdate) FROM orders) - INTERVAL 30 DAY GROUP BY 1"""

BEHAVIOR = f"""
SELECT o_custkey AS customer_id, COUNT(*) AS nombre_commandes,
       COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS jours_achat,
       {TOTAL} AS total_depense, {AVG} AS panier_moyen
FROM ({DELIVERED}) GROUP BY 1"""

SEGMENTED = f"""
SELECT *, CASE WHEN total_depense >= 1000000 THEN 'VIP' WHEN total_depense >= 500000 THEN 'Fidèle'
               WHEN total_depense >= 100000 THEN 'Actif' ELSE 'Occasionnel' END AS segment
FROM ({BEHAVIOR})"""

ITEMS = f"""
SELECT l_orderkey AS order_id, l_partkey AS product_id, p_name AS name,
       p_retailprice AS price, l_quantity AS quantity
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""

DELIVERED_ITEMS = f"""
SELECT i.* FROM ({ITEMS}) i WHERE i.order_id IN (SELECT o_orderkey FROM ({DELIVERED}))"""

PRODUCT_SALES = f"""
SELECT product_id, name AS produit, COUNT(*) AS nb_ventes, SUM(quantity) AS quantite_totale
FROM ({DELIVERED_ITEMS}) GROUP BY 1, 2"""

CUSTOMERS = """
SELECT c_custkey AS customer_id, c_name AS name, n_name AS location,
       (SELECT MIN(ts) FROM events WHERE event_type = 'signup' AND user_id = c_custkey) AS join_date
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

TOP5_SPENDERS = f"""
SELECT o_custkey AS customer_id, {TOTAL} AS total_spent, COUNT(*) AS order_count, {AVG} AS avg_order
FROM ({DELIVERED}) GROUP BY 1 ORDER BY total_spent DESC, customer_id LIMIT 5"""

ORDERS_VIEW = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS date,
       o_totalprice AS total_amount, o_orderpriority AS payment_method, o_orderstatus AS status
FROM orders"""

# The fallback to all orders below five delivered ones.
TRAINING = f"""
SELECT * FROM ({ORDERS_VIEW})
WHERE status LIKE '%F%' OR (SELECT COUNT(*) FROM orders WHERE o_orderstatus LIKE '%F%') < 5"""

FEATURES = """CAST(day({d}) AS INTEGER) AS day, CAST(dayofweek({d}) + 1 AS INTEGER) AS weekday,
       CAST(month({d}) AS INTEGER) AS month"""

WEEKDAY_CASE = """CASE dayofweek({d}) WHEN 0 THEN 'Dimanche' WHEN 1 THEN 'Lundi' WHEN 2 THEN 'Mardi'
       WHEN 3 THEN 'Mercredi' WHEN 4 THEN 'Jeudi' WHEN 5 THEN 'Vendredi' ELSE 'Samedi' END"""

KPIS = f"""
SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (o_orderstatus LIKE '%F%') AS delivered_orders,
       {money("CASE WHEN o_orderstatus LIKE '%F%' THEN o_totalprice END")} AS total_revenue,
       (SELECT COUNT(*) FROM customer) AS total_customers,
       (SELECT COUNT(*) FROM part) AS total_products,
       (SELECT COUNT(DISTINCT o_custkey) FROM ({DELIVERED})) AS active_customers
FROM orders"""

ORACLE: dict[str, str] = {
    "scan_orders": ORDERS_VIEW,
    "collection_profile": """
SELECT 'customers' AS collection, COUNT(*) AS n_rows, 4 AS n_cols FROM customer
UNION ALL SELECT 'orders', COUNT(*), 6 FROM orders
UNION ALL SELECT 'products', COUNT(*), 4 FROM part""",
    "preview_orders": f"{ORDERS_VIEW} ORDER BY order_id LIMIT 20",
    "schema_listing": """
SELECT s.collection, s.ordinal, s.column_name, s.data_type, n.n_rows
FROM (VALUES
  ('customers', 1, 'customer_id', 'bigint'), ('customers', 2, 'name', 'string'),
  ('customers', 3, 'location', 'string'), ('customers', 4, 'join_date', 'timestamp_ntz'),
  ('orders', 1, 'order_id', 'bigint'), ('orders', 2, 'customer_id', 'bigint'),
  ('orders', 3, 'date', 'timestamp_ntz'), ('orders', 4, 'total_amount', 'double'),
  ('orders', 5, 'payment_method', 'string'), ('orders', 6, 'status', 'string'),
  ('products', 1, 'product_id', 'bigint'), ('products', 2, 'name', 'string'),
  ('products', 3, 'category', 'string'), ('products', 4, 'price', 'double')
) AS s(collection, ordinal, column_name, data_type)
JOIN (SELECT 'customers' AS collection, COUNT(*) AS n_rows FROM customer
      UNION ALL SELECT 'orders', COUNT(*) FROM orders
      UNION ALL SELECT 'products', COUNT(*) FROM part) AS n USING (collection)""",
    "missing_values": f"""
WITH c AS ({CUSTOMERS}),
     m AS (SELECT COUNT(*) AS n, COUNT(*) - COUNT(customer_id) AS m1, COUNT(*) - COUNT(name) AS m2,
                  COUNT(*) - COUNT(location) AS m3, COUNT(*) - COUNT(join_date) AS m4 FROM c)
SELECT column_name, n_missing, n_missing * CAST(100 AS DOUBLE) / n AS pct_missing
FROM (SELECT n, 'customer_id' AS column_name, m1 AS n_missing FROM m
      UNION ALL SELECT n, 'name', m2 FROM m
      UNION ALL SELECT n, 'location', m3 FROM m
      UNION ALL SELECT n, 'join_date', m4 FROM m)
WHERE n_missing > 0""",
    "search_contains": f"SELECT * FROM ({ORDERS_VIEW}) WHERE payment_method LIKE '%URGENT%'",
    "search_hits": "SELECT COUNT(*) AS n_hits FROM customer WHERE c_name LIKE '%42%'",
    "export_json_rows": """
SELECT '{"order_id":' || o_orderkey || ',"customer_id":' || o_custkey
       || ',"date":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
       || '","total_amount":' || CAST(o_totalprice AS VARCHAR)
       || ',"payment_method":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}' AS json
FROM orders""",
    "signup_period": f"""
SELECT MIN(join_date) AS Premier_inscrit, MAX(join_date) AS Dernier_inscrit FROM ({CUSTOMERS})""",
    "order_period": """
SELECT MIN(o_orderdate) AS Premiere_commande, MAX(o_orderdate) AS Derniere_commande FROM orders""",
    "distinct_statuses": "SELECT DISTINCT o_orderstatus AS status FROM orders",
    "status_share": f"""
SELECT o_orderstatus AS status, COUNT(*) AS nombre_commandes,
       {pct2("COUNT(*)", "(SELECT COUNT(*) FROM orders)")} AS pourcentage
FROM orders GROUP BY 1""",
    "status_distribution": f"""
SELECT o_orderstatus AS status, COUNT(*) AS nombre, {AVG} AS "moyenne_TND" FROM orders GROUP BY 1""",
    "status_counts": """
SELECT CASE WHEN o_orderstatus IS NULL OR o_orderstatus = '' THEN 'Inconnu' ELSE o_orderstatus END AS status,
       n AS count, n * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM orders) AS percentage
FROM (SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1)""",
    "basic_statistics": f"""
SELECT total_orders, delivered_orders, delivered_orders * CAST(100 AS DOUBLE) / total_orders AS delivered_pct,
       total_customers, total_products, total_revenue,
       total_revenue / delivered_orders AS avg_order_value
FROM ({KPIS})""",
    "summary_report": f"""
WITH k AS ({KPIS})
SELECT 'commandes_totales' AS metric, CAST(total_orders AS DOUBLE) AS value FROM k
UNION ALL SELECT 'commandes_nettoyees', delivered_orders FROM k
UNION ALL SELECT 'taux_utilisation', delivered_orders * CAST(100 AS DOUBLE) / total_orders FROM k
UNION ALL SELECT 'clients_inscrits', total_customers FROM k
UNION ALL SELECT 'produits_disponibles', total_products FROM k
UNION ALL SELECT 'clients_actifs', active_customers FROM k
UNION ALL SELECT 'taux_activation', active_customers * CAST(100 AS DOUBLE) / total_customers FROM k
UNION ALL SELECT 'chiffre_affaires', total_revenue FROM k
UNION ALL SELECT 'panier_moyen', total_revenue / delivered_orders FROM k""",
    "quick_kpis": f"""
SELECT total_orders, delivered_orders, delivered_orders * CAST(100 AS DOUBLE) / total_orders AS delivered_pct,
       total_revenue AS total, total_revenue / delivered_orders AS avg
FROM ({KPIS})""",
    "delivered_revenue": f"""
SELECT {TOTAL} AS total_sales, {AVG} AS avg_order, MAX(o_totalprice) AS max_order, MIN(o_totalprice) AS min_order
FROM ({DELIVERED}) HAVING COUNT(*) > 0""",
    "order_statistics": f"""
SELECT COUNT(*) AS "Total_Commandes", {TOTAL} AS "Chiffre_Affaires_Total", {AVG} AS "Panier_Moyen" FROM orders""",
    "calendar_features": f"""
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS date_formatted,
       CAST(year(o_orderdate) AS INTEGER) AS year, {FEATURES.format(d="o_orderdate")},
       CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       strftime(o_orderdate, '%Y-%m') AS month_year
FROM ({DELIVERED})""",
    "weekday_names": f"""
SELECT CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday,
       {WEEKDAY_CASE.format(d="o_orderdate")} AS weekday_name, COUNT(*) AS n_orders
FROM orders GROUP BY 1, 2""",
    "daily_sales": DAILY,
    "daily_stats": f"""
SELECT CAST(SUM(nb_commandes) AS DOUBLE) / COUNT(*) AS commandes_moyennes_par_jour,
       MAX(nb_commandes) AS max_commandes_jour, MIN(nb_commandes) AS min_commandes_jour,
       COUNT(date_jour) AS nombre_jours_analyses
FROM ({DAILY})""",
    "first_days": f"SELECT * FROM ({DAILY}) ORDER BY date_jour LIMIT 5",
    "last_days": f"SELECT * FROM ({DAILY}) ORDER BY date_jour DESC LIMIT 5",
    "best_days": f"""
SELECT date_jour, nb_commandes, total_ventes_day, panier_moyen_day
FROM ({DAILY}) ORDER BY total_ventes_day DESC, date_jour LIMIT 5""",
    "order_day_window": f"""
SELECT order_id, date_jour, total_amount,
       CAST(SUM(amount) OVER day AS DOUBLE) AS total_ventes_day,
       CAST(SUM(amount) OVER day AS DOUBLE) / COUNT(amount) OVER day AS panier_moyen_day
FROM (SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS date_jour,
             o_totalprice AS total_amount, CAST(o_totalprice AS DECIMAL(18,4)) AS amount
      FROM ({DELIVERED}))
WINDOW day AS (PARTITION BY date_jour)""",
    "monthly_sales": MONTHLY,
    "monthly_first12": f"SELECT * FROM ({MONTHLY}) ORDER BY year_month LIMIT 12",
    "monthly_display6": f"""
SELECT * FROM (SELECT * FROM ({MONTHLY}) ORDER BY year_month LIMIT 12) ORDER BY year_month DESC LIMIT 6""",
    "daily_history_30d": HISTORY,
    "daily_history_mean": f"""
SELECT {wide("daily_sales")} / COUNT(*) AS hist_avg, COUNT(*) AS n_days FROM ({HISTORY})""",
    "amount_histogram": f"""
WITH d AS ({DELIVERED}),
     b AS (SELECT MIN(o_totalprice) AS low, (MAX(o_totalprice) - MIN(o_totalprice)) / 15 AS width FROM d),
     h AS (SELECT LEAST(CAST(floor((o_totalprice - low) / width) AS BIGINT), 14) AS bin, COUNT(*) AS n
           FROM d, b GROUP BY 1)
SELECT bin, low + bin * width AS low, low + (bin + 1) * width AS high, COALESCE(n, 0) AS n
FROM (SELECT range AS bin FROM range(15)) LEFT JOIN h USING (bin), b""",
    "amount_center": f"""
WITH d AS (SELECT o_totalprice AS x, row_number() OVER (ORDER BY o_totalprice) AS r, COUNT(*) OVER () AS n
           FROM ({DELIVERED}))
SELECT {mean("x")} AS mean_amount,
       SUM(x) FILTER (r = (n + 1) // 2 OR r = (n + 2) // 2)
       / COUNT(*) FILTER (r = (n + 1) // 2 OR r = (n + 2) // 2) AS median_amount
FROM d""",
    "payment_mix": f"""
SELECT o_orderpriority AS payment_method, COUNT(*) AS nombre_commandes,
       {pct2("COUNT(*)", "(SELECT COUNT(*) FROM orders)")} AS pourcentage,
       {TOTAL} AS montant_total, {AVG} AS panier_moyen
FROM orders GROUP BY 1""",
    "payment_distribution": f"""
SELECT o_orderpriority AS payment_method, COUNT(*) AS nombre, {TOTAL} AS "total_TND" FROM orders GROUP BY 1""",
    "payment_totals": f"""
SELECT CASE WHEN o_orderpriority IS NULL OR o_orderpriority = '' THEN 'Non spécifié'
            ELSE o_orderpriority END AS payment_method,
       n AS count, total_amount, avg_amount,
       n * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM orders) AS percentage
FROM (SELECT o_orderpriority, COUNT(*) AS n, {TOTAL} AS total_amount, {AVG} AS avg_amount
      FROM orders GROUP BY 1)""",
    "customer_behavior": BEHAVIOR,
    "customer_segments": f"SELECT customer_id, total_depense, segment FROM ({SEGMENTED})",
    "segment_summary": f"""
SELECT segment, COUNT(*) AS nb_clients, {wide("total_depense")} / COUNT(*) AS depense_moyenne,
       CAST(SUM(nombre_commandes) AS DOUBLE) / COUNT(*) AS commandes_moyennes
FROM ({SEGMENTED}) GROUP BY 1""",
    "top_customers_count": f"""
SELECT customer_id, nombre_commandes, jours_achat FROM ({BEHAVIOR})
ORDER BY nombre_commandes DESC, customer_id LIMIT 10""",
    "customer_behavior_top100": f"""
SELECT * FROM ({SEGMENTED}) ORDER BY nombre_commandes DESC, customer_id LIMIT 100""",
    "top_customers": f"""
SELECT t.customer_id, COALESCE(c_name, 'Client ' || right(CAST(t.customer_id AS VARCHAR), 4)) AS client_name,
       total_spent, order_count, avg_order
FROM ({TOP5_SPENDERS}) t LEFT JOIN customer ON c_custkey = t.customer_id""",
    "top_customer_labels": f"""
SELECT t.customer_id, total_spent,
       COALESCE(substr(substr(c_name, 1, 10) || ' (' || substr(n_name, 1, 3) || ')', 1, 12),
                substr(c_name, 1, 12), 'Client ' || right(CAST(t.customer_id AS VARCHAR), 4)) AS label
FROM ({TOP5_SPENDERS}) t LEFT JOIN customer ON c_custkey = t.customer_id
     LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "customers_by_location": """
SELECT n_name AS location, COUNT(*) AS "Nombre_Clients"
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "customer_overview": """
SELECT (SELECT COUNT(*) FROM customer) AS n_customers,
       (SELECT COUNT(*) FROM (SELECT DISTINCT n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey))
       AS n_cities""",
    "product_sales": PRODUCT_SALES,
    "top_products_count": f"""
SELECT * FROM ({PRODUCT_SALES}) ORDER BY nb_ventes DESC, product_id, produit LIMIT 10""",
    "top_products_revenue": f"""
SELECT product_id, COALESCE(name, 'Inconnu') AS name, SUM(quantity) AS total_sold,
       {money("price * quantity")} AS total_revenue, {mean("price")} AS avg_price
FROM ({DELIVERED_ITEMS}) GROUP BY product_id, name
ORDER BY total_revenue DESC, product_id, name LIMIT 5""",
    "product_catalog": """
SELECT p_partkey AS product_id, p_name AS name, p_retailprice AS price, p_type AS category
FROM part ORDER BY p_partkey, p_name LIMIT 100""",
    "price_statistics": f"""
SELECT COUNT(*) AS "Nombre_Produits", {mean("p_retailprice")} AS "Prix_Moyen",
       MIN(p_retailprice) AS "Prix_Min", MAX(p_retailprice) AS "Prix_Max"
FROM part""",
    "category_distribution": "SELECT p_type AS category, COUNT(*) AS count FROM part GROUP BY 1",
    "order_documents_json": f"""
WITH docs AS (
  SELECT order_id, string_agg('{{"product_id":' || product_id || ',"name":"' || name || '","price":'
           || CAST(price AS VARCHAR) || ',"quantity":' || CAST(quantity AS VARCHAR) || '}}',
           ',' ORDER BY product_id, name, price, quantity) AS items
  FROM ({ITEMS}) GROUP BY order_id)
SELECT '{{"order_id":' || o_orderkey || ',"customer_id":' || o_custkey
       || ',"date":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
       || '","total_amount":' || CAST(o_totalprice AS VARCHAR)
       || ',"payment_method":"' || o_orderpriority || '","status":"' || o_orderstatus
       || '","items":[' || COALESCE(items, '') || ']}}' AS json
FROM orders LEFT JOIN docs ON order_id = o_orderkey""",
    "order_documents": f"""
WITH docs AS (
  SELECT order_id, string_agg('{{"product_id":' || product_id || ',"name":"' || name || '","price":'
           || CAST(price AS VARCHAR) || ',"quantity":' || CAST(quantity AS VARCHAR) || '}}',
           ',' ORDER BY product_id, name, price, quantity) AS items,
         {money("price * quantity")} AS items_total
  FROM ({ITEMS}) GROUP BY order_id)
SELECT o_orderkey AS order_id, CAST(0 AS BIGINT) AS part, o_custkey AS customer_id, o_orderdate AS date,
       o_totalprice AS total_amount, o_orderpriority AS payment_method, o_orderstatus AS status,
       '[' || COALESCE(items, '') || ']' AS items, COALESCE(items_total, 0) AS items_total
FROM orders LEFT JOIN docs ON order_id = o_orderkey""",
    "exploded_items": DELIVERED_ITEMS,
    "order_item_totals": f"""
SELECT o_orderkey AS order_id, COUNT(i.order_id) AS n_items,
       COALESCE({money("price * quantity")}, 0) AS items_total
FROM orders LEFT JOIN ({ITEMS}) i ON i.order_id = o_orderkey GROUP BY 1""",
    "order_item_preview": f"""
SELECT order_id, CAST(position AS INTEGER) AS position, substr(COALESCE(name, 'Inconnu'), 1, 30) AS name,
       quantity, price
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY product_id, name, price, quantity) AS position
      FROM ({ITEMS}) WHERE order_id IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 3))
WHERE position <= 2""",
    "training_rows": TRAINING,
    "training_features": f"""
SELECT total_amount, {FEATURES.format(d="date")} FROM ({TRAINING})""",
    "training_features_daily": f"""
SELECT total_amount, {FEATURES.format(d="day_date")}
FROM (SELECT CAST(date AS DATE) AS day_date, {money("total_amount")} AS total_amount FROM ({TRAINING}) GROUP BY 1)""",
    "future_calendar": f"""
SELECT 'PRED-' || strftime(d, '%Y%m%d') AS prediction_id, d AS predicted_date, {FEATURES.format(d="d")},
       {WEEKDAY_CASE.format(d="d")} AS weekday_name
FROM (SELECT CAST(MAX(o_orderdate) AS DATE) + CAST(range AS INTEGER) AS d FROM orders, range(1, 8) GROUP BY range)""",
}

# A stored forecast: the mean amount of each weekday over the future calendar.
STORED = f"""
SELECT prediction_id, predicted_date, predicted_sales, day, month, weekday_name AS weekday, 'weekday_mean' AS model
FROM ({ORACLE["future_calendar"]}) LEFT JOIN (
  SELECT weekday, round({mean("total_amount")}, 2) AS predicted_sales
  FROM ({ORACLE["training_features"]}) GROUP BY weekday) USING (weekday)"""

FORECAST_SUMMARY = f"""
SELECT model, COUNT(*) AS n_days, {money("predicted_sales")} AS total_predicted, {mean("predicted_sales")} AS avg_predicted
FROM ({STORED}) GROUP BY model"""

ORACLE |= {
    "store_export": ORACLE["scan_orders"],
    "store_export_items": ORACLE["exploded_items"],
    "export_marks": """
SELECT mark, n_lines FROM (
  SELECT '$date' AS mark, COUNT(o_orderdate) AS n_lines FROM orders
  UNION ALL SELECT '$numberLong', COUNT(*) FILTER (o_orderkey IS NOT NULL OR o_custkey IS NOT NULL OR o_orderdate IS NOT NULL) FROM orders
  UNION ALL SELECT '$numberDouble', COUNT(o_totalprice) FROM orders) WHERE n_lines > 0""",
    "statuses_by_count": ORACLE["status_counts"],
    "weekday_forecast": STORED,
    "next_predictions": f"""
SELECT prediction_id, predicted_date, predicted_sales FROM ({STORED}) ORDER BY predicted_date, prediction_id LIMIT 5""",
    "forecast_summary": FORECAST_SUMMARY,
    "forecast_trend": f"""
SELECT model, avg_predicted, historical_avg, abs((avg_predicted - historical_avg) / historical_avg * 100) AS diff_pct,
       CASE WHEN (avg_predicted - historical_avg) / historical_avg * 100 > 0 THEN 'HAUSSE' ELSE 'BAISSE' END AS trend
FROM ({FORECAST_SUMMARY}), (SELECT {AVG} AS historical_avg FROM ({DELIVERED})) WHERE historical_avg > 0""",
    "forecast_vs_history": f"""
SELECT hist_avg, pred_avg, CASE WHEN hist_avg > 0 THEN abs((pred_avg - hist_avg) / hist_avg * 100) END AS diff_pct,
       CASE WHEN hist_avg > 0 THEN CASE WHEN (pred_avg - hist_avg) / hist_avg * 100 > 0 THEN '↗' ELSE '↘' END END AS direction
FROM (SELECT {wide("daily_sales")} / COUNT(daily_sales) AS hist_avg FROM ({HISTORY})),
     (SELECT {mean("predicted_sales")} AS pred_avg FROM ({STORED})) WHERE hist_avg IS NOT NULL""",
}

PARTS = ("day", "weekday", "month")
PAIRS = [(f, g) for i, f in enumerate(PARTS) for g in PARTS[i:]]


def fitted(features: str, rounds: int = 100, reg: float = 0.01, ratio: float = 0.8) -> str:
    """One row of coefficients and intercept for rows (total_amount, day, weekday, month)."""
    pair = lambda f, g: f"{f}_{g}" if (f, g) in PAIRS else f"{g}_{f}"
    y = "CAST(total_amount AS DECIMAL(18,4))"
    units = f"CAST(CAST({y} AS DECIMAL(28,4)) * 10000 AS HUGEINT)"
    sums = [f"SUM({f}) AS x_{f}, CAST(SUM({y} * {f}) AS DOUBLE) AS xy_{f}" for f in PARTS] + [f"SUM({f} * {g}) AS xx_{f}_{g}" for f, g in PAIRS]
    spread = [f"CAST(n * xx_{f}_{g} - x_{f} * x_{g} AS DOUBLE) / n / n AS c_{f}_{g}" for f, g in PAIRS]
    with_y = [f"xy_{f} / n - (x_{f} / n) * (y / n) AS c_{f}, x_{f} / n AS m_{f}" for f in PARTS]
    scaled = [f"COALESCE(c_{f} / NULLIF(sqrt(c_{f}_{f}), 0), 0) AS r_{f}, sqrt(c_{f}_{f}) AS d_{f}" for f in PARTS]
    alike = [f"COALESCE(c_{f}_{g} / NULLIF(sqrt(c_{f}_{f}) * sqrt(c_{g}_{g}), 0), 0) AS g_{f}_{g}" for f, g in PAIRS]
    step = f"SELECT * FROM descent, scaled WHERE round < {rounds}"
    l1, l2 = repr(reg * ratio), repr(reg * (1 - ratio))
    for f in PARTS:
        rest = f"r_{f}" + "".join(f" - g_{pair(f, g)} * b_{g}" for g in PARTS if g != f)
        cut = f"CASE WHEN {rest} > {l1} THEN {rest} - {l1} WHEN {rest} < -{l1} THEN {rest} + {l1} ELSE 0 END"
        step = f"SELECT * REPLACE (COALESCE(({cut}) / NULLIF(g_{f}_{f} + l2, 0), 0) AS b_{f}) FROM ({step})"
    slopes = [f"COALESCE(b_{f} / NULLIF(d_{f}, 0), 0) AS {f}" for f in PARTS]
    intercept = "m" + "".join(f" - {f} * m_{f}" for f in PARTS)
    return f"""
WITH RECURSIVE sums AS (
  SELECT COUNT(*) AS n, {money("total_amount")} AS y, CAST(SUM({units} * {units}) AS DOUBLE) / 1e8 AS yy, {", ".join(sums)} FROM ({features})),
spread AS (SELECT y / n AS m, sqrt(GREATEST(yy / n - (y / n) * (y / n), 0)) AS d, {", ".join(spread + with_y)} FROM sums),
scaled AS (SELECT m, COALESCE({l2} / NULLIF(d, 0), 0) AS l2, {", ".join(f"m_{f}" for f in PARTS)}, {", ".join(scaled + alike)} FROM spread),
descent AS (
  SELECT 0 AS round, {", ".join(f"CAST(0 AS DOUBLE) AS b_{f}" for f in PARTS)}
  UNION ALL SELECT round + 1, {", ".join(f"b_{f}" for f in PARTS)} FROM ({step})),
slopes AS (SELECT m, {", ".join(f"m_{f}" for f in PARTS)}, {", ".join(slopes)} FROM descent, scaled WHERE round = {rounds})
SELECT {", ".join(PARTS)}, {intercept} AS intercept FROM slopes"""


PREDICTED = "m.intercept" + "".join(f" + f.{p} * m.{p}" for p in PARTS)
HELD_OUT = "CAST('0x' || left(md5(CAST(order_id AS VARCHAR)), 8) AS BIGINT) % 5 = 0"


def features_of(rows: str) -> str:
    return f"SELECT total_amount, {FEATURES.format(d='date')} FROM ({TRAINING}) WHERE {rows}"


ORACLE |= {
    "model_coefficients": f"""
SELECT unnest(['day', 'weekday', 'month', 'intercept']) AS term, round(unnest([day, weekday, month, intercept]), 6) AS coefficient
FROM ({fitted(ORACLE["training_features"])})""",
    "model_evaluation": f"""
SELECT COUNT(*) AS n_rows, round(sqrt(AVG(e * e)), 3) AS rmse, round(AVG(abs(e)), 3) AS mae, round(1 - AVG(e * e) / var_pop(total_amount), 9) AS r2
FROM (SELECT total_amount, total_amount - ({PREDICTED}) AS e FROM ({features_of(HELD_OUT)}) f, ({fitted(features_of(f"NOT {HELD_OUT}"))}) m)""",
    "sales_forecast": f"""
SELECT prediction_id, predicted_date, round({PREDICTED}, 6) AS predicted_sales, f.day, f.month, weekday_name AS weekday, 'LinearRegression' AS model,
       '["day","weekday","month"]' AS features_used,
       strftime((SELECT MAX(o_orderdate) FROM orders), '%Y-%m-%dT%H:%M:%S.%f') AS created_at
FROM ({ORACLE["future_calendar"]}) f, ({fitted(ORACLE["training_features"])}) m""",
}

for _key, _test in {
    "delivered_like": "o_orderstatus LIKE '%F%'",
    "delivered_contains": "o_orderstatus = 'F' OR contains(o_orderstatus, 'F')",
    "delivered_regex": "regexp_matches(o_orderstatus, 'f', 'i')",
}.items():
    ORACLE[_key] = (
        "SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total_amount "
        f"FROM orders WHERE {_test}"
    )
