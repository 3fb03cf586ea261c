"""The same queries in ANSI SQL, for an independent engine to check against.

Money is summed as ``decimal(28,6)`` here and in whole units and millionths by the
operators, and rounded after the sum; ratios are rounded half up from their decimal text, so exact halves agree too.
"""

from __future__ import annotations

from itertools import permutations

_VIEWS = {
    "m_orders": """SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
        c.c_nationkey AS location_id, o.o_orderdate AS order_date, o.o_orderpriority AS channel,
        o.o_totalprice AS total_amount,
        CASE o.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Cancelled' ELSE 'Open' END AS status
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "m_order_items": """SELECT l_orderkey * 10 + l_linenumber AS order_line_id, l_orderkey AS order_id,
        l_partkey AS item_id, CAST(l_quantity AS INT) AS quantity,
        l_extendedprice / l_quantity AS unit_price, l_extendedprice AS line_total FROM lineitem""",
    "m_menu_items": """SELECT p_partkey AS item_id, p_name AS item_name, p_type AS category,
        p_retailprice AS cost, p_retailprice * 2 AS base_price, p_size <= 40 AS is_available FROM part""",
    "m_customers": """SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS home_location_id,
        c_mktsegment AS preferred_channel FROM customer""",
    "m_restaurants": """SELECT n_nationkey AS location_id, n_name AS location_name, r_name AS city,
        TRUE AS is_active FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "m_ratings": """SELECT event_id AS rating_id, event_id % (SELECT MAX(o_orderkey) + 1 FROM orders) AS order_id, user_id AS customer_id,
        event_id % (SELECT MAX(p_partkey) + 1 FROM part) AS item_id, 1 + CAST(LEAST(4, FLOOR(value / 25)) AS INT) AS rating,
        ts AS rating_date FROM events""",
    "m_event_orders": """SELECT event_id AS order_id, user_id AS customer_id, ts AS order_date,
        event_type AS channel, value AS total_amount, 'Completed' AS status FROM events""",
    "m_wastage": """SELECT l_orderkey * 10 + l_linenumber AS wastage_id, l_partkey AS item_id,
        s_nationkey AS location_id, CAST(l_quantity AS INT) AS quantity, l_extendedprice AS cost,
        CAST(l_shipdate AS DATE) AS wastage_date,
        CASE l_orderkey % 5 WHEN 0 THEN 'Expired' WHEN 1 THEN 'Overproduction' WHEN 2 THEN 'Damaged'
        WHEN 3 THEN 'Customer Return' ELSE 'Prep Error' END AS reason
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R'""",
    "m_pricing_history": """SELECT l_orderkey * 10 + l_linenumber AS price_id, l_partkey AS item_id,
        p_retailprice AS old_price, l_extendedprice / l_quantity AS new_price,
        CAST(l_shipdate AS DATE) AS change_date FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag = 'N'""",
    "m_promotions": """SELECT l_orderkey * 10 + l_linenumber AS promo_id, l_partkey AS item_id,
        CAST(ROUND(l_discount * 100) AS INT) AS discount_pct, CAST(l_shipdate AS DATE) AS start_date,
        CAST(CAST(l_shipdate AS DATE) + INTERVAL '60' DAY AS DATE) AS end_date FROM lineitem
        WHERE l_discount >= 0.10""",
    "m_inventory": """SELECT s_nationkey AS location_id, l_partkey AS item_id,
        3 * CAST(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS BIGINT) AS stock_qty,
        MAX(p_size) + 20 AS reorder_level FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN part ON l_partkey = p_partkey GROUP BY s_nationkey, l_partkey""",
}

_COLUMNS = {
    "orders": (
        "m_orders",
        "order_id customer_id location_id order_date channel total_amount status",
    ),
    "order_items": (
        "m_order_items",
        "order_line_id order_id item_id quantity unit_price line_total",
    ),
    "menu_items": ("m_menu_items", "item_id item_name category cost base_price is_available"),
    "customers": ("m_customers", "customer_id name home_location_id preferred_channel"),
    "ratings": ("m_ratings", "rating_id order_id customer_id item_id rating rating_date"),
    "wastage": ("m_wastage", "wastage_id item_id quantity cost wastage_date reason location_id"),
}

_DONE = "status = 'Completed'"
_PAID = "status = 'Completed' AND total_amount > 0"


def _r(x: str, digits: int = 2) -> str:
    """Round the shortest text of a double half up, as Spark rounds doubles."""
    text = f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"
    return f"CAST(ROUND(CAST({text} AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def _money(x: str) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(28,6))), 2) AS DOUBLE)"


def _money_avg(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE) / COUNT({x}))"


def _six_avg(x: str) -> str:
    """Average rounded to six digits."""
    return f"ROUND(AVG({x}), 6)"


def _int_sum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def _pct(part: str, whole: str) -> str:
    return _r(f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 100")


def _quadrant(qty_test: str, margin_test: str) -> str:
    return (
        f"CASE WHEN {qty_test} AND {margin_test} THEN 'Profit Driver' "
        f"WHEN {qty_test} AND NOT ({margin_test}) THEN 'Volume Driver' "
        f"WHEN NOT ({qty_test}) AND {margin_test} THEN 'Hidden Opportunity' "
        "ELSE 'Low Performer' END"
    )


def _margin_columns(revenue: str, cost: str) -> str:
    """total_cost, profit and profit_pct from decimal revenue and cost."""
    pct = _r(f"CAST({revenue} - {cost} AS DOUBLE) / CAST({revenue} AS DOUBLE) * 100")
    return (
        f"CAST({cost} AS DOUBLE) AS total_cost, CAST({revenue} - {cost} AS DOUBLE) AS profit, "
        f"CASE WHEN {revenue} > 0 THEN {pct} ELSE 0.0 END AS profit_pct"
    )


def _recommended(rows: str) -> str:
    """Advice over ``rows``: classified items with their wastage_pct."""
    return f"""SELECT *, CASE
          WHEN performance_class = 'Hidden Opportunity' AND profit_pct > 60
            THEN 'PROMOTE - High margin, low visibility'
          WHEN performance_class = 'Low Performer' AND wastage_pct > 15
            THEN 'REVIEW - Low performer with high wastage'
          WHEN performance_class = 'Low Performer' AND profit_pct < 30
            THEN 'REMOVE or REDESIGN - Low margin'
          WHEN performance_class = 'Volume Driver' AND profit_pct < 40
            THEN 'REPRICE - High volume, low margin'
          WHEN performance_class = 'Profit Driver' THEN 'MAINTAIN - Strong performer'
          ELSE 'MONITOR' END AS recommendation,
        CASE WHEN profit_pct > 65 THEN 'Critical' WHEN profit_pct > 55 THEN 'High'
          WHEN profit_pct > 45 THEN 'Medium' ELSE 'Low' END AS priority,
        'Margin: ' || CAST(profit_pct AS VARCHAR) || '% | Sold: ' || CAST(qty_sold AS VARCHAR)
          || ' | Wastage: ' || CAST(wastage_pct AS VARCHAR) || '%' AS evidence
        FROM ({rows})"""


#: Names and strategies of segments by rank (fixed values).
_SEGMENTS = """['High-Value Loyal', 'Frequent', 'Promotion-Driven', 'Occasional', 'At-Risk']"""
_STRATEGIES = """['VIP Program - Exclusive offers', 'Loyalty Rewards - Frequent buyers',
    'Promotional Campaigns - Discount sensitive', 'Reactivation - Send special offers',
    'Re-engagement - Reminder emails']"""


def _orthogonal(names: list[str]) -> dict[str, str]:
    """Steps that make the features orthogonal one after another and add up the fit."""
    centred = ", ".join(f"{x} - AVG({x}) OVER () AS {x}" for x in names)
    steps = {
        "fit_0": f"""SELECT order_date, demand, {centred}, demand - AVG(demand) OVER () AS y,
            AVG(demand) OVER () AS fit FROM features"""
    }
    for k, x in enumerate(names):
        square = f"SUM({x} * {x}) OVER ()"
        rest = "".join(f", {z} - SUM({z} * {x}) OVER () / {square} * {x} AS {z}" for z in names[k + 1 :])
        steps[f"fit_{k + 1}"] = f"""SELECT order_date, demand, y{rest},
            fit + SUM(y * {x}) OVER () / {square} * {x} AS fit FROM fit_{k}"""
    return steps


def _best_match() -> str:
    """The most customers that a one-to-one match of the labels of ``match_cells`` agrees on."""
    sums = []
    for order in permutations("xyz"):
        pairs = " OR ".join(f"(l = '{a}' AND r = '{b}')" for a, b in zip(("rich", "middle", "modest"), order))
        sums.append(f"COALESCE(SUM(n) FILTER (WHERE {pairs}), 0)")
    return f"GREATEST({', '.join(sums)})"


_STEPS = {
    "profitability": f"""SELECT item_id, item_name, category, cost, base_price, qty_sold,
        CAST(rev AS DOUBLE) AS revenue, order_count, {_margin_columns("rev", "spent")}
        FROM (SELECT *, ROUND(qty_sold * CAST(cost AS DECIMAL(18,2)), 2) AS spent FROM (
          SELECT m.item_id, m.item_name, m.category, m.cost, m.base_price,
            {_int_sum("i.quantity")} AS qty_sold, ROUND(SUM(CAST(i.line_total AS DECIMAL(28,6))), 2) AS rev,
            COUNT(i.order_id) AS order_count
          FROM m_order_items i JOIN m_orders o ON i.order_id = o.order_id
          JOIN m_menu_items m ON i.item_id = m.item_id
          WHERE i.quantity > 0 AND {_PAID} GROUP BY ALL))""",
    "classified": "SELECT *, "
    + _quadrant(
        "qty_sold >= AVG(qty_sold) OVER ()",
        "CAST(profit_pct AS DECIMAL(18,2)) * COUNT(*) OVER () >= "
        "SUM(CAST(profit_pct AS DECIMAL(18,2))) OVER ()",
    )
    + " AS performance_class FROM profitability",
    "comparison": f"""SELECT location_id, revenue, total_orders, avg_order_value, unique_customers,
        COALESCE(gross_revenue, 0) AS gross_revenue, COALESCE(total_cost, 0) AS total_cost,
        COALESCE(profit, 0) AS profit, COALESCE(total_wasted_qty, 0) AS total_wasted_qty,
        COALESCE(wastage_cost, 0) AS wastage_cost,
        {_pct("COALESCE(profit, 0)", "revenue")} AS profit_margin_pct
        FROM (SELECT location_id, {_money("total_amount")} AS revenue, COUNT(order_id) AS total_orders,
            {_money_avg("total_amount")} AS avg_order_value,
            COUNT(DISTINCT customer_id) AS unique_customers
          FROM m_orders WHERE {_DONE} GROUP BY location_id)
        LEFT JOIN (SELECT location_id AS of_lines, CAST(rev AS DOUBLE) AS gross_revenue,
            CAST(spent AS DOUBLE) AS total_cost, CAST(rev - spent AS DOUBLE) AS profit
          FROM (SELECT o.location_id, ROUND(SUM(CAST(i.line_total AS DECIMAL(28,6))), 2) AS rev,
              ROUND(SUM(CAST(i.quantity * m.cost AS DECIMAL(28,6))), 2) AS spent
            FROM m_order_items i JOIN m_orders o ON i.order_id = o.order_id
            JOIN m_menu_items m ON i.item_id = m.item_id WHERE {_DONE} GROUP BY o.location_id))
          ON location_id IS NOT DISTINCT FROM of_lines
        LEFT JOIN (SELECT location_id AS of_waste, {_int_sum("quantity")} AS total_wasted_qty,
            {_money("cost")} AS wastage_cost FROM m_wastage GROUP BY location_id)
          ON location_id IS NOT DISTINCT FROM of_waste""",
    "wasted": f"""SELECT m.*, COALESCE(total_wasted_qty, 0) AS total_wasted_qty,
        COALESCE(total_wastage_cost, 0) AS total_wastage_cost, COALESCE(total_sold, 0) AS total_sold,
        {_pct("COALESCE(total_wasted_qty, 0)",
              "COALESCE(total_sold, 0) + COALESCE(total_wasted_qty, 0) + 1")} AS wastage_pct
        FROM m_menu_items m
        LEFT JOIN (SELECT item_id, {_int_sum("quantity")} AS total_wasted_qty,
            {_money("cost")} AS total_wastage_cost FROM m_wastage GROUP BY item_id) USING (item_id)
        LEFT JOIN (SELECT item_id, {_int_sum("quantity")} AS total_sold
          FROM m_order_items JOIN m_orders USING (order_id) WHERE {_DONE} GROUP BY item_id)
          USING (item_id)""",
    "risk": f"""SELECT *, CASE WHEN waste_ratio > 15 THEN 'High' WHEN waste_ratio > 8 THEN 'Medium'
        ELSE 'Low' END AS risk_level
        FROM (SELECT item_id, total_wasted, COALESCE(total_sold, 0) AS total_sold,
            {_pct("total_wasted", "total_wasted + COALESCE(total_sold, 0) + 1")} AS waste_ratio
          FROM (SELECT item_id, {_int_sum("quantity")} AS total_wasted FROM m_wastage GROUP BY item_id)
          LEFT JOIN (SELECT item_id, {_int_sum("quantity")} AS total_sold FROM m_order_items
            WHERE quantity > 0 GROUP BY item_id) USING (item_id))""",
    "promo_lines": f"""SELECT i.item_id, {_int_sum("i.quantity")} AS qty_sold,
        {_money("i.line_total")} AS revenue,
        CAST(SUM(CAST(i.line_total AS DECIMAL(18,2)) - CAST(i.quantity * m.cost AS DECIMAL(18,2)))
          AS DOUBLE) AS total_profit
        FROM m_order_items i JOIN m_orders o ON i.order_id = o.order_id
        JOIN m_menu_items m ON i.item_id = m.item_id WHERE {_DONE} GROUP BY i.item_id""",
    "sensitivity": f"""SELECT *, CASE WHEN price_variation_pct > 10 THEN 'Highly Price Sensitive'
        WHEN price_variation_pct > 5 THEN 'Moderately Price Sensitive'
        ELSE 'Low Price Sensitivity' END AS sensitivity_class
        FROM (SELECT *, CASE WHEN avg_price > 0
            THEN (avg_selling_price - avg_price) / avg_price * 100 ELSE 0.0 END AS price_variation_pct
          FROM (SELECT item_id, qty_sold, avg_selling_price, COALESCE(avg_price, 0) AS avg_price,
              COALESCE(num_price_changes, 0) AS num_price_changes
            FROM (SELECT item_id, {_int_sum("quantity")} AS qty_sold,
                {_six_avg("unit_price")} AS avg_selling_price FROM m_order_items GROUP BY item_id)
            LEFT JOIN (SELECT item_id, {_six_avg("new_price")} AS avg_price,
                COUNT(price_id) AS num_price_changes FROM m_pricing_history GROUP BY item_id)
              USING (item_id)))""",
    "rfm_all": f"""SELECT customer_id,
        CAST(date_diff('day', MAX(CAST(order_date AS DATE)), (SELECT MAX(CAST(order_date AS DATE))
          FROM m_orders WHERE {_DONE})) AS INT) AS recency,
        COUNT(*) AS frequency, {_money("total_amount")} AS monetary
        FROM m_orders WHERE {_DONE} GROUP BY customer_id""",
    "churn": f"""SELECT *, CASE WHEN recency > 180 THEN 'High Risk' WHEN recency > 90 THEN 'Medium Risk'
        WHEN recency > 60 THEN 'Low Risk' ELSE 'Active' END AS churn_risk
        FROM (SELECT customer_id, MAX(CAST(order_date AS DATE)) AS last_order,
            COUNT(order_id) AS frequency, {_money("total_amount")} AS monetary,
            CAST(date_diff('day', MAX(CAST(order_date AS DATE)), (SELECT MAX(CAST(order_date AS DATE))
              FROM m_orders WHERE {_PAID})) AS INT) AS recency
          FROM m_orders WHERE {_PAID} GROUP BY customer_id)""",
    "diversity": f"""SELECT o.customer_id, COUNT(DISTINCT m.category) AS category_diversity
        FROM m_order_items i JOIN m_orders o ON i.order_id = o.order_id
        JOIN m_menu_items m ON i.item_id = m.item_id
        WHERE i.quantity > 0 AND {_PAID} GROUP BY o.customer_id""",
    "weekend_share": f"""SELECT item_id,
        {_r("AVG(CASE WHEN dayofweek(order_date) IN (0, 6) THEN 1 ELSE 0 END) * 100")}
          AS weekend_ratio_pct
        FROM m_order_items JOIN m_orders USING (order_id)
        WHERE quantity > 0 AND {_PAID} GROUP BY item_id""",
    "rated": """SELECT item_id, AVG(rating) AS avg_rating, COUNT(rating) AS total_ratings
        FROM m_ratings GROUP BY item_id HAVING COUNT(rating) > 2""",
    "sold": f"""SELECT item_id, {_int_sum("quantity")} AS total_qty, COUNT(order_id) AS order_count
        FROM m_order_items WHERE quantity > 0 GROUP BY item_id""",
    "recommended": _recommended("""SELECT c.*, COALESCE(r.waste_ratio, CAST(0 AS DOUBLE)) AS wastage_pct
          FROM classified c LEFT JOIN risk r ON c.item_id = r.item_id"""),
    "daily_sales": f"""SELECT CAST(order_date AS DATE) AS order_date,
        {_money("total_amount")} AS daily_revenue, COUNT(order_id) AS order_count
        FROM m_orders GROUP BY 1""",
    "anomaly": f"""SELECT * FROM (SELECT *, {_r(
        "ABS(daily_revenue - AVG(daily_revenue) OVER ()) / "
        "NULLIF(STDDEV_SAMP(daily_revenue) OVER (), 0)", 6)} AS z_score
        FROM daily_sales) WHERE z_score > 2.5""",
    "daily": f"""SELECT CAST(order_date AS DATE) AS order_date, {_int_sum("quantity")} AS demand
        FROM m_order_items JOIN m_orders USING (order_id) WHERE {_DONE} GROUP BY 1""",
    "lagged": """SELECT * FROM (SELECT order_date, demand,
          LAG(demand, 1) OVER (ORDER BY order_date) AS lag_1,
          LAG(demand, 7) OVER (ORDER BY order_date) AS lag_7 FROM daily)
        WHERE lag_1 IS NOT NULL AND lag_7 IS NOT NULL""",
    "features": """SELECT order_date, demand, CAST(dayofweek(order_date) + 1 AS INT) AS dayofweek,
        CAST(month(order_date) AS INT) AS month, CAST(dayofyear(order_date) AS INT) AS dayofyear,
        lag_1, lag_7 FROM lagged""",
    "rule_clusters": "SELECT *, CAST(LEAST(frequency, 5) - 1 AS INT) AS prediction FROM rfm_all",
    "rule_ranks": """SELECT prediction, CAST(ROW_NUMBER() OVER (ORDER BY AVG(CAST(monetary AS DECIMAL(18,2)))
          DESC, prediction) AS INT) AS segment_rank FROM rule_clusters GROUP BY prediction""",
    "rule_named": f"""SELECT c.*, segment_rank, {_SEGMENTS}[segment_rank] AS segment
        FROM rule_clusters c JOIN rule_ranks r ON c.prediction = r.prediction""",
    "sil_points": "SELECT ROW_NUMBER() OVER () AS i, prediction AS c, "
    + ", ".join(
        f"({m} - AVG({m}) OVER ()) / STDDEV_SAMP({m}) OVER () AS z{k}"
        for k, m in enumerate(("recency", "frequency", "monetary"))
    )
    + " FROM rule_clusters",
    "sil_clusters": """SELECT c, COUNT(*) AS n, SUM(z0 * z0 + z1 * z1 + z2 * z2) AS s, SUM(z0) AS a,
        SUM(z1) AS b, SUM(z2) AS d FROM sil_points GROUP BY c""",
    "sil_rows": """SELECT i, MAX(CASE WHEN c = other THEN dist * n / (n - 1) END) AS inside,
          MIN(CASE WHEN c <> other THEN dist END) AS outside
        FROM (SELECT p.i, p.c, m.c AS other, m.n, z0 * z0 + z1 * z1 + z2 * z2 + s / n
            - 2 * (z0 * a + z1 * b + z2 * d) / n AS dist FROM sil_points p CROSS JOIN sil_clusters m)
        GROUP BY i""",
    "match_cells": """SELECT l, r, COUNT(*) AS n FROM (SELECT
          CASE WHEN monetary > 900000 THEN 'rich' WHEN monetary > 400000 THEN 'middle' ELSE 'modest' END AS l,
          CASE WHEN frequency > 4 THEN 'x' WHEN frequency > 2 THEN 'y' ELSE 'z' END AS r
          FROM rfm_all) GROUP BY l, r""",
    "match_sums": """SELECT SUM(n) AS total, SUM(n * (n - 1) / 2) AS together,
        (SELECT SUM(n * (n - 1) / 2) FROM (SELECT SUM(n) AS n FROM match_cells GROUP BY l)) AS in_l,
        (SELECT SUM(n * (n - 1) / 2) FROM (SELECT SUM(n) AS n FROM match_cells GROUP BY r)) AS in_r
        FROM match_cells""",
    "guesses": """SELECT 'yesterday' AS model, demand, lag_1 AS p FROM lagged
        UNION ALL SELECT 'last week', demand, lag_7 FROM lagged""",
    "said": """SELECT 'margin' AS model, performance_class AS label, CASE WHEN profit_pct >= 50
          THEN 'Profit Driver' ELSE 'Low Performer' END AS prediction FROM classified
        UNION ALL SELECT 'volume', performance_class, CASE WHEN qty_sold >= 240
          THEN 'Volume Driver' ELSE 'Hidden Opportunity' END FROM classified""",
    "said_classes": """SELECT model, label AS cls, COUNT(*) AS truly,
          CAST(COUNT(*) FILTER (WHERE label = prediction) AS DOUBLE) AS hits,
          (SELECT COUNT(*) FROM said s WHERE s.model = said.model AND s.prediction = said.label) AS said
        FROM said GROUP BY model, label""",
    "said_scores": """SELECT *, hits / truly AS recall, CASE WHEN said > 0 THEN hits / said ELSE 0 END AS precision
        FROM said_classes""",
    **_orthogonal(["dayofweek", "month", "dayofyear", "lag_1", "lag_7"]),
    # Baskets of categories as bit masks; one row per mask.
    "cats": """SELECT category, CAST(1 AS BIGINT) << CAST(ROW_NUMBER() OVER (ORDER BY category) - 1
        AS INT) AS bit FROM (SELECT DISTINCT category FROM m_menu_items)""",
    "masks": """SELECT mask, COUNT(*) AS n FROM (SELECT order_id, bit_or(bit) AS mask
          FROM m_order_items i JOIN m_menu_items m ON i.item_id = m.item_id
          JOIN cats ON cats.category = m.category WHERE i.quantity > 0 GROUP BY order_id)
        WHERE bit_count(mask) >= 2 GROUP BY mask""",
    "itemsets": """SELECT s.mask, CAST(SUM(n) AS BIGINT) AS freq
        FROM (SELECT range AS mask FROM range(1, CAST((SELECT SUM(bit) + 1 FROM cats) AS BIGINT))) s
        JOIN masks ON masks.mask & s.mask = s.mask GROUP BY s.mask
        HAVING SUM(n) >= CEIL(0.01 * (SELECT SUM(n) FROM masks))""",
    "named": """SELECT mask, freq, (SELECT string_agg(category, ',' ORDER BY category) FROM cats
        WHERE bit & mask <> 0) AS items FROM itemsets""",
    "rules": f"""SELECT a.items AS antecedent, c.items AS consequent,
        {_r("u.freq / total", 6)} AS support,
        {_r("CAST(u.freq AS DOUBLE) / a.freq", 6)} AS confidence,
        {_r("CAST(u.freq AS DOUBLE) / a.freq / (c.freq / total)", 6)} AS lift
        FROM itemsets u JOIN named c ON bit_count(c.mask) = 1 AND u.mask & c.mask <> 0
        JOIN named a ON a.mask = u.mask - c.mask,
        (SELECT CAST(SUM(n) AS DOUBLE) AS total FROM masks)
        WHERE CAST(u.freq AS DOUBLE) / a.freq >= 0.3""",
}


def _with(body: str) -> str:
    """Prefix the views and steps that ``body`` refers to, in dependency order."""
    defined = {**_VIEWS, **_STEPS}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, sql in defined.items():
            if name not in needed and _mentions(text, name):
                visit(sql)
                needed.append(name)

    visit(body)
    if not needed:
        return body
    clauses = ",\n".join(f"{name} AS ({defined[name]})" for name in dict.fromkeys(needed))
    return f"WITH {clauses}\n{body}"


def _mentions(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split()
    return any(
        word == name and before.upper() in ("FROM", "JOIN", "IN")
        for before, word in zip(words, words[1:])
    )


def _null_profile() -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", "
        f"COUNT(*) FILTER (WHERE {column} IS NULL) AS nulls, "
        f"COALESCE({_pct(f'COUNT(*) FILTER (WHERE {column} IS NULL)', 'COUNT(*)')}, 0) AS pct "
        f"FROM {view}"
        for table, (view, columns) in _COLUMNS.items()
        for column in columns.split()
    )


def _duplicates(view: str, key: str) -> str:
    return f"(SELECT COUNT(*) FROM (SELECT {key} FROM {view} GROUP BY {key} HAVING COUNT(*) > 1))"


def _missing(table: str) -> str:
    view, columns = _COLUMNS[table]
    cells = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in columns.split())
    return f"(SELECT {cells} FROM {view})"


def _count(view: str, test: str) -> str:
    return f"(SELECT COUNT(*) FROM {view} WHERE {test})"


def _quality_report() -> str:
    checks = {
        "missing_orders": _missing("orders"),
        "missing_items": _missing("order_items"),
        "missing_menu": _missing("menu_items"),
        "missing_customers": _missing("customers"),
        "duplicate_orders": _duplicates("m_orders", "order_id"),
        "duplicate_order_lines": _duplicates("m_order_items", "order_line_id"),
        "invalid_menu_prices": _count("m_menu_items", "base_price <= 0 OR cost <= 0"),
        "negative_quantities": _count("m_order_items", "quantity < 0"),
        "invalid_dates": _count("m_orders", "order_date IS NULL"),
        "invalid_ratings": _count("m_ratings", "rating < 1 OR rating > 5"),
        "missing_customer_ids": _count("m_orders", "customer_id IS NULL"),
        "missing_menu_ids": _count("m_order_items", "item_id IS NULL"),
        "invalid_location_refs": _count(
            "m_orders", "location_id NOT IN (SELECT location_id FROM m_restaurants)"
        ),
        "impossible_wastage": _count("m_wastage", "quantity > 1000"),
        "cancelled_transactions": _count("m_orders", "status = 'Cancelled'"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", CAST({sql} AS BIGINT) AS violations"
        for name, sql in checks.items()
    )


_FIRST_COPY = """(SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_date NULLS FIRST,
    customer_id NULLS FIRST, channel NULLS FIRST, total_amount NULLS FIRST, status NULLS FIRST) AS copy
    FROM m_orders)"""

_PERIOD = f"{_money('total_amount')} AS revenue FROM m_orders WHERE {_PAID} GROUP BY"
_SEASON = """CASE WHEN month(order_date) IN (12, 1, 2) THEN 'Winter'
    WHEN month(order_date) IN (3, 4, 5) THEN 'Spring'
    WHEN month(order_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"""
_TOP_PROFIT = (
    "SELECT item_id, item_name, qty_sold, revenue, profit, profit_pct, performance_class "
    "FROM classified {where} ORDER BY profit DESC, item_id LIMIT 10"
)
_LOCATION_COLUMNS = "location_id, revenue, total_orders, avg_order_value, profit_margin_pct"
_WASTE_SUMS = f"{_int_sum('quantity')} AS total_qty, {_money('cost')} AS total_cost FROM m_wastage"
_IN_FILTER = "order_date >= DATE '1996-01-01' AND order_date < DATE '1999-01-01'"


def _channel_detailed(count: str) -> str:
    return f"""SELECT channel, {_int_sum("quantity")} AS total_qty, {count} AS total_orders,
        {_r(_money_avg("line_total"))} AS avg_line_value, COUNT(DISTINCT item_id) AS unique_items,
        {_r(f"SUM(quantity) / CAST({count} AS DOUBLE)")} AS avg_basket_size
        FROM m_order_items JOIN m_orders USING (order_id) WHERE quantity > 0 AND {_PAID}
        GROUP BY channel"""


def _repeat(count: str) -> str:
    return f"""SELECT item_id, {_r("AVG(CASE WHEN n > 1 THEN 1 ELSE 0 END) * 100")}
        AS repeat_purchase_rate FROM (SELECT item_id, customer_id, {count} AS n
        FROM m_order_items i JOIN m_orders o ON i.order_id = o.order_id
        WHERE quantity > 0 AND {_PAID} GROUP BY item_id, customer_id) GROUP BY item_id"""


def _tricky(rating: str) -> str:
    cases = {
        "high_selling_loss_making": "qty_sold > 300 AND profit_pct < 40",
        "low_selling_high_margin": "qty_sold < 180 AND profit_pct > 60",
        "highly_rated_low_profit": f"{rating} >= 2.6 AND profit_pct < 40",
        "low_rated_high_sales": f"{rating} < 2.0 AND qty_sold > 300",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"case\", COUNT(*) FILTER (WHERE {test}) AS n FROM classified "
        "LEFT JOIN (SELECT item_id, AVG(rating) AS avg_rating FROM m_ratings GROUP BY item_id) "
        "USING (item_id)"
        for name, test in cases.items()
    )


def _kpi(name: str, value: str, source: str) -> str:
    return f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value FROM {source}"


_BODIES = {
    "null_profile": _null_profile(),
    "duplicate_keys": " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", {_duplicates(view, key)} AS duplicates"
        for table, view, key in (
            ("orders", "m_orders", "order_id"),
            ("customers", "m_customers", "customer_id"),
            ("menu_items", "m_menu_items", "item_id"),
            ("order_items", "m_order_items", "order_line_id"),
        )
    ),
    "quality_report": _quality_report(),
    "clean_orders": f"""SELECT order_id, customer_id, location_id, order_date, channel, total_amount,
        status FROM {_FIRST_COPY} WHERE copy = 1 AND {_PAID}""",
    "cleaning_log": f"""SELECT 'duplicates' AS step, COUNT(*) FILTER (WHERE copy > 1) AS removed
        FROM {_FIRST_COPY} UNION ALL
        SELECT 'cancelled', COUNT(*) FROM {_FIRST_COPY}
        WHERE copy = 1 AND status IS DISTINCT FROM 'Completed' UNION ALL
        SELECT 'invalid amounts', COUNT(*) FROM {_FIRST_COPY}
        WHERE copy = 1 AND {_DONE} AND NOT COALESCE(total_amount > 0, FALSE)""",
    "menu_profitability": "SELECT * FROM profitability",
    "menu_classified": "SELECT * FROM classified",
    "class_summary": "SELECT performance_class, COUNT(*) AS items FROM classified GROUP BY 1",
    "top_profit_items": _TOP_PROFIT.format(where=""),
    "top_profit_filtered": _TOP_PROFIT.format(
        where="WHERE performance_class IN ('Profit Driver', 'Hidden Opportunity') "
        "AND category IN ('ECONOMY', 'SMALL')"
    ),
    "promote_candidates": """SELECT item_id, item_name, profit_pct FROM classified
        WHERE performance_class = 'Hidden Opportunity' ORDER BY profit_pct DESC, item_id LIMIT 5""",
    "top_sellers": "SELECT item_id, total_qty AS qty FROM sold ORDER BY qty DESC, item_id LIMIT 10",
    "low_sellers": "SELECT item_id, total_qty AS qty FROM sold ORDER BY qty, item_id LIMIT 10",
    "slow_moving_threshold": """SELECT item_id, total_qty, order_count, item_name, category
        FROM sold JOIN m_menu_items USING (item_id)
        WHERE total_qty < 0.7 * (SELECT AVG(total_qty) FROM sold)""",
    "slow_moving_bottom_k": """SELECT item_id, total_qty, order_count, item_name, category
        FROM (SELECT * FROM sold ORDER BY total_qty, item_id LIMIT 20)
        JOIN m_menu_items USING (item_id)""",
    "inventory_recommendations": """SELECT *, CASE WHEN avg_stock < avg_reorder THEN 'REORDER NOW'
        WHEN avg_stock < avg_reorder * 1.5 THEN 'MONITOR' ELSE 'SUFFICIENT' END AS recommendation
        FROM (SELECT item_id, AVG(stock_qty) AS avg_stock, AVG(reorder_level) AS avg_reorder
          FROM m_inventory GROUP BY item_id)""",
    "price_what_if": """SELECT item_id, item_name, base_price,
        base_price * CAST(1.1 AS DOUBLE) AS new_price, qty_sold FROM classified""",
    "location_menu": f"""SELECT location_id, item_id, {_int_sum("quantity")} AS qty_sold
        FROM m_order_items JOIN m_orders USING (order_id) WHERE quantity > 0 AND {_PAID}
        GROUP BY location_id, item_id""",
    "location_menu_classified": f"""SELECT location_id, item_id, qty_sold, revenue, total_cost, profit,
        profit_pct, avg_qty, avg_profit, {_quadrant(
            "qty_sold >= avg_qty", "CAST(profit_pct AS DECIMAL(18,2)) * items >= margins")} AS loc_class
        FROM (SELECT *, AVG(qty_sold) OVER (PARTITION BY location_id) AS avg_qty,
            CAST(SUM(CAST(profit_pct AS DECIMAL(28,6))) OVER (PARTITION BY location_id) AS DOUBLE)
              / COUNT(*) OVER (PARTITION BY location_id) AS avg_profit,
            COUNT(*) OVER (PARTITION BY location_id) AS items,
            SUM(CAST(profit_pct AS DECIMAL(18,2))) OVER (PARTITION BY location_id) AS margins
          FROM (SELECT location_id, item_id, qty_sold, CAST(rev AS DOUBLE) AS revenue,
              {_margin_columns("rev", "spent")}
            FROM (SELECT o.location_id, i.item_id, {_int_sum("i.quantity")} AS qty_sold,
                ROUND(SUM(CAST(i.line_total AS DECIMAL(28,6))), 2) AS rev,
                ROUND(SUM(CAST(i.quantity * m.cost AS DECIMAL(28,6))), 2) AS spent
              FROM m_order_items i JOIN m_orders o ON i.order_id = o.order_id
              JOIN m_menu_items m ON i.item_id = m.item_id
              WHERE i.quantity > 0 AND {_PAID} GROUP BY o.location_id, i.item_id)))""",
    "location_comparison": "SELECT * FROM comparison",
    "top_locations": f"""SELECT {_LOCATION_COLUMNS} FROM comparison
        ORDER BY revenue DESC, location_id LIMIT 10""",
    "worst_locations": f"""SELECT {_LOCATION_COLUMNS} FROM comparison
        ORDER BY profit_margin_pct, location_id LIMIT 5""",
    "channel_analysis": f"""SELECT channel, COUNT(order_id) AS total_orders,
        {_money("total_amount")} AS revenue, {_r(_money_avg("total_amount"))} AS avg_order_value,
        COUNT(DISTINCT customer_id) AS unique_customers FROM m_orders WHERE {_PAID}
        GROUP BY channel""",
    "channel_detailed": _channel_detailed("COUNT(order_id)"),
    "channel_detailed_orders": _channel_detailed("COUNT(DISTINCT order_id)"),
    "channel_top_items": f"""SELECT channel, item_id, {_int_sum("quantity")} AS qty
        FROM m_order_items JOIN m_orders USING (order_id) WHERE quantity > 0 AND {_PAID}
        GROUP BY channel, item_id""",
    "peak_hours": f"""SELECT CAST(hour(order_date) AS INT) AS hour, COUNT(order_id) AS order_count,
        {_money("total_amount")} AS revenue FROM m_event_orders WHERE {_PAID} GROUP BY 1""",
    "peak_days": f"""SELECT CAST(dayofweek(order_date) + 1 AS INT) AS dow,
        COUNT(order_id) AS order_count, {_PERIOD} 1""",
    "weekend_analysis": f"""SELECT CAST(CASE WHEN dayofweek(order_date) IN (0, 6) THEN 1 ELSE 0 END
        AS INT) AS is_weekend, COUNT(order_id) AS orders, {_PERIOD} 1""",
    "monthly_analysis": f"""SELECT CAST(month(order_date) AS INT) AS month,
        COUNT(order_id) AS orders, {_PERIOD} 1""",
    "monthly_analysis_by_year": f"""SELECT CAST(year(order_date) AS INT) AS year,
        CAST(month(order_date) AS INT) AS month, COUNT(order_id) AS orders, {_PERIOD} 1, 2""",
    "seasonal_analysis": f"SELECT {_SEASON} AS season, COUNT(order_id) AS orders, {_PERIOD} 1",
    "orders_with_month": f"""SELECT *, CAST(month(order_date) AS INT) AS month FROM m_orders
        WHERE {_PAID}""",
    "wastage_analysis": "SELECT * FROM wasted",
    "wastage_by_location": f"SELECT location_id, {_WASTE_SUMS} GROUP BY 1",
    "wastage_by_category": f"""SELECT m.category, {_int_sum("w.quantity")} AS total_qty,
        {_money("w.cost")} AS total_cost FROM m_wastage w JOIN m_menu_items m ON w.item_id = m.item_id
        GROUP BY 1""",
    "wastage_by_day": f"""SELECT CAST(dayofweek(wastage_date) + 1 AS INT) AS dow, {_WASTE_SUMS}
        GROUP BY 1""",
    "wastage_by_reason": f"SELECT reason, {_WASTE_SUMS} GROUP BY 1",
    "wastage_risk": "SELECT * FROM risk",
    "top_wastage": """SELECT item_id, item_name, total_wasted_qty, total_wastage_cost, wastage_pct
        FROM wasted ORDER BY total_wastage_cost DESC, item_id LIMIT 10""",
    "wastage_headline": f"""SELECT {_money("total_wastage_cost")} AS total_wastage_cost,
        COUNT(*) FILTER (WHERE wastage_pct > 10) AS high_wastage_items FROM wasted""",
    "rating_analysis": f"""SELECT item_id, AVG(rating) AS avg_rating, COUNT(rating) AS total_ratings,
        COUNT(*) FILTER (WHERE rating >= 4) AS positive_ratings,
        COUNT(*) FILTER (WHERE rating <= 2) AS negative_ratings,
        {_pct("COUNT(*) FILTER (WHERE rating >= 4)", "COUNT(rating)")} AS satisfaction_pct
        FROM m_ratings GROUP BY item_id""",
    "rating_by_location": """SELECT o.location_id, AVG(r.rating) AS avg_rating,
        COUNT(r.rating) AS total_ratings FROM m_ratings r LEFT JOIN m_orders o
        ON r.order_id = o.order_id GROUP BY o.location_id""",
    "rating_vs_profit": """SELECT r.item_id, AVG(r.rating) AS avg_rating,
        MAX(c.profit_pct) AS avg_profit_pct FROM m_ratings r LEFT JOIN classified c
        ON r.item_id = c.item_id GROUP BY r.item_id""",
    "rating_by_promotion": """SELECT item_id, AVG(rating) AS promoted_rating FROM m_ratings
        WHERE item_id IN (SELECT item_id FROM m_promotions) GROUP BY item_id""",
    "best_rated": "SELECT * FROM rated ORDER BY avg_rating DESC, item_id LIMIT 10",
    "worst_rated": "SELECT * FROM rated ORDER BY avg_rating, item_id LIMIT 10",
    "rating_anomalies": f"""SELECT * FROM (SELECT item_id, AVG(rating) AS avg_rating,
        COUNT(rating) AS rating_count, {_r("STDDEV_SAMP(rating)", 6)} AS rating_std
        FROM m_ratings GROUP BY item_id) WHERE rating_count > 3 AND rating_std < 1.3""",
    "promotion_performance": """SELECT * FROM promo_lines
        WHERE item_id IN (SELECT item_id FROM m_promotions)""",
    "nonpromoted_performance": """SELECT * FROM promo_lines
        WHERE item_id NOT IN (SELECT item_id FROM m_promotions)""",
    "promo_traps": """SELECT * FROM promo_lines WHERE item_id IN (SELECT item_id FROM m_promotions)
        AND qty_sold > 300 AND total_profit / NULLIF(revenue, 0) < 0.45""",
    "promotion_dependency": f"""SELECT *, {_pct("promo_qty", "total_qty")} AS promo_dependency_pct
        FROM (SELECT item_id, total_qty, CASE WHEN item_id IN (SELECT item_id FROM m_promotions)
          THEN total_qty ELSE 0 END AS promo_qty FROM sold)""",
    "promotion_dependency_in_window": f"""SELECT item_id, total_qty,
        COALESCE(promo, 0) AS promo_qty, {_pct("COALESCE(promo, 0)", "total_qty")}
          AS promo_dependency_pct
        FROM sold LEFT JOIN (SELECT i.item_id, {_int_sum("i.quantity")} AS promo
          FROM m_order_items i JOIN m_orders o ON i.order_id = o.order_id
          WHERE i.quantity > 0 AND EXISTS (SELECT 1 FROM m_promotions p WHERE p.item_id = i.item_id
            AND CAST(o.order_date AS DATE) BETWEEN p.start_date AND p.end_date)
          GROUP BY i.item_id) USING (item_id)""",
    "price_sensitivity": "SELECT * FROM sensitivity",
    "sensitivity_summary": "SELECT sensitivity_class, COUNT(*) AS items FROM sensitivity GROUP BY 1",
    "top_price_sensitive": """SELECT * FROM sensitivity
        WHERE sensitivity_class = 'Highly Price Sensitive' ORDER BY qty_sold DESC, item_id LIMIT 10""",
    "rfm": "SELECT * FROM rfm_all",
    "rfm_plus_one": f"""SELECT customer_id, CAST(date_sub('day', MAX(order_date),
        (SELECT MAX(order_date) FROM m_orders WHERE {_PAID}) + INTERVAL 1 DAY) AS INT) AS recency,
        COUNT(order_id) AS frequency, {_money("total_amount")} AS monetary
        FROM m_orders WHERE {_PAID} GROUP BY customer_id""",
    "churn_risk": "SELECT * FROM churn",
    "churn_headline": """SELECT COUNT(*) FILTER (WHERE churn_risk = 'High Risk') AS high_risk,
        COUNT(*) FILTER (WHERE churn_risk = 'Active') AS active FROM churn""",
    "category_diversity": "SELECT * FROM diversity",
    "churn_enhanced": """SELECT c.*, COALESCE(d.category_diversity, 0) AS category_diversity
        FROM churn c LEFT JOIN diversity d ON c.customer_id = d.customer_id""",
    "repeat_purchase_rate": _repeat("COUNT(i.order_id)"),
    "repeat_purchase_orders": _repeat("COUNT(DISTINCT i.order_id)"),
    "weekend_ratio": "SELECT * FROM weekend_share",
    "weekend_only_items": "SELECT * FROM weekend_share WHERE weekend_ratio_pct > 60",
    "basket_size": f"""SELECT customer_id, {_r("AVG(n)")} AS avg_basket_size
        FROM (SELECT o.customer_id, o.order_id, SUM(i.quantity) AS n FROM m_order_items i
          JOIN m_orders o ON i.order_id = o.order_id WHERE i.quantity > 0 AND {_PAID}
          GROUP BY o.customer_id, o.order_id) GROUP BY customer_id""",
    "segment_agreement": f"""SELECT total, matches, total - matches AS mismatches,
        {_pct("matches", "total")} AS agreement_pct
        FROM (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE rich = often) AS matches
          FROM (SELECT CAST(monetary AS DECIMAL(18,2)) * COUNT(*) OVER ()
                >= SUM(CAST(monetary AS DECIMAL(18,2))) OVER () AS rich,
              frequency * COUNT(*) OVER () >= SUM(frequency) OVER () AS often FROM rfm_all))""",
    "rule_segments": "SELECT * FROM rule_named",
    "rule_segment_counts": "SELECT segment, COUNT(*) AS customers FROM rule_named GROUP BY segment",
    "rule_segment_summary": f"""SELECT segment, {_r("AVG(recency)")} AS avg_recency,
        {_r("AVG(frequency)")} AS avg_frequency, {_r(_money_avg("monetary"))} AS avg_monetary
        FROM rule_named GROUP BY segment""",
    "rule_segment_quality": """SELECT 'silhouette' AS metric,
        ROUND(AVG((outside - inside) / GREATEST(inside, outside)), 6) AS value FROM sil_rows""",
    "rule_customer_targeting": f"""SELECT segment_rank, segment, COUNT(customer_id) AS customer_count,
        {_r(_money_avg("monetary"))} AS avg_monetary, {_r("AVG(frequency)")} AS avg_frequency,
        {_STRATEGIES}[segment_rank] AS strategy FROM rule_named GROUP BY segment_rank, segment""",
    "rule_segment_matching": f"""SELECT CAST(total AS BIGINT) AS total, CAST(matches AS BIGINT) AS matches,
        CAST(total - matches AS BIGINT) AS mismatches, {_pct("matches", "total")} AS agreement_pct,
        ROUND((together - in_l * in_r / (total * (total - 1) / 2))
          / ((in_l + in_r) / 2 - in_l * in_r / (total * (total - 1) / 2)), 6) AS adjusted_rand
        FROM (SELECT {_best_match()} AS matches FROM match_cells) CROSS JOIN match_sums""",
    "rule_forecast_metrics": f"""SELECT model, {_r("rmse", 6)} AS rmse, {_r("mae", 6)} AS mae,
        {_r("r2", 6)} AS r2, ROW_NUMBER() OVER (ORDER BY rmse, model) = 1 AS best
        FROM (SELECT model, SQRT(AVG((demand - p) * (demand - p))) AS rmse, AVG(ABS(demand - p)) AS mae,
          1 - SUM((demand - p) * (demand - p)) / (VAR_POP(demand) * COUNT(*)) AS r2 FROM guesses GROUP BY model)""",
    "rule_model_comparison": f"""SELECT *, ROW_NUMBER() OVER (ORDER BY f1 DESC, model) = 1 AS best FROM (
        SELECT model, {_r("SUM(hits) / SUM(truly)", 4)} AS accuracy,
          {_r("SUM(truly * CASE WHEN hits > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END) "
              "/ SUM(truly)", 4)} AS f1,
          {_r("SUM(truly * precision) / SUM(truly)", 4)} AS precision,
          {_r("SUM(truly * recall) / SUM(truly)", 4)} AS recall FROM said_scores GROUP BY model)""",
    "fitted_demand": "SELECT order_date, demand, ROUND(fit, 4) AS fitted FROM fit_5",
    "baskets": f"""SELECT order_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items,
        CAST(COUNT(*) AS INT) AS size FROM (SELECT DISTINCT i.order_id, i.item_id
          FROM m_order_items i JOIN m_orders o ON i.order_id = o.order_id WHERE {_DONE})
        GROUP BY order_id HAVING COUNT(*) >= 2""",
    "frequent_itemsets": "SELECT items, freq FROM named",
    "top_itemsets": """SELECT items, freq FROM named
        ORDER BY freq DESC, string_split(items, ',') LIMIT 10""",
    "association_rules": "SELECT * FROM rules",
    "top_rules": """SELECT * FROM rules
        ORDER BY lift DESC, string_split(antecedent, ','), consequent LIMIT 10""",
    "pair_rules": "SELECT * FROM rules WHERE antecedent NOT LIKE '%,%'",
    "bundle_pairs": """SELECT a.item_id AS item1, b.item_id AS item2, COUNT(*) AS pair_count
        FROM (SELECT DISTINCT order_id, item_id FROM m_order_items WHERE quantity > 0) a
        JOIN (SELECT DISTINCT order_id, item_id FROM m_order_items WHERE quantity > 0) b
        ON a.order_id = b.order_id AND a.item_id < b.item_id
        GROUP BY 1, 2 ORDER BY pair_count DESC, item1, item2 LIMIT 50""",
    "recommendations": "SELECT * FROM recommended",
    "recommendations_by_priority": "SELECT * FROM recommended",
    "recommendations_by_sales": _recommended("""SELECT c.*, w.wastage_pct FROM classified c
        JOIN wasted w ON c.item_id = w.item_id"""),
    "recommendations_without_wastage": _recommended("SELECT *, CAST(0 AS DOUBLE) AS wastage_pct FROM classified"),
    "recommendation_counts": "SELECT priority, COUNT(*) AS items FROM recommended GROUP BY 1",
    "tricky_cases": _tricky("COALESCE(avg_rating, 0)"),
    "tricky_cases_rated": _tricky("avg_rating"),
    "master_kpis": " UNION ALL ".join(
        (
            _kpi("total_revenue", _money("total_amount"), f"m_orders WHERE {_PAID}"),
            _kpi("total_orders", "COUNT(*)", f"m_orders WHERE {_PAID}"),
            _kpi("unique_customers", "COUNT(DISTINCT customer_id)", f"m_orders WHERE {_PAID}"),
            _kpi("avg_order_value", _money_avg("total_amount"), f"m_orders WHERE {_PAID}"),
            _kpi("total_menu_items", "COUNT(*)", "m_menu_items"),
            _kpi("total_wastage_cost", _money("cost"), "m_wastage"),
            _kpi("avg_rating", "AVG(rating)", "m_ratings"),
        )
    ),
    "filtered_kpis": f"""SELECT {_money("total_amount")} AS total_revenue, COUNT(*) AS total_orders,
        {_money_avg("total_amount")} AS avg_order_value,
        COUNT(DISTINCT customer_id) AS unique_customers FROM m_orders
        WHERE {_IN_FILTER} AND location_id = 7 AND channel = '1-URGENT'""",
    "daily_revenue": f"""SELECT CAST(order_date AS DATE) AS date, {_money("total_amount")} AS revenue
        FROM m_orders WHERE {_IN_FILTER} GROUP BY 1""",
    "channel_mix": f"""SELECT channel, {_money("total_amount")} AS revenue FROM m_orders
        WHERE {_IN_FILTER} GROUP BY 1""",
    "sales_anomalies": "SELECT * FROM anomaly",
    "top_anomalies": "SELECT * FROM anomaly ORDER BY z_score DESC, order_date LIMIT 10",
    "daily_demand": "SELECT * FROM daily",
    "demand_features": "SELECT * FROM features",
    "demand_features_dom": """SELECT order_date, demand,
        CAST((dayofweek(order_date) + 6) % 7 AS INT) AS dayofweek,
        CAST(month(order_date) AS INT) AS month, CAST(day(order_date) AS INT) AS day, lag_1, lag_7
        FROM lagged""",
    "demand_split": """SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY order_date)
        <= FLOOR(0.8 * COUNT(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM features""",
    "forecast_error": f"""SELECT {_r("AVG(CASE WHEN demand <> 0 THEN ABS(demand - lag_7) "
        "/ CAST(demand AS DOUBLE) END) * 100")} AS mape,
        {_r("AVG(ABS(demand - lag_7))")} AS mae FROM lagged""",
}


#: Results of the cube, and the query whose rows they must have.
_FROM_CUBE = {
    "cube_channels": "channel_analysis",
    "cube_locations": "location_comparison",
    "cube_hours": "peak_hours",
    "cube_days": "peak_days",
    "cube_weekend": "weekend_analysis",
    "cube_months": "monthly_analysis_by_year",
    "cube_seasons": "seasonal_analysis",
}
_BODIES |= {name: _BODIES[same] for name, same in _FROM_CUBE.items()}
_BODIES["cube_totals"] = " UNION ALL ".join(
    _kpi(name, value, f"m_orders WHERE {_PAID}")
    for name, value in (
        ("total_revenue", _money("total_amount")),
        ("total_orders", "COUNT(*)"),
        ("unique_customers", "COUNT(DISTINCT customer_id)"),
        ("avg_order_value", _money_avg("total_amount")),
    )
)


def oracle_sql() -> dict[str, str]:
    return {name: _with(body) for name, body in _BODIES.items()}
