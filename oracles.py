"""DuckDB SQL with the same results as the registered queries.

Written apart from the Spark code, from the tables upwards: order metrics, for
example, are looked up per known order id instead of stacked or outer joined.
"""

from __future__ import annotations

from starmart.plans.checks import CHECKS
from starmart.plans.quality import Check

# Raw-shaped tables over the given ones, typed as staging types them.
TABLES = {
    "o": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    WHEN 'P' THEN 'processing' END AS order_status,
               o_orderdate + to_hours(o_orderkey % 24) AS order_purchase_timestamp,
               o_orderdate + to_hours(o_orderkey % 24 + 1 + o_orderkey % 48) AS order_approved_at,
               CASE WHEN o_orderstatus IN ('F', 'O')
                    THEN o_orderdate + to_hours(o_orderkey % 24 + 1 + o_orderkey % 48)
                         + to_days(CAST(1 + o_orderkey % 5 AS INTEGER))
               END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F'
                    THEN o_orderdate + to_hours(o_orderkey % 24 + o_orderkey % 31 * 24
                                                + o_orderkey % 17)
               END AS order_delivered_customer_date,
               CASE WHEN o_orderkey % 50 <> 0
                    THEN o_orderdate + to_hours(o_orderkey % 24)
                         + to_days(CAST(10 + o_orderkey % 7 AS INTEGER))
               END AS order_estimated_delivery_date
        FROM orders""",
    "i": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date,
               l_extendedprice AS price,
               l_quantity AS freight_value
        FROM lineitem""",
    "p": """
        SELECT CAST(event_id // 2 * 4 AS VARCHAR) AS order_id,
               CAST(1 + event_id % 2 AS INTEGER) AS payment_sequential,
               CASE event_type WHEN 'view' THEN 'credit_card' WHEN 'click' THEN 'boleto'
                    WHEN 'purchase' THEN 'debit_card' WHEN 'signup' THEN 'voucher'
                    WHEN 'error' THEN 'not_defined' END AS payment_type,
               CAST(1 + event_id % 10 AS INTEGER) AS payment_installments,
               value AS payment_value
        FROM events""",
    "r": """
        SELECT CAST(doc_id AS VARCHAR) AS review_id,
               CAST(doc_id * 15 AS VARCHAR) AS order_id,
               CAST(1 + quality * 3 + toxic AS INTEGER) AS review_score,
               CASE WHEN doc_id % 4 <> 0 THEN 'Review ' || doc_id END AS review_comment_title,
               CASE WHEN doc_id % 3 <> 0 THEN 'said "ok",' || chr(10) || 'score ' || doc_id % 5
               END AS review_comment_message,
               TIMESTAMP '2017-01-01 06:30:00' + to_hours(doc_id) AS review_creation_date,
               CASE WHEN doc_id % 5 > 0
                    THEN TIMESTAMP '2017-01-01 06:30:00' + to_hours(doc_id + 24 + doc_id % 9 * 24)
               END AS review_answer_timestamp
        FROM labels""",
    "c": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               c_name AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix,
               c_mktsegment AS customer_city,
               upper(lower(n_name)) AS customer_state
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "s": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               s_nationkey AS seller_zip_code_prefix,
               s_name AS seller_city,
               upper(lower(n_name)) AS seller_state
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "pr": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               p_type AS product_category_name,
               CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'LARGE', 'PROMO', 'SMALL')
                    THEN lower(p_type) ELSE 'unknown' END AS product_category_name_english,
               p_size AS product_weight_g,
               CAST(10 + p_size AS INTEGER) AS product_length_cm,
               CAST(CASE p_size % 3 WHEN 0 THEN NULL ELSE p_size + p_size END AS INTEGER)
                   AS product_height_cm,
               CAST(50 - p_size AS INTEGER) AS product_width_cm,
               CAST(p_size % 7 AS INTEGER) AS product_photos_qty
        FROM part""",
    "ri": """
        SELECT order_id, count(*) AS items_count, sum(price) AS total_price,
               sum(freight_value) AS total_freight
        FROM i GROUP BY order_id""",
    "rp": """
        SELECT order_id, sum(payment_value) AS total_payment,
               max(payment_installments) AS max_installments
        FROM p GROUP BY order_id""",
    "rr": """
        SELECT order_id, sum(review_score) / count(review_score) AS avg_review_score,
               count(*) AS review_count
        FROM r GROUP BY order_id""",
    "m": """
        SELECT k.order_id, ifnull(items_count, 0) AS items_count,
               ifnull(total_price, 0) AS total_price, ifnull(total_freight, 0) AS total_freight,
               ifnull(total_payment, 0) AS total_payment,
               ifnull(max_installments, 0) AS max_installments,
               avg_review_score, ifnull(review_count, 0) AS review_count
        FROM (SELECT order_id FROM ri UNION SELECT order_id FROM rp
              UNION SELECT order_id FROM rr) k
        LEFT JOIN ri USING (order_id) LEFT JOIN rp USING (order_id) LEFT JOIN rr USING (order_id)""",
    "fo": """
        SELECT md5(o.order_id) AS order_sk, o.order_id, md5(customer_id) AS customer_sk,
               CAST(year(order_purchase_timestamp) * 10000 + month(order_purchase_timestamp) * 100
                    + day(order_purchase_timestamp) AS INTEGER) AS order_date_sk,
               order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_customer_date, order_estimated_delivery_date,
               items_count, total_price, total_freight,
               total_price + total_freight AS total_order_value,
               total_payment, max_installments, avg_review_score, review_count,
               CAST(order_delivered_customer_date AS DATE)
                   - CAST(order_purchase_timestamp AS DATE) AS delivery_days,
               CASE WHEN order_delivered_customer_date IS NOT NULL
                    THEN ifnull(order_delivered_customer_date <= order_estimated_delivery_date,
                                false) END AS delivered_on_time
        FROM o LEFT JOIN m USING (order_id)""",
    "fi": """
        SELECT md5(i.order_id || '||' || order_item_id) AS order_item_sk,
               i.order_id, order_item_id, md5(customer_id) AS customer_sk,
               md5(product_id) AS product_sk, md5(seller_id) AS seller_sk,
               CAST(year(order_purchase_timestamp) * 10000 + month(order_purchase_timestamp) * 100
                    + day(order_purchase_timestamp) AS INTEGER) AS order_date_sk,
               order_status, price, freight_value, price + freight_value AS item_total
        FROM i JOIN o USING (order_id)""",
    "dc": "SELECT md5(customer_id) AS customer_sk, * FROM c",
    "dp": "SELECT md5(product_id) AS product_sk, * FROM pr",
    "ds": "SELECT md5(seller_id) AS seller_sk, * FROM s",
    "db": """
        SELECT min(CAST(order_purchase_timestamp AS DATE)) AS min_date,
               max(CAST(order_purchase_timestamp AS DATE)) AS max_date
        FROM o""",
    "sp": """
        SELECT min_date + CAST(n AS INTEGER) AS date_day
        FROM db, range(0, 40000) AS days(n)
        WHERE n <= max_date - min_date""",
    "dd": """
        SELECT CAST(year(date_day) * 10000 + month(date_day) * 100 + day(date_day) AS INTEGER)
                   AS date_sk,
               date_day, year(date_day) AS year, quarter(date_day) AS quarter,
               month(date_day) AS month, monthname(date_day) AS month_name,
               day(date_day) AS day_of_month, dayofweek(date_day) AS day_of_week,
               dayname(date_day) AS day_name,
               dayname(date_day) IN ('Saturday', 'Sunday') AS is_weekend
        FROM sp""",
}
NEEDS = {
    "ri": ["i"], "rp": ["p"], "rr": ["r"], "m": ["ri", "rp", "rr"], "fo": ["o", "m"],
    "fi": ["i", "o"], "dc": ["c"], "dp": ["pr"], "ds": ["s"], "db": ["o"], "sp": ["db"],
    "dd": ["sp"],
}
NAMES = {
    "stg_customers": "c", "stg_orders": "o", "stg_order_items": "i", "stg_order_payments": "p",
    "stg_order_reviews": "r", "stg_products": "pr", "stg_sellers": "s", "dim_customer": "dc",
    "dim_product": "dp", "dim_seller": "ds", "dim_date": "dd", "fact_orders": "fo",
    "fact_order_items": "fi",
}

METRICS_ROUNDED = """round(total_price, 2) AS total_price,
    round(total_freight, 2) AS total_freight, round(total_payment, 2) AS total_payment"""
METRICS = f"SELECT * REPLACE ({METRICS_ROUNDED}) FROM m"
FACT_ORDERS = f"""SELECT * REPLACE ({METRICS_ROUNDED},
    round(total_order_value, 2) AS total_order_value) FROM fo"""
FACT_ITEMS = "SELECT * FROM fi"
CONDITIONS = """
    SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS on_weekend, known <= 100000 AS small,
           known IS NULL AS unknown,
           CASE WHEN known < 1000 THEN 'low' WHEN known > 100000 THEN 'high' ELSE 'other' END
               AS band,
           known + 1.5::DOUBLE AS raised,
           o_totalprice >= 5000 AND known <= 100000 AS both,
           o_totalprice >= 5000 OR known <= 100000 AS either
    FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS known FROM orders)"""


def _with(tables: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(table: str) -> None:
        for needed in NEEDS.get(table, []):
            add(needed)
        if table not in ordered:
            ordered.append(table)

    for table in tables:
        add(table)
    return f"WITH {', '.join(f'{t} AS ({TABLES[t]})' for t in ordered)} {body}"


def _count_failures(check: Check) -> str:
    table, column = NAMES[check.table], check.column
    if check.kind == "not_null":
        return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    if check.kind == "singular":
        return f"SELECT count(*) FROM {table} WHERE {check.predicate}"
    if check.kind == "unique":
        return (
            f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1)"
        )
    if check.kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in check.values)
        return (
            f"SELECT count(DISTINCT {column}) FROM {table} "
            f"WHERE CAST({column} AS VARCHAR) NOT IN ({values})"
        )
    return (
        f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {check.parent_column} FROM {NAMES[check.parent]} "
        f"WHERE {check.parent_column} IS NOT NULL)"
    )


def _summary() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c.test}' AS test, '{c.table}' AS \"table\", '{c.column}' AS \"column\", "
        f"({_count_failures(c)}) AS failures"
        for c in CHECKS
    )
    return f"SELECT *, failures = 0 AS passed FROM ({rows})"


def oracle_sql() -> dict[str, str]:
    sql = {name: _with([t], f"SELECT * FROM {t}") for name, t in NAMES.items() if t not in
           ("fo", "fi")}
    sql["fact_orders"] = _with(["fo"], FACT_ORDERS)
    sql["fact_order_items"] = _with(["fi"], FACT_ITEMS)
    sql["int_items"] = _with(["ri"], """SELECT * REPLACE (round(total_price, 2) AS total_price,
        round(total_freight, 2) AS total_freight) FROM ri""")
    sql["int_payments"] = _with(
        ["rp"], "SELECT * REPLACE (round(total_payment, 2) AS total_payment) FROM rp")
    sql["int_reviews"] = _with(["rr"], "SELECT * FROM rr")
    for name in ("order_metrics", "order_metrics_joined", "order_metrics_view"):
        sql[name] = _with(["m"], METRICS)
    sql["date_bounds"] = _with(["db"], "SELECT * FROM db")
    sql["date_spine"] = _with(["sp"], "SELECT * FROM sp")
    sql["delivery_days"] = _with(["fo"], """SELECT delivery_days, count(*) AS orders
        FROM fo GROUP BY delivery_days""")
    sql["on_time_flag"] = _with(["fo"], """SELECT order_status, delivered_on_time,
        count(*) AS orders FROM fo GROUP BY ALL""")

    sql["rpt_kpis"] = _with(["fo"], """SELECT count(*) AS orders,
        round(sum(total_order_value), 2) AS revenue, round(avg(avg_review_score), 6) AS avg_review,
        round(avg(delivery_days), 6) AS avg_delivery_days
        FROM fo WHERE order_status = 'delivered'""")
    sql["rpt_monthly_revenue"] = _with(["fo"], """
        SELECT CAST(make_date(year(d), month(d), 1) AS TIMESTAMP) AS month,
               round(sum(total_order_value), 2) AS revenue
        FROM (SELECT *, order_purchase_timestamp AS d FROM fo) GROUP BY 1 ORDER BY 1""")
    sql["rpt_top_categories"] = _with(["fi", "dp"], """
        SELECT product_category_name_english AS category, round(sum(item_total), 2) AS revenue
        FROM fi JOIN dp USING (product_sk) GROUP BY category
        ORDER BY revenue DESC, category LIMIT 10""")
    sql["rpt_state_revenue"] = _with(["fo", "dc"], """
        SELECT customer_state AS state, round(sum(total_order_value), 2) AS revenue
        FROM fo JOIN dc USING (customer_sk) GROUP BY state ORDER BY revenue DESC, state""")
    sql["rpt_installments"] = _with(["fo"], """
        SELECT max_installments AS installments, count(*) AS orders
        FROM fo WHERE max_installments >= 1 GROUP BY installments ORDER BY installments""")
    sql["rpt_top_sellers"] = _with(["fi", "ds"], """
        SELECT seller_id, seller_state, count(DISTINCT order_id) AS orders,
               round(sum(item_total), 2) AS revenue
        FROM fi JOIN ds USING (seller_sk) GROUP BY seller_id, seller_state
        ORDER BY revenue DESC, seller_id, seller_state LIMIT 10""")
    sql["rpt_status"] = sql["csv_to_catalog"] = _with(["fo"], """
        SELECT order_status, count(*) AS orders, round(sum(total_order_value), 2) AS revenue
        FROM fo GROUP BY order_status""")

    sql["dq_not_null"] = _with(["fo"], f"""
        SELECT * FROM ({FACT_ORDERS}) WHERE total_order_value IS NULL""")
    sql["dq_unique"] = _with(["fi"], """
        SELECT order_item_sk AS unique_field, count(*) AS n_records
        FROM fi GROUP BY order_item_sk HAVING count(*) > 1""")
    sql["dq_accepted_values"] = _with(["o"], """
        SELECT order_status AS value_field, count(*) AS n_records
        FROM o WHERE order_status NOT IN ('delivered', 'shipped') GROUP BY order_status""")
    sql["dq_relationships"] = _with(["p", "o"], """
        SELECT order_id AS from_field FROM p
        WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.order_id = p.order_id)""")
    sql["dq_value_non_negative"] = _with(["i", "p", "r", "o"], """
        SELECT order_id, round(total_order_value, 2) AS total_order_value
        FROM (SELECT i.order_id,
                     sum(CASE WHEN CAST(i.order_id AS BIGINT) % 7 = 0 THEN -price ELSE price END)
                         + sum(freight_value) AS total_order_value
              FROM i JOIN o USING (order_id) GROUP BY i.order_id)
        WHERE total_order_value < 0""")
    sql["dq_mixed_types"] = """
        WITH l AS (SELECT l_partkey + l_linenumber AS part, l_linenumber AS line,
                          CASE l_linenumber WHEN 7 THEN 0.5 ELSE l_suppkey END AS supplier
                   FROM lineitem),
        n AS (
            SELECT 'relationships_lines_part__parts_p_partkey' AS test, 'part' AS "column",
                   (SELECT count(*) FROM l WHERE part NOT IN (SELECT p_partkey FROM part))
                       AS failures
            UNION ALL SELECT 'relationships_lines_supplier__suppliers_s_suppkey', 'supplier',
                   (SELECT count(*) FROM l
                    WHERE supplier NOT IN (SELECT s_suppkey FROM supplier))
            UNION ALL SELECT 'accepted_values_lines_line', 'line',
                   (SELECT count(DISTINCT line) FROM l WHERE line NOT IN (1, 2, 3))
            UNION ALL SELECT 'unique_lines_part', 'part',
                   (SELECT count(*) FROM (SELECT part FROM l GROUP BY part HAVING count(*) > 1)))
        SELECT test, 'lines' AS "table", "column", failures, failures = 0 AS passed FROM n"""
    sql["dq_summary"] = _with(list(dict.fromkeys(NAMES.values())), _summary())
    sql["dq_summary_published"] = sql["dq_summary"]

    sql["surrogate_key"] = """
        SELECT o_orderkey,
               md5(CAST(o_orderkey AS VARCHAR)) AS key_one,
               md5(o_orderkey || '||' || o_orderstatus || '||' || o_orderdate) AS key_three,
               md5(ifnull(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '_null_')
                   || '||' || (o_orderkey % 2 = 0)) AS key_null_token
        FROM orders"""
    sql["raw_csv_scan"] = _with(["o"], f"SELECT {_all_text('o')} FROM o")
    sql["raw_csv_free_text"] = """
        SELECT CAST(doc_id AS VARCHAR) AS review_id, source AS review_comment_title,
               nullif(text, '') AS review_comment_message
        FROM documents"""
    sql["raw_csv_stitched"] = sql["raw_csv_free_text"]
    sql["staging_views"] = _with(["p", "o"], """
        SELECT payment_type, order_status, count(*) AS payments,
               round(sum(payment_value), 2) AS paid
        FROM p JOIN o USING (order_id) GROUP BY ALL""")
    sql["dimension_overwrite"] = _with(
        ["dc"], "SELECT * REPLACE (lower(customer_city) AS customer_city) FROM dc")
    sql["mart_read_back"] = _with(["fi"], FACT_ITEMS)

    sql["fn_text_and_null"] = """
        SELECT c_custkey, upper(c_mktsegment) AS upper_segment,
               concat_ws('||', c_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END)
                   AS joined_name,
               md5(c_name) AS name_md5,
               nullif(CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END, '')
                   AS filled_segment,
               coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END,
                        CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, 'none') AS first_filled
        FROM customer"""
    sql["fn_casts"] = """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS text_to_double,
               CAST(CAST(l_quantity + 0.5 AS VARCHAR) AS INTEGER) AS text_to_int,
               CAST(CAST(l_shipdate AS VARCHAR) AS TIMESTAMP) AS text_to_timestamp,
               CAST(l_shipdate AS DATE) AS timestamp_to_date,
               CAST(l_linenumber AS DOUBLE) AS int_to_double
        FROM lineitem"""
    sql["fn_dates"] = """
        SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
               year(ts) AS year, quarter(ts) AS quarter, month(ts) AS month, day(ts) AS day,
               dayofweek(ts) AS day_of_week, strftime(ts, '%B') AS month_name,
               strftime(ts, '%A') AS day_name,
               CAST(ts + to_hours(event_id % 40) AS DATE) - CAST(ts AS DATE) AS days_between,
               date_trunc('month', CAST(ts AS TIMESTAMP)) AS month_start
        FROM events"""
    sql["fn_conditions"] = CONDITIONS
    sql["rel_null_order"] = f"""
        SELECT row_number() OVER (ORDER BY small ASC NULLS LAST) - 1 AS position, small, orders
        FROM (SELECT small, count(*) AS orders FROM ({CONDITIONS}) GROUP BY small)"""
    sql["fn_aggregates"] = """
        SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users,
               round(sum(value), 2) AS total, round(avg(value), 6) AS mean,
               min(ts) AS first_ts, max(ts) AS last_ts
        FROM events GROUP BY event_type"""
    sql["rel_join_types"] = _with(["i", "p", "r", "o", "ri", "rp", "rr"], """
        SELECT join_type, count(*) AS n, CAST(sum(CAST(a AS BIGINT)) AS BIGINT) AS left_keys,
               CAST(sum(CAST(b AS BIGINT)) AS BIGINT) AS right_keys
        FROM (
            SELECT 'inner' AS join_type, i.order_id AS a, o.order_id AS b
            FROM i JOIN o ON i.order_id = o.order_id
            UNION ALL SELECT 'left', o.order_id, p.order_id
            FROM o LEFT JOIN p ON o.order_id = p.order_id
            UNION ALL SELECT 'full_outer', ri.order_id, rp.order_id
            FROM ri FULL JOIN rp ON ri.order_id = rp.order_id
            UNION ALL SELECT 'full_outer_on_expression', ifnull(x.a, x.b), rr.order_id
            FROM (SELECT ri.order_id AS a, rp.order_id AS b
                  FROM ri FULL JOIN rp ON ri.order_id = rp.order_id) x
            FULL JOIN rr ON ifnull(x.a, x.b) = rr.order_id
            UNION ALL SELECT 'anti', p.order_id, NULL FROM p ANTI JOIN o USING (order_id)
        ) GROUP BY join_type""")
    return sql


def _all_text(table: str) -> str:
    columns = {
        "o": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
              "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"],
    }[table]
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
