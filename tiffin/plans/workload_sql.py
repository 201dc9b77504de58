"""The registered queries as plain SQL over the same tables, for comparison.

Rounded ratios are written as integer half-up arithmetic: binary division would
miss the last digit on rounding edges.
"""

from __future__ import annotations

from tiffin.operators import enrich, quality
from tiffin.plans.workload import SAMPLE_RULES, WINDOWS

SQL: dict[str, str] = {}


def half_up(num: str, den: str, digits: int) -> str:
    """``num / den`` of whole numbers, rounded half away from zero."""
    scale = 10**digits
    return (
        f"CAST(sign({num}) AS DOUBLE) * CAST((2 * {scale} * CAST(abs({num}) AS HUGEINT) + ({den})) "
        f"// (2 * ({den})) AS DOUBLE) / {scale}"
    )


def ratio(num: str, den: str, digits: int) -> str:
    """The same, 0 for an empty denominator."""
    return f"CASE WHEN ({den}) = 0 THEN 0 ELSE {half_up(num, den, digits)} END"


def text(sql: str) -> str:
    return f"coalesce(CAST({sql} AS VARCHAR), chr(0))"


def title_case(sql: str) -> str:
    breaks = r"""[\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"""
    return (
        "array_to_string(list_transform("
        rf"regexp_extract_all(lower({sql}), '[^\s!?@\x22^#$&~_,.:;+\-*%/|\\\[\](){{}}<>]+|{breaks}'), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )


HEADS = """
heads AS (
  SELECT o_orderkey AS order_id, o_orderdate AS order_timestamp, CAST(o_orderdate AS DATE) AS order_date,
         o_custkey AS customer_id, n_name AS city, o_orderpriority AS cuisine, c_mktsegment AS payment_method,
         CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'Cancelled' WHEN 'O' THEN 'Refunded'
              ELSE o_orderstatus END AS order_status,
         o_orderstatus = 'F' AS is_delivered,
         CAST(o_totalprice AS DECIMAL(12,2)) AS sales_amount,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CAST(left(o_orderpriority, 1) AS BIGINT) AS customer_rating
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
)"""

TYPED = (
    HEADS
    + """,
totals AS (
  SELECT l_orderkey AS order_id, min(l_suppkey) AS restaurant_id, count(*) AS items_count,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sales_qty,
         sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS subtotal,
         sum(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)) AS discount,
         sum(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)) AS gst,
         CAST(max(l_shipdate) AS DATE) AS delivered_on
  FROM lineitem GROUP BY l_orderkey
),
typed AS (
  SELECT heads.*, restaurant_id, items_count, sales_qty, subtotal, discount, gst,
         CAST(date_diff('day', order_date, delivered_on) AS BIGINT) AS delivery_time_min
  FROM heads LEFT JOIN totals USING (order_id)
)"""
)

RESTAURANTS = """
restaurants AS (
  SELECT s_suppkey AS restaurant_id, s_name AS restaurant_name, n_name AS city, 'Cuisine ' || s_nationkey AS cuisine
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
)"""

REVIEWS = """
reviews AS (
  SELECT doc_id AS review_id, text AS comment, source AS city, CAST(quality * 3 + 2 AS BIGINT) AS rating,
         DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS review_date
  FROM documents LEFT JOIN labels USING (doc_id)
)"""

# --- staging ----------------------------------------------------------------

SQL["stg_restaurants"] = """
SELECT s_suppkey AS restaurant_id, s_name AS restaurant_name, n_name AS city,
       CASE WHEN s_acctbal >= 0
            THEN CAST(CAST(CAST(CAST(CAST(s_acctbal AS DECIMAL(12,2)) / 2000 AS DECIMAL(12,4)) AS VARCHAR)
                 AS DECIMAL(3,1)) AS DOUBLE) END AS rating,
       CASE WHEN s_acctbal >= 0 THEN s_suppkey END AS rating_count,
       CAST(s_nationkey AS BIGINT) AS cost_for_two, 'Cuisine ' || s_nationkey AS cuisine,
       'L' || s_suppkey AS license_no, 'load-1' AS _batch_id
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
"""

USERS = """
users AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_name) || '@example.com' AS customer_email,
         CASE WHEN c_acctbal >= 0 THEN CAST(round(CAST(c_acctbal AS DECIMAL(12,2)) / 100) AS BIGINT)
              END AS customer_age,
         CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS marital_status,
         CASE WHEN c_acctbal > 5000 THEN 'MOVED' ELSE c_mktsegment END AS occupation,
         CAST(NULL AS VARCHAR) AS income_band, CAST(NULL AS VARCHAR) AS education,
         CAST(c_nationkey AS BIGINT) AS family_size,
         CASE WHEN c_acctbal > 5000 THEN 'load-2' ELSE 'load-1' END AS _batch_id
  FROM customer
)"""
SQL["stg_users"] = f"WITH {USERS} SELECT * FROM users"

SQL["stg_food"] = f"""
SELECT 'fd' || p_partkey AS f_id, p_name AS food_name,
       {title_case("lower(p_type) || '-' || upper(p_brand)")} AS veg_or_non_veg, 'load-1' AS _batch_id
FROM part
"""

SQL["stg_menu"] = """
SELECT 'mn' || p_partkey AS menu_id, CAST(p_size AS BIGINT) AS restaurant_id, 'fd' || p_partkey AS f_id,
       CASE WHEN p_size > 25 THEN p_type ELSE lower(p_type) END AS cuisine,
       CASE WHEN p_size > 25 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 0.01 AS DOUBLE) ELSE 12.35 END AS price,
       CASE WHEN p_size > 25 THEN 'load-1' ELSE 'load-2' END AS _batch_id
FROM part
"""

SQL["stg_orders"] = f"""
WITH {HEADS}
SELECT order_id, order_timestamp, order_date, customer_id, CAST(c_nationkey % 10 AS BIGINT) AS restaurant_id, city, cuisine,
       CAST(c_nationkey + 1 AS BIGINT) AS items_count, CAST(NULL AS BIGINT) AS sales_qty,
       CAST(sales_amount AS DOUBLE) AS subtotal,
       CASE WHEN order_status = 'Refunded' THEN NULL ELSE 1.01 END AS discount,
       CAST(2.50 AS DOUBLE) AS delivery_fee, CAST(NULL AS DOUBLE) AS gst, CAST(sales_amount AS DOUBLE) AS sales_amount,
       'INR' AS currency, payment_method,
       order_status, is_delivered,
       customer_rating, CAST(NULL AS BIGINT) AS delivery_time_min,
       CASE WHEN order_status = 'Refunded' THEN 'load-1' ELSE 'load-2' END AS _batch_id
FROM heads LEFT JOIN customer ON c_custkey = customer_id
"""

ITEMS = f"""
lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_suppkey AS restaurant_id,
         'fd' || l_partkey AS f_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_quantity AS DECIMAL(12,2)) AS quantity, l_shipdate
  FROM lineitem
),
items AS (
  SELECT order_item_id, order_id, restaurant_id, f_id, CAST(price AS DECIMAL(10,2)) AS price,
         CAST(round(quantity) AS BIGINT) AS quantity, CAST(price AS DECIMAL(10,2)) AS line_amount,
         'load-1' AS _batch_id
  FROM lines
  QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY l_shipdate DESC,
    md5(concat_ws(chr(1), {", ".join(text(c) for c in
        ("order_item_id", "order_id", "restaurant_id", "f_id", "price", "quantity", "price"))})) DESC) = 1
)"""
SQL["stg_order_items"] = f"""
WITH {ITEMS}
SELECT order_item_id, order_id, restaurant_id, f_id, CAST(price AS DOUBLE) AS price, quantity,
       CAST(line_amount AS DOUBLE) AS line_amount, _batch_id
FROM items
"""

SQL["stg_reviews"] = """
SELECT doc_id AS review_id, doc_id AS order_id, doc_id AS customer_id, s_suppkey_text AS restaurant_id,
       CAST(CASE quality WHEN 1 THEN 4 WHEN 0 THEN 2 END AS BIGINT) AS rating, text AS comment,
       DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS review_date, n_name AS city,
       CASE quality WHEN 1 THEN 'load-2' ELSE 'load-1' END AS _batch_id
FROM (SELECT *, CAST(regexp_extract(source, '[0-9]+') AS BIGINT) AS s_suppkey_text FROM documents)
LEFT JOIN labels USING (doc_id)
LEFT JOIN supplier ON s_suppkey = s_suppkey_text
LEFT JOIN nation ON n_nationkey = s_nationkey
WHERE text IS NOT NULL
"""

# --- dimensions and facts ---------------------------------------------------

SQL["dim_customer"] = f"""
WITH {USERS}
SELECT customer_id, customer_name, customer_email, customer_age,
       CASE WHEN customer_age < 25 THEN 'Gen Z' WHEN customer_age < 40 THEN 'Millennial'
            WHEN customer_age < 55 THEN 'Gen X' WHEN customer_age IS NULL THEN 'Unknown' ELSE 'Boomer' END
         AS age_segment,
       gender, marital_status, occupation, income_band, education, family_size
FROM users
"""

SQL["dim_restaurants"] = f"""
SELECT restaurant_id, restaurant_name, city, rating, rating_count, cost_for_two, cuisine
FROM ({SQL["stg_restaurants"]})
"""

SQL["dim_food"] = f"SELECT f_id, food_name, veg_or_non_veg FROM ({SQL['stg_food']})"

SQL["dim_date_orders"] = """
WITH per_day AS (SELECT CAST(o_orderdate AS DATE) AS date_day, count(*) AS orders FROM orders GROUP BY 1),
days AS (
  SELECT CAST(unnest(generate_series((SELECT min(date_day) FROM per_day), (SELECT max(date_day) FROM per_day),
                                     INTERVAL 1 DAY)) AS DATE) AS date_day
)
SELECT date_day, CAST(year(date_day) AS INTEGER) AS year, CAST(month(date_day) AS INTEGER) AS month,
       strftime(date_day, '%b') AS month_name, strftime(date_day, '%a') AS day_name,
       isodow(date_day) >= 6 AS is_weekend, coalesce(orders, 0) AS orders
FROM days LEFT JOIN per_day USING (date_day)
"""

SQL["fact_orders"] = f"""
WITH {TYPED}
SELECT order_id, order_timestamp, order_date, customer_id, restaurant_id, city, cuisine, payment_method,
       order_status, is_delivered, items_count, sales_qty, CAST(subtotal AS DOUBLE) AS subtotal,
       CAST(discount AS DOUBLE) AS discount, CAST(0 AS DOUBLE) AS delivery_fee, CAST(gst AS DOUBLE) AS gst,
       CAST(sales_amount AS DOUBLE) AS sales_amount, customer_rating, delivery_time_min
FROM typed
"""

SQL["fact_order_items"] = f"""
WITH {HEADS}, {ITEMS}
SELECT order_item_id, order_id, restaurant_id, f_id, order_timestamp AS order_ts, order_date, city,
       CAST(price AS DOUBLE) AS price, quantity, CAST(line_amount AS DOUBLE) AS line_amount
FROM items JOIN heads USING (order_id)
"""

# --- marts and semantic views -----------------------------------------------

DONE = "count(*) FILTER (WHERE is_delivered)"
GMV_CENTS = "sum(CASE WHEN is_delivered THEN cents ELSE 0 END)"
CANCELLED = "count(*) FILTER (WHERE order_status = 'Cancelled')"

REVENUE = f"""
SELECT order_date, city, count(*) AS orders, {DONE} AS delivered_orders,
       {ratio(CANCELLED, "count(*)", 4)} AS cancel_rate,
       CAST({GMV_CENTS} AS DOUBLE) / 100 AS gross_merchandise_value,
       CASE WHEN {DONE} = 0 THEN 0 ELSE {half_up(GMV_CENTS, DONE, 0)} / 100 END AS average_order_value
FROM heads GROUP BY order_date, city
"""
SQL["mart_daily_city_revenue"] = f"WITH {HEADS} {REVENUE}"

PERFORMANCE = f"""
SELECT restaurant_id, restaurant_name, r.city, r.cuisine, count(*) AS orders,
       CAST({GMV_CENTS} AS DOUBLE) / 100 AS revenue,
       {half_up("sum(customer_rating)", "count(customer_rating)", 2)} AS avg_customer_rating,
       CASE WHEN count(delivery_time_min) > 0
            THEN {half_up("sum(delivery_time_min)", "count(delivery_time_min)", 1)} END AS avg_delivery_min,
       {ratio(CANCELLED, "count(*)", 4)} AS cancel_rate
FROM typed LEFT JOIN restaurants r USING (restaurant_id)
GROUP BY restaurant_id, restaurant_name, r.city, r.cuisine
"""
SQL["mart_restaurant_performance"] = f"WITH {TYPED}, {RESTAURANTS} {PERFORMANCE}"

LATE = "count(*) FILTER (WHERE delivery_time_min > 45)"
SLA = f"""
SELECT city, CAST(hour(order_timestamp) AS INTEGER) AS order_hour, count(*) AS delivered_orders,
       round(median(delivery_time_min), 1) AS p50_delivery_min,
       round(quantile_cont(delivery_time_min, 0.9), 1) AS p90_delivery_min,
       {ratio(LATE, "count(*)", 4)} AS late_rate
FROM typed WHERE is_delivered GROUP BY 1, 2
"""
SQL["mart_delivery_sla"] = f"WITH {TYPED} {SLA}"

SQL["event_hourly_sla"] = f"""
SELECT event_type, CAST(hour(ts) AS INTEGER) AS event_hour, count(*) AS n_events,
       {ratio("count(*) FILTER (WHERE value > 45)", "count(*)", 4)} AS late_rate,
       round(quantile_cont(value, 0.5), 6) AS p50_value, round(quantile_cont(value, 0.9), 6) AS p90_value
FROM events GROUP BY 1, 2
"""

SQL["sem_orders"] = f"""
WITH {TYPED}, customers AS ({SQL["dim_customer"]})
SELECT order_id, order_timestamp, order_date, customer_id, age_segment, restaurant_id, city, cuisine, payment_method,
       order_status, is_delivered, CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(discount AS DOUBLE) AS discount,
       CAST(0 AS DOUBLE) AS delivery_fee, CAST(gst AS DOUBLE) AS gst, customer_rating, delivery_time_min
FROM typed LEFT JOIN customers USING (customer_id)
"""
SQL["sem_revenue_daily"] = SQL["mart_daily_city_revenue"]
SQL["sem_restaurant_performance"] = SQL["mart_restaurant_performance"]
SQL["sem_delivery_sla"] = SQL["mart_delivery_sla"]
SQL["sem_reviews"] = f"WITH {REVIEWS} SELECT review_id, city, rating, comment, review_date FROM reviews"

# --- facts that grow --------------------------------------------------------

FACT = "order_id, order_timestamp, order_date, customer_id, city, order_status, CAST(sales_amount AS DOUBLE) AS sales_amount"
FIRST_DROP = "order_date <= DATE '1998-06-30' AND cuisine <> '5-LOW'"
NEWEST = f"(SELECT max(order_timestamp) FROM heads WHERE {FIRST_DROP})"

SQL["fact_orders_incremental"] = f"""
WITH {HEADS} SELECT {FACT} FROM heads WHERE ({FIRST_DROP}) OR order_timestamp > {NEWEST}
"""

SQL["fact_orders_lookback"] = f"""
WITH {HEADS}
SELECT {FACT} FROM heads WHERE order_timestamp > {NEWEST} - INTERVAL 365 DAY
UNION ALL
SELECT {FACT.replace("order_status", "'Placed' AS order_status")} FROM heads
WHERE {FIRST_DROP} AND order_timestamp <= {NEWEST} - INTERVAL 365 DAY
"""

# --- metrics and governed SQL -----------------------------------------------

SQL["metric_customer_count"] = "SELECT count(DISTINCT o_custkey) AS customer_count FROM orders"

SQL["metric_restaurant_revenue"] = f"""
WITH {TYPED}
SELECT restaurant_id, CAST({GMV_CENTS} AS DOUBLE) / 100 AS restaurant_revenue FROM typed GROUP BY restaurant_id
"""

SQL["metric_aov_by_city"] = f"""
WITH {HEADS}
SELECT city, CASE WHEN {DONE} = 0 THEN 0 ELSE {half_up(GMV_CENTS, DONE, 0)} / 100 END AS average_order_value
FROM heads GROUP BY city
"""

SQL["metric_lookup_gmv"] = f"SELECT * FROM ({SQL['mart_daily_city_revenue']}) ORDER BY order_date, city LIMIT 200"

SQL["governed_query"] = f"""
SELECT city, CAST(year(order_date) AS INTEGER) AS order_year, CAST(sum(orders) AS BIGINT) AS n_orders,
       CAST(sum(CAST(gross_merchandise_value AS DECIMAL(22,2))) AS DOUBLE) AS gmv
FROM ({SQL["mart_daily_city_revenue"]}) WHERE orders > 1
GROUP BY ALL ORDER BY gmv DESC, city, order_year LIMIT 50
"""

SQL["governed_union"] = f"""
WITH {HEADS}
SELECT city FROM heads WHERE is_delivered UNION SELECT source AS city FROM documents ORDER BY city LIMIT 30
"""

# --- data checks --------------------------------------------------------------

SQL["dim_date"] = """
SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS date_day
"""


def check_sql(check: quality.Check) -> str:
    """One check as SQL over the SQL of its model."""
    model = f"({SQL[check.table]})"
    c = check.column
    if check.kind == "unique":
        bad = f"SELECT {c} FROM {model} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    elif check.kind == "not_null":
        bad = f"SELECT 1 FROM {model} WHERE {c} IS NULL"
    elif check.kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in check.values)
        bad = f"SELECT 1 FROM {model} WHERE {c} NOT IN ({values})"
    elif check.kind == "relationships":
        parent = f"SELECT {check.parent_column} FROM ({SQL[check.parent]})"
        bad = f"SELECT 1 FROM {model} WHERE {c} IS NOT NULL AND {c} NOT IN ({parent})"
    elif check.kind == "expression":
        bad = f"SELECT 1 FROM {model} WHERE NOT ({c} {check.expression})"
    else:
        bad = f"SELECT 1 FROM {model} WHERE NOT ({check.expression})"
    return (
        f"SELECT '{check.table}' AS table_name, '{c}' AS column_name, '{check.kind}' AS check_name, "
        f"'{check.severity}' AS severity, count(*) AS failures FROM ({bad})"
    )


def checks_sql(checks: list[quality.Check]) -> str:
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
        f"FROM ({' UNION ALL '.join(check_sql(c) for c in checks)})"
    )


SQL["dq_staging"] = checks_sql(quality.STAGING_CHECKS)
SQL["dq_marts"] = checks_sql(quality.MART_CHECKS)
SQL["dq_semantic"] = checks_sql(quality.SEMANTIC_CHECKS)
SQL["dq_contract_fact_orders"] = checks_sql(quality.CONTRACTS["fact_orders"].checks())
del SQL["dim_date"]

SQL["dq_unique"] = """
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, count(*) AS n_rows
FROM lineitem GROUP BY 1 HAVING count(*) > 1
"""
SQL["dq_not_null"] = f"WITH {TYPED} SELECT order_id, restaurant_id, city FROM typed WHERE restaurant_id IS NULL"
SQL["dq_accepted_values"] = f"""
WITH {HEADS} SELECT order_id, order_status FROM heads WHERE order_status NOT IN ('Delivered', 'Cancelled')
"""
SQL["dq_relationships"] = f"""
WITH {HEADS} SELECT order_id, city FROM heads WHERE order_id NOT IN (SELECT l_orderkey FROM lineitem)
"""
SQL["dq_expression"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"
SQL["dq_freshness"] = """
SELECT 'events' AS table_name, age_hours,
       CASE WHEN age_hours > 48 THEN 'fail' WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT round(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-02 00:30:00') / 3600000000.0, 6) AS age_hours
      FROM events)
"""
SQL["dq_freshness_loads"] = """
SELECT event_type AS table_name, age_hours,
       CASE WHEN age_hours > 48 THEN 'fail' WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT event_type, round(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-02 00:30:00') / 3600000000.0, 6) AS age_hours
      FROM events WHERE event_type NOT IN ('error', 'view') GROUP BY event_type)
"""
SQL["dq_parity"] = f"""
SELECT view_name, n AS gold_row_count, n AS semantic_row_count, 0 AS failures FROM (
  SELECT 'sem_orders' AS view_name, count(*) AS n FROM orders
  UNION ALL SELECT 'sem_revenue_daily', count(*) FROM ({SQL["mart_daily_city_revenue"]})
  UNION ALL SELECT 'sem_reviews', count(*) FROM documents)
"""

# --- reviews: redaction, classification, insights ----------------------------

# RE2 knows word boundaries in ASCII only. The e-mail pattern has none; for the
# other two, letters and digits beyond ASCII first become the word character a.
PHONE = r"\b(?:\+?\d{1,3}[ -]?)?(?:\(\d{2,4}\)[ -]?)?\d{3,4}[ -]?\d{3,4}[ -]?\d{0,4}\b"


def labels_in(column: str) -> str:
    total = " + ".join(
        f"(length({column}) - length(replace({column}, '{x}', ''))) // {len(x)}"
        for x in ("[REDACTED_EMAIL]", "[REDACTED_CARD]", "[REDACTED_PHONE]")
    )
    return f"CAST({total} AS INTEGER)"


SCRUBBED = rf"""
scrubbed AS (
  SELECT doc_id, source, raw,
         regexp_replace(regexp_replace(folded, '\b(?:\d[ -]?){{13,16}}\b', '[REDACTED_CARD]', 'g'),
                        '{PHONE}', '[REDACTED_PHONE]', 'g') AS clean
  FROM (SELECT doc_id, source, text AS raw,
               regexp_replace(regexp_replace(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}',
                              '[REDACTED_EMAIL]', 'g'), '[^\x00-\x7F\PL]|[^\x00-\x7F\PN]', 'a', 'g') AS folded
        FROM documents)
)"""

SQL["pii_scrub"] = rf"""
WITH {SCRUBBED}
SELECT doc_id, {labels_in("clean")} - {labels_in("raw")} AS pii_redacted_count,
       CAST(length(clean) AS INTEGER) AS n_scrubbed, md5(regexp_replace(clean, '[^\x00-\x7F]', 'a', 'g')) AS fingerprint
FROM scrubbed
"""

SQL["review_pending"] = """
SELECT doc_id AS review_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
"""
SQL["review_pending_batch"] = """
SELECT doc_id AS review_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
ORDER BY 1 LIMIT 50
"""
SQL["review_attempts"] = """
SELECT doc_id AS review_id, CAST(CASE quality WHEN 1 THEN 2 WHEN 0 THEN 3 ELSE 1 END AS INTEGER) AS attempt_number
FROM documents LEFT JOIN labels USING (doc_id)
"""


def words(names: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def classified(rules: enrich.Rules) -> str:
    """Whole words of a-z, counted against the word lists. Labels put in by the
    redaction hold no listed word."""
    count = lambda names: f"len(list_filter(tokens, lambda w: list_contains({words(names)}, w)))"
    topic = " ".join(f"WHEN list_has_any(tokens, {words(v)}) THEN '{k}'" for k, v in rules.topics.items())
    issue = f"list_filter(tokens, lambda w: list_contains({words(rules.negative)}, w))[1]"
    return f"""
classified AS (
  SELECT doc_id AS review_id, source,
         CASE WHEN steps > 0 THEN 'positive' WHEN steps < 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
         CAST(steps AS BIGINT) AS steps, CAST(steps AS DOUBLE) / 5 AS sentiment_score,
         CASE {topic} ELSE 'other' END AS topic, CASE WHEN steps < 0 THEN {issue} END AS key_issue
  FROM (SELECT *, greatest(-5, least(5, {count(rules.positive)} - {count(rules.negative)})) AS steps
        FROM (SELECT doc_id, source, regexp_extract_all(lower(text), '[a-z]+') AS tokens
              FROM (SELECT doc_id, source, regexp_replace(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}',
                                                          '[REDACTED_EMAIL]', 'g') AS text FROM documents)))
)"""


SQL["review_classified"] = f"""
WITH {SCRUBBED}, {classified(SAMPLE_RULES)}
SELECT review_id, 'SUCCEEDED' AS status, sentiment_label, sentiment_score, topic, key_issue,
       {labels_in("clean")} - {labels_in("raw")} AS pii_redacted_count
FROM classified JOIN scrubbed ON doc_id = review_id
"""

SQL["review_insights"] = f"""
WITH {REVIEWS}, {classified(SAMPLE_RULES)}
SELECT city, topic, sentiment_label, count(*) AS reviews,
       {half_up("sum(steps)", "5 * count(*)", 3)} AS avg_sentiment_score,
       CASE WHEN count(rating) > 0 THEN {half_up("sum(rating)", "count(rating)", 2)} END AS avg_star_rating,
       count(key_issue) AS flagged_issues
FROM classified JOIN reviews USING (review_id) GROUP BY city, topic, sentiment_label
"""

REPLIES = """
replies AS (
  SELECT doc_id AS review_id, source,
         CASE WHEN quality IS NULL THEN 'bad sentiment_label' WHEN quality = 0 THEN 'bad sentiment_label'
              WHEN toxic = 1 THEN 'bad sentiment_score' END AS error_kind,
         CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN -1.5 ELSE 0.5 END AS score
  FROM documents LEFT JOIN labels USING (doc_id)
)"""
SQL["reply_validation"] = f"""
WITH {REPLIES}
SELECT review_id, CASE WHEN error_kind IS NULL THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, error_kind,
       CAST(score AS DOUBLE) AS sentiment_score, CAST(NULL AS VARCHAR) AS key_issue
FROM replies
"""
SQL["enrichment_gate"] = f"""
WITH {REPLIES}
SELECT source AS batch_id, count(*) - count(error_kind) AS succeeded, count(error_kind) AS failed,
       {half_up("count(error_kind)", "count(*)", 3)} AS failure_rate, 5 * count(error_kind) > count(*) AS blocked
FROM replies GROUP BY source
"""

SQL["enrichment_summary"] = f"""
WITH {SCRUBBED}
SELECT source AS batch_id, count(*) AS succeeded, CAST(0 AS BIGINT) AS failed, CAST(0 AS DOUBLE) AS failure_rate,
       CAST(sum({labels_in("clean")} - {labels_in("raw")}) AS BIGINT) AS pii_redacted_count
FROM scrubbed GROUP BY source
"""

SQL["enrichment_batch"] = f"""
WITH {SCRUBBED},
attempts AS (
  SELECT *, contains(clean, 'license') AS refused, {labels_in("clean")} - {labels_in("raw")} AS pii_redacted_count
  FROM scrubbed, (VALUES (1), (2)) AS t(attempt_number)
)
SELECT 'b-' || attempt_number AS batch_id, doc_id AS review_id, attempt_number,
       CASE WHEN refused THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
       CASE WHEN refused THEN 'refused' END AS error_message, 'm' AS model_name,
       CASE WHEN NOT refused THEN 'm-1' END AS model_version, 'v1' AS prompt_version, pii_redacted_count
FROM attempts WHERE refused OR attempt_number = 1
"""

# --- retrieval ----------------------------------------------------------------

NEAREST = """
numbers AS (
  SELECT label, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings
),
centroids AS (
  SELECT label AS query_id, list(x ORDER BY pos) AS vector
  FROM (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM numbers GROUP BY label, pos) GROUP BY label
),
scored AS (
  SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vector), 12) AS score
  FROM embeddings, centroids
),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored QUALIFY rank <= 5
)"""
SQL["embedding_topk"] = f"""
WITH {NEAREST} SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM nearest
"""
SQL["context_assembly"] = f"""
WITH {NEAREST}, {REVIEWS}
SELECT query_id, count(*) AS n_sources,
       string_agg(' (' || coalesce(city, 'None') || ', ' || coalesce(CAST(rating AS VARCHAR), 'None') || ' stars) '
                  || comment, chr(10) ORDER BY rank) AS context
FROM nearest JOIN reviews ON review_id = vec_id GROUP BY query_id
"""
SQL["enrichment_success"] = """
SELECT doc_id AS review_id, 'b-1' AS batch_id, 'neutral' AS sentiment_label, CAST(0 AS DOUBLE) AS sentiment_score,
       'other' AS topic, CAST(NULL AS VARCHAR) AS key_issue, 'm' AS model_name, 'm-1' AS model_version,
       'v2' AS prompt_version
FROM documents WHERE text NOT LIKE '%license%'
"""


def snapped(text: str, planned: str) -> str:
    """Where a cut planned at an offset of a text lies: behind the last sentence end shortly before it, if any."""
    tail = f"substring({text}, {planned} - {WINDOWS.slack} + 1, {WINDOWS.slack})"
    end = f"length(regexp_extract({tail}, '^(?s:.*)([.!?][ \\t\\r]|\\n)'))"
    return f"CASE WHEN {end} > 0 THEN {planned} - {WINDOWS.slack} + {end} ELSE {planned} END"


SQL["chunk_windows"] = f"""
WITH planned AS (
  SELECT doc_id, text, unnest(range(greatest(1, CAST(ceil((length(text) - {WINDOWS.overlap}) / {WINDOWS.step}) AS BIGINT)))) AS no
  FROM documents WHERE text IS NOT NULL
), ends AS (
  SELECT doc_id, text, no, no * {WINDOWS.step} AS a, no * {WINDOWS.step} + {WINDOWS.size} AS b FROM planned
), cuts AS (
  SELECT doc_id, text, no, CASE WHEN no = 0 THEN 0 ELSE {snapped("text", "a")} END AS a,
         CASE WHEN b >= length(text) THEN length(text) ELSE {snapped("text", "b")} END AS b
  FROM ends
)
SELECT doc_id || '#' || no AS chunk_id, doc_id, a || '-' || b AS chars, sha256(substring(text, a + 1, b - a)) AS content_hash
FROM cuts
"""
SQL["review_sample"] = f"""
WITH {REVIEWS}
SELECT CAST(review_id AS VARCHAR) AS doc_id, CAST(review_date AS VARCHAR) AS review_date FROM reviews
ORDER BY md5('7|' || review_id), review_id LIMIT 500
"""
SQL["embed_cache_misses"] = """
SELECT sha256(text) AS content_hash, CAST(length(any_value(text)) AS INTEGER) AS n_chars FROM documents
GROUP BY text HAVING sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'en')
"""
SQL["embed_reviews"] = """
SELECT CAST(doc_id AS VARCHAR) AS chunk_id, sha256(text) AS content_hash,
       list_aggregate(list_transform(range(26), lambda i: CAST(
           2 * length(text) - length(replace(text, chr(97 + i::INT), '')) - length(replace(text, chr(65 + i::INT), ''))
           AS VARCHAR)), 'string_agg', ' ') AS numbers
FROM documents
"""
SQL["review_retrieval"] = f"""
WITH {REVIEWS}, questions(query_id, question) AS (
  VALUES (0, 'license and permission'), (1, 'who is it for')
), texts AS (
  SELECT review_id, comment, city, rating, list_transform(range(26), lambda i: CAST(
           2 * length(comment) - length(replace(comment, chr(97 + i::INT), ''))
           - length(replace(comment, chr(65 + i::INT), '')) AS DOUBLE)) AS v
  FROM reviews WHERE comment IS NOT NULL
), asked AS (
  SELECT query_id, list_transform(range(26), lambda i: CAST(
           2 * length(question) - length(replace(question, chr(97 + i::INT), ''))
           - length(replace(question, chr(65 + i::INT), '')) AS DOUBLE)) AS w
  FROM questions
), scored AS (
  SELECT query_id, review_id, comment, city, rating,
         CASE WHEN list_sum(v) = 0 THEN 0
              ELSE round(list_dot_product(v, w) / sqrt(list_dot_product(v, v)) / sqrt(list_dot_product(w, w)), 12) END AS score
  FROM texts, asked
), best AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, CAST(review_id AS VARCHAR)) AS rank FROM scored
)
SELECT CAST(query_id AS INTEGER) AS query_id, count(*) AS n_sources,
       string_agg(' (' || coalesce(city, 'None') || ', ' || coalesce(CAST(rating AS VARCHAR), 'None') || ' stars) '
                  || comment, chr(10) ORDER BY rank) AS context
FROM best WHERE rank <= 5 GROUP BY query_id
"""
SQL["vector_upsert"] = """
SELECT CAST(vec_id AS VARCHAR) AS chunk_id, CASE WHEN label >= 5 THEN 'second' ELSE 'first' END AS text, label
FROM embeddings
"""

# --- loads --------------------------------------------------------------------


def row_hash(*fields: str) -> str:
    return f"md5(concat_ws(chr(1), {', '.join(text(f) for f in fields)}))"


SQL["record_hash_items"] = f"""
WITH {ITEMS}
SELECT CAST(order_item_id AS VARCHAR) AS order_item_id,
       {row_hash("order_item_id", "order_id", "restaurant_id", "f_id", "price", "quantity", "price")} AS _record_hash
FROM lines
"""

REVIEW_FIELDS = ("doc_id", "doc_id", "doc_id", "regexp_extract(source, '[0-9]+')", "rating", "comment", "review_date")
SQL["csv_load"] = f"""
WITH loads AS (
  SELECT *, coalesce(CAST(quality * 3 + 2 AS VARCHAR), 'none') AS rating, text AS comment
  FROM documents LEFT JOIN labels USING (doc_id)
  UNION ALL
  SELECT *, '4' AS rating, CASE WHEN quality = 1 THEN text END AS comment
  FROM documents JOIN labels USING (doc_id)
),
dated AS (SELECT *, DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS review_date FROM loads)
SELECT CAST(doc_id AS VARCHAR) AS review_id, rating, CAST(review_date AS VARCHAR) AS review_date,
       md5(comment) AS comment_md5, 'run-1' AS _batch_id, {row_hash(*REVIEW_FIELDS)} AS _record_hash
FROM dated
"""

SQL["csv_split_load"] = SQL["csv_load"]

SQL["ingestion_runs"] = """
WITH loaded AS (
  SELECT 'food' AS source, count(*) AS n FROM part
  UNION ALL SELECT 'menu', 2 * count(*) FROM part
  UNION ALL SELECT 'users', count(*) + count(*) FILTER (WHERE c_acctbal > 5000) FROM customer
)
SELECT 'run-1' AS run_id, source, 'SUCCEEDED' AS status, CAST(n AS BIGINT) AS row_count FROM loaded
UNION ALL SELECT 'run-2', source, 'SKIPPED_ALREADY_LOADED', 0 FROM loaded
"""

SQL["torn_load"] = """
WITH failed AS (SELECT 'a quoted field is still open at the end of the file' AS error_message)
SELECT 'run-1' AS run_id, 'SUCCEEDED' AS status, count(*) AS row_count, 0 AS failed_files, NULL AS error_message FROM part
UNION ALL SELECT 'run-2', 'SKIPPED_ALREADY_LOADED', 0, 0, NULL
UNION ALL SELECT 'run-1', 'FAILED', 0, 4, error_message FROM failed
UNION ALL SELECT 'run-2', 'FAILED', 0, 4, error_message FROM failed
"""

SQL["lineage_runs"] = """
SELECT 'run-1' AS run_id, 'restaurants' AS source, 'raw.restaurants' AS output_table, 'COMPLETE' AS state,
       count(*) AS row_count FROM supplier
UNION ALL SELECT 'run-1', 'food', 'raw.food', 'COMPLETE', count(*) FROM part
"""

VEG = "lower(p_type) || '-' || upper(p_brand)"
SQL["stream_load"] = f"""
SELECT 'fd' || p_partkey AS f_id, p_name AS item, 'run-1' AS _batch_id,
       {row_hash("NULL", "'fd' || p_partkey", "p_name", VEG)} AS _record_hash
FROM part
"""

SQL["stream_control"] = """
WITH n AS (SELECT count(*) AS n FROM part)
SELECT 'run-1' AS run_id, 'SUCCEEDED' AS status, n AS row_count, 0 AS failed_files, 'FAIL' AS state, n AS run_rows,
       n AS stored_rows FROM n
UNION ALL SELECT 'run-1', 'FAILED', 0, 4, 'FAIL', n, n FROM n
UNION ALL SELECT 'run-2', 'SKIPPED_ALREADY_LOADED', 0, 0, 'FAIL', 0, NULL
UNION ALL SELECT 'run-2', 'FAILED', 0, 4, 'FAIL', 0, NULL
"""

SQL["daily_run"] = """
SELECT 'run-1' AS run_id, 'SUCCESS' AS status, 'passed' AS dq_status, CAST(0 AS BIGINT) AS ai_fail_count,
       (SELECT count(*) FROM documents) AS ai_success_count,
       CAST((SELECT count(*) FROM supplier) + (SELECT count(*) FROM lineitem) + 3 * (SELECT count(*) FROM part)
       + (SELECT count(*) + count(*) FILTER (WHERE c_acctbal > 5000) FROM customer)
       + (SELECT count(*) + count(*) FILTER (WHERE o_orderstatus <> 'O') + count(*) FILTER (WHERE o_orderstatus = 'P')
          FROM orders)
       + (SELECT count(*) FROM documents) + (SELECT count(*) FROM labels) AS BIGINT) AS rows_ingested
"""

SQL["new_files"] = """
SELECT CAST(doc_id AS VARCHAR) AS file_name, source FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
"""

SQL["load_gate"] = """
WITH per_source AS (
  SELECT strftime(ts, '%Y-%m-%d %H') AS run_id, 's' || user_id AS source,
         count(*) FILTER (WHERE event_type <> 'view') AS n, bool_or(event_type = 'error') AS failed
  FROM events GROUP BY 1, 2
)
SELECT run_id, count(*) AS sources_loaded, CAST(sum(n) AS BIGINT) AS total_rows,
       coalesce(string_agg(source, ',' ORDER BY source) FILTER (WHERE failed), '') AS failed_sources
FROM per_source GROUP BY run_id
"""

SQL["centroid_similarity"] = f"""
WITH {NEAREST}
SELECT e.vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vector), 6) AS similarity
FROM embeddings e JOIN centroids ON query_id = label
"""

# The upper case of a sharp s is SS in one engine and a single letter in the other.
SQL["title_case_texts"] = f"""
SELECT doc_id, md5(replace({title_case("text")}, chr(7838), 'SS')) AS fingerprint FROM documents
"""

SQL["fact_orders_skipping"] = SQL["fact_orders_lookback"]

SQL["daily_two_days"] = f"""
WITH {HEADS}, mart AS ({REVENUE})
SELECT *, orders AS fact_rows, delivered_orders AS fact_delivered FROM mart
"""

SQL["embedding_ivf"] = """
WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings WHERE vec_id % 50 = 0),
scored AS (
  SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vector), 12) AS score
  FROM embeddings, q
)
SELECT query_id, vec_id, round(score, 6) AS score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, true AS recall_reached
FROM scored QUALIFY rank <= 5
"""

SQL["sla_sketch"] = f"""
WITH {TYPED}
SELECT city, count(delivery_time_min) AS n, true AS p50_within, true AS p90_within
FROM typed WHERE delivery_time_min IS NOT NULL GROUP BY city
"""

SQL["customers_rolling"] = """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, o_custkey FROM orders),
quarters AS (SELECT DISTINCT year(day) * 4 + quarter(day) AS q, o_custkey FROM days)
SELECT 'rolling' AS kind, CAST(e.day AS VARCHAR) AS period, count(DISTINCT d.o_custkey) AS exact, true AS within
FROM (SELECT DISTINCT day FROM days) e JOIN days d ON d.day BETWEEN e.day - 29 AND e.day GROUP BY e.day
UNION ALL
SELECT 'returning', CAST(a.q AS VARCHAR), count(b.o_custkey), true
FROM quarters a LEFT JOIN quarters b ON b.q = a.q - 1 AND b.o_custkey = a.o_custkey GROUP BY a.q
"""
