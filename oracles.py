"""SQL counterparts of the catalogue queries, for DuckDB over the same Parquet tables.

Written on their own from the meaning of each query: shared CTEs name the tables, every query
states its result. ``sql("a b", body)`` prefixes the CTEs a, b and what they need.
"""

from __future__ import annotations

# Fixed values of the word queries, kept apart from the package's own.
TOKEN_PATTERN = "([a-zA-Zá-úÁ-Ú]{3,})"
ACCENTED, PLAIN = "áâãäåçèéêëìíîïñòóôõöùú", "aaaaaceeeeiiiinooooouu"
STOP_WORDS = sorted(set((
    "a o as os um uma uns umas de do da dos das em no na nos nas por pra para com sem sob sobre e ou mas que se "
    "porque como quando onde qual quais eu tu ele ela vos eles elas voce voces meu minha seu sua este esta isso "
    "esse essa aquele aquela ao aos nao sim ja ainda muito muita muitos muitas mais menos bem mal tudo nada algum "
    "alguma todo toda todos todas ser estar ter fazer foi era estao sao tem tinha ficou chegou veio vou vai so ate "
    "depois antes agora comprei produto produtos compra loja entrega recebi recebido pedido item itens dia dias "
    "prazo data "
    "the and for are but not you all any can had her was one our out has him his how its may now she too use who "
    "why did get let per than that this with have from they been were will would there their what when where which "
    "while your about after again also because before being below between both could does doing down during each "
    "few further here hers into just more most myself nor off once only other over own same should some such them "
    "then these those through under until very yours "
).split()))

AS_OF = "TIMESTAMP '2001-09-01 00:00:00'"
CUT1 = "TIMESTAMP '2024-01-15 00:00:00'"
CUT2 = "TIMESTAMP '2024-02-01 00:00:00'"

CTES: dict[str, tuple[str, str]] = {
    "o": ("", """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
          CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'processing' END AS order_status,
          o_orderdate + to_minutes(o_orderkey % 1440) AS purchase_ts,
          o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) + to_minutes(o_orderkey % 1440) AS approved_ts,
          o_orderdate + to_days(CAST(o_orderkey % 3 + o_custkey % 5 AS INTEGER)) + to_hours(12) AS carrier_ts,
          CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 97 <> 0
            THEN o_orderdate + to_days(CAST((o_orderkey + o_custkey) % 62 - 2 AS INTEGER)) + to_hours(18) END AS delivered_ts,
          o_orderdate + INTERVAL 30 DAY AS estimated_ts
        FROM orders"""),
    "i_raw": ("", """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_partkey AS product_id,
          l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
          CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight_value
        FROM lineitem"""),
    "i": ("i_raw", """
        SELECT * FROM i_raw QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
          ORDER BY shipping_limit_date DESC NULLS LAST, product_id, seller_id, price, freight_value) = 1"""),
    "p": ("", """
        SELECT order_id, seq AS payment_sequential,
          CASE WHEN seq > 1 THEN 'voucher' ELSE first_type END AS payment_type,
          1 + (order_id + seq) % 10 AS payment_installments,
          CAST(CAST(CASE WHEN seq = 1 THEN cents - (parts - 1) * (cents // parts) ELSE cents // parts END AS DOUBLE) / 100
            AS DECIMAL(12,2)) AS payment_value
        FROM (SELECT o_orderkey AS order_id, o_orderkey % 4 AS parts, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
                CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
                  WHEN '3-MEDIUM' THEN 'voucher' WHEN '5-LOW' THEN 'debit_card' END AS first_type,
                unnest(generate_series(1, o_orderkey % 4)) AS seq
              FROM orders WHERE o_orderkey % 4 > 0)"""),
    "lp": ("p", "SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY payment_sequential DESC) = 1"),
    "r_raw": ("", """
        SELECT CASE WHEN event_id % 10 = 9 THEN event_id - 1 ELSE event_id END AS review_id, event_id // 2 AS order_id,
          CAST(1 + CAST(round(value * 100) AS BIGINT) % 5 AS INTEGER) AS review_score, event_type AS review_comment_title,
          CASE WHEN event_type = 'error' THEN ' ' ELSE props END AS review_comment_message,
          CAST(CAST(ts AS DATE) AS TIMESTAMP) AS review_creation_date, ts AS review_answer_timestamp
        FROM events"""),
    "r": ("r_raw", "SELECT * FROM r_raw QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY review_answer_timestamp DESC) = 1"),
    "lr": ("r", "SELECT order_id, review_score FROM r QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC, review_id DESC) = 1"),
    "c": ("", """
        SELECT c_custkey AS customer_id, c_custkey // 2 AS customer_unique_id,
          lpad(CAST(c_custkey // 3 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
          lower(c_mktsegment) AS customer_city, n_name AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""),
    "pr": ("", """
        SELECT p_partkey AS product_id, lower(p_type) AS product_category_name,
          CAST(length(p_name) AS INTEGER) AS name_length,
          CASE WHEN p_size % 7 <> 0 THEN p_size * 100 END AS product_weight_g, p_size AS product_length_cm,
          p_size % 10 + 1 AS product_height_cm, p_size % 4 + 1 AS product_width_cm,
          CASE p_type WHEN 'ECONOMY' THEN 'budget_goods' WHEN 'LARGE' THEN 'large_goods' WHEN 'PROMO' THEN 'promotion'
            WHEN 'SMALL' THEN 'small_goods' WHEN 'STANDARD' THEN 'standard_goods' END AS product_category
        FROM part"""),
    "s": ("", """
        SELECT s_suppkey AS seller_id, lpad(CAST(s_suppkey * 7 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
          'city ' || CAST(s_suppkey % 11 AS VARCHAR) AS seller_city, n_name AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""),
    "g": ("", """
        SELECT lpad(CAST(c_custkey // 3 AS VARCHAR), 5, '0') AS zip_code_prefix, CAST(c_acctbal AS DECIMAL(12,2)) AS lat,
          CAST(-c_acctbal AS DECIMAL(12,2)) AS lng, lower(c_mktsegment) AS city, n_name AS state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""),
    "gz": ("g", """
        SELECT zip_code_prefix, CAST(sum(lat) AS DOUBLE) / count(lat) AS avg_lat, CAST(sum(lng) AS DOUBLE) / count(lng) AS avg_lng,
          count(*) AS n_points FROM g GROUP BY 1"""),
    "f": ("o i lp", f"""
        SELECT o.order_id AS id, o.customer_id, o.order_status, o.purchase_ts AS order_purchase_timestamp,
          o.approved_ts AS order_approved_at, o.carrier_ts AS order_delivered_carrier_date,
          o.delivered_ts AS order_delivered_customer_date, o.estimated_ts AS order_estimated_delivery_date,
          i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
          CASE WHEN i.price > 0 THEN i.price END AS price, CASE WHEN i.freight_value >= 0 THEN i.freight_value END AS freight_value,
          lp.payment_sequential, coalesce(lp.payment_type, 'not_defined') AS payment_type, lp.payment_installments, lp.payment_value,
          coalesce(o.delivered_ts < o.purchase_ts, false) AS has_invalid_delivery_date,
          {AS_OF} > o.estimated_ts AND o.delivered_ts IS NULL AS is_overdue_delivery,
          coalesce(i.price > 10000, false) AS is_high_value_product,
          o.order_status = 'delivered' AND o.delivered_ts IS NULL AS has_missing_delivery_date,
          coalesce(date_diff('day', o.purchase_ts, o.delivered_ts) > 30, false) AS is_long_delivery,
          lp.payment_type IS NULL OR lp.payment_value IS NULL AS has_missing_payment_info,
          i.order_item_id IS NULL AS has_no_items
        FROM o LEFT JOIN i USING (order_id) LEFT JOIN lp USING (order_id)"""),
    "io": ("i", """
        SELECT order_id, CAST(sum(price) AS DOUBLE) AS gmv, CAST(sum(freight_value) AS DOUBLE) AS freight, count(*) AS n_items
        FROM i GROUP BY 1"""),
    "b": ("o io lp lr c", """
        SELECT o.order_id, o.customer_id, o.order_status, o.purchase_ts, CAST(date_trunc('month', o.purchase_ts) AS DATE) AS order_month,
          o.delivered_ts, o.estimated_ts, date_diff('day', o.purchase_ts, o.delivered_ts) AS delivery_days,
          date_diff('day', o.estimated_ts, o.delivered_ts) AS days_vs_estimate,
          io.gmv, io.freight, coalesce(io.n_items, 1) AS n_items, coalesce(lp.payment_type, 'not_defined') AS payment_type,
          lp.payment_installments, lr.review_score, c.customer_unique_id, c.customer_state
        FROM o LEFT JOIN io USING (order_id) LEFT JOIN lp USING (order_id) LEFT JOIN lr USING (order_id)
          LEFT JOIN c ON o.customer_id = c.customer_id"""),
    "e": ("b", """
        SELECT b.*, order_status = 'delivered' AS is_delivered, days_vs_estimate > 0 AS is_late,
          CASE WHEN days_vs_estimate <= 0 THEN '1 · Early / on-time' WHEN days_vs_estimate <= 3 THEN '2 · 1-3 days late'
            WHEN days_vs_estimate <= 7 THEN '3 · 4-7 days late' WHEN days_vs_estimate > 7 THEN '4 · 8+ days late' END AS delivery_bucket,
          CASE WHEN review_score <= 2 THEN '1-2 ★ detractor' WHEN review_score = 3 THEN '3 ★ passive'
            WHEN review_score >= 4 THEN '4-5 ★ promoter' END AS review_bucket,
          CAST(row_number() OVER (PARTITION BY customer_unique_id ORDER BY purchase_ts, order_id) AS INTEGER) AS order_seq,
          count(*) OVER (PARTITION BY customer_unique_id) AS cust_total_orders,
          min(order_month) OVER (PARTITION BY customer_unique_id) AS cohort_month
        FROM b"""),
    "h": ("e", "SELECT *, order_seq > 1 AS is_repeat_order, order_seq < cust_total_orders AS has_subsequent_order FROM e"),
    "cat": ("o i pr c", """
        SELECT CAST(date_trunc('month', o.purchase_ts) AS DATE) AS order_month, c.customer_state,
          coalesce(pr.product_category, 'unknown') AS product_category, CAST(sum(i.price) AS DOUBLE) AS gmv, count(*) AS n_items
        FROM o LEFT JOIN i USING (order_id) LEFT JOIN pr USING (product_id) LEFT JOIN c ON o.customer_id = c.customer_id
        GROUP BY ALL"""),
    "v": ("b", """
        SELECT customer_unique_id, min(customer_state) AS customer_state, count(*) AS frequency, round(sum(gmv), 2) AS monetary,
          date_diff('day', max(purchase_ts), (SELECT max(purchase_ts) FROM b)) AS recency_days,
          CAST(min(purchase_ts) AS DATE) AS first_order_date, CAST(date_trunc('month', min(purchase_ts)) AS DATE) AS cohort_month
        FROM b GROUP BY 1"""),
    "vs": ("v", """
        SELECT v.*, frequency > 1 AS is_repeat_customer,
          CASE WHEN frequency >= 5 THEN '5+' ELSE CAST(frequency AS VARCHAR) END AS orders_placed_bucket,
          CASE WHEN frequency >= 2 AND recency_days <= 120 THEN 'Champions / Loyal' WHEN frequency >= 2 THEN 'Lapsing repeat'
            WHEN recency_days <= 90 THEN 'New / recent (one-off)' WHEN recency_days <= 240 THEN 'Cooling one-off'
            ELSE 'Dormant one-off' END AS segment
        FROM v"""),
    "co": ("e", """
        SELECT cohort_month, CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS INTEGER) AS months_since,
          count(DISTINCT customer_unique_id) AS active_customers
        FROM e GROUP BY ALL"""),
    "cl": ("co", """
        SELECT co.*, z.active_customers AS cohort_size, co.active_customers / CAST(z.active_customers AS DOUBLE) AS retention
        FROM co JOIN co z ON co.cohort_month = z.cohort_month AND z.months_since = 0"""),
    "rb": ("b", """
        SELECT customer_unique_id, count(*) AS frequency, round(coalesce(sum(gmv), 0), 2) AS monetary,
          CAST(floor((epoch_us((SELECT max(purchase_ts) FROM b)) - epoch_us(max(purchase_ts))) / 86400000000.0) AS BIGINT) + 1 AS recency
        FROM b WHERE customer_unique_id IS NOT NULL GROUP BY 1"""),
    "u1": ("", f"""
        SELECT user_id, event_type, ts AS updated_at FROM events WHERE ts <= {CUT1}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""),
    "u2": ("", f"""
        SELECT user_id, event_type, ts AS updated_at FROM events WHERE ts <= {CUT2}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""),
    "d": ("", """
        SELECT doc_id, text, lang, CASE WHEN quality = 1 THEN 5 WHEN quality = 0 THEN 1 END AS review_score
        FROM documents LEFT JOIN labels USING (doc_id)"""),
    "tk": ("", f"""
        SELECT doc_id, lang, list_filter(list_transform(regexp_extract_all(lower(text), '{TOKEN_PATTERN}'),
            lambda x: translate(x, '{ACCENTED}', '{PLAIN}')),
          lambda w: NOT list_contains([{', '.join(repr(w) for w in STOP_WORDS)}], w)) AS words
        FROM documents"""),
    "w": ("tk", "SELECT doc_id, lang, unnest(words) AS term FROM tk"),
    "tx": ("r", """
        SELECT review_id, order_id, review_score, nullif(trim(review_comment_title), '') AS title,
          nullif(trim(review_comment_message), '') AS message,
          nullif(concat_ws(' ', nullif(trim(review_comment_title), ''), nullif(trim(review_comment_message), '')), '') AS text,
          CAST(date_trunc('month', review_answer_timestamp) AS DATE) AS answer_month
        FROM r"""),
}


def sql(ctes: str, body: str) -> str:
    done: dict[str, str] = {}

    def need(name: str) -> None:
        if name not in done:
            deps, text = CTES[name]
            for d in deps.split():
                need(d)
            done[name] = text

    for name in ctes.split():
        need(name)
    if not done:
        return body
    body = body.strip()
    joint = ",\n" if body.startswith("WITH ") else "\n"
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in done.items()) + joint + body.removeprefix("WITH ")


def r2(x: str, digits: int = 2) -> str:
    """Round half up on the decimal reading of a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def avg(x: str) -> str:
    """Mean from an exact sum."""
    return f"CAST(sum({x}) AS DOUBLE) / count({x})"


def rate(flag: str) -> str:
    return f"avg(CAST({flag} AS INTEGER))"


def bucket(value: str, q: int) -> str:
    """Equal-size buckets of a first-come rank, as quantile cuts of ranks give them."""
    rank = f"row_number() OVER (ORDER BY {value}, customer_unique_id)"
    return f"CAST(greatest(1, ceil(({rank} - 1) * {q} / CAST(greatest(count(*) OVER () - 1, 1) AS DOUBLE))) AS INTEGER)"


def rfm(q: int) -> str:
    """Scored customers; recency cut at interpolated quantiles, ties together."""
    edges = ", ".join(f"quantile_cont(recency, {k / q}) AS e{k}" for k in range(1, q))
    case = "CASE " + " ".join(f"WHEN recency <= e{k} THEN {q + 1 - k}" for k in range(1, q)) + " ELSE 1 END"
    return f"""(SELECT rb.*, {case} AS r_score, {bucket('frequency', q)} AS f_score, {bucket('monetary', q)} AS m_score
        FROM rb, (SELECT {edges} FROM rb))"""


QUINTILE_SEGMENT = """CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions' WHEN r_score >= 4 AND f_score <= 2 THEN 'New / promising'
    WHEN r_score <= 2 AND m_score >= 4 THEN 'At-risk high-value' WHEN r_score <= 2 THEN 'Lost / dormant' ELSE 'Need attention' END"""

STATES = [f"NATION_{i}" for i in range(25)]
O: dict[str, str] = {}

# Loading
_counts = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}" for n, t in (
    ("customers", "c"), ("orders", "o"), ("order_items", "i_raw"), ("order_payments", "p"), ("order_reviews", "r_raw"),
    ("products", "pr"), ("sellers", "s")))
O["table_counts"] = sql("c o i_raw p r_raw pr s", _counts)
O["row_reconcile"] = sql("c o i_raw i p r_raw r pr s", " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, (SELECT count(*) FROM {a}) AS src_rows, (SELECT count(*) FROM {b}) AS tgt_rows,
        CASE WHEN (SELECT count(*) FROM {a}) = (SELECT count(*) FROM {b}) THEN 'exact'
          WHEN (SELECT count(*) FROM {a}) < (SELECT count(*) FROM {b}) THEN 'appended' ELSE 'SHORT' END AS status"""
    for n, a, b in (("orders", "o", "o"), ("order_items", "i_raw", "i"), ("order_payments", "p", "p"),
                    ("order_reviews", "r_raw", "r"), ("customers", "c", "c"), ("products", "pr", "pr"), ("sellers", "s", "s"))))
O["audit_stamped"] = sql("c", """SELECT *, TIMESTAMP '2024-01-01 20:00:00' AS created_at, TIMESTAMP '2024-01-01 20:00:00' AS updated_at,
    false AS is_deleted, 'customers.csv' AS source_file, 'batch_1' AS batch_name FROM c""")
O["upsert_result"] = sql("u1", f"""
    SELECT coalesce(u1.user_id, n.user_id) AS user_id,
      CASE WHEN n.user_id IS NOT NULL THEN nullif(n.event_type, 'error') ELSE u1.event_type END AS event_type,
      coalesce(n.ts, u1.updated_at) AS updated_at, coalesce(u1.updated_at, n.ts) AS created_at
    FROM u1 FULL JOIN (SELECT * FROM events WHERE ts > {CUT1}
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) n ON u1.user_id = n.user_id""")
O["increment_rows"] = f"SELECT CAST(ts AS DATE) AS day, count(*) AS n, max(ts) AS bookmark FROM events WHERE ts > {CUT1} GROUP BY 1"
O["flatten_json"] = "SELECT event_id, CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS BIGINT) AS props__k FROM events"
O["child_rows"] = sql("o i", "SELECT order_id, order_item_id, product_id FROM i WHERE order_id IN (SELECT order_id FROM o)")
O["landing_names"] = """
    SELECT page_id, CASE WHEN n = '' THEN 'uploaded_table' WHEN regexp_matches(n, '^[0-9]') THEN 't_' || n ELSE n END AS table_name
    FROM (SELECT page_id, trim(regexp_replace(CASE WHEN strpos(f, '.') > 1 THEN regexp_replace(f, '[.][^.]*$', '') ELSE f END,
      '[^a-z0-9]+', '_', 'g'), '_') AS n
      FROM (SELECT page_id, lower(list_last(string_split(trim(url), '/'))) AS f FROM pages))"""
O["csv_round_trip"] = sql("r_raw", "SELECT review_id, order_id, review_score, review_comment_title, review_comment_message FROM r_raw")
O["json_lines_round_trip"] = sql("s", "SELECT * FROM s")
O["stored_result"] = sql("o", "SELECT CAST(date_trunc('month', purchase_ts) AS DATE) AS order_month, count(*) AS orders FROM o GROUP BY 1")
O["stream_upsert"] = """SELECT user_id, event_id, event_type, ts AS updated_at FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""
O["stream_append"] = "SELECT event_type, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY 1"

O["layer_rebuild"] = sql("f c s o pr", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {x}" for n, x in (
        ("fact_orders", "f"), ("dim_customers", "c"), ("dim_sellers", "s"), ("dim_products", "pr"), ("orders_enriched", "o")))
    + " UNION ALL SELECT 'dim_date', date_diff('day', min(purchase_ts), max(estimated_ts)) + 1 FROM o")

# Cleaning
O["clean_columns"] = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS type, upper(p_name) AS name,
      CASE WHEN p_brand <> 'Brand#1' THEN p_brand END AS brand, p_size > 25 AS is_big,
      CASE WHEN p_type = 'PROMO' THEN 'unknown' ELSE p_type END AS type_or_default,
      CASE WHEN p_retailprice >= 1000 THEN 'high_value' WHEN p_retailprice >= 100 THEN 'medium_value'
        WHEN p_retailprice > 0 THEN 'low_value' ELSE 'no_amount' END AS tier
    FROM part"""
O["strip_text"] = "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"
O["safe_casts"] = """
    SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS rank_no,
      TRY_CAST(split_part(o_orderpriority, '-', 2) AS INTEGER) AS not_a_number, o_orderdate AS parsed,
      CAST(NULL AS TIMESTAMP) AS unparsed FROM orders"""
O["numeric_clean"] = """
    SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal END AS clamped,
      CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive, CASE WHEN c_nationkey NOT IN (0, 7) THEN c_nationkey END AS nation_or_null,
      lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip FROM customer"""
O["complete_rows"] = sql("pr", """SELECT product_id, product_weight_g IS NOT NULL AS is_complete, coalesce(product_weight_g, 0) AS weight_or_zero,
    CASE WHEN product_weight_g IS NOT NULL THEN product_length_cm END AS product_length_cm FROM pr""")
O["null_fill_median"] = sql("pr", """SELECT product_id, CAST(coalesce(product_weight_g, (SELECT quantile_cont(product_weight_g, 0.5) FROM pr)) AS DOUBLE) AS product_weight_g,
    CAST(product_weight_g IS NULL AS INTEGER) AS product_weight_g_is_null_flag FROM pr""")
O["null_fill_mode"] = sql("p", """SELECT order_id, payment_sequential, CAST(payment_type IS NULL AS INTEGER) AS payment_type_is_null_flag,
    coalesce(payment_type, (SELECT payment_type FROM p WHERE payment_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS payment_type FROM p""")
O["cleaned_table"] = """
    WITH a AS (SELECT o_orderkey AS order_id, o_custkey AS customer, nullif(o_orderpriority, '4-NOT SPECIFIED') AS category,
        CASE WHEN o_totalprice > 20000 THEN o_totalprice END AS amount, o_orderdate AS ordered_at,
        o_orderdate + to_days(CAST(o_orderkey % 3 - 1 AS INTEGER)) AS created_at FROM orders),
    m AS (SELECT a.order_id, customer, ordered_at, created_at, CAST(a.amount IS NULL AS INTEGER) AS amount_is_null_flag,
        CAST(category IS NULL AS INTEGER) AS category_is_null_flag,
        coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM a)) AS amount,
        coalesce(category, (SELECT category FROM a WHERE category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS category FROM a)
    SELECT m.*, CASE WHEN amount >= 1000 THEN 'high_value' WHEN amount >= 100 THEN 'medium_value' WHEN amount > 0 THEN 'low_value' ELSE 'no_amount' END AS value_tier,
      created_at <= ordered_at AS is_valid_timeline, amount > (SELECT quantile_cont(amount, 0.99) FROM m) AS is_potential_outlier FROM m"""
O["order_slice"] = sql("b", """SELECT order_month, customer_state, count(*) AS orders, round(sum(gmv), 2) AS gmv FROM b
    WHERE order_month BETWEEN DATE '1996-03-01' AND DATE '1998-08-01'
      AND customer_state IN ('NATION_0','NATION_1','NATION_2','NATION_3','NATION_4') GROUP BY 1, 2""")
O["month_bounds"] = sql("b", "SELECT min(order_month) AS first_month, max(order_month) AS last_month FROM b")
O["state_list"] = sql("b", "SELECT DISTINCT customer_state FROM b WHERE customer_state IS NOT NULL")
O["place_override"] = sql("s g", """
    SELECT seller_id, seller_zip_code_prefix, coalesce(city, seller_city) AS seller_city, coalesce(state, seller_state) AS seller_state,
      z.zip_code_prefix IS NOT NULL AS zip_codes_match
    FROM s LEFT JOIN (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY lat DESC, city, state) = 1) z
      ON seller_zip_code_prefix = z.zip_code_prefix""")

# De-duplication
O["dedup_latest"] = sql("r", "SELECT * FROM r")
O["dedup_composite"] = sql("i", "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value) FROM i")
O["dedup_any"] = sql("g", """SELECT * REPLACE (CAST(lat AS DOUBLE) AS lat, CAST(lng AS DOUBLE) AS lng) FROM g
    QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY lat, lng, city, state) = 1""")
O["dedup_many_columns"] = """SELECT user_id, event_type, value, ts, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, ts DESC, event_id) = 1"""
O["last_payment"] = sql("lp", "SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM lp")
O["distinct_places"] = sql("g", "SELECT DISTINCT city, state FROM g")
O["dup_audit"] = sql("o i_raw p r_raw c", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{', '.join(k)}' AS key_columns, count(*) AS n_rows, count(DISTINCT ({', '.join(k)})) AS n_keys, "
    f"count(*) - count(DISTINCT ({', '.join(k)})) AS n_surplus FROM {t}"
    for n, t, k in (("orders", "o", ["order_id"]), ("order_items", "i_raw", ["order_id", "order_item_id"]),
                    ("order_payments", "p", ["order_id", "payment_sequential"]), ("order_reviews", "r_raw", ["review_id"]),
                    ("customers", "c", ["customer_id"]))))
O["full_row_duplicates"] = """SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS n_keys,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS n_surplus FROM documents"""
O["dropped_duplicates"] = sql("i_raw i", """SELECT order_item_id, a.n - b.n AS n FROM (SELECT order_item_id, count(*) AS n FROM i_raw GROUP BY 1) a
    JOIN (SELECT order_item_id, count(*) AS n FROM i GROUP BY 1) b USING (order_item_id) WHERE a.n > b.n""")

# Star schema
_money3 = "CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value"
O["fact_orders"] = sql("f", f"SELECT * REPLACE ({_money3}, CAST(payment_value AS DOUBLE) AS payment_value) FROM f")
O["fact_orders_summed"] = sql("o p", """SELECT order_status, count(*) AS orders, CAST(sum(paid) AS DOUBLE) AS paid
    FROM o LEFT JOIN (SELECT order_id, sum(payment_value) AS paid FROM p GROUP BY 1) USING (order_id) GROUP BY 1""")
FLAGS = ("has_invalid_delivery_date", "is_overdue_delivery", "is_high_value_product", "has_missing_delivery_date",
         "is_long_delivery", "has_missing_payment_info", "has_no_items")
O["dq_flags"] = sql("f", "SELECT order_status, count(*) AS rows, " + ", ".join(f"count(*) FILTER ({x}) AS {x}" for x in FLAGS) + " FROM f GROUP BY 1")
O["fact_sales_alloc"] = sql("o i p r", f"""
    SELECT md5(CAST(order_id AS VARCHAR) || '-' || CAST(order_item_id AS VARCHAR)) AS sales_key, order_id, order_item_id, customer_id,
      product_id, seller_id, order_status, CAST(strftime(purchase_ts, '%Y%m%d') AS INTEGER) AS purchase_date_key,
      CAST(strftime(approved_ts, '%Y%m%d') AS INTEGER) AS approved_date_key,
      CAST(strftime(delivered_ts, '%Y%m%d') AS INTEGER) AS delivered_customer_date_key,
      CAST(strftime(estimated_ts, '%Y%m%d') AS INTEGER) AS estimated_delivery_date_key,
      CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value, CAST(price + freight_value AS DOUBLE) AS total_sale_amount,
      pa.payment_record_count, pa.total_payment_value,
      round(CASE WHEN order_total > 0 THEN pa.total_payment_value * CAST(price + freight_value AS DOUBLE) / order_total END, 4) AS allocated_payment_value,
      pa.max_payment_installments, pa.payment_types, ra.*EXCLUDE (order_id),
      date_diff('day', purchase_ts, delivered_ts) AS delivery_days, date_diff('day', estimated_ts, delivered_ts) AS delivery_delay_days,
      delivered_ts > estimated_ts AS is_late_delivery
    FROM i JOIN o USING (order_id)
      LEFT JOIN (SELECT order_id, CAST(sum(price + freight_value) AS DOUBLE) AS order_total FROM i GROUP BY 1) USING (order_id)
      LEFT JOIN (SELECT order_id, count(*) AS payment_record_count, CAST(sum(payment_value) AS DOUBLE) AS total_payment_value,
          max(payment_installments) AS max_payment_installments,
          coalesce(array_to_string(list_sort(list(DISTINCT payment_type) FILTER (payment_type IS NOT NULL)), ', '), '') AS payment_types
        FROM p GROUP BY 1) pa USING (order_id)
      LEFT JOIN (SELECT order_id, count(*) AS review_record_count, avg(review_score) AS avg_review_score,
          max(review_score) AS max_review_score, min(review_score) AS min_review_score,
          bool_or(trim(review_comment_message) <> '') AS has_review_comment, max(review_creation_date) AS latest_review_creation_date,
          max(review_answer_timestamp) AS latest_review_answer_timestamp FROM r GROUP BY 1) ra USING (order_id)""")
O["order_lines"] = sql("o i", """
    SELECT md5(CAST(order_id AS VARCHAR) || '-' || CAST(order_item_id AS VARCHAR)) AS order_item_sk, md5(CAST(customer_id AS VARCHAR)) AS customer_sk,
      md5(CAST(product_id AS VARCHAR)) AS product_sk, order_id, order_item_id, CAST(price AS DOUBLE) AS price,
      CAST(freight_value AS DOUBLE) AS freight_value, CAST(price + freight_value AS DOUBLE) AS total_line_value,
      date_diff('day', purchase_ts, delivered_ts) AS delivery_lead_time_days FROM i JOIN o USING (order_id)""")
O["dim_customers"] = sql("c", "SELECT customer_id AS id, * EXCLUDE (customer_id) FROM c")
O["dim_sellers"] = sql("s gz", """SELECT seller_id AS id, seller_zip_code_prefix, seller_city, seller_state, avg_lat AS geo_lat, avg_lng AS geo_lng
    FROM s LEFT JOIN gz ON seller_zip_code_prefix = zip_code_prefix""")
O["dim_products"] = sql("pr", """
    SELECT md5(CAST(product_id AS VARCHAR) || '|2000-01-01 00:00:00.000000') AS surrogate_key, product_id, product_category,
      coalesce(product_category, product_category_name, 'unknown') AS category, product_weight_g, TIMESTAMP '2000-01-01' AS valid_from, CASE WHEN product_weight_g >= 2500 THEN TIMESTAMP '2000-06-01' END AS valid_to,
      NOT coalesce(product_weight_g >= 2500, false) AS is_current FROM pr
    UNION ALL SELECT md5(CAST(product_id AS VARCHAR) || '|2000-06-01 00:00:00.000000'), product_id, product_category,
      coalesce(product_category, product_category_name, 'unknown'), product_weight_g + 1000, TIMESTAMP '2000-06-01', NULL, true FROM pr WHERE product_weight_g >= 2500""")
O["current_product_sales"] = sql("i pr", """SELECT product_category_name, count(*) AS items, CAST(sum(price) AS DOUBLE) AS revenue,
    CAST(sum(CASE WHEN product_weight_g >= 2500 THEN product_weight_g + 1000 ELSE product_weight_g END) AS BIGINT) AS weight_g
    FROM i LEFT JOIN pr USING (product_id) GROUP BY 1""")
def _versions(source: str, key: str, ts: str, cols: list[str]) -> str:
    """Runs of equal states of a key in order of time: one row each, with the start of the next run."""
    names, order = ", ".join(cols), ", ".join([ts, *(f"{c} NULLS FIRST" for c in cols)])
    turn = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in cols)
    return f"""
    SELECT {key}, {names}, valid_from, last_seen, lead(valid_from) OVER v AS valid_to, lead(valid_from) OVER v IS NULL AS is_current
    FROM (SELECT {key}, run, {", ".join(f"any_value({c}) AS {c}" for c in cols)}, min({ts}) AS valid_from, max({ts}) AS last_seen
      FROM (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY {key} ORDER BY place) AS run
        FROM (SELECT {key}, {ts}, {names}, row_number() OVER w AS place, row_number() OVER w = 1 OR {turn} AS opens
          FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {order})))
      GROUP BY {key}, run)
    WINDOW v AS (PARTITION BY {key} ORDER BY run)"""


O["dim_reviews"] = sql("r_raw", "SELECT * EXCLUDE (last_seen) FROM (" + _versions(
    "r_raw", "review_id", "review_answer_timestamp", ["review_score", "review_comment_title", "review_comment_message"]) + ")")
O["dim_location"] = sql("g", """SELECT md5(zip_code_prefix || '-' || city || '-' || state) AS location_key, zip_code_prefix, city, state,
    CAST(sum(lat) AS DOUBLE) / count(lat) AS avg_lat, CAST(sum(lng) AS DOUBLE) / count(lng) AS avg_lng, count(*) AS n_points FROM g GROUP BY 2, 3, 4""")
O["dim_date"] = sql("o", """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
      CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
      CAST(strftime(d, '%U') AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
      CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT unnest(generate_series((SELECT CAST(min(purchase_ts) AS DATE) FROM o), (SELECT CAST(max(estimated_ts) AS DATE) FROM o), INTERVAL 1 DAY)) AS d)""")
O["analysis_orders"] = sql("o c p i r gz", """
    SELECT o.order_id, o.customer_id, customer_state, total_paid, total_items, total_price, total_freight, avg_review_score, avg_lat AS lat, avg_lng AS lng
    FROM o LEFT JOIN c ON o.customer_id = c.customer_id
      LEFT JOIN (SELECT order_id, CAST(sum(payment_value) AS DOUBLE) AS total_paid FROM p GROUP BY 1) a ON o.order_id = a.order_id
      LEFT JOIN (SELECT order_id, max(order_item_id) AS total_items, CAST(sum(price) AS DOUBLE) AS total_price, CAST(sum(freight_value) AS DOUBLE) AS total_freight FROM i GROUP BY 1) z ON o.order_id = z.order_id
      LEFT JOIN (SELECT order_id, avg(review_score) AS avg_review_score FROM r GROUP BY 1) q ON o.order_id = q.order_id
      LEFT JOIN gz ON customer_zip_code_prefix = zip_code_prefix""")
O["analysis_payments"] = sql("p o c", """SELECT p.* REPLACE (CAST(payment_value AS DOUBLE) AS payment_value), o.purchase_ts AS order_purchase_timestamp,
    o.customer_id, c.customer_state, c.customer_city FROM p LEFT JOIN o USING (order_id) LEFT JOIN c ON o.customer_id = c.customer_id""")
O["analysis_products"] = sql("i pr s o", """SELECT i.order_id, order_item_id, i.product_id, i.seller_id, product_category, seller_state, order_status,
    CAST(price AS DOUBLE) AS price, product_weight_g FROM i LEFT JOIN pr USING (product_id) LEFT JOIN s USING (seller_id) LEFT JOIN o USING (order_id)""")
O["denormalised"] = sql("o i p r c", """SELECT order_status, customer_state, count(*) AS rows, count(product_id) AS items, count(review_id) AS reviews, CAST(sum(price) AS DOUBLE) AS price
    FROM o LEFT JOIN i USING (order_id) LEFT JOIN p USING (order_id) LEFT JOIN r USING (order_id) LEFT JOIN c ON o.customer_id = c.customer_id GROUP BY 1, 2""")
O["monthly_revenue_mart"] = sql("f pr", """SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, coalesce(product_category, 'unknown') AS product_category,
    CAST(sum(price) AS DOUBLE) AS gmv, count(DISTINCT id) AS order_count FROM f LEFT JOIN pr USING (product_id) WHERE order_item_id IS NOT NULL GROUP BY 1, 2""")

# History
O["scd2_rebuild"] = _versions("events", "user_id", "ts", ["event_type"])
O["scd2_changes"] = """SELECT user_id, event_id, ts AS valid_from, event_type, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
O["scd2_current"] = """SELECT user_id, event_id, ts AS valid_from, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
_vid = lambda user, at: f"md5(CAST({user} AS VARCHAR) || '|' || strftime({at}, '%Y-%m-%d %H:%M:%S.%f'))"
O["scd2_check"] = sql("u1 u2", f"""
    SELECT u1.user_id, u1.event_type, u1.updated_at, {_vid('u1.user_id', CUT1)} AS version_id, {CUT1} AS valid_from,
      CASE WHEN u2.event_type IS DISTINCT FROM u1.event_type THEN {CUT2} END AS valid_to FROM u1 JOIN u2 USING (user_id)
    UNION ALL SELECT u2.user_id, u2.event_type, u2.updated_at, {_vid('u2.user_id', CUT2)}, {CUT2}, NULL
      FROM u2 LEFT JOIN u1 USING (user_id) WHERE u1.user_id IS NULL OR u1.event_type IS DISTINCT FROM u2.event_type""")
O["scd2_timestamp"] = sql("u1 u2", f"""
    SELECT u1.user_id, u1.event_type, u1.updated_at, {_vid('u1.user_id', 'u1.updated_at')} AS version_id, u1.updated_at AS valid_from,
      CASE WHEN u2.updated_at > u1.updated_at THEN u2.updated_at END AS valid_to FROM u1 JOIN u2 USING (user_id)
    UNION ALL SELECT u2.user_id, u2.event_type, u2.updated_at, {_vid('u2.user_id', 'u2.updated_at')}, u2.updated_at, NULL
      FROM u2 LEFT JOIN u1 USING (user_id) WHERE u1.user_id IS NULL OR u2.updated_at > u1.updated_at""")
O["scd2_hard_delete"] = sql("u1 u2", f"""
    SELECT u1.user_id, u1.event_type, u1.updated_at, {_vid('u1.user_id', CUT1)} AS version_id, {CUT1} AS valid_from,
      CASE WHEN u2.event_type = 'error' OR u2.event_type <> u1.event_type THEN {CUT2} END AS valid_to FROM u1 JOIN u2 USING (user_id)
    UNION ALL SELECT u2.user_id, u2.event_type, u2.updated_at, {_vid('u2.user_id', CUT2)}, {CUT2}, NULL
      FROM u2 LEFT JOIN u1 USING (user_id) WHERE u2.event_type <> 'error' AND (u1.user_id IS NULL OR u1.event_type <> u2.event_type)""")
O["latest_version"] = sql("r", "SELECT review_id, order_id, review_score, review_answer_timestamp FROM r")

# Aggregates
O["payments_rollup"] = sql("p", """SELECT order_id, count(*) AS payment_record_count, CAST(sum(payment_value) AS DOUBLE) AS total_payment_value,
    max(payment_installments) AS max_payment_installments,
    coalesce(array_to_string(list_sort(list(DISTINCT payment_type) FILTER (payment_type IS NOT NULL)), ', '), '') AS payment_types FROM p GROUP BY 1""")
O["reviews_rollup"] = sql("r", """SELECT order_id, count(*) AS review_record_count, avg(review_score) AS avg_review_score, max(review_score) AS max_review_score,
    min(review_score) AS min_review_score, bool_or(trim(review_comment_message) <> '') AS has_review_comment,
    max(review_creation_date) AS latest_review_creation_date, max(review_answer_timestamp) AS latest_review_answer_timestamp FROM r GROUP BY 1""")
O["geo_rollup"] = sql("g", """SELECT zip_code_prefix, city, state, CAST(sum(lat) AS DOUBLE) / count(lat) AS avg_lat, CAST(sum(lng) AS DOUBLE) / count(lng) AS avg_lng,
    count(*) AS n_points FROM g GROUP BY 1, 2, 3""")
O["mode_per_group"] = sql("p o", """SELECT customer_id, payment_type, n AS payment_type_count FROM
    (SELECT customer_id, payment_type, count(*) AS n FROM p JOIN o USING (order_id) WHERE payment_type IS NOT NULL GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, payment_type) = 1""")
O["null_share"] = sql("o p", "WITH j AS (SELECT o.*, p.payment_type, p.payment_value FROM o LEFT JOIN p USING (order_id)) " + " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) FILTER ({x} IS NULL) AS n_null, count(*) FILTER ({x} IS NULL) / CAST(count(*) AS DOUBLE) AS null_share FROM j"
    for n, x in (("order_status", "order_status"), ("order_approved_at", "approved_ts"), ("order_delivered_customer_date", "delivered_ts"),
                 ("payment_type", "payment_type"), ("payment_value", "payment_value"))))
O["value_counts"] = sql("p", "SELECT payment_type, count(*) AS n, count(*) / CAST((SELECT count(*) FROM p) AS DOUBLE) AS share FROM p GROUP BY 1")
O["describe_numeric"] = sql("i", " UNION ALL ".join(
    f"SELECT '{x}' AS column_name, count({x}) AS n, CAST(sum({x}) AS DOUBLE) / count({x}) AS mean, round(stddev_samp(CAST({x} AS DOUBLE)), 4) AS std, "
    f"CAST(min({x}) AS DOUBLE) AS min, CAST(max({x}) AS DOUBLE) AS max FROM i" for x in ("price", "freight_value", "order_item_id")))
O["describe_text"] = sql("o p", " UNION ALL ".join(
    f"""SELECT '{x}' AS column_name, count({x}) AS n, count(DISTINCT {x}) AS n_distinct,
      (SELECT {x} FROM o JOIN p USING (order_id) WHERE {x} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
      (SELECT count(*) FROM o JOIN p USING (order_id) WHERE {x} IS NOT NULL GROUP BY {x} ORDER BY count(*) DESC LIMIT 1) AS freq
      FROM o JOIN p USING (order_id)""" for x in ("order_status", "payment_type")))
O["status_pivot"] = sql("b", "SELECT order_month, " + ", ".join(
    f"count(*) FILTER (order_status = '{x}') AS {x}" for x in ("delivered", "shipped", "processing")) + " FROM b GROUP BY 1")
O["price_quartiles"] = sql("i", "SELECT " + ", ".join(f"quantile_cont(CAST(price AS DOUBLE), {q / 100}) AS p{q}" for q in (25, 50, 75, 99)) + " FROM i")
O["median_weight_by_category"] = sql("pr", "SELECT product_category_name, CAST(median(product_weight_g) AS DOUBLE) AS median_weight FROM pr GROUP BY 1")
O["weight_quartile_bands"] = sql("pr", """SELECT product_id, product_weight_g, CASE WHEN product_weight_g IS NULL THEN NULL WHEN product_weight_g <= e1 THEN 1
    WHEN product_weight_g <= e2 THEN 2 WHEN product_weight_g <= e3 THEN 3 ELSE 4 END AS band
    FROM pr, (SELECT quantile_cont(product_weight_g, 0.25) AS e1, quantile_cont(product_weight_g, 0.5) AS e2, quantile_cont(product_weight_g, 0.75) AS e3 FROM pr)""")
O["price_ranks"] = """SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS price_rank,
    CAST(greatest(1, ceil((row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1) * 10 / CAST(count(*) OVER () - 1 AS DOUBLE))) AS INTEGER) AS decile FROM part"""


def _ols(ctes: str, y: str, x: str, source: str) -> str:
    return sql(ctes, f"""SELECT CAST(regr_count({y}, {x}) AS BIGINT) AS n, round(regr_slope({y}, {x}), 6) AS slope,
      round(regr_intercept({y}, {x}), 6) AS intercept, round(regr_r2({y}, {x}), 6) AS r2, round(corr({y}, {x}), 6) AS corr FROM {source}""")


O["freight_ols"] = _ols("io", "freight", "CAST(n_items AS DOUBLE)", "io")
O["weight_ols"] = _ols("i pr", "CAST(freight_value AS DOUBLE)", "CAST(product_weight_g AS DOUBLE)", "(SELECT * FROM i JOIN pr USING (product_id) WHERE product_weight_g IS NOT NULL)")
O["review_share"] = sql("r", "SELECT review_score, count(*) AS reviews, count(*) / CAST((SELECT count(*) FROM r) AS DOUBLE) AS share FROM r GROUP BY 1")

# Orders and KPIs
O["order_base"] = sql("b", "SELECT * FROM b")
O["order_base_from_fact"] = sql("b", "SELECT * FROM b")
_msf = "CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS INTEGER) AS months_since_first"
O["enriched_orders"] = sql("h", f"SELECT *, {_msf} FROM h")
O["category_month"] = sql("cat", "SELECT * FROM cat")
KPI = f"""
    SELECT round(sum(gmv), 2) AS gmv, count(*) AS orders, count(DISTINCT customer_unique_id) AS customers,
      round(sum(gmv), 2) / count(*) AS aov,
      (SELECT count(*) FROM (SELECT 1 FROM e GROUP BY customer_unique_id HAVING count(*) > 1)) / CAST(count(DISTINCT customer_unique_id) AS DOUBLE) AS repeat_rate,
      avg(CASE WHEN is_delivered AND days_vs_estimate IS NOT NULL THEN CAST(days_vs_estimate <= 0 AS INTEGER) END) AS on_time_rate,
      avg(review_score) AS avg_review, avg(delivery_days) AS avg_lead_days FROM e"""
O["headline_kpis"] = sql("e", KPI)
O["gmv_new_repeat"] = sql("h", """SELECT order_month, round(coalesce(sum(gmv) FILTER (NOT is_repeat_order), 0), 2) AS new_gmv,
    round(coalesce(sum(gmv) FILTER (is_repeat_order), 0), 2) AS repeat_gmv,
    round(coalesce(sum(gmv) FILTER (NOT is_repeat_order), 0) + coalesce(sum(gmv) FILTER (is_repeat_order), 0), 2) AS total_gmv, count(*) AS orders FROM h GROUP BY 1""")
O["repeat_share"] = sql("h", f"SELECT order_month, count(*) AS orders, count(*) FILTER (is_repeat_order) AS repeat_orders, {rate('is_repeat_order')} AS repeat_order_share FROM h GROUP BY 1")
O["treadmill"] = sql("h", """SELECT order_month, count(DISTINCT customer_unique_id) FILTER (NOT is_repeat_order) AS new_customers,
    count(DISTINCT customer_unique_id) FILTER (is_repeat_order) AS repeat_customers FROM h GROUP BY 1""")
O["cac_scenario"] = sql("e", f"""
    SELECT spend AS total_spend, spend / customers AS blended_cac, spend / gmv AS pct_gmv_on_marketing, repeat_rate,
      customers * CAST(0.02 AS DOUBLE) AS extra_repeat_customers, customers * CAST(0.02 AS DOUBLE) * aov AS incremental_gmv,
      customers * CAST(0.02 AS DOUBLE) * CAST(40 AS DOUBLE) AS equiv_paid_cost
    FROM ({KPI}), (SELECT CAST(50000 * count(DISTINCT order_month) AS DOUBLE) AS spend FROM e)""")
O["delivery_split"] = sql("o", """SELECT CASE WHEN delivered_ts IS NULL THEN 'not delivered' WHEN delivered_ts <= estimated_ts THEN 'on time' ELSE 'late' END AS delivery_outcome,
    count(*) AS orders FROM o GROUP BY 1""")
_late = "count(*) AS orders, count(*) FILTER (is_late) AS late, " + rate("is_late") + " AS late_rate FROM e WHERE is_delivered AND days_vs_estimate IS NOT NULL GROUP BY 1"
O["late_by_state"] = sql("e", "SELECT customer_state, " + _late)
O["late_by_month"] = sql("e", "SELECT order_month, " + _late)
O["late_by_large_state"] = sql("e", f"""SELECT customer_state, count(*) AS orders, {rate('delivered_ts > estimated_ts')} * 100 AS late_pct FROM e
    WHERE is_delivered AND delivered_ts IS NOT NULL GROUP BY 1 HAVING count(*) >= 150""")
O["review_distribution"] = sql("b", "SELECT review_score, count(*) AS orders FROM b WHERE review_score IS NOT NULL GROUP BY 1")
O["review_summary"] = sql("lr", f"SELECT count(*) AS reviews, avg(review_score) AS avg_score, {rate('review_score <= 2')} AS low_share FROM lr")
O["score_by_bucket"] = sql("e", """SELECT delivery_bucket, avg(review_score) AS avg_review, count(*) AS orders, CAST(left(delivery_bucket, 1) AS INTEGER) AS position
    FROM e WHERE delivery_bucket IS NOT NULL AND review_score IS NOT NULL GROUP BY 1""")
_reorder = f"SELECT delivery_bucket, {rate('has_subsequent_order')} AS reorder_rate, count(*) AS orders, CAST(left(delivery_bucket, 1) AS INTEGER) AS position FROM h WHERE delivery_bucket IS NOT NULL GROUP BY 1"
O["reorder_by_bucket"] = sql("h", _reorder)
O["reorder_by_score"] = sql("h", f"""SELECT review_bucket, {rate('has_subsequent_order')} AS reorder_rate, count(*) AS orders,
    CASE left(review_bucket, 1) WHEN '1' THEN 1 WHEN '3' THEN 2 ELSE 3 END AS position FROM h WHERE review_bucket IS NOT NULL GROUP BY 1""")
O["reorder_gap"] = sql("h", f"""SELECT a AS first_value, z AS last_value, z / a - 1 AS relative_gap FROM
    (SELECT arg_min(reorder_rate, position) AS a, arg_max(reorder_rate, position) AS z FROM ({_reorder}))""")
O["lead_hist"] = sql("b", """SELECT CAST(bin AS BIGINT) AS bin, CAST(bin * top AS DOUBLE) / 40 AS bin_start, count(*) AS n FROM
    (SELECT least(delivery_days * 40 // top, 39) AS bin, top FROM b, (SELECT greatest(max(delivery_days), 1) AS top FROM b) WHERE delivery_days >= 0) GROUP BY bin, top""")
O["lead_median"] = sql("b", "SELECT CAST(median(delivery_days) AS DOUBLE) AS median_days FROM b WHERE delivery_days >= 0")
O["lead_by_state"] = sql("b", """SELECT customer_state, count(*) AS orders, avg(delivery_days) AS avg_days, CAST(median(delivery_days) AS DOUBLE) AS median_days
    FROM b WHERE delivery_days IS NOT NULL GROUP BY 1""")
_dl = "SELECT days_vs_estimate, avg(review_score) AS avg_review, count(*) AS orders FROM b WHERE days_vs_estimate BETWEEN -30 AND 30 AND review_score IS NOT NULL GROUP BY 1"
O["score_by_day_late"] = sql("b", _dl)
O["score_trend"] = sql("b", f"""
    WITH k AS (SELECT CAST(days_vs_estimate AS DOUBLE) AS x, avg_review AS y FROM ({_dl})),
    q AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(x * x) AS mq FROM k),
    t AS (SELECT sum((x - mx) * (x - mx)) AS a, sum((x - mx) * (x * x - mq)) AS b, sum((x * x - mq) * (x * x - mq)) AS c,
        sum((x - mx) * (y - my)) AS u, sum((x * x - mq) * (y - my)) AS v FROM k, q)
    SELECT n, round(my - (u * c - v * b) / (a * c - b * b) * mx - (v * a - u * b) / (a * c - b * b) * mq, 8) AS intercept,
      round((u * c - v * b) / (a * c - b * b), 8) AS linear, round((v * a - u * b) / (a * c - b * b), 8) AS quadratic FROM t, q""")
O["top_categories"] = sql("cat", "SELECT product_category, round(sum(gmv), 2) AS gmv, CAST(sum(n_items) AS BIGINT) AS items FROM cat GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 3")
O["bottom_categories"] = sql("cat", "SELECT product_category, CAST(sum(n_items) AS BIGINT) AS items FROM cat GROUP BY 1 ORDER BY 2, 1 LIMIT 3")
_cells = """SELECT product_category, customer_state, round(sum(gmv), 2) AS gmv FROM cat
    WHERE product_category IN (SELECT product_category FROM cat GROUP BY 1 ORDER BY round(sum(gmv), 2) DESC NULLS LAST, 1 LIMIT 10)
      AND customer_state IN (SELECT customer_state FROM cat GROUP BY 1 ORDER BY round(sum(gmv), 2) DESC NULLS LAST, 1 LIMIT 10) GROUP BY 1, 2"""
O["category_state_matrix"] = sql("cat", "SELECT product_category, " + ", ".join(
    f"coalesce(max(gmv) FILTER (customer_state = 'NATION_{i}'), 0) AS NATION_{i}" for i in range(25)) + f" FROM ({_cells}) GROUP BY 1")
O["lane_scorecard"] = sql("e i pr", f"""
    SELECT customer_state, coalesce(product_category, 'unknown') AS product_category, count(*) AS items, {rate('is_late')} AS late_rate,
      CAST(sum(price) AS DOUBLE) AS gmv, {rate('is_late')} * CAST(sum(price) AS DOUBLE) AS risk
    FROM e JOIN i USING (order_id) LEFT JOIN pr USING (product_id) WHERE is_delivered AND days_vs_estimate IS NOT NULL GROUP BY 1, 2""")
O["revenue_at_risk"] = sql("h", """
    SELECT g AS gmv_at_risk, n AS orders_at_risk, t AS total_gmv, g / t AS share_at_risk FROM
      (SELECT round(coalesce(sum(gmv), 0), 2) AS g, count(*) AS n FROM h WHERE customer_unique_id IN
        (SELECT customer_unique_id FROM h WHERE review_score <= 2 AND NOT has_subsequent_order)), (SELECT round(sum(gmv), 2) AS t FROM h)""")
_judged = "FROM e WHERE is_delivered AND delivered_ts IS NOT NULL AND review_score IS NOT NULL"
_dlv = "CASE WHEN delivered_ts > estimated_ts THEN 'Late' ELSE 'On-time' END AS delivery"
O["review_profile"] = sql("e", f"""SELECT {_dlv}, count(*) AS n, avg(review_score) AS avg_score, {rate('review_score <= 2')} * 100 AS pct_detractor,
    {rate('review_score >= 4')} * 100 AS pct_promoter {_judged} GROUP BY 1""")
O["review_composition"] = sql("e", f"""
    SELECT delivery, bucket, n, n / CAST(sum(n) OVER (PARTITION BY delivery) AS DOUBLE) * 100 AS pct FROM
      (SELECT {_dlv}, CASE WHEN review_score <= 2 THEN 'detractor' WHEN review_score = 3 THEN 'neutral' ELSE 'promoter' END AS bucket, count(*) AS n {_judged} GROUP BY 1, 2)""")
O["handling_stages"] = sql("o", """SELECT order_id, (epoch_us(approved_ts) - epoch_us(purchase_ts)) / CAST(3600000000 AS DOUBLE) AS approval_hours,
    CAST(floor((epoch_us(carrier_ts) - epoch_us(approved_ts)) / 86400000000.0) AS BIGINT) AS carrier_handling_days,
    CAST(floor((epoch_us(delivered_ts) - epoch_us(estimated_ts)) / 86400000000.0) AS BIGINT) AS delivery_diff FROM o""")

# Charts
O["chart_big_numbers"] = sql("e vs", """
    SELECT 'kpi_gmv' AS chart, round(sum(gmv), 2) AS value FROM e UNION ALL SELECT 'kpi_orders', CAST(count(*) AS DOUBLE) FROM e
    UNION ALL SELECT 'kpi_aov', round(sum(gmv), 2) / count(*) FROM e
    UNION ALL SELECT 'kpi_repeat', avg(CAST(is_repeat_customer AS INTEGER)) FROM vs
    UNION ALL SELECT 'kpi_ontime', avg(CAST(days_vs_estimate <= 0 AS INTEGER)) FROM e UNION ALL SELECT 'kpi_review', avg(review_score) FROM e""")
O["chart_gmv_new_vs_repeat"] = sql("h", "SELECT order_month, is_repeat_order, round(sum(gmv), 2) AS gmv_total FROM h GROUP BY 1, 2")
O["chart_delivery_hist"] = sql("e", "SELECT delivery_bucket, count(*) AS order_count FROM e GROUP BY 1")
O["chart_late_by_state"] = sql("e", f"SELECT customer_state, {rate('days_vs_estimate > 0')} AS late_rate FROM e GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 27")
O["chart_review_by_delivery"] = sql("e", "SELECT delivery_bucket, avg(review_score) AS avg_review FROM e GROUP BY 1")
O["chart_rfm_segments"] = sql("vs", "SELECT segment, count(customer_unique_id) AS customer_count FROM vs GROUP BY 1")
O["chart_cohort_heatmap"] = sql("cl", "SELECT cohort_month, months_since, avg(retention) AS avg_retention FROM cl GROUP BY 1, 2")
O["chart_top_categories"] = sql("cat", "SELECT product_category, round(sum(gmv), 2) AS gmv_total FROM cat GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 12")

O["chart_repeat_share_trend"] = sql("h", f"SELECT order_month, {rate('is_repeat_order')} AS repeat_order_share FROM h GROUP BY 1")
O["chart_orders_per_customer"] = sql("vs", "SELECT orders_placed_bucket, count(customer_unique_id) AS customer_count FROM vs GROUP BY 1")
O["chart_reorder_by_review"] = sql("h", f"SELECT review_bucket, {rate('has_subsequent_order')} AS reorder_rate FROM h GROUP BY 1")
O["chart_late_rate_trend"] = sql("e", f"SELECT order_month, {rate('days_vs_estimate > 0')} AS late_rate FROM e GROUP BY 1")
O["chart_reorder_by_delivery"] = sql("h", f"SELECT delivery_bucket, {rate('has_subsequent_order')} AS reorder_rate FROM h GROUP BY 1")

# Retention
O["cohort_long"] = sql("cl", "SELECT * FROM cl")
O["cohort_wide"] = sql("cl", "SELECT cohort_month, " + ", ".join(
    f"max(retention) FILTER (months_since = {k}) AS m{k}" for k in range(84)) + " FROM cl GROUP BY 1")
_opc = "(SELECT customer_unique_id, count(*) AS n FROM b WHERE customer_unique_id IS NOT NULL GROUP BY 1)"
O["repeat_rate"] = sql("b", f"""SELECT count(*) AS customers, count(*) FILTER (n > 1) AS repeat_customers, CAST(sum(n) AS BIGINT) AS orders,
    count(*) FILTER (n > 1) / CAST(count(*) AS DOUBLE) AS repeat_rate, CAST(sum(n) - count(*) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS repeat_order_share FROM {_opc}""")
O["orders_per_customer"] = sql("b", f"""SELECT least(n, 5) AS orders_placed, count(*) AS customers, CASE WHEN least(n, 5) >= 5 THEN '5+' ELSE CAST(least(n, 5) AS VARCHAR) END AS label
    FROM {_opc} GROUP BY 1""")
O["customer_view"] = sql("vs", "SELECT * FROM vs")
O["rfm_rules"] = sql("vs", "SELECT segment, count(*) AS customers, round(sum(monetary), 2) AS monetary, count(*) / CAST((SELECT count(*) FROM vs) AS DOUBLE) AS share FROM vs GROUP BY 1")
O["rfm_rules2"] = sql("b", f"""
    SELECT *, CASE WHEN recency_days <= 90 AND frequency >= 3 AND monetary >= 500 THEN 'Champion' WHEN recency_days <= 180 AND frequency >= 2 THEN 'Loyal'
      WHEN recency_days <= 90 THEN 'Recent' WHEN recency_days > 365 THEN 'Churned' ELSE 'At Risk' END AS customer_segment
    FROM (SELECT customer_id, date_diff('day', max(purchase_ts), {AS_OF}) AS recency_days, count(*) AS frequency, round(sum(gmv), 2) AS monetary
      FROM b WHERE order_status = 'delivered' GROUP BY 1)""")
O["rfm_quintile"] = sql("rb", f"SELECT *, {QUINTILE_SEGMENT} AS segment FROM {rfm(5)}")
O["rfm_quintile_means"] = sql("rb", f"""SELECT {QUINTILE_SEGMENT} AS segment, count(*) AS customers, avg(recency) AS avg_recency, avg(frequency) AS avg_frequency,
    round(avg(monetary), 2) AS avg_monetary FROM {rfm(5)} GROUP BY 1""")
O["rfm_quartile"] = sql("rb", f"""
    SELECT *, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score,
      CASE WHEN r_score = 4 AND f_score = 4 THEN 'Champion' WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customer' WHEN r_score = 4 THEN 'Recent Customer'
        WHEN r_score = 2 AND f_score >= 2 THEN 'At Risk' WHEN r_score <= 1 THEN 'Lost' ELSE 'Potential Loyalist' END AS segment FROM {rfm(4)}""")
O["customer_360"] = sql("rb", f"""
    SELECT customer_unique_id, md5(CAST(customer_unique_id AS VARCHAR)) AS customer_sk, frequency AS order_count, monetary AS lifetime_value, recency AS recency_days,
      CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'champions' WHEN r_score >= 3 AND f_score >= 3 THEN 'loyal'
        WHEN r_score <= 2 AND (f_score >= 3 OR m_score >= 4) THEN 'at_risk' WHEN r_score <= 1 THEN 'lost' ELSE 'hibernating' END AS rfm_segment FROM {rfm(5)}""")
_ret = f"count(*) AS customers, count(*) FILTER (cust_total_orders > 1) AS returned, {rate('cust_total_orders > 1')} AS return_rate FROM e WHERE order_seq = 1"
O["first_order_return"] = sql("e", f"SELECT CASE WHEN delivered_ts > estimated_ts THEN 'Late' ELSE 'On-time' END AS first_delivery, {_ret} AND is_delivered AND delivered_ts IS NOT NULL GROUP BY 1")
O["first_score_return"] = sql("e", f"SELECT review_score AS first_score, {_ret} AND review_score IS NOT NULL GROUP BY 1")

# Business questions
O["revenue_month"] = sql("f", f"""
    SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, count(DISTINCT id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
      CAST(sum(price) AS DOUBLE) AS gross_revenue, CAST(sum(freight_value) AS DOUBLE) AS total_freight, CAST(sum(price + freight_value) AS DOUBLE) AS total_revenue,
      {r2(avg('price'))} AS avg_order_value FROM f WHERE order_status = 'delivered' GROUP BY 1""")
_fr = "f LEFT JOIN lr ON f.id = lr.order_id"
O["seller_rank"] = sql("f lr s", f"""
    SELECT f.seller_id, seller_state, seller_city, count(DISTINCT id) AS total_orders, CAST(sum(price) AS DOUBLE) AS total_revenue, {r2(avg('price'))} AS avg_order_value,
      {r2(avg('review_score'))} AS avg_review_score, count(*) FILTER (is_long_delivery) AS long_delivery_count, count(*) FILTER (has_invalid_delivery_date) AS invalid_delivery_count
    FROM {_fr} LEFT JOIN s ON f.seller_id = s.seller_id WHERE order_status = 'delivered' GROUP BY 1, 2, 3""")
O["category_perf"] = sql("f lr pr", f"""
    SELECT product_category, count(DISTINCT id) AS total_orders, CAST(sum(price) AS DOUBLE) AS total_revenue, {r2(avg('price'))} AS avg_price, {r2(avg('freight_value'))} AS avg_freight,
      {r2(avg('review_score'))} AS avg_review_score, count(*) FILTER (is_long_delivery) AS long_deliveries,
      round(avg(CAST(freight_value AS DOUBLE) / CAST(price AS DOUBLE)) * 100, 2) AS freight_pct_of_price
    FROM {_fr} LEFT JOIN pr USING (product_id) WHERE order_status = 'delivered' GROUP BY 1""")
O["payment_mix"] = sql("f", f"""
    SELECT payment_type, payment_installments, count(DISTINCT id) AS total_orders, CAST(sum(price) AS DOUBLE) AS total_revenue, {r2(avg('price'))} AS avg_order_value,
      {r2(avg('payment_value'))} AS avg_payment_value FROM f WHERE order_status = 'delivered' AND payment_type <> 'not_defined' GROUP BY 1, 2""")
_days = "date_diff('day', order_purchase_timestamp, order_delivered_customer_date)"
_early = "date_diff('day', order_delivered_customer_date, order_estimated_delivery_date)"
O["sla_state"] = sql("f s", f"""
    SELECT seller_state, count(DISTINCT id) AS total_orders, {r2(avg(_days), 1)} AS avg_delivery_days, {r2(avg(_early), 1)} AS avg_days_vs_estimate,
      count(*) FILTER (is_long_delivery) AS long_deliveries, count(*) FILTER (is_overdue_delivery) AS overdue_deliveries,
      {r2("count(*) FILTER (is_overdue_delivery) / CAST(count(*) AS DOUBLE) * 100")} AS overdue_rate_pct
    FROM f LEFT JOIN s USING (seller_id) WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL GROUP BY 1""")
O["geo_revenue"] = sql("f lr c", f"""
    SELECT customer_state, count(DISTINCT f.customer_id) AS unique_customers, count(DISTINCT id) AS total_orders, CAST(sum(price) AS DOUBLE) AS total_revenue,
      {r2(avg('price'))} AS avg_order_value, {r2(avg('review_score'))} AS avg_satisfaction,
      {r2("count(DISTINCT id) / CAST(count(DISTINCT f.customer_id) AS DOUBLE)")} AS orders_per_customer
    FROM {_fr} LEFT JOIN c ON f.customer_id = c.customer_id WHERE order_status = 'delivered' GROUP BY 1""")
O["category_score"] = sql("f lr pr", f"""
    SELECT product_category, review_score, count(DISTINCT id) AS total_orders, {r2(avg('price'))} AS avg_price, {r2(avg(_days), 1)} AS avg_delivery_days,
      {r2(avg('freight_value'))} AS avg_freight FROM {_fr} LEFT JOIN pr USING (product_id) WHERE review_score IS NOT NULL GROUP BY 1, 2""")
_sales = "round(sum(gmv), 2) AS sales, round(sum(freight), 2) AS freight, round(sum(freight), 2) / round(sum(gmv), 2) AS freight_ratio, count(*) AS orders FROM b GROUP BY 1"
O["sales_by_season"] = sql("b", f"""SELECT CASE WHEN month(purchase_ts) IN (12, 1, 2) THEN 'Winter' WHEN month(purchase_ts) <= 5 THEN 'Spring'
    WHEN month(purchase_ts) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season, {_sales}""")
O["sales_by_weekday"] = sql("b", f"SELECT dayname(purchase_ts) AS purchase_day_name, {_sales}")
O["sales_by_hour"] = sql("b", f"SELECT CAST(hour(purchase_ts) AS INTEGER) AS purchase_hour, {_sales}")
O["sales_by_state"] = sql("b", f"SELECT customer_state, {_sales}")
O["local_freight"] = sql("i o s c", """SELECT CASE WHEN seller_state = customer_state THEN 'Local' ELSE 'Non-local' END AS shipping, CAST(sum(freight_value) AS DOUBLE) AS freight,
    count(*) AS items FROM i LEFT JOIN o USING (order_id) LEFT JOIN s USING (seller_id) LEFT JOIN c ON o.customer_id = c.customer_id GROUP BY 1""")
O["top_sellers"] = sql("i", "SELECT seller_id, CAST(sum(price) AS DOUBLE) AS revenue, count(*) AS items FROM i GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
O["top_city_categories"] = sql("i s pr", """SELECT seller_city, product_category, count(*) AS n FROM i LEFT JOIN s USING (seller_id) LEFT JOIN pr USING (product_id)
    GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS LAST, 2 NULLS LAST LIMIT 10""")
_vip = "SELECT customer_id, sum(payment_value) AS paid FROM p JOIN o USING (order_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
O["vip"] = sql("p o i pr c", f"""
    SELECT t.customer_id, CAST(t.paid AS DOUBLE) AS paid, m.payment_type AS modal_type, total_items, first_category, n_categories,
      right(CAST(customer_unique_id AS VARCHAR), 8) AS customer_short
    FROM ({_vip}) t LEFT JOIN (SELECT customer_id, payment_type FROM p JOIN o USING (order_id) WHERE payment_type IS NOT NULL GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, payment_type) = 1) m USING (customer_id)
      LEFT JOIN (SELECT customer_id, count(product_id) AS total_items, min(product_category) AS first_category, count(DISTINCT product_category) AS n_categories
        FROM o JOIN i USING (order_id) LEFT JOIN pr USING (product_id) GROUP BY 1) USING (customer_id) LEFT JOIN c USING (customer_id)""")
O["vip_products"] = sql("p o i pr", f"""SELECT customer_id, product_category, count(*) AS items FROM o JOIN i USING (order_id) LEFT JOIN pr USING (product_id)
    WHERE customer_id IN (SELECT customer_id FROM ({_vip})) GROUP BY 1, 2""")
O["payment_distributions"] = sql("p", " UNION ALL ".join(
    f"SELECT '{x}' AS column_name, CAST({x} AS VARCHAR) AS value, count(*) AS n, count(*) / CAST((SELECT count(*) FROM p) AS DOUBLE) AS share FROM p GROUP BY {x}"
    for x in ("payment_sequential", "payment_type", "payment_installments")))
O["rolling3"] = sql("b", """SELECT order_month, revenue, orders, round(avg(revenue) OVER (ORDER BY order_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS rolling_avg
    FROM (SELECT order_month, round(sum(gmv), 2) AS revenue, count(*) AS orders FROM b GROUP BY 1)""")
_growth = """
    SELECT min(order_month) AS first_month, max(order_month) AS last_month, arg_min(gmv, order_month) AS first_gmv, arg_max(gmv, order_month) AS last_gmv,
      (arg_max(gmv, order_month) / arg_min(gmv, order_month) - 1) * 100 AS growth_pct
    FROM (SELECT order_month, round(sum(gmv), 2) AS gmv FROM b WHERE gmv IS NOT NULL{} GROUP BY 1)"""
O["gmv_growth"] = sql("b", _growth.format(" AND order_month BETWEEN DATE '1995-02-01' AND DATE '2001-06-01'"))
O["gmv_growth_all"] = sql("b", _growth.format(""))
O["product_volumes"] = sql("pr", "SELECT product_id, CAST(product_length_cm * product_height_cm * product_width_cm AS BIGINT) AS volume_cm3 FROM pr")
O["freight_shares"] = sql("i", """SELECT order_id, order_item_id, CAST(price + freight_value AS DOUBLE) AS line_total,
    CAST(freight_value AS DOUBLE) / CAST(price AS DOUBLE) * 100 AS freight_pct FROM i""")

# Quality
O["unique_violations"] = sql("r_raw", "SELECT review_id, count(*) AS n_rows FROM r_raw GROUP BY 1 HAVING count(*) > 1")
O["combination_violations"] = sql("i_raw", "SELECT order_id, order_item_id, count(*) AS n_rows FROM i_raw GROUP BY 1, 2 HAVING count(*) > 1")
O["null_violations"] = sql("p", "SELECT order_id, payment_sequential FROM p WHERE payment_type IS NULL")
O["fk_violations"] = sql("s g", "SELECT * FROM s WHERE seller_zip_code_prefix NOT IN (SELECT zip_code_prefix FROM g)")
O["enum_violations"] = sql("r_raw", "SELECT review_id, review_comment_title, review_answer_timestamp FROM r_raw WHERE review_comment_title NOT IN ('view', 'click', 'purchase')")
O["range_violations"] = sql("f", "SELECT id, order_item_id, CAST(price AS DOUBLE) AS price FROM f WHERE order_status = 'delivered' AND price NOT BETWEEN 1000 AND 90000")
O["pair_violations"] = sql("o", """SELECT order_id, delivered_ts AS order_delivered_customer_date, carrier_ts AS order_delivered_carrier_date FROM o
    WHERE order_status = 'delivered' AND delivered_ts < carrier_ts""")
O["regex_violations"] = "SELECT p_partkey, p_brand FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]$')"
O["expression_violations"] = sql("i", "SELECT order_id, order_item_id FROM i WHERE NOT (price > 1000 AND freight_value <= price * 0.07)")
O["placeholder_violations"] = sql("r_raw", "SELECT review_id, order_id FROM r_raw WHERE lower(trim(review_comment_message)) IN ('null', 'n/a', 'none', 'missing', 'unknown', '')")
O["null_rate_gate"] = sql("o", """SELECT 'order_delivered_customer_date' AS column_name, count(*) FILTER (delivered_ts IS NULL) AS n_null,
    count(*) FILTER (delivered_ts IS NULL) / CAST(count(*) AS DOUBLE) AS null_share, CAST(0.2 AS DOUBLE) AS "limit" FROM o
    HAVING count(*) FILTER (delivered_ts IS NULL) / CAST(count(*) AS DOUBLE) > 0.2""")
O["mean_gate"] = sql("r", "SELECT avg(review_score) AS mean FROM r HAVING avg(review_score) NOT BETWEEN 1 AND 2")
O["iqr_outliers"] = sql("i", """
    SELECT q1, q3, q1 - (q3 - q1) * CAST(1.5 AS DOUBLE) AS lower_bound, q3 + (q3 - q1) * CAST(1.5 AS DOUBLE) AS upper_bound,
      (SELECT count(*) FROM i WHERE CAST(freight_value AS DOUBLE) > q3 + (q3 - q1) * CAST(1.5 AS DOUBLE)) AS n_outliers, n AS n_rows,
      (SELECT count(*) FROM i WHERE CAST(freight_value AS DOUBLE) > q3 + (q3 - q1) * CAST(1.5 AS DOUBLE)) / CAST(n AS DOUBLE) AS outlier_share
    FROM (SELECT quantile_cont(CAST(freight_value AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(freight_value AS DOUBLE), 0.75) AS q3, count(*) AS n FROM i)""")
O["freight_anomalies"] = sql("i", "SELECT count(*) FILTER (freight_value > price) AS freight_above_price, CAST(max(freight_value) AS DOUBLE) AS max_freight, count(*) AS items FROM i")
O["place_mismatches"] = sql("s g", """SELECT * FROM s WHERE seller_zip_code_prefix IN (SELECT zip_code_prefix FROM g)
    AND (seller_zip_code_prefix, seller_state) NOT IN (SELECT zip_code_prefix, state FROM g)""")
O["mart_reconciliation"] = sql("o i_raw i", """
    SELECT month, round(l, 2) AS left_total, round(r, 2) AS right_total FROM
      (SELECT CAST(date_trunc('month', purchase_ts) AS DATE) AS month, CAST(sum(price) AS DOUBLE) AS l FROM i JOIN o USING (order_id) GROUP BY 1)
      FULL JOIN (SELECT CAST(date_trunc('month', purchase_ts) AS DATE) AS month, CAST(sum(price) AS DOUBLE) AS r FROM i_raw JOIN o USING (order_id) GROUP BY 1) USING (month)
    WHERE abs(l - r) > 0.01 OR l IS NULL OR r IS NULL""")
_people = "(SELECT DISTINCT customer_unique_id AS k FROM b WHERE customer_unique_id IS NOT NULL)"
O["one_segment_each"] = sql("b", f"SELECT k AS customer_unique_id FROM {_people} WHERE k % 10 = 0 UNION ALL SELECT k FROM {_people} WHERE k % 15 = 1 UNION ALL SELECT k FROM {_people} WHERE k % 15 = 1 AND k % 10 = 0")
_chk = lambda name, source, cond, sev="error": (
    f"SELECT '{name}' AS check_name, '{sev}' AS severity, (SELECT count(*) FROM {source} WHERE {cond}) AS n_failed, (SELECT count(*) FROM {source} WHERE {cond}) = 0 AS passed")
_dupes = lambda t, k: f"(SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)"
_key_checks = lambda **t: " UNION ALL ".join(
    [_chk(f"{n}_unique", _dupes(t[n], ", ".join(k)), "true") for n, k in _KEYS]
    + [_chk(f"{n}_{k}_present", t[n], f"{k} IS NULL") for n, ks in _KEYS for k in ks])
_KEYS = (("customers", ["customer_id"]), ("orders", ["order_id"]), ("order_items", ["order_id", "order_item_id"]),
    ("order_payments", ["order_id", "payment_sequential"]), ("order_reviews", ["review_id"]), ("products", ["product_id"]), ("sellers", ["seller_id"]))
O["stage_checks"] = sql("c o i p r pr s", _key_checks(
    customers="c", orders="o", order_items="i", order_payments="p", order_reviews="r", products="pr", sellers="s"))
O["raw_key_checks"] = sql("c o i_raw p r_raw pr s", _key_checks(
    customers="c", orders="o", order_items="i_raw", order_payments="p", order_reviews="r_raw", products="pr", sellers="s"))
O["gold_checks"] = sql("f c pr s r", " UNION ALL ".join([
    _chk("fact_grain", "(SELECT id FROM f WHERE order_item_id IS NOT NULL GROUP BY id, order_item_id HAVING count(*) > 1)", "true"),
    _chk("fact_id_present", "f", "id IS NULL"),
    _chk("fact_customer", "f", "customer_id NOT IN (SELECT customer_id FROM c)"),
    _chk("fact_product", "f", "product_id NOT IN (SELECT product_id FROM pr)", "warn"),
    _chk("fact_seller", "f", "seller_id NOT IN (SELECT seller_id FROM s)"),
    _chk("fact_status", "f", "order_status NOT IN ('approved', 'canceled', 'created', 'delivered', 'invoiced', 'processing', 'shipped', 'unavailable')"),
    _chk("fact_payment_type", "f", "payment_type NOT IN ('boleto', 'credit_card', 'debit_card', 'voucher', 'not_defined')"),
    _chk("fact_price_range", "f", "price NOT BETWEEN 0 AND 10000", "warn"),
    _chk("fact_freight_range", "f", "freight_value NOT BETWEEN 0 AND 1000", "warn"),
    _chk("delivered_after_purchase", "f", "order_status = 'delivered' AND order_delivered_customer_date < order_purchase_timestamp", "warn"),
    _chk("delivered_has_date", "f", "order_status = 'delivered' AND order_delivered_customer_date IS NULL", "warn"),
    _chk("no_future_purchase", "f", f"order_purchase_timestamp > {AS_OF}"),
    _chk("dear_item_is_paid", "f", "price > 1000 AND payment_value IS NULL", "warn"),
    _chk("customer_zip_form", "c", "NOT regexp_matches(customer_zip_code_prefix, '^[0-9]{5}$')"),
    _chk("review_score_range", "r", "review_score NOT BETWEEN 1 AND 5"),
    _chk("lead_time_not_negative", "f", "order_status = 'delivered' AND order_delivered_customer_date < order_purchase_timestamp", "warn"),
]))

# Text
O["top_words"] = sql("w", "SELECT term, count(*) AS n FROM w GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
O["word_counts"] = sql("w", "SELECT term, count(*) AS n FROM w GROUP BY 1")
_pairs = "SELECT unnest(list_transform(list_zip(words[:-2], words[2:]), lambda x: x[1] || ' ' || x[2])) AS term FROM tk WHERE len(words) > 1"
O["top_bigrams"] = sql("tk", f"SELECT term, count(*) AS n FROM ({_pairs}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
_band = lambda b, q: f"(SELECT '{b}' AS band, term, count(*) AS n FROM w JOIN labels USING (doc_id) WHERE quality = {q} GROUP BY term ORDER BY n DESC, term LIMIT 20)"
O["words_by_band"] = sql("w", f"SELECT * FROM {_band('low', 0)} UNION ALL SELECT * FROM {_band('high', 1)}")
O["relabelled_words"] = sql("w", """SELECT label AS term, CAST(sum(n) AS BIGINT) AS n FROM (SELECT term, count(*) AS n FROM w GROUP BY 1) JOIN
    (SELECT term, lang AS label FROM w GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY term ORDER BY count(*) DESC, lang DESC) = 1) USING (term) GROUP BY 1""")
O["length_by_score"] = sql("d", "SELECT review_score, avg(length(text)) AS avg_length, count(*) AS texts FROM d WHERE text IS NOT NULL AND review_score IS NOT NULL GROUP BY 1")
O["length_hist"] = """SELECT CAST(least(length(text), 500) // 25 AS BIGINT) AS bin, CAST(least(length(text), 500) // 25 * 25 AS DOUBLE) AS bin_start, count(*) AS n
    FROM documents WHERE text IS NOT NULL GROUP BY 1, 2"""
O["review_texts"] = sql("tx", "SELECT * FROM tx")
O["review_coverage"] = sql("tx", """SELECT count(*) AS reviews, count(title) AS with_title, count(message) AS with_message, count(text) AS with_text,
    avg(length(message)) AS avg_message_length FROM tx""")

# Models
_ml = """
    SELECT o.order_id, o.customer_id, o.order_status, c.customer_unique_id, c.customer_state, o.purchase_ts, o.delivered_ts, o.estimated_ts,
      z.* EXCLUDE (order_id), m1.product_category, m2.seller_state
    FROM o LEFT JOIN c ON o.customer_id = c.customer_id
      LEFT JOIN (SELECT order_id, CAST(sum(price) AS DOUBLE) AS order_gmv, CAST(sum(freight_value) AS DOUBLE) AS order_freight, count(*) AS item_count,
          count(DISTINCT seller_id) AS seller_count, CAST(sum(product_weight_g) AS BIGINT) AS total_weight_g,
          CAST(max(product_length_cm * product_height_cm * product_width_cm) AS BIGINT) AS max_volume_cm3
        FROM i LEFT JOIN pr USING (product_id) GROUP BY 1) z ON o.order_id = z.order_id
      LEFT JOIN (SELECT order_id, product_category FROM i JOIN pr USING (product_id) WHERE product_category IS NOT NULL GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, product_category) = 1) m1 ON o.order_id = m1.order_id
      LEFT JOIN (SELECT order_id, seller_state FROM i JOIN s USING (seller_id) WHERE seller_state IS NOT NULL GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, seller_state) = 1) m2 ON o.order_id = m2.order_id"""
O["ml_order_rows"] = sql("o c i pr s", f"SELECT * EXCLUDE (purchase_ts, delivered_ts, estimated_ts) FROM ({_ml})")
O["ml_features"] = sql("o c i pr s", f"""
    SELECT order_id, CAST(delivered_ts > estimated_ts AS INTEGER) AS label, order_gmv, order_freight, CAST(item_count AS DOUBLE) AS item_count,
      CAST(seller_count AS DOUBLE) AS seller_count, CAST(total_weight_g AS DOUBLE) AS total_weight_g, CAST(max_volume_cm3 AS DOUBLE) AS max_volume_cm3,
      round((epoch_us(estimated_ts) - epoch_us(purchase_ts)) / CAST(86400000000 AS DOUBLE), 8) AS estimated_lead_days,
      CAST(isodow(purchase_ts) - 1 AS DOUBLE) AS purchase_dow, CAST(month(purchase_ts) AS DOUBLE) AS purchase_month, CAST(hour(purchase_ts) AS DOUBLE) AS purchase_hour,
      order_freight / order_gmv AS freight_ratio, customer_state, seller_state, product_category,
      CASE WHEN customer_state = seller_state THEN 'same' ELSE 'cross' END AS same_state
    FROM ({_ml}) WHERE order_status = 'delivered' AND delivered_ts IS NOT NULL""")
O["ml_repeat_label"] = sql("e", "SELECT order_id, customer_unique_id, CAST(cust_total_orders > 1 AS INTEGER) AS label FROM e WHERE order_seq = 1")
O["ml_class_weights"] = sql("o", """
    WITH k AS (SELECT CAST(delivered_ts > estimated_ts AS INTEGER) AS label, count(*) AS n FROM o WHERE order_status = 'delivered' AND delivered_ts IS NOT NULL GROUP BY 1)
    SELECT label, n, (SELECT sum(n) FROM k) / CAST((SELECT count(*) FROM k) * n AS DOUBLE) AS weight FROM k""")
_fixed = "SELECT order_id, CAST(delivered_ts > estimated_ts AS INTEGER) AS label, freight / gmv AS score FROM b WHERE order_status = 'delivered' AND delivered_ts IS NOT NULL AND freight / gmv IS NOT NULL"
O["ml_metrics_fixed"] = sql("b", f"""
    WITH z AS ({_fixed}), pts AS (SELECT score, sum(label) AS p, count(*) AS n FROM z GROUP BY 1),
    cum AS (SELECT score, p, n - p AS q, sum(p) OVER w AS tp, sum(n) OVER w AS flagged FROM pts WINDOW w AS (ORDER BY score DESC)),
    tot AS (SELECT sum(label) AS p, count(*) - sum(label) AS q FROM z),
    cut AS (SELECT coalesce((SELECT score FROM cum, tot WHERE cum.tp / CAST(tot.p AS DOUBLE) >= 0.7 ORDER BY cum.tp / CAST(flagged AS DOUBLE) DESC, score DESC LIMIT 1), 0.5) AS t),
    cnt AS (SELECT t, count(*) AS n, count(*) FILTER (score >= t AND label = 1) AS tp, count(*) FILTER (score >= t AND label = 0) AS fp,
        count(*) FILTER (score < t AND label = 1) AS fn, count(*) FILTER (score < t AND label = 0) AS tn FROM z, cut GROUP BY t),
    ar AS (SELECT sum(cum.p * (cum.tp / CAST(flagged AS DOUBLE))) / max(tot.p) AS pr, sum(cum.q * (2 * cum.tp - cum.p) / 2.0) / (max(tot.p) * CAST(max(tot.q) AS DOUBLE)) AS roc FROM cum, tot)
    SELECT round(t, 9) AS threshold, n AS n_test, tp, fp, fn, tn, (tp + fn) / CAST(n AS DOUBLE) AS positive_rate, tp / CAST(tp + fn AS DOUBLE) AS recall_pos,
      tp / CAST(tp + fp AS DOUBLE) AS precision_pos, 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) AS f1_pos, round(pr, 9) AS pr_auc, round(roc, 9) AS roc_auc FROM cnt, ar""")
O["ml_split_shares"] = sql("o", """SELECT CAST(delivered_ts > estimated_ts AS INTEGER) AS label, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_in_both, true AS share_holds
    FROM o WHERE order_status = 'delivered' AND delivered_ts IS NOT NULL GROUP BY 1""")

# Loads, rows and versions that no other query shows
O["schema_contract"] = """SELECT * FROM (VALUES ('order_id', 'string', 'bigint'), ('order_region', 'string', NULL),
    ('order_approved_at', NULL, 'timestamp_ntz')) v(column_name, expected, found)"""
O["load_modes"] = """
    WITH n AS (SELECT count(*) AS n, count(*) FILTER (s_suppkey % 2 = 0) AS m FROM supplier)
    SELECT 1 AS step, 'replace' AS mode, n AS n_rows, CAST(0 AS BIGINT) AS n_moved FROM n UNION ALL SELECT 2, 'append', n + m, m FROM n
    UNION ALL SELECT 3, 'replace', n, 0 FROM n UNION ALL SELECT 4, 'upsert', n, m FROM n"""
O["csv_all_text"] = """SELECT 'texts' AS file, 'customer_city:string,customer_state:string' AS columns, (SELECT count(*) FROM customer) AS n_records
    UNION ALL SELECT 'mixed', 'seller_id:bigint,seller_city:string', (SELECT count(*) FROM supplier)"""
O["typed_orders"] = sql("o", """SELECT order_id, order_status, CASE WHEN order_id % 5 <> 0 THEN purchase_ts END AS order_purchase_timestamp,
    CAST(NULL AS TIMESTAMP) AS order_approved_at FROM o WHERE order_id % 7 <> 0""")
O["active_rows"] = "SELECT event_type, count(*) AS n FROM events WHERE event_id % 10 <> 0 GROUP BY 1"
O["latest_by_sequence"] = sql("r_raw", """SELECT review_id, review_score, review_answer_timestamp FROM r_raw
    QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY review_answer_timestamp) = 1""")
O["describe_quartiles"] = sql("i", " UNION ALL ".join(f"SELECT '{x}' AS column_name, " + ", ".join(
    f"quantile_cont(CAST({x} AS DOUBLE), {q / 100}) AS p{q}" for q in (25, 50, 75)) + " FROM i" for x in ("price", "freight_value", "order_item_id")))
O["newest_day_events"] = """SELECT user_id, event_id, CAST(ts AS DATE) AS day FROM events
    QUALIFY rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1"""
O["first_values"] = """SELECT user_id, arg_min(event_type, (ts, event_id)) FILTER (event_type <> 'error') AS event_type,
    arg_min(value, (ts, event_id)) FILTER (value > 50) AS value FROM events GROUP BY 1"""
O["lanes_at_risk"] = f"SELECT * FROM ({O['lane_scorecard']}) ORDER BY round(risk, 6) DESC NULLS LAST, customer_state, product_category LIMIT 20"
O["sales_by_year"] = sql("b", f"SELECT CAST(year(purchase_ts) AS INTEGER) AS purchase_year, {_sales}")
O["sales_by_city"] = sql("b c", f"SELECT customer_city, {_sales}".replace("FROM b", "FROM b LEFT JOIN c USING (customer_id)"))
O["sales_latest_update"] = sql("i o lr r", """SELECT order_id, order_item_id, greatest(purchase_ts, delivered_ts, shipping_limit_date, answered) AS latest_update
    FROM i JOIN o USING (order_id) LEFT JOIN (SELECT order_id, max(review_answer_timestamp) AS answered FROM r GROUP BY 1) USING (order_id)""")
_moved = lambda t, k, c: f"""SELECT {k}, {c}, TIMESTAMP '2000-01-01 00:00:00' AS valid_from,
    CASE WHEN {k} % 3 = 0 AND {c} IS DISTINCT FROM 'moved' THEN TIMESTAMP '2000-06-01 00:00:00' END AS valid_to FROM {t}
    UNION ALL SELECT {k}, 'moved', TIMESTAMP '2000-06-01 00:00:00', NULL FROM {t} WHERE {k} % 3 = 0 AND {c} IS DISTINCT FROM 'moved'"""  # noqa: E731
O["snapshot_sellers"] = sql("s", _moved("s", "seller_id", "seller_city"))
O["snapshot_customers"] = sql("c", _moved("c", "customer_id", "customer_city"))
O["dim_geolocation"] = sql("g", "SELECT md5(zip_code_prefix || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS id, * EXCLUDE (last_seen, is_current), is_current FROM (" + _versions(
    "(SELECT *, TIMESTAMP '1970-01-01 00:00:00' + to_days(CAST(trunc(abs(lat)) AS INTEGER)) AS seen_at FROM g)", "zip_code_prefix", "seen_at", ["city", "state"]) + ")")
O["incremental_load"] = """SELECT user_id, event_id, event_type, ts AS updated_at, max(ts) OVER () AS bookmark FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1"""
O["keyed_parts"] = " UNION ALL ".join(f"""SELECT {n} AS step, count(DISTINCT event_id) AS n_rows, TRUE AS bounded, TRUE AS rewrites_bounded
    FROM events WHERE ts <= {day}""" for n, day in enumerate(("TIMESTAMP '2024-01-05 00:00:00'", CUT1, f"{CUT1} + INTERVAL 30 MINUTE", CUT2), 1))
O["table_versions"] = """
    WITH n AS (SELECT count(*) AS n, count(*) FILTER (s_suppkey % 2 = 0) AS m FROM supplier)
    SELECT '1' AS version, n AS n_rows FROM n UNION ALL SELECT '2', n + m FROM n UNION ALL SELECT '3', m FROM n"""
O["snapshot_fact"] = sql("f", """
    WITH s AS (SELECT id, order_item_id, order_status, strftime(order_purchase_timestamp, '%Y%m') = '199603' AND id % 3 = 0 AS moved FROM f)
    SELECT id, order_item_id, order_status, TIMESTAMP '2000-01-01 00:00:00' AS valid_from,
      CASE WHEN moved THEN TIMESTAMP '2000-06-01 00:00:00' END AS valid_to FROM s
    UNION ALL SELECT id, order_item_id, 'returned', TIMESTAMP '2000-06-01 00:00:00', NULL FROM s WHERE moved""")
O["ml_folds"] = sql("o", """SELECT CAST(('0x' || md5(label || '|' || order_id)[1:8])::BIGINT % 3 AS INTEGER) AS fold, label, count(*) AS n_rows,
      count(DISTINCT order_id) AS n_orders
    FROM (SELECT order_id, CAST(delivered_ts > estimated_ts AS INTEGER) AS label FROM o WHERE order_status = 'delivered' AND delivered_ts IS NOT NULL)
    GROUP BY 1, 2""")
O["payments_latest"] = sql("p o", """SELECT order_id, count(*) AS payment_record_count, max(purchase_ts + to_hours(payment_sequential)) AS latest_update
    FROM p JOIN o USING (order_id) GROUP BY 1""")
O["geo_latest"] = sql("g c o", """SELECT zip_code_prefix, city, state, count(*) AS n_points, max(newest) AS latest_update
    FROM g LEFT JOIN (SELECT customer_zip_code_prefix AS zip_code_prefix, max(purchase_ts) AS newest FROM o JOIN c USING (customer_id) GROUP BY 1) USING (zip_code_prefix)
    GROUP BY 1, 2, 3""")
O["marked_csv"] = sql("s", "SELECT seller_id, seller_city, seller_state FROM s")
O["stream_tables"] = "SELECT DISTINCT 'public-' || event_type AS stream, event_type || '_raw' AS table_name FROM events"

ORACLES = O
