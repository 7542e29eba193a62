"""Raw commerce tables derived from a generic order star schema (orders, lineitem, part, ...).

Every role is a projection of whole tables, so its size follows theirs. Expressions are plain SQL
text: readable, and evaluated inside the scan stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.plans.stage import stage_geolocation, stage_table

# English names of five of the six product types; the sixth stays untranslated.
TRANSLATION = (
    ("economy", "budget_goods"),
    ("large", "large_goods"),
    ("promo", "promotion"),
    ("small", "small_goods"),
    ("standard", "standard_goods"),
)

# Payment type of each order priority; one priority has none.
PAYMENT_OF_PRIORITY = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "voucher",
    "5-LOW": "debit_card",
}

# Order state of each status letter.
STATUS_OF_LETTER = {"F": "delivered", "O": "shipped", "P": "processing"}

ORDERS = """
    o_orderkey AS order_id,
    o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'processing' END AS order_status,
    o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey % 1440 AS INT)) AS order_purchase_timestamp,
    o_orderdate + make_dt_interval(CAST(o_orderkey % 3 AS INT), 0, CAST(o_orderkey % 1440 AS INT)) AS order_approved_at,
    o_orderdate + make_dt_interval(CAST(o_orderkey % 3 + o_custkey % 5 AS INT), 12) AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 97 <> 0
         THEN o_orderdate + make_dt_interval(CAST((o_orderkey + o_custkey) % 62 AS INT) - 2, 18) END
        AS order_delivered_customer_date,
    o_orderdate + INTERVAL 30 DAYS AS order_estimated_delivery_date
"""

ITEMS = """
    l_orderkey AS order_id,
    CAST(l_linenumber AS BIGINT) AS order_item_id,
    l_partkey AS product_id,
    l_suppkey AS seller_id,
    l_shipdate AS shipping_limit_date,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight_value
"""

# An order is paid in 0 to 3 parts; the first part takes the odd cents.
PAYMENTS = """
    order_id,
    payment_sequential,
    CASE WHEN payment_sequential > 1 THEN 'voucher' ELSE payment_type END AS payment_type,
    1 + (order_id + payment_sequential) % 10 AS payment_installments,
    CAST(CASE WHEN payment_sequential = 1 THEN cents - (parts - 1) * (cents div parts) ELSE cents div parts END
         AS DECIMAL(14,2)) / 100 AS payment_value
"""

REVIEWS = """
    CASE WHEN event_id % 10 = 9 THEN event_id - 1 ELSE event_id END AS review_id,
    event_id div 2 AS order_id,
    CAST(1 + CAST(round(value * 100) AS BIGINT) % 5 AS INT) AS review_score,
    event_type AS review_comment_title,
    CASE WHEN event_type = 'error' THEN ' ' ELSE props END AS review_comment_message,
    CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) AS review_creation_date,
    ts AS review_answer_timestamp
"""

PRODUCTS = """
    p_partkey AS product_id,
    lower(p_type) AS product_category_name,
    CAST(length(p_name) AS INT) AS product_name_lenght,
    CASE WHEN p_size % 7 <> 0 THEN p_size * 100 END AS product_weight_g,
    p_size AS product_length_cm,
    CAST(p_size % 10 + 1 AS INT) AS product_height_cm,
    CAST(p_size % 4 + 1 AS INT) AS product_width_cm
"""


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(df: DataFrame, columns: str) -> DataFrame:
    out, depth, part = [], 0, ""
    for ch in columns:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(part)
            part = ""
        else:
            part += ch
    return df.selectExpr(*[c.strip() for c in [*out, part]])


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 rows at every scale."""
    return F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(_read(spark, sf_dir, "orders"), ORDERS)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(_read(spark, sf_dir, "lineitem"), ITEMS)


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.create_map(*[F.lit(x) for pair in PAYMENT_OF_PRIORITY.items() for x in pair])
    parts = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.try_element_at(kinds, F.col("o_orderpriority")).alias("payment_type"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        (F.col("o_orderkey") % 4).alias("parts"),
    )
    numbered = parts.filter("parts > 0").withColumn(
        "payment_sequential", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("parts")))
    )
    return _pick(numbered, PAYMENTS).withColumn("payment_value", F.col("payment_value").cast("decimal(12,2)"))


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(_read(spark, sf_dir, "events"), REVIEWS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").join(
        _nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return c.selectExpr(
        "c_custkey AS customer_id",
        "c_custkey div 2 AS customer_unique_id",
        "lpad(CAST(c_custkey div 3 AS STRING), 5, '0') AS customer_zip_code_prefix",
        "lower(c_mktsegment) AS customer_city",
        "n_name AS customer_state",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(_read(spark, sf_dir, "part"), PRODUCTS)


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").join(
        _nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    return s.selectExpr(
        "s_suppkey AS seller_id",
        "lpad(CAST(s_suppkey * 7 AS STRING), 5, '0') AS seller_zip_code_prefix",
        "concat('city ', CAST(s_suppkey % 11 AS STRING)) AS seller_city",
        "n_name AS seller_state",
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").join(
        _nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return c.selectExpr(
        "lpad(CAST(c_custkey div 3 AS STRING), 5, '0') AS zip_code_prefix",
        "CAST(c_acctbal AS DECIMAL(12,2)) AS lat",
        "CAST(-c_acctbal AS DECIMAL(12,2)) AS lng",
        "lower(c_mktsegment) AS city",
        "n_name AS state",
    )


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup of five rows at every scale."""
    schema = "product_category_name string, product_category_name_english string"
    return spark.createDataFrame(list(TRANSLATION), schema)


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "customers": customers,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "product_category_name_translation": translation,
}


class Tables(dict):
    """Raw or stage tables of one folder, made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = True):
        super().__init__()
        self.spark, self.sf_dir, self.staged = spark, sf_dir, staged

    def __missing__(self, name: str) -> DataFrame:
        raw = RAW[name](self.spark, self.sf_dir)
        if not self.staged:
            self[name] = raw
        elif name == "geolocation":
            self[name] = stage_geolocation(raw)
        else:
            self[name] = stage_table(name, raw)
        return self[name]
