"""Star schema: order-item fact with quality flags, sales fact with payment allocation, dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.functions.clean import clamp_null, require, total
from orderloom.functions.dates import date_key, date_spine, days_between, is_weekend, sunday_week
from orderloom.operators.aggregates import geo_rollup, payments_rollup, reviews_rollup
from orderloom.operators.joins import keep_all, lookup
from orderloom.plans.stage import last_payments, typed_reviews

# What counts as dear and as slow.
HIGH_VALUE = 10_000
LONG_DELIVERY_DAYS = 30


def quality_flags(as_of: Column, high_value: float = HIGH_VALUE) -> dict[str, Column]:
    """Seven true/false flags, never NULL, over the columns of ``fact_orders``."""
    delivered = F.col("order_delivered_customer_date")
    bought = F.col("order_purchase_timestamp")
    yes = lambda condition: F.coalesce(condition, F.lit(False))
    return {
        "has_invalid_delivery_date": yes(delivered < bought),
        "is_overdue_delivery": yes((F.col("order_estimated_delivery_date") < as_of) & delivered.isNull()),
        "is_high_value_product": yes(F.col("price") > high_value),
        "has_missing_delivery_date": yes((F.col("order_status") == "delivered") & delivered.isNull()),
        "is_long_delivery": yes(days_between(delivered, bought) > LONG_DELIVERY_DAYS),
        "has_missing_payment_info": yes(F.col("payment_type") == "not_defined") | F.col("payment_value").isNull(),
        "has_no_items": F.col("order_item_id").isNull(),
    }


def clean_items(items: DataFrame) -> DataFrame:
    """Items with all keys; implausible money becomes NULL while the row stays."""
    return require(items, "order_id", "order_item_id", "product_id", "seller_id").withColumns({
        "price": clamp_null("price", lo=0, lo_open=True),
        "freight_value": clamp_null("freight_value", lo=0),
    })


def clean_orders(orders: DataFrame) -> DataFrame:
    return require(orders, "order_id", "customer_id").withColumn(
        "order_status", F.lower(F.coalesce("order_status", F.lit("unavailable")))
    )


def order_payments(payments: DataFrame, policy: str = "last") -> DataFrame:
    """One payment row per order: the ``last`` one, or their ``sum`` (type and count of the last)."""
    payments = require(payments, "order_id")
    last = last_payments(payments).select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )
    if policy == "last":
        return last
    if policy == "sum":
        sums = payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_value"))
        return last.drop("payment_value").join(sums, "order_id")
    raise ValueError(f"unknown payment policy {policy!r}")


def fact_orders(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame | None,
    as_of: Column,
    payment_policy: str = "last",
    high_value: float = HIGH_VALUE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row per order item; orders without items stay once with a NULL item.

    Orders that own a great share of the items are looked for in ``counted`` (see ``joins.keep_all``), best the raw items.

    Payments are one row per order and meet the order first, so nothing fans out and the only join
    that sees item skew is the last one. Without ``payments`` their columns and flag are left out: an
    unused left join costs a shuffle that the optimizer cannot drop.
    """
    o = clean_orders(orders).select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    )
    i = clean_items(items).select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"
    )
    flags = quality_flags(as_of, high_value)
    if payments is None:
        joined = keep_all(o, i, "order_id", counted)
        del flags["has_missing_payment_info"]
    else:
        joined = keep_all(lookup(o, order_payments(payments, payment_policy), "order_id"), i, "order_id", counted)
        joined = joined.withColumn("payment_type", F.lower(F.coalesce("payment_type", F.lit("not_defined"))))
    return joined.withColumns(flags).withColumnRenamed("order_id", "id")


def fact_sales(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per sold item; the order's payments are shared out by line amount.

    Totals, payments and reviews meet the order first, one row each; the items come last.
    """
    lines = clean_items(items).withColumn(
        "total_sale_amount", F.coalesce("price", F.lit(0)) + F.coalesce("freight_value", F.lit(0))
    )
    per_order = lines.groupBy("order_id").agg(total("total_sale_amount").alias("order_items_total_amount"))
    o = clean_orders(orders)
    bought, delivered, due = (
        F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    )
    heads = o
    for side in (per_order, payments_rollup(payments), reviews_rollup(typed_reviews(reviews))):
        heads = lookup(heads, side, "order_id")
    joined = lines.join(heads, "order_id")
    line = F.col("total_sale_amount").cast("double")
    return joined.select(
        F.md5(F.concat_ws("-", F.col("order_id").cast("string"), F.col("order_item_id").cast("string"))).alias("sales_key"),
        "order_id", "order_item_id", "customer_id", "product_id", "seller_id", "order_status",
        date_key(bought).alias("purchase_date_key"),
        date_key("order_approved_at").alias("approved_date_key"),
        date_key(delivered).alias("delivered_customer_date_key"),
        date_key(due).alias("estimated_delivery_date_key"),
        "price", "freight_value", "total_sale_amount",
        "payment_record_count", "total_payment_value",
        F.when(
            F.col("order_items_total_amount") > 0,
            F.col("total_payment_value") * line / F.nullif(F.col("order_items_total_amount"), F.lit(0.0)),
        ).alias("allocated_payment_value"),
        "max_payment_installments", "payment_types",
        "review_record_count", "avg_review_score", "max_review_score", "min_review_score", "has_review_comment",
        "latest_review_creation_date", "latest_review_answer_timestamp",
        days_between(delivered, bought).alias("delivery_days"),
        days_between(delivered, due).alias("delivery_delay_days"),
        (delivered > due).alias("is_late_delivery"),
    )


def fct_order_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item lines with surrogate keys, line total and lead time."""
    key = lambda *cs: F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in cs]))
    return clean_items(items).join(clean_orders(orders), "order_id").select(
        key("order_id", "order_item_id").alias("order_item_sk"),
        key("customer_id").alias("customer_sk"),
        key("product_id").alias("product_sk"),
        "order_id", "order_item_id", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_line_value"),
        days_between("order_delivered_customer_date", "order_purchase_timestamp").alias("delivery_lead_time_days"),
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").alias("id"), "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    )


def dim_sellers(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """Sellers with the mean point of their zip, NULL where the zip is unknown."""
    points = geo.select(F.col("zip_code_prefix").alias("seller_zip_code_prefix"), "avg_lat", "avg_lng")
    return lookup(sellers, points, "seller_zip_code_prefix").select(
        F.col("seller_id").alias("id"), "seller_zip_code_prefix", "seller_city", "seller_state",
        F.col("avg_lat").alias("geo_lat"), F.col("avg_lng").alias("geo_lng"),
    )


def override_places(sellers: DataFrame, places: DataFrame) -> DataFrame:
    """City and state as the zip table spells them, own spelling where the zip is unknown."""
    p = places.select(
        F.col("zip_code_prefix").alias("seller_zip_code_prefix"), F.col("city").alias("_city"), F.col("state").alias("_state"),
        F.lit(True).alias("zip_codes_match"),
    )
    joined = lookup(sellers, p, "seller_zip_code_prefix")
    match = F.coalesce("zip_codes_match", F.lit(False))
    return joined.select(
        "seller_id", "seller_zip_code_prefix",
        F.when(match, F.col("_city")).otherwise(F.col("seller_city")).alias("seller_city"),
        F.when(match, F.col("_state")).otherwise(F.col("seller_state")).alias("seller_state"),
        match.alias("zip_codes_match"),
    )


def product_attributes(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category; the misspelt length columns are renamed."""
    for old, new in (
        ("product_name_lenght", "product_name_length"),
        ("product_description_lenght", "product_description_length"),
    ):
        products = products.withColumnRenamed(old, new)
    english = translation.withColumnRenamed("product_category_name_english", "product_category")
    return lookup(products, english, "product_category_name")


def dim_products(versions: DataFrame, translation: DataFrame) -> DataFrame:
    """Product versions with the English category (NULL where none is known), ``category`` that falls back to the raw one,
    and ``is_current``."""
    df = product_attributes(versions, translation).withColumn("category", category_or_default()).drop("product_category_name")
    return df.withColumnRenamed("version_id", "surrogate_key").withColumn("is_current", F.col("valid_to").isNull())


def category_or_default(english: str = "product_category", raw: str = "product_category_name") -> Column:
    """English category, else the raw one, else 'unknown'."""
    return F.coalesce(F.col(english), F.col(raw), F.lit("unknown"))


# Fixed value: where counting starts for a source without a moment.
EPOCH = "1970-01-01 00:00:00"


def latest_update(*moments: str) -> Column:
    """The newest of several moments; an absent one counts as the epoch."""
    return F.greatest(*[F.coalesce(F.col(m), F.lit(EPOCH).cast("timestamp_ntz")) for m in moments])


def dim_versions(versions: DataFrame) -> DataFrame:
    """Review or geolocation versions as a dimension keyed by version."""
    return versions.withColumnRenamed("version_id", "id").withColumn("is_current", F.col("valid_to").isNull())


def dim_location(geo: DataFrame) -> DataFrame:
    place = ["zip_code_prefix", "city", "state"]
    return geo_rollup(geo, place).select(
        F.md5(F.concat_ws("-", *place)).alias("location_key"), *place, "avg_lat", "avg_lng", "n_points"
    )


def dim_date(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Every day from the first purchase to the last promised delivery."""
    bounds = orders.agg(
        F.min(F.col("order_purchase_timestamp").cast("date")).alias("lo"),
        F.max(F.col("order_estimated_delivery_date").cast("date")).alias("hi"),
    )
    day = F.col("full_date")
    return date_spine(spark, bounds, "lo", "hi").select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        sunday_week(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    )


def analysis_orders(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, items: DataFrame, reviews: DataFrame, geo: DataFrame
) -> DataFrame:
    """Order table for analysis: every many-side summed to the order before its join."""
    paid = payments.groupBy("order_id").agg(total("payment_value").alias("total_paid"))
    sold = items.groupBy("order_id").agg(
        F.max("order_item_id").alias("total_items"),
        total("price").alias("total_price"),
        total("freight_value").alias("total_freight"),
    )
    scored = reviews.groupBy("order_id").agg(F.avg("review_score").alias("avg_review_score"))
    points = geo.select(
        F.col("zip_code_prefix").alias("customer_zip_code_prefix"), F.col("avg_lat").alias("lat"), F.col("avg_lng").alias("lng")
    )
    df = lookup(orders, customers, "customer_id")
    for side, key in ((paid, "order_id"), (sold, "order_id"), (scored, "order_id"), (points, "customer_zip_code_prefix")):
        df = lookup(df, side, key)
    return df


def analysis_payments(payments: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Payment rows with purchase time and customer place."""
    df = lookup(payments, orders.select("order_id", "order_purchase_timestamp", "customer_id"), "order_id")
    return lookup(df, customers.select("customer_id", "customer_state", "customer_city"), "customer_id")


def analysis_products(
    items: DataFrame, products: DataFrame, translation: DataFrame, sellers: DataFrame, orders: DataFrame
) -> DataFrame:
    """Item rows with product, English category, seller and order status."""
    df = lookup(items, product_attributes(products, translation), "product_id")
    df = lookup(df, sellers, "seller_id")
    return lookup(df, orders.select("order_id", "order_purchase_timestamp", "order_status"), "order_id")


def denormalised(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, customers: DataFrame, products: DataFrame,
    counted: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Orders with every item, payment and review side by side: the fan-out is wanted here.

    ``counted`` holds the raw tables, if they are at hand (see ``joins.keep_all``). Customers meet the orders while there is one row of each; the items, which an order may have most of, come last but for
    the products, whose join the optimizer can split.
    """
    df = lookup(orders, customers, "customer_id")
    for lines, name in ((payments, "order_payments"), (reviews, "order_reviews"), (items, "order_items")):
        df = keep_all(df, lines, "order_id", counted[name] if counted else None)
    return lookup(df, products, "product_id")
