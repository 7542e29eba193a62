"""Business questions over the item-grain fact. Reviews come as one row per order, products and
sellers as one row per key, so sums and means count every item once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.clean import count_true, ratio, round_half_up, total
from orderloom.functions.dates import days_between, month_start, season
from orderloom.operators.aggregates import linear_trend, mode_per_group, value_counts
from orderloom.operators.joins import lookup


def delivered(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_status") == "delivered")


def revenue_by_month(fact: DataFrame) -> DataFrame:
    """Delivered orders: volume, customers, revenue and freight per month."""
    month = month_start("order_purchase_timestamp").alias("month")
    d = delivered(fact).filter(F.col("order_purchase_timestamp").isNotNull())
    per_order = d.groupBy(month, "id", "customer_id").agg(
        F.sum("price").alias("price"), F.sum("freight_value").alias("freight"),
        F.sum(F.col("price") + F.col("freight_value")).alias("both"), F.count("price").alias("priced"),
    )
    per_customer = per_order.groupBy("month", "customer_id").agg(
        F.count(F.lit(1)).alias("orders"), *[F.sum(c).alias(c) for c in ("price", "freight", "both", "priced")]
    )
    return per_customer.groupBy("month").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        total("price").alias("gross_revenue"),
        total("freight").alias("total_freight"),
        total("both").alias("total_revenue"),
        round_half_up(F.try_divide(total("price"), F.sum("priced")), 2).alias("avg_order_value"),
    )


def _per_order(df: DataFrame, *keys: str) -> DataFrame:
    """Partial sums per group and order: the step that turns distinct orders into a plain count."""
    return df.groupBy(*keys, "id").agg(
        F.sum("price").alias("price"),
        F.count("price").alias("priced"),
        F.sum("freight_value").alias("freight"),
        F.count("freight_value").alias("freighted"),
        F.sum("review_score").alias("stars"),
        F.count("review_score").alias("starred"),
        count_true("is_long_delivery").alias("long"),
        count_true("has_invalid_delivery_date").alias("invalid"),
        count_true("is_overdue_delivery").alias("overdue"),
        F.sum(days_between("order_delivered_customer_date", "order_purchase_timestamp")).alias("days"),
        F.count(days_between("order_delivered_customer_date", "order_purchase_timestamp")).alias("dayed"),
        F.sum(days_between("order_estimated_delivery_date", "order_delivered_customer_date")).alias("early"),
        F.count(days_between("order_estimated_delivery_date", "order_delivered_customer_date")).alias("earlied"),
        F.sum(F.try_divide(F.col("freight_value").cast("double"), F.col("price").cast("double"))).alias("fshare"),
        F.count(F.try_divide(F.col("freight_value").cast("double"), F.col("price").cast("double"))).alias("fshared"),
        F.count(F.lit(1)).alias("rows"),
    )


def _avg(value: str, n: str, digits: int) -> Column:
    return round_half_up(F.try_divide(total(value), F.sum(n)), digits)


def seller_ranking(fact: DataFrame, sellers: DataFrame, scores: DataFrame) -> DataFrame:
    d = lookup(delivered(fact), scores, "id")
    sums = _per_order(d, "seller_id").groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        total("price").alias("total_revenue"),
        _avg("price", "priced", 2).alias("avg_order_value"),
        _avg("stars", "starred", 2).alias("avg_review_score"),
        F.sum("long").alias("long_delivery_count"),
        F.sum("invalid").alias("invalid_delivery_count"),
    )
    return lookup(sums, sellers.select("seller_id", "seller_state", "seller_city"), "seller_id")


def category_performance(fact: DataFrame, categories: DataFrame, scores: DataFrame) -> DataFrame:
    d = lookup(lookup(delivered(fact), categories, "product_id"), scores, "id")
    return _per_order(d, "product_category").groupBy("product_category").agg(
        F.count(F.lit(1)).alias("total_orders"),
        total("price").alias("total_revenue"),
        _avg("price", "priced", 2).alias("avg_price"),
        _avg("freight", "freighted", 2).alias("avg_freight"),
        _avg("stars", "starred", 2).alias("avg_review_score"),
        F.sum("long").alias("long_deliveries"),
        F.round(F.try_divide(F.sum("fshare"), F.sum("fshared")) * 100, 2).alias("freight_pct_of_price"),
    )


def payment_mix(fact: DataFrame) -> DataFrame:
    """Payment type by instalments over delivered orders with a known type."""
    d = delivered(fact).filter(F.col("payment_type") != "not_defined")
    per_order = d.groupBy("payment_type", "payment_installments", "id").agg(
        F.sum("price").alias("price"), F.count("price").alias("priced"),
        F.sum("payment_value").alias("paid"), F.count("payment_value").alias("payments"),
    )
    return per_order.groupBy("payment_type", "payment_installments").agg(
        F.count(F.lit(1)).alias("total_orders"),
        total("price").alias("total_revenue"),
        _avg("price", "priced", 2).alias("avg_order_value"),
        _avg("paid", "payments", 2).alias("avg_payment_value"),
    )


def sla_by_seller_state(fact: DataFrame, sellers: DataFrame) -> DataFrame:
    """Positive days against the estimate are early, negative late."""
    d = delivered(fact).filter(F.col("order_delivered_customer_date").isNotNull())
    d = lookup(d, sellers.select("seller_id", "seller_state"), "seller_id").withColumn("review_score", F.lit(None).cast("int"))
    return _per_order(d, "seller_state").groupBy("seller_state").agg(
        F.count(F.lit(1)).alias("total_orders"),
        _avg("days", "dayed", 1).alias("avg_delivery_days"),
        _avg("early", "earlied", 1).alias("avg_days_vs_estimate"),
        F.sum("long").alias("long_deliveries"),
        F.sum("overdue").alias("overdue_deliveries"),
        round_half_up(ratio(F.sum("overdue"), F.sum("rows")) * 100, 2).alias("overdue_rate_pct"),
    )


def revenue_by_customer_state(fact: DataFrame, customers: DataFrame, scores: DataFrame) -> DataFrame:
    d = lookup(lookup(delivered(fact), customers.select("customer_id", "customer_state"), "customer_id"), scores, "id")
    per_order = _per_order(d, "customer_state", "customer_id")
    per_customer = per_order.groupBy("customer_state", "customer_id").agg(
        F.count(F.lit(1)).alias("orders"), *[F.sum(c).alias(c) for c in ("price", "priced", "stars", "starred")]
    )
    return per_customer.groupBy("customer_state").agg(
        F.count("customer_id").alias("unique_customers"),
        F.sum("orders").alias("total_orders"),
        total("price").alias("total_revenue"),
        _avg("price", "priced", 2).alias("avg_order_value"),
        _avg("stars", "starred", 2).alias("avg_satisfaction"),
        round_half_up(ratio(F.sum("orders"), F.count("customer_id")), 2).alias("orders_per_customer"),
    )


def category_by_score(fact: DataFrame, categories: DataFrame, scores: DataFrame) -> DataFrame:
    d = fact.join(scores.filter(F.col("review_score").isNotNull()), "id")
    d = lookup(d, categories, "product_id").withColumn("score", F.col("review_score"))
    return _per_order(d, "product_category", "score").groupBy(
        "product_category", F.col("score").alias("review_score")
    ).agg(
        F.count(F.lit(1)).alias("total_orders"),
        _avg("price", "priced", 2).alias("avg_price"),
        _avg("days", "dayed", 1).alias("avg_delivery_days"),
        _avg("freight", "freighted", 2).alias("avg_freight"),
    )


# Exploration -------------------------------------------------------------------------------


def with_calendar(orders: DataFrame, ts: str = "purchase_ts") -> DataFrame:
    """year, month, day, hour, weekday name and season of the purchase."""
    t = F.col(ts)
    return orders.withColumns({
        "purchase_year": F.year(t), "purchase_month": F.month(t), "purchase_day": F.dayofmonth(t),
        "purchase_hour": F.hour(t), "purchase_day_name": F.date_format(t, "EEEE"),
        "purchase_dow": F.weekday(t), "season": season(F.month(t)),
    })


def sales_by(orders: DataFrame, by: str) -> DataFrame:
    """Revenue, freight, freight per revenue and orders per value of a column."""
    gmv, freight = F.round(F.sum("gmv"), 2), F.round(F.sum("freight"), 2)
    return orders.groupBy(by).agg(
        gmv.alias("sales"), freight.alias("freight"), ratio(freight, gmv).alias("freight_ratio"),
        F.count(F.lit(1)).alias("orders"),
    )


def local_freight(items: DataFrame, sellers: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Freight of items whose seller is in the customer's state, and of the others."""
    where = lookup(orders.select("order_id", "customer_id"), customers.select("customer_id", "customer_state"), "customer_id")
    df = lookup(items.select("order_id", "seller_id", "freight_value"), where, "order_id")
    df = lookup(df, sellers.select("seller_id", "seller_state"), "seller_id")
    same = F.coalesce(F.col("seller_state") == F.col("customer_state"), F.lit(False))
    kind = F.when(same, "Local").otherwise("Non-local").alias("shipping")
    return df.groupBy(kind).agg(total("freight_value").alias("freight"), F.count(F.lit(1)).alias("items"))


def top_by_revenue(items: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """A top-k report by revenue (sellers, cities, states)."""
    sums = items.groupBy(*keys).agg(total("price").alias("revenue"), F.count(F.lit(1)).alias("items"))
    return sums.orderBy(F.col("revenue").desc_nulls_last(), *keys).limit(n)


def top_by_count(items: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    counts = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), *[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def vip_customers(
    payments: DataFrame, orders: DataFrame, customers: DataFrame, items: DataFrame, categories: DataFrame, n: int = 10
) -> DataFrame:
    """Top customers by payments with modal payment type, item count and first category by name.

    The ten winners are known before items are read: every later join is a semi-join on ten rows.
    """
    paid = payments.join(orders.select("order_id", "customer_id"), "order_id")
    sums = paid.groupBy("customer_id").agg(F.sum("payment_value").alias("paid"))
    top = sums.orderBy(F.col("paid").desc(), "customer_id").limit(n)
    ids = F.broadcast(top.select("customer_id"))
    modal = mode_per_group(paid.join(ids, "customer_id", "left_semi"), ["customer_id"], "payment_type", "modal_type")
    bought = (
        orders.select("order_id", "customer_id").join(ids, "customer_id", "left_semi")
        .join(items.select("order_id", "product_id"), "order_id").join(categories, "product_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("product_id").alias("total_items"),
            F.min("product_category").alias("first_category"),
            F.count_distinct("product_category").alias("n_categories"),
        )
    )
    person = customers.select("customer_id", F.right(F.col("customer_unique_id").cast("string"), F.lit(8)).alias("customer_short"))
    df = lookup(lookup(lookup(top, modal.drop("modal_type_count"), "customer_id"), bought, "customer_id"), person, "customer_id")
    return df.withColumn("paid", F.col("paid").cast("double"))


def vip_products(
    payments: DataFrame, orders: DataFrame, items: DataFrame, categories: DataFrame, n: int = 10
) -> DataFrame:
    """All categories the top customers bought, as rows: no list grows with a customer."""
    paid = payments.join(orders.select("order_id", "customer_id"), "order_id")
    sums = paid.groupBy("customer_id").agg(F.sum("payment_value").alias("paid"))
    ids = F.broadcast(sums.orderBy(F.col("paid").desc(), "customer_id").limit(n).select("customer_id"))
    return (
        orders.select("order_id", "customer_id").join(ids, "customer_id", "left_semi")
        .join(items.select("order_id", "product_id"), "order_id").join(categories, "product_id", "left")
        .groupBy("customer_id", "product_category").agg(F.count(F.lit(1)).alias("items"))
    )


def payment_distributions(payments: DataFrame) -> DataFrame:
    """value_counts of sequence, type and instalments, stacked."""
    out = None
    for c in ("payment_sequential", "payment_type", "payment_installments"):
        part = value_counts(payments, c).select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), "n", "share")
        out = part if out is None else out.unionByName(part)
    return out


def freight_trend(orders: DataFrame) -> DataFrame:
    """Freight against the number of items of an order."""
    return linear_trend(orders.filter(F.col("freight").isNotNull()), "freight", "n_items")


def weight_trend(items: DataFrame, products: DataFrame) -> DataFrame:
    """Freight of an item against the weight of its product."""
    weights = products.select("product_id", "product_weight_g")
    return linear_trend(lookup(items.select("product_id", "freight_value"), weights, "product_id"), "freight_value", "product_weight_g")


def monthly_revenue_mart(fact: DataFrame, categories: DataFrame) -> DataFrame:
    """GMV and orders per month and category."""
    d = lookup(fact.filter(F.col("order_item_id").isNotNull()), categories, "product_id")
    month, category = month_start("order_purchase_timestamp"), F.coalesce("product_category", F.lit("unknown"))
    per_order = d.groupBy(month.alias("month"), category.alias("product_category"), "id").agg(F.sum("price").alias("gmv"))
    return per_order.groupBy("month", "product_category").agg(
        total("gmv").alias("gmv"), F.count(F.lit(1)).alias("order_count")
    )


def product_volume(products: DataFrame) -> DataFrame:
    sides = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return products.withColumn("volume_cm3", sides.cast("bigint"))


def freight_share(items: DataFrame) -> DataFrame:
    """Line total and freight as a percent of price per item."""
    price, freight = F.col("price").cast("double"), F.col("freight_value").cast("double")
    return items.withColumns({
        "line_total": (F.col("price") + F.col("freight_value")).cast("double"),
        "freight_pct": F.try_divide(freight, price) * 100,
    })
