"""Delivery and review metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.clean import bool_mean, count_true, ratio
from orderloom.functions.dates import days_between, elapsed_hours
from orderloom.functions.labels import (
    DELIVERY_BUCKETS, REVIEW_BUCKETS, delivery_outcome, review_bucket, right_closed,
)
from orderloom.operators.aggregates import even_histogram, quadratic_trend, weighted_median
from orderloom.operators.joins import share_of_total


def outcome_split(orders: DataFrame) -> DataFrame:
    """Orders on time, late (by timestamp) and not delivered."""
    return orders.groupBy(delivery_outcome("delivered_ts", "estimated_ts").alias("delivery_outcome")).agg(
        F.count(F.lit(1)).alias("orders")
    )


def judged(orders: DataFrame) -> DataFrame:
    """Delivered orders with both dates."""
    return orders.filter(F.col("is_delivered") & F.col("days_vs_estimate").isNotNull())


def late_rate(orders: DataFrame, by: str) -> DataFrame:
    """Late share (by calendar day) of delivered orders per state, month or other column."""
    return judged(orders).groupBy(by).agg(
        F.count(F.lit(1)).alias("orders"), count_true("is_late").alias("late"), bool_mean("is_late").alias("late_rate")
    )


def late_rate_of_large(orders: DataFrame, by: str = "customer_state", min_orders: int = 500) -> DataFrame:
    """Percent late (by timestamp) for groups with at least ``min_orders`` deliveries."""
    d = orders.filter(F.col("is_delivered") & F.col("delivered_ts").isNotNull() & F.col("estimated_ts").isNotNull())
    late = F.col("delivered_ts") > F.col("estimated_ts")
    rates = d.groupBy(by).agg(F.count(F.lit(1)).alias("orders"), (bool_mean(late) * 100).alias("late_pct"))
    return rates.filter(F.col("orders") >= min_orders)


def score_distribution(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("review_score").isNotNull()).groupBy("review_score").agg(F.count(F.lit(1)).alias("orders"))


def _in_order(df: DataFrame, column: str, labels: tuple[str, ...]) -> DataFrame:
    """Adds the display position of a bucket; empty buckets simply have no row."""
    positions = F.create_map(*[x for i, l in enumerate(labels) for x in (F.lit(l), F.lit(i + 1))])
    return df.withColumn("position", positions[F.col(column)])


def score_by_bucket(orders: DataFrame) -> DataFrame:
    """Mean review per delivery bucket."""
    d = orders.filter(F.col("delivery_bucket").isNotNull() & F.col("review_score").isNotNull())
    means = d.groupBy("delivery_bucket").agg(F.avg("review_score").alias("avg_review"), F.count(F.lit(1)).alias("orders"))
    return _in_order(means, "delivery_bucket", DELIVERY_BUCKETS)


def reorder_by(orders: DataFrame, bucket: str) -> DataFrame:
    """Share of orders the same person followed by another, per delivery or review bucket."""
    rates = orders.filter(F.col(bucket).isNotNull()).groupBy(bucket).agg(
        bool_mean("has_subsequent_order").alias("reorder_rate"), F.count(F.lit(1)).alias("orders")
    )
    return _in_order(rates, bucket, DELIVERY_BUCKETS if bucket == "delivery_bucket" else REVIEW_BUCKETS)


def relative_gap(rates: DataFrame, measure: str) -> DataFrame:
    """How much lower (or higher) the last bucket is than the first, as a share of the first."""
    ends = rates.agg(
        F.min_by(measure, "position").alias("first_value"), F.max_by(measure, "position").alias("last_value")
    )
    return ends.withColumn("relative_gap", ratio(F.col("last_value"), F.col("first_value")) - 1)


def lead_histogram(orders: DataFrame, bins: int = 40) -> DataFrame:
    """Orders per lead-time bin, with so many bins of equal width from zero to the longest time."""
    return even_histogram(orders.filter(F.col("delivery_days") >= 0), "delivery_days", bins)


def lead_median(orders: DataFrame) -> DataFrame:
    return weighted_median(orders.filter(F.col("delivery_days") >= 0), [], "delivery_days", "median_days")


def lead_by_state(orders: DataFrame) -> DataFrame:
    """Mean and median lead time and order count per state."""
    d = orders.filter(F.col("delivery_days").isNotNull())
    means = d.groupBy("customer_state").agg(F.count(F.lit(1)).alias("orders"), F.avg("delivery_days").alias("avg_days"))
    return means.join(weighted_median(d, ["customer_state"], "delivery_days", "median_days"), "customer_state")


def score_by_day_late(orders: DataFrame, reach: int = 30) -> DataFrame:
    """Mean review per day early or late, within ``reach`` days of the promise."""
    d = orders.filter(F.col("days_vs_estimate").between(-reach, reach) & F.col("review_score").isNotNull())
    return d.groupBy("days_vs_estimate").agg(F.avg("review_score").alias("avg_review"), F.count(F.lit(1)).alias("orders"))


def score_trend(orders: DataFrame, reach: int = 30) -> DataFrame:
    """Second-order fit of the daily mean review."""
    return quadratic_trend(score_by_day_late(orders, reach), "avg_review", "days_vs_estimate")


def review_profile(orders: DataFrame) -> DataFrame:
    """n, mean score, percent detractors and promoters of on-time and late deliveries."""
    d = orders.filter(
        F.col("is_delivered") & F.col("delivered_ts").isNotNull() & F.col("estimated_ts").isNotNull()
        & F.col("review_score").isNotNull()
    )
    outcome = F.when(F.col("delivered_ts") > F.col("estimated_ts"), "Late").otherwise("On-time")
    return d.groupBy(outcome.alias("delivery")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("review_score").alias("avg_score"),
        (bool_mean(F.col("review_score") <= 2) * 100).alias("pct_detractor"),
        (bool_mean(F.col("review_score") >= 4) * 100).alias("pct_promoter"),
    )


def review_composition(orders: DataFrame) -> DataFrame:
    """Percent of detractor, neutral and promoter scores within each delivery outcome."""
    d = orders.filter(
        F.col("is_delivered") & F.col("delivered_ts").isNotNull() & F.col("estimated_ts").isNotNull()
        & F.col("review_score").isNotNull()
    )
    outcome = F.when(F.col("delivered_ts") > F.col("estimated_ts"), "Late").otherwise("On-time")
    band = right_closed("review_score", [0, 2, 3, 5], ["detractor", "neutral", "promoter"])
    counts = d.groupBy(outcome.alias("delivery"), band.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("delivery").agg(F.sum("n").alias("_all"))
    return counts.join(totals, "delivery").withColumn("pct", ratio(F.col("n"), F.col("_all")) * 100).drop("_all")


def review_summary(reviews: DataFrame) -> DataFrame:
    """Current reviews: count, mean score, share of 1-2 stars."""
    return reviews.filter(F.col("review_score").isNotNull()).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.avg("review_score").alias("avg_score"),
        bool_mean(F.col("review_score") <= 2).alias("low_share"),
    )


def score_shares(reviews: DataFrame) -> DataFrame:
    counts = reviews.filter(F.col("review_score").isNotNull()).groupBy("review_score").agg(F.count(F.lit(1)).alias("reviews"))
    return share_of_total(counts, "reviews")


def handling_stages(orders: DataFrame) -> DataFrame:
    """Per order: hours to approval, whole elapsed days at the seller, elapsed days against the promise."""
    return orders.select(
        "order_id",
        elapsed_hours("order_approved_at", "order_purchase_timestamp").alias("approval_hours"),
        days_between("order_delivered_carrier_date", "order_approved_at", "elapsed").alias("carrier_handling_days"),
        days_between("order_delivered_customer_date", "order_estimated_delivery_date", "elapsed").alias("delivery_diff"),
    )


def lane_scorecard(orders: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """Customer state x category, ranked by late rate times GMV. ``categories`` maps product to category."""
    lines = items.select("order_id", "product_id", "price").join(categories, "product_id", "left")
    late = judged(orders).select("order_id", "customer_state", "is_late").join(lines, "order_id")
    category = F.coalesce("product_category", F.lit("unknown")).alias("product_category")
    lanes = late.groupBy("customer_state", category).agg(
        F.count(F.lit(1)).alias("items"),
        bool_mean("is_late").alias("late_rate"),
        F.sum("price").cast("double").alias("gmv"),
    )
    return lanes.withColumn("risk", F.col("late_rate") * F.col("gmv"))


def with_review_bucket(orders: DataFrame) -> DataFrame:
    return orders.withColumn("review_bucket", review_bucket("review_score"))
