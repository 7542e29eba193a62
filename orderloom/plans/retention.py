"""Cohorts, repeat purchase, customer view and customer segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.clean import bool_mean, count_true, ratio
from orderloom.functions.dates import days_between, month_start, months_between_starts
from orderloom.functions.labels import (
    mart_segment, quartile_segment, quintile_segment, rule_segment, tail_label, value_segment,
)
from orderloom.operators.joins import share_of_total, with_scalar
from orderloom.operators.ranking import quantile_bucket
from orderloom.session import cut_lineage


def person_months(orders: DataFrame) -> DataFrame:
    """Distinct (person, order month): all a cohort needs, a fraction of the orders."""
    return orders.filter(F.col("customer_unique_id").isNotNull()).select("customer_unique_id", "order_month").distinct()


def cohort_long(orders: DataFrame) -> DataFrame:
    """cohort_month, months_since, active_customers, cohort_size, retention.

    The cohort is a grouped minimum joined back on the person, never a window over a person's
    orders, so a person with very many orders is only many months at most.
    """
    months = person_months(orders)
    first = months.groupBy("customer_unique_id").agg(F.min("order_month").alias("cohort_month"))
    since = months_between_starts("order_month", "cohort_month").alias("months_since")
    active = (
        months.join(first, "customer_unique_id")
        .groupBy("cohort_month", since)
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    sizes = first.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return active.join(sizes, "cohort_month").withColumn(
        "retention", ratio(F.col("active_customers"), F.col("cohort_size"))
    )


def cohort_wide(cohorts: DataFrame, months: Sequence[int] | None = None) -> DataFrame:
    """One row per cohort, one retention column per month distance: the listed ones, or all that occur.

    There are no more distances than months in the data.
    """
    if months is None:
        months = sorted(row[0] for row in cohorts.select("months_since").distinct().collect())
    wide = cohorts.groupBy("cohort_month").pivot("months_since", list(months)).agg(F.first("retention"))
    return wide.select("cohort_month", *[F.col(str(m)).alias(f"m{m}") for m in months])


def orders_by_person(orders: DataFrame) -> DataFrame:
    known = orders.filter(F.col("customer_unique_id").isNotNull())
    return known.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("frequency"))


def repeat_rate(orders: DataFrame) -> DataFrame:
    """customers, repeat_customers, repeat_rate and the share of orders that are repeats."""
    one = orders_by_person(orders).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("frequency") > 1).alias("repeat_customers"),
        F.sum("frequency").alias("orders"),
    )
    return one.select(
        "customers", "repeat_customers", "orders",
        ratio(F.col("repeat_customers"), F.col("customers")).alias("repeat_rate"),
        ratio(F.col("orders") - F.col("customers"), F.col("orders")).alias("repeat_order_share"),
    )


def orders_per_customer(orders: DataFrame, cap: int = 5) -> DataFrame:
    capped = orders_by_person(orders).groupBy(F.least("frequency", F.lit(cap)).alias("orders_placed")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    return capped.withColumn("label", tail_label("orders_placed", cap))


def customer_view(orders: DataFrame) -> DataFrame:
    """One row per person: frequency, monetary, recency against the newest order, cohort, segment."""
    snapshot = orders.agg(F.max("purchase_ts").alias("_snapshot"))
    # the state joins the first key: a MIN over text would make Spark sort all orders
    by_state = orders.groupBy("customer_unique_id", "customer_state").agg(
        F.count(F.lit(1)).alias("n"), F.sum("gmv").alias("gmv"),
        F.min("purchase_ts").alias("_first"), F.max("purchase_ts").alias("_last"),
    )
    people = by_state.groupBy("customer_unique_id").agg(
        F.min("customer_state").alias("customer_state"),
        F.sum("n").alias("frequency"),
        F.round(F.sum("gmv"), 2).alias("monetary"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    recency = days_between("_snapshot", "_last")
    df = with_scalar(people, snapshot).withColumn("recency_days", recency)
    return df.select(
        "customer_unique_id", "customer_state", "frequency", "monetary", "recency_days",
        F.col("_first").cast("date").alias("first_order_date"),
        month_start("_first").alias("cohort_month"),
        (F.col("frequency") > 1).alias("is_repeat_customer"),
        tail_label("frequency").alias("orders_placed_bucket"),
        rule_segment("frequency", "recency_days").alias("segment"),
    )


def segment_sizes(view: DataFrame, segment: str = "segment") -> DataFrame:
    sizes = view.groupBy(segment).agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("monetary"), 2).alias("monetary")
    )
    return share_of_total(sizes, "customers")


def value_segments(orders: DataFrame, as_of: Column) -> DataFrame:
    """Per customer id, delivered orders only: recency to a given day, frequency, spend, segment."""
    people = orders.filter(F.col("is_delivered")).groupBy("customer_id").agg(
        days_between(as_of, F.max("purchase_ts")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.round(F.sum("gmv"), 2).alias("monetary"),
    )
    return people.withColumn("customer_segment", value_segment("frequency", "recency_days", "monetary"))


def rfm_base(orders: DataFrame) -> DataFrame:
    """recency (whole elapsed days to the day after the newest order), frequency, monetary."""
    snapshot = orders.agg(F.max("purchase_ts").alias("_snapshot"))
    people = orders.filter(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
        F.max("purchase_ts").alias("_last"),
        F.count(F.lit(1)).alias("frequency"),
        F.round(F.coalesce(F.sum("gmv"), F.lit(0.0)), 2).alias("monetary"),
    )
    recency = days_between("_snapshot", "_last", "elapsed") + 1
    return with_scalar(people, snapshot).withColumn("recency", recency).drop("_last", "_snapshot")


def rfm_scores(base: DataFrame, q: int) -> DataFrame:
    """r_score (recent is high; equal days share a score), f_score, m_score (ties by person id).

    The one row per person is read by every ranking step, so it is stored once.
    """
    tie = ["customer_unique_id"]
    base = cut_lineage(base)
    df = quantile_bucket(base, "recency", q, "r_score", ties="share", reverse=True)
    df = quantile_bucket(df, "frequency", q, "f_score", tiebreak=tie)
    return quantile_bucket(df, "monetary", q, "m_score", tiebreak=tie)


def rfm_quintiles(orders: DataFrame) -> DataFrame:
    return rfm_scores(rfm_base(orders), 5).withColumn("segment", quintile_segment("r_score", "f_score", "m_score"))


def rfm_quartiles(orders: DataFrame) -> DataFrame:
    scored = rfm_scores(rfm_base(orders), 4)
    digits = [F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]
    return scored.withColumn("rfm_score", F.concat(*digits)).withColumn(
        "segment", quartile_segment("r_score", "f_score")
    )


def segment_means(scored: DataFrame) -> DataFrame:
    return scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("recency").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        F.round(F.avg("monetary"), 2).alias("avg_monetary"),
    )


def customer_360(orders: DataFrame) -> DataFrame:
    """order_count, lifetime_value, recency_days and one of five segments per person."""
    scored = rfm_scores(rfm_base(orders), 5)
    return scored.select(
        "customer_unique_id",
        F.md5(F.col("customer_unique_id").cast("string")).alias("customer_sk"),
        F.col("frequency").alias("order_count"),
        F.col("monetary").alias("lifetime_value"),
        F.col("recency").alias("recency_days"),
        mart_segment("r_score", "f_score", "m_score").alias("rfm_segment"),
    )


def first_orders(orders: DataFrame) -> DataFrame:
    """First orders with ``returned``: whether the person ever ordered again."""
    first = orders.filter((F.col("order_seq") == 1) & F.col("customer_unique_id").isNotNull())
    return first.withColumn("returned", F.col("cust_total_orders") > 1)


def first_order_return(orders: DataFrame, by: str = "delivery") -> DataFrame:
    """Return rate by what the first order was like: ``delivery`` (late or not) or ``score``."""
    first = first_orders(orders)
    if by == "delivery":
        late = F.col("delivered_ts") > F.col("estimated_ts")
        first = first.filter(F.col("is_delivered") & late.isNotNull())
        key = F.when(late, "Late").otherwise("On-time").alias("first_delivery")
    elif by == "score":
        first = first.filter(F.col("review_score").isNotNull())
        key = F.col("review_score").alias("first_score")
    else:
        raise ValueError(f"by must be delivery or score, not {by!r}")
    return first.groupBy(key).agg(
        F.count(F.lit(1)).alias("customers"),
        count_true("returned").alias("returned"),
        bool_mean("returned").alias("return_rate"),
    )


def revenue_at_risk(orders: DataFrame) -> DataFrame:
    """GMV of persons whose last order drew 1-2 stars, so nothing followed the bad experience."""
    lost = F.coalesce((F.col("review_score") <= 2) & ~F.col("has_subsequent_order"), F.lit(False))
    people = orders.groupBy("customer_unique_id").agg(
        F.sum("gmv").alias("gmv"), F.count(F.lit(1)).alias("orders"), F.bool_or(lost).alias("lost")
    )
    gone = F.col("lost") & F.col("customer_unique_id").isNotNull()
    sums = people.agg(
        F.round(F.coalesce(F.sum(F.when(gone, F.col("gmv"))), F.lit(0.0)), 2).alias("gmv_at_risk"),
        F.coalesce(F.sum(F.when(gone, F.col("orders"))), F.lit(0)).cast("bigint").alias("orders_at_risk"),
        F.round(F.sum("gmv"), 2).alias("total_gmv"),
    )
    return sums.withColumn("share_at_risk", ratio(F.col("gmv_at_risk"), F.col("total_gmv")))
