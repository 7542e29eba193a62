"""Headline figures, monthly revenue, retention mix, catalogue and scenario metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from orderloom.functions.clean import bool_mean, count_true, ratio
from orderloom.operators.joins import with_scalar
from orderloom.session import cut_lineage


def kpis(orders: DataFrame) -> DataFrame:
    """One row: gmv, orders, customers, aov, repeat_rate, on_time_rate, avg_review, avg_lead_days.

    Totals per person first, so the person count and the repeat share need no distinct count.
    """
    on_time = F.when(
        F.col("is_delivered") & F.col("days_vs_estimate").isNotNull(), (F.col("days_vs_estimate") <= 0).cast("int")
    )
    people = orders.groupBy("customer_unique_id").agg(
        F.sum("gmv").alias("gmv"),
        F.count(F.lit(1)).alias("orders"),
        F.sum(on_time).alias("on_time"),
        F.count(on_time).alias("judged"),
        F.sum("review_score").alias("stars"),
        F.count("review_score").alias("reviews"),
        F.sum("delivery_days").alias("lead"),
        F.count("delivery_days").alias("leads"),
    )
    known = F.col("customer_unique_id").isNotNull()
    sums = people.agg(
        F.round(F.sum("gmv"), 2).alias("gmv"),
        F.sum("orders").alias("orders"),
        F.count_if(known).alias("customers"),
        F.count_if(known & (F.col("orders") > 1)).alias("_repeat"),
        *[F.sum(c).alias(f"_{c}") for c in ("on_time", "judged", "stars", "reviews", "lead", "leads")],
    )
    return sums.select(
        "gmv", "orders", "customers",
        ratio(F.col("gmv"), F.col("orders")).alias("aov"),
        ratio(F.col("_repeat"), F.col("customers")).alias("repeat_rate"),
        ratio(F.col("_on_time"), F.col("_judged")).alias("on_time_rate"),
        ratio(F.col("_stars"), F.col("_reviews")).alias("avg_review"),
        ratio(F.col("_lead"), F.col("_leads")).alias("avg_lead_days"),
    )


def gmv_monthly(orders: DataFrame) -> DataFrame:
    """Monthly GMV of first and repeat orders, with the order count."""
    repeat = F.col("is_repeat_order")
    new_gmv = F.coalesce(F.sum(F.when(~repeat, F.col("gmv"))), F.lit(0.0))
    repeat_gmv = F.coalesce(F.sum(F.when(repeat, F.col("gmv"))), F.lit(0.0))
    return orders.groupBy("order_month").agg(
        F.round(new_gmv, 2).alias("new_gmv"),
        F.round(repeat_gmv, 2).alias("repeat_gmv"),
        F.round(new_gmv + repeat_gmv, 2).alias("total_gmv"),
        F.count(F.lit(1)).alias("orders"),
    )


def repeat_share_monthly(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_month").agg(
        F.count(F.lit(1)).alias("orders"),
        count_true("is_repeat_order").alias("repeat_orders"),
        bool_mean("is_repeat_order").alias("repeat_order_share"),
    )


def treadmill(orders: DataFrame) -> DataFrame:
    """Distinct new and returning customers per month, by way of one row per month and person."""
    person = orders.filter(F.col("customer_unique_id").isNotNull()).groupBy("order_month", "customer_unique_id").agg(
        F.bool_or(~F.col("is_repeat_order")).alias("was_new"),
        F.bool_or("is_repeat_order").alias("was_repeat"),
    )
    return person.groupBy("order_month").agg(
        count_true("was_new").alias("new_customers"), count_true("was_repeat").alias("repeat_customers")
    )


def scenario(
    kpi: DataFrame, months: DataFrame, monthly_spend: float, target_cac: float | None, repeat_uplift_pp: float
) -> DataFrame:
    """Unit economics of assumed marketing spend over the observed KPIs (one row).

    ``months`` holds one row with ``n_months``.
    """
    spend = F.lit(float(monthly_spend)) * F.greatest(F.col("n_months"), F.lit(1))
    cac = ratio(spend, F.col("customers"))
    extra = F.col("customers") * F.lit(repeat_uplift_pp / 100.0)
    return with_scalar(kpi, months).select(
        spend.alias("total_spend"),
        cac.alias("blended_cac"),
        ratio(spend, F.col("gmv")).alias("pct_gmv_on_marketing"),
        "repeat_rate",
        extra.alias("extra_repeat_customers"),
        (extra * F.col("aov")).alias("incremental_gmv"),
        (extra * (F.lit(float(target_cac)) if target_cac else cac)).alias("equiv_paid_cost"),
    )


def top_categories(sales: DataFrame, n: int = 12) -> DataFrame:
    """A top-k report: the n categories with the greatest revenue."""
    totals = sales.groupBy("product_category").agg(
        F.round(F.sum("gmv"), 2).alias("gmv"), F.sum("n_items").cast("bigint").alias("items")
    )
    return totals.orderBy(F.col("gmv").desc_nulls_last(), "product_category").limit(n)


def bottom_categories(sales: DataFrame, n: int = 10) -> DataFrame:
    totals = sales.groupBy("product_category").agg(F.sum("n_items").cast("bigint").alias("items"))
    return totals.orderBy(F.col("items").asc(), "product_category").limit(n)


def category_state_cells(sales: DataFrame, categories: int = 10, states: int = 10) -> DataFrame:
    """Revenue of the top categories in the top states, long form.

    The sales cube is read three times, so it is stored once; both top lists are ``limit`` rows.
    """
    sales = cut_lineage(sales.select("product_category", "customer_state", "gmv", "n_items"))
    by_state = sales.groupBy("customer_state").agg(F.round(F.sum("gmv"), 2).alias("gmv"))
    best_states = by_state.orderBy(F.col("gmv").desc_nulls_last(), "customer_state").limit(states)
    best_categories = top_categories(sales, categories)
    return (
        sales.join(F.broadcast(best_categories.select("product_category")), "product_category", "left_semi")
        .join(F.broadcast(best_states.select("customer_state")), "customer_state", "left_semi")
        .groupBy("product_category", "customer_state")
        .agg(F.round(F.sum("gmv"), 2).alias("gmv"))
    )


def category_state_matrix(
    sales: DataFrame, categories: int = 10, states: int = 10, columns: Sequence[str] | None = None
) -> DataFrame:
    """Wide form: a column for each of the top states; a pair without sales is 0.

    With ``columns`` (all states there are) the columns do not depend on the data: a state that is not a top one has 0.
    """
    if columns is not None:
        cells = category_state_cells(sales, categories, states)
        wide = cells.groupBy("product_category").pivot("customer_state", list(columns)).agg(F.first("gmv"))
        return wide.fillna(0.0, subset=list(columns))
    cells = cut_lineage(category_state_cells(sales, categories, states))  # categories x states rows
    names = sorted(str(row[0]) for row in cells.select("customer_state").distinct().collect())
    wide = cells.withColumn("customer_state", F.coalesce("customer_state", F.lit("None")))
    return wide.groupBy("product_category").pivot("customer_state", names).agg(F.first("gmv")).fillna(0.0, subset=names)


def growth(orders: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """GMV of the first and last month in a window, and the growth between them."""
    monthly = orders.filter(F.col("gmv").isNotNull())
    if start:
        monthly = monthly.filter(F.col("order_month") >= F.lit(start).cast("date"))
    if end:
        monthly = monthly.filter(F.col("order_month") <= F.lit(end).cast("date"))
    monthly = monthly.groupBy("order_month").agg(F.round(F.sum("gmv"), 2).alias("gmv"))
    ends = monthly.agg(
        F.min("order_month").alias("first_month"), F.max("order_month").alias("last_month"),
        F.min_by("gmv", "order_month").alias("first_gmv"), F.max_by("gmv", "order_month").alias("last_gmv"),
    )
    return ends.withColumn("growth_pct", (ratio(F.col("last_gmv"), F.col("first_gmv")) - 1) * 100)


def rolling_revenue(orders: DataFrame, months: int = 3) -> DataFrame:
    """Monthly revenue and its mean over up to ``months`` months.

    The window runs over the monthly totals, one row per calendar month of the history.
    """
    monthly = orders.groupBy("order_month").agg(
        F.round(F.sum("gmv"), 2).alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    span = Window.orderBy("order_month").rowsBetween(1 - months, 0)
    return monthly.withColumn("rolling_avg", F.round(F.avg("revenue").over(span), 2))
