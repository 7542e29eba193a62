"""Named metrics over four datasets, and the chart queries built from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.clean import bool_mean, ratio

ORDERS, CUSTOMERS, COHORTS, CATEGORIES = "orders", "customers", "cohort_retention", "category"


def _gmv() -> Column:
    return F.round(F.sum("gmv"), 2)


def _rate(condition: Column) -> Column:
    return F.avg(condition.cast("int"))


# One row per order (or customer) in these datasets, so counting keys needs no DISTINCT.
METRICS: Mapping[str, Mapping[str, Callable[[], Column]]] = {
    ORDERS: {
        "gmv_total": _gmv,
        "order_count": lambda: F.count("order_id"),
        "aov": lambda: ratio(_gmv(), F.count("order_id")),
        "avg_review": lambda: F.avg("review_score"),
        "avg_lead_days": lambda: F.avg("delivery_days"),
        "on_time_rate": lambda: _rate(F.col("days_vs_estimate") <= 0),
        "late_rate": lambda: _rate(F.col("days_vs_estimate") > 0),
        "reorder_rate": lambda: bool_mean("has_subsequent_order"),
        "repeat_order_share": lambda: bool_mean("is_repeat_order"),
    },
    CUSTOMERS: {
        "customer_count": lambda: F.count("customer_unique_id"),
        "repeat_customer_rate": lambda: bool_mean("is_repeat_customer"),
        "total_monetary": lambda: F.round(F.sum("monetary"), 2),
    },
    COHORTS: {"avg_retention": lambda: F.avg("retention")},
    CATEGORIES: {"gmv_total": _gmv, "items": lambda: F.sum("n_items").cast("bigint")},
}


def metric_query(
    dataset: str,
    data: DataFrame,
    metrics: Sequence[str],
    dims: Sequence[str] = (),
    where: Column | None = None,
    order_by: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Metrics per dimension. ``limit`` makes it a top-k report by ``order_by`` (ties by dimension)."""
    df = data if where is None else data.filter(where)
    out = df.groupBy(*dims).agg(*[METRICS[dataset][m]().alias(m) for m in metrics])
    if limit is not None:
        out = out.orderBy(F.col(order_by or metrics[0]).desc_nulls_last(), *[F.col(d).asc_nulls_last() for d in dims]).limit(limit)
    return out


@dataclass(frozen=True)
class Chart:
    dataset: str
    metrics: tuple[str, ...]
    dims: tuple[str, ...] = ()
    limit: int | None = None


# The charts of the dashboard.
CHARTS: Mapping[str, Chart] = {
    "kpi_gmv": Chart(ORDERS, ("gmv_total",)),
    "kpi_orders": Chart(ORDERS, ("order_count",)),
    "kpi_aov": Chart(ORDERS, ("aov",)),
    "kpi_repeat": Chart(CUSTOMERS, ("repeat_customer_rate",)),
    "kpi_ontime": Chart(ORDERS, ("on_time_rate",)),
    "kpi_review": Chart(ORDERS, ("avg_review",)),
    "gmv_new_vs_repeat": Chart(ORDERS, ("gmv_total",), ("order_month", "is_repeat_order")),
    "repeat_share_trend": Chart(ORDERS, ("repeat_order_share",), ("order_month",)),
    "cohort_heatmap": Chart(COHORTS, ("avg_retention",), ("cohort_month", "months_since")),
    "orders_per_customer": Chart(CUSTOMERS, ("customer_count",), ("orders_placed_bucket",), 10),
    "rfm_segments": Chart(CUSTOMERS, ("customer_count",), ("segment",), 10),
    "reorder_by_review": Chart(ORDERS, ("reorder_rate",), ("review_bucket",), 10),
    "delivery_hist": Chart(ORDERS, ("order_count",), ("delivery_bucket",), 10),
    "late_by_state": Chart(ORDERS, ("late_rate",), ("customer_state",), 27),
    "review_by_delivery": Chart(ORDERS, ("avg_review",), ("delivery_bucket",), 10),
    "late_rate_trend": Chart(ORDERS, ("late_rate",), ("order_month",)),
    "reorder_by_delivery": Chart(ORDERS, ("reorder_rate",), ("delivery_bucket",), 10),
    "top_categories": Chart(CATEGORIES, ("gmv_total",), ("product_category",), 12),
}


def chart(name: str, datasets: Mapping[str, DataFrame]) -> DataFrame:
    c = CHARTS[name]
    return metric_query(c.dataset, datasets[c.dataset], c.metrics, c.dims, limit=c.limit)


def big_numbers(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """The six headline charts as one table: the four over orders share a single aggregation."""
    names = [n for n in CHARTS if n.startswith("kpi_")]
    out = None
    for dataset in dict.fromkeys(CHARTS[n].dataset for n in names):
        own = [n for n in names if CHARTS[n].dataset == dataset]
        row = metric_query(dataset, datasets[dataset], [CHARTS[n].metrics[0] for n in own])
        pairs = F.array(*[
            F.struct(F.lit(n).alias("chart"), F.col(CHARTS[n].metrics[0]).cast("double").alias("value")) for n in own
        ])
        part = row.select(F.explode(pairs).alias("p")).select("p.*")
        out = part if out is None else out.unionByName(part)
    return out
