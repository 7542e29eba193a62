"""Rebuild the warehouse layer by layer: raw tables, stage, gold, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.operators.history import open_versions, scd2_check
from orderloom.plans import audits, star
from orderloom.plans.orders import enrich, order_base, order_base_from_fact
from orderloom.plans.stage import stage
from orderloom.session import stored
from orderloom.sources.tables import audit_columns, exists, read_table, reconcile, swap_table

LAYERS = ("bronze", "stage", "snapshot", "gold", "checks")

# Product columns whose change opens a new version.
PRODUCT_CHECKS = ("product_category_name", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    as_of: dt.datetime,
    layers: Sequence[str] = LAYERS,
    batch: str = "full_refresh",
) -> dict[str, DataFrame]:
    """Build the chosen layers in order below ``root``; returns the frames of the last state.

    Bronze, snapshots and gold are stored, stage tables are views over bronze. Tables are swapped
    in whole, so a failed run leaves the former state usable. A table of ``raw`` or gold that is asked
    for and not there is an error.
    """
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers {sorted(unknown)}")
    path = lambda layer, name: f"{root.rstrip('/')}/{layer}/{name}"
    now: Column = F.lit(as_of).cast("timestamp_ntz")
    out: dict[str, DataFrame] = {}
    if "bronze" in layers:
        for name, df in raw.items():
            swap_table(audit_columns(df, as_of, batch, source=name), path("bronze", name))
    bronze = {n: read_table(spark, path("bronze", n)) for n in raw}
    out["reconciliation"] = reconcile(dict(raw), bronze)
    tables = stage(bronze)
    out.update({f"stg_{n}": df for n, df in tables.items()})
    history = path("snapshots", "products")
    if "snapshot" in layers:
        products = tables["products"].drop("created_at", "updated_at", "is_deleted", "source_file", "batch_name")
        if exists(spark, history):
            state = scd2_check(read_table(spark, history), products, ["product_id"], PRODUCT_CHECKS, now)
        else:
            state = open_versions(products, ["product_id"], now)
        swap_table(state, history)
    if "gold" in layers:
        gold = {
            "fact_orders": star.fact_orders(tables["orders"], tables["order_items"], tables["order_payments"], now, counted=bronze["order_items"]),
            "dim_customers": star.dim_customers(tables["customers"]),
            "dim_sellers": star.dim_sellers(tables["sellers"], tables["geolocation"]),
            "dim_date": star.dim_date(spark, tables["orders"]),
        }
        if exists(spark, history):
            gold["dim_products"] = star.dim_products(
                read_table(spark, history), tables["product_category_name_translation"].select(
                    "product_category_name", "product_category_name_english")
            )
        for name, df in gold.items():
            swap_table(df, path("gold", name))
        # The fact has the items and payments of each order already; the history reads the base several times.
        base = order_base_from_fact(read_table(spark, path("gold", "fact_orders")), tables["customers"], tables["order_reviews"])
        swap_table(enrich(stored(base.select(order_base(tables).columns), "orders")), path("gold", "orders_enriched"))
    kept = ("fact_orders", "dim_customers", "dim_sellers", "dim_date", "orders_enriched")
    if {"gold", "checks"} & set(layers):
        out.update({name: read_table(spark, path("gold", name)) for name in kept})
        if exists(spark, path("gold", "dim_products")):  # needs a snapshot
            out["dim_products"] = read_table(spark, path("gold", "dim_products"))
    if "checks" in layers:
        out["checks"] = audits.gold_summary(out["fact_orders"], tables, now)
    return out
