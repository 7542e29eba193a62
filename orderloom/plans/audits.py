"""The data tests of the stage and gold tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderloom import schemas
from orderloom.operators.quality import (
    Check, RowRule, check_fk, check_range, check_regex, check_unique, run_checks, run_row_rules,
)


STAGED = ("customers", "orders", "order_items", "order_payments", "order_reviews", "products", "sellers")
DELIVERED = "order_status = 'delivered'"


def key_rules(name: str) -> list[RowRule]:
    return [RowRule(f"{name}_{k}_present", F.col(k).isNull()) for k in schemas.KEYS[name][0]]


def stage_checks(tables) -> list[Check]:
    """Every stage key is unique and present."""
    out = []
    for name in STAGED:
        out.append(Check(f"{name}_unique", check_unique(tables[name], schemas.KEYS[name][0])))
        out += [rule.check(tables[name]) for rule in key_rules(name)]
    return out


def fact_rules(as_of: Column) -> list[RowRule]:
    """Enums, ranges and business rules of the item fact, all of them conditions on one row."""
    delivered, price = F.expr(DELIVERED), F.col("price")
    outside = lambda c, lo, hi: (F.col(c) < lo) | (F.col(c) > hi)
    late = F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")
    return [
        RowRule("fact_id_present", F.col("id").isNull()),
        RowRule("fact_status", ~F.col("order_status").isin(list(schemas.ORDER_STATUS))),
        RowRule("fact_payment_type", ~F.col("payment_type").isin(list(schemas.PAYMENT_TYPES))),
        RowRule("fact_price_range", outside("price", 0, 10_000), "warn"),
        RowRule("fact_freight_range", outside("freight_value", 0, 1_000), "warn"),
        RowRule("delivered_after_purchase", delivered & late, "warn"),
        RowRule("delivered_has_date", delivered & F.col("order_delivered_customer_date").isNull(), "warn"),
        RowRule("no_future_purchase", F.col("order_purchase_timestamp") > as_of),
        RowRule("dear_item_is_paid", (price > 1000) & F.col("payment_value").isNull(), "warn"),
        RowRule("lead_time_not_negative", delivered & late, "warn"),
    ]


def fact_key_checks(fact: DataFrame, tables) -> list[Check]:
    """Grain and references of the item fact: these need rows to meet."""
    return [
        Check("fact_grain", check_unique(fact, ["id", "order_item_id"])),
        Check("fact_customer", check_fk(fact, "customer_id", tables["customers"], "customer_id")),
        Check("fact_product", check_fk(fact, "product_id", tables["products"], "product_id"), "warn"),
        Check("fact_seller", check_fk(fact, "seller_id", tables["sellers"], "seller_id")),
    ]


def side_checks(tables) -> list[Check]:
    return [
        Check("customer_zip_form", check_regex(tables["customers"], "customer_zip_code_prefix", r"^\d{5}$")),
        Check("review_score_range", check_range(tables["order_reviews"], "review_score", 1, 5)),
    ]


def gold_checks(fact: DataFrame, tables, as_of: Column) -> list[Check]:
    """All checks of the gold layer with their violating rows."""
    return [*fact_key_checks(fact, tables), *[r.check(fact) for r in fact_rules(as_of)], *side_checks(tables)]


def stage_summary(tables) -> DataFrame:
    """Uniqueness by key and all presence rules of a table in one scan."""
    unique = run_checks([Check(f"{n}_unique", check_unique(tables[n], schemas.KEYS[n][0])) for n in STAGED])
    return reduce(DataFrame.unionByName, [run_row_rules(tables[n], key_rules(n)) for n in STAGED], unique)


def gold_summary(fact: DataFrame, tables, as_of: Column) -> DataFrame:
    """The row rules scan the fact once; grain, references and side tables follow."""
    met = run_checks([*fact_key_checks(fact, tables), *side_checks(tables)])
    return run_row_rules(fact, fact_rules(as_of)).unionByName(met)


def freight_anomalies(items: DataFrame) -> DataFrame:
    """Items whose freight is above their price, and the dearest freight (one row)."""
    return items.agg(
        F.count_if(F.col("freight_value") > F.col("price")).alias("freight_above_price"),
        F.max("freight_value").cast("double").alias("max_freight"),
        F.count(F.lit(1)).alias("items"),
    )


def place_mismatches(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """Sellers whose state differs from every state their zip has points in."""
    places = geo.select(F.col("zip_code_prefix").alias("seller_zip_code_prefix"), F.col("state").alias("seller_state")).distinct()
    known = sellers.join(places.select("seller_zip_code_prefix").distinct(), "seller_zip_code_prefix", "left_semi")
    return known.join(places, ["seller_zip_code_prefix", "seller_state"], "left_anti")
