"""Stage tables: one row per key, trimmed ids, typed columns. Lazy views over the raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from orderloom import schemas
from orderloom.functions.clean import clamp_null, lower_text, not_deleted, safe_cast, upper_text, zip_text
from orderloom.operators.aggregates import geo_rollup
from orderloom.operators.dedup import latest_per_key

Tables = Mapping[str, DataFrame]


def stage_table(name: str, raw: DataFrame) -> DataFrame:
    keys, order = schemas.KEYS[name]
    load_order = [c for c in ("_sdc_sequence", "updated_at") if c in raw.columns]
    return latest_per_key(raw, keys, [*load_order, *order])


def stage_geolocation(raw: DataFrame, latest: str | None = None) -> DataFrame:
    """One point per zip: the mean point, or the newest by ``latest``. Keeps zip joins 1:1."""
    if latest is not None:
        return latest_per_key(raw, ["zip_code_prefix"], [latest])
    return geo_rollup(raw, ["zip_code_prefix"])


def stage(raw: Tables) -> dict[str, DataFrame]:
    """Every stage table of the raw tables present."""
    out = {name: stage_table(name, raw[name]) for name in schemas.KEYS if name in raw}
    if "geolocation" in raw:
        out["geolocation"] = stage_geolocation(raw["geolocation"])
    return out


# Columns in standard case.
LOWER = ("order_status", "payment_type", "customer_city", "seller_city", "geolocation_city", "product_category_name")
UPPER = ("customer_state", "seller_state", "geolocation_state")


def typed_table(name: str, raw: DataFrame) -> DataFrame:
    """The typed form of a raw table of texts: soft-deleted rows left out, texts trimmed with blanks as NULL, standard
    case, five-digit zips, and values that do not read as their type as NULL. Columns the raw table lacks are NULL."""
    df = not_deleted(raw) if "is_deleted" in raw.columns else raw
    out = []
    for field in schemas.raw_schema(name).fields:
        text = F.nullif(F.trim(F.col(field.name).cast("string")), F.lit("")) if field.name in raw.columns else F.lit(None).cast("string")
        if field.name.endswith("zip_code_prefix"):
            value = zip_text(text)
        elif isinstance(field.dataType, T.StringType):
            value = F.lower(text) if field.name in LOWER else F.upper(text) if field.name in UPPER else text
        else:
            kind = "timestamp_ntz" if isinstance(field.dataType, T.TimestampType) else field.dataType.simpleString()
            value = safe_cast(text, kind)
        out.append(value.alias(field.name))
    return df.select(*out)


def typed_customers(raw: DataFrame) -> DataFrame:
    """Standard case, five-digit zips; soft-deleted rows are left out when a flag is there."""
    df = raw.filter(~F.coalesce("is_deleted", F.lit(False))) if "is_deleted" in raw.columns else raw
    return df.select(
        F.trim(F.col("customer_id").cast("string")).alias("customer_id"),
        F.trim(F.col("customer_unique_id").cast("string")).alias("customer_unique_id"),
        zip_text("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        lower_text("customer_city").alias("customer_city"),
        upper_text("customer_state").alias("customer_state"),
    )


def typed_reviews(reviews: DataFrame) -> DataFrame:
    """Scores outside 1-5 become NULL; ``has_review_comment`` tells a non-blank message."""
    message = F.trim(F.col("review_comment_message"))
    return reviews.withColumns({
        "review_score": clamp_null(safe_cast("review_score", "int"), 1, 5),
        "has_review_comment": message.isNotNull() & (message != ""),
    })


def latest_reviews(reviews: DataFrame, per: str = "order_id") -> DataFrame:
    """One review per order (or per review id): the last answered."""
    other = "review_id" if per == "order_id" else "order_id"
    return latest_per_key(reviews, [per], ["review_answer_timestamp", other])


def last_payments(payments: DataFrame) -> DataFrame:
    """The last payment of each order."""
    return latest_per_key(payments, ["order_id"], ["payment_sequential"])
