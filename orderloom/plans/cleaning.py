"""The cleaning chain as DataFrame transforms: strip, placeholders, impute, type, dedup, tier, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.clean import NUMERIC_SENTINELS, clamp_null, placeholder_to_null, strip_all_text
from orderloom.functions.labels import value_tier
from orderloom.operators.dedup import latest_per_key
from orderloom.operators.impute import impute
from orderloom.operators.joins import with_scalar
from orderloom.operators.ranking import exact_quantiles


def clean_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return strip_all_text(df).withColumns({c: placeholder_to_null(c) for c in cols})


def clean_amount(df: DataFrame, col: str, lo: float = 0, hi: float = 1_000_000) -> DataFrame:
    return df.withColumn(col, clamp_null(col, lo, hi, NUMERIC_SENTINELS))


def valid_timeline(df: DataFrame, created: str, ordered: str) -> DataFrame:
    """Created no later than ordered; NULL when either is absent."""
    return df.withColumn("is_valid_timeline", F.col(created) <= F.col(ordered))


def flag_outliers(df: DataFrame, col: str, prob: float = 0.99) -> DataFrame:
    """Marks values above an exact quantile; nothing is removed."""
    fence = exact_quantiles(df, col, [prob], ["_fence"])
    return with_scalar(df, fence).withColumn(
        "is_potential_outlier", F.coalesce(F.col(col) > F.col("_fence"), F.lit(False))
    ).drop("_fence")


def clean_table(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    text_cols: Sequence[str],
    amount: str,
    category: str,
    created: str,
    ordered: str,
) -> DataFrame:
    """The whole chain; ``amount`` and ``category`` are imputed with null flags kept."""
    df = clean_amount(clean_text(df, text_cols), amount)
    df = impute(df, [amount], [category])
    df = latest_per_key(df, keys, order_by)
    df = valid_timeline(df.withColumn("value_tier", value_tier(amount)), created, ordered)
    return flag_outliers(df, amount)
