"""Fill absent values with a constant, the median or the most frequent value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderloom.operators.aggregates import mode_per_group
from orderloom.operators.joins import with_scalar
from orderloom.operators.ranking import column_quantiles


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The medians of all columns come from one frequency table; a column without values stays NULL."""
    if not columns:
        return df
    medians = column_quantiles(df, columns, [0.5])
    one = medians.agg(*[F.max(F.when(F.col("column_name") == c, F.col("p50"))).alias(f"_median_{c}") for c in columns])
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}")) for c in columns}
    return with_scalar(df, one).withColumns(filled).drop(*[f"_median_{c}" for c in columns])


def fill_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name in columns:
        one = mode_per_group(df.withColumn("_all", F.lit(1)), ["_all"], name, "_mode").agg(
            F.max("_mode").alias("_mode")
        )
        df = with_scalar(df, one).withColumn(name, F.coalesce(F.col(name), F.col("_mode"))).drop("_mode")
    return df


def impute(
    df: DataFrame, median_cols: Sequence[str] = (), mode_cols: Sequence[str] = (), flags: bool = True
) -> DataFrame:
    """Fill medians and modes; ``<column>_is_null_flag`` remembers where a value was absent."""
    if flags:
        df = df.withColumns({
            f"{c}_is_null_flag": F.col(c).isNull().cast("int") for c in [*median_cols, *mode_cols]
        })
    return fill_mode(fill_median(df, median_cols), mode_cols)
