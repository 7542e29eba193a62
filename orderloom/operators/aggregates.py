"""Reusable aggregates: modes, rollups, frequency tables, histograms, pivots, profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderloom.functions.clean import col, mean, total
from orderloom.operators.joins import share_of_total
from orderloom.operators.ranking import column_quantiles, group_quantiles


def mode_per_group(df: DataFrame, keys: Sequence[str], column: str, out: str | None = None) -> DataFrame:
    """Most frequent non-null value per group, the smallest on ties.

    Counts per (group, value) come first; one row per distinct value then meets the pick.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, column)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    pick = F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v")))
    return counts.groupBy(*keys).agg(pick.alias("_best")).select(
        *keys, F.col("_best.v").alias(out or column), (-F.col("_best.n")).alias(f"{out or column}_count")
    )


def modes_per_group(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of several text columns per key, from one pass over the rows."""
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).alias("v")) for i, c in enumerate(columns)])
    counts = (
        df.select(key, F.explode(pairs).alias("p")).select(key, "p.c", "p.v").filter(F.col("v").isNotNull())
        .groupBy(key, "c", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    best = [
        F.min(F.when(F.col("c") == i, F.struct((-F.col("n")).alias("n"), F.col("v")))).alias(f"_{i}")
        for i in range(len(columns))
    ]
    return counts.groupBy(key).agg(*best).select(key, *[F.col(f"_{i}.v").alias(c) for i, c in enumerate(columns)])


def value_counts(df: DataFrame, column: str, normalise: bool = True) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counts, "n") if normalise else counts


def payments_rollup(payments: DataFrame, updated: str | None = None) -> DataFrame:
    """One row per order. The type set is bounded by the payment-type list; ``updated`` names the moment of which
    ``latest_update`` is the newest."""
    return payments.groupBy("order_id").agg(
        *_latest(updated),
        F.count(F.lit(1)).alias("payment_record_count"),
        total("payment_value").alias("total_payment_value"),
        F.max("payment_installments").alias("max_payment_installments"),
        F.array_join(F.array_sort(F.collect_set("payment_type")), ", ").alias("payment_types"),
    )


def reviews_rollup(reviews: DataFrame) -> DataFrame:
    """One row per order over all of its reviews."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_record_count"),
        F.avg("review_score").alias("avg_review_score"),
        F.max("review_score").alias("max_review_score"),
        F.min("review_score").alias("min_review_score"),
        F.bool_or("has_review_comment").alias("has_review_comment"),
        F.max("review_creation_date").alias("latest_review_creation_date"),
        F.max("review_answer_timestamp").alias("latest_review_answer_timestamp"),
    )


def _latest(updated: str | None) -> list[Column]:
    return [] if updated is None else [F.max(updated).alias("latest_update")]


def geo_rollup(
    geo: DataFrame, keys: Sequence[str] = ("zip_code_prefix", "city", "state"), updated: str | None = None
) -> DataFrame:
    """Mean point per place with the number of raw points, and the newest ``updated`` moment as ``latest_update``."""
    return geo.groupBy(*keys).agg(
        *_latest(updated),
        mean("lat").alias("avg_lat"), mean("lng").alias("avg_lng"), F.count(F.lit(1)).alias("n_points")
    )


def pivot_sum(
    df: DataFrame, rows: Sequence[str], column: str, values: Sequence, measure: Column, fill=0
) -> DataFrame:
    """Long to wide over a given value list: no extra job, every column present, gaps filled."""
    wide = df.groupBy(*rows).pivot(column, list(values)).agg(measure)
    return wide.fillna(fill, subset=[str(v).lower() if isinstance(v, bool) else str(v) for v in values])


def even_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``bins`` bins of equal width from 0 to the greatest value, which is in the last bin."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.agg(F.greatest(F.max(column), F.lit(1)).alias("_top"))
    bin_no = F.least(F.floor(F.col(column) * bins / F.col("_top")), F.lit(bins - 1)).cast("bigint")
    return counts.crossJoin(F.broadcast(top)).groupBy(bin_no.alias("bin"), "_top").agg(F.sum("_n").alias("n")).select(
        "bin", (F.col("bin") * F.col("_top") / bins).cast("double").alias("bin_start"), "n")


def histogram(df: DataFrame, column: str, width: float, lo: float = 0, cap: float | None = None) -> DataFrame:
    """Fixed-width bins from ``lo``; values above ``cap`` count in the last bin."""
    c = F.col(column)
    value = F.least(c, F.lit(cap)) if cap is not None else c
    bin_no = F.floor((value - F.lit(lo)) / F.lit(width)).cast("bigint")
    return (
        df.filter(c.isNotNull())
        .groupBy(bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("bin") * F.lit(float(width)) + F.lit(float(lo))).alias("bin_start"), "n")
    )


def null_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column_name, n_null, null_share for every column in one pass over the table."""
    columns = list(columns or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("n_null")) for i, c in enumerate(columns)
    ])
    return one.select("_rows", F.explode(pairs).alias("p")).select(
        "p.column_name", "p.n_null", F.try_divide(F.col("p.n_null").cast("double"), F.col("_rows")).alias("null_share")
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, min, max and sample deviation per column, in one pass, as long rows."""
    one = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            mean(c).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        ).alias(f"_{i}")
        for i, c in enumerate(columns)
    ])
    return one.select(F.explode(F.array(*[f"_{i}" for i in range(len(columns))])).alias("s")).select("s.*")


def describe_quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, p25, p50, p75: exact interpolated quartiles of each column."""
    return column_quantiles(df, columns, [0.25, 0.5, 0.75])


def first_present(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """First non-NULL value of each column in a group, ascending by ``order``: values may come from different rows."""
    place = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns])


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value and its count per text column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).select("p.column_name", "p.v").filter(F.col("v").isNotNull())
    counts = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("v")))
    return counts.groupBy("column_name").agg(
        F.sum("n").cast("bigint").alias("n"),
        F.count(F.lit(1)).alias("n_distinct"),
        best.alias("_b"),
    ).select("column_name", "n", "n_distinct", F.col("_b.v").alias("top"), (-F.col("_b.n")).alias("freq"))


def weighted_median(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Exact median per group, from its frequency table."""
    return group_quantiles(df, keys, column, [0.5], [out])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def linear_trend(df: DataFrame, y: Column | str, x: Column | str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of y on x with correlation, from one aggregation."""
    y, x = col(y).cast("double"), col(x).cast("double")
    return df.groupBy(*keys).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.corr(y, x).alias("corr"),
    )


def quadratic_trend(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares a + b x + c x^2, solved from the moment sums of one aggregation."""
    sums = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    ).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(F.pow("x", F.lit(k))).alias(f"x{k}") for k in range(1, 5)],
        F.sum("y").alias("y0"),
        F.sum(F.col("x") * F.col("y")).alias("y1"),
        F.sum(F.col("x") * F.col("x") * F.col("y")).alias("y2"),
    )
    m = [["n", "x1", "x2"], ["x1", "x2", "x3"], ["x2", "x3", "x4"]]
    rhs = ["y0", "y1", "y2"]

    def det(rows: list[list[str]]) -> Column:
        (a, b, c), (d, e, f), (g, h, i) = [[F.col(v) for v in r] for r in rows]
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    base = det(m)
    solved = [det([[rhs[r] if j == k else v for j, v in enumerate(row)] for r, row in enumerate(m)]) for k in range(3)]
    return sums.select(
        F.col("n").cast("bigint").alias("n"),
        *[F.try_divide(s, base).alias(name) for s, name in zip(solved, ["intercept", "linear", "quadratic"])],
    )
