"""Data-quality checks. Each returns the violating rows; an empty frame passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderloom.functions.clean import PLACEHOLDERS, lower_text, ratio
from orderloom.operators.aggregates import null_share
from orderloom.operators.joins import with_scalar
from orderloom.operators.ranking import exact_quantiles


def _where(df: DataFrame, where: Column | str | None) -> DataFrame:
    if where is None:
        return df
    return df.filter(F.expr(where) if isinstance(where, str) else where)


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count; NULL keys are not compared."""
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in cols])
    return df.filter(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_fk(df: DataFrame, col: str, dim: DataFrame, dim_col: str) -> DataFrame:
    """Rows whose non-null key is absent from the dimension."""
    keys = dim.select(F.col(dim_col).alias(col)).distinct()
    return df.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def check_enum(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def check_range(df: DataFrame, col: str, lo=None, hi=None, where: Column | str | None = None) -> DataFrame:
    """Rows outside ``[lo, hi]``; an absent value passes."""
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (F.col(col) < lo)
    if hi is not None:
        bad = bad | (F.col(col) > hi)
    return _where(df, where).filter(bad)


def check_pair(df: DataFrame, a: str, b: str, or_equal: bool = True, where: Column | str | None = None) -> DataFrame:
    """Rows where ``a`` is not above ``b``."""
    good = F.col(a) >= F.col(b) if or_equal else F.col(a) > F.col(b)
    return _where(df, where).filter(~good)


def check_regex(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(~F.col(col).rlike(pattern))


def check_expr(df: DataFrame, expression: str, where: Column | str | None = None) -> DataFrame:
    """Rows for which the assertion is not true (NULL counts as a failure)."""
    return _where(df, where).filter(~F.coalesce(F.expr(expression), F.lit(False)))


def check_schema(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Contract on names and types: one row per missing, unexpected or mistyped column."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {c: T._parse_datatype_string(t).simpleString() for c, t in expected.items()}
    rows = [
        (c, wanted.get(c), found.get(c))
        for c in dict.fromkeys([*wanted, *found])
        if wanted.get(c) != found.get(c)
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, found string")


def check_null_rate(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Columns whose share of NULLs is above its limit."""
    pairs = F.create_map(*[x for c, v in limits.items() for x in (F.lit(c), F.lit(float(v)))])
    return null_share(df, list(limits)).withColumn("limit", pairs[F.col("column_name")]).filter("null_share > limit")


def check_mean(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """One row when the mean leaves its bounds or there is no value."""
    one = df.agg(F.avg(F.col(col).cast("double")).alias("mean"))
    return one.filter(F.col("mean").isNull() | ~F.col("mean").between(lo, hi))


def check_placeholders(df: DataFrame, cols: Sequence[str], placeholders: Sequence[str] = PLACEHOLDERS) -> DataFrame:
    """Rows that still hold a text standing for no value."""
    return df.filter(reduce(Column.__or__, [lower_text(c).isin(list(placeholders)) for c in cols]))


def check_totals(left: DataFrame, right: DataFrame, period: str, measure: str, tolerance: float = 0.01) -> DataFrame:
    """Periods whose totals differ between two models by more than the tolerance, or exist once only."""
    a = left.groupBy(period).agg(F.sum(measure).cast("double").alias("left_total"))
    b = right.groupBy(period).agg(F.sum(measure).cast("double").alias("right_total"))
    gap = F.abs(F.col("left_total") - F.col("right_total"))
    return a.join(b, period, "full").filter(gap.isNull() | (gap > tolerance))


def iqr_outliers(df: DataFrame, col: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, fences, rows above the upper fence and their share (one row)."""
    q = exact_quantiles(df, col, [0.25, 0.75], ["q1", "q3"])
    spread = F.col("q3") - F.col("q1")
    fences = q.withColumns({"lower_bound": F.col("q1") - spread * reach, "upper_bound": F.col("q3") + spread * reach})
    marked = with_scalar(df.select(F.col(col).cast("double").alias("_v")), fences)
    sums = marked.groupBy("q1", "q3", "lower_bound", "upper_bound").agg(
        F.count_if(F.col("_v") > F.col("upper_bound")).alias("n_outliers"), F.count(F.lit(1)).alias("n_rows")
    )
    return sums.withColumn("outlier_share", ratio(F.col("n_outliers"), F.col("n_rows")))


@dataclass(frozen=True)
class Check:
    """A named check: a frame of violations and whether they stop a build."""

    name: str
    violations: DataFrame
    severity: str = "error"


def run_checks(checks: Sequence[Check], store: str | None = None) -> DataFrame:
    """check_name, severity, n_failed, passed. With ``store`` the violating rows are kept as tables."""
    parts = []
    for c in checks:
        rows = c.violations
        if store is not None:
            path = f"{store.rstrip('/')}/{c.name}"
            rows.write.mode("overwrite").parquet(path)
            rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("n_failed")).select(
                F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "n_failed"
            )
        )
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("n_failed") == 0)


@dataclass(frozen=True)
class RowRule:
    """A named condition under which a row fails; an absent value passes unless the condition says otherwise."""

    name: str
    fails: Column
    severity: str = "error"

    def check(self, df: DataFrame) -> Check:
        return Check(self.name, df.filter(self.fails), self.severity)


def run_row_rules(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """The summary of all rules over one frame, counted in a single scan."""
    one = df.agg(*[F.count_if(F.coalesce(r.fails, F.lit(False))).alias(f"_{i}") for i, r in enumerate(rules)])
    lines = F.array(*[
        F.struct(F.lit(r.name).alias("check_name"), F.lit(r.severity).alias("severity"), F.col(f"_{i}").alias("n_failed"))
        for i, r in enumerate(rules)
    ])
    return one.select(F.inline(lines)).withColumn("passed", F.col("n_failed") == 0)


def failed_errors(summary: DataFrame) -> DataFrame:
    """The failed checks that should stop a build."""
    return summary.filter((F.col("severity") == "error") & ~F.col("passed"))


