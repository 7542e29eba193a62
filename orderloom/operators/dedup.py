"""Keep one row per key, and audits of duplicate keys.

``row_number() = 1`` is planned with a map-side group limit: every map task hands at most one row
per key to the shuffle, so a key that holds a third of the table does not fill one reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _orderable(df: DataFrame, names: Sequence[str]) -> list[str]:
    bad = (T.MapType, T.VariantType)
    return [n for n in names if not isinstance(df.schema[n].dataType, bad)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties settled by all other columns.

    Plain names in ``order_by`` sort descending with NULLs last; pass Columns for another order.
    """
    order = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order_by]
    named = {o for o in order_by if isinstance(o, str)}
    rest = tiebreak if tiebreak is not None else [c for c in df.columns if c not in set(keys) | named]
    order += [F.col(c).asc_nulls_last() for c in _orderable(df, rest)]
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def duplicate_audit(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """table, key, rows, distinct keys and surplus rows.

    Counting per key first spreads the work over keys and leaves a plain sum for the end.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(", ".join(keys)).alias("key_columns"),
        "n_rows",
        "n_keys",
        (F.col("n_rows") - F.col("n_keys")).alias("n_surplus"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat another row in every column: one-row count."""
    return duplicate_audit(df, "rows", df.columns).select("n_rows", "n_keys", "n_surplus")


def audit_tables(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    audits = [duplicate_audit(df, name, keys) for name, (df, keys) in tables.items()]
    return reduce(DataFrame.unionByName, audits)
