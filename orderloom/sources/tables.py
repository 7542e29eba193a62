"""Writing tables: overwrite, append, upsert; audit columns; load reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.operators.merge import upsert  # noqa: F401  (part of this module's interface)
from orderloom.sources.versions import VersionedTable

# What a swap by renames, as earlier releases did it, may have left beside a table: the former table.
OLD = "__old"


def landing_names(streams: Sequence[str], suffix: str = "_raw") -> dict[str, str]:
    """Landing table of each source stream: the name after ``schema-`` plus a suffix."""
    return {s: s.rsplit("-", 1)[-1] + suffix for s in streams}


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table is there. A former table that a cut-short swap of an earlier release left aside takes its place again."""
    fs, target = _fs(spark, path)
    _, previous = _fs(spark, path + OLD)
    if not fs.exists(target) and fs.exists(previous) and not fs.rename(previous, target):
        raise OSError(f"could not rename {previous} to {target}")
    return VersionedTable(spark, path).exists()


def versioned(spark: SparkSession, path: str) -> VersionedTable:
    exists(spark, path)
    return VersionedTable(spark, path)


def swap_table(df: DataFrame, path: str) -> None:
    """Replace a table by a frame that may read from it: a new version, seen whole or not at all."""
    versioned(df.sparkSession, path).replace(df)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the table; the frame keeps to it."""
    return versioned(spark, path).read()


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "replace",
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    max_records: int = 0,
) -> None:
    """``append``, ``replace``, ``fail`` (when present) or ``upsert``; an upsert without keys appends.

    Each write is one new version of the table. An upsert rewrites the parts its keys fall in.
    """
    table = versioned(df.sparkSession, path)
    if mode == "upsert" and keys:
        table.merge(df, keys, order_by)
    elif mode in ("append", "upsert"):
        table.append(df, max_records=max_records)
    elif mode == "replace":
        table.replace(df)
    elif mode == "fail":
        if table.exists():
            raise FileExistsError(f"{path} exists")
        table.replace(df)
    else:
        raise ValueError(f"unknown write mode {mode!r}")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks at the ends of texts are kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def audit_columns(
    df: DataFrame, loaded_at: dt.datetime, batch_name: str, source: str | None = None, zone: str = "UTC"
) -> DataFrame:
    """created_at, updated_at (wall time in ``zone``), is_deleted, source_file and batch_name."""
    stamp = F.from_utc_timestamp(F.lit(loaded_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"), zone)
    file = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return df.select(
        "*",
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
        F.lit(False).alias("is_deleted"),
        file.alias("source_file"),
        F.lit(batch_name).alias("batch_name"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n_rows for every table, by one count each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile(sources: dict[str, DataFrame], targets: dict[str, DataFrame]) -> DataFrame:
    """Rows per table on both sides with exact / appended / SHORT / MISSING."""
    src = table_counts(sources).withColumnRenamed("n_rows", "src_rows")
    tgt = table_counts(targets).withColumnRenamed("n_rows", "tgt_rows")
    status = (
        F.when(F.col("tgt_rows").isNull(), "MISSING")
        .when(F.col("tgt_rows") == F.col("src_rows"), "exact")
        .when(F.col("tgt_rows") > F.col("src_rows"), "appended")
        .otherwise("SHORT")
    )
    return src.join(tgt, "table_name", "left").withColumn("status", status)


def cached_result(spark: SparkSession, path: str, build, max_age_seconds: float | None = None, force: bool = False):
    """A result kept as a table: read while fresh, else built, written and read back."""
    table = versioned(spark, path)
    if not force and table.exists() and (max_age_seconds is None or table.age() <= max_age_seconds):
        return table.read()
    table.replace(build())
    return table.read()
