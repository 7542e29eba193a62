"""Incremental loads: by bookmark in batch, by file stream with a checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.session import cut_lineage
from orderloom.sources.tables import read_table, versioned
from orderloom.sources.versions import PART_ROWS, Version


def increment(df: DataFrame, bookmark, column: str = "updated_at") -> DataFrame:
    """Rows changed after the bookmark; all rows when there is none. The filter reaches the scan."""
    return df if bookmark is None else df.filter(F.col(column) > F.lit(bookmark))


def next_bookmark(df: DataFrame, column: str = "updated_at"):
    """The greatest change time of an increment, None for an empty one."""
    return df.agg(F.max(column)).first()[0]


def load_increment(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    column: str = "updated_at",
    name: str = "bookmark",
    part_rows: int = PART_ROWS,
) -> Version | None:
    """Merge the rows of ``source`` that changed after the target's bookmark; rows and bookmark are one version.

    So a load that dies at any moment leaves both as they were, and the next one takes the same rows again. The increment
    is stored before its greatest change time is taken, so that rows which arrive meanwhile wait for the next load. Rows
    of equal change time that arrive after a load are not seen; a source must give later rows later times.
    """
    table = versioned(source.sparkSession, target)
    fresh = cut_lineage(increment(source, table.mark(name), column))
    reached = next_bookmark(fresh, column)
    if reached is None and table.exists():
        return table.latest()
    return table.merge(fresh, keys, [column], newer=column, marks={} if reached is None else {name: reached}, part_rows=part_rows)


def stream_upsert(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    keys: Sequence[str],
    order_by: str,
    checkpoint: str,
    max_files: int = 1000,
    part_rows: int = PART_ROWS,
) -> StreamingQuery:
    """Upsert new Parquet files into a keyed table.

    A micro-batch reads and rewrites only the parts its keys fall in, and is one version of the table. Replaying one
    leaves the same rows: the merge is keyed, and an older row never replaces a newer one.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        versioned(spark, target).merge(batch, keys, [order_by], newer=order_by, preserve=(), part_rows=part_rows)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserted(spark: SparkSession, target: str) -> DataFrame:
    """A table that ``stream_upsert`` keeps."""
    return read_table(spark, target)


def stream_append(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, max_files: int = 1000
) -> StreamingQuery:
    """Append-only history load; the checkpoint keeps each file exactly once."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    return (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )
