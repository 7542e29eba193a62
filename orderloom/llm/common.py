"""Helpers shared by the operators: key hashes, bounded samples, block counts, text batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
import pyarrow as pa

# Texts handed to one vectorised step together: at most so many characters, or one text.
BATCH_CHARS = 2_000_000


def boxed(df: DataFrame, *columns: Column) -> DataFrame:
    """All columns of ``df`` as one struct ``row``, so that no name of theirs can meet one of an operator's own."""
    return df.select(F.struct(*(F.col(quoted(c)) for c in df.columns)).alias("row"), *columns)


def unboxed(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select("row.*", *columns)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def id_text(col: str | Column) -> Column:
    """The id as text; a null id counts as the empty text."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def fold(col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(id_text(col).cast("binary")) % folds


def blocks(rows: int, size: int) -> int:
    """How many blocks of about ``size`` hold ``rows``; at least one."""
    return max(1, -(-rows // size))


def smallest(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The ``n`` rows with the smallest key: a bounded sample that does not depend on partitions."""
    return df.withColumn("_key", key).orderBy("_key").limit(n).drop("_key")


def text_batches(texts: Iterable[str | None], chars: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive runs of texts (null: empty) of bounded size, each with the index of its first."""
    first, run, total = 0, [], 0
    for text in texts:
        text = text or ""
        if run and total + len(text) > chars:
            yield first, run
            first, run, total = first + len(run), [], 0
        run.append(text)
        total += len(text)
    if run:
        yield first, run


def arrow_rows(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def with_columns(df: DataFrame, kept: str, more: str) -> StructType:
    """The schema of the columns named in ``kept``, as they are in ``df``, and of those that ``more`` declares."""
    return StructType([*(df.schema[c] for c in kept.split(", ")), *StructType.fromDDL(more).fields])


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def sample_bound(df: DataFrame, key: Column, n: int) -> int | None:
    """The ``n``-th smallest distinct key (None without rows): ``key <= bound`` picks a sample of ``n`` keys.

    Only the keys are sorted, so that a sample of long rows costs one narrow scan and one filter.
    """
    keys = df.select(key.alias("_key")).where("_key is not null").distinct().orderBy("_key").limit(n)
    return keys.agg(F.max("_key")).first()[0]


# Rows and bytes that travel to a Python worker together; texts are long, so fewer than Spark's own 10,000 rows.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds the batches that workers get, and lets them find this package at the path it has here."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark
