"""Vectors as packed rows, shared by the searches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` (long), ``v``: rows with an id and a vector without null or non-finite components; equal rows once."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad).dropDuplicates(["id", "v"])


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The arrays of a batch as rows; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    out = np.zeros((len(column), dim))
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def packed(rows: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(rows)]


def unpacked(column, kind: type) -> np.ndarray:
    """Rows of a column of packed vectors of one length."""
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def map_vectors(rows: DataFrame, dim: int, schema: str, fields: list[tuple[str, pa.DataType]],
                make: Callable[[np.ndarray, np.ndarray], list]) -> DataFrame:
    """Runs ``make(ids, vectors) -> columns`` over batches of ``id``, ``v``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                columns = make(part.column(0).to_numpy(), matrix(part.column(1), dim))
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, fields)], schema=pa.schema(fields))

    return rows.select("id", "v").mapInArrow(run, schema)


def block_of(n: int, seed: int) -> Column:
    """A block for each id, of ``n`` equally likely ones."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(n)).cast("int")


def best(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest scores of each query, ties to the smaller id."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
