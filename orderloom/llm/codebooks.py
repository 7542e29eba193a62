"""Product codes of integer vectors: exact nearest codebook entries by limb-split matrix products.

Components become integers and vectors are cut into equal parts, each with a codebook of its own. The nearest entry needs
``|e|^2 - 2 x.e`` for every part and entry: one matrix product. To be exact it is done in limbs: every integer is broken into
digits so narrow that a product of two limb matrices stays below 2^53 in each sum, where float64 BLAS is exact; the
products are put together in int64, and the first smallest distance wins. How many limbs there are follows from the largest
component (limbs that are all zero are left out): small components need one, larger ones more.

Codebooks are learnt by rounds of assigning all parts and moving each entry to the floored mean of its parts. A task returns
one sum for each entry in use, whatever its rows; Spark adds them up; the driver gets parts x entries x width integers.

Rows whose vector is null or holds null or non-finite components take no part. Vectors shorter than the longest end in
zeros, and zeros make up a length that the parts do not divide (an empty vector is all zeros). Repeated rows count each
time; equal ids among the first entries are ordered by vector, null ids come last. An empty table gives empty codebooks and
no rows. Components so large that a squared distance might not fit a long raise ``ValueError``. Extra columns pass through
within ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.session import cut_lineage

from .common import quoted
from .vectors import matrix

# Integers up to this size are exact in float64.
EXACT = 53


def limb_bits(width: int) -> int:
    """The widest limb for which sums of ``width`` products of two limbs stay below 2^53."""
    return (EXACT - max(width, 1).bit_length()) // 2


def limb_count(largest: int, bits: int) -> int:
    """Limbs that integers of absolute value up to ``largest`` need; the top one keeps the sign."""
    return max(1, -(-largest.bit_length() // bits))


def limbs(values: np.ndarray, bits: int, count: int) -> list[np.ndarray | None]:
    """int64 values as float64 digits of ``bits`` bits, lowest first; None for a digit that is zero everywhere."""
    digits = []
    for _ in range(count - 1):
        digits.append(values & ((1 << bits) - 1))
        values = values >> bits
    digits.append(values)
    return [d.astype(np.float64) if d.any() else None for d in digits]


def exact_products(left: list[np.ndarray | None], right: list[np.ndarray | None], shape: tuple[int, ...], bits: int) -> np.ndarray:
    """The (stacked) matrix product of two limb-split integer matrices, in int64."""
    total = np.zeros(shape, np.int64)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            if a is not None and b is not None:
                total += (a @ b).astype(np.int64) << (bits * (i + j))  # what passes 2^63 on the way comes back in the sum
    return total


def nearest(parts: np.ndarray, books: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """For ``parts`` (part, row, component) and ``books`` (part, entry, component), both int64: the first nearest entry of each
    row and its squared distance, as (part, row)."""
    bits = limb_bits(parts.shape[2])
    count = limb_count(largest, bits)
    entries = books.transpose(0, 2, 1)
    dots = exact_products(limbs(parts, bits, count), limbs(entries, bits, count), (*parts.shape[:2], books.shape[1]), bits)
    gaps = (books * books).sum(2)[:, None, :] - 2 * dots
    index = gaps.argmin(2)
    return index, (parts * parts).sum(2) + np.take_along_axis(gaps, index[..., None], 2)[..., 0]


@dataclass(frozen=True)
class Codebooks:
    """Entries as (part, entry, component), and the largest absolute component of the vectors they are for."""

    entries: np.ndarray
    scale: int
    largest: int

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    def split(self, vectors: pa.Array) -> np.ndarray:
        """The vectors of a batch as integers, (part, row, component)."""
        parts, width = self.entries.shape[0], self.entries.shape[2]
        whole = np.floor(matrix(vectors, parts * width) * self.scale).astype(np.int64)
        return np.ascontiguousarray(whole.reshape(len(whole), parts, width).transpose(1, 0, 2))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, vector_col: str, keep: Sequence[str]) -> DataFrame:
    """``row`` (the columns of ``keep``) and ``v`` (array of doubles) of the rows that take part."""
    v = F.col(quoted(vector_col)).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.struct(*(F.col(quoted(c)) for c in keep)).alias("row"), v.alias("v")).where(F.col("v").isNotNull() & ~bad)


def first_entries(vectors: DataFrame, id_col: str, vector_col: str, parts: int, entries: int, scale: int) -> Codebooks:
    """Codebooks from the parts of the ``entries`` vectors of the smallest ids."""
    rows = usable(vectors, vector_col, [id_col])
    size, high, low = rows.agg(F.max(F.size("v")), F.max(F.array_max("v")), F.min(F.array_min("v"))).first()
    width = -(-(size or 0) // parts)
    largest = max(abs(math.floor(x * scale)) for x in (high or 0.0, low or 0.0)) + 1
    # A squared distance is at most width x (2 x largest)^2 in a part; their sum over the parts must fit too.
    if 4 * largest * largest * max(width, 1) * parts >= 1 << 63:
        raise ValueError(f"squared distances of components up to {largest} do not fit a long")
    first = rows.orderBy(F.col("row." + quoted(id_col)).asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    books = Codebooks(np.zeros((parts, 0, width), np.int64), scale, largest)
    return Codebooks(books.split(first.column(0)), scale, largest)


def assigned(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Adds ``code`` (one byte a part) and ``error`` (squared distances summed over the parts) to ``row``."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            index, far = nearest(held.split(batch.column(1)), held.entries, held.largest)
            codes = list(map(bytes, np.ascontiguousarray(index.T.astype(np.uint8))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes, pa.binary()), pa.array(far.sum(0))],
                schema=pa.schema([batch.schema.field(0), ("code", pa.binary()), ("error", pa.int64())]))

    return rows.mapInArrow(run, rows.select("row").withColumns({"code": F.lit(b""), "error": F.lit(0).cast("long")}).schema)


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: each entry at the floored mean of its parts; unused ones stay."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        parts, entries, width = held.entries.shape
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            split = held.split(batch.column(0))
            index, _ = nearest(split, held.entries, held.largest)
            place = (index + np.arange(parts)[:, None] * entries).reshape(-1)
            np.add.at(sums, place, split.reshape(-1, width))
            counts += np.bincount(place, minlength=parts * entries)
        used = np.flatnonzero(counts)
        schema = pa.schema([("place", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
        flat = pa.array(sums[used].reshape(-1))
        lists = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * width, flat)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]), lists], schema=schema)

    partial = rows.select("v").mapInArrow(run, "place int, n long, sums array<long>")
    whole = F.sum(F.col("value").cast("decimal(38,0)"))
    totals = partial.select("place", "n", F.posexplode("sums").alias("at", "value")).groupBy("place", "at").agg(
        F.sum("n").alias("n"), whole.alias("total")).collect()
    new = books.entries.copy()
    for place, at, n, total in totals:
        new[(*divmod(place, new.shape[1]), at)] = int(total) // n
    return Codebooks(new, books.scale, books.largest)


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = 16, entries: int = 64,
             rounds: int = 2, scale: int = 256, keep: Sequence[str] | None = None) -> tuple[DataFrame, Codebooks]:
    """``row`` (the columns of ``keep``; by default all but the vector), ``code`` and ``error`` of every vector, and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    books = first_entries(vectors, id_col, vector_col, parts, entries, scale)
    rows = usable(vectors, vector_col, [c for c in vectors.columns if c != vector_col] if keep is None else keep)
    if books.entries.size:
        for _ in range(rounds):
            books = moved(rows, books)
    return assigned(rows, books), books


def with_group_error(coded: DataFrame, group_col: str) -> DataFrame:
    """Adds ``group_error``, the error summed over the rows of the same ``row.group_col`` (nulls are one group).

    The codes are stored once; sums are made before the shuffle, and a group that holds most rows is the split side of the join.
    """
    group = F.col("row." + quoted(group_col)).alias("_group")
    stored = cut_lineage(coded.withColumn("_group", group))
    totals = stored.groupBy("_group").agg(F.sum("error").alias("group_error")).withColumnRenamed("_group", "_of")
    return stored.join(totals, F.col("_group").eqNullSafe(F.col("_of"))).drop("_group", "_of")


def oracle() -> str:
    """The same codes, codebooks and errors as DuckDB SQL, for vectors of 64 components."""
    far = " + ".join(f"(p.s[{j}] - b.s[{j}]) * (p.s[{j}] - b.s[{j}])" for j in range(1, 5))

    def closest(books: str) -> str:
        return f"""SELECT p.vec_id, p.label, p.part, p.s, min(({far}) * 64 + b.entry) AS best
            FROM p JOIN {books} b USING (part) GROUP BY ALL"""

    def mean(j: int) -> str:
        total, n = f"sum(s[{j}])", "count(*)"
        return f"(({total} - ((({total} % {n}) + {n}) % {n})) // {n})::BIGINT"

    def means(books: str, closest_to: str) -> str:
        return f"""SELECT b.part, b.entry, coalesce(m.s, b.s) AS s FROM {books} b LEFT JOIN (
            SELECT part, best % 64 AS entry, [{', '.join(map(mean, range(1, 5)))}] AS s FROM {closest_to} GROUP BY ALL) m USING (part, entry)"""

    return f"""
    WITH x AS (SELECT vec_id, label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
    p AS MATERIALIZED (SELECT vec_id, label, part, v[part * 4 + 1:part * 4 + 4] AS s FROM x, (SELECT unnest(range(16)) AS part)),
    b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, s FROM p QUALIFY entry < 64),
    a1 AS MATERIALIZED ({closest('b0')}), b1 AS MATERIALIZED ({means('b0', 'a1')}),
    a2 AS MATERIALIZED ({closest('b1')}), b2 AS MATERIALIZED ({means('b1', 'a2')}),
    a3 AS MATERIALIZED ({closest('b2')}),
    coded AS (SELECT vec_id, label, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error
        FROM a3 GROUP BY ALL),
    sha AS (SELECT sha256(string_agg(concat_ws(',', s[1], s[2], s[3], s[4]), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, sha"""
