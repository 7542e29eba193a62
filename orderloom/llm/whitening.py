"""Whitening of integer vectors, the covariance taken exactly from bit slices.

Components become integers. Rows are gathered into blocks; a block is shifted by its own minima, so that the integers are
small and not negative, and every bit plane of every dimension is packed across the rows into 64-bit words. The cross-product
of two dimensions is the sum over pairs of their planes of 2^(a+b) times the number of ones in the AND of the planes: whole
numbers all the way. The shift is put back with the sums, tasks return one exact number for each pair of dimensions, Spark
adds them as decimals, and the driver gets D (D + 1) / 2 + D + 1 of them for D dimensions. There the covariance is centred in
integers, ``n sum(x y) - sum(x) sum(y)``, and divided by n^2 once, before ``eigh``. So no rounding depends on the number
of rows, on their order or on a mean far from zero.

Rows whose vector is null or holds null or non-finite entries take no part. Vectors shorter than the longest end in zeros (an
empty one is all zeros). Repeated rows count each time. Components whose eigenvalue is zero to rounding (``D * 2^-52`` of the
largest) cannot be whitened and are left out: of fewer than D + 1 rows there are fewer than D components, of one row or of
equal rows none, and of an empty table no rows. A ``deviation`` beyond a long is null. Entries that do not fit a long after
scaling raise ``ValueError``. Extra columns pass through within ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .codebooks import usable
from .vectors import matrix

# Rows whose planes are packed together: so many words a plane stay in the cache.
BLOCK_ROWS = 16_384
SCALE, OFFSET = 64, 1_000_000

LONG = 1 << 63


def whole_numbers(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * entry) of a batch, (row, dimension)."""
    return np.floor(matrix(vectors, dims) * scale).astype(np.int64)


def planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative integers (row, dimension) that hold a one: packed words (plane, word), dimension and bit of each."""
    bits = [int(m).bit_length() for m in values.max(0)]
    dims = np.repeat(np.arange(len(bits)), bits)
    bit = np.concatenate([np.arange(b) for b in bits]) if sum(bits) else np.zeros(0, np.int64)
    columns = np.ascontiguousarray(values.T)
    words = np.zeros((len(dims), -(-values.shape[0] // 64) * 8), np.uint8)
    for p, (d, b) in enumerate(zip(dims, bit)):
        row = np.packbits((columns[d] >> b & 1).astype(bool))
        words[p, :len(row)] = row
    return words.view(np.uint64), dims, bit


def cross_products(values: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of the products of all pairs of dimensions (upper triangle, Python integers), by AND-popcounts."""
    size = values.shape[1]
    words, dims, bit = planes(values)
    total = np.zeros((size, size), object)
    # Weighted counts of one pair of planes stay below 2^(a + b) x rows; beyond a long they are added as Python integers.
    narrow = len(bit) == 0 or 2 * int(bit.max()) + 2 + int(values.shape[0]).bit_length() <= 62
    weights = np.left_shift(1, bit) if narrow else np.array([1 << int(b) for b in bit], object)
    for d in range(size):
        own = np.flatnonzero(dims == d)
        if not len(own):
            continue
        later = slice(own[0], None)  # planes of this dimension and of those after it
        sums = np.zeros(len(dims) - own[0], np.int64 if narrow else object)
        for p in own:
            counts = np.bitwise_count(words[later] & words[p]).sum(1, dtype=np.int64)
            sums = sums + counts * weights[p]
        by_dim = np.zeros(size, object)
        np.add.at(by_dim, dims[later], sums * weights[later])
        total[d] = by_dim
    return total


def moments(rows: DataFrame, dims: int, scale: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, sums of each dimension and cross-products (Python integers) of the scaled vectors ``v``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)

        def add(block: np.ndarray) -> None:
            nonlocal n, sums, products
            low = block.min(0)
            shifted = block - low
            part, low = shifted.sum(0).astype(object), low.astype(object)
            n += len(block)
            sums += part + len(block) * low
            products += cross_products(shifted) + np.outer(low, part) + np.outer(part, low) + len(block) * np.outer(low, low)

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(whole_numbers(batch.column(0), dims, scale))
            if sum(map(len, held)) >= BLOCK_ROWS:
                add(np.concatenate(held))
                held = []
        if any(map(len, held)):
            add(np.concatenate(held))
        if n:
            a, b = np.triu_indices(dims)
            numbers = [n, *sums, *products[a, b]]
            keys = [np.concatenate([[-1], np.full(dims, -1), a]), np.concatenate([[-1], np.arange(dims), b])]
            schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("total", pa.string())])
            for at in range(0, len(numbers), 65_536):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(k[at:at + 65_536].astype(np.int32)) for k in keys), pa.array(list(map(str, numbers[at:at + 65_536])))], schema=schema)

    partial = rows.select("v").mapInArrow(run, "a int, b int, total string")
    totals = partial.groupBy("a", "b").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
    for a, b, total in totals:
        if a >= 0:
            products[a, b] = products[b, a] = int(total)
        elif b >= 0:
            sums[b] = int(total)
        else:
            n = int(total)
    return n, sums, products


@dataclass(frozen=True)
class Whitener:
    """What the rows are projected with. ``axes`` holds a unit eigenvector divided by the root of its eigenvalue in each column."""

    n: int
    scale: int
    sums: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    axes: np.ndarray

    def centred(self, vectors: pa.Array) -> np.ndarray:
        """``n x - S`` of a batch, exact; Python integers where a long might be too narrow."""
        x = whole_numbers(vectors, len(self.sums), self.scale)
        widest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        if self.n * widest + max(map(abs, self.sums), default=0) < LONG:
            return x * self.n - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.axes


def fit(n: int, sums: np.ndarray, products: np.ndarray, components: int, scale: int) -> Whitener:
    """The covariance, centred in integers, and its eigenvectors by falling eigenvalue."""
    dims = len(sums)
    exact = n * products - np.outer(sums, sums)
    covariance = np.array([[int(c) / (n * n) for c in row] for row in exact], np.float64).reshape(dims, dims) if n else np.zeros((dims, dims))
    values, vectors = np.linalg.eigh(covariance) if dims else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = np.flatnonzero(values > dims * 2.0 ** -52 * values[:1])[:components] if dims and values[0] > 0 else []
    trace = sum(int(exact[i, i]) for i in range(dims)) / (n * n) if n else 0.0
    return Whitener(n, scale, sums, values[kept], values[kept] / trace if trace else values[kept], vectors[:, kept] / np.sqrt(values[kept]))


def identity_error(rows: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on all rows.

    The rows are centred exactly before they are projected, so their products need no further mean.
    """
    k = model.axes.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((k, k))
        for batch in batches:
            w = shared.value.project(shared.value.centred(batch.column(0)))
            gram += w.T @ w
        a, b = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(a * k + b), pa.array(gram[a, b])], names=["place", "total"])

    sums = rows.select("v").mapInArrow(run, "place long, total double").groupBy("place").agg(F.sum("total").alias("total"))
    wanted = F.when(F.col("place") % (k + 1) == 0, 1.0).otherwise(0.0)
    return sums.agg(F.max(F.abs(F.col("total") / model.n - wanted))).first()[0]


def whiten(vectors: DataFrame, *, vector_col: str = "embedding", components: int = 32, scale: int = SCALE,
           keep: Sequence[str] | None = None) -> tuple[DataFrame, Whitener]:
    """``row`` (the columns of ``keep``; by default all but the vector), ``deviation`` (long: the sum over dimensions of
    ``(n x - S)^2``) and ``whitened`` (array of doubles, one for each component) of every vector, and the model.

    A constant added to every integer changes nothing here, since all is centred; ``OFFSET`` names the contract's.
    """
    rows = usable(vectors, vector_col, [c for c in vectors.columns if c != vector_col] if keep is None else keep)
    dims, high, low = rows.agg(F.max(F.size("v")), F.max(F.array_max("v")), F.min(F.array_min("v"))).first()
    if max(abs(high or 0.0), abs(low or 0.0)) * scale + OFFSET >= LONG:
        raise ValueError("scaled entries do not fit a long")
    model = fit(*moments(rows, dims or 0, scale), components, scale)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        k = held.axes.shape[1]
        for batch in batches:
            centred = held.centred(batch.column(1))
            widest = int(np.abs(centred).max(initial=0))
            whole = centred if widest * widest * centred.shape[1] < LONG else centred.astype(object)
            deviation = [d if d < LONG else None for d in (whole * whole).sum(1).tolist()]
            flat = pa.array(held.project(centred).reshape(-1))
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * k, flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()), lists],
                schema=pa.schema([batch.schema.field(0), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))]))

    schema = rows.select("row", F.lit(None).cast("long").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")).schema
    return rows.mapInArrow(run, schema), model


def components_of(vectors: DataFrame, *, vector_col: str = "embedding", components: int = 32, scale: int = SCALE,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """One row for each vector and component: ``row``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``
    (share of the trace) and ``identity_error``."""
    rows, model = whiten(vectors, vector_col=vector_col, components=components, scale=scale, keep=keep)
    error = identity_error(usable(vectors, vector_col, []), model) if len(model.values) else None
    shares = F.array(*map(F.lit, model.explained.tolist())).cast("array<double>")
    return rows.select("row", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "row", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("_at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
