"""Exact top-k by integer inner product with a table of distances to pivots.

A component x counts as floor(``scale`` * x). Distances to the pivots (the origin and well spread vectors of a bounded
sample) are computed once for every vector. For a query q and a candidate c the largest difference of their distances to a pivot is a
lower bound of |q - c|, so (|q|^2 + |c|^2 - bound^2) / 2 is an upper bound of their inner product. Candidates are
evaluated in order of that bound until the k-th best score is above the next bound: the result is exact.

Candidates belong to the group of their nearest pivot; a group's range of distances to every pivot bounds all its scores.
A first pass gives each query one block of its best-bounded group and so a threshold, its k-th best score there; then it visits
only the groups whose bound reaches the threshold. A cell holds at most about ``QUERIES`` x ``CANDIDATES`` rows; candidates are
copied only for the queries that visit their block. ``evaluated`` tells how many candidates a query's products were taken with.
Where the pivots tell little, as for vectors spread evenly in many dimensions, all blocks are visited. Vectors of different lengths are compared on their common leading components. Rows
that are equal count once, rows with the query's id are not its candidates, an id with several vectors has its best
score. Vectors that are null, empty or hold null or non-finite components, and null ids, take no part. Scores beyond the
64-bit range are set to its ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.session import scratch_path

from .common import blocks, smallest
from .vectors import best, map_vectors, packed, unpacked, usable

PIVOTS, SAMPLE = 63, 512
QUERIES, CANDIDATES, STEP = 2048, 8192, 256
# Up to this size of components the sums of products fit 64 bits for any dimension below 2 ** 23.
EXACT_LIMIT = 2 ** 20
LONGEST = 2 ** 63 - 1


def choose(sample: np.ndarray, count: int) -> np.ndarray:
    """The origin, then vectors of the sample, each farthest from those before it."""
    chosen = [np.zeros(sample.shape[1])]
    gap = np.linalg.norm(sample, axis=1)
    while len(chosen) <= count and len(sample) and gap.max() > 0:
        chosen.append(sample[gap.argmax()])
        gap = np.minimum(gap, np.linalg.norm(sample - chosen[-1], axis=1))
    return np.array(chosen)


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(rows - p, axis=1) for p in pivots], axis=1)


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products; components that could exceed 64 bits are multiplied as Python integers."""
    if max(np.abs(rows).max(initial=0), np.abs(query).max(initial=0)) < EXACT_LIMIT:
        return rows.astype(np.int64) @ query.astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.array([max(-LONGEST - 1, min(LONGEST, x)) for x in whole(rows).dot(whole(query))], np.int64)


def evaluate(query: np.ndarray, query_far: np.ndarray, query_id: int, ids: np.ndarray, rows: np.ndarray, far: np.ndarray, k: int, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the best ``k`` that reach ``least``, and how many candidates were evaluated."""
    lower = np.abs(far - query_far).max(axis=1)
    squares = query_far[0] ** 2 + far[:, 0] ** 2  # the first pivot is the origin
    upper = (squares - lower ** 2) / 2 + squares * 1e-9 + 1  # room for rounding
    upper[ids == query_id] = -np.inf
    order = np.argsort(-upper, kind="stable")
    order = order[:len(order) - int((ids == query_id).sum())]
    top_ids, top, done = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    while done < len(order) and upper[order[done]] >= (least if len(top) < k else max(least, top[-1])):
        part = order[done:done + STEP]
        top_ids, top = np.concatenate([top_ids, ids[part]]), np.concatenate([top, products(rows[part], query)])
        keep = np.lexsort((top_ids, ~top))[:k]
        top_ids, top, done = top_ids[keep], top[keep], done + len(part)
    return top_ids, top, done


def reach(query_far: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Upper bounds of a query's scores in each group, from the groups' ranges of distances; the first pivot is the origin."""
    lower = np.maximum(0, np.maximum(low - query_far, query_far - high)).max(axis=1)
    squares = query_far[0] ** 2 + high[:, 0] ** 2
    return (squares - lower ** 2) / 2 + squares * 1e-9 + 1


def visit(queries: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score, done`` of queries (with ``group``, ``block``, ``least``) and the candidates of that block.

    ``done``, the candidates evaluated, stands in one row of each visit; a visit without a result has null ``vec_id``.
    """
    path = scratch_path(table.sparkSession, "pivots")
    queries.groupBy("group", "block").agg(F.ceil(F.count("*") / QUERIES).alias("parts")).write.parquet(path)
    # Read once for either side, so that the two sides share no column.
    asked, met = (table.sparkSession.read.parquet(path) for _ in range(2))
    left = queries.join(asked, ["group", "block"]).withColumn("part", F.pmod(F.xxhash64("id", "v", F.lit(3)), F.col("parts"))).drop("parts")
    right = table.join(met, ["group", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, vectors, far = right["id"].to_numpy(), unpacked(right["v"], float), unpacked(right["far"], float)
            for query_id, least, query, query_far in zip(left["id"], left["least"], unpacked(left["v"], float), unpacked(left["far"], float)):
                top_ids, top, done = evaluate(query, query_far, query_id, ids, vectors, far, k, least)
                rows = max(1, len(top))
                out.append(pd.DataFrame({
                    "query_id": query_id, "vec_id": pd.array(top_ids if len(top) else [None], "Int64"),
                    "score": pd.array(top if len(top) else [None], "Int64"), "done": [done] + [0] * (rows - 1)}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="Int64") for c in ("query_id", "vec_id", "score", "done")})

    cells = ["group", "block", "part"]
    return left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInPandas(cell, "query_id long, vec_id long, score long, done long")


def search(vectors: DataFrame, is_query: Column, *, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score, evaluated`` of the rows for which ``is_query`` (of the column ``id``) holds, against all others."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 1
    sample = [r.v + [0.0] * (dim - len(r.v)) for r in smallest(rows, F.xxhash64("id"), SAMPLE).collect()]
    pivots = choose(np.floor(np.array(sample, float).reshape(len(sample), dim) * scale), PIVOTS)
    shared = spark.sparkContext.broadcast(pivots)  # PIVOTS + 1 vectors

    def make(ids: np.ndarray, found: np.ndarray) -> list:
        found = np.floor(found * scale)
        far = distances(found, shared.value)
        return [ids, packed(found), packed(far), pa.array(list(far), pa.list_(pa.float64())), far.argmin(axis=1)]

    path = scratch_path(spark, "pivots")
    map_vectors(rows, dim, "id long, v binary, far binary, gaps array<double>, group long", [
        ("id", pa.int64()), ("v", pa.binary()), ("far", pa.binary()), ("gaps", pa.list_(pa.float64())), ("group", pa.int64())], make).write.parquet(path)
    stored = spark.read.parquet(path)
    # At most (PIVOTS + 1) squared ranges, whatever the table's size.
    ranges = stored.select("group", F.posexplode("gaps")).groupBy("group", "pos").agg(
        F.min("col").alias("low"), F.max("col").alias("high"), F.count("*").alias("n")).orderBy("group", "pos").collect()
    names, dealt = [r.group for r in ranges if r.pos == 0], [blocks(r.n, CANDIDATES) for r in ranges if r.pos == 0]
    low, high = (np.array([r[c] for r in ranges]).reshape(len(names), len(pivots)) for c in ("low", "high"))
    in_group = F.element_at(F.create_map(*(F.lit(x) for pair in zip(names, dealt) for x in pair)), F.col("group")) if names else F.lit(1)
    table = stored.select("id", "v", "far", "group").withColumn("block", F.pmod(F.xxhash64("id", "v"), in_group))
    queries = stored.where(is_query).select("id", "v", "far")

    def bounded(batches):
        for batch in batches:
            bounds = [reach(far, low, high) for far in unpacked(batch["far"], float)]
            yield batch.assign(bounds=[list(b) for b in bounds], home=[names[int(b.argmax())] for b in bounds])

    bounded_ = queries.mapInPandas(bounded, "id long, v binary, far binary, bounds array<double>, home long")
    path = scratch_path(spark, "pivots")
    bounded_.withColumn("group", F.col("home")).withColumn("at", F.pmod(F.xxhash64("id", F.lit(2)), in_group)).drop("group").write.parquet(path)
    queries = spark.read.parquet(path)
    path = scratch_path(spark, "pivots")
    visit(queries.select("id", "v", "far", F.col("home").alias("group"), F.col("at").alias("block"), F.lit(float("-inf")).alias("least")), table, k).write.parquet(path)
    first = spark.read.parquet(path)
    least = best(first.where("vec_id is not null"), k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("least"))
    reached = queries.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    number = F.array(*(F.lit(n) for n in names)) if names else F.array(F.lit(0).cast("long"))
    reached = reached.select("id", "v", "far", "least", "home", "at", F.posexplode("bounds")).where("col >= least")
    reached = reached.withColumn("group", F.element_at(number, F.col("pos") + 1).cast("long"))
    reached = reached.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), in_group.cast("long") - 1)))
    other = reached.where("group != home or block != at").select("id", "v", "far", "group", "block", "least")
    path = scratch_path(spark, "pivots")
    visit(other, table, k).write.parquet(path)
    found = first.unionByName(spark.read.parquet(path))
    evaluated = found.groupBy("query_id").agg(F.sum("done").alias("evaluated"))
    return best(found.where("vec_id is not null"), k).join(evaluated, "query_id")
