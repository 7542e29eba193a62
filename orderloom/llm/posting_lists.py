"""Approximate nearest neighbours by largest inner product, from balanced posting lists.

A last component sqrt(M^2 - |x|^2), M the largest norm, makes the largest inner product the smallest distance. A bounded
sample is halved again and again across its widest direction, which gives balanced clusters; their means are the
centroids. Every vector goes to the list of its nearest centroid, and boundary vectors to up to ``COPIES`` lists whose distance
is within ``COPY_RATIO`` of the nearest and which no nearer chosen centroid stands for. A query walks the graph of
neighbouring centroids in memory and reads the lists whose distance is within a ratio of the nearest one. That ratio is fitted
on the sample, so that ``TARGET`` of its true neighbours lie in the lists read. Found vectors are scored exactly.

Lists are packed into cells of about ``CELL`` vectors; a longer list (many copies of one vector) is split over several.
A query goes once to each cell that holds a list of its own. Every row is indexed. Vectors that are null, empty, zero or
hold null or non-finite components, and null ids, take no part; shorter vectors count as ending in zeros. Equal rows count once; rows
with the query's id are not its candidates. A query reads further lists until they hold ``ENOUGH`` * k vectors.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.session import scratch_path

from .common import blocks, smallest
from .vectors import best, block_of, map_vectors, packed, unpacked, usable

# The sample, the vectors of it that stand for one centroid, and the most centroids.
SAMPLE, PER_CENTROID, MOST_CENTROIDS = 16_384, 64, 4096
COPIES, COPY_RATIO = 4, 1.05
DEGREE, TARGET, TRIALS, ENOUGH = 16, 0.98, 256, 8
CELL, QUERIES = 8192, 2048


def halve(rows: np.ndarray, count: int) -> list[np.ndarray]:
    """Means of ``count`` clusters of nearly equal size, neighbours next to each other."""
    if count <= 1 or len(rows) < 2:
        return [rows.mean(axis=0)]
    spread = rows - rows.mean(axis=0)
    direction = spread[np.argmax((spread ** 2).sum(axis=1))]
    for _ in range(4):  # power steps towards the widest direction
        direction = spread.T @ (spread @ direction)
        direction = direction / (np.linalg.norm(direction) or 1)
    order = np.argsort(spread @ direction, kind="stable")
    left = count // 2
    cut = max(1, len(rows) * left // count)
    return halve(rows[order[:cut]], left) + halve(rows[order[cut:]], count - left)


def gaps(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """[row, centroid] distances."""
    squares = (rows ** 2).sum(axis=1)[:, None] + (centroids ** 2).sum(axis=1) - 2 * rows @ centroids.T
    return np.sqrt(np.maximum(squares, 0))


@dataclass
class Index:
    dim: int
    norm: float             # M
    centroids: np.ndarray   # MOST_CENTROIDS at most
    between: np.ndarray     # distances between centroids
    near: np.ndarray        # [centroid, DEGREE] neighbours in the graph
    entries: np.ndarray     # where walks start
    ratio: float = 1.0

    def lift(self, rows: np.ndarray, query: bool = False) -> np.ndarray:
        last = np.zeros(len(rows)) if query else np.sqrt(np.maximum(self.norm ** 2 - (rows ** 2).sum(axis=1), 0))
        return np.concatenate([rows, last[:, None]], axis=1)

    def lists(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of each place of each lifted vector: the nearest list and those of its boundary."""
        far = gaps(rows, self.centroids)
        order = np.argpartition(far, min(COPIES, far.shape[1]) - 1, axis=1)[:, :COPIES]
        order = np.take_along_axis(order, np.take_along_axis(far, order, 1).argsort(axis=1, kind="stable"), 1)
        each = np.take_along_axis(far, order, 1)
        keep = each <= each[:, :1] * COPY_RATIO
        for j in range(1, order.shape[1]):
            for i in range(j):
                keep[:, j] &= ~keep[:, i] | (self.between[order[:, j], order[:, i]] >= each[:, j])
        keep[:, 0] = True
        at, place = np.nonzero(keep)
        return at, order[at, place]

    def walk(self, query: np.ndarray, sizes: np.ndarray, least: int) -> list[int]:
        """Lists to read, nearest first: those within the ratio, and more until they hold ``least`` vectors."""
        def far(nodes: np.ndarray) -> np.ndarray:
            return np.sqrt(((self.centroids[nodes] - query) ** 2).sum(axis=1))

        seen = np.zeros(len(self.centroids), bool)
        seen[self.entries] = True
        heap = list(zip(far(self.entries).tolist(), self.entries.tolist()))
        heapq.heapify(heap)
        nearest, held, out = heap[0][0], 0, []
        while heap:
            gap, node = heapq.heappop(heap)
            nearest = min(nearest, gap)
            out.append((gap, node))
            held += sizes[node]
            if gap > nearest * self.ratio and held >= least and len(out) > DEGREE:
                break
            new = self.near[node]
            new = new[~seen[new]]
            if len(new):
                seen[new] = True
                for item in zip(far(new).tolist(), new.tolist()):
                    heapq.heappush(heap, item)
        chosen, held = [], 0
        for gap, node in sorted(out):
            if gap > nearest * self.ratio and held >= least:
                break
            chosen.append(node)
            held += sizes[node]
        return chosen


def fit(sample: np.ndarray, norm: float, rows: int, k: int) -> Index:
    """Centroids, their graph and the ratio, from a sample of the vectors."""
    dim = sample.shape[1]
    index = Index(dim, norm, np.zeros((1, dim + 1)), np.zeros((1, 1)), np.zeros((1, 0), int), np.zeros(1, int))
    if not len(sample):
        return index
    lifted = index.lift(sample)
    count = min(MOST_CENTROIDS, max(1, rows // 128), max(1, len(sample) // PER_CENTROID))
    index.centroids = np.array(halve(lifted, count))
    index.between = gaps(index.centroids, index.centroids)
    # Nearest neighbours, and a ring through all centroids so that every one can be reached.
    order = np.argsort(index.between, axis=1, kind="stable")[:, 1:DEGREE - 1]
    ring = np.stack([np.roll(np.arange(count), 1), np.roll(np.arange(count), -1)], axis=1)
    index.near = np.concatenate([order, ring], axis=1)
    index.entries = np.unique(np.linspace(0, count - 1, min(count, 16)).astype(int))
    at, lists = index.lists(lifted)
    member = np.zeros((len(sample), count), bool)
    member[at, lists] = True
    trials = np.unique(np.linspace(0, len(sample) - 1, min(TRIALS, len(sample))).astype(int))
    far = gaps(index.lift(sample[trials], query=True), index.centroids)
    scores = sample[trials] @ sample.T
    scores[np.arange(len(trials)), trials] = -np.inf
    true = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, len(sample) - 1)]
    needed = np.array([np.where(member[t], f, np.inf).min(axis=1) / max(f.min(), 1e-12) for t, f in zip(true, far)])
    index.ratio = float(np.quantile(needed, TARGET)) * (1 + 1e-9) if needed.size else 1.0
    return index


def search(vectors: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows for which ``is_query`` (of the column ``id``) holds, against all others."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    size = rows.agg(F.max(F.size("v")), F.count("*"), F.count_if(is_query), F.max(square)).first()
    dim, n, asked, norm = size[0] or 1, size[1], size[2], float(np.sqrt(size[3] or 0.0))
    sample = [r.v + [0.0] * (dim - len(r.v)) for r in smallest(rows, F.xxhash64("id"), SAMPLE).collect()]
    index = fit(np.array(sample, float).reshape(len(sample), dim), norm, n, k)
    shared = spark.sparkContext.broadcast(index)

    def place(ids: np.ndarray, found: np.ndarray) -> list:
        at, lists = shared.value.lists(shared.value.lift(found))
        return [lists, ids[at], [x.tobytes() for x in found[at]]]

    path = scratch_path(spark, "posting-lists")
    map_vectors(rows, dim, "list int, id long, v binary", [("list", pa.int32()), ("id", pa.int64()), ("v", pa.binary())], place).write.parquet(path)
    postings = spark.read.parquet(path)
    sizes = np.zeros(len(index.centroids), np.int64)
    for row in postings.groupBy("list").agg(F.count("*").alias("n")).collect():  # a row for each centroid
        sizes[row.list] = row.n
    first, parts, cells, held = np.zeros_like(sizes), np.ones_like(sizes), 0, 0
    for i, count in enumerate(sizes.tolist()):
        if count > CELL:
            first[i], parts[i] = cells + (held > 0), blocks(count, CELL)
            cells, held = int(first[i] + parts[i]), 0
        else:
            if held + count > CELL:
                cells, held = cells + 1, 0
            first[i], held = cells, held + count
    layout = spark.sparkContext.broadcast((sizes, first, parts))
    query_blocks = blocks(asked, QUERIES)

    def ask(ids: np.ndarray, found: np.ndarray) -> list:
        index, (sizes, first, parts) = shared.value, layout.value
        cell, query, vector, lists = [], [], [], []
        for id_, row, lifted in zip(ids.tolist(), found, index.lift(found, query=True)):
            wanted: dict[int, list[int]] = {}
            for chosen in index.walk(lifted, sizes, ENOUGH * k):
                for c in range(first[chosen], first[chosen] + parts[chosen]):
                    wanted.setdefault(c, []).append(chosen)
            cell += wanted
            query += [id_] * len(wanted)
            vector += [row.tobytes()] * len(wanted)
            lists += [np.array(x, np.int32).tobytes() for x in wanted.values()]
        return [cell, query, vector, lists]

    fields = [("cell", pa.int32()), ("id", pa.int64()), ("v", pa.binary()), ("lists", pa.binary())]
    queries = map_vectors(rows.where(is_query), dim, "cell int, id long, v binary, lists binary", fields, ask).withColumn("q", block_of(query_blocks, 1))
    table = spark.createDataFrame(pd.DataFrame({"list": np.arange(len(sizes), dtype=np.int32), "first": first.astype(np.int32), "parts": parts.astype(np.int32)}))
    candidates = postings.join(F.broadcast(table), "list").withColumn(  # MOST_CENTROIDS rows at most
        "cell", (F.col("first") + F.pmod(F.xxhash64("id"), "parts")).cast("int")).select(
        "cell", "list", "id", "v", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, rows_, lists = right["id"].to_numpy(), unpacked(right["v"], float), right["list"].to_numpy()
            for at in range(0, len(left), 256):
                part = left.iloc[at:at + 256]
                asked_ = unpacked(part["v"], float)
                rough = asked_ @ rows_.T
                for query_id, query, wanted, score in zip(part["id"], asked_, part["lists"], rough):
                    own = np.flatnonzero(np.isin(lists, np.frombuffer(wanted, np.int32)) & (ids != query_id))
                    # A vector that is in several lists counts once, so the best k are among the best COPIES * k.
                    if len(own) > COPIES * k:
                        edge = np.partition(score[own], -COPIES * k)[-COPIES * k]
                        own = own[score[own] >= edge - 1e-9 * (1 + abs(edge))]
                    exact = np.zeros(len(own))
                    for d in range(rows_.shape[1]):  # one fixed order of adding, so that equal vectors tie
                        exact += rows_[own, d] * query[d]
                    found = np.unique(ids[own], return_index=True)
                    pick = np.lexsort((found[0], -exact[found[1]]))[:k]
                    out.append(pd.DataFrame({"query_id": query_id, "vec_id": found[0][pick], "score": exact[found[1]][pick]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    found = queries.groupBy("cell", "q").cogroup(candidates.groupBy("cell", "q")).applyInPandas(meet, "query_id long, vec_id long, score double")
    return best(found, k)
