"""Sources interleaved to target weights by Pfair scheduling.

The documents of a source, in order of the MD5 of their id, are cut into blocks of ``block`` rows. With weight w, the
source's i-th block (from 0) is released at slot floor(i / w) and due by slot ceil((i + 1) / w). Each slot goes to the
released block with the earliest deadline (ties: the source with the larger weight, then the first name). Weights are
whole multiples of 1 / ``slots``, so the schedule repeats after ``slots`` slots: one such period is worked out by
the rule, and the blocks find their slots in it by a join on the source and the block's number in the period. After
any number of slots each source that still has blocks is less than one block from its target.

All rows stay. A source that has run out leaves its slots empty; the others keep theirs. Weights not given are in
proportion to the square root of the source's rows; given ones are scaled to the sources there are, and a source
without one is refused. Null is a source like any other. Rows are numbered within (source, first ``DIGITS`` digits
of the MD5), so a source that holds most rows is numbered in many tasks. Rows that share an id follow each other in
order of their text's MD5; rows equal in both are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from fractions import Fraction
import json
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import boxed, id_text

BLOCK, SLOTS, DIGITS = 16, 1000, 3
# Sources that one schedule can hold; a table with more is refused.
MOST_SOURCES = 10_000


def shares(weights: dict[str | None, int | Fraction], slots: int) -> dict[str | None, int]:
    """Whole slots of a period for each source, one at least, in proportion to the weights (largest remainders)."""
    slots = max(slots, len(weights))
    total = sum(weights.values())
    exact = {s: Fraction(w) * slots / total for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (out[s] - exact[s], s is None, s or ""))
    while (left := slots - sum(out.values())) != 0:
        for s in order if left > 0 else [s for s in reversed(order) if out[s] > 1]:
            if left == 0:
                break
            out[s] += 1 if left > 0 else -1
            left += -1 if left > 0 else 1
    return out


def period(given: dict[str | None, int]) -> list[tuple[str | None, int, int]]:
    """(source, block of the period, slot) of one period, by earliest deadline among the released."""
    slots, done, out = sum(given.values()), dict.fromkeys(given, 0), []
    names = sorted(given, key=lambda s: (-given[s], s is None, s or ""))
    for slot in range(slots):
        ready = [s for s in names if done[s] < given[s] and done[s] * slots // given[s] <= slot]
        best = min(ready, key=lambda s: -(-(done[s] + 1) * slots // given[s]))
        out.append((best, done[best], slot))
        done[best] += 1
    return out


def mix(docs: DataFrame, weights: dict[str | None, int | Fraction] | None = None, *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block: int = BLOCK, slots: int = SLOTS) -> DataFrame:
    """The documents as ``row`` with ``block`` (of its source), ``slot`` and ``place`` (in the block); order by slot, place."""
    spark = docs.sparkSession
    digest = F.md5(id_text(id_col))
    source, bucket = F.col(source_col).cast("string").alias("source"), F.substring(digest, 1, DIGITS).alias("bucket")
    rows = boxed(docs, source, bucket, digest.alias("digest"), F.col(id_col).alias("id"), F.md5(F.coalesce(text_col, F.lit(""))).alias("text_digest"))
    counts = docs.select(source, bucket).groupBy("source", "bucket").agg(F.count("*").alias("n"))
    # A source has 16 ** DIGITS buckets at most.
    before = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    sizes = counts.groupBy("source").agg(F.sum("n").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    if weights is None:
        weights = {r.source: max(1, isqrt(r.n * 1_000_000)) for r in sizes}
    elif unknown := {r.source for r in sizes} - set(weights):
        raise ValueError(f"no weight for the sources {sorted(map(str, unknown))}")
    given = shares({r.source: weights[r.source] for r in sizes}, slots) if sizes else {}
    # max(slots, MOST_SOURCES) rows at most
    steps = json.dumps([{"source": s, "i": i, "t": t, "share": given[s]} for s, i, t in period(given)])
    plan = spark.range(1).select(F.inline(F.from_json(F.lit(steps), "array<struct<source string, i long, t long, share long>>")))
    rank = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("digest", "id", "text_digest"))
    numbered = rows.withColumn("rank", rank)
    same = _same(numbered, offsets, "source") & (numbered["bucket"] == offsets["bucket"])
    number = F.col("before") + F.col("rank") - 1
    placed = numbered.join(offsets, same).select(
        "row", numbered["source"], F.floor(number / block).cast("long").alias("block"), (number % block).alias("place"))
    shares_ = F.broadcast(plan.groupBy("source").agg(F.max("share").alias("share")))
    placed = placed.join(shares_, _same(placed, shares_, "source")).select(
        "row", placed["source"], "block", "place", "share", (F.col("block") % F.col("share")).alias("i"))
    steps_ = F.broadcast(plan.select("source", "i", "t"))
    slot = F.expr("block div share") * sum(given.values()) + F.col("t")
    return placed.join(steps_, _same(placed, steps_, "source") & (placed["i"] == steps_["i"])).select("row", "block", slot.alias("slot"), "place")


def _same(left: DataFrame, right: DataFrame, name: str) -> Column:
    return left[name].eqNullSafe(right[name])


def oracle(table: str = "documents", block: int = BLOCK, slots: int = SLOTS, digits: int = DIGITS) -> str:
    """The query's rows as DuckDB SQL; the period is simulated slot by slot in a recursive query."""
    return f"""
WITH RECURSIVE numbered AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST, md5(coalesce(text, ''))) - 1 AS r
  FROM {table}),
size AS (SELECT source, count(*) AS n, CAST(floor(sqrt(CAST(count(*) * 1000000 AS DOUBLE))) AS BIGINT) AS w FROM numbered GROUP BY source),
total AS (SELECT sum(w) AS w, greatest({slots}, count(*)) AS slots FROM size),
floors AS (
  SELECT source, greatest(1, s.w * t.slots // t.w) AS f, t.slots,
    greatest(1, s.w * t.slots // t.w) * t.w - s.w * t.slots AS over
  FROM size s, total t),
ranked AS (SELECT *, row_number() OVER (ORDER BY over, source IS NULL, source) AS o, slots - sum(f) OVER () AS missing FROM floors),
given AS (
  SELECT source, CAST(f + CASE WHEN o <= missing THEN 1 ELSE 0 END AS BIGINT) AS g, CAST(slots AS BIGINT) AS slots,
    row_number() OVER (ORDER BY f + CASE WHEN o <= missing THEN 1 ELSE 0 END DESC, source IS NULL, source) AS o
  FROM ranked),
held AS (SELECT list(g ORDER BY o) AS g, any_value(slots) AS slots, range(1, count(*) + 1) AS os FROM given),
run(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(os, lambda o: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT) FROM held
  UNION ALL
  SELECT t + 1, list_transform(os, lambda o: done[o] + CASE WHEN o = p THEN 1 ELSE 0 END), p
  FROM (
    SELECT r.t, r.done, h.os, list_min(list_transform(
        list_filter(h.os, lambda o: r.done[o] < h.g[o] AND r.done[o] * h.slots // h.g[o] <= r.t + 1),
        lambda o: struct_pack(due := ((r.done[o] + 1) * h.slots + h.g[o] - 1) // h.g[o], o := o))).o AS p
    FROM run r, held h WHERE r.t + 1 < h.slots)),
plan AS (SELECT pick AS o, t, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS i FROM run WHERE t >= 0)
SELECT n.doc_id, n.source, n.r // {block} AS block, n.r % {block} AS place,
  CAST((n.r // {block}) // g.g * g.slots + p.t AS BIGINT) AS slot
FROM numbered n JOIN given g ON n.source IS NOT DISTINCT FROM g.source
JOIN plan p ON p.o = g.o AND p.i = (n.r // {block}) % g.g"""
