"""Equi-joins that keep the row count, and helpers for one-row and null-safe joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def lookup(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | dict[str, str]) -> DataFrame:
    """Left join to a dimension holding one row per key. ``on`` may map fact to dimension names.

    No broadcast hint: the planner broadcasts a dimension only below its size threshold.
    """
    if isinstance(on, dict):
        for left, right in on.items():
            dim = dim.withColumnRenamed(right, left)
        on = list(on)
    return fact.join(dim, on, "left")


def safe_lookup(
    fact: DataFrame,
    many: DataFrame,
    on: str | Sequence[str],
    to_one: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Left join to a side with several rows per key, reduced to one row per key beforehand."""
    return lookup(fact, to_one(many), on)


# Share of the rows in which hot keys are counted, how often one must be seen there, and into how many pieces a
# shuffle partition's share is cut, so that pieces that meet in a partition even out.
COUNTED, SEEN, PIECES = 0.01, 100, 8


def hot_keys(rows: DataFrame, on: str) -> dict:
    """Keys that own more than a shuffle partition's share of the rows, by a counted sample, each with the number of
    pieces to deal it in. Fewer keys than there are shuffle partitions can be that frequent.

    One job over the key column; a NULL key is never hot, as it joins nothing.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.select(on).filter(F.col(on).isNotNull()).sample(COUNTED, seed=1).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    shares = F.col("_n") * partitions / F.col("_all")
    seen = with_scalar(counts.filter(F.col("_n") >= SEEN), counts.agg(F.sum("_n").alias("_all")))
    return dict(seen.filter(shares > 1).select(on, F.ceil(shares * PIECES).cast("int")).collect())


def keep_all(heads: DataFrame, lines: DataFrame, on: str, counted: DataFrame | None = None) -> DataFrame:
    """Left join of heads to lines, safe for a key that owns most lines; reads either side once.

    A skewed right side of an outer join cannot be split at run time. So hot keys are counted first, their lines are dealt
    over salts by a hash of their columns, and their heads are copied for each salt. A copy that no line was dealt to
    goes, as another copy has some: only keys that do occur in ``lines`` are salted. ``counted`` is a frame that shows
    the same hot keys at less cost, such as the raw rows that ``lines`` are made from.
    """
    hot = hot_keys(lines if counted is None else counted, on)
    if hot:
        occurring = lines.filter(F.col(on).isin(list(hot))).select(on).distinct().collect()
        hot = {key: hot[key] for key, in occurring if hot[key] > 1}
    rest = [c for c in lines.columns if c != on]
    if not hot:
        return heads.join(lines, on, "left").select(on, *[c for c in heads.columns if c != on], *rest)
    kind = heads.schema[on].dataType
    known = T.StructType([T.StructField(on, kind), T.StructField("_salts", T.IntegerType())])
    dealt_over = F.broadcast(heads.sparkSession.createDataFrame(list(hot.items()), known))
    hashed = [f.name for f in lines.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salts = F.coalesce("_salts", F.lit(1))
    dealt = lines.join(dealt_over, on, "left").select(
        *lines.columns, F.pmod(F.xxhash64(*hashed), salts).cast("int").alias("_salt"), F.lit(True).alias("_met"))
    copied = heads.join(dealt_over, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    met = copied.join(dealt, [on, "_salt"], "left").filter(F.col("_met") | F.col("_salts").isNull())
    return met.select(on, *[c for c in heads.columns if c != on], *rest)


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of an un-grouped aggregate (exactly one row) to every row."""
    return df.crossJoin(F.broadcast(one_row))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its keys renamed, and the condition under which NULL keys match each other."""
    renamed = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    return renamed, reduce(Column.__and__, [left[k].eqNullSafe(renamed[f"_k{i}"]) for i, k in enumerate(keys)])


def null_safe_full(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of two frames with one row per key, in which NULL keys match each other."""
    marked = left.withColumn("_left", F.lit(True))
    renamed, same = _null_safe(marked, right, keys)
    joined = marked.join(renamed, same, "full")
    # A key that is NULL on the left may be a NULL key or a row of the right alone; the mark tells which.
    own = [F.when(F.col("_left"), F.col(k)).otherwise(F.col(f"_k{i}")).alias(k) for i, k in enumerate(keys)]
    rest = [c for c in (*left.columns, *right.columns) if c not in keys]
    return joined.select(*own, *rest)


def null_safe_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to one row per key, in which NULL keys match each other."""
    renamed, same = _null_safe(left, right, keys)
    return left.join(renamed, same, "left").select(*left.columns, *[c for c in right.columns if c not in keys])


def null_safe_match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which NULL keys match each other."""
    renamed = right.select([F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    condition = None
    for i, k in enumerate(keys):
        part = left[k].eqNullSafe(renamed[f"_k{i}"])
        condition = part if condition is None else condition & part
    return left.join(renamed, condition, how)


def share_of_total(df: DataFrame, measure: str, out: str = "share") -> DataFrame:
    """measure / sum(measure). The total is a one-row aggregate, not a one-task window."""
    one = df.agg(F.sum(measure).cast("double").alias("_total"))
    return with_scalar(df, one).withColumn(
        out, F.try_divide(F.col(measure).cast("double"), F.col("_total"))
    ).drop("_total")
