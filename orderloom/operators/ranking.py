"""Order-dependent operators that never put a whole table, or one hot group, in one task.

* ``global_rank``/``running_total`` range-partition the rows, number them inside each partition
  and add the sizes of the partitions before it. What is broadcast is one row per partition.
* ``sequence_in_group``/``neighbour`` look for hot groups in one job over a counted sample, cut those into slices at bounds
  taken from their rows, use windows per slice and carry one row of each slice along. Without hot groups they are plain windows.
* ``group_quantiles`` counts values, range-partitions the counts by group and value and picks the places asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.operators.joins import SEEN, null_safe_lookup, with_scalar
from orderloom.session import cut_lineage

# One row of so many is counted to find hot groups (how often one must be seen: ``joins.SEEN``). A hot group is cut into so many
# slices for each shuffle partition's share it owns, and each bound is picked from so many of its rows.
ONE_OF, SLICES, PICKED_FROM = 100, 2, 16


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with the partition and place of each row."""
    place = F.monotonically_increasing_id()
    return cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_place", place - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    )


def _before(sizes: DataFrame, size: str, out: str) -> DataFrame:
    """Sum of the sizes of earlier partitions; one row per partition, so one task is enough."""
    window = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_pid", F.coalesce(F.sum(size).over(window), F.lit(0)).alias(out))


def global_rank(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """1-based position of every row under a total order."""
    ranged = _ranged(df, order)
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    starts = F.broadcast(_before(sizes, "_n", "_start"))
    return (
        ranged.join(starts, "_pid")
        .withColumn(out, F.col("_start") + F.col("_place") + 1)
        .drop("_pid", "_place", "_start")
    )


def running_total(df: DataFrame, order: Sequence[Column], measure: str, out: str = "running") -> DataFrame:
    """Cumulative sum over a total order of the whole frame."""
    return running_totals(df, order, {out: measure})


def running_totals(df: DataFrame, order: Sequence[Column], measures: dict[str, str]) -> DataFrame:
    """Cumulative sums over a total order: ``{new column: measure}``."""
    ranged = _ranged(df, order)
    sizes = ranged.groupBy("_pid").agg(*[F.sum(m).alias(f"_sum_{o}") for o, m in measures.items()])
    window = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("_pid", *[F.coalesce(F.sum(f"_sum_{o}").over(window), F.lit(0)).alias(f"_start_{o}") for o in measures])
    inside = Window.partitionBy("_pid").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumns({f"_inside_{o}": F.sum(m).over(inside) for o, m in measures.items()})
        .join(F.broadcast(starts), "_pid")
        .select(*df.columns, *[(F.col(f"_start_{o}") + F.col(f"_inside_{o}")).alias(o) for o in measures])
    )


def hot_bounds(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    """Bounds (``_bounds``: rising ``order`` structs) of the slices of hot groups, None if there is no hot group.

    Rows are counted and picked by their hash. Fewer groups than there are shuffle partitions can own more than a partition's
    share, and they share ``SLICES`` bounds for each partition; so many are held on the driver. The bounds of a frame also
    serve frames that have much the same rows.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*order).alias("_place")
    counted = df.select(*keys, place, F.xxhash64(*keys, *order).alias("_hash")).filter(F.pmod("_hash", F.lit(ONE_OF)) == 0)
    counts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    of_all = F.col("_n") * partitions / F.col("_all")
    found = with_scalar(counts.filter(F.col("_n") >= SEEN), counts.agg(F.sum("_n").alias("_all"))).filter(of_all > 1).select(
        *keys, "_n", F.ceil(of_all * SLICES).alias("_slices"))
    rows = found.collect()
    if not rows:
        return None
    hot = spark.createDataFrame(rows, found.schema)
    met = null_safe_lookup(counted, F.broadcast(hot), keys).filter(F.col("_n").isNotNull())
    picked = met.filter(F.pmod(F.xxhash64("_hash"), F.col("_n")) < F.col("_slices") * PICKED_FROM)
    places = F.sort_array(F.collect_set("_place"))
    bounds = picked.groupBy(*keys).agg(F.filter(places, lambda _, i: i % PICKED_FROM == PICKED_FROM - 1).alias("_bounds"))
    return spark.createDataFrame(bounds.collect(), bounds.schema)


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` with the slice of each row (0 in groups that are not hot), and the rows of hot groups alone."""
    place = F.struct(*order)
    met = null_safe_lookup(df, F.broadcast(bounds), keys)
    cut = F.size(F.filter("_bounds", lambda bound: bound <= place))
    sliced = met.withColumn("_slice", F.when(F.col("_bounds").isNull(), 0).otherwise(cut))
    return sliced.drop("_bounds"), sliced.filter(F.col("_bounds").isNotNull()).drop("_bounds")


def sequence_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "seq") -> DataFrame:
    """1-based position of each row inside its group, ascending by the columns ``order``, NULLs first.

    Rows are numbered inside (group, slice); the sizes of the slices before it are added. So the rows of a hot group are
    spread whatever they look like, as long as they differ in ``order``.
    """
    bounds = hot_bounds(df, keys, order)
    if bounds is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    sliced, hot = _sliced(df, keys, order, bounds)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hot.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(*keys, "_slice", F.sum("_n").over(earlier).alias("_start"))  # one row a slice
    placed = null_safe_lookup(sliced.withColumn("_at", F.row_number().over(inside)), F.broadcast(starts), [*keys, "_slice"])
    return placed.withColumn(out, (F.coalesce("_start", F.lit(0)) + F.col("_at")).cast("int")).select(*df.columns, out)


def neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], step: int, out: str, bounds: DataFrame | None
) -> DataFrame:
    """Adds a struct of ``values`` of the row before (``step`` -1) or after (1) in the group, NULL where there is none.

    Ascending by the columns ``order``, NULLs first. ``bounds`` are those of ``hot_bounds``: the row at the edge of a slice takes
    the nearest edge row of the group's other slices, so no task sees a whole hot group.
    """
    shift = F.lag if step < 0 else F.lead
    if bounds is None:
        return df.withColumn(out, shift(F.struct(*values)).over(Window.partitionBy(*keys).orderBy(*order)))
    sliced, hot = _sliced(df, keys, order, bounds)
    near = shift(F.struct(*values)).over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    edge = (F.max if step < 0 else F.min)(F.struct(F.struct(*order).alias("o"), F.struct(*values).alias("v")))
    slices = hot.groupBy(*keys, "_slice").agg(edge.alias("_edge"))
    along = Window.partitionBy(*keys).orderBy("_slice")
    carried = slices.select(*keys, "_slice", shift("_edge.v").over(along).alias("_carried"))
    met = null_safe_lookup(sliced.withColumn(out, near), F.broadcast(carried), [*keys, "_slice"])
    return met.withColumn(out, F.coalesce(out, "_carried")).select(*df.columns, out)


def first_with_ties(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of each group that come first under ``order``, all of them when several tie."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.rank().over(window)).filter("_rank = 1").drop("_rank")


def quantile_bucket(
    df: DataFrame,
    column: str,
    q: int,
    out: str,
    ties: str = "first",
    tiebreak: Sequence[str] = (),
    reverse: bool = False,
) -> DataFrame:
    """Bucket 1..q of equal size, NULL measures left out of the ranking and given NULL.

    ``ties="first"`` splits equal values by ``tiebreak``; ``ties="share"`` keeps them together
    and cuts at interpolated quantiles. ``reverse`` numbers the buckets downwards.
    """
    if ties == "first":
        # Only the ordering values are ranked; the last value of each bucket then tells a row's bucket.
        place = F.struct(column, *tiebreak)
        ranked = global_rank(df.filter(F.col(column).isNotNull()).select(column, *tiebreak), [F.col(c).asc() for c in (column, *tiebreak)], "_rank")
        step, span = (F.col("_rank") - 1) * q, F.greatest(F.col("_n") - 1, F.lit(1))
        held = F.greatest(F.floor((step + span - 1) / span), F.lit(1))
        edges = ranked.crossJoin(F.broadcast(ranked.agg(F.count(F.lit(1)).alias("_n")))).agg(
            *[F.max(F.when(held <= k, place)).alias(f"_e{k}") for k in range(1, q)])
        over = [F.coalesce((place > F.col(f"_e{k}")).cast("int"), F.lit(0)) for k in range(1, q)]
        bucketed = df.crossJoin(F.broadcast(edges)).withColumn(
            out, F.when(F.col(column).isNotNull(), reduce(Column.__add__, over, F.lit(1)))
        ).drop(*[f"_e{k}" for k in range(1, q)])
    elif ties == "share":
        edges = exact_quantiles(df, column, [k / q for k in range(1, q)], [f"_e{k}" for k in range(1, q)])
        bucket = F.lit(q)
        for k in range(q - 1, 0, -1):
            bucket = F.when(F.col(column) <= F.col(f"_e{k}"), F.lit(k)).otherwise(bucket)
        bucketed = df.crossJoin(F.broadcast(edges)).withColumn(
            out, F.when(F.col(column).isNotNull(), bucket)
        ).drop(*[f"_e{k}" for k in range(1, q)])
    else:
        raise ValueError(f"ties must be first or share, not {ties!r}")
    return bucketed.withColumn(out, F.lit(q + 1) - F.col(out)) if reverse else bucketed


def exact_quantiles(
    df: DataFrame, column: str, probs: Sequence[float], names: Sequence[str] | None = None
) -> DataFrame:
    """One row with exact linearly interpolated quantiles."""
    return group_quantiles(df, [], column, probs, names)


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """column_name, p25, ...: quantiles of many columns from one frequency table; NULL for a column without values."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]))
    found = group_quantiles(df.select(values.alias("_c")).select("_c.*"), ["column_name"], "value", probs)
    named = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return named.join(F.broadcast(found), "column_name", "left")  # one row a column


def group_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, probs: Sequence[float], names: Sequence[str] | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles of each group, NULLs left out; without keys one row for all rows.

    Values are counted first, so ties cost one row. The counts are range-partitioned by group and value and accumulated along
    each group, with one row carried for each partition a group reaches into, and only the rows that hold a wanted position
    are kept. So no task or buffer holds all values of a group.
    """
    names = list(names or [f"p{round(p * 100)}" for p in probs])
    freq = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    ranged = _ranged(freq, [*[F.col(k).asc() for k in keys], F.col("_v").asc()])
    whole, inside = Window.partitionBy(*keys), Window.partitionBy("_pid", *keys).orderBy("_place")
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_pid", *keys).agg(F.sum("_c").alias("_s")).select(
        "_pid", *keys, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"), F.sum("_s").over(whole).alias("_n"))
    spots = null_safe_lookup(ranged.withColumn("_in", F.sum("_c").over(inside)), starts, ["_pid", *keys])
    upto = F.col("_start") + F.col("_in")
    holds = []
    for p in probs:
        spot = (F.col("_n") - 1) * F.lit(float(p))
        at = lambda i: (upto - F.col("_c") <= i) & (i < upto)
        holds.append((spot, at(F.floor(spot)), at(F.ceil(spot))))
    any_spot = reduce(Column.__or__, [at for _, *both in holds for at in both])
    out = []
    for name, (spot, at_lo, at_hi) in zip(names, holds):
        lo_value = F.max(F.when(at_lo, F.col("_v")))
        hi_value = F.max(F.when(at_hi, F.col("_v")))
        part = F.max(spot - F.floor(spot))
        out.append((lo_value + (hi_value - lo_value) * part).alias(name))
    return spots.filter(any_spot).groupBy(*keys).agg(*out)
