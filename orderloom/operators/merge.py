"""Keyed merge of a batch into a table state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderloom.operators.dedup import latest_per_key
from orderloom.operators.joins import null_safe_full


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    preserve: Sequence[str] = ("created_at",),
    newer: str | None = None,
    reduced: bool = False,
) -> DataFrame:
    """New table state after a keyed merge; NULL keys match each other.

    The batch is reduced to its newest row per key first, unless it is ``reduced`` already. Matched rows take every
    batch value, NULLs included, except the ``preserve`` columns; other rows pass through. Columns the batch lacks
    keep their old value. With ``newer`` a matched row stays as it is if it has a greater value in that column.
    """
    missing = [k for k in keys if k not in batch.columns or k not in current.columns]
    if missing or not keys:
        raise ValueError(f"upsert keys not in both frames: {missing or 'none given'}")
    batch = batch if reduced else latest_per_key(batch, keys, order_by)
    rest = [c for c in current.columns if c not in keys]
    shared = [c for c in rest if c in batch.columns]
    new = batch.select(*keys, F.struct(F.lit(True).alias("_in"), *shared).alias("_new"))
    old = current.select(*keys, F.struct(F.lit(True).alias("_in"), *rest).alias("_old"))
    both = null_safe_full(old, new, keys)
    from_batch = F.col("_new").isNotNull()
    known = F.col("_old").isNotNull()
    if newer is not None:
        seen, came = F.col(f"_old.{newer}"), F.col(f"_new.{newer}")
        from_batch = from_batch & (~known | seen.isNull() | (came >= seen))

    def pick(c: str):
        if c not in shared:
            return F.col(f"_old.{c}")
        if c in preserve:
            return F.when(known, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}"))
        return F.when(from_batch, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}"))

    return both.select(*[F.col(c) if c in keys else pick(c).alias(c) for c in current.columns])
