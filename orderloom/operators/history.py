"""Slowly changing dimensions: versions with valid_from / valid_to.

Most forms return the whole new state of the version table as a DataFrame, to be stored as the next version of a table
(``sources.tables.swap_table``); ``snapshot_parts`` stores what changed itself. Replaying a batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.clean import col
from orderloom.operators.joins import null_safe_full, null_safe_lookup
from orderloom.operators.ranking import hot_bounds, neighbour
from orderloom.sources.versions import Version, VersionedTable

VERSION_COLUMNS = ("version_id", "valid_from", "valid_to")


def version_id(keys: Sequence[str], changed_at: Column | str) -> Column:
    """md5 of the key values and the moment of change."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    stamp = F.date_format(col(changed_at), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", *parts, stamp))


def open_versions(current: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """First versions for a snapshot without history."""
    df = current.withColumn("valid_from", at)
    df = df.withColumn("version_id", version_id(keys, "valid_from"))
    return df.withColumn("valid_to", F.lit(None).cast(df.schema["valid_from"].dataType))


def _merge(
    history: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    changed: Column,
    at: Column,
    hard_deletes: bool,
    deleted_at: Column | None,
) -> DataFrame:
    """Join open versions with the snapshot; emit closed, kept and new versions in one pass.

    Both sides hold one row per key, so the full join cannot fan out on a hot key. NULL keys match
    each other. Versions that were closed before are passed through untouched.
    """
    payload = [c for c in current.columns if c not in keys]
    closed = history.filter(F.col("valid_to").isNotNull())
    old = history.filter(F.col("valid_to").isNull()).select(
        *keys, F.struct(*payload, *VERSION_COLUMNS).alias("old")
    )
    new = current.select(*keys, F.struct(*payload).alias("new"))
    pair = null_safe_full(old, new, keys)
    stamp_type = history.schema["valid_from"].dataType
    at = at.cast(stamp_type)
    gone = F.col("new").isNull()
    change = F.col("old").isNotNull() & ~gone & changed
    end = F.when(change, at)
    if hard_deletes:
        end = end.when(gone, (deleted_at if deleted_at is not None else at).cast(stamp_type))
    none = F.lit(None).cast(stamp_type)

    def version(side: str, identity: Column, start: Column, stop: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{p}").alias(p) for p in payload],
            identity.alias("version_id"), start.alias("valid_from"), stop.alias("valid_to"),
        )

    kept = F.when(
        F.col("old").isNotNull(),
        version("old", F.col("old.version_id"), F.col("old.valid_from"), F.coalesce(end, none)),
    )
    added = F.when(
        ~gone & (F.col("old").isNull() | change), version("new", version_id(keys, at), at, none)
    )
    rows = pair.select(*keys, F.explode(F.filter(F.array(kept, added), lambda v: v.isNotNull())).alias("v"))
    return closed.select(*keys, *payload, *VERSION_COLUMNS).unionByName(rows.select(*keys, "v.*"))


def _differs(cols: Sequence[str]) -> Column:
    return reduce(Column.__or__, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in cols])


def scd2_check(
    history: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    now: Column,
    hard_deletes: bool = False,
) -> DataFrame:
    """A change in any checked column closes the open version at ``now`` and opens another."""
    return _merge(history, current, keys, _differs(cols), now, hard_deletes, None)


def snapshot_parts(
    table: VersionedTable,
    current: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    part: Column,
    now: Column,
    hard_deletes: bool = False,
) -> Version:
    """Check snapshot of a large table, stored part by part (such as the months of a fact): parts in which no checked
    column changed are neither read nor written.

    Each part carries a digest of its rows' keys and checked columns: their number and the sums of two 64-bit hashes of
    each, which do not depend on order. ``part`` is a whole number from ``current``'s columns (NULL: 0). A row that moves
    to another part changes both. Without ``hard_deletes`` a part without any rows keeps its versions open.
    """
    numbered = F.coalesce(part.cast("bigint"), F.lit(0))
    state = [*keys, *[c for c in cols if c not in keys]]
    hashes = [F.sum(F.xxhash64(F.lit(seed), *state).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    digest = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *hashes)
    found = dict(current.groupBy(numbered.alias("part")).agg(digest.alias("digest")).collect())  # one row a part
    base = table.latest()
    stored = {p.id: p for p in base.parts} if base else {}
    changed = {i: d for i, d in found.items() if i not in stored or stored[i].digest != d}
    if hard_deletes:
        changed |= {i: "0" for i, p in stored.items() if i not in found and p.digest != "0"}
    if base and not changed:
        return base
    fresh = current.filter(numbered.isin(list(changed)))
    if base is None:
        versions = open_versions(fresh, keys, now)
    else:
        versions = scd2_check(table.rows_of(base, [stored[i] for i in changed if i in stored]), fresh, keys, cols, now, hard_deletes)
    return table.replace_parts(versions, numbered, changed)


def scd2_timestamp(
    history: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    updated_at: str,
    now: Column | None = None,
    hard_deletes: bool = False,
) -> DataFrame:
    """A later ``updated_at`` opens a version from that moment; late older rows are ignored."""
    newer = F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}")
    return _merge(history, current, keys, newer, F.col(f"new.{updated_at}"), hard_deletes, now)


def start_history(current: DataFrame, keys: Sequence[str], updated_at: str) -> DataFrame:
    return open_versions(current, keys, F.col(updated_at))


def scd2_rebuild(
    log: DataFrame,
    keys: Sequence[str],
    ts: str,
    cols: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """All versions from a change log: a row opens a version when it differs from the key's row before.

    A state that returns opens a version again. Rows of one moment are taken in order of ``tiebreak``, then of
    their state. ``last_seen`` is the last row that still held the version.
    """
    order = [ts, *tiebreak, *[c for c in cols if c not in tiebreak]]
    rows = log.select(*dict.fromkeys([*keys, *order]))
    bounds = hot_bounds(rows, keys, order)
    seen = neighbour(rows, keys, order, [ts, *cols], -1, "_before", bounds)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_before.{c}")) for c in cols])
    opened = seen.filter(F.col("_before").isNull() | ~same)
    # The row before the next version's first one is the last that still held this version.
    out = neighbour(opened.withColumnRenamed("_before", "_former"), keys, order, [ts, "_former"], 1, "_after", bounds)
    newest = rows.groupBy(*keys).agg(F.max(ts).alias("_newest"))
    return null_safe_lookup(out, newest, keys).select(
        *keys, *cols, F.col(ts).alias("valid_from"),
        F.when(F.col("_after").isNull(), F.col("_newest")).otherwise(F.col(f"_after._former.{ts}")).alias("last_seen"),
        F.col(f"_after.{ts}").alias("valid_to"), F.col("_after").isNull().alias("is_current"),
    )


def scd2_changes(log: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Every log row as a version, ended by the key's next row."""
    order = [ts, *tiebreak]
    out = neighbour(log, keys, order, [ts], 1, "_after", hot_bounds(log, keys, order))
    return out.select(
        *[F.col(c).alias("valid_from") if c == ts else F.col(c) for c in log.columns],
        F.col(f"_after.{ts}").alias("valid_to"), F.col("_after").isNull().alias("is_current"),
    )


def current_versions(history: DataFrame, deleted_flag: str | None = None) -> DataFrame:
    df = history.filter(F.col("valid_to").isNull())
    return df.filter(~F.coalesce(F.col(deleted_flag), F.lit(False))) if deleted_flag else df
