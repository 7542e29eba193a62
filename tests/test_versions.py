"""Versioned tables: whole versions, growing keyed parts, bookmarks that are committed with their rows."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators import history
from orderloom.sources import versions
from orderloom.sources.versions import VersionedTable
from orderloom.streaming import loads

T0 = dt.datetime(2020, 1, 1)
SCHEMA = "k bigint, v string, updated_at timestamp, created_at timestamp"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def batch_of(spark, pairs, hour):
    return spark.createDataFrame([(k, v, at(hour), at(hour)) for k, v in pairs], SCHEMA)


class Crash(Exception):
    pass


def crash(*_):
    raise Crash


def test_a_reader_keeps_its_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.latest() is None and not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(spark.range(5))
    held = table.read()
    table.replace(held.union(spark.range(3)))  # reads the table that it replaces
    table.append(spark.range(2))
    assert (held.count(), table.read().count(), table.read(2).count()) == (5, 10, 8)
    assert table.numbers() == [1, 2, 3] and table.latest().rows == 10


@pytest.mark.parametrize("step", ["write", "publish"])
@pytest.mark.parametrize("mode", ["replace", "append", "merge", "replace_parts"])
def test_a_write_cut_short_changes_nothing(spark, tmp_path, monkeypatch, step, mode):
    table = VersionedTable(spark, str(tmp_path / "t"))
    old, new = batch_of(spark, [(i, "old") for i in range(30)], 0), batch_of(spark, [(i, "new") for i in range(25, 35)], 1)
    if mode == "replace_parts":
        table.replace(old)
    else:
        table.merge(old, ["k"], ["updated_at"], part_rows=8)

    def write():
        if mode == "merge":
            table.merge(new, ["k"], ["updated_at"], part_rows=8)
        elif mode == "replace_parts":
            table.replace_parts(new, F.lit(7), {7: "d"})
        else:
            getattr(table, mode)(new)

    before = rows(table.read())
    with monkeypatch.context() as patched:
        if step == "publish":  # all data files are there, the manifest is not
            patched.setattr(versions, "publish", crash)
        else:  # some data files are there
            for name in ("_count", "_write_parts"):
                plain = getattr(VersionedTable, name)
                patched.setattr(VersionedTable, name, lambda self, *a, plain=plain: (plain(self, *a), crash()))
        with pytest.raises(Crash):
            write()
    assert rows(table.read()) == before and table.numbers() == [1]
    write()
    after = {"merge": 35, "replace": 10, "append": 40, "replace_parts": 40}[mode]
    assert table.read().count() == after == table.latest().rows


def test_half_a_manifest_is_no_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(4))
    (tmp_path / "t" / "_versions" / ".a0b1").write_text('{"number": 2, "sch')  # what a writer that died leaves
    assert table.read().count() == 4
    assert table.append(spark.range(1)).number == 2


def test_two_writers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, other = VersionedTable(spark, path), VersionedTable(spark, path)
    one.merge(batch_of(spark, [(1, "a")], 0), ["k"])
    plain = VersionedTable._write_parts
    came = []

    def meanwhile(self, *args):
        written = plain(self, *args)
        if not came:
            came.append(1)
            other.append(batch_of(spark, [(9, "other")], 5))
        return written

    monkeypatch.setattr(VersionedTable, "_write_parts", meanwhile)
    with pytest.raises(versions.ConcurrentWrite):  # its rows come from a version that is not the newest any more
        one.merge(batch_of(spark, [(1, "b")], 1), ["k"], ["updated_at"])
    assert rows(one.read(), "k", "v") == [(1, "a"), (9, "other")]
    one.merge(batch_of(spark, [(1, "b")], 1), ["k"], ["updated_at"])
    assert rows(one.read(), "k", "v") == [(1, "b"), (9, "other")]
    monkeypatch.undo()
    # Appends go on top of each other.
    count = VersionedTable._count

    def appended(self, *args):
        if len(came) == 1:
            came.append(2)
            other.append(batch_of(spark, [(10, "x")], 5))
        return count(self, *args)

    monkeypatch.setattr(VersionedTable, "_count", appended)
    one.append(batch_of(spark, [(11, "y")], 5))
    assert rows(one.read(), "k") == [(1,), (9,), (10,), (11,)]


def test_the_number_is_taken_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    version = table.replace(spark.range(3))
    assert versions.publish(table, version) is False
    assert [f.name for f in (tmp_path / "t" / "_versions").iterdir() if f.suffix != ".crc"] == [f"{1:020d}.json"]


def test_parts_grow_with_the_table(spark, tmp_path):
    """Random batches against a dict: same rows, parts within bounds, at most one part rewritten for each key."""
    table, state, rng = VersionedTable(spark, str(tmp_path / "t")), {}, random.Random(4)
    for hour, (size, span) in enumerate([(3, 10), (400, 500), (50, 5_000), (1, 5_000), (600, 5_000), (0, 1), (4, 5_000)]):
        batch = [(rng.choice([None, *range(span)]) if rng.random() < 0.05 else rng.randrange(span), f"{hour}-{i}") for i in range(size)]
        before = {p for p in (table.latest().parts if hour else ())}
        table.merge(batch_of(spark, batch, hour).repartition(3), ["k"], ["updated_at", "v"], part_rows=32)
        for k, v in sorted(batch, key=lambda b: b[1]):
            state[k] = (v, state.get(k, (0, at(hour)))[1])
        now = table.latest()
        assert rows(table.read(), "k", "v", "created_at") == sorted(
            ((k, *v) for k, v in state.items()), key=lambda t: (t[0] is not None, t[0]))
        assert len(before - set(now.parts)) <= len({k for k, _ in batch})
        assert all(p.rows <= 64 for p in now.parts) and now.rows == len(state)
        # The directory: every hash has one part.
        assert sum(2.0 ** -(p.id.bit_length() - 1) for p in now.parts) == 1
    assert len(now.parts) > 30 and len({p.id.bit_length() for p in now.parts}) > 1


def test_older_rows_and_types(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.merge(batch_of(spark, [(1, "a"), (2, "a")], 5), ["k"], newer="updated_at", part_rows=1)
    late = batch_of(spark, [(1, "late"), (3, "c")], 1).withColumn("k", F.col("k").cast("int")).drop("created_at")
    table.merge(late, ["k"], newer="updated_at", part_rows=1)  # an int key has another hash than a long one
    assert rows(table.read(), "k", "v", "created_at") == [(1, "a", at(5)), (2, "a", at(5)), (3, "c", None)]
    with pytest.raises(ValueError):
        table.merge(late, ["other"])
    with pytest.raises(ValueError):
        table.append(spark.range(1))


def test_other_keys_and_plain_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    batch_of(spark, [(i, f"v{i % 7}") for i in range(50)], 0).write.parquet(path)
    table = VersionedTable(spark, path)
    assert table.latest().number == 0 and table.read().count() == 50
    table.merge(batch_of(spark, [(3, "n"), (99, "n")], 1), ["k"], part_rows=8)
    assert table.read().count() == 51 == table.latest().rows and len(table.latest().parts) >= 6
    table.append(batch_of(spark, [(3, "again")], 2))
    assert table.read().filter("k = 3").count() == 2
    table.merge(batch_of(spark, [(0, "v1")], 3), ["v"], part_rows=8)  # every row of that value takes the batch's values
    assert rows(table.read().filter("v = 'v1'"), "k") == [(0,)] * 7 and table.latest().keys == ("v",)
    assert table.read().count() == 52


def test_expired_versions_go(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.merge(batch_of(spark, [(i, "a") for i in range(40)], 0), ["k"], part_rows=8)
    for n in range(3):
        table.merge(batch_of(spark, [(n, "b")], 1), ["k"], part_rows=8)
    table._write(spark.range(3))  # a write that died
    assert table.expire(older_than=3600) == [] and len(list((tmp_path / "t" / "_data").iterdir())) == 5
    assert table.expire(older_than=-60) == [1, 2, 3]
    assert table.numbers() == [4] and rows(table.read().filter("v = 'b'"), "k") == [(0,), (1,), (2,)]
    assert table.read().count() == 40 and len(list((tmp_path / "t" / "_data").iterdir())) <= 4
    assert table.expire(older_than=-60) == []


# Bookmarks

@pytest.mark.parametrize("moment", ["before", "after"])
def test_a_crash_between_load_and_bookmark(spark, tmp_path, monkeypatch, moment):
    target = str(tmp_path / "t")
    first, second = batch_of(spark, [(1, "a"), (2, "a")], 0), batch_of(spark, [(2, "b"), (3, "b")], 1)
    assert loads.load_increment(first, target, ["k"]).marks == {"bookmark": at(0)}
    plain = versions.publish
    monkeypatch.setattr(versions, "publish", (lambda *_: crash()) if moment == "before" else (lambda *a: (plain(*a), crash())))
    with pytest.raises(Crash):
        loads.load_increment(first.union(second), target, ["k"])
    monkeypatch.undo()
    table = VersionedTable(spark, target)
    assert table.mark("bookmark") == at(0 if moment == "before" else 1)
    assert rows(table.read(), "k", "v") == ([(1, "a"), (2, "a")] if moment == "before" else [(1, "a"), (2, "b"), (3, "b")])
    loads.load_increment(first.union(second), target, ["k"])
    assert rows(table.read(), "k", "v", "created_at") == [(1, "a", at(0)), (2, "b", at(0)), (3, "b", at(1))]
    number = table.latest().number
    assert loads.load_increment(first.union(second), target, ["k"]).number == number  # nothing is newer


def test_marks_keep_their_types(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    marks = {"a": at(1), "b": T0.date(), "c": 5, "d": "x", "e": None}
    table.replace(spark.range(1), marks=marks)
    table.append(spark.range(1), marks={"c": 6})
    assert {n: table.mark(n) for n in marks} == {**marks, "c": 6} and table.mark("other") is None


# Snapshots by part

def test_snapshot_writes_changed_parts_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    schema = "id bigint, month bigint, price double, note string"
    first = [(i, i % 5, float(i), "n") for i in range(40)]
    # one month changes; a row of another moves to the month after it; notes are not checked
    second = [(i, m, p + 1 if m == 1 else p, "other") for i, m, p, _ in first if i != 12] + [(12, 3, 12.0, "n"), (77, 9, 1.0, "n")]

    def take(data, moment, **more):
        return history.snapshot_parts(table, spark.createDataFrame(data, schema), ["id"], ["month", "price"], F.col("month"), F.lit(moment), **more)

    assert take(first, T0).rows == 40
    before = {p.id: p for p in table.latest().parts}
    take(second, at(1))
    after = {p.id: p for p in table.latest().parts}
    assert {i for i in after if after[i] != before.get(i)} == {1, 2, 3, 9}
    out = table.read()
    assert out.filter("valid_to is null").count() == 41
    assert rows(out.filter("id = 12"), "month", "valid_to") == [(2, at(1)), (3, None)]
    assert rows(out.filter("id = 6"), "price", "valid_from", "valid_to") == [(6.0, T0, at(1)), (7.0, at(1), None)]
    number = table.latest().number
    assert take(second, at(2)).number == number  # nothing changed, nothing written
    gone = [r for r in second if r[1] != 4]
    assert take(gone, at(3)).number == number  # rows that are gone stay open
    take(gone, at(3), hard_deletes=True)
    assert table.read().filter("valid_to is null").count() == 33 and table.read().filter("month = 4 and valid_to is null").count() == 0


def test_small_parts_share_files(spark, tmp_path, monkeypatch):
    """Files grow with the rows, not with the parts; rows that a rewritten part left behind in a shared file are not read."""
    monkeypatch.setattr(versions, "FILE_ROWS", 500)
    table = VersionedTable(spark, str(tmp_path / "t"))
    first = table.merge(batch_of(spark, [(i, "old") for i in range(2_000)], 0), ["k"], part_rows=10)
    assert len(first.parts) == 256 and len(list((tmp_path / "t").glob("_data/*/*/*.parquet"))) == 4
    second = table.merge(batch_of(spark, [(5, "new"), (2_000, "new")], 1), ["k"], part_rows=10)
    assert len(set(first.parts) - set(second.parts)) <= 2 and second.rows == 2_001 == table.read().count()
    assert len(list((tmp_path / "t").glob("_data/*/*/*.parquet"))) == 5
    table.merge(batch_of(spark, [(i, "all") for i in range(0, 2_000, 2)], 2), ["k"], part_rows=2)  # cuts parts
    state = {**{i: "old" for i in range(2_000)}, 5: "new", 2_000: "new", **{i: "all" for i in range(0, 2_000, 2)}}
    assert rows(table.read(), "k", "v") == sorted(state.items())
    assert rows(table.read(1), "v") == [("old",)] * 2_000 and table.read(2).filter("v = 'new'").count() == 2
    one = second.parts[7]  # a part by itself, out of a file of many
    assert table.rows_of(second, [one]).count() == one.rows < 30
