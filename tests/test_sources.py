import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.sources import files, tables, versions
from orderloom.streaming import loads

T0, T1, T2 = (dt.datetime(2020, 1, d) for d in (1, 2, 3))


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_csv_with_mark_quotes_and_newlines(spark, tmp_path):
    p = write(tmp_path / "a.csv", '﻿id,note\n1,"two\nlines"\n2,"say ""hi"""\n')
    df = files.load_csv_auto(spark, p, multiline=True)
    assert df.columns == ["id", "note"] and df.schema["id"].dataType.simpleString() == "bigint"
    assert rows(df) == [(1, "two\nlines"), (2, 'say "hi"')]
    assert files.csv_records(spark, p) == 2


def test_all_text_files_keep_their_names(spark, tmp_path):
    p = write(tmp_path / "t.csv", "﻿name,english\nsofa,couch\n")
    assert files.is_all_text(files.load_csv(spark, p))
    assert rows(files.load_csv_auto(spark, p), "english") == [("couch",)]


def test_flatten_once_goes_one_level(spark):
    df = spark.sql("select 1 as id, named_struct('a', 2, 'b', named_struct('c', 3)) as s")
    assert files.flatten_once(df).columns == ["id", "s__a", "s__b"]


def test_table_names(spark):
    names = ["/x/My File (1).csv", "2017 sales.JSON", "___.csv", "a__b.tar.gz"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", files.table_name(F.col("n")))
    assert dict(tuple(r) for r in df.collect()) == {
        names[0]: "my_file_1", names[1]: "t_2017_sales", names[2]: "uploaded_table", names[3]: "a_b_tar"}


OLD = [(1, "a", T0, T0), (2, "b", T0, T0)]
SCHEMA = "k int, v string, updated_at timestamp, created_at timestamp"


def test_upsert_lets_new_nulls_win_and_keeps_created_at(spark):
    current = spark.createDataFrame(OLD, SCHEMA)
    batch = spark.createDataFrame([(2, "x", T1, T1), (2, None, T2, T2), (3, "c", T1, T1)], SCHEMA)
    out = tables.upsert(current, batch, ["k"], ["updated_at"])
    assert rows(out) == [(1, "a", T0, T0), (2, None, T2, T0), (3, "c", T1, T1)]
    assert rows(tables.upsert(out, batch, ["k"], ["updated_at"])) == rows(out)


def test_upsert_without_a_column_keeps_the_old_value(spark):
    current = spark.createDataFrame(OLD, SCHEMA)
    batch = spark.createDataFrame([(1, T2)], "k int, updated_at timestamp")
    assert rows(tables.upsert(current, batch, ["k"]))[0] == (1, "a", T2, T0)


def test_upsert_needs_its_keys(spark):
    current = spark.createDataFrame(OLD, SCHEMA)
    with pytest.raises(ValueError):
        tables.upsert(current, current.drop("k"), ["k"])


def test_write_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame(OLD, SCHEMA)
    tables.write_table(df, path, "upsert", ["k"], ["updated_at"])
    tables.write_table(df.withColumn("v", F.lit("n")), path, "upsert", ["k"], ["updated_at"])
    assert rows(tables.read_table(spark, path), "k", "v") == [(1, "n"), (2, "n")]
    tables.write_table(df, path, "append")
    assert tables.read_table(spark, path).count() == 4
    tables.write_table(df, path, "upsert")
    assert tables.read_table(spark, path).count() == 6
    tables.write_table(tables.read_table(spark, path).limit(1), path, "replace")
    assert tables.read_table(spark, path).count() == 1
    with pytest.raises(Exception, match="exists"):
        tables.write_table(df, path, "fail")
    with pytest.raises(ValueError):
        tables.write_table(df, path, "other")


def test_replay_of_an_upsert_with_a_null_key(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([(None, "a", T1, T0), (1, "b", T1, T0), (None, "c", T2, T0)], SCHEMA)
    for _ in range(2):
        tables.write_table(df, path, "upsert", ["k"], ["updated_at"])
        assert rows(tables.read_table(spark, path), "k", "v") == [(None, "c"), (1, "b")]


@pytest.mark.parametrize("step", ["read", "upsert", "append", "replace", "fail", "cached"])
def test_a_cut_short_swap_loses_nothing(spark, tmp_path, step):
    path, df = str(tmp_path / "t"), spark.range(100).selectExpr("cast(id as int) as k", "'old' as v")
    df.write.parquet(path + "__old")  # what a crash between the two renames leaves behind
    df.limit(1).write.parquet(path + "__new")
    new = spark.range(99, 102).selectExpr("cast(id as int) as k", "'new' as v")
    if step == "upsert":
        for _ in range(2):
            tables.write_table(new, path, "upsert", ["k"])
        assert tables.read_table(spark, path).groupBy("v").count().orderBy("v").collect() == [("new", 3), ("old", 99)]
    elif step == "append":
        tables.write_table(new, path, "append")
        assert tables.read_table(spark, path).count() == 103
    elif step == "replace":
        tables.write_table(tables.read_table(spark, path).union(new), path)
        assert tables.read_table(spark, path).count() == 103
    elif step == "fail":
        with pytest.raises(Exception, match="exists"):
            tables.write_table(new, path, "fail")
    elif step == "cached":
        assert tables.cached_result(spark, path, lambda: new).count() == 100
    else:
        assert tables.read_table(spark, path).count() == 100
    assert not tables.exists(spark, path + "__old")


def test_a_refused_manifest_raises(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    monkeypatch.setattr(versions, "publish", lambda *_: False)
    with pytest.raises(versions.ConcurrentWrite):
        tables.write_table(spark.range(9), path)
    monkeypatch.undo()
    assert tables.read_table(spark, path).count() == 5


def test_a_cut_short_layer_run_keeps_the_history(spark, tmp_path):
    history = str(tmp_path / "snapshots" / "products")
    spark.range(374).write.parquet(history + "__old")
    assert tables.exists(spark, history) and tables.read_table(spark, history).count() == 374


def test_reconcile_and_audit_columns(spark):
    a, b = spark.range(3).toDF("x"), spark.range(5).toDF("x")
    out = tables.reconcile({"same": a, "more": a, "less": b, "none": a}, {"same": a, "more": b, "less": a})
    assert rows(out, "table_name", "status") == [("less", "SHORT"), ("more", "appended"), ("none", "MISSING"), ("same", "exact")]
    row = tables.audit_columns(a, dt.datetime(2024, 1, 1), "b1", "f.csv", "Asia/Singapore").first()
    assert row["created_at"] == dt.datetime(2024, 1, 1, 8) and row["is_deleted"] is False


def test_cached_result_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(2)

    for force in (False, False, True):
        assert tables.cached_result(spark, str(tmp_path / "c"), build, 3600, force).count() == 2
    assert len(calls) == 2


def test_increment_and_bookmark(spark):
    df = spark.createDataFrame(OLD + [(3, "c", T2, T2)], SCHEMA)
    assert loads.increment(df, None).count() == 3
    assert rows(loads.increment(df, T0), "k") == [(3,)]
    assert loads.next_bookmark(df) == T2 and loads.next_bookmark(df.limit(0)) is None


def test_stream_upsert_survives_replays_and_late_rows(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "t")
    schema = spark.createDataFrame(OLD, SCHEMA).schema

    def load(data, checkpoint):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        loads.stream_upsert(spark, source, schema, target, ["k"], "updated_at", str(tmp_path / checkpoint)).awaitTermination()
        return rows(tables.read_table(spark, target), "k", "v")

    assert load([(1, "a", T1, T1), (1, "b", T2, T2), (2, "x", T1, T1)], "s") == [(1, "b"), (2, "x")]
    assert load([(1, "late", T0, T0), (2, "y", T2, T2), (3, "z", T0, T0)], "s") == [(1, "b"), (2, "y"), (3, "z")]
    # a lost checkpoint reads every file again
    assert load([(3, "z2", T1, T1)], "fresh") == [(1, "b"), (2, "y"), (3, "z2")]


def test_stream_upsert_leaves_other_parts_alone(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "t")
    schema = spark.createDataFrame(OLD, SCHEMA).schema

    def load(data):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        loads.stream_upsert(spark, source, schema, target, ["k"], "updated_at", str(tmp_path / "s"), part_rows=20).awaitTermination()
        return {f for p in versions.VersionedTable(spark, target).latest().parts for f in p.folders}

    before = load([(i, "a", T1, T1) for i in range(200)])
    after = load([(3, "b", T2, T2), (None, "n", T1, T1)])
    assert len(before) >= 10 and len(before - after) <= 2 and len(before & after) >= 10
    assert rows(loads.read_upserted(spark, target).filter("v != 'a'"), "k", "v") == [(None, "n"), (3, "b")]
    assert loads.read_upserted(spark, target).count() == 201


def test_stream_append_takes_each_file_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame(OLD, SCHEMA)
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(source)
        loads.stream_append(spark, source, df.schema, target, str(tmp_path / "s")).awaitTermination()
    assert spark.read.parquet(target).count() == 4
