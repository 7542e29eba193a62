import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from orderloom.operators import aggregates as agg, dedup, history, impute, joins, quality, ranking

T0, T1, T2, T3 = (dt.datetime(2020, 1, d) for d in (1, 2, 3, 4))


def skewed(spark, n=3000):
    """One key (and the NULL key) hold most rows; many rows share a moment."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 37 % 101).alias("t"), F.col("id"),
    )


def test_latest_per_key_settles_ties_by_all_columns(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "c"), (2, None, "z")], "k int, t int, v string")
    assert rows(dedup.latest_per_key(df, ["k"], ["t"])) == [(1, 5, "a"), (2, None, "z")]


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    df = dedup.latest_per_key(skewed(spark), ["k"], ["t"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_duplicate_audit(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert rows(dedup.duplicate_audit(df, "t", ["a", "b"])) == [("t", "a, b", 3, 2, 1)]


def test_global_rank_and_running_total(spark):
    df = skewed(spark)
    ranked = ranking.global_rank(df, [F.col("t").asc(), F.col("id").desc()], "r").toPandas()
    ranked = ranked.sort_values(["t", "id"], ascending=[True, False])
    assert ranked["r"].tolist() == list(range(1, 3001))
    total = ranking.running_total(df, [F.col("id").asc()], "t", "s").toPandas().sort_values("id")
    assert total["s"].tolist() == total["t"].cumsum().tolist()


@pytest.fixture
def hot(spark, request, monkeypatch):
    """Whether groups count as hot easily."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    if request.param:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        for name, value in (("SEEN", 3), ("ONE_OF", 4), ("PICKED_FROM", 2)):
            monkeypatch.setattr(ranking, name, value)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


@pytest.mark.parametrize("hot", [False, True], indirect=True)
@pytest.mark.parametrize("first", ["t", "moment", "day", "word", "far"])
def test_slices_give_the_same_sequence_and_neighbours(spark, first, hot):
    df = skewed(spark).withColumns({
        "moment": F.timestamp_seconds(F.col("t") * 40_000), "day": F.date_add(F.lit(T0).cast("date"), (F.col("t") * 3).cast("int")),
        "word": F.concat(F.lit("w"), F.lpad(F.col("t").cast("string"), 9, "0")), "far": F.when(F.col("t") > 3, F.col("t") * 10**6),
    })
    order = [first, "id"]
    bounds = ranking.hot_bounds(df, ["k"], order)
    assert (bounds is None) != hot and (not hot or {r.k for r in bounds.collect()} >= {0, None})
    window = Window.partitionBy("k").orderBy(*order)
    want = df.select("k", "id", F.row_number().over(window).alias("seq"), F.lag("id").over(window).alias("b"), F.lead("id").over(window).alias("a"))
    got = ranking.sequence_in_group(df, ["k"], order, "seq")
    got = ranking.neighbour(ranking.neighbour(got, ["k"], order, ["id"], -1, "b", bounds), ["k"], order, ["id"], 1, "a", bounds)
    assert rows(got.select("k", "id", "seq", F.col("b.id").alias("b"), F.col("a.id").alias("a")), "id", "k", "seq", "b", "a") == rows(want, "id", "k", "seq", "b", "a")


@pytest.mark.parametrize("first", ["one day", "one start"])
def test_a_hot_group_of_any_shape_is_spread(spark, first):
    """200,000 rows of one key within one second, or texts with one common start, fall into even slices."""
    n = F.col("id")
    place = F.timestamp_micros(n + 10**15) if first == "one day" else F.concat(F.lit("a common start "), F.lpad(n.cast("string"), 7, "0"))
    df = spark.range(200_000).select(F.lit(1).alias("k"), place.alias("o"), n)
    sliced, hot = ranking._sliced(df, ["k"], ["o"], ranking.hot_bounds(df, ["k"], ["o"]))
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) >= 7 and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2] and hot.count() == 200_000
    placed = ranking.sequence_in_group(df, ["k"], ["o"])
    assert placed.agg(F.min("seq"), F.max("seq"), F.count_distinct("seq"), F.max(F.col("seq") - n)).first() == (
        1, 200_000, 200_000, 1)


@pytest.mark.parametrize("n,q", [(7, 4), (10, 5), (101, 5), (64, 4)])
def test_buckets_equal_quantile_cuts(spark, n, q):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"id": range(n), "v": rng.integers(0, 4, n).astype(float), "w": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    first = ranking.quantile_bucket(df, "v", q, "b", tiebreak=["id"]).toPandas().sort_values("id")
    assert first["b"].tolist() == (pd.qcut(pdf["v"].rank(method="first"), q, labels=False) + 1).tolist()
    share = ranking.quantile_bucket(df, "w", q, "b", ties="share", reverse=True).toPandas().sort_values("id")
    assert share["b"].tolist() == (q - pd.qcut(pdf["w"], q, labels=False)).tolist()


def test_exact_quantiles(spark):
    values = [float(x) for x in (3, 3, 3, 1, 9, 4, 4, 10)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ranking.exact_quantiles(df, "v", [0, 0.25, 0.5, 0.99, 1]).first()
    want = np.quantile([v for v in values if v is not None], [0, 0.25, 0.5, 0.99, 1])
    assert np.allclose(list(got), want)


@pytest.mark.parametrize("keys", [["k"], ["k", "h"], []])
def test_group_quantiles_equal_numpy(spark, keys):
    """Continuous and repeated values, a NULL group, groups of one value and groups of NULLs only."""
    rng = np.random.default_rng(3)
    data = [(None if i % 3 == 0 else i % 5, i % 2, float(rng.normal()) if i % 4 else float(i % 7)) for i in range(2_000)]
    data += [(77, 0, 5.0), (78, 0, None), (79, 1, None), (79, 1, 1.0), (79, 1, 2.0)]
    got = ranking.group_quantiles(spark.createDataFrame(data, "k int, h int, v double").repartition(5), keys, "v", [0, 0.1, 0.5, 0.99]).collect()
    groups = {}
    for k, h, v in data:
        if v is not None:
            groups.setdefault((k, h)[:len(keys)], []).append(v)
    assert len(got) == len(groups)
    for r in got:
        assert np.allclose(list(r[len(keys):]), np.quantile(groups[tuple(r[:len(keys)])], [0, 0.1, 0.5, 0.99]))


def test_quantiles_of_a_group_over_many_partitions(spark):
    """A group of 300,000 distinct values reaches into every partition of the range; its median is exact."""
    df = spark.range(300_001).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("k"), (F.col("id") / 7).alias("v"))
    held = ranking._ranged(df, [F.col("k"), F.col("v")])
    assert held.filter("k = 'a'").select("_pid").distinct().count() > 1
    assert rows(agg.weighted_median(df, ["k"], "v", "m")) == [("a", pytest.approx(150_000 / 7)), ("b", pytest.approx(150_000 / 7))]


def test_quantiles_of_many_columns_take_one_range(spark, monkeypatch):
    ranged = []
    plain = ranking._ranged
    monkeypatch.setattr(ranking, "_ranged", lambda *a: (ranged.append(1), plain(*a))[1])
    df = spark.range(101).select("id", (F.col("id") * 2.5).alias("x"), F.lit(None).cast("int").alias("none"), (F.col("id") % 3).alias("y"))
    assert rows(ranking.column_quantiles(df, ["id", "x", "none", "y"], [0.25, 0.5])) == [("id", 25, 50), ("none", None, None), ("x", 62.5, 125), ("y", 0, 1)]
    filled = impute.fill_median(df.withColumn("x", F.when(F.col("id") > 90, F.col("x"))), ["x", "none", "y"])
    assert len(ranged) == 2 and filled.filter("x is null").count() == 0 and filled.filter("none is not null").count() == 0


def test_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z"), (2, "z"), (2, "a"), (3, None)], "k int, v string")
    assert rows(agg.mode_per_group(df, ["k"], "v")) == [(1, "a", 1), (2, "z", 2)]


def test_imputation_keeps_flags(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "a"), (3, 4.0, None), (4, 9.0, "b")], "id int, n double, c string")
    out = rows(impute.impute(df, ["n"], ["c"]), "id", "n", "c", "n_is_null_flag", "c_is_null_flag")
    assert out == [(1, 1.0, "a", 0, 0), (2, 4.0, "a", 1, 0), (3, 4.0, "a", 0, 1), (4, 9.0, "b", 0, 0)]


def test_quadratic_trend_recovers_its_coefficients(spark):
    df = spark.range(-10, 11).select(F.col("id").alias("x"), (F.lit(2.0) - 3 * F.col("id") + 0.5 * F.col("id") * F.col("id")).alias("y"))
    got = agg.quadratic_trend(df, "y", "x").first()
    assert got["n"] == 21 and np.allclose([got["intercept"], got["linear"], got["quadratic"]], [2, -3, 0.5])


def test_safe_lookup_keeps_the_row_count(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    many = spark.createDataFrame([(1, 5), (1, 7)], "k int, v int")
    out = joins.safe_lookup(fact, many, "k", lambda d: d.groupBy("k").agg(F.sum("v").alias("v")))
    assert rows(out) == [(1, 12), (1, 12), (2, None)]


def owned(spark, n=60_000):
    """Heads 0-199 twice over, lines of which head 7 owns half; heads 150-199 and key 500 have no partner."""
    heads = spark.range(200).select("id", F.col("id").alias("h")).union(spark.range(3).select("id", F.lit(-1).cast("long").alias("h")))
    lines = spark.range(n).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") == 1, 500).otherwise(F.col("id") % 150).alias("id"), F.col("id").alias("l"))
    return heads, lines.union(spark.createDataFrame([(None, -1)], lines.schema)).repartition(6)


@pytest.mark.parametrize("hot", [{}, {7: 3, 8: 400}, {7: 60_000, 160: 9, 500: 2, 0: 1}])
def test_keep_all_is_a_left_join(spark, monkeypatch, hot):
    """With any choice of hot keys: some without lines, some with fewer lines than salts."""
    heads, lines = owned(spark, 6_000)
    monkeypatch.setattr(joins, "hot_keys", lambda *_: hot)
    out = joins.keep_all(heads, lines, "id")
    want = heads.join(lines, "id", "left")
    assert out.columns == want.columns
    assert out.exceptAll(want).count() == want.exceptAll(out).count() == 0


def test_hot_keys_are_dealt_evenly(spark):
    heads, lines = owned(spark)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert joins.hot_keys(lines, "id").keys() == {7}
        joined = joins.keep_all(heads, lines, "id")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        plain = sorted(r["count"] for r in heads.join(lines, "id", "left").groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == sum(plain) and sizes[-1] <= 3 * sizes[len(sizes) // 2] < plain[-1] / 3


def test_histogram_clips_and_pivot_fills(spark):
    df = spark.createDataFrame([(0,), (4,), (5,), (99,), (None,)], "v int")
    assert rows(agg.histogram(df, "v", 5, cap=10)) == [(0, 0.0, 2), (1, 5.0, 1), (2, 10.0, 1)]
    wide = agg.pivot_sum(spark.createDataFrame([(1, "a", 2)], "r int, c string, v int"), ["r"], "c", ["a", "b"], F.sum("v"))
    assert rows(wide) == [(1, 2, 0)]


# History ---------------------------------------------------------------------------------------


def versions(spark, data):
    return history.open_versions(spark.createDataFrame(data, "k int, v string"), ["k"], F.lit(T0))


def state(df):
    return rows(df, "k", "v", "valid_from", "valid_to")


def test_check_strategy_and_replay(spark):
    start = versions(spark, [(1, "a"), (2, "b"), (3, None), (4, "d")])
    current = spark.createDataFrame([(1, "a"), (2, "x"), (3, "now"), (5, "new")], "k int, v string")
    once = history.scd2_check(start, current, ["k"], ["v"], F.lit(T1))
    assert state(once) == sorted([
        (1, "a", T0, None), (2, "b", T0, T1), (2, "x", T1, None), (3, None, T0, T1), (3, "now", T1, None),
        (4, "d", T0, None), (5, "new", T1, None)], key=lambda t: tuple((x is not None, x) for x in t))
    again = history.scd2_check(once, current, ["k"], ["v"], F.lit(T2))
    assert state(again) == state(once)
    assert quality.check_unique(once, ["version_id"]).isEmpty()
    back = history.scd2_check(once, spark.createDataFrame([(2, "b")], "k int, v string"), ["k"], ["v"], F.lit(T2))
    assert [r for r in state(back) if r[0] == 2] == [(2, "b", T0, T1), (2, "b", T2, None), (2, "x", T1, T2)]


def test_hard_delete_closes_and_key_can_return(spark):
    start = versions(spark, [(1, "a"), (2, "b")])
    gone = history.scd2_check(start, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], ["v"], F.lit(T1), hard_deletes=True)
    assert state(gone) == [(1, "a", T0, None), (2, "b", T0, T1)]
    back = history.scd2_check(gone, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], ["v"], F.lit(T2), hard_deletes=True)
    assert state(back) == [(1, "a", T0, None), (2, "b", T0, T1), (2, "b", T2, None)]


def test_timestamp_strategy_ignores_late_older_rows(spark):
    schema = "k int, v string, u timestamp"
    start = history.start_history(spark.createDataFrame([(1, "a", T1), (2, "b", T1)], schema), ["k"], "u")
    batch = spark.createDataFrame([(1, "old", T0), (2, "new", T2)], schema)
    once = history.scd2_timestamp(start, batch, ["k"], "u")
    assert state(once) == [(1, "a", T1, None), (2, "b", T1, T2), (2, "new", T2, None)]
    assert state(history.scd2_timestamp(once, batch, ["k"], "u")) == state(once)


def test_rebuild_has_one_open_version_and_no_overlap(spark):
    log = skewed(spark).select("k", F.timestamp_seconds("id").alias("ts"), (F.col("t") % 5).alias("v")).filter("k is not null")
    pdf = history.scd2_rebuild(log, ["k"], "ts", ["v"]).toPandas().sort_values(["k", "valid_from"])
    assert (pdf.groupby("k")["is_current"].sum() == 1).all()
    assert pdf["valid_to"].dropna().tolist() == pdf.groupby("k")["valid_from"].shift(-1).dropna().tolist()
    assert (pdf["last_seen"] >= pdf["valid_from"]).all() and not (pdf["last_seen"] >= pdf["valid_to"]).any()


def test_rebuild_opens_a_returning_state_again(spark):
    log = spark.createDataFrame([(1, "a", T0), (1, "a", T1), (1, "b", T2), (1, "a", T3), (None, None, T0), (None, "x", T1), (None, None, T2)], "k int, v string, ts timestamp")
    out = history.scd2_rebuild(log, ["k"], "ts", ["v"])
    assert rows(out, "k", "valid_from", "v", "last_seen", "valid_to", "is_current") == [
        (None, T0, None, T0, T1, False), (None, T1, "x", T1, T2, False), (None, T2, None, T2, None, True),
        (1, T0, "a", T1, T2, False), (1, T2, "b", T2, T3, False), (1, T3, "a", T3, None, True)]


def test_replay_with_a_null_key_changes_nothing(spark):
    now = F.lit(T1)
    start = history.open_versions(spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string"), ["k"], F.lit(T0))
    batch = spark.createDataFrame([(None, "c"), (1, "b")], "k int, v string")
    once = history.scd2_check(start, batch, ["k"], ["v"], now)
    assert once.count() == 3 and rows(history.scd2_check(once, batch, ["k"], ["v"], now), "k", "v", "valid_to") == rows(once, "k", "v", "valid_to")


def test_first_with_ties_and_first_present(spark):
    df = spark.createDataFrame([(1, 1, None, 5), (1, 1, "b", None), (1, 2, "c", 6), (2, 3, None, None)], "k int, t int, v string, n int")
    assert rows(ranking.first_with_ties(df, ["k"], [F.col("t").asc()]), "k", "t", "v") == [(1, 1, None), (1, 1, "b"), (2, 3, None)]
    assert rows(agg.first_present(df, ["k"], ["t", "v"], ["v", "n"])) == [(1, "b", 5), (2, None, None)]


def test_even_histogram_and_quartiles(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 4, 10, 10, None)], "v int")
    assert rows(agg.even_histogram(df, "v", 5)) == [(0, 0.0, 2), (1, 2.0, 2), (2, 4.0, 1), (4, 8.0, 2)]
    assert rows(agg.describe_quartiles(df, ["v"])) == [("v", 1.5, 3.0, 7.0)]


def test_row_rules_count_in_one_scan(spark):
    df = spark.createDataFrame([(1, None), (None, 5), (3, -1)], "a int, b int")
    rules = [quality.RowRule("a_present", F.col("a").isNull()), quality.RowRule("b_positive", F.col("b") < 0, "warn"), quality.RowRule("fine", F.lit(False))]
    out = quality.run_row_rules(df, rules)
    assert rows(out) == [("a_present", "error", 1, False), ("b_positive", "warn", 1, False), ("fine", "error", 0, True)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


# Checks -----------------------------------------------------------------------------------------


def test_checks_return_their_violations(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5, 4), (1, "x", -1, 0), (None, None, None, 3)], "id int, e string, lo int, hi int")
    dim = spark.createDataFrame([(2,)], "id int")
    assert rows(quality.check_unique(df, ["id"])) == [(1, 2)]
    assert quality.check_not_null(df, "id").count() == 1
    assert quality.check_fk(df, "id", dim, "id").count() == 2
    assert rows(quality.check_enum(df, "e", ["a"]), "e") == [("x",)]
    assert rows(quality.check_range(df, "lo", 0, 10), "lo") == [(-1,)]
    assert rows(quality.check_pair(df, "hi", "lo"), "id") == [(1,)]
    assert rows(quality.check_regex(df, "e", "^a$"), "e") == [("x",)]
    assert quality.check_expr(df, "lo > 0").count() == 2
    assert rows(quality.check_schema(df, {"id": "bigint", "e": "string", "z": "int"})) == [
        ("hi", None, "int"), ("id", "bigint", "int"), ("lo", None, "int"), ("z", "int", None)]
    assert rows(quality.check_null_rate(df, {"id": 0.5, "e": 0.2}), "column_name") == [("e",)]
    assert quality.check_mean(df, "hi", 0, 2).count() == 1
    summary = quality.run_checks([
        quality.Check("u", quality.check_unique(df, ["id"])), quality.Check("n", quality.check_not_null(df, "hi")),
        quality.Check("r", quality.check_range(df, "lo", 0), "warn"),
    ], store=str(tmp_path))
    assert rows(summary) == [("n", "error", 0, True), ("r", "warn", 1, False), ("u", "error", 1, False)]
    assert rows(quality.failed_errors(summary), "check_name") == [("u",)]
    assert spark.read.parquet(str(tmp_path / "u")).count() == 1


def test_totals_must_agree(spark):
    a = spark.createDataFrame([("m1", 1.0), ("m1", 2.0), ("m2", 5.0)], "m string, v double")
    b = spark.createDataFrame([("m1", 3.0), ("m3", 1.0)], "m string, v double")
    assert rows(quality.check_totals(a, b, "m", "v"), "m") == [("m2",), ("m3",)]
