import datetime as dt
from decimal import Decimal
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer
from pyspark.ml.tuning import CrossValidator
from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators.history import open_versions
from orderloom.plans import audits, boosting, delivery, kpis, layers, learning, orders, retention, semantic, stage, star, words
from orderloom.schemas import raw_schema

D = dt.datetime
BUY = D(2020, 1, 10, 12)


def table(spark, name, data):
    return spark.createDataFrame(data, raw_schema(name))


@pytest.fixture(scope="module")
def t(spark):
    """Edge rows: item-less and unpaid orders, odd money, delivery of 30 and 31 days, repeated keys."""
    due = D(2020, 1, 20)

    def order(i, person, status, bought, delivered):
        return (f"o{i}", person, status, bought, bought, None, delivered, due)

    raw = {
        "orders": table(spark, "orders", [
            order(1, "c1", "delivered", BUY, D(2020, 2, 9)),             # 30 days
            order(2, "c1", "delivered", D(2020, 1, 11), D(2020, 2, 11)),  # 31 days
            order(3, "c2", "delivered", BUY, None),                      # delivered, no date
            order(4, "c2", None, D(2020, 3, 1), D(2020, 2, 1)),           # no status, before purchase
            order(5, "c3", "shipped", BUY, D(2020, 1, 20, 9)),            # no items, no payment
            order(5, "c3", "created", D(2020, 1, 9), None),               # older copy of the same key
            (None, "c3", "created", BUY, None, None, None, None),
        ]),
        "order_items": table(spark, "order_items", [
            ("o1", 1, "p1", "s1", BUY, Decimal("10000.00"), Decimal("5.00")),
            ("o1", 2, "p2", "s2", BUY, Decimal("10000.01"), Decimal("-1.00")),
            ("o2", 1, "p1", "s1", BUY, Decimal("0.00"), Decimal("2.00")),
            ("o3", 1, "p3", "s9", BUY, Decimal("30.00"), Decimal("10.00")),
            ("o3", 1, "p3", "s9", D(2020, 1, 9), Decimal("99.00"), Decimal("10.00")),
            ("o4", 1, "p1", "s1", BUY, Decimal("50.00"), Decimal("0.00")),
        ]),
        "order_payments": table(spark, "order_payments", [
            ("o1", 1, "credit_card", 3, Decimal("100.00")), ("o1", 2, "voucher", 1, Decimal("50.00")),
            ("o2", 1, None, 1, Decimal("20.00")), ("o3", 1, "boleto", 1, Decimal("40.00")),
        ]),
        "order_reviews": table(spark, "order_reviews", [
            ("r1", "o1", 5, None, "ótimo produto", BUY, D(2020, 2, 10)), ("r1", "o1", 1, None, " ", BUY, D(2020, 2, 12)),
            ("r2", "o1", 4, "bom", "chegou rápido demais", BUY, D(2020, 2, 11)), ("r3", "o3", 2, None, None, BUY, BUY),
        ]),
        "customers": table(spark, "customers", [
            ("c1", "u1", "01001", "a", "SP"), ("c2", "u2", "02002", "b", "RJ"), ("c3", "u1", "03003", "a", "SP"),
        ]),
        "products": table(spark, "products", [
            ("p1", "moveis", 1, 1, 1, 100, 1, 2, 3), ("p2", "semnome", 1, 1, 1, None, 1, 1, 1), ("p3", None, 1, 1, 1, 7, 1, 1, 1),
        ]),
        "sellers": table(spark, "sellers", [("s1", "01001", "x", "SP"), ("s2", "99999", "y", "RJ")]),
        "product_category_name_translation": table(spark, "product_category_name_translation", [("moveis", "furniture")]),
        "geolocation": spark.createDataFrame(
            [("01001", 1.0, 2.0, "a", "SP"), ("01001", 3.0, 4.0, "a", "SP")],
            "zip_code_prefix string, lat double, lng double, city string, state string"),
    }
    return {"raw": raw, **stage.stage(raw)}


def as_of():
    return F.lit(D(2020, 6, 1))


def test_fact_grain_and_flags(t):
    fact = star.fact_orders(t["orders"], t["order_items"], t["order_payments"], as_of())
    by_key = {(r["id"], r["order_item_id"]): r for r in fact.collect()}
    assert set(by_key) == {("o1", 1), ("o1", 2), ("o2", 1), ("o3", 1), ("o4", 1), ("o5", None)}
    assert by_key["o1", 1]["payment_type"] == "voucher" and by_key["o1", 1]["payment_value"] == 50
    assert not by_key["o1", 1]["is_high_value_product"] and by_key["o1", 2]["is_high_value_product"]
    assert by_key["o1", 2]["freight_value"] is None and by_key["o2", 1]["price"] is None
    assert not by_key["o1", 1]["is_long_delivery"] and by_key["o2", 1]["is_long_delivery"]
    assert by_key["o2", 1]["payment_type"] == "not_defined" and by_key["o2", 1]["has_missing_payment_info"]
    assert by_key["o3", 1]["has_missing_delivery_date"] and by_key["o3", 1]["is_overdue_delivery"]
    assert by_key["o3", 1]["price"] == 30
    assert by_key["o4", 1]["order_status"] == "unavailable" and by_key["o4", 1]["has_invalid_delivery_date"]
    assert by_key["o5", None]["has_no_items"] and by_key["o5", None]["has_missing_payment_info"]
    assert by_key["o5", None]["order_status"] == "shipped"


def test_summed_payments_replace_the_last(t):
    fact = star.fact_orders(t["orders"], t["order_items"], t["order_payments"], as_of(), payment_policy="sum")
    assert {r["payment_value"] for r in fact.filter("id = 'o1'").collect()} == {150}


def test_allocated_payments_add_up_to_payments(t):
    sales = star.fact_sales(t["orders"], t["order_items"], t["order_payments"], t["order_reviews"])
    sums = {r[0]: r[1] for r in sales.groupBy("order_id").agg(F.sum("allocated_payment_value")).collect()}
    assert sums["o1"] == pytest.approx(150) and sums["o3"] == pytest.approx(40) and sums["o4"] is None
    assert sales.count() == 5


def test_order_base_counts_each_order_once(t):
    base = {r["order_id"]: r for r in orders.order_base(t).collect()}
    assert len(base) == 5
    assert base["o1"]["gmv"] == 20000.01 and base["o1"]["n_items"] == 2
    assert base["o1"]["review_score"] == 1  # the newest answer of the order
    assert base["o5"]["gmv"] is None and base["o5"]["n_items"] == 1
    assert base["o5"]["days_vs_estimate"] == 0 and base["o3"]["delivery_days"] is None


def test_both_ways_to_the_base_agree(t):
    fact = star.fact_orders(t["orders"], t["order_items"], t["order_payments"], as_of())
    a = orders.order_base(t)
    b = orders.order_base_from_fact(fact, t["customers"], t["order_reviews"])
    cols = [c for c in a.columns if c != "n_items"]
    assert rows(a, *cols) == rows(b, *cols)


def test_person_history(t):
    df = orders.enriched_orders(t, ("items", "customers"))
    got = {r["order_id"]: (r["order_seq"], r["cust_total_orders"], r["is_repeat_order"], r["has_subsequent_order"], r["cohort_month"])
           for r in df.collect()}
    jan = dt.date(2020, 1, 1)
    assert got["o3"] == (1, 2, False, True, jan) and got["o4"] == (2, 2, True, False, jan)
    # u1 owns o2 (11 Jan 0:00), o1 and o5 (same instant, settled by order id)
    assert [got[o][0] for o in ("o1", "o5", "o2")] == [1, 2, 3]
    assert got["o1"][1:4] == (3, False, True) and got["o2"][1:4] == (3, True, False)


def test_kpis_and_cohorts(t):
    df = orders.enriched_orders(t)
    k = kpis.kpis(df).first()
    assert (k["orders"], k["customers"], k["repeat_rate"]) == (5, 2, 1.0)
    assert k["on_time_rate"] == 0.0 and k["gmv"] == pytest.approx(20080.01)
    long = retention.cohort_long(df)
    assert all(r["retention"] == 1 for r in long.filter("months_since = 0").collect())
    assert kpis.treadmill(df).filter("order_month = '2020-01-01'").first()["new_customers"] == 2


def test_slicing_comes_after_history(t):
    df = orders.slice_orders(orders.enriched_orders(t, ("customers",)), "2020-03-01", "2020-03-01", ["RJ"])
    assert rows(df, "order_id", "order_seq") == [("o4", 2)]
    assert orders.slice_orders(df, states=[]).count() == 1


def test_review_at_risk_and_profile(t):
    df = orders.enriched_orders(t)
    risk = retention.revenue_at_risk(df).first()
    assert risk["gmv_at_risk"] == 0.0  # o1 and o3 drew low scores, yet both persons ordered again
    assert rows(delivery.score_distribution(df)) == [(1, 1), (2, 1)]


def test_dimensions(t):
    assert rows(star.dim_sellers(t["sellers"], t["geolocation"]), "id", "geo_lat") == [("s1", 2.0), ("s2", None)]
    products = star.dim_products(open_versions(t["products"], ["product_id"], as_of()), t["product_category_name_translation"])
    assert rows(products, "product_id", "product_category", "is_current") == [
        ("p1", "furniture", True), ("p2", None, True), ("p3", None, True)]
    assert "product_name_length" in products.columns
    days = star.dim_date(t["orders"].sparkSession, t["orders"])
    assert days.count() == 11 and rows(days.filter("is_weekend"), "day_of_month") == [(11,), (12,), (18,), (19,)]


def test_metric_registry(t):
    df = orders.enriched_orders(t)
    out = semantic.metric_query(semantic.ORDERS, df, ["order_count", "late_rate"], ["customer_state"], limit=1)
    assert rows(out, "customer_state", "order_count") == [("SP", 3)]
    assert len(semantic.CHARTS) == 18
    numbers = semantic.big_numbers({semantic.ORDERS: df, semantic.CUSTOMERS: retention.customer_view(df)})
    assert numbers.count() == 6


def test_audits_find_the_broken_rows(t):
    fact = star.fact_orders(t["orders"], t["order_items"], t["order_payments"], as_of())
    failed = {r["check_name"]: r["n_failed"] for r in audits.gold_summary(fact, t, as_of()).collect() if not r["passed"]}
    assert failed["fact_seller"] == 1 and failed["delivered_has_date"] == 1 and failed["fact_price_range"] == 1 and "fact_grain" not in failed


def test_review_words(t):
    texts = words.review_texts(t["raw"]["order_reviews"])
    assert rows(texts, "review_id", "message") == [("r1", None), ("r2", "chegou rápido demais"), ("r3", None)]
    assert rows(words.term_freq(texts, "text")) == [("bom", 1), ("demais", 1), ("rapido", 1)]
    assert rows(words.bigram_freq(texts, "text")) == [("bom rapido", 1), ("rapido demais", 1)]
    mapping = t["orders"].sparkSession.createDataFrame([("bom", "good"), ("demais", "good")], "term string, label string")
    assert rows(words.relabel(words.term_freq(texts, "text"), mapping)) == [("good", 2), ("rapido", 1)]


def test_layers_can_be_rebuilt_and_replayed(spark, t, tmp_path):
    root, raw = str(tmp_path / "w"), t["raw"]
    for _ in range(2):
        out = layers.run(spark, raw, root, D(2020, 6, 1))
    assert out["fact_orders"].count() == 6 and out["dim_products"].count() == 3
    assert {r["status"] for r in out["reconciliation"].collect()} == {"exact"}
    heavier = raw["products"].withColumn("product_weight_g", F.col("product_weight_g") + 1)
    out = layers.run(spark, {**raw, "products": heavier}, root, D(2020, 7, 1), layers=("bronze", "snapshot", "gold"))
    assert out["dim_products"].count() == 5 and out["dim_products"].filter("is_current").count() == 3
    with pytest.raises(ValueError):
        layers.run(spark, raw, root, D(2020, 7, 1), layers=("silver",))


def test_the_order_layer_is_made_from_the_stored_fact(spark, t, tmp_path, monkeypatch):
    read, plain = {}, layers.swap_table
    monkeypatch.setattr(layers, "swap_table", lambda df, path: (read.update({path.rsplit("/", 1)[1]: df.inputFiles()}), plain(df, path)))
    out = layers.run(spark, t["raw"], str(tmp_path / "w"), D(2020, 6, 1))
    assert read["orders_enriched"] and not [f for f in read["orders_enriched"] if "/bronze/" in f]
    known = orders.enriched_orders(stage.stage(t["raw"]))
    assert out["orders_enriched"].columns == known.columns and rows(out["orders_enriched"]) == rows(known)


# Models ------------------------------------------------------------------------------------------


def test_threshold_and_areas_on_known_scores(spark):
    data = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.2), (0, 0.1)]
    scored = spark.createDataFrame([(i, l, s) for i, (l, s) in enumerate(data)], "order_id int, label int, score double")
    assert learning.pick_threshold(scored, 0.6).first()[0] == pytest.approx(0.8)
    assert learning.pick_threshold(scored, 1.1).first()[0] == 0.5
    m = learning.metrics(scored, 0.6).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (2, 0, 1, 3)
    assert m["roc_auc"] == pytest.approx(8 / 9) and m["pr_auc"] == pytest.approx((1 + 1 + 0.75) / 3)


def test_models_learn_a_plain_rule_and_keep_their_scores(spark, tmp_path):
    n = 1200
    df = spark.range(n).select(
        F.col("id").alias("order_id"), (F.col("id") % 5 == 0).cast("int").alias("label"),
        *[(F.when(F.col("id") % 9 > 0, F.pmod(F.xxhash64("id", F.lit(c)), F.lit(100)) / 10.0) + F.when(
            (F.col("id") % 5 == 0) & F.lit(c == "freight_ratio"), 50).otherwise(0)).alias(c) for c in learning.NUMERIC],
        *[F.concat(F.lit("v"), F.col("id") % (400 if c == "product_category" else 3)).alias(c) for c in learning.CATEGORICAL],
    )
    train, test = learning.split(df)
    assert train.count() + test.count() == n and 150 < test.count() < 330
    assert rows(learning.split(df)[1], "order_id") == rows(test, "order_id")
    levels = {c: learning.common_levels(train, c) for c in learning.CATEGORICAL}
    modes = learning.training_modes(train)
    train, test = (learning.fold_rare(d, levels, modes) for d in (train, test))
    assert {r[0] for r in train.select("product_category").distinct().collect()} == {"rare"}
    weighted = learning.balance(train).cache()
    sums = {r[0]: r[1] for r in weighted.groupBy("label").agg(F.sum("weight")).collect()}
    assert sums[0] == pytest.approx(sums[1])
    model = learning.fit(weighted, "gradient_boosting", {"maxIter": 3, "maxDepth": 3})
    scored = learning.score(model, test)
    assert learning.metrics(scored).first()["roc_auc"] > 0.85
    assert learning.importances(model, weighted, 1).first()["feature"].startswith("scaled")
    learning.save(model, str(tmp_path / "m"))
    again = learning.score(learning.load(str(tmp_path / "m")), test)
    assert rows(again) == rows(scored)


def test_orders_are_labelled_before_their_items_are_summed(spark, t):
    """The same rows as from all orders; items of orders that are not wanted go first."""
    late = orders.order_base(t, ("customers",))
    for target in ("late_delivery", "repeat_purchase"):
        after = learning.label(learning.ml_base(t), target)
        labelled = learning.label(late, target)
        before = learning.with_items(labelled, t, labelled.select("order_id"))
        assert set(before.columns) == set(after.columns) and before.count() > 0
        assert rows(before, *after.columns) == rows(after)
    assert learning.with_items(late, t, labelled.select("order_id").limit(0)).filter("item_count is not null").count() == 0


def test_leaks_are_not_features():
    assert not set(learning.NUMERIC + learning.CATEGORICAL) & set(learning.LEAKS)


def test_search_prefers_the_better_parameters(spark):
    df = spark.range(300).select(
        F.col("id").alias("order_id"), (F.col("id") % 2).cast("int").alias("label"), F.lit(1.0).alias("weight"),
        *[((F.col("id") % 2) * 3.0 + F.pmod(F.xxhash64("id", F.lit(c)), F.lit(10)) / 10).alias(c) for c in learning.NUMERIC],
        *[F.lit("x").alias(c) for c in learning.CATEGORICAL[:-1]],
        F.when(F.col("id") % 3 == 0, "same").otherwise("cross").alias("same_state"),
    )
    found = learning.search(df, "logistic_regression", {"regParam": [0.0, 0.1]}, folds=2)
    assert max(found.avgMetrics) > 0.95


def test_typed_tables_null_what_does_not_read(spark):
    raw = spark.createDataFrame([(" s1 ", "77", " Rio ", "rj", False), ("s2", None, " ", "SP", True)],
                                "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string, is_deleted boolean")
    assert rows(stage.typed_table("sellers", raw)) == [("s1", "00077", "rio", "RJ")]
    pay = spark.createDataFrame([("o", "x", "VOUCHER")], "order_id string, payment_sequential string, payment_type string")
    assert rows(stage.typed_table("order_payments", pay)) == [("o", None, "voucher", None, None)]


def ml_rows(spark, n=4_000):
    """Late if a number is high in some states; a NULL and a level that training does not hold."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        numbers = [rng.random() if rng.random() > 0.05 else None for _ in learning.NUMERIC]
        levels = [rng.choice("abcd") for _ in learning.CATEGORICAL]
        late = (numbers[0] or 0) > 0.6 and levels[0] in "ab" or rng.random() < 0.05
        rows.append((i, int(late), 1.0, *numbers, *levels))
    rows += [(n, 0, 1.0, *[None] * len(learning.NUMERIC), *["new"] * len(learning.CATEGORICAL))]
    columns = ["order_id bigint", "label int", "weight double", *[f"{c} double" for c in learning.NUMERIC], *[f"{c} string" for c in learning.CATEGORICAL]]
    return spark.createDataFrame(rows, ", ".join(columns))


def test_histogram_boosting_learns_what_trees_can(spark):
    data = ml_rows(spark)
    train, test = data.filter("order_id < 3000"), data.filter("order_id >= 3000")
    model = boosting.fit(train, trees=4, leaves=4)
    assert all(len(t.values) <= 4 and t.values.keys() == {c for n in t.splits for c in (2 * n, 2 * n + 1)} - t.splits.keys() for t in model.trees)
    figures = learning.metrics(boosting.score(model, test)).first()
    plain = learning.metrics(learning.score(learning.fit(train, "gradient_boosting", {"maxIter": 4, "maxDepth": 2}), test)).first()
    assert figures.n_test == 1001 and figures.roc_auc > 0.85 and figures.pr_auc > plain.pr_auc - 0.02
    again = boosting.fit(train.repartition(7), trees=4, leaves=4)
    assert [t.splits for t in again.trees] == [t.splits for t in model.trees]  # whatever the order of the rows
    used = [r.feature for r in boosting.importances(model, test).collect() if r.splits]
    assert {learning.NUMERIC[0], learning.CATEGORICAL[0]} <= set(used[:3])
    margins = boosting.score(model, test).filter("order_id = 4000").first()
    assert 0 < margins.score < 1


def test_histogram_boosting_reads_the_smaller_half_of_a_split_only(spark, monkeypatch):
    asked, whole = [], boosting._histograms

    def watched(rows, tree, fresh, features):
        found = whole(rows, tree, fresh, features)
        if fresh != [1] and not asked:  # sums of the other half follow exactly
            node = fresh[0]
            top, both = whole(rows, boosting.Tree(), [1], features)[1], whole(rows, tree, [node, node ^ 1], features)
            assert node // 2 == 1 and both[node] == found[node] and boosting._without(top, found[node]) == both[node ^ 1]
            assert sum(n for *_, n in found[node][0].values()) <= sum(n for *_, n in both[node ^ 1][0].values())
        asked.append(list(fresh))
        return found

    monkeypatch.setattr(boosting, "_histograms", watched)
    boosting.fit(ml_rows(spark, 800), trees=1, leaves=4)
    assert asked[0] == [1] and len(asked) > 1 and not any(node ^ 1 in fresh for fresh in asked for node in fresh)


def test_histogram_boosting_without_rows_or_splits(spark):
    data = ml_rows(spark, 50)
    flat = boosting.fit(data.filter("label = 0"), trees=2)
    assert all(t.splits == {} for t in flat.trees)
    assert boosting.score(boosting.fit(data.limit(0), trees=1), data).filter("score is null").count() == 0


def test_folds_hold_every_row_once_and_keep_shares(spark):
    data = spark.range(9_000).select(F.col("id").alias("order_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    held = learning.with_folds(data, 3)
    shares = held.groupBy("fold").agg(F.count("*").alias("n"), F.avg("label").alias("share")).collect()
    assert held.count() == 9_000 and {r.fold for r in shares} == {0, 1, 2}
    assert all(abs(r.n - 3_000) < 200 and abs(r.share - 0.1) < 0.02 for r in shares)


def test_random_search_judges_on_folds(spark):
    data = learning.with_folds(ml_rows(spark, 600), 2).drop("fold")
    model, tried = learning.random_search(data, "logistic_regression", {"regParam": (0.0, 0.1, 10.0)}, draws=3, folds=2)
    assert len(tried) == 3 and all(0 < area <= 1 for _, area in tried)
    assert learning.score(model, data).count() == 601


def test_random_search_repeats_its_draws(spark):
    space, first = {"a": range(100), "b": (1, 2, 3)}, []
    for _ in range(2):
        picker = learning.random.Random(7)
        first.append([{n: picker.choice(list(v)) for n, v in space.items()} for _ in range(5)])
    assert first[0] == first[1]


def test_exact_thresholds_and_areas(spark):
    scored = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.4), (0, 0.2), (0, 0.1)], "label int, score double")
    row = learning.metrics(scored, min_recall=0.6).first()
    assert (row.threshold, row.tp, row.fp, row.fn, row.tn) == (0.4, 3, 1, 0, 2)
    assert row.roc_auc == pytest.approx(7.5 / 9) and row.pr_auc == pytest.approx((1 + 2 / 3 + 3 / 4) / 3)


def test_random_search_prepares_each_fold_once(spark, monkeypatch):
    train = ml_rows(spark, 400).coalesce(1)
    space = {"maxDepth": (2, 3), "maxIter": (1, 2)}
    last, fits, plain = learning.estimator("gradient_boosting"), [], Imputer.fit
    monkeypatch.setattr(Imputer, "fit", lambda self, *a: (fits.append(1), plain(self, *a))[1])
    model, tried = learning.random_search(train, "gradient_boosting", space, draws=5, folds=2)
    assert len(fits) == 3  # one a fold and one of all rows, however many draws there are
    monkeypatch.undo()
    known = CrossValidator(
        estimator=Pipeline(stages=[*learning.preparation(), last]), numFolds=2, foldCol="fold",
        evaluator=BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR", numBins=0),
        estimatorParamMaps=[{getattr(last, n): v for n, v in params.items()} for params, _ in tried],
    ).fit(learning.with_folds(train, 2))
    assert [area for _, area in tried] == pytest.approx(known.avgMetrics)
    assert model.stages[-1].toDebugString.split("\n", 1)[1] == known.bestModel.stages[-1].toDebugString.split("\n", 1)[1]
