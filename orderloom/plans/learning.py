"""Late-delivery and repeat-purchase models on order-grain features, with pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F
from pyspark.util import inheritable_thread_target

from orderloom.functions.clean import ratio, total
from orderloom.functions.dates import elapsed_days
from orderloom.operators.aggregates import mode_per_group, modes_per_group
from orderloom.operators.joins import lookup, with_scalar
from orderloom.operators.ranking import running_totals
from orderloom.plans.business import product_volume
from orderloom.plans.orders import order_base, with_person_history
from orderloom.plans.star import clean_items, product_attributes
from orderloom.session import cut_lineage, stored

# Features, and columns that must never become one.
NUMERIC = (
    "order_gmv", "order_freight", "item_count", "seller_count", "total_weight_g", "max_volume_cm3",
    "estimated_lead_days", "purchase_dow", "purchase_month", "purchase_hour", "freight_ratio",
)
CATEGORICAL = ("customer_state", "seller_state", "product_category", "same_state")
LEAKS = ("delivered_ts", "approved_ts", "order_status", "order_id", "customer_id", "customer_unique_id")

# Levels seen in fewer training rows than this share one rare level.
MIN_SHARE = 0.005
SEED = 42


def ml_base(tables) -> DataFrame:
    """One row per order: money, items, distinct sellers, weight, volume, modal category and seller state."""
    return with_items(order_base(tables, ("customers",)), tables)


def with_items(orders: DataFrame, tables, only: DataFrame | None = None) -> DataFrame:
    """Orders with what their items tell. ``only`` holds the ``order_id`` of all of ``orders`` where these are a part of the table:
    items of other orders then go before they are summed."""
    products = product_volume(product_attributes(tables["products"], tables["product_category_name_translation"])).select(
        "product_id", "product_category", "product_weight_g", "volume_cm3"
    )
    items = tables["order_items"] if only is None else tables["order_items"].join(only, "order_id", "left_semi")
    items = clean_items(items).select("order_id", "product_id", "seller_id", "price", "freight_value")
    items = lookup(lookup(items, products, "product_id"), tables["sellers"].select("seller_id", "seller_state"), "seller_id")
    per_seller = items.groupBy("order_id", "seller_id").agg(
        F.sum("price").alias("price"), F.sum("freight_value").alias("freight"), F.count(F.lit(1)).alias("n"),
        F.sum("product_weight_g").alias("weight"), F.max("volume_cm3").alias("volume"),
    )
    sums = per_seller.groupBy("order_id").agg(
        total("price").alias("order_gmv"), total("freight").alias("order_freight"),
        F.sum("n").alias("item_count"), F.count("seller_id").alias("seller_count"),
        F.sum("weight").alias("total_weight_g"), F.max("volume").alias("max_volume_cm3"),
    )
    df = lookup(orders, sums, "order_id")
    return lookup(df, modes_per_group(items, "order_id", ("product_category", "seller_state")), "order_id")


def label(df: DataFrame, target: str) -> DataFrame:
    """``late_delivery`` on delivered orders, or ``repeat_purchase`` on first orders."""
    if target == "late_delivery":
        late = F.col("delivered_ts") > F.col("estimated_ts")
        return df.filter((F.col("order_status") == "delivered") & late.isNotNull()).withColumn("label", late.cast("int"))
    if target == "repeat_purchase":
        known = with_person_history(df.filter(F.col("customer_unique_id").isNotNull()))
        return known.filter("order_seq = 1").withColumn("label", (F.col("cust_total_orders") > 1).cast("int"))
    raise ValueError(f"unknown target {target!r}")


def engineer(df: DataFrame) -> DataFrame:
    """Calendar, lead-time and freight features known at purchase time."""
    same = F.coalesce(F.col("customer_state") == F.col("seller_state"), F.lit(False))
    return df.withColumns({
        "estimated_lead_days": elapsed_days("estimated_ts", "purchase_ts"),
        "purchase_dow": F.weekday("purchase_ts"),
        "purchase_month": F.month("purchase_ts"),
        "purchase_hour": F.hour("purchase_ts"),
        "freight_ratio": ratio(F.col("order_freight"), F.col("order_gmv")),
        "same_state": F.when(same, "same").otherwise("cross"),
    })


def features_only(df: DataFrame, keep: Sequence[str] = ("order_id", "label")) -> DataFrame:
    """Feature columns plus the named ones: nothing that leaks the outcome goes further."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in NUMERIC], *CATEGORICAL)


def split(df: DataFrame, id_col: str = "order_id", test_share: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test by a hash of id and label: the same rows on every run and retry.

    Each label is split by the same even hash, so the label shares of both parts agree.
    """
    slot = F.pmod(F.xxhash64(F.lit(seed), F.col("label"), F.col(id_col)), F.lit(10_000))
    test = slot < int(test_share * 10_000)
    return df.filter(~test), df.filter(test)


def balance(df: DataFrame) -> DataFrame:
    """``weight`` = rows / (classes * rows of the class)."""
    sizes = df.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    whole = sizes.agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_k"))
    weights = with_scalar(sizes, whole).select(
        "label", (F.col("_rows") / (F.col("_k") * F.col("_n"))).alias("weight")
    )
    return df.join(F.broadcast(weights), "label")


def common_levels(train: DataFrame, col: str, min_share: float = MIN_SHARE) -> DataFrame:
    """Levels that make up a share of the training rows: at most 1 / min_share of them, however many rows there are."""
    sizes = train.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.agg(F.sum("n").alias("_all"))
    return with_scalar(sizes, whole).filter(F.col(col).isNotNull() & (F.col("n") >= min_share * F.col("_all"))).drop("_all")


def fold_rare(df: DataFrame, levels: dict[str, DataFrame], modes: DataFrame) -> DataFrame:
    """Absent values become the training mode, levels not in ``levels`` become 'rare'."""
    df = with_scalar(df, modes)
    for col, common in levels.items():
        df = df.withColumn(col, F.coalesce(F.col(col), F.col(f"_mode_{col}"), F.lit("rare"))).drop(f"_mode_{col}")
        marks = common.select(col, F.lit(True).alias("_common"))
        df = lookup(df, F.broadcast(marks), col).withColumn(  # at most 1 / MIN_SHARE levels
            col, F.when(F.coalesce("_common", F.lit(False)), F.col(col)).otherwise("rare")
        ).drop("_common")
    return df


def training_modes(train: DataFrame) -> DataFrame:
    one = None
    for col in CATEGORICAL:
        mode = mode_per_group(train.withColumn("_all", F.lit(1)), ["_all"], col, "_m").agg(F.max("_m").alias(f"_mode_{col}"))
        one = mode if one is None else with_scalar(one, mode)
    return one


def estimator(model: str, params: dict | None = None):
    params = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight", **(params or {})}
    if model == "logistic_regression":
        return LogisticRegression(**{"maxIter": 50, **params})
    if model == "random_forest":
        return RandomForestClassifier(**{"numTrees": 50, "maxDepth": 6, "seed": SEED, **params})
    if model == "gradient_boosting":
        return GBTClassifier(**{"maxIter": 20, "maxDepth": 4, "seed": SEED, **params})
    raise ValueError(f"unknown model {model!r}")


def preparation() -> list:
    """Median fill and scaling of numbers, one-hot levels; a level unseen in training gets its own slot."""
    filled = [f"{c}_filled" for c in NUMERIC]
    coded, hot = [f"{c}_code" for c in CATEGORICAL], [f"{c}_hot" for c in CATEGORICAL]
    return [
        Imputer(strategy="median", inputCols=list(NUMERIC), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True),
        StringIndexer(inputCols=list(CATEGORICAL), outputCols=coded, handleInvalid="keep"),
        OneHotEncoder(inputCols=coded, outputCols=hot, handleInvalid="keep"),
        VectorAssembler(inputCols=["scaled", *hot], outputCol="features"),
    ]


def fit(train: DataFrame, model: str = "logistic_regression", params: dict | None = None) -> PipelineModel:
    return Pipeline(stages=[*preparation(), estimator(model, params)]).fit(train)


def search(train: DataFrame, model: str, grid: dict[str, Sequence], folds: int = 3) -> CrossValidator:
    """Cross-validated choice of parameters by area under the precision-recall curve."""
    last = estimator(model)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(last, name), list(values))
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR")
    return CrossValidator(
        estimator=Pipeline(stages=[*preparation(), last]), estimatorParamMaps=builder.build(),
        evaluator=judge, numFolds=folds, seed=SEED,
    ).fit(train)


def with_folds(df: DataFrame, folds: int, id_col: str = "order_id", column: str = "fold") -> DataFrame:
    """Adds a fold from 0 by a hash of label and id: the same on every run, and with the same label shares in each."""
    digest = F.md5(F.concat_ws("|", F.col("label").cast("string"), F.col(id_col).cast("string")))
    return df.withColumn(column, (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % folds).cast("int"))


def random_search(
    train: DataFrame, model: str, space: dict[str, Sequence], draws: int = 10, seed: int = SEED, folds: int = 3, parallel: int = 4
) -> tuple[PipelineModel, list[tuple[dict, float]]]:
    """The best of some random draws of parameters, fitted on all rows, and each draw with its mean area under the
    precision-recall curve over stratified folds.

    Draws come from a seeded generator; equal ones are fitted once. Each is fitted on all folds but one and judged on that one,
    ``parallel`` at a time. The features of a fold do not depend on the draw: they are learned from its training rows
    and stored once, and all draws read them.
    """
    picker, last = random.Random(seed), estimator(model)
    drawn = [{name: picker.choice(list(values)) for name, values in space.items()} for _ in range(draws)]
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR", numBins=0)  # every score is a cut
    rows = stored(with_folds(train, folds), "folds")
    different = [params for i, params in enumerate(drawn) if params not in drawn[:i]]
    areas = [0.0] * len(different)
    for fold in range(folds):
        fitted_on, judged_on = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
        for part, kind in ((fitted_on, "training"), (judged_on, "validation")):
            if part.isEmpty():
                raise ValueError(f"The {kind} data at fold {fold} is empty.")
        ready = Pipeline(stages=preparation()).fit(fitted_on)
        fitted_on, judged_on = (
            stored(ready.transform(part).select("features", "label", "weight"), "features") for part in (fitted_on, judged_on))

        def judged(params: dict) -> float:
            model = last.fit(fitted_on, {getattr(last, name): value for name, value in params.items()})
            return judge.evaluate(model.transform(judged_on))

        with ThreadPool(min(parallel, len(different))) as pool:
            areas = [a + b / folds for a, b in zip(areas, pool.map(inheritable_thread_target(rows.sparkSession)(judged), different, chunksize=1))]
    tried = [(params, areas[different.index(params)]) for params in drawn]
    best = max(range(len(tried)), key=lambda i: tried[i][1])
    return Pipeline(stages=[*preparation(), last.copy({getattr(last, n): v for n, v in drawn[best].items()})]).fit(rows), tried


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """order_id, label, probability of the positive class."""
    return model.transform(df).select("order_id", "label", vector_to_array("probability")[1].alias("score"))


def threshold_table(scored: DataFrame) -> DataFrame:
    """Recall and precision when cutting at each score that occurs; equal scores are cut together."""
    at = scored.groupBy(F.col("score").alias("threshold")).agg(
        F.sum(F.col("label").cast("bigint")).alias("_pos"), F.count(F.lit(1)).alias("_n")
    )
    totals = running_totals(at, [F.col("threshold").desc()], {"tp": "_pos", "flagged": "_n"})
    whole = scored.agg(F.sum(F.col("label").cast("bigint")).alias("_all"))
    return with_scalar(totals, whole).select(
        "threshold", "tp", "flagged",
        ratio(F.col("tp"), F.col("_all")).alias("recall"), ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        F.col("_pos").alias("gained"), (F.col("_n") - F.col("_pos")).alias("gained_fp"),
    )


def pick_threshold(scored: DataFrame, min_recall: float = 0.7, default: float = 0.5) -> DataFrame:
    """The cut of highest precision with enough recall (the highest such cut on ties), else the default."""
    return best_threshold(threshold_table(scored), min_recall, default)


def best_threshold(table: DataFrame, min_recall: float, default: float = 0.5) -> DataFrame:
    good = table.filter(F.col("recall") >= min_recall)
    return good.agg(F.coalesce(F.max(F.struct("precision", "threshold"))["threshold"], F.lit(default)).alias("threshold"))


def metrics(scored: DataFrame, min_recall: float = 0.7) -> DataFrame:
    """One row: threshold, confusion counts, recall, precision, F1, PR-AUC and ROC-AUC.

    All come from the exact threshold table, which is stored once; nothing is sorted in one task.
    """
    table = cut_lineage(threshold_table(scored))
    cut = best_threshold(table, min_recall)
    hit, pos = F.col("score") >= F.col("threshold"), F.col("label") == 1
    counts = with_scalar(scored, cut).groupBy("threshold").agg(
        F.count(F.lit(1)).alias("n_test"),
        F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    row = counts.withColumns({
        "positive_rate": ratio(tp + fn, F.col("n_test")),
        "recall_pos": ratio(tp, tp + fn),
        "precision_pos": ratio(tp, tp + fp),
        "f1_pos": ratio(2 * tp, 2 * tp + fp + fn),
    })
    return with_scalar(row, areas(table))


def areas(table: DataFrame) -> DataFrame:
    """pr_auc (average precision) and roc_auc (trapezoids) of a threshold table."""
    widths = F.col("gained_fp") * (2 * F.col("tp") - F.col("gained")) / 2
    positives, negatives = F.sum("gained"), F.sum("gained_fp")
    return table.agg(
        ratio(F.sum(F.col("gained") * F.col("precision")), positives).alias("pr_auc"),
        F.try_divide(F.sum(widths), (positives * negatives).cast("double")).alias("roc_auc"),
    )


def importances(model: PipelineModel, df: DataFrame, top: int = 20) -> DataFrame:
    """Feature names with importance (trees) or absolute coefficient (logistic), greatest first.

    The list is as long as the feature vector, not as the data.
    """
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    attrs = model.transform(df).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    rows = [(names.get(i, f"f{i}"), abs(float(v))) for i, v in enumerate(values.toArray())]
    out = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return out.orderBy(F.col("importance").desc(), "feature").limit(top)


def prepared(tables, target: str) -> tuple[DataFrame, DataFrame]:
    """Balanced train and plain test frames with rare levels folded by the training rows.

    Orders are labelled before their items are looked at, as only labelled ones count. The feature rows, the common levels and the modes are computed once and stored: fitting reads the rows many times, by column.
    """
    orders = stored(label(order_base(tables, ("customers",)), target), "labelled")
    train, test = split(stored(features_only(engineer(with_items(orders, tables, orders.select("order_id")))), "features"))
    levels = {c: cut_lineage(common_levels(train, c)) for c in CATEGORICAL}
    modes = cut_lineage(training_modes(train))
    return stored(balance(fold_rare(train, levels, modes)), "train"), stored(fold_rare(test, levels, modes), "test")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


