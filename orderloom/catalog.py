"""Every operator as a named query over a folder of Parquet tables: ``QUERIES[name](spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom import schemas
from orderloom.bindings import RAW, Tables
from orderloom.functions import clean, dates, labels
from orderloom.operators import aggregates as agg, dedup, history, impute, joins, quality, ranking
from orderloom.plans import (
    audits, boosting, business, cleaning, delivery, kpis, layers, learning, orders as base, retention, semantic, stage, star, words,
)
from orderloom.session import apply_settings, cut_lineage, scratch_path
from orderloom.sources import files, tables as store
from orderloom.streaming import loads

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.datetime(2001, 9, 1)
BOOKMARK = dt.datetime(2024, 1, 15)
SECOND_CUT = dt.datetime(2024, 2, 1)  # after the newest event
STATES = [f"NATION_{i}" for i in range(25)]
COHORT_MONTHS = 84


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register under the function's name; the function gets the stage tables of the folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(apply_settings(spark), sf_dir))

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


def raw(t: Tables) -> Tables:
    return Tables(t.spark, t.sf_dir, staged=False)


def read(t: Tables, name: str) -> DataFrame:
    return t.spark.read.parquet(f"{t.sf_dir}/{name}.parquet")


def ts(moment: dt.datetime):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def fact(t: Tables, paid: bool = True) -> DataFrame:
    return star.fact_orders(
        t["orders"], t["order_items"], t["order_payments"] if paid else None, ts(AS_OF), counted=raw(t)["order_items"])


def category_sales(t: Tables) -> DataFrame:
    return base.category_sales(t, raw(t)["order_items"])


def categories(t: Tables) -> DataFrame:
    """product_id, English category."""
    named = star.product_attributes(t["products"], t["product_category_name_translation"])
    return named.select("product_id", "product_category")


def scores(t: Tables) -> DataFrame:
    """One current review per order, keyed like the fact."""
    return stage.latest_reviews(t["order_reviews"]).select(F.col("order_id").alias("id"), "review_score")


def states_at(t: Tables, moment: dt.datetime) -> DataFrame:
    """The newest event of each user up to a moment: a source table as it stood then."""
    seen = read(t, "events").filter(F.col("ts") <= ts(moment))
    newest = dedup.latest_per_key(seen.select("user_id", "ts", "event_type", "event_id"), ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_type", F.col("ts").alias("updated_at"))


def document_scores(t: Tables) -> DataFrame:
    """Texts with a score: 5 for good, 1 for bad documents, NULL where nobody judged."""
    marks = read(t, "labels").select("doc_id", F.when(F.col("quality") == 1, 5).otherwise(1).alias("review_score"))
    return joins.lookup(read(t, "documents").select("doc_id", "text", "lang"), marks, "doc_id")


# Loading ---------------------------------------------------------------------------------------


@query
def table_counts(t):
    return store.table_counts({n: raw(t)[n] for n in schemas.KEYS if n != "product_category_name_translation"})


@query
def row_reconcile(t):
    names = ("orders", "order_items", "order_payments", "order_reviews", "customers", "products", "sellers")
    return store.reconcile({n: raw(t)[n] for n in names}, {n: t[n] for n in names})


@query
def audit_stamped(t):
    df = store.audit_columns(raw(t)["customers"], dt.datetime(2024, 1, 1, 12), "batch_1", "customers.csv", "Asia/Singapore")
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")})


@query
def upsert_result(t):
    old = states_at(t, BOOKMARK).withColumn("created_at", F.col("updated_at"))
    events = loads.increment(read(t, "events").withColumnRenamed("ts", "updated_at"), ts(BOOKMARK))
    batch = events.select("user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "updated_at", "event_id")
    batch = batch.withColumn("created_at", F.col("updated_at"))
    return store.upsert(old, batch, ["user_id"], ["updated_at", "event_id"])


@query
def increment_rows(t):
    fresh = loads.increment(read(t, "events"), ts(BOOKMARK), "ts")
    return fresh.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("bookmark")
    )


@query
def flatten_json(t):
    parsed = read(t, "events").select("event_id", F.from_json("props", "k bigint").alias("props"))
    return files.flatten_once(parsed)


@query
def child_rows(t):
    return files.children_of(raw(t)["orders"], t["order_items"], "order_id", "order_id").select("order_id", "order_item_id", "product_id")


@query
def load_modes(t):
    """Sellers after each load mode: rows and distinct cities of the table."""
    path = scratch_path(t.spark, "load-modes")
    sellers = raw(t)["sellers"]
    moved = sellers.filter(F.col("seller_id") % 2 == 0).withColumn("seller_city", F.lit("moved"))
    steps = []
    for mode, batch in (("replace", sellers), ("append", moved), ("replace", sellers), ("upsert", moved)):
        store.write_table(batch, path, mode, ["seller_id"] if mode == "upsert" else ())
        row = store.read_table(t.spark, path).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("seller_city") == "moved").alias("moved")).first()
        steps.append((len(steps) + 1, mode, row.n, row.moved))
    return t.spark.createDataFrame(steps, "step int, mode string, n_rows bigint, n_moved bigint")


@query
def csv_all_text(t):
    """A file of texts only keeps its columns as strings; one with numbers gets types; records are counted by the parser."""
    texts, mixed = scratch_path(t.spark, "texts-csv"), scratch_path(t.spark, "mixed-csv")
    store.export_csv(raw(t)["customers"].select("customer_city", "customer_state"), texts)
    store.export_csv(raw(t)["sellers"].select("seller_id", "seller_city"), mixed)
    rows = [
        (name, ",".join(f"{c}:{k}" for c, k in files.load_csv_auto(t.spark, path).dtypes), files.csv_records(t.spark, path))
        for name, path in (("texts", texts), ("mixed", mixed))
    ]
    return t.spark.createDataFrame(rows, "file string, columns string, n_records bigint")


@query
def typed_orders(t):
    """Orders exported as texts and typed again; every seventh is soft-deleted, every fifth has an unreadable moment."""
    path = scratch_path(t.spark, "orders-csv")
    key = F.col("order_id")
    texts = raw(t)["orders"].select(
        F.concat(F.lit(" "), key.cast("string")).alias("order_id"), F.col("customer_id").cast("string").alias("customer_id"),
        F.upper("order_status").alias("order_status"),
        F.when(key % 5 == 0, F.lit("soon")).otherwise(F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")).alias("order_purchase_timestamp"),
        (key % 7 == 0).alias("is_deleted"))
    store.export_csv(texts, path)
    loaded = files.load_csv(t.spark, path).withColumn("is_deleted", clean.to_bool("is_deleted"))
    return stage.typed_table("orders", loaded).select(
        F.col("order_id").cast("bigint").alias("order_id"), "order_status", "order_purchase_timestamp", "order_approved_at")


@query
def active_rows(t):
    marked = read(t, "events").withColumn("is_deleted", F.when(F.col("event_id") % 10 == 0, True).when(F.col("event_id") % 10 == 1, False))
    return clean.not_deleted(marked).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def latest_by_sequence(t):
    """Reviews by load sequence: here the later answer was loaded first."""
    loaded = raw(t)["order_reviews"].withColumn("_sdc_sequence", -F.unix_micros(F.col("review_answer_timestamp").cast("timestamp")))
    return stage.stage_table("order_reviews", loaded).select("review_id", "review_score", "review_answer_timestamp")


@query
def landing_names(t):
    return read(t, "pages").select("page_id", files.table_name(F.col("url")).alias("table_name"))


@query
def csv_round_trip(t):
    """Export reviews as CSV (texts with quotes and braces) and load them with a schema."""
    path = scratch_path(t.spark, "reviews-csv")
    df = raw(t)["order_reviews"].select("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message")
    store.export_csv(df, path)
    return files.load_csv(
        t.spark, path,
        "review_id bigint, order_id bigint, review_score int, review_comment_title string, review_comment_message string",
    )


@query
def json_lines_round_trip(t):
    path = scratch_path(t.spark, "sellers-jsonl")
    store.write_json_lines(raw(t)["sellers"], path)
    return files.load_json_lines(
        t.spark, path, "seller_id bigint, seller_zip_code_prefix string, seller_city string, seller_state string"
    )


@query
def stored_result(t):
    """Monthly orders written once and read back from the stored copy."""
    path = scratch_path(t.spark, "monthly")
    build = lambda: base.order_base(t, ()).groupBy("order_month").agg(F.count(F.lit(1)).alias("orders"))
    store.cached_result(t.spark, path, build)
    return store.cached_result(t.spark, path, build, max_age_seconds=3600)


@query
def layer_rebuild(t):
    """All layers from raw tables to checks below a fresh folder; rows of each gold table."""
    tables = {n: raw(t)[n] for n in RAW}
    out = layers.run(t.spark, tables, scratch_path(t.spark, "warehouse"), AS_OF)
    names = ("fact_orders", "dim_customers", "dim_sellers", "dim_date", "dim_products", "orders_enriched")
    return store.table_counts({n: out[n] for n in names})


def event_files(t: Tables) -> tuple[str, DataFrame]:
    """Events as change files of several days, the form a stream picks up."""
    path = scratch_path(t.spark, "events-in")
    events = user_events(t)
    events.repartitionByRange(6, "updated_at").write.parquet(path)
    return path, events


@query
def stream_upsert(t):
    source, events = event_files(t)
    target = scratch_path(t.spark, "users")
    loads.stream_upsert(
        t.spark, source, events.schema, target, ["user_id"], "updated_at", scratch_path(t.spark, "state"), max_files=2
    ).awaitTermination()
    out = loads.read_upserted(t.spark, target)
    return out.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def user_events(t: Tables) -> DataFrame:
    return read(t, "events").select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("updated_at"))


@query
def incremental_load(t):
    """Newest event of each user, loaded in runs up to several days, one of them twice; rows and bookmark are one version."""
    target = scratch_path(t.spark, "users")
    for last in (dt.datetime(2024, 1, 5), BOOKMARK, BOOKMARK, SECOND_CUT, None):
        seen = user_events(t) if last is None else user_events(t).filter(F.col("updated_at") <= ts(last).cast("timestamp"))
        loads.load_increment(seen, target, ["user_id"])
    table = store.versioned(t.spark, target)
    reached = F.lit(table.mark("bookmark")).cast("timestamp_ntz").alias("bookmark")
    return table.read().select("user_id", "event_id", "event_type", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), reached)


@query
def keyed_parts(t):
    """Events merged into a keyed table in runs: rows so far, whether all parts keep to their bound and whether a run wrote
    no more parts than it had keys."""
    table, bound, steps = store.versioned(t.spark, scratch_path(t.spark, "events")), 200, []
    days = [None, dt.datetime(2024, 1, 5), BOOKMARK, BOOKMARK + dt.timedelta(minutes=30), SECOND_CUT]
    for step, (after, last) in enumerate(zip(days, days[1:]), 1):
        until = user_events(t).filter(F.col("updated_at") <= ts(last).cast("timestamp"))
        run = until if after is None else until.filter(F.col("updated_at") > ts(after).cast("timestamp"))
        former = set(table.latest().parts) if table.exists() else set()
        version = table.merge(run, ["event_id"], newer="updated_at", part_rows=bound)
        bounded = all(p.rows <= 2 * bound for p in version.parts)
        steps.append((step, version.rows, bounded, len(former - set(version.parts)) <= run.count()))
    return t.spark.createDataFrame(steps, "step int, n_rows bigint, bounded boolean, rewrites_bounded boolean")


@query
def table_versions(t):
    """Sellers replaced, grown and replaced from themselves; every version still holds its own rows."""
    table, sellers = store.versioned(t.spark, scratch_path(t.spark, "sellers")), raw(t)["sellers"]
    table.replace(sellers)
    table.append(sellers.filter(F.col("seller_id") % 2 == 0).drop("seller_city"))
    table.replace(table.read().filter(F.col("seller_city").isNull()))
    return store.table_counts({str(n): table.read(n) for n in table.numbers()}).withColumnRenamed("table_name", "version")


@query
def stream_append(t):
    source, events = event_files(t)
    target = scratch_path(t.spark, "events-out")
    loads.stream_append(t.spark, source, events.schema, target, scratch_path(t.spark, "state"), max_files=2).awaitTermination()
    out = t.spark.read.schema(events.schema).parquet(target)
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"))


# Cleaning ------------------------------------------------------------------------------------


@query
def clean_columns(t):
    return read(t, "part").select(
        clean.clean_id("p_partkey").alias("product_id"),
        clean.lower_text("p_type").alias("type"),
        clean.upper_text("p_name").alias("name"),
        clean.placeholder_to_null("p_brand", ["Brand#1", "n/a", ""]).alias("brand"),
        clean.to_bool((F.col("p_size") > 25).cast("string")).alias("is_big"),
        F.coalesce(F.nullif("p_type", F.lit("PROMO")), F.lit("unknown")).alias("type_or_default"),
        labels.value_tier("p_retailprice").alias("tier"),
    )


@query
def strip_text(t):
    return clean.strip_all_text(read(t, "nation").join(read(t, "customer"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"), F.concat("n_name", F.lit(" ")).alias("n_name")
    ))


@query
def safe_casts(t):
    parts = F.split("o_orderpriority", "-")
    return read(t, "orders").select(
        "o_orderkey",
        clean.safe_cast(parts[0], "int").alias("rank_no"),
        clean.safe_cast(parts[1], "int").alias("not_a_number"),
        clean.parse_timestamp(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").cast("timestamp_ntz").alias("parsed"),
        clean.parse_timestamp(F.col("o_orderpriority"), "yyyy-MM-dd").cast("timestamp_ntz").alias("unparsed"),
    )


@query
def numeric_clean(t):
    return read(t, "customer").select(
        "c_custkey",
        clean.clamp_null("c_acctbal", lo=0, hi=5000).alias("clamped"),
        clean.clamp_null("c_acctbal", lo=0, lo_open=True).alias("positive"),
        clean.clamp_null("c_nationkey", sentinels=[0, 7]).alias("nation_or_null"),
        clean.zip_text("c_nationkey").alias("zip"),
    )


@query
def complete_rows(t):
    p = raw(t)["products"].select("product_id", "product_weight_g", "product_length_cm")
    return p.select(
        "product_id",
        F.col("product_weight_g").isNotNull().alias("is_complete"),
        F.coalesce("product_weight_g", F.lit(0)).alias("weight_or_zero"),
    ).join(p.dropna(subset=["product_weight_g"]).select("product_id", "product_length_cm"), "product_id", "left")


@query
def null_fill_median(t):
    return impute.impute(t["products"].select("product_id", "product_weight_g"), median_cols=["product_weight_g"])


@query
def null_fill_mode(t):
    payments = t["order_payments"].select("order_id", "payment_sequential", "payment_type")
    return impute.impute(payments, mode_cols=["payment_type"])


@query
def cleaned_table(t):
    o = read(t, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("category"),
        F.when(F.col("o_totalprice") > 20000, F.col("o_totalprice")).otherwise(F.lit(-999.0)).alias("amount"),
        F.col("o_orderdate").alias("ordered_at"),
        (F.col("o_orderdate") + F.expr("make_dt_interval(CAST(o_orderkey % 3 AS INT) - 1)")).alias("created_at"),
    )
    return cleaning.clean_table(
        o, ["order_id"], ["created_at", "amount"], ["category"], "amount", "category", "created_at", "ordered_at"
    )


@query
def order_slice(t):
    df = base.order_base(t, ("items", "customers"))
    part = base.slice_orders(df, "1996-03-01", "1998-08-01", STATES[:5])
    return part.groupBy("order_month", "customer_state").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("gmv"), 2).alias("gmv")
    )


@query
def month_bounds(t):
    return base.month_bounds(base.order_base(t, ()))


@query
def state_list(t):
    return base.state_list(base.order_base(t, ("customers",)))


@query
def place_override(t):
    places = stage.stage_geolocation(raw(t)["geolocation"].select("zip_code_prefix", "city", "state", "lat"), latest="lat")
    return star.override_places(t["sellers"], places)


# De-duplication ---------------------------------------------------------------------------------


@query
def dedup_latest(t):
    return stage.stage_table("order_reviews", raw(t)["order_reviews"])


@query
def dedup_composite(t):
    df = stage.stage_table("order_items", raw(t)["order_items"])
    return df.withColumns({"price": F.col("price").cast("double"), "freight_value": F.col("freight_value").cast("double")})


@query
def dedup_any(t):
    geo = raw(t)["geolocation"]
    one = dedup.latest_per_key(geo, ["zip_code_prefix"])
    return one.withColumns({c: F.col(c).cast("double") for c in ("lat", "lng")})


@query
def dedup_many_columns(t):
    events = read(t, "events").select("user_id", "event_type", "value", "ts", "event_id")
    return dedup.latest_per_key(events, ["user_id", "event_type"], ["value", "ts"])


@query
def last_payment(t):
    return stage.last_payments(t["order_payments"]).withColumn("payment_value", F.col("payment_value").cast("double"))


@query
def distinct_places(t):
    return raw(t)["geolocation"].select("city", "state").distinct()


@query
def dup_audit(t):
    r = raw(t)
    names = ("orders", "order_items", "order_payments", "order_reviews", "customers")
    return dedup.audit_tables({n: (r[n], schemas.KEYS[n][0]) for n in names})


@query
def full_row_duplicates(t):
    return dedup.duplicate_rows(read(t, "documents").select("text", "lang"))


@query
def dropped_duplicates(t):
    """Raw items that stage de-duplication leaves out: a table difference with counts kept."""
    cols = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date"]
    gone = raw(t)["order_items"].select(*cols).exceptAll(t["order_items"].select(*cols))
    return gone.groupBy("order_item_id").agg(F.count(F.lit(1)).alias("n"))


# Star schema -------------------------------------------------------------------------------------


@query
def fact_orders(t):
    df = fact(t)
    return df.withColumns({c: F.col(c).cast("double") for c in ("price", "freight_value", "payment_value")})


@query
def fact_orders_summed(t):
    """The fact with payment totals instead of the last payment."""
    df = star.fact_orders(t["orders"], t["order_items"], t["order_payments"], ts(AS_OF), payment_policy="sum", counted=raw(t)["order_items"])
    per_order = df.select("id", "order_status", "payment_value").distinct()
    return per_order.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"), clean.total("payment_value").alias("paid")
    )


@query
def dq_flags(t):
    flags = list(star.quality_flags(ts(AS_OF)))
    return fact(t).groupBy("order_status").agg(
        F.count(F.lit(1)).alias("rows"), *[clean.count_true(f).alias(f) for f in flags]
    )


@query
def fact_sales_alloc(t):
    df = star.fact_sales(t["orders"], t["order_items"], t["order_payments"], t["order_reviews"])
    money = {c: F.col(c).cast("double") for c in ("price", "freight_value", "total_sale_amount")}
    return df.withColumns({**money, "allocated_payment_value": F.round("allocated_payment_value", 4)})


@query
def order_lines(t):
    df = star.fct_order_items(t["orders"], t["order_items"])
    return df.withColumns({c: F.col(c).cast("double") for c in ("price", "freight_value", "total_line_value")})


@query
def dim_customers(t):
    return star.dim_customers(t["customers"])


@query
def dim_sellers(t):
    return star.dim_sellers(t["sellers"], t["geolocation"])


def product_history(t: Tables) -> DataFrame:
    """Two product snapshots: in the second the heavier half weighs a kilogram more."""
    first = t["products"]
    second = first.withColumn(
        "product_weight_g", F.when(F.col("product_weight_g") >= 2500, F.col("product_weight_g") + 1000).otherwise(F.col("product_weight_g"))
    )
    start = history.open_versions(first, ["product_id"], ts(dt.datetime(2000, 1, 1)))
    cols = ["product_category_name", "product_weight_g", "product_length_cm"]
    return history.scd2_check(start, second, ["product_id"], cols, ts(dt.datetime(2000, 6, 1)))


@query
def dim_products(t):
    df = star.dim_products(product_history(t), t["product_category_name_translation"])
    return df.select(
        "surrogate_key", "product_id", "product_category", "category", "product_weight_g", "valid_from", "valid_to", "is_current"
    )


@query
def current_product_sales(t):
    """Sales joined to the current product version only, so no item counts twice."""
    current = history.current_versions(product_history(t)).select("product_id", "product_category_name", "product_weight_g")
    df = joins.lookup(star.clean_items(t["order_items"]), current, "product_id")
    return df.groupBy("product_category_name").agg(
        F.count(F.lit(1)).alias("items"), clean.total("price").alias("revenue"), F.sum("product_weight_g").alias("weight_g")
    )


@query
def dim_reviews(t):
    checks = ["review_score", "review_comment_title", "review_comment_message"]
    versions = history.scd2_rebuild(raw(t)["order_reviews"], ["review_id"], "review_answer_timestamp", checks)
    return versions.drop("last_seen")


@query
def dim_location(t):
    return star.dim_location(raw(t)["geolocation"])


@query
def dim_date(t):
    return star.dim_date(t.spark, t["orders"])


@query
def analysis_orders(t):
    df = star.analysis_orders(t["orders"], t["customers"], t["order_payments"], t["order_items"], t["order_reviews"], t["geolocation"])
    return df.select(
        "order_id", "customer_id", "customer_state", "total_paid", "total_items", "total_price", "total_freight",
        "avg_review_score", "lat", "lng",
    )


@query
def analysis_payments(t):
    df = star.analysis_payments(t["order_payments"], t["orders"], t["customers"])
    return df.withColumn("payment_value", F.col("payment_value").cast("double"))


@query
def analysis_products(t):
    df = star.analysis_products(
        t["order_items"], t["products"], t["product_category_name_translation"], t["sellers"], t["orders"]
    )
    return df.select(
        "order_id", "order_item_id", "product_id", "seller_id", "product_category", "seller_state", "order_status",
        F.col("price").cast("double").alias("price"), "product_weight_g",
    )


@query
def denormalised(t):
    reviews = t["order_reviews"].select("order_id", "review_id", "review_score")
    df = star.denormalised(t["orders"], t["order_items"], t["order_payments"], reviews, t["customers"], t["products"], raw(t))
    return df.groupBy("order_status", "customer_state").agg(
        F.count(F.lit(1)).alias("rows"), F.count("product_id").alias("items"), F.count("review_id").alias("reviews"),
        clean.total("price").alias("price"),
    )


@query
def monthly_revenue_mart(t):
    return business.monthly_revenue_mart(fact(t, paid=False), categories(t))


# History ------------------------------------------------------------------------------------------


@query
def scd2_rebuild(t):
    log = read(t, "events").select("user_id", "event_type", "ts")
    return history.scd2_rebuild(log, ["user_id"], "ts", ["event_type"])


@query
def scd2_changes(t):
    log = read(t, "events").select("user_id", "event_id", "ts", "event_type")
    return history.scd2_changes(log, ["user_id"], "ts", ["event_id"])


@query
def scd2_current(t):
    log = read(t, "events").select("user_id", "event_id", "ts", "event_type")
    return history.current_versions(history.scd2_changes(log, ["user_id"], "ts", ["event_id"])).drop("valid_to", "is_current")


@query
def scd2_check(t):
    start = history.open_versions(states_at(t, BOOKMARK), ["user_id"], ts(BOOKMARK))
    return history.scd2_check(start, states_at(t, SECOND_CUT), ["user_id"], ["event_type"], ts(SECOND_CUT))


@query
def scd2_timestamp(t):
    start = history.start_history(states_at(t, BOOKMARK), ["user_id"], "updated_at")
    return history.scd2_timestamp(start, states_at(t, SECOND_CUT), ["user_id"], "updated_at")


def snapshots(first: DataFrame, key: str, column: str) -> DataFrame:
    """Two snapshots of a table by the check strategy; in the second every third row has another value."""
    second = first.withColumn(column, F.when(F.col(key) % 3 == 0, F.lit("moved")).otherwise(F.col(column)))
    start = history.open_versions(first, [key], ts(dt.datetime(2000, 1, 1)))
    return history.scd2_check(start, second, [key], [column], ts(dt.datetime(2000, 6, 1)))


@query
def snapshot_sellers(t):
    return snapshots(t["sellers"], "seller_id", "seller_city").select("seller_id", "seller_city", "valid_from", "valid_to")


@query
def snapshot_customers(t):
    people = t["customers"].select("customer_id", "customer_state", "customer_city")
    return snapshots(people, "customer_id", "customer_city").select("customer_id", "customer_city", "valid_from", "valid_to")


@query
def snapshot_fact(t):
    """Two snapshots of the fact by purchase month; in the second orders of one month have another status."""
    bought = F.col("order_purchase_timestamp")
    month = (F.year(bought) * 100 + F.month(bought)).cast("bigint")
    first = cut_lineage(fact(t, paid=False).select("id", "order_item_id", "order_status", "price", bought))
    returned = F.when((month == 199603) & (F.col("id") % 3 == 0), F.lit("returned")).otherwise(F.col("order_status"))
    table = store.versioned(t.spark, scratch_path(t.spark, "fact-history"))
    for rows, moment in ((first, dt.datetime(2000, 1, 1)), (first.withColumn("order_status", returned), dt.datetime(2000, 6, 1))):
        history.snapshot_parts(table, rows, ["id", "order_item_id"], ["order_status", "price"], month, ts(moment))
    return table.read().select("id", "order_item_id", "order_status", "valid_from", "valid_to")


@query
def dim_geolocation(t):
    """Place versions: each zip's city as it changes along its points."""
    places = raw(t)["geolocation"].withColumn("seen_at", F.timestamp_seconds(F.abs(F.col("lat")).cast("bigint") * 86_400).cast("timestamp_ntz"))
    versions = history.scd2_rebuild(places, ["zip_code_prefix"], "seen_at", ["city", "state"])
    versions = versions.withColumn("version_id", history.version_id(["zip_code_prefix"], "valid_from"))
    return star.dim_versions(versions.drop("last_seen", "is_current"))


@query
def scd2_hard_delete(t):
    """Users whose newest event is an error count as deleted from the second snapshot."""
    start = history.open_versions(states_at(t, BOOKMARK), ["user_id"], ts(BOOKMARK))
    later = states_at(t, SECOND_CUT).filter(F.col("event_type") != "error")
    return history.scd2_check(start, later, ["user_id"], ["event_type"], ts(SECOND_CUT), hard_deletes=True)


@query
def latest_version(t):
    return stage.latest_reviews(raw(t)["order_reviews"], per="review_id").select(
        "review_id", "order_id", "review_score", "review_answer_timestamp"
    )


# Aggregates ------------------------------------------------------------------------------------


@query
def payments_rollup(t):
    return agg.payments_rollup(t["order_payments"])


@query
def reviews_rollup(t):
    return agg.reviews_rollup(stage.typed_reviews(t["order_reviews"]))


@query
def payments_latest(t):
    """Payments of an order follow its purchase by the hour; the rollup tells the last one."""
    bought = t["orders"].select("order_id", "order_purchase_timestamp")
    hours = F.make_dt_interval(hours=F.col("payment_sequential"))
    paid = joins.lookup(t["order_payments"], bought, "order_id").withColumn("updated_at", F.col("order_purchase_timestamp") + hours)
    return agg.payments_rollup(paid, "updated_at").select("order_id", "payment_record_count", "latest_update")


@query
def geo_latest(t):
    """Places with the last purchase from their zip."""
    zips = t["customers"].select("customer_id", F.col("customer_zip_code_prefix").alias("zip_code_prefix"))
    bought = joins.lookup(t["orders"].select("customer_id", "order_purchase_timestamp"), zips, "customer_id")
    newest = bought.groupBy("zip_code_prefix").agg(F.max("order_purchase_timestamp").alias("updated_at"))
    points = joins.lookup(raw(t)["geolocation"], newest, "zip_code_prefix")
    return agg.geo_rollup(points, updated="updated_at").select("zip_code_prefix", "city", "state", "n_points", "latest_update")


@query
def marked_csv(t):
    """Sellers written with a byte-order mark before the header and read back by their names."""
    path = scratch_path(t.spark, "marked-csv")
    sellers = raw(t)["sellers"].select(F.col("seller_id").alias("\ufeffseller_id"), "seller_city", "seller_state")
    store.export_csv(sellers, path)
    return files.load_csv_auto(t.spark, path).select("seller_id", "seller_city", "seller_state")


@query
def stream_tables(t):
    """Landing table of each event stream."""
    kinds = read(t, "events").select("event_type").distinct().collect()
    names = store.landing_names([f"public-{kind}" for kind, in kinds])
    return t.spark.createDataFrame(sorted(names.items()), "stream string, table_name string")


@query
def geo_rollup(t):
    return agg.geo_rollup(raw(t)["geolocation"])


@query
def mode_per_group(t):
    return agg.mode_per_group(t["order_payments"].join(t["orders"], "order_id"), ["customer_id"], "payment_type")


@query
def null_share(t):
    return agg.null_share(t["orders"].join(t["order_payments"], "order_id", "left"), [
        "order_status", "order_approved_at", "order_delivered_customer_date", "payment_type", "payment_value",
    ])


@query
def value_counts(t):
    return agg.value_counts(t["order_payments"], "payment_type")


@query
def describe_numeric(t):
    df = agg.describe_numeric(t["order_items"], ["price", "freight_value", "order_item_id"])
    return df.withColumns({"std": F.round("std", 4)})


@query
def describe_quartiles(t):
    return agg.describe_quartiles(t["order_items"], ["price", "freight_value", "order_item_id"])


@query
def newest_day_events(t):
    """Each user's events of the newest day they were seen: ties stay."""
    events = read(t, "events").select("user_id", "event_id", F.to_date("ts").alias("day"))
    return ranking.first_with_ties(events, ["user_id"], [F.col("day").desc()])


@query
def first_values(t):
    """Per user the first known event type (errors are unknown) and the first value above 50."""
    events = read(t, "events").select(
        "user_id", "ts", "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), F.when(F.col("value") > 50, F.col("value")).alias("value"))
    return agg.first_present(events, ["user_id"], ["ts", "event_id"], ["event_type", "value"])


@query
def describe_text(t):
    return agg.describe_text(t["orders"].select("order_id", "order_status").join(
        t["order_payments"].select("order_id", "payment_type"), "order_id"), ["order_status", "payment_type"])


@query
def status_pivot(t):
    months = base.order_base(t, ()).withColumn("n", F.lit(1))
    return agg.pivot_sum(months, ["order_month"], "order_status", ["delivered", "shipped", "processing"], F.sum("n"))


@query
def price_quartiles(t):
    return ranking.exact_quantiles(t["order_items"], "price", [0.25, 0.5, 0.75, 0.99])


@query
def median_weight_by_category(t):
    return agg.weighted_median(t["products"], ["product_category_name"], "product_weight_g", "median_weight")


@query
def weight_quartile_bands(t):
    """Products in four bands of weight; equal weights share a band."""
    df = ranking.quantile_bucket(t["products"].select("product_id", "product_weight_g"), "product_weight_g", 4, "band", ties="share")
    return df


@query
def price_ranks(t):
    """Products numbered by price over the whole table, in one of ten equal buckets."""
    parts = read(t, "part").select("p_partkey", "p_retailprice")
    ranked = ranking.global_rank(parts, [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], "price_rank")
    return ranking.quantile_bucket(ranked, "p_retailprice", 10, "decile", tiebreak=["p_partkey"])


@query
def freight_ols(t):
    return business.freight_trend(base.order_base(t, ("items",))).select(
        "n", *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2", "corr")]
    )


@query
def weight_ols(t):
    return business.weight_trend(t["order_items"], t["products"]).select(
        "n", *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2", "corr")]
    )


@query
def review_share(t):
    return delivery.score_shares(t["order_reviews"])


# Orders and KPIs ------------------------------------------------------------------------------------


@query
def order_base(t):
    return base.order_base(t)


@query
def order_base_from_fact(t):
    return base.order_base_from_fact(fact(t), t["customers"], t["order_reviews"])


@query
def enriched_orders(t):
    return base.enriched_orders(t)


@query
def category_month(t):
    return category_sales(t)


@query
def headline_kpis(t):
    return kpis.kpis(base.enriched_orders(t, ("items", "customers", "reviews"), history=False))


@query
def gmv_new_repeat(t):
    return kpis.gmv_monthly(base.enriched_orders(t, ("items", "customers")))


@query
def repeat_share(t):
    return kpis.repeat_share_monthly(base.enriched_orders(t, ("customers",)))


@query
def treadmill(t):
    return kpis.treadmill(base.enriched_orders(t, ("customers",)))


@query
def cac_scenario(t):
    df = base.enriched_orders(t, ("items", "customers", "reviews"), history=False)
    months = base.order_base(t, ()).agg(F.count_distinct("order_month").alias("n_months"))
    return kpis.scenario(kpis.kpis(df), months, 50_000, 40, 2)


@query
def delivery_split(t):
    return delivery.outcome_split(base.order_base(t, ()))


@query
def late_by_state(t):
    return delivery.late_rate(base.enriched_orders(t, ("customers",), history=False), "customer_state")


@query
def late_by_month(t):
    return delivery.late_rate(base.enriched_orders(t, (), history=False), "order_month")


@query
def late_by_large_state(t):
    return delivery.late_rate_of_large(base.enriched_orders(t, ("customers",), history=False), min_orders=150)


@query
def review_distribution(t):
    return delivery.score_distribution(base.order_base(t, ("reviews",)))


@query
def review_summary(t):
    return delivery.review_summary(stage.latest_reviews(t["order_reviews"]))


@query
def score_by_bucket(t):
    return delivery.score_by_bucket(base.enriched_orders(t, ("reviews",), history=False))


@query
def reorder_by_bucket(t):
    return delivery.reorder_by(base.enriched_orders(t, ("customers",)), "delivery_bucket")


@query
def reorder_by_score(t):
    return delivery.reorder_by(base.enriched_orders(t, ("customers", "reviews")), "review_bucket")


@query
def reorder_gap(t):
    rates = delivery.reorder_by(base.enriched_orders(t, ("customers",)), "delivery_bucket")
    return delivery.relative_gap(rates, "reorder_rate")


@query
def lead_hist(t):
    return delivery.lead_histogram(base.order_base(t, ()))


@query
def lead_median(t):
    return delivery.lead_median(base.order_base(t, ()))


@query
def lead_by_state(t):
    return delivery.lead_by_state(base.order_base(t, ("customers",)))


@query
def score_by_day_late(t):
    return delivery.score_by_day_late(base.order_base(t, ("reviews",)))


@query
def score_trend(t):
    df = delivery.score_trend(base.order_base(t, ("reviews",)))
    return df.select("n", *[F.round(c, 8).alias(c) for c in ("intercept", "linear", "quadratic")])


@query
def top_categories(t):
    return kpis.top_categories(category_sales(t), 3)


@query
def bottom_categories(t):
    return kpis.bottom_categories(category_sales(t), 3)


@query
def category_state_matrix(t):
    return kpis.category_state_matrix(category_sales(t), columns=STATES)


@query
def lane_scorecard(t):
    return lane_rows(t)


def lane_rows(t: Tables) -> DataFrame:
    orders = base.enriched_orders(t, ("customers",), history=False)
    return delivery.lane_scorecard(orders, star.clean_items(t["order_items"]), categories(t))


@query
def lanes_at_risk(t):
    """A top-k report: the twenty lanes with the most revenue at risk of coming late."""
    return lane_rows(t).orderBy(F.round("risk", 6).desc_nulls_last(), "customer_state", "product_category").limit(20)


@query
def revenue_at_risk(t):
    return retention.revenue_at_risk(base.enriched_orders(t, ("items", "customers", "reviews")))


@query
def review_profile(t):
    return delivery.review_profile(base.enriched_orders(t, ("reviews",), history=False))


@query
def review_composition(t):
    return delivery.review_composition(base.enriched_orders(t, ("reviews",), history=False))


@query
def handling_stages(t):
    return delivery.handling_stages(t["orders"])


# Dashboard charts -----------------------------------------------------------------------------------


def datasets(t: Tables) -> dict[str, DataFrame]:
    orders = base.enriched_orders(t, ("items", "customers", "reviews"), history=False)
    return {semantic.ORDERS: orders, semantic.CUSTOMERS: retention.customer_view(orders)}


@query
def chart_big_numbers(t):
    return semantic.big_numbers(datasets(t))


@query
def chart_gmv_new_vs_repeat(t):
    return semantic.chart("gmv_new_vs_repeat", {semantic.ORDERS: base.enriched_orders(t, ("items", "customers"))})


@query
def chart_delivery_hist(t):
    return semantic.chart("delivery_hist", {semantic.ORDERS: base.enriched_orders(t, (), history=False)})


@query
def chart_late_by_state(t):
    return semantic.chart("late_by_state", {semantic.ORDERS: base.enriched_orders(t, ("customers",), history=False)})


@query
def chart_review_by_delivery(t):
    return semantic.chart("review_by_delivery", {semantic.ORDERS: base.enriched_orders(t, ("reviews",), history=False)})


@query
def chart_rfm_segments(t):
    view = retention.customer_view(base.enriched_orders(t, ("items", "customers"), history=False))
    return semantic.chart("rfm_segments", {semantic.CUSTOMERS: view})


@query
def chart_cohort_heatmap(t):
    cohorts = retention.cohort_long(base.order_base(t, ("customers",)))
    return semantic.chart("cohort_heatmap", {semantic.COHORTS: cohorts})


@query
def chart_top_categories(t):
    return semantic.chart("top_categories", {semantic.CATEGORIES: category_sales(t)})


@query
def chart_repeat_share_trend(t):
    return semantic.chart("repeat_share_trend", {semantic.ORDERS: base.enriched_orders(t, ("customers",))})


@query
def chart_orders_per_customer(t):
    view = retention.customer_view(base.enriched_orders(t, ("items", "customers"), history=False))
    return semantic.chart("orders_per_customer", {semantic.CUSTOMERS: view})


@query
def chart_reorder_by_review(t):
    return semantic.chart("reorder_by_review", {semantic.ORDERS: base.enriched_orders(t, ("customers", "reviews"))})


@query
def chart_late_rate_trend(t):
    return semantic.chart("late_rate_trend", {semantic.ORDERS: base.enriched_orders(t, (), history=False)})


@query
def chart_reorder_by_delivery(t):
    return semantic.chart("reorder_by_delivery", {semantic.ORDERS: base.enriched_orders(t, ("customers",))})


# Retention and segments -------------------------------------------------------------------------------


@query
def cohort_long(t):
    return retention.cohort_long(base.order_base(t, ("customers",)))


@query
def cohort_wide(t):
    # Every distance there can be between two months of the orders table, which covers seven years.
    return retention.cohort_wide(retention.cohort_long(base.order_base(t, ("customers",))), range(COHORT_MONTHS))


@query
def repeat_rate(t):
    return retention.repeat_rate(base.order_base(t, ("customers",)))


@query
def orders_per_customer(t):
    return retention.orders_per_customer(base.order_base(t, ("customers",)))


@query
def customer_view(t):
    return retention.customer_view(base.order_base(t, ("items", "customers")))


@query
def rfm_rules(t):
    return retention.segment_sizes(retention.customer_view(base.order_base(t, ("items", "customers"))))


@query
def rfm_rules2(t):
    orders = base.enriched_orders(t, ("items",), history=False)
    return retention.value_segments(orders, ts(AS_OF))


@query
def rfm_quintile(t):
    return retention.rfm_quintiles(base.order_base(t, ("items", "customers")))


@query
def rfm_quintile_means(t):
    return retention.segment_means(retention.rfm_quintiles(base.order_base(t, ("items", "customers"))))


@query
def rfm_quartile(t):
    return retention.rfm_quartiles(base.order_base(t, ("items", "customers")))


@query
def customer_360(t):
    return retention.customer_360(base.order_base(t, ("items", "customers")))


@query
def first_order_return(t):
    return retention.first_order_return(base.enriched_orders(t, ("customers",)), "delivery")


@query
def first_score_return(t):
    return retention.first_order_return(base.enriched_orders(t, ("customers", "reviews")), "score")


# Business questions -------------------------------------------------------------------------------------


@query
def revenue_month(t):
    return business.revenue_by_month(fact(t, paid=False))


@query
def seller_rank(t):
    return business.seller_ranking(fact(t, paid=False), t["sellers"], scores(t))


@query
def category_perf(t):
    return business.category_performance(fact(t, paid=False), categories(t), scores(t))


@query
def payment_mix(t):
    return business.payment_mix(fact(t))


@query
def sla_state(t):
    return business.sla_by_seller_state(fact(t, paid=False), t["sellers"])


@query
def geo_revenue(t):
    return business.revenue_by_customer_state(fact(t, paid=False), t["customers"], scores(t))


@query
def category_score(t):
    return business.category_by_score(fact(t, paid=False), categories(t), scores(t))


@query
def sales_by_season(t):
    return business.sales_by(business.with_calendar(base.order_base(t, ("items",))), "season")


@query
def sales_by_weekday(t):
    return business.sales_by(business.with_calendar(base.order_base(t, ("items",))), "purchase_day_name")


@query
def sales_by_hour(t):
    return business.sales_by(business.with_calendar(base.order_base(t, ("items",))), "purchase_hour")


@query
def sales_by_state(t):
    return business.sales_by(base.order_base(t, ("items", "customers")), "customer_state")


@query
def sales_by_year(t):
    return business.sales_by(business.with_calendar(base.order_base(t, ("items",))), "purchase_year")


@query
def sales_by_city(t):
    cities = t["customers"].select("customer_id", "customer_city")
    return business.sales_by(joins.lookup(base.order_base(t, ("items",)), cities, "customer_id"), "customer_city")


@query
def sales_latest_update(t):
    """Newest moment any source of a sold item was touched; a source without one counts from the epoch."""
    facts = star.clean_items(t["order_items"]).join(star.clean_orders(t["orders"]), "order_id")
    facts = joins.lookup(facts, scores_at(t), "order_id")
    moments = ("order_purchase_timestamp", "order_delivered_customer_date", "shipping_limit_date", "review_answer_timestamp")
    return facts.select("order_id", "order_item_id", star.latest_update(*moments).alias("latest_update"))


def scores_at(t: Tables) -> DataFrame:
    return stage.latest_reviews(t["order_reviews"]).select("order_id", "review_answer_timestamp")


@query
def local_freight(t):
    return business.local_freight(star.clean_items(t["order_items"]), t["sellers"], t["orders"], t["customers"])


@query
def top_sellers(t):
    return business.top_by_revenue(star.clean_items(t["order_items"]), ["seller_id"], 10)


@query
def top_city_categories(t):
    items = joins.lookup(t["order_items"], t["sellers"].select("seller_id", "seller_city"), "seller_id")
    return business.top_by_count(joins.lookup(items, categories(t), "product_id"), ["seller_city", "product_category"])


@query
def vip(t):
    return business.vip_customers(t["order_payments"], t["orders"], t["customers"], t["order_items"], categories(t))


@query
def vip_products(t):
    return business.vip_products(t["order_payments"], t["orders"], t["order_items"], categories(t))


@query
def payment_distributions(t):
    return business.payment_distributions(t["order_payments"])


@query
def rolling3(t):
    return kpis.rolling_revenue(base.order_base(t, ("items",)))


@query
def gmv_growth(t):
    return kpis.growth(base.order_base(t, ("items",)), "1995-02-01", "2001-06-01")


@query
def gmv_growth_all(t):
    return kpis.growth(base.order_base(t, ("items",)))


@query
def product_volumes(t):
    return business.product_volume(t["products"]).select("product_id", "volume_cm3")


@query
def freight_shares(t):
    return business.freight_share(star.clean_items(t["order_items"])).select(
        "order_id", "order_item_id", "line_total", "freight_pct"
    )


# Quality --------------------------------------------------------------------------------------------------


@query
def unique_violations(t):
    return quality.check_unique(raw(t)["order_reviews"], ["review_id"])


@query
def combination_violations(t):
    return quality.check_unique(raw(t)["order_items"], ["order_id", "order_item_id"])


@query
def null_violations(t):
    return quality.check_not_null(t["order_payments"], "payment_type").select("order_id", "payment_sequential")


@query
def fk_violations(t):
    return quality.check_fk(t["sellers"], "seller_zip_code_prefix", raw(t)["geolocation"], "zip_code_prefix")


@query
def enum_violations(t):
    return quality.check_enum(raw(t)["order_reviews"], "review_comment_title", ["view", "click", "purchase"]).select(
        "review_id", "review_comment_title", "review_answer_timestamp"
    )


@query
def range_violations(t):
    bad = quality.check_range(fact(t), "price", 1000, 90_000, where="order_status = 'delivered'")
    return bad.select("id", "order_item_id", F.col("price").cast("double").alias("price"))


@query
def pair_violations(t):
    bad = quality.check_pair(
        t["orders"], "order_delivered_customer_date", "order_delivered_carrier_date", where="order_status = 'delivered'"
    )
    return bad.select("order_id", "order_delivered_customer_date", "order_delivered_carrier_date")


@query
def regex_violations(t):
    return quality.check_regex(read(t, "part"), "p_brand", r"^Brand#[0-9]$").select("p_partkey", "p_brand")


@query
def expression_violations(t):
    return quality.check_expr(
        t["order_items"], "price > 1000 AND freight_value <= price * 0.07"
    ).select("order_id", "order_item_id")


@query
def placeholder_violations(t):
    return quality.check_placeholders(raw(t)["order_reviews"], ["review_comment_message"]).select("review_id", "order_id")


@query
def null_rate_gate(t):
    return quality.check_null_rate(t["orders"], {"order_delivered_customer_date": 0.2, "order_approved_at": 0.0})


@query
def mean_gate(t):
    return quality.check_mean(t["order_reviews"], "review_score", 1, 2)


@query
def iqr_outliers(t):
    return quality.iqr_outliers(t["order_items"], "freight_value")


@query
def freight_anomalies(t):
    return audits.freight_anomalies(star.clean_items(t["order_items"]))


@query
def place_mismatches(t):
    return audits.place_mismatches(t["sellers"], raw(t)["geolocation"])


@query
def mart_reconciliation(t):
    """Months in which the category mart and the raw (not de-duplicated) items disagree."""
    lines = joins.lookup(raw(t)["order_items"].select("order_id", "price"), t["orders"].select("order_id", "order_purchase_timestamp"), "order_id")
    monthly = lines.withColumn("month", dates.month_start("order_purchase_timestamp")).withColumnRenamed("price", "gmv")
    mart = business.monthly_revenue_mart(fact(t, paid=False), categories(t)).withColumn("gmv", F.col("gmv").cast("decimal(18,2)"))
    return quality.check_totals(mart, monthly, "month", "gmv").withColumns({
        c: F.round(c, 2) for c in ("left_total", "right_total")
    })


@query
def one_segment_each(t):
    """Customers with no segment or several rows, in a mart where every tenth is doubled and every fifteenth lost its segment."""
    key = F.col("customer_unique_id")
    mart = customer_360(t).withColumn("rfm_segment", F.when(key % 15 != 1, F.col("rfm_segment")))
    mart = mart.unionByName(mart.filter(key % 10 == 0))
    several = quality.check_unique(mart, ["customer_unique_id"]).select("customer_unique_id")
    return several.unionByName(quality.check_not_null(mart, "rfm_segment").select("customer_unique_id"))


@query
def raw_key_checks(t):
    """The key checks over the raw tables, whose reviews and items hold several rows of a key."""
    return audits.stage_summary(raw(t))


@query
def schema_contract(t):
    """Columns of the stage orders against a contract with a wrong type, a missing and an unknown column."""
    return quality.check_schema(t["orders"].select("order_id", "customer_id", "order_status", "order_approved_at"), {
        "order_id": "string", "customer_id": "bigint", "order_status": "string", "order_region": "string"})


@query
def stage_checks(t):
    return audits.stage_summary(t)


@query
def gold_checks(t):
    """Checks read the stored fact, as they do after a layer run: each scans only its columns."""
    stored = store.cached_result(t.spark, scratch_path(t.spark, "fact"), lambda: fact(t))
    return audits.gold_summary(stored, t, ts(AS_OF))


# Text -----------------------------------------------------------------------------------------------------


@query
def top_words(t):
    return words.term_freq(read(t, "documents"), "text", 20)


@query
def word_counts(t):
    return words.term_freq(read(t, "documents"), "text")


@query
def top_bigrams(t):
    return words.bigram_freq(read(t, "documents"), "text", 20)


@query
def words_by_band(t):
    return words.vocabulary_by_band(document_scores(t), "text", "review_score", 20)


@query
def relabelled_words(t):
    """Word counts under language labels: words map to the language that uses them most."""
    by_lang = words.token_counts(read(t, "documents"), "text", ["lang"])
    best = F.max(F.struct("n", "lang"))["lang"].alias("label")
    mapping = by_lang.groupBy("term").agg(best)
    return words.relabel(words.term_freq(read(t, "documents"), "text"), mapping)


@query
def length_by_score(t):
    return words.length_by_score(document_scores(t), "text", "review_score")


@query
def length_hist(t):
    return words.length_histogram(read(t, "documents"), "text")


@query
def review_texts(t):
    return words.review_texts(raw(t)["order_reviews"])


@query
def review_coverage(t):
    return words.coverage(words.review_texts(raw(t)["order_reviews"]))


# Models -----------------------------------------------------------------------------------------------------


@query
def ml_order_rows(t):
    return learning.ml_base(t).drop("purchase_ts", "order_month", "delivered_ts", "estimated_ts", "delivery_days", "days_vs_estimate")


@query
def ml_features(t):
    df = learning.features_only(learning.engineer(learning.label(learning.ml_base(t), "late_delivery")))
    return df.withColumn("estimated_lead_days", F.round("estimated_lead_days", 8))


@query
def ml_repeat_label(t):
    rows = learning.label(base.order_base(t, ("customers",)), "repeat_purchase")
    return rows.select("order_id", "customer_unique_id", "label")


@query
def ml_class_weights(t):
    rows = learning.label(base.order_base(t, ()), "late_delivery")
    return learning.balance(rows).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"))


def scored(t: Tables, model: str) -> DataFrame:
    train, test = learning.prepared(t, "late_delivery")
    return learning.score(learning.fit(train, model), test)


@query
def ml_scored(t):
    return scored(t, "logistic_regression")


@query
def ml_metrics(t):
    return learning.metrics(scored(t, "logistic_regression"))


@query
def ml_metrics_fixed(t):
    """The model figures of a score that needs no fitting: freight as a share of the order's value."""
    rows = learning.label(base.order_base(t, ("items",)), "late_delivery")
    scored = rows.select("order_id", "label", clean.ratio(F.col("freight"), F.col("gmv")).alias("score")).filter("score is not null")
    return learning.metrics(scored).withColumns({c: F.round(c, 9) for c in ("threshold", "pr_auc", "roc_auc")})


@query
def ml_split_shares(t):
    """Rows, test rows and rows in both parts of each label's split; the test share lies within bounds."""
    rows = learning.label(base.order_base(t, ()), "late_delivery").select("order_id", "label")
    train, test = learning.split(rows)
    parts = train.withColumn("part", F.lit(1)).unionByName(test.withColumn("part", F.lit(2)))
    per_order = parts.groupBy("label", "order_id").agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("part"))
    return per_order.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_in_both"),
        (F.abs(F.avg((F.col("part") == 2).cast("int")) - 0.2) < 0.03).alias("share_holds"))


@query
def ml_boosted_search(t):
    """Boosted trees with parameters from seeded random draws: each draw and its mean area over the folds."""
    train, _ = learning.prepared(t, "late_delivery")
    space = {"maxDepth": range(2, 6), "maxIter": (4, 6, 8), "stepSize": (0.05, 0.1, 0.2)}
    _, tried = learning.random_search(train, "gradient_boosting", space)
    rows = [(i + 1, *(float(p[n]) for n in space), area) for i, (p, area) in enumerate(tried)]
    return t.spark.createDataFrame(rows, "draw int, max_depth double, max_iter double, step_size double, pr_auc double")


@query
def ml_histogram_boosting(t):
    """The second kind of boosting: histograms of binned features, trees grown leaf by leaf."""
    train, test = learning.prepared(t, "late_delivery")
    return learning.metrics(boosting.score(boosting.fit(train), test))


@query
def ml_folds(t):
    """Rows of each fold and label of the training frame; every row is in one fold."""
    rows = learning.label(base.order_base(t, ()), "late_delivery")
    return learning.with_folds(rows, 3).groupBy("fold", "label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("order_id").alias("n_orders"))


@query
def ml_importances(t):
    train, _ = learning.prepared(t, "late_delivery")
    return learning.importances(learning.fit(train, "random_forest", {"numTrees": 10, "maxDepth": 4}), train)
