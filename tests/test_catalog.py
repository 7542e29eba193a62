"""The driver contract, and a cross-section of queries against their SQL in DuckDB."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as driver
import oracles
from orderloom import catalog

FOLDER = Path("/root/testdata/sf0.001")
NAMES = (
    "dedup_composite", "fact_orders", "dq_flags", "fact_sales_alloc", "enriched_orders", "headline_kpis", "gmv_new_repeat",
    "treadmill", "cohort_wide", "rfm_quartile", "revenue_month", "geo_revenue", "scd2_check", "scd2_rebuild", "upsert_result",
    "iqr_outliers", "gold_checks", "top_words", "top_bigrams", "ml_features",
)


def test_every_sql_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(catalog.QUERIES) - set(oracles.ORACLES) == {
        "ml_scored", "ml_metrics", "ml_importances", "ml_boosted_search", "ml_histogram_boosting"}


@pytest.mark.skipif(not FOLDER.exists(), reason="driver tables absent")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in FOLDER.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    df = driver.queries()[name](spark, str(FOLDER))
    cols = sorted(df.columns)
    want = con.execute(f"select {', '.join(cols)} from ({driver.oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in df.select(*cols).collect()]
    order = lambda row: tuple((v is not None, str(v)) for v in row)
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9)), (cols, a, b)


@pytest.mark.skipif(not FOLDER.exists(), reason="driver tables absent")
def test_entry(spark):
    assert driver.entry(spark).count() > 0
