import datetime as dt
import re
import unicodedata

from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from orderloom.functions import clean, dates, labels, text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("x")).first()[0]


def test_placeholders_and_blanks_become_null(spark):
    df = spark.createDataFrame([(" N/A ",), ("None",), ("",), ("ok",), (None,)], "c string")
    assert rows(df.select(clean.placeholder_to_null("c"))) == [(None,)] * 4 + [("ok",)]
    assert rows(df.select(clean.blank_to_null("c"))) == [(None,), (None,), ("N/A",), ("None",), ("ok",)]


def test_numeric_bounds_keep_the_row(spark):
    df = spark.createDataFrame([(-999.0,), (-1.0,), (0.0,), (5.0,), (11.0,), (None,)], "c double")
    assert rows(df.select(clean.clamp_null("c", 0, 10, [-999]))) == [(None,)] * 4 + [(0.0,), (5.0,)]
    assert rows(df.select(clean.clamp_null("c", lo=0, lo_open=True))) == [(None,)] * 4 + [(5.0,), (11.0,)]


def test_safe_cast_and_booleans(spark):
    df = spark.createDataFrame([("12",), ("x",), (" TRUE ",), ("false",)], "c string")
    assert rows(df.select(clean.safe_cast("c", "int"))) == [(None,)] * 3 + [(12,)]
    assert rows(df.select(clean.to_bool("c"))) == [(None,), (None,), (False,), (True,)]


def test_strip_all_text_and_require(spark):
    df = spark.createDataFrame([(" a ", 1), ("  ", 2), (None, 3)], "s string, n int")
    assert rows(clean.require(clean.strip_all_text(df), "s")) == [("a", 1)]


def test_soft_deleted_rows_leave(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_deleted boolean")
    assert rows(clean.not_deleted(df), "id") == [(2,), (3,)]


def test_calendar_and_elapsed_days_differ(spark):
    late, early = dt.datetime(2020, 1, 2, 0, 5), dt.datetime(2020, 1, 1, 23, 59)
    args = {"a": ("timestamp", late), "b": ("timestamp", early)}
    assert one(spark, dates.days_between("a", "b"), **args) == 1
    assert one(spark, dates.days_between("a", "b", "elapsed"), **args) == 0
    assert one(spark, dates.days_between("b", "a", "elapsed"), **args) == -1


def test_sunday_week_matches_strftime(spark):
    days = [dt.date(2016, 12, 25) + dt.timedelta(days=i) for i in range(0, 800)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", dates.sunday_week("d"))
    assert all(w == int(d.strftime("%U")) for d, w in df.collect())


def test_bucket_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-1, 0, 1, 3, 4, 7, 8, None)], "d int")
    got = {r[0]: r[1] for r in df.select("d", labels.delivery_bucket("d")).collect()}
    one_, two, three, four = labels.DELIVERY_BUCKETS
    assert got == {-1: one_, 0: one_, 1: two, 3: two, 4: three, 7: three, 8: four, None: None}
    marks = spark.createDataFrame([(x,) for x in (1.0, 2.0, 2.5, 3.0, 4.0, 5.0, None)], "s double")
    grades = {r[0]: r[1] for r in marks.select("s", labels.review_grade("s")).collect()}
    assert grades == {1.0: "Bad", 2.0: "Bad", 2.5: "Okay", 3.0: "Okay", 4.0: "Good", 5.0: "Excellent", None: None}


def test_rule_segments_at_their_edges(spark):
    cases = [(2, 120), (2, 121), (1, 90), (1, 91), (1, 240), (1, 241)]
    df = spark.createDataFrame(cases, "f int, r int").select("f", "r", labels.rule_segment("f", "r"))
    loyal, lapsing, recent, cooling, dormant = labels.RULE_SEGMENTS
    assert {(a, b): c for a, b, c in df.collect()} == {
        (2, 120): loyal, (2, 121): lapsing, (1, 90): recent, (1, 91): cooling, (1, 240): cooling, (1, 241): dormant}


def plain_tokens(s):
    out = []
    for word in re.findall(text.TOKEN_PATTERN, s.lower()):
        word = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
        if word not in text.STOP_WORDS:
            out.append(word)
    return out


ALPHABET = st.sampled_from("abcxyz áàâãçéêíóôõúüñ÷ØÉ 1-.,'\n")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=1, max_size=8))
def test_tokens_match_a_plain_reading(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", text.tokens("t").alias("w")).select("i", "w", text.bigrams("w")).collect()
    for i, words, pairs in got:
        want = plain_tokens(texts[i])
        assert words == want
        assert pairs == [f"{a} {b}" for a, b in zip(want, want[1:])]


def test_review_field_choice(spark):
    df = spark.createDataFrame([("t", " "), (None, "m"), ("t", "m"), (None, None)], "a string, b string")
    assert rows(df.select(text.review_field("a", "b"))) == [(None,), ("m",), ("t",), ("t m",)]
    assert rows(df.select(text.review_field("a", "b", "message"))) == [(None,), (None,), ("m",), ("m",)]


def test_round_half_up_reads_decimals(spark):
    df = spark.createDataFrame([(123.455,), (2.675,), (-0.125,)], "x double")
    assert [r[0] for r in df.select(clean.round_half_up(F.col("x"), 2)).collect()] == [123.46, 2.68, -0.13]
