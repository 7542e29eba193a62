"""Word and word-pair frequencies of review texts, by score band, with text lengths."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.clean import blank_to_null
from orderloom.functions.dates import month_start
from orderloom.functions.text import STOP_WORDS, bigrams, raw_words, review_field, strip_accents, tokens
from orderloom.operators.aggregates import histogram
from orderloom.operators.joins import lookup
from orderloom.plans.stage import latest_reviews


def review_texts(reviews: DataFrame, field: str = "both") -> DataFrame:
    """Newest version of each review with blank texts as NULL and the month of the answer."""
    latest = latest_reviews(reviews, per="review_id")
    return latest.select(
        "review_id", "order_id", "review_score",
        blank_to_null("review_comment_title").alias("title"),
        blank_to_null("review_comment_message").alias("message"),
        review_field("review_comment_title", "review_comment_message", field).alias("text"),
        month_start("review_answer_timestamp").alias("answer_month"),
    )


def _top(counts: DataFrame, n: int | None) -> DataFrame:
    return counts if n is None else counts.orderBy(F.col("n").desc(), "term").limit(n)


def token_counts(df: DataFrame, col: str, keys: Sequence[str] = (), stop: Iterable[str] = STOP_WORDS) -> DataFrame:
    """keys, term, n over whole texts.

    Raw words are counted first, so accents and stop words are dealt with once per distinct word
    and the shuffle carries counts instead of words.
    """
    raw = df.select(*keys, F.explode(raw_words(col)).alias("_raw")).groupBy(*keys, "_raw").agg(F.count(F.lit(1)).alias("_n"))
    plain = raw.select(*keys, strip_accents("_raw").alias("term"), "_n").filter(~F.col("term").isin(list(stop)))
    return plain.groupBy(*keys, "term").agg(F.sum("_n").alias("n"))


def term_freq(df: DataFrame, col: str, n: int | None = None, stop: Iterable[str] = STOP_WORDS) -> DataFrame:
    """term, n; ``n`` gives the top-n report, ties by term."""
    return _top(token_counts(df, col, (), stop), n)


def bigram_freq(df: DataFrame, col: str, n: int | None = None, stop: Iterable[str] = STOP_WORDS) -> DataFrame:
    """Neighbouring pairs after stop-word removal; pairs never span two texts."""
    pairs = df.select(tokens(col, stop).alias("_words")).select(F.explode(bigrams("_words")).alias("term"))
    return _top(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("n")), n)


def score_band(score: Column) -> Column:
    return F.when(score <= 2, "low").when(score >= 4, "high")


def vocabulary_by_band(df: DataFrame, col: str, score: str, n: int = 20, stop: Iterable[str] = STOP_WORDS) -> DataFrame:
    """Top-n words of low-score and of high-score texts."""
    banded = df.withColumn("band", score_band(F.col(score))).filter(F.col("band").isNotNull())
    counts = token_counts(banded, col, ["band"], stop)
    return _top(counts.filter(F.col("band") == "low"), n).unionByName(_top(counts.filter(F.col("band") == "high"), n))


def relabel(freq: DataFrame, mapping: DataFrame) -> DataFrame:
    """Terms renamed by a (term, label) table; equal labels add up, other terms stay."""
    named = lookup(freq, mapping, "term")
    return named.groupBy(F.coalesce("label", "term").alias("term")).agg(F.sum("n").cast("bigint").alias("n"))


def length_by_score(df: DataFrame, col: str, score: str) -> DataFrame:
    d = df.filter(F.col(col).isNotNull() & F.col(score).isNotNull())
    return d.groupBy(score).agg(F.avg(F.length(col)).alias("avg_length"), F.count(F.lit(1)).alias("texts"))


def length_histogram(df: DataFrame, col: str, width: int = 25, cap: int = 500) -> DataFrame:
    """Texts per length bin; texts above the cap count in the last bin."""
    return histogram(df.select(F.length(col).alias("length")), "length", width, 0, cap)


def coverage(reviews: DataFrame) -> DataFrame:
    """How many reviews carry a title, a message, any text (one row)."""
    title, message = F.col("title").isNotNull(), F.col("message").isNotNull()
    return reviews.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(title).alias("with_title"),
        F.count_if(message).alias("with_message"),
        F.count_if(title | message).alias("with_text"),
        F.avg(F.length("message")).alias("avg_message_length"),
    )
