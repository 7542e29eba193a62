"""The operators as named queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
import public_tokenizers

from . import (
    bpe, codebooks, language, line_chunks, mixing, order_minhash, pieces, pivots, posting_lists, secrets, suffix_tree, url_lists, whitening,
)
from .common import fold, prepare

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("row.doc_id", "row.source", "block", "place", "slot")


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    return bpe.encode(table(spark, folder, "documents"), ranks, pattern, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    log = url_lists.report_log(pages, table(spark, folder, "events"))
    judged = url_lists.judge(url_lists.page_captures(pages), log)
    return judged.select("row.page_id", "row.url", F.col("row.fetched").cast("string").alias("fetched"), "verdict", "pattern", "n_active")


def op2_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.search(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op3_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.score_held_out(table(spark, folder, "documents"))


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return posting_lists.search(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.classes(table(spark, folder, "documents")).select("doc_id", "class_id", "n_class")


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secrets.find(docs, secrets.fit(docs))

    def joined(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, secrets.KINDS),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "crf")), 256).alias("base_sha256"),
        joined("spans").alias("spans"))


def op9_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_chunks.drop_repeated(table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select(
        "row.doc_id", "n_lines", "n_chunks", F.col("lines_gone").alias("n_lines_removed"),
        F.length("row.text").cast("long").alias("n_chars_kept"), F.md5("row.text").alias("text_md5"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold("doc_id", 4) == 2
    parser = language.fit(docs.where(~held_out))
    return language.predict(docs, parser).withColumn("held_out", held_out)


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = codebooks.compress(table(spark, folder, "embeddings"), keep=["vec_id", "label"])
    return codebooks.with_group_error(coded, "label").select(
        "row.vec_id", F.lower(F.hex("code")).alias("code"), "error", F.col("group_error").alias("label_error"),
        F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.components_of(table(spark, folder, "embeddings"), keep=["vec_id"])
    return rows.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    coded = pieces.encode(table(spark, folder, "documents"), public_tokenizers.path(PIECE_BPE), decoded=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_exact_topk": op2_exact_topk,
    "op3_language_model": op3_language_model,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_secrets": op6_secrets,
    "op7_mixing": op7_mixing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_line_chunks": op9_line_chunks,
    "op10_language": op10_language,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_sentence_pieces": op13_sentence_pieces,
}

LLM_ORACLES: dict[str, str] = {
    "op1_url_filters": url_lists.oracle(),
    "op7_mixing": mixing.oracle(),
    "op9_line_chunks": line_chunks.oracle(),
    "op11_vector_codes": codebooks.oracle(),
}
