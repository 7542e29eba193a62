"""Corpus pipeline: five stages over the documents, each written as Parquet and read again by the next.

A stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the columns
of ``docs``; the last returns the token ids and each document's place in the mixed order. Extra columns of ``docs`` pass
through, empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
import public_tokenizers

from orderloom.llm import bpe, language, line_chunks, mixing, order_minhash
from orderloom.llm.common import fold, prepare, unboxed
from orderloom.llm.queries import BYTE_BPE, table
from orderloom.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (null texts, texts without a letter); all others stay as they are.

    The automata learn from the labelled documents whose crc32(doc_id) modulo 4 is not 2.
    """
    prepare(spark)
    parser = language.fit(docs.where(fold("doc_id", 4) != 2))
    return unboxed(language.predict_rows(docs, parser).where(F.col("lang_pred") != language.UNKNOWN))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated chunks of lines out of the texts; documents of which nothing is left go. ``n_chars`` follows the text."""
    kept = unboxed(line_chunks.drop_repeated(docs).where(~F.col("emptied")))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each class of near-duplicates."""
    prepare(spark)
    return order_minhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the Pfair schedule; every document stays."""
    return unboxed(mixing.mix(docs).orderBy("slot", "place"))


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``position`` (from 0) in the order in which ``docs`` was written.

    Spark reads the files of a table in any order, but the writer numbers them: the order is that of the files' names and of
    the rows in each. Rows that do not come from files are taken in the order of their partitions.
    """
    try:
        meta = docs.metadataColumn("_metadata")
        # part-(task)-(id)-c(file of the task)
        numbers = (F.regexp_extract(meta["file_name"], r, 1).try_cast("long") for r in (r"^part-(\d+)", r"-c(\d+)[^-]*$"))
        part = F.struct(*numbers, meta["file_name"]).alias("part")
        rows = docs.select("doc_id", "text", part, meta["row_index"].alias("row"))
        parts = docs.select(part)
    except AnalysisException:
        number = F.monotonically_increasing_id()  # the partition, and 33 bits of the row in it
        rows = docs.select("doc_id", "text", F.shiftright(number, 33).alias("part"), number.bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
        parts = docs.select(F.shiftright(F.monotonically_increasing_id(), 33).alias("part"))
    # One row for each part.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(F.broadcast(offsets), "part").select("doc_id", "text", (F.col("before") + F.col("row")).alias("position"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``position`` in the mixed order, ``n_tokens``, ``ids`` (packed little-endian unsigned 32-bit), and the
    decoded bytes' SHA-256."""
    prepare(spark)
    rows = in_order(docs).select(F.struct("doc_id", "position").alias("doc_id"), "text")
    coded = bpe.encode(rows, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id.doc_id", "doc_id.position", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

# Cross-parsing, edit alignment and token merges are not SQL; tests/llm checks the stages by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; what lies between them is kept in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
