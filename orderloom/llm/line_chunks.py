"""Removal of repeated runs of lines, cut where their content says so.

Each line has a 32-bit hash (the first 8 hex digits of its MD5). A rolling hash over the last ``WINDOW`` line hashes ends
a chunk after a line if it is divisible by ``MEAN_LINES``; the last line ends one too. So the cuts depend on nearby
lines alone and find their places again when lines are put in or taken out before them. Chunks of at least two lines
with at least one non-blank line count; grouping by the chunk's text itself is the byte comparison. Of a text that occurs more
than once in the corpus the occurrence of the smallest id stays, in that document the first; all others are removed.

Null texts stay null, empty texts are one empty line and stay. Rows that share an id count as one document, each
keeping the first occurrence it has; a null id comes after all others. Ties cannot remain, so results repeat. A hot chunk
is reduced in each task before its text moves, and its occurrences, which carry no text, meet it in a join that may be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import boxed, id_text, quoted

WINDOW, MEAN_LINES, FACTOR = 2, 3, 31


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def with_chunks(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_lines`` and ``_chunks``: (number from 1, first line, lines, text) of each chunk in order."""
    rolling = " + ".join(f"element_at(_hashes, i - {k}) * {FACTOR ** k}" for k in range(1, WINDOW))
    ends = f"""filter(sequence(1, size(_lines)), i -> i = size(_lines)
        or (i >= {WINDOW} and (element_at(_hashes, i) + {rolling}) % {MEAN_LINES} = 0))"""
    return (
        docs.withColumn("_lines", lines(F.col(text_col)))
        .withColumn("_hashes", F.transform("_lines", line_hash))
        .withColumn("_ends", F.expr(ends))
        .withColumn("_chunks", F.expr("""transform(_ends, (e, k) -> named_struct(
            'k', k + 1, 'first', if(k = 0, 1, element_at(_ends, k) + 1), 'n', e - if(k = 0, 0, element_at(_ends, k)),
            'text', array_join(slice(_lines, if(k = 0, 1, element_at(_ends, k) + 1), e - if(k = 0, 0, element_at(_ends, k))), '\n')))"""))
        .drop("_hashes", "_ends"))


def _key(id_col: str, text_col: str) -> Column:
    """Names a row by its id and text: rows that share both share every decision."""
    return F.md5(F.concat(id_text(id_col), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))))


def repeated(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row``, ``gone``: the numbers of the chunks to remove, for rows that have any; ``emptied``: if these are all."""
    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = (
        with_chunks(whole.where("text is not null"), "text")
        # The outer form: the plain one would push a filter on the chunks, spelt out in full, down to the scan.
        .select("id", _key("id", "text").alias("row"), F.size("_chunks").alias("chunks"), F.explode_outer("_chunks").alias("c"))
        .where("c.n >= 2 and c.text rlike '[^\\\\s]'"))
    texts = found.groupBy(F.col("c.text").alias("text")).agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    # One row for each hash; a hash that two texts share would not be used.
    known = texts.groupBy(F.md5("text").alias("hash")).agg(
        F.count("*").alias("texts"), F.min("first_id").alias("first_id"), F.sum("n").alias("n")).where("texts = 1 and n > 1")
    places = found.select("id", "row", "chunks", F.col("c.k").alias("k"), F.md5("c.text").alias("hash"))
    gone = places.join(known.select("hash", "first_id"), "hash").groupBy("row", "hash").agg(
        F.min("id").alias("id"), F.max("chunks").alias("chunks"), F.min("first_id").alias("first_id"), F.min("k").alias("first_k"),
        F.collect_set("k").alias("ks"))
    drop = F.when(F.col("id").eqNullSafe(F.col("first_id")), F.array_remove("ks", F.col("first_k"))).otherwise(F.col("ks"))
    return gone.groupBy("row").agg(
        F.flatten(F.collect_list(drop)).alias("gone"), F.max("chunks").alias("chunks")).where("size(gone) > 0").select(
        "row", "gone", (F.size("gone") == F.col("chunks")).alias("emptied"))


def drop_repeated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as ``row``, their text without the repeated chunks, and what was done.

    ``n_lines``, ``n_chunks`` and ``lines_gone`` are of the text before; ``emptied`` says that every chunk has gone.
    """
    rows = boxed(docs, _key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    gone = repeated(docs, id_col, text_col).withColumnRenamed("row", "key")
    cut = with_chunks(rows.join(gone, "key", "left"), "text").withColumn(
        "kept", F.expr("filter(_chunks, c -> gone is null or not array_contains(gone, c.k))"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("kept.text", "\n"))
    lost = F.size("_lines") - F.expr("aggregate(kept, 0, (s, c) -> s + c.n)")
    return cut.select(
        F.col("row").withField(quoted(text_col), text).alias("row"),
        *(F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias(name) for name, n in (
            ("n_lines", F.size("_lines")), ("n_chunks", F.size("_chunks")), ("lines_gone", lost))),
        F.coalesce("emptied", F.lit(False)).alias("emptied"))


def oracle(table: str = "documents") -> str:
    """The query's rows as DuckDB SQL."""
    return rf"""
WITH cut AS (
  SELECT doc_id, text, l, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS row_key,
    list_filter(range(1, len(l) + 1), lambda i: i = len(l) OR (i >= {WINDOW} AND
      (CAST('0x' || substr(md5(l[i]), 1, 8) AS BIGINT) + {FACTOR} * CAST('0x' || substr(md5(l[i - 1]), 1, 8) AS BIGINT)) % {MEAN_LINES} = 0)) AS ends
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM {table})),
chunk AS (
  SELECT doc_id, row_key, k, ends[k] - coalesce(ends[k - 1], 0) AS n,
    array_to_string(l[coalesce(ends[k - 1], 0) + 1:ends[k]], chr(10)) AS t
  FROM (SELECT *, unnest(range(1, len(ends) + 1)) AS k FROM cut)),
firsts AS (
  SELECT *, count(*) OVER (PARTITION BY t) AS copies, min(doc_id) OVER (PARTITION BY t) AS first_id,
    min(k) OVER (PARTITION BY t, row_key) AS first_k
  FROM chunk WHERE n >= 2 AND regexp_matches(t, '[^\s]')),
gone AS (
  SELECT DISTINCT row_key, k FROM firsts
  WHERE copies > 1 AND NOT (doc_id IS NOT DISTINCT FROM first_id AND k = first_k)),
kept AS (
  SELECT c.row_key, string_agg(c.t, chr(10) ORDER BY c.k) AS t, sum(c.n) AS n
  FROM (SELECT DISTINCT row_key, k, n, t FROM chunk) c ANTI JOIN gone g USING (row_key, k) GROUP BY c.row_key)
SELECT d.doc_id, coalesce(len(d.l), 0) AS n_lines, coalesce(len(d.ends), 0) AS n_chunks,
  CASE WHEN d.text IS NULL THEN 0 ELSE CAST(len(d.l) - coalesce(k.n, 0) AS BIGINT) END AS n_lines_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE CAST(length(coalesce(k.t, '')) AS BIGINT) END AS n_chars_kept,
  CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.t, '')) END AS text_md5
FROM cut d LEFT JOIN kept k USING (row_key)"""
