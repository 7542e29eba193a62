"""Near-duplicate classes by order MinHash and banded alignment.

A text's words (lower-cased, split at white space) give k-mers of ``K`` words; equal ones are told apart by their occurrence number.
A text of fewer words has one k-mer of all of them. Each of ``ENTRIES`` hash functions takes the two smallest labelled
k-mers and keeps them in text order, so an entry agrees only if both texts have these passages in the same order.
``ROWS`` entries make a band; texts that share a band are in one bucket.

The similarity of two texts is m / (n1 + n2 - m), m the longest common subsequence of their labelled k-mers. As each occurs
once, it is the longest increasing run of positions. Only pairs of positions in the band that an alignment of
similarity ``SIMILAR`` can use are aligned. Texts of similarity ``SIMILAR`` or more are linked; classes are the
connected components.

Byte-equal texts are one node from the start, and buckets of the same texts are one bucket. A bucket's texts meet in one cell
with their k-mers: a text counts the k-mers it shares with all others through the cell's postings, and those that share as many as
the similarity asks for are aligned, unless both are in one class already. Texts of the class of the most central text need not
ask, since every pair across classes has another end. So all pairs of a bucket are settled, and what leaves a cell
is a spanning tree of each class, never more rows than texts. Buckets of more than ``CELL`` texts or ``CELL_KMERS`` k-mers are dealt
over cells; afterwards their texts outside the bucket's largest class meet all its texts, block by block, in the same way.
The only pairs that can be lost are those that share no band (at 0.8: 3 in a million). A bucket of more than a cell whose texts are
mostly unlike costs blocks in the square of its size.

Null texts and texts without a word are classes of their own. Rows that share an id but not the text are told apart;
repeated rows fall into one class. An empty table gives an empty result; very long texts are hashed and aligned whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from orderloom.session import cut_lineage, scratch_path

from .common import arrow_rows, blocks, boxed, record_batch, unboxed, with_columns

K, SIMILAR = 5, 0.8
ENTRIES, ROWS = 48, 2
CELL, CELL_KMERS = 1024, 2_000_000
STRIDE, KEPT_WORDS, PART_ROWS = 65_536, 200_000, 200_000

_random = np.random.default_rng(20240229)
_TURN = _random.integers(1, 2**63, ENTRIES, np.uint64) * np.uint64(2) + np.uint64(1)
_MASK = _random.integers(0, 2**63, ENTRIES, np.uint64)
_ODD = _random.integers(1, 2**63, 8, np.uint64) * np.uint64(2) + np.uint64(1)


class Words(dict):
    """Hashes of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    return x ^ (x >> np.uint64(29))


def kmers(text: str, hashes: Words) -> np.ndarray:
    """Hashes of the text's labelled k-mers, in order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(K, len(own))
    out = np.full(len(own) - width + 1, width, np.uint64)
    for i in range(width):
        out = out * _ODD[1] + own[i:len(own) - width + 1 + i]
    out = mixed(out)
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    same = ranked[1:] == ranked[:-1]
    if same.any():
        start = np.concatenate([[True], ~same])
        at = np.arange(len(ranked))
        label = at - np.maximum.accumulate(np.where(start, at, 0))
        out[order] = mixed(ranked + label.astype(np.uint64) * _ODD[2])
    return out


def sketch(grams: np.ndarray) -> np.ndarray:
    """The entries: hashes of the two smallest k-mers of each function, in text order."""
    places, values = [], []
    for at in range(0, len(grams), STRIDE):
        part = (grams[at:at + STRIDE][None, :] ^ _MASK[:, None]) * _TURN[:, None]
        for _ in range(min(2, part.shape[1])):
            low = part.argmin(axis=1)[:, None]
            places.append(low + at)
            values.append(np.take_along_axis(part, low, 1))
            np.put_along_axis(part, low, np.uint64(2**64 - 1), 1)
    place, value = np.concatenate(places, 1), np.concatenate(values, 1)
    two = np.take_along_axis(place, np.argsort(value, axis=1, kind="stable")[:, :2], 1)
    two.sort(axis=1)
    return mixed(grams[two[:, 0]] * _ODD[3] + grams[two[:, -1]] * _ODD[4] + np.arange(ENTRIES, dtype=np.uint64))


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """Similarity of two texts' labelled k-mers, or a bound below ``least`` if it is less than that."""
    total = len(a) + len(b)
    _, first, second = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not total or len(first) < least / (1 + least) * total - 1e-9:
        return len(first) / max(1, total - len(first))
    need = int(np.ceil(least / (1 + least) * total - 1e-9))
    order = np.argsort(first)
    first, second = first[order], second[order]
    inside = (second - first <= len(b) - need) & (first - second <= len(a) - need)
    second = second[inside]
    if (np.diff(second) > 0).all():
        m = len(second)
    else:
        tails: list[int] = []
        for place in second.tolist():
            i = bisect_left(tails, place)
            tails[i:i + 1] = [place]
        m = len(tails)
    return m / (total - m)


def sketches(docs: DataFrame) -> DataFrame:
    """``text_key``, ``doc_id``, ``n`` (k-mers), ``keys`` (one for each band) of ``text_key``, ``doc_id``, ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            at, n, keys = [], [], []
            for i, text in enumerate(arrow_rows(batch, "text")):
                grams = kmers(text, hashes)
                if len(grams):
                    bands = sketch(grams).reshape(-1, ROWS)
                    band = mixed(bands[:, 0] * _ODD[5] + bands[:, 1] * _ODD[6] + np.arange(len(bands), dtype=np.uint64))
                    at.append(i), n.append(len(grams)), keys.append(band.view(np.int64))
            rows = batch.select(["text_key", "doc_id"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["text_key", "doc_id", "n", "keys"])

    return docs.select("text_key", "doc_id", "text").mapInArrow(run, with_columns(docs, "text_key, doc_id", "n long, keys array<long>"))


def packed(texts: DataFrame) -> DataFrame:
    """``node`` and ``grams``, its labelled k-mers in order, eight bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, hashes = pa.schema([("node", pa.binary()), ("grams", pa.binary())]), Words()
        for batch in batches:
            yield record_batch(schema, [batch.column("node"), [kmers(t, hashes).tobytes() for t in arrow_rows(batch, "text")]])

    return texts.select("node", "text").mapInArrow(run, "node binary, grams binary")


def settle(label: np.ndarray, asks: np.ndarray, grams: list[np.ndarray]) -> np.ndarray:
    """The labels after every pair with an asking end has been tested, or found to be in one class already."""
    label, n = label.copy(), np.array([len(g) for g in grams])
    ends = np.cumsum(n)
    _, ids = np.unique(np.concatenate(grams), return_inverse=True)
    owners = np.repeat(np.arange(len(n)), n)[np.argsort(ids, kind="stable")]
    held = np.bincount(ids)
    first = np.cumsum(held) - held
    centre = int(np.add.reduceat(held[ids], ends - n).argmax())
    for i in [centre, *range(len(n))]:
        # Where all ask, those of the centre's class may stay silent: a pair across classes has an end outside it.
        if not asks[i] or (asks.all() and i != centre and label[i] == label[centre]):
            continue
        own = ids[ends[i] - n[i]:ends[i]]
        many = held[own]
        at = np.repeat(first[own] - np.cumsum(many) + many, many) + np.arange(many.sum())
        shared = np.bincount(owners[at], minlength=len(n))
        for j in np.flatnonzero((shared >= SIMILAR / (1 + SIMILAR) * (n[i] + n) - 1e-9) & (label != label[i])).tolist():
            if label[i] != label[j] and similarity(grams[i], grams[j]) >= SIMILAR - 1e-9:
                label[label == label[j]] = label[i]
    return label


def links(cells: DataFrame, grams: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of roots that became one class in a cell, from ``cell``, ``node``, ``root``, ``asks``: a star for each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        for table in whole_cells(batches):
            cell = table.column("cell").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])).tolist()
            roots, asks = table.column("root").to_pylist(), table.column("asks").to_numpy()
            packs = [np.frombuffer(g.as_buffer(), np.uint64) for g in table.column("grams")]
            found = set()
            for s, e in zip(starts, [*starts[1:], len(cell)]):
                number = {root: i for i, root in enumerate(sorted(set(roots[s:e])))}
                names = list(number)
                before = np.array([number[r] for r in roots[s:e]])
                after = settle(before, asks[s:e], packs[s:e])
                centre: dict[int, int] = {}
                for old, new in sorted(set(zip(before.tolist(), after.tolist()))):
                    if centre.setdefault(new, old) != old:
                        found.add((names[centre[new]], names[old]))
            yield record_batch(schema, list(zip(*found)) if found else [[], []])

    rows = cells.select("cell", "node", "root", "asks").join(grams, "node").select("cell", "root", "asks", "grams")
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a binary, b binary").distinct()


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by cell, cut between cells; no cell has more than a few times CELL rows or CELL_KMERS k-mers, or two texts."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        cells = table.column("cell").to_numpy()
        cut = len(cells) - int((cells[::-1] == cells[-1]).cumprod().sum())
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def stored(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder, in as many partitions as its rows need."""
    kept = cut_lineage(df)
    return kept.coalesce(blocks(kept.count(), PART_ROWS))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) of all nodes of the links ``a``, ``b``."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b"))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b", "root": "near"}), "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("far"))
        moved = stored(lower.join(jump, lower["next"] == jump["at"], "left").select(
            "node", F.least("next", F.coalesce("far", "next")).alias("root"), (F.least("next", F.coalesce("far", "next")) != F.col("root")).alias("moved")))
        labels = moved.select("node", "root")
        if moved.where("moved").isEmpty():
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links, which join whole classes; only the roots they name take part."""
    root = labels.withColumnsRenamed({"node": "at", "root": "old"})
    for end in "ab":
        links = links.join(root, links[end] == root["at"], "left").withColumn(end, F.coalesce("old", end)).select("a", "b")
    moved = components(links.where("a != b"))
    out = labels.join(moved.withColumnsRenamed({"node": "old", "root": "new"}), labels["root"] == F.col("old"), "left")
    out = out.select("node", F.coalesce("new", "root").alias("root"))
    fresh = moved.join(labels.select("node"), "node", "left_anti")  # nodes that had no link yet
    return stored(out.unionByName(fresh))


def slots(rows: Column, kmers: Column, share: int = 1) -> Column:
    """Over how many cells, or shares of one, so many texts with so many k-mers are dealt."""
    return F.greatest(F.ceil(rows * share / CELL), F.ceil(kmers * share / CELL_KMERS))


def meetings(shared: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Cells in which the texts of dealt buckets that are outside the bucket's largest class ask all its texts.

    Two blocks of about half a cell at most make a cell. None if no such bucket holds several classes.
    """
    big = shared.where(slots(F.col("size"), F.col("kmers")) > 1)
    held = stored(big.join(labels, "node", "left").select("key", "node", "n", "size", "kmers", F.coalesce("root", "node").alias("root")))
    if held.isEmpty():
        return None
    largest = held.groupBy("key", "root").agg(F.count("*").alias("c"), F.sum("n").alias("k")).groupBy("key").agg(
        F.max(F.struct("c", "k", "root")).alias("top"))
    met = held.join(largest, "key").where("top.c < size").select(
        "key", "node", "root", (F.col("root") != F.col("top.root")).alias("outside"),
        slots(F.col("size") - F.col("top.c"), F.col("kmers") - F.col("top.k"), 2).alias("askers"), slots(F.col("size"), F.col("kmers"), 2).alias("blocks"))
    hashed = F.xxhash64("node", "key")
    ask = met.where("outside").select("*", F.pmod(hashed, F.col("askers")).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("asks"))
    answer = met.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("askers") - 1)).alias("i"), F.pmod(hashed, F.col("blocks")).alias("j"), F.lit(False).alias("asks"))
    return ask.unionByName(answer).select(F.xxhash64("key", F.lit("meet"), "i", "j").alias("cell"), "node", "root", "asks")


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_key`` (MD5 of the text), ``class_key``, ``class_id`` (its smallest id), ``n_class`` (its rows).

    Rows without a word have null keys and their own id as class.
    """
    spark = docs.sparkSession
    has_words = F.coalesce(F.length(F.trim("text")) > 0, F.lit(False)) & F.col("text").rlike(r"\S")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("text_key", F.when(has_words, F.unhex(F.md5("text"))))
    held = rows.where("text_key is not null")
    path = scratch_path(spark, "order-minhash")
    sketches(held).write.parquet(path)
    known = spark.read.parquet(path).groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    bands = known.select(F.col("text_key").alias("node"), "doc_id", "n", F.explode("keys").alias("key"))
    # Buckets of the same texts have the same size and the same two sums of hashes.
    sizes = bands.groupBy("key").agg(
        F.count("*").alias("size"), F.sum("n").alias("kmers"), *(F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"sum{i}") for i in (1, 2)))
    sizes = sizes.where("size > 1").groupBy("size", "kmers", "sum1", "sum2").agg(F.min("key").alias("key"))
    path = scratch_path(spark, "order-minhash")
    bands.join(sizes.select("key", "size", "kmers"), "key").write.parquet(path)
    shared = spark.read.parquet(path)
    chosen = shared.select(F.col("node").alias("_node"), F.col("doc_id").alias("_id")).distinct()
    path = scratch_path(spark, "order-minhash")
    texts = held.join(chosen, (held["text_key"] == F.col("_node")) & held["doc_id"].eqNullSafe(F.col("_id"))).select(held["text_key"].alias("node"), "text")
    packed(texts.dropDuplicates(["node"])).write.parquet(path)
    grams = spark.read.parquet(path)
    slot = F.pmod(F.xxhash64("node", "key"), slots(F.col("size"), F.col("kmers")))
    cells = shared.select(F.xxhash64("key", slot).alias("cell"), "node", F.col("node").alias("root"), F.lit(True).alias("asks"))
    labels = components(stored(links(cells, grams)))
    crossed = meetings(shared, labels)
    if crossed is not None:
        found = stored(links(crossed, grams))
        labels = labels if found.isEmpty() else joined(labels, found)
    of = rows.select("doc_id", "text_key")
    members = of.join(labels, of["text_key"] == labels["node"], "left").select(
        "doc_id", "text_key", F.coalesce("root", "text_key").alias("root"))
    tops = members.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_class"))
    out = members.join(tops, "root", "left")
    return out.select("doc_id", "text_key", F.col("root").alias("class_key"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_class", F.lit(1)).alias("n_class"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id (then of the smallest text key); null ids come last."""
    found = classes(docs, id_col=id_col, text_col=text_col)
    grouped = found.where("n_class > 1").groupBy("class_key")
    stays = grouped.agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"))
    stays = stays.select(F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"))
    several = found.where("n_class > 1").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    marked = several.join(stays.withColumn("_stays", F.lit(True)), several["_id"].eqNullSafe(stays["_id"]) & (several["_key"] == stays["_key"]), "left").select(
        several["_id"], several["_key"], F.coalesce("_stays", F.lit(False)).alias("_stays"))
    rows = boxed(docs, F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text_col))).alias("key"))
    out = rows.join(marked, rows["id"].eqNullSafe(marked["_id"]) & (rows["key"] == marked["_key"]), "left").select("row", "key", "_stays")
    # Repeated rows of a class's first text all carry the mark.
    one = out.where("_stays").dropDuplicates(["key"])
    return unboxed(out.where("_stays is null").select("row").unionByName(one.select("row")))
