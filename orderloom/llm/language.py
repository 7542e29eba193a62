"""Language by cross-parsing entropy against suffix automata of labelled text.

For each language a bounded sample of its labelled texts becomes one string and that string's suffix automaton. A text
is parsed greedily into the longest phrases that occur in the string; ``phrases * log2(sample length) / characters``
estimates the bits a character needs, and the language with the fewest wins (ties: the first name). Letters are
lower-cased, every run of other characters is one space, a letter that no sample has is a phrase of its own.

The whole text is parsed, in segments of ``SEGMENT`` characters with a phrase ending at each cut, so that numpy moves
many segments and all languages by one character at a step. Null texts and texts without a letter are ``und`` with score
0. Without any labelled text every answer is ``und``. Rows are independent: repeated rows repeat their results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import arrow_rows, id_text, record_batch, text_batches, with_columns

# The sample: texts of a language, characters taken of each, characters of a language in all.
SAMPLE_TEXTS, SAMPLE_EACH, SAMPLE_CHARS = 64, 1000, 12_000
SEGMENT = 1024
UNKNOWN = "und"


def plain(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of other characters than letters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _LETTERS[points]
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    return np.where(letters, points, 32)[keep]


_LETTERS = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)  # of every code point


def automaton(text: list[int], alphabet: int) -> np.ndarray:
    """[state, symbol] next states of the suffix automaton of a string of symbols; -1: no such substring."""
    nexts, link, size, last = [{}], [-1], [0], 0
    for symbol in text:
        new = len(nexts)
        nexts.append({})
        size.append(size[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in nexts[state]:
            nexts[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = nexts[state][symbol]
            if size[target] == size[state] + 1:
                link[new] = target
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[target]))
                size.append(size[state] + 1)
                link.append(link[target])
                link[target] = link[new] = copy
                while state >= 0 and nexts[state].get(symbol) == target:
                    nexts[state][symbol] = copy
                    state = link[state]
        last = new
    table = np.full((len(nexts), alphabet), -1, np.int32)
    for state, row in enumerate(nexts):
        if row:
            table[state, list(row)] = list(row.values())
    return table


class Parser:
    """The automata of all languages in one table of steps."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        strings = [plain(samples[name]) for name in self.languages]
        self.points = np.unique(np.concatenate(strings)) if strings else np.zeros(0, np.uint32)
        width = len(self.points) + 1  # the last symbol: letters of no sample
        tables, self.start, self.bits, offset = [], [], [], 0
        for string in strings:
            steps = automaton(np.searchsorted(self.points, string).tolist(), width)
            lost = len(steps)  # the state after a letter that is not in the sample
            steps = np.vstack([steps, np.full((1, width), -1, np.int32)])
            ends = steps < 0  # here a phrase ends and the symbol starts the next
            steps = np.where(ends, steps[0], steps)
            steps = np.where(steps < 0, lost, steps)
            # A step's value: twice the place of the next state's row, plus one if a phrase ended.
            tables.append(((steps.astype(np.int64) + offset) * width * 2 + ends).astype(np.int64).ravel())
            self.start.append(offset * width)
            self.bits.append(np.log2(max(2, len(string))))
            offset += len(steps)
        self.steps = np.concatenate(tables) if tables else np.zeros(0, np.int64)
        if len(self.steps) and self.steps.max() < 2**31:
            self.steps = self.steps.astype(np.int32)
        lookup = np.full(0x3400, width - 1, np.int64)
        small = self.points[self.points < len(lookup)]
        lookup[small] = np.arange(len(small))
        self.lookup = lookup

    def symbols(self, points: np.ndarray) -> np.ndarray:
        out = self.lookup[np.minimum(points, len(self.lookup) - 1)]
        if (far := points >= len(self.lookup) - 1).any():
            at = np.minimum(np.searchsorted(self.points, points[far]), len(self.points) - 1)
            out[far] = np.where(self.points[at] == points[far], at, len(self.points))
        return out

    def phrases(self, strings: list[np.ndarray]) -> np.ndarray:
        """[string, language] phrases of each string, a phrase ending at every ``SEGMENT``-th character."""
        owner = np.repeat(np.arange(len(strings)), [-(-len(s) // SEGMENT) for s in strings])
        lengths = np.concatenate([[SEGMENT] * (len(s) // SEGMENT) + [len(s) % SEGMENT] * (len(s) % SEGMENT > 0) for s in strings] or [[]]).astype(np.int64)
        flat = self.symbols(np.concatenate(strings)) if strings else np.zeros(0, np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        order = np.argsort(-lengths, kind="stable")
        lengths, starts, owner = lengths[order], starts[order], owner[order]
        count = np.ones((len(self.languages), len(lengths)), np.int32)
        state = np.repeat(np.array(self.start, self.steps.dtype)[:, None], len(lengths), axis=1)
        alive = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
        for step, n in enumerate(alive):
            if n < state.shape[1]:
                state = np.ascontiguousarray(state[:, :n])
            value = self.steps[state + flat[starts[:n] + step].astype(self.steps.dtype)]
            if step:
                count[:, :n] += value & 1
            state = value >> 1
        out = np.zeros((len(strings), len(self.languages)), np.int64)
        np.add.at(out, owner, count.T)
        return out

    def classify(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """Language, score and bits per character of each text.

        The score is the lead over the next language, ``1 - bits / bits of the next``; 1 if there is one language only.
        """
        strings = [plain(text) for text in texts]
        strings = [s if len(s) > 1 or (len(s) and s[0] != 32) else s[:0] for s in strings]
        if not self.languages:
            return [(UNKNOWN, 0.0, 0.0)] * len(texts)
        bits = self.phrases(strings) * np.array(self.bits)
        best = bits.argmin(axis=1)
        out = []
        for i, string in enumerate(strings):
            if not len(string):
                out.append((UNKNOWN, 0.0, 0.0))
                continue
            ranked = np.sort(bits[i])
            lead = 1.0 if len(ranked) == 1 else float(1 - ranked[0] / ranked[1])
            out.append((self.languages[best[i]], lead, float(ranked[0] / len(string))))
        return out


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", salts: int = 64) -> Parser:
    """A parser from at most ``SAMPLE_CHARS`` characters of each label of ``docs``, built on the driver.

    The texts with the smallest hashes of their ids are taken, so the sample does not depend on partitions.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_text(id_col)).alias("key"), F.col(text_col).alias("text"))
    keys = rows.select("lang", "key").distinct().withColumn("salt", F.pmod("key", F.lit(salts)))
    for part in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy("key"))
        keys = keys.withColumn("_rank", rank).where(f"_rank <= {SAMPLE_TEXTS}").drop("_rank")
    bounds = {r.lang: r.bound for r in keys.groupBy("lang").agg(F.max("key").alias("bound")).collect()}
    if not bounds:
        return Parser({})
    chosen: Column = F.lit(False)
    for lang, bound in bounds.items():
        chosen = chosen | ((F.col("lang") == lang) & (F.col("key") <= bound))
    texts = rows.where(chosen).groupBy("lang", "key").agg(F.min(F.substring("text", 1, SAMPLE_EACH)).alias("text"))
    samples: dict[str, str] = {}
    for row in sorted(texts.collect(), key=lambda r: (r.lang, r.key)):
        samples[row.lang] = (samples.get(row.lang, "") + " " + row.text)[:SAMPLE_CHARS]
    return Parser({lang: text for lang, text in samples.items() if any(map(str.isalpha, text))})


def predict(docs: DataFrame, parser: Parser, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1) and ``bits`` of every whole text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _mapped(rows, parser, "text", ["doc_id"])


def predict_rows(docs: DataFrame, parser: Parser, *, text_col: str = "text") -> DataFrame:
    """The documents as ``row`` with ``lang_pred``, ``score`` and ``bits``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    out = _mapped(rows, parser, names[docs.columns.index(text_col)], names)
    return out.select(F.struct(*(F.col(n).alias(c) for n, c in zip(names, docs.columns))).alias("row"), "lang_pred", "score", "bits")


def _mapped(rows: DataFrame, parser: Parser, text_col: str, stay: list[str]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(parser)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        for batch in batches:
            out = [x for _, texts in text_batches(arrow_rows(batch, text_col)) for x in parser.classify(texts)]
            kept = [batch.schema.get_field_index(c) for c in stay]
            schema = pa.schema([*(batch.schema.field(i) for i in kept), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64())])
            yield record_batch(schema, [*map(batch.column, kept), *(list(zip(*out)) if out else [[], [], []])])

    return rows.mapInArrow(run, with_columns(rows, ", ".join(stay), "lang_pred string, score double, bits double"))
