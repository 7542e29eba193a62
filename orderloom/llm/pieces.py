"""Merge-type SentencePiece encoding by backtracking, and its inverse.

The text is normalised as the model says. An Aho-Corasick automaton over the pieces gives the longest matches from left
to right. They are the encoding if all neighbours accept each other; two pieces accept each other if merging the
characters of both again, best score first and the left one of equals, ends with just these two (the answer is kept for each
pair). At the first pair that does not, the search goes back: the piece is given up for its next shorter prefix, and a
position from which no piece leads on is marked in a bit field and never tried again, so the work is linear in the text. A
merge across a border between two pieces would also happen if the two stood alone, so an encoding without a refused
pair is the one that the merges give.

Before that the text is cut where no piece can reach across: the characters are put into classes such that neighbours in
any piece are of one class, the space mark in front aside. What is cut out is mostly a word, whose ids are kept. Characters
that are in no piece become their bytes.

Null and empty texts give no ids. Long texts are encoded whole. Repeated rows give repeated results, an empty table an
empty one; other columns are not touched. Models must be of the merge type, with byte fallback, and without pieces of the
kinds "unused" and "user defined".
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib
from itertools import chain
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
import sentencepiece

from .common import arrow_rows, record_batch, text_batches, with_columns

SPACE = "▁"

# Words and pairs kept by a worker (twice as many at most: the older half goes when the newer is full), and the longest word kept.
KEPT_WORDS, KEPT_PAIRS, KEPT_LENGTH = 250_000, 500_000, 40

_encoders: dict[bytes, "Encoder"] = {}


class Encoder(dict):
    """Maps a word (cut out of a normalised text) to its ids."""

    def __init__(self, model: bytes):
        super().__init__()
        self.model = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        if any(map(sp.is_unused, range(len(sp)))):
            raise ValueError("the model has unused pieces")
        self.text_of = [sp.id_to_piece(i) for i in range(len(sp))]
        self.score_of = [sp.get_score(i) for i in range(len(sp))]
        plain = [i for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.ids = {self.text_of[i]: i for i in plain}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(sp.is_byte, self.byte_ids)):
            raise ValueError("the model has no byte fallback")
        characters = set(chain.from_iterable(self.ids))
        self.known = characters.issuperset
        if not characters <= self.ids.keys():
            raise ValueError("a piece holds a character that is no piece")
        # Pieces that the merges never give stay out, so that every piece accepts being one.
        self.automaton = ahocorasick.Automaton()
        for text, id_ in self.ids.items():
            if self.merged(text) == [id_]:
                self.automaton.add_word(text, id_)
        self.automaton.make_automaton()
        self.size_of, self.bits = list(map(len, self.text_of)), len(sp).bit_length()
        # The longest proper prefix that is a piece; -1: none.
        self.shorter = [-1] * len(sp)
        for text, id_ in self.ids.items():
            self.shorter[id_] = next((self.automaton.get(text[:k]) for k in range(len(text) - 1, 0, -1) if text[:k] in self.automaton), -1)
        self.words = re.compile(self.classes(), re.DOTALL).findall
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.older_pairs: dict[int, bool] = {}

    def classes(self) -> str:
        """A pattern of the runs that no piece reaches across."""
        parent = {c: c for c in chain.from_iterable(self.ids) if c != SPACE}

        def root(c: str) -> str:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        for text in self.ids:
            for a, b in zip(text, text[1:]):
                if b == SPACE != a:
                    return ".+"  # a space mark within a piece: nothing is cut
                if a != SPACE:
                    parent[root(a)] = root(b)
        members: dict[str, list[str]] = {}
        for c in sorted(parent):
            members.setdefault(root(c), []).append(c)
        # A character alone in its class comes by itself, unless some piece repeats it.
        doubled = {a for text in self.ids for a, b in zip(text, text[1:]) if a == b}
        runs = [re.escape("".join(m)) for m in members.values() if len(m) > 1 or m[0] in doubled]
        return f"{SPACE}*(?:" + "".join(f"[{m}]+|" for m in sorted(runs, key=len, reverse=True)) + f"[^{SPACE}])|{SPACE}+"

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        return list(chain.from_iterable(map(self.__getitem__, self.words(self.model.normalize(text)))))

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            ids = tuple(self.tokens(word))
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def tokens(self, word: str) -> list[int]:
        """Ids of a word: those of its runs of known characters, and the bytes of the others between them."""
        if self.known(word):
            return self.run(word)
        out, start = [], 0
        for at, c in enumerate(word):
            if c not in self.ids:
                out += self.run(word[start:at])
                out += [self.byte_ids[b] for b in c.encode()]
                start = at + 1
        return out + self.run(word[start:])

    def run(self, run: str) -> list[int]:
        """Ids of a run of known characters: its longest matches, mended from the first refused pair on."""
        taken, pairs, bits, last = [], self.pairs, self.bits, -1
        for _, piece in self.automaton.iter_long(run):
            if last >= 0:
                known = pairs.get(last << bits | piece)
                if not (self.accepts(last, piece) if known is None else known):
                    return self.back(run, taken, piece)
            taken.append(piece)
            last = piece
        return taken

    def back(self, run: str, taken: list[int], piece: int) -> list[int]:
        """The search from the place after ``taken``, where ``piece`` has just been refused."""
        sizes, shorter, longest, bits, end = self.size_of, self.shorter, self.automaton.iter_long, self.bits, len(run)
        failed = bytearray(end // 8 + 1)
        at, piece, last = sum(map(sizes.__getitem__, taken)), shorter[piece], taken[-1]
        while True:
            while piece >= 0:
                to = at + sizes[piece]
                if not failed[to >> 3] >> (to & 7) & 1:
                    if last < 0:
                        break
                    known = self.pairs.get(last << bits | piece)
                    if self.accepts(last, piece) if known is None else known:
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                if to == end:
                    return taken
                at, last = to, piece
                piece = next(longest(run, at))[1]
            else:  # nothing leads on from here
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at, last, piece = at - sizes[piece], taken[-1] if taken else -1, shorter[piece]

    def accepts(self, left: int, right: int) -> bool:
        """Whether two neighbours stay as they are when they are merged again."""
        key = left << self.bits | right
        known = self.older_pairs.get(key)
        if known is None:
            known = self.merged(self.text_of[left] + self.text_of[right]) == [left, right]
        if len(self.pairs) >= KEPT_PAIRS:
            self.older_pairs = dict(self.pairs)
            self.pairs.clear()
        self.pairs[key] = known
        return known

    def merged(self, text: str) -> list[int]:
        """Ids of a short text by merging its characters: the best score first, of equal ones the left."""
        ids, scores = self.ids, self.score_of
        parts = list(text)
        while len(parts) > 1:
            best, place, joined = -float("inf"), -1, ""
            for i in range(len(parts) - 1):
                both = parts[i] + parts[i + 1]
                id_ = ids.get(both)
                if id_ is not None and (place < 0 or scores[id_] > best):
                    best, place, joined = scores[id_], i, both
            if place < 0:
                break
            parts[place:place + 2] = [joined]
        return [ids[p] for p in parts]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids) if ids else []


def encoder(model: bytes) -> Encoder:
    """One encoder per worker process and model."""
    key = hashlib.sha256(model).digest()
    if key not in _encoders:
        _encoders[key] = Encoder(model)
    return _encoders[key]


def _shared(df: DataFrame, model: str):
    """The model file (some hundred kilobytes, read once on the driver) travels with the tasks."""
    with open(model, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of every whole text, without begin and end ids; with ``decoded`` also the text that
    the ids stand for, made in the same worker."""
    shared = _shared(docs, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for batch in batches:
            schema = pa.schema([batch.schema.field("doc_id"), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())),
                                *[("decoded", pa.string())] * decoded])
            for first, texts in text_batches(arrow_rows(batch, "text")):
                ids = [coder.encode(text) if text else [] for text in texts]
                sizes = np.array(list(map(len, ids)), np.int64)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), flat)
                yield record_batch(schema, [batch.column(0).slice(first, len(texts)), pa.array(sizes), lists, *[coder.decode(ids)] * decoded])

    return rows.mapInArrow(run, with_columns(rows, "doc_id", "n_tokens long, ids array<int>" + ", decoded string" * decoded))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``decoded``, the text that ``ids`` stand for (null: none), to ``doc_id``, ``n_tokens``, ``ids``."""
    shared = _shared(encoded, model)
    rows = encoded.select("doc_id", "n_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for batch in batches:
            texts = coder.decode([ids or [] for ids in arrow_rows(batch, "ids")])
            yield record_batch(pa.schema([*batch.schema, ("decoded", pa.string())]), [*batch.columns, texts])

    return rows.mapInArrow(run, with_columns(rows, "doc_id, n_tokens, ids", "decoded string"))
