"""Byte-level BPE by longest matches and backtracking, and its inverse.

The bytes of a piece are read as Latin-1 so that the trie of an Aho-Corasick automaton over all tokens finds the
longest matches from left to right, which mostly are the encoding already. From the first refused pair on the longest token
is taken whose neighbour on the left accepts it; where none is left the last token is given up for its next shorter prefix.
Two tokens accept each other if
no ranked merge crosses their border while they are being merged; the answer is kept per pair. An encoding in which all
neighbours accept each other is the one that the ranked merges give. Every end position is refused once at
most, so the work is linear in the piece.

Null and empty texts give no ids. Repeated rows give repeated results; other columns are not touched.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
import hashlib
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
import regex

from .common import arrow_rows, record_batch, with_columns

# Encodings of pieces (and answers on pairs) kept by a worker, twice as many at most: the older half goes when the newer is
# full. The longest piece kept.
KEPT_PIECES, KEPT_LENGTH = 200_000, 40

_encoders: dict[tuple[bytes, str], "Encoder"] = {}


class Encoder(dict):
    """Maps a piece to its ids as packed little-endian unsigned 32-bit integers."""

    def __init__(self, rank_file: bytes, pattern: str):
        super().__init__()
        self.bytes_of = token_bytes(rank_file)
        self.ranks = {token: rank for rank, token in enumerate(self.bytes_of) if token}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        if not all(bytes([b]) in self.ranks for b in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        self.size_of = list(map(len, self.bytes_of))
        # The longest proper prefix that is a token; -1: none.
        self.shorter = [next((self.ranks[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ranks), -1) for t in self.bytes_of]
        self.split = regex.compile(pattern).findall
        self.older: dict[str, bytes] = {}
        self.accepted: dict[int, bool] = {}
        self.older_accepted: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = {}, {}

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return unpack(ids, self.bytes_of)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            found = self.tokens(raw) if whole is None else [whole]
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def tokens(self, raw: bytes) -> list[int]:
        """Ids of a piece: its longest matches if all neighbours accept each other, else mended from the first refused pair on."""
        text, taken, accepted, last = raw.decode("latin-1"), [], self.accepted, -1
        for _, token in self.automaton.iter_long(text):
            if last >= 0:
                known = accepted.get(last << 32 | token)
                if not (self.accepts(last, token) if known is None else known):
                    return self.back(text, taken, token)
            taken.append(token)
            last = token
        return taken

    def back(self, text: str, taken: list[int], token: int) -> list[int]:
        """The search from the place after ``taken``, where ``token`` has just been refused."""
        sizes, shorter, longest, end = self.size_of, self.shorter, self.automaton.iter_long, len(text)
        refused = bytearray(end + 1)
        at, token, last = sum(map(sizes.__getitem__, taken)), shorter[token], taken[-1]
        while True:
            while token >= 0:
                to = at + sizes[token]
                if not refused[to]:
                    if last < 0:
                        break
                    known = self.accepted.get(last << 32 | token)
                    if self.accepts(last, token) if known is None else known:
                        break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                if to == end:
                    return taken
                at, last = to, token
                token = next(longest(text, at))[1]
            else:  # nothing leads on from here
                refused[at] = 1
                token = taken.pop()
                at, last, token = at - sizes[token], taken[-1] if taken else -1, shorter[token]

    def accepts(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.older_accepted.get(key)
        if known is None:
            known = not any(
                rank < dies and rank <= ends
                for x, born, dies in self.edge(left, 1) for y, starts, ends in self.edge(right, 0)
                if born <= ends and starts < dies and (rank := self.ranks.get(x + y)) is not None)
        if len(self.accepted) >= KEPT_PIECES:
            self.older_accepted = dict(self.accepted)
            self.accepted.clear()
        self.accepted[key] = known
        return known

    def edge(self, id_: int, side: int) -> list[tuple[bytes, int, float]]:
        """The parts that stand at the left (0) or right (1) end of a token while it is merged: each with the rank of
        the merge that makes it (-1: a byte) and of the one that ends it (infinite: the token itself).

        Equal merges are done from left to right, which decides ties between ``left`` and ``right`` above.
        """
        known = self.edges[side].get(id_)
        if known is None:
            known, part, end = [], self.bytes_of[id_], float("inf")
            while True:
                born = self.ranks[part] if len(part) > 1 else -1
                known.append((part, born, end))
                if born < 0:
                    break
                part, end = self.halves(part)[side], born
            self.edges[side][id_] = known
        return known

    def halves(self, token: bytes) -> list[bytes]:
        """The two parts that the last merge joins to this token."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranked = [self.ranks.get(a + b, len(self.bytes_of)) for a, b in zip(parts, parts[1:])]
            i = ranked.index(min(ranked))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts


def _encoder(rank_file: bytes, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = hashlib.sha256(rank_file).digest(), pattern
    if key not in _encoders:
        _encoders[key] = Encoder(rank_file, pattern)
    return _encoders[key]


def encode(docs: DataFrame, ranks: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (packed little-endian unsigned 32-bit) of every whole text.

    With ``decoded`` the ids are decoded again in the same worker and their bytes added. The rank file (about 1 MB, read once on the driver) travels with the tasks.
    """
    with open(ranks, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for batch in batches:
            ids = [encoder.encode(text) if text else b"" for text in arrow_rows(batch, "text")]
            schema = pa.schema([batch.schema.field("doc_id"), ("n_tokens", pa.int64()), ("ids", pa.binary()), *[("decoded", pa.binary())] * decoded])
            yield record_batch(schema, [batch.column(0), [len(x) // 4 for x in ids], ids, *[list(map(encoder.decode, ids))] * decoded])

    return rows.mapInArrow(run, with_columns(rows, "doc_id", "n_tokens long, ids binary" + ", decoded binary" * decoded))


def unpack(ids: bytes, bytes_of: list[bytes]) -> bytes:
    return b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def token_bytes(rank_file: bytes) -> list[bytes]:
    """The bytes of each id."""
    pairs = [line.split() for line in rank_file.splitlines() if line]
    out = [b""] * (max(int(rank) for _, rank in pairs) + 1)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """Adds ``decoded``, the bytes that ``ids`` stand for, to the columns ``doc_id``, ``n_tokens``, ``ids``."""
    with open(ranks, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    rows = encoded.select("doc_id", "n_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = token_bytes(shared.value)
        for batch in batches:
            texts = [unpack(ids or b"", bytes_of) for ids in arrow_rows(batch, "ids")]
            schema = pa.schema([*batch.schema, ("decoded", pa.binary())])
            yield record_batch(schema, [*batch.columns, texts])

    return rows.mapInArrow(run, with_columns(rows, "doc_id, n_tokens, ids", "decoded binary"))
