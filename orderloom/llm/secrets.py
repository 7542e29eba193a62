"""Secrets by patterns and by a linear-chain conditional random field.

Tokens (runs without white space) are tagged outside, begin or inside. A token's scores are sums of learnt weights of
its own shape, of the shapes of the words before and after it, and of features of the whole file; neighbouring tags
add a transition weight. The weights maximise the likelihood of weak labels: tokens that hold the secret part of a
pattern match, in windows from a bounded sample of texts. Every whole text is then decoded by Viterbi. Texts are
decoded side by side, one token of each at a step, so that numpy does the work.

A decoded run of tokens that meets no pattern match is added as a span of kind ``crf``, without the marks around it.
Null and empty texts have no spans; without any match in the sample nothing is learnt and only the patterns work.
Long texts are decoded whole. Rows are independent, so repeated rows and ties of ids repeat their results.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_rows, id_text, record_batch, sample_bound, text_batches, with_columns

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
# What a lower-cased text must hold for ASSIGN to match at all.
ASSIGN_WORDS = ("passw", "secret", "token", "api")

# The sample: so many texts, so many windows of their tokens, and so many tokens on each side of a match.
SAMPLE_TEXTS, SAMPLE_WINDOWS, SIDE = 4096, 1024, 12
ROUNDS, RATE, DECAY = 150, 0.15, 1e-4
OUTSIDE, BEGIN, INSIDE = range(3)
# Tokens whose scores a worker keeps; then the store starts anew.
KEPT_TOKENS = 400_000

HINT = re.compile(r"passw|secret|token|api_?key|auth|credential|private", re.I)
MARKS = "\"'`,;:.()[]{}<>!?="


def pattern_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret part) of all pattern matches, in order."""
    found, low = [], text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    found += [(m.start(), kind, m.end(), m.start()) for kind, pattern in ((1, ACCESS), (2, HEX)) for m in pattern.finditer(text)]
    return sorted(found)


def token_features(token: str) -> list[int]:
    """Numbers of the features that a token's shape has."""
    n = len(token)
    if token.isalpha():  # what is left of the checks below for a plain word
        out = [min(n, 64).bit_length(), 8, 12, 16 + min(3, len(set(token)) * 4 // n), 20]
        checks = (
            (21, token.islower()), (22, token.isupper()), (23, token[0].isupper()), (25, not token.strip("abcdef")),
            (26, not token.strip("ABCDEFGHIJKLMNOPQRSTUVWXYZ")), (35, HINT.search(token)), (36, token.startswith("AKIA")), (37, n >= 16), (38, n >= 24),
        )
        return out + [feature for feature, holds in checks if holds]
    core = token.strip(MARKS)
    if core.isalpha():
        digits = turns = 0
    else:
        digits = sum(map(str.isdigit, token))
        turns = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:])) if digits else 0
    out = [
        min(n, 64).bit_length(),                                       # 0-7
        8 + (0 if not digits else 1 + min(2, 6 * digits // (2 * n))),  # 8-11
        12 + (0, 1, 1, 2, 2, 2, 3)[min(turns, 6)],                     # 12-15
        16 + min(3, len(set(core)) * 4 // max(1, len(core))),          # 16-19
    ]
    checks = (
        core.isalpha(), core.islower(), core.isupper(), core[:1].isupper(), core.isdigit(),
        bool(core) and not core.strip("0123456789abcdef"), bool(core) and not core.strip("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
        "=" in token, ":" in token, token[-1:] in "=:", token[:1] in "\"'", "@" in token, "." in core, "/" in token,
        "-" in token or "_" in token, bool(HINT.search(token)), token.startswith("AKIA"), len(core) >= 16, len(core) >= 24,
        any(len(part) >= 8 and not part.isalpha() and not part.isdigit() for part in re.split(r"[=:\"']", token)),
    )
    return out + [20 + i for i, holds in enumerate(checks) if holds]


TOKEN_FEATURES, FILE_FEATURES = 40, 9


def file_features(tokens: list[str], text: str) -> list[int]:
    """Numbers of the features of a whole file: its size, its assignments, its share of digits."""
    size, marks = len(tokens), text.count("=") + text.count(":")
    digits = sum(text.count(d) for d in "0123456789")
    return [min(2, size // 100), 3 + min(2, marks), 6 + min(2, 50 * digits // max(1, len(text)))]


class Shapes(dict):
    """Maps a token to the number of its set of features; ``sets`` holds the sets seen so far."""

    def __init__(self):
        super().__init__()
        self.sets: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}

    def __missing__(self, token: str) -> int:
        features = tuple(token_features(token))
        number = self.number.get(features)
        if number is None:
            number = self.number[features] = len(self.sets)
            self.sets.append(features)
        self[token] = number
        return number


class Field:
    """Weights of the random field; ``scores`` and ``decode`` work on batches of texts."""

    def __init__(self, shape: np.ndarray, file: np.ndarray, turn: np.ndarray):
        self.shape, self.file, self.turn = shape, file, turn  # [place, feature, tag], [feature, tag], [tag, next tag]
        self.known = Shapes()
        self.rows = np.zeros((0, 3, 3), np.float32)

    def scores(self, tokens: list[str], text: str) -> np.ndarray:
        """[token, tag] scores of one text."""
        if len(self.known) >= KEPT_TOKENS:
            self.known.clear()
        numbers = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        if new := self.known.sets[len(self.rows):]:
            self.rows = np.concatenate([self.rows, [self.shape[:, list(f)].sum(axis=1) for f in new]]).astype(np.float32)
        rows = self.rows[numbers]
        out = rows[:, 0] + self.file[file_features(tokens, text)].sum(axis=0)
        out[1:] += rows[:-1, 1]
        out[:-1] += rows[1:, 2]
        return out

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best tags of each text by Viterbi; all texts move one token a step, longest first."""
        order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
        lengths = np.array([len(scores[i]) for i in order])
        if not len(lengths) or not lengths[0]:
            return [np.zeros(0, np.int8) for _ in scores]
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.concatenate([scores[i] for i in order])
        back = np.zeros((len(flat), 3), np.int8)
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than the step
        best = flat[offsets[:alive[0]]]
        final = np.zeros(len(lengths), np.int8)
        for step in range(1, lengths[0]):
            n = alive[step]
            if n < len(best):
                final[n:len(best)] = best[n:].argmax(axis=1)
                best = best[:n]
            paths = best[:, :, None] + self.turn
            came = paths.argmax(axis=1)
            back[offsets[:n] + step] = came
            best = np.take_along_axis(paths, came[:, None], axis=1)[:, 0] + flat[offsets[:n] + step]
        final[:len(best)] = best.argmax(axis=1)
        tags = np.zeros(len(flat), np.int8)
        now = final.copy()
        for step in range(lengths[0] - 1, -1, -1):
            n = alive[step]
            at = offsets[:n] + step
            tags[at] = now[:n]
            now[:n] = back[at, now[:n]]
        out: list = [None] * len(scores)
        for i, start, n in zip(order, offsets, lengths):
            out[i] = tags[start:start + n]
        return out


def weak_windows(text: str) -> list[tuple[list[str], list[int], list[int]]]:
    """Windows of a text: tokens, tags from its pattern matches, numbers of its file features."""
    places = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    if not places:
        return []
    starts = np.array([a for a, _ in places])
    ends = np.array([b for _, b in places])
    tags, centres = [OUTSIDE] * len(places), []
    for _, _, end, secret in pattern_spans(text):
        first, last = int(np.searchsorted(ends, secret, "right")), int(np.searchsorted(starts, end, "left"))
        if first < last and tags[first] == OUTSIDE:
            tags[first:last] = [BEGIN] + [INSIDE] * (last - first - 1)
            centres.append(first)
    tokens = text.split()
    centres.append(int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % len(tokens))  # one window of any place
    file = file_features(tokens, text)
    return [(tokens[(a := max(0, c - SIDE)):c + SIDE], tags[a:c + SIDE], file) for c in centres]


def learn(windows: list[tuple[list[str], list[int], list[int]]]) -> Field:
    """Weights that maximise the likelihood of the windows' tags, less a penalty on large weights."""
    width = TOKEN_FEATURES
    longest, count = max(len(w[0]) for w in windows), len(windows)
    seen = np.zeros((count, longest, 3 * width + FILE_FEATURES), np.float32)
    gold, live = np.zeros((count, longest), np.int64), np.zeros((count, longest), bool)
    for i, (tokens, tags, file) in enumerate(windows):
        features = [token_features(t) for t in tokens]
        for j, own in enumerate(features):
            seen[i, j, own] = 1
            if j:
                seen[i, j, [width + f for f in features[j - 1]]] = 1
            if j + 1 < len(features):
                seen[i, j, [2 * width + f for f in features[j + 1]]] = 1
            seen[i, j, [3 * width + f for f in file]] = 1
        gold[i, :len(tags)], live[i, :len(tags)] = tags, True
    weights, turn = np.zeros((seen.shape[2], 3), np.float32), np.zeros((3, 3), np.float32)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(turn), np.zeros_like(turn)]
    onehot = np.eye(3, dtype=np.float32)[gold] * live[:, :, None]
    pairs = onehot[:, :-1, :, None] * onehot[:, 1:, None, :]
    flat = seen.reshape(-1, seen.shape[2])

    def soft(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)

    for t in range(1, ROUNDS + 1):
        own = (flat @ weights).reshape(count, longest, 3)
        ahead, behind = own.copy(), np.zeros_like(own)
        for j in range(1, longest):
            step = soft(ahead[:, j - 1, :, None] + turn, 1) + own[:, j]
            ahead[:, j] = np.where(live[:, j, None], step, ahead[:, j - 1])
        for j in range(longest - 2, -1, -1):
            step = soft(turn + (own[:, j + 1] + behind[:, j + 1])[:, None, :], 2)
            behind[:, j] = np.where(live[:, j + 1, None], step, behind[:, j + 1])
        total = soft(ahead[:, -1], 1)
        single = np.exp(ahead + behind - total[:, None, None]) * live[:, :, None]
        double = np.exp(ahead[:, :-1, :, None] + turn + (own + behind)[:, 1:, None, :] - total[:, None, None, None])
        double *= live[:, 1:, None, None]
        steps = (flat.T @ (onehot - single).reshape(-1, 3) / count - DECAY * weights, (pairs - double).sum(axis=(0, 1)) / count - DECAY * turn)
        for k, (target, gradient) in enumerate(zip((weights, turn), steps)):
            moments[2 * k] += 0.1 * (gradient - moments[2 * k])
            moments[2 * k + 1] += 0.01 * (gradient ** 2 - moments[2 * k + 1])
            target += RATE * (moments[2 * k] / (1 - 0.9 ** t)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99 ** t)) + 1e-8)
    return Field(weights[:3 * width].reshape(3, width, 3), weights[3 * width:], turn)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    """The field, learnt on the driver from at most ``SAMPLE_WINDOWS`` windows; None if no match is among them."""
    rows = docs.select(F.xxhash64(id_text(id_col)).alias("key"), F.col(text_col).alias("text"))
    bound = sample_bound(rows, F.col("key"), SAMPLE_TEXTS)
    if bound is None:
        return None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("plain", pa.bool_()), ("key", pa.int64()), ("tokens", pa.list_(pa.string())), ("tags", pa.list_(pa.int32())), ("file", pa.list_(pa.int32()))])
        for batch in batches:
            found = [(BEGIN not in w[1], key, *w) for key, text in zip(arrow_rows(batch, "key"), arrow_rows(batch, "text")) for w in weak_windows(text or "")]
            yield record_batch(schema, list(zip(*found)) if found else [[]] * 5)

    windows = rows.where(F.col("key") <= bound).mapInArrow(
        cut, "plain boolean, key long, tokens array<string>, tags array<int>, file array<int>")
    order = ("key", "tokens", "tags")
    taken = [windows.where(which).orderBy(*order).limit(SAMPLE_WINDOWS // 2).collect() for which in ("not plain", "plain")]
    if not taken[0]:
        return None
    return learn([(r.tokens, r.tags, r.file) for part in taken for r in part])


def find(docs: DataFrame, field: Field | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: ``doc_id`` and ``spans``, an array of (kind, start, end) in code points, end exclusive.

    Spans are in order of start, then kind as in ``KINDS``; those of ``crf`` meet no pattern match.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = rows.sparkSession.sparkContext.broadcast(field and (field.shape, field.file, field.turn))
    name = hashlib.md5(b"".join(np.ascontiguousarray(x).tobytes() for x in shared.value or ())).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value and name not in _fields:
            _fields.clear()
            _fields[name] = Field(*shared.value)
        model = _fields.get(name)
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            out: list[list[tuple[str, int, int]]] = []
            for _, texts in text_batches(arrow_rows(batch, "text")):
                out += all_spans(texts, model)
            rows_out = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in out]
            yield record_batch(pa.schema([batch.schema.field("doc_id"), ("spans", span)]), [batch.column(0), rows_out])

    return rows.mapInArrow(run, with_columns(rows, "doc_id", "spans array<struct<kind:string,start:bigint,end:bigint>>"))


_fields: dict[str, Field] = {}


def all_spans(texts: list[str], model: Field | None) -> list[list[tuple[str, int, int]]]:
    tokens = [text.split() for text in texts]
    tags = model.decode([model.scores(t, text) for t, text in zip(tokens, texts)]) if model else [()] * len(texts)
    out = []
    for text, tagged in zip(texts, tags):
        base = pattern_spans(text)
        found = [(start, kind, end) for start, kind, end, _ in base]
        if model and (marked := np.flatnonzero(tagged != OUTSIDE)).size:
            places = [m.span() for m in re.finditer(r"\S+", text)]
            runs: list[list[int]] = []
            for i in marked.tolist():
                if tagged[i] == INSIDE and runs and runs[-1][1] == i:
                    runs[-1][1] = i + 1
                else:
                    runs.append([i, i + 1])
            for first, last in runs:
                a, b = places[first][0], places[last - 1][1]
                inner = text[a:b].strip(MARKS)
                a += text[a:b].find(inner)
                b = a + len(inner)
                if inner and not any(start < b and a < end for start, _, end, _ in base):
                    found.append((a, KINDS.index("crf"), b))
        out.append([(KINDS[kind], start, end) for start, kind, end in sorted(found)])
    return out
