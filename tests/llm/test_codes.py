"""Vector codes, whitening and SentencePiece encoding against brute force and the library."""

from collections import Counter
from fractions import Fraction
import hashlib
import math
import random

from hypothesis import given, settings, strategies as st
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece

from orderloom.llm import codebooks, pieces, whitening
from orderloom.llm.queries import LLM_QUERIES, PIECE_BPE

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path(PIECE_BPE)
VECTORS = "vec_id long, embedding array<double>, label int, row string, code string, v long, error string, n long"


def vectors_of(spark, triples):
    return spark.createDataFrame([(i, v, l, "r", "c", 1, "e", 2) for i, v, l in triples], VECTORS)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# Limbs

@pytest.mark.parametrize("size", [3, 200, 10**6, 2**30 - 1])
def test_limb_products_are_exact(size):
    rng = random.Random(size)
    a = np.array([[rng.randrange(-size, size + 1) for _ in range(7)] for _ in range(20)])
    b = np.array([[rng.randrange(-size, size + 1) for _ in range(7)] for _ in range(9)])
    a[0], b[0] = size, -size
    bits = 11  # narrow limbs, so that small numbers need several too
    count = codebooks.limb_count(size, bits)
    got = codebooks.exact_products(codebooks.limbs(a, bits, count), codebooks.limbs(b.T, bits, count), (20, 9), bits)
    assert (got == (a.astype(object) @ b.T.astype(object))).all()


def test_limbs_stay_below_the_exact_range():
    for width in (1, 4, 33, 96, 4096):
        bits = codebooks.limb_bits(width)
        assert width * (2 ** bits) ** 2 <= 2 ** 53 < width * (2 ** (bits + 1)) ** 2 * 2
        assert codebooks.limb_count(2 ** (2 * bits), bits) == 3


def plain_codes(triples, parts, entries, rounds, scale):
    """Python integers, one distance after the other."""
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v], l) for i, v, l in triples if usable(v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    rows = [(i, v + [0] * (width * parts - len(v)), l) for i, v, l in kept]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width:(p + 1) * width] for _, v, _ in first] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in rows:
            far = [[sum((a - b) ** 2 for a, b in zip(v[p * width:(p + 1) * width], e)) for e in books[p]] for p in range(parts)]
            out.append([(f.index(min(f)), min(f)) for f in far])
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p * width:(p + 1) * width] for (_, v, _), f in zip(rows, found) if f[p][0] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    coded = [(i, "".join(f"{c:02x}" for c, _ in f), sum(d for _, d in f), l) for (i, _, l), f in zip(rows, assign())]
    by_label = Counter()
    for _, _, error, label in coded:
        by_label[label] += error
    text = ",".join(str(c) for b in books for e in b for c in e)
    return Counter((i, code, error, by_label[label]) for i, code, error, label in coded), hashlib.sha256(text.encode()).hexdigest()


def spark_codes(df, parts, entries, rounds, scale):
    coded, books = codebooks.compress(df, parts=parts, entries=entries, rounds=rounds, scale=scale)
    out = codebooks.with_group_error(coded, "label")
    assert out.select("row.*").columns == [c for c in df.columns if c != "embedding"]
    return Counter((r.row.vec_id, bytes(r.code).hex(), r.error, r.group_error) for r in out.collect()), books.sha256()


def odd_vectors(size):
    rng = random.Random(size)
    some = [(i, [rng.uniform(-size, size) for _ in range(8)], rng.choice([None, 1, 1, 1, 2])) for i in range(60)]
    some += [(100, None, 1), (101, [1.0, None] * 4, 1), (102, [float("nan")] * 8, 1), (103, [float("inf")] * 8, 2)]
    some += [(104, [], 3), (105, [1.5], None), (None, [2.0] * 8, 4), (7, [-3.0] * 8, 5), (7, [-3.0] * 8, 5), (7, [-4.0] * 8, 5)]
    some += [(200 + i, [float(i % 2)] + [0.0] * 7, 6) for i in range(10)]  # ties
    return some


@pytest.mark.parametrize("size, parts, entries", [(1.0, 4, 8), (40_000.0, 4, 8), (1.0, 3, 200), (2.0, 16, 5)])
def test_codes_equal_brute_force(spark, size, parts, entries):
    rows = odd_vectors(size)
    assert spark_codes(vectors_of(spark, rows).repartition(5), parts, entries, 2, 256) == plain_codes(rows, parts, entries, 2, 256)


def test_codes_of_few_and_no_rows(spark):
    none = vectors_of(spark, [(1, None, 1)])
    assert spark_codes(none, 4, 8, 2, 256) == plain_codes([], 4, 8, 2, 256)
    empty = [(1, [], 1), (2, [], None)]
    assert spark_codes(vectors_of(spark, empty), 4, 8, 2, 256) == plain_codes(empty, 4, 8, 2, 256)
    with pytest.raises(ValueError):
        codebooks.compress(vectors_of(spark, [(1, [1e30], 1)]))


# Bit slices

@pytest.mark.parametrize("size", [1, 2, 300, 2**20, 2**40])
def test_bit_slices_give_exact_products(size):
    rng = random.Random(size)
    x = np.array([[rng.randrange(size) for _ in range(5)] for _ in range(131)])
    x[:, 2] = 0
    want = x.astype(object).T @ x.astype(object)
    got = whitening.cross_products(x)
    upper = np.triu_indices(5)
    assert (got[upper] == want[upper]).all()


def exact_moments(rows, scale):
    kept = [v for _, v, _ in rows if usable(v)]
    dims = max(map(len, kept))
    x = np.array([[math.floor(Fraction(c) * scale) + whitening.OFFSET for c in v] + [whitening.OFFSET] * (dims - len(v)) for v in kept], object)
    return x, x.sum(0)


@pytest.mark.parametrize("size, mean", [(1.0, 0.0), (1.0, 9000.0), (30_000.0, 0.0)])
def test_whitening_equals_brute_force(spark, size, mean):
    rng = random.Random(int(size))
    rows = [(i, [mean + rng.gauss(0, size) * (d + 1) for d in range(6)], None) for i in range(300)]
    rows += [(400, None, 1), (401, [None] * 6, 1), (402, [float("inf")] * 6, 1), (403, [1.0], 1), (None, [2.0] * 6, 1), (5, [3.0] * 6, 1), (5, [3.0] * 6, 1), (6, [], 1)]
    x, sums = exact_moments(rows, 64)
    n = len(x)
    out = whitening.components_of(vectors_of(spark, rows).repartition(7), components=4).collect()
    assert len(out) == 4 * n and {r.component for r in out} == {1, 2, 3, 4} and {r.n for r in out} == {n}
    deviations = ((n * x - sums) ** 2).sum(1)
    assert Counter(r.deviation for r in out if r.component == 1) == Counter(d if d < 2**63 else None for d in deviations)
    cross = n * (x.T @ x) - np.outer(sums, sums)
    covariance = np.array([[float(Fraction(int(c), n * n)) for c in row] for row in cross])
    values = np.sort(np.linalg.eigvalsh(covariance))[::-1]
    for k in (1, 2, 3, 4):
        explained, = {r.explained for r in out if r.component == k}
        assert explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
    error, = {r.identity_error for r in out}
    assert 0 <= error < 1e-9
    white = np.array([[r.whitened for r in sorted(out, key=lambda r: r.component) if r.row.vec_id == i] for i in range(300) if i not in (5, 6)])
    whole = {r.row.vec_id: None for r in out}
    assert len(whole) == 302 and white.shape == (298, 4)
    assert abs(white.mean()) < 0.1 and out[0].row.asDict().keys() == {"vec_id", "label", "row", "code", "v", "error", "n"}


def test_wide_deviations_are_null(spark):
    rows = [(1, [3e6, 0.0], 1), (2, [-3e6, 1.0], 1), (3, [-3e12, 5.0], 1), (4, [1.0, 9.0], 1)]
    x, sums = exact_moments(rows, 64)
    deviations = ((4 * x - sums) ** 2).sum(1)
    out = whitening.components_of(vectors_of(spark, rows)).collect()
    assert {(r.row.vec_id, r.deviation) for r in out} == {(i + 1, d if d < 2**63 else None) for i, d in enumerate(deviations)}
    assert None in {r.deviation for r in out}


def test_whitening_of_few_and_no_rows(spark):
    def components(rows):
        return Counter(r.row.vec_id for r in whitening.components_of(vectors_of(spark, rows)).collect())

    assert components([(1, None, 1)]) == components([]) == components([(1, [1.0, 2.0], 1)]) == components([(1, [], 1), (2, [], 1)]) == {}
    assert components([(1, [1.0, 2.0], 1)] * 3) == {}
    assert components([(1, [1.0, 2.0, 7.0], 1), (2, [3.0, 2.0, 9.0], 1)]) == {1: 1, 2: 1}  # a line has one component


def test_whitening_query(spark):
    out = LLM_QUERIES["op12_whitening"](spark, SF).toPandas()
    table = pq.read_table(f"{SF}/embeddings.parquet")
    x = np.floor(np.array(table["embedding"].to_pylist()) * 64) + 1e6
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    want = centred @ vectors[:, ::-1][:, :32] / np.sqrt(values[::-1][:32])
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"].to_pylist()].to_numpy()
    assert np.allclose(got * np.sign((got * want).sum(0)), want, atol=1e-7)
    assert (out.identity_error <= 1e-4).all() and len(out) == 32 * len(x)


# Pieces

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    with open(MODEL, "rb") as file:
        return pieces.encoder(file.read())


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aeinrst \t\n▁é.,0'é日🎉\x00 �", max_size=80)))
def test_pieces_equal_the_library(library, coder, text):
    assert coder.encode(text) == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(3, 31_999), max_size=12))
def test_joined_pieces_equal_the_library(library, coder, ids):
    text = "".join(library.id_to_piece(i) for i in ids).replace("▁", " ")
    assert coder.encode(text) == library.encode(text)


@pytest.mark.parametrize("text", ["a" * 10_000, "ab" * 8_000, " " * 5_001, "▁" * 999, "é\x00" * 3_000, "日本" * 4_000,
                                  "".join(random.Random(3).choices("aeinst", k=30_000)), "the quick " * 40_000])
def test_long_pieces(library, coder, text):
    assert coder.encode(text) == library.encode(text)


def test_refused_pairs_are_searched_on(library, coder):
    """Longest matches alone would be wrong for many words; stores that overflow change nothing."""
    rng = random.Random(5)
    words = ["▁" + "".join(rng.choices("aeinrstlohc", k=rng.randrange(2, 16))) for _ in range(3_000)]
    longest = [[id_ for _, id_ in coder.automaton.iter_long(w)] for w in words]
    want = library.encode([w[1:] for w in words])
    assert [list(coder[w]) for w in words] == want
    assert sum(a != b for a, b in zip(longest, want)) > 500


def test_small_stores(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 3)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 5)
    with open(MODEL, "rb") as file:
        small = pieces.Encoder(file.read())
    rng = random.Random(6)
    for _ in range(50):
        text = " ".join("".join(rng.choices("aeinrst", k=rng.randrange(1, 12))) for _ in range(40))
        assert small.encode(text) == library.encode(text)
    assert len(small) <= 3 and len(small.older) <= 3 and len(small.pairs) <= 5


def test_pieces_query_equals_the_library(spark, library):
    texts = {i: t or "" for i, t in zip(*(pq.read_table(f"{SF}/documents.parquet")[c].to_pylist() for c in ("doc_id", "text")))}
    got = LLM_QUERIES["op13_sentence_pieces"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_odd_rows(spark, library):
    texts = [(None, "a b"), (1, None), (2, ""), (3, " "), (4, "word " * 60_000), (5, "twice"), (5, "twice"), (6, "<s>\x00</s>  x")]
    docs = spark.createDataFrame([(i, t, "ids", 3, "d") for i, t in texts], "doc_id long, text string, ids string, n_tokens long, decoded string")
    out = pieces.encode(docs, MODEL, decoded=True)
    want = Counter((i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in texts)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in out.collect()) == want
    again = pieces.decode(out.drop("decoded"), MODEL).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in again) == want
    assert pieces.encode(docs.limit(0), MODEL).count() == 0 == pieces.decode(out.drop("decoded").limit(0), MODEL).count()
