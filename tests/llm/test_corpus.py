"""Operators across documents: lines, near-duplicates, mixing, URL lists, vector searches, the pipeline."""

from collections import Counter
from datetime import date
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import line_chunks, mixing, order_minhash, pivots, posting_lists, url_lists
from orderloom.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, slot long, key string, gone string"


def docs_of(spark, pairs, source=lambda i: "s"):
    rows = [(i, t, "en", source(n), len(t or ""), "r", 7, "k", "g") for n, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "events", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(LLM_ORACLES[name])
    columns = [d[0] for d in want.description]
    got = LLM_QUERIES[name](spark, "/root/testdata/sf0.01").select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


# Lines

def passage(seed, lines=30):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(10**6)}" for _ in range(8)) for _ in range(lines)]


def test_shared_lines_are_cut_at_the_same_places(spark):
    shared = passage(0, 60)
    docs = docs_of(spark, [(i, "\n".join(passage(i + 1, 3 + i) + shared + passage(i + 50, 4))) for i in range(4)])
    out = {r.row.doc_id: r for r in line_chunks.drop_repeated(docs).collect()}
    assert out[0].lines_gone == 0 and out[0].row.text == docs.where("doc_id = 0").first().text
    for i in (1, 2, 3):
        # All but the chunks at the two ends of the shared lines go; lines of the document's own stay.
        assert out[i].lines_gone > 40
        left = out[i].row.text.split("\n")
        assert set(passage(i + 1, 3 + i)) <= set(left) and set(passage(i + 50, 4)) <= set(left)


def test_lines_odd_rows(spark):
    block = "\n".join(passage(5, 12))
    docs = docs_of(spark, [(None, block), (3, block), (3, block), (4, None), (5, ""), (6, "\n\n\n"), (7, "\n\n\n"), (8, "x" * 200_000), (9, "a\n" * 50_000)])
    out = line_chunks.drop_repeated(docs)
    rows = Counter((r.row.doc_id, r.row.text) for r in out.collect())
    assert rows[(3, block)] == 2  # one id, one document
    assert rows[(4, None)] == rows[(5, "")] == rows[(6, "\n\n\n")] == rows[(7, "\n\n\n")] == rows[(8, "x" * 200_000)] == 1
    assert [r.lines_gone >= 6 for r in out.collect() if r.row.doc_id is None] == [True]  # a chunk of one line stays
    assert sum(rows.values()) == 9 and out.select("row.*").columns == docs.columns
    assert line_chunks.drop_repeated(docs.limit(0)).count() == 0


# Near-duplicates

def near_classes(docs):
    """Brute force: all pairs, dynamic programming, union."""
    hashes = order_minhash.Words()
    grams = {i: order_minhash.kmers(t or "", hashes).tolist() for i, t in docs}
    root = {i: i for i in grams}

    def find(i):
        return i if root[i] == i else find(root[i])

    names = sorted(grams)
    for x, i in enumerate(names):
        for j in names[x + 1:]:
            a, b = grams[i], grams[j]
            if not a or not b or min(len(a), len(b)) < 0.8 * max(len(a), len(b)):
                continue
            row = [0] * (len(b) + 1)
            for s in a:
                last = 0
                for k, t in enumerate(b, 1):
                    last, row[k] = row[k], last + 1 if s == t else max(row[k], row[k - 1])
            if row[-1] >= 0.8 * (len(a) + len(b) - row[-1]) - 1e-9:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in names}


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**9)}"
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for group in range(12):
        base = [f"g{rng.randrange(10**4)}" for _ in range(rng.choice([6, 20, 60, 120]))]
        texts += [" ".join(edited(base, rng.randrange(4), rng)) for _ in range(rng.choice([1, 2, 5, 9]))]
        if group % 3 == 0:
            half = len(base) // 2
            texts.append(" ".join(base[half:] + base[:half]))  # the same k-mers in another order
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs_of(spark, docs)).collect()}
    assert got == near_classes(docs)


def test_near_duplicates_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 6000]
    got = {r.doc_id: r.class_id for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_classes(rows)


def test_one_large_group(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    texts = [" ".join(base)] + [" ".join(edited(base, 2, rng)) for _ in range(1500)] + [" ".join(f"o{rng.random()}" for _ in range(50)) for _ in range(20)]
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs_of(spark, list(enumerate(texts)))).collect()}
    assert {got[i] for i in range(1501)} == {0} and all(got[i] == i for i in range(1501, 1521))


def test_every_pair_of_a_large_bucket_is_tested(spark, monkeypatch):
    """Texts about the threshold, with bounds so low that the buckets are dealt over many cells."""
    monkeypatch.setattr(order_minhash, "CELL", 16)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(100)]
    docs = [(i, " ".join(edited(base, 2, rng))) for i in range(160)]
    hashes = order_minhash.Words()
    grams, root = [order_minhash.kmers(t, hashes) for _, t in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if order_minhash.similarity(grams[i], grams[j]) >= 0.8 - 1e-9 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert 1 < len(set(root)) < len(docs)
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs_of(spark, docs)).collect()}
    assert got == dict(enumerate(root))


def test_a_cell_settles_every_pair_that_is_asked_for():
    rng = random.Random(6)
    hashes = order_minhash.Words()
    for size in (1, 2, 40):
        for share in (0.3, 1):
            bases = [[f"w{rng.randrange(60)}" for _ in range(n)] for n in (1, 30, 32, 80)]
            grams = [order_minhash.kmers(" ".join(edited(rng.choice(bases), rng.randrange(2), rng)), hashes) for _ in range(size)]
            asks = np.array([rng.random() < share for _ in grams])
            before = np.array([rng.choice([i, max(0, i - 1)]) for i in range(size)])
            after = order_minhash.settle(before, asks, grams)
            want = before.copy()
            for i in range(size):
                for j in range(size):
                    if asks[i] and order_minhash.similarity(grams[i], grams[j]) >= 0.8 - 1e-9:
                        want[want == want[j]] = want[i]
            assert [[a == b for b in after] for a in after] == [[a == b for b in want] for a in want]


def test_similarity_is_the_banded_alignment():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.permutation(30).astype(np.uint64)[:rng.integers(1, 30)]
        b = a.copy()
        for _ in range(rng.integers(0, 4)):
            i, j = rng.integers(0, len(b), 2)
            b[i], b[j] = b[j], b[i]
        b = b[:len(b) - rng.integers(0, min(3, len(b)))]
        row = [0] * (len(b) + 1)
        for s in a:
            last = 0
            for k, t in enumerate(b, 1):
                last, row[k] = row[k], last + 1 if s == t else max(row[k], row[k - 1])
        want, got = row[-1] / (len(a) + len(b) - row[-1]), order_minhash.similarity(a, b)
        assert got == want if want >= 0.8 else got < 0.8


def test_near_duplicates_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = docs_of(spark, [(5, text), (2, text), (2, text), (None, text), (7, None), (8, ""), (9, " "), (10, "One word"), (11, "one  WORD"), (2, "something else"), (12, "y " * 100_000)])
    out = order_minhash.classes(docs)
    assert Counter((r.doc_id, r.class_id, r.n_class) for r in out.collect()) == Counter(
        [(5, 2, 4), (2, 2, 4), (2, 2, 4), (None, 2, 4), (7, 7, 1), (8, 8, 1), (9, 9, 1), (10, 10, 2), (11, 10, 2), (2, 2, 1), (12, 12, 1)])
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(2, text), (7, None), (8, ""), (9, " "), (10, "One word"), (2, "something else"), (12, "y " * 100_000)])
    assert order_minhash.classes(docs.limit(0)).count() == 0 and order_minhash.keep_one(docs.limit(0)).count() == 0


# Mixing

@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 500, "b": 99, "c": 1}, {None: 3, "a": 7, "b": 7, "c": 7, "d": 1}, {str(i): 1 + i for i in range(40)}])
def test_schedule_stays_within_one_block(weights):
    given = mixing.shares(weights, 1000)
    steps, total = mixing.period(given), sum(given.values())
    assert sorted(t for _, _, t in steps) == list(range(total)) and min(given.values()) >= 1
    done = dict.fromkeys(given, 0)
    for source, i, slot in steps:
        assert i == done[source]
        assert i * total // given[source] <= slot < -(-(i + 1) * total // given[source])  # released, and in time
        done[source] += 1
        assert all(abs(done[s] * total - (slot + 1) * given[s]) < total for s in given)


def test_mixing_odd_rows(spark):
    names = ["a", "a", "a", "b", None]
    docs = docs_of(spark, [(i if i % 9 else None, f"text {i}" if i % 7 else None) for i in range(200)] + [(1, "text 1")] * 3, lambda n: names[n % 5])
    out = mixing.mix(docs, block=4)
    rows = out.collect()
    assert Counter(tuple(r.row) for r in rows) == Counter(map(tuple, docs.collect())) and out.select("row.*").columns == docs.columns
    assert len({(r.slot, r.place) for r in rows}) == len(rows)
    assert len({r.slot for r in rows}) == len({(r.row.source, r.block) for r in rows})
    assert mixing.mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 1})
    given = mixing.mix(docs, {"a": 2, "b": 1, None: 1}, block=1, slots=4).collect()
    first = Counter(r.row.source for r in given if r.slot < 40)
    assert (first["a"], first["b"], first[None]) == (20, 10, 10)


# URL lists

def test_validity_and_as_of(spark):
    log = spark.createDataFrame([
        ("l", "block", "domain", "x.org", "add", "2024-01-05"), ("l", "block", "domain", "x.org", "add", "2024-01-06"),
        ("l", "block", "domain", "x.org", "remove", "2024-01-10"), ("l", "block", "domain", "x.org", "remove", "2024-01-12"),
        ("l", "block", "domain", "x.org", "add", "2024-01-12"), ("m", "block", "domain", "x.org", "add", "2024-01-09"),
        ("n", "allow", "path", "www.x.org/good", "add", "2024-01-01"), ("n", "allow", "path", "www.x.org/good", "remove", "2024-02-01"),
        ("n", "allow", "domain", None, "add", "2024-01-01"), ("n", "block", "domain", "late.org", "add", None)],
        "list string, verdict string, kind string, pattern string, action string, dated string")
    spans = {(r.list, str(r.valid_from), str(r.valid_to)) for r in url_lists.validity_intervals(log).collect()}
    assert spans == {("l", "2024-01-05", "2024-01-10"), ("l", "2024-01-12", "None"), ("m", "2024-01-09", "None"), ("n", "2024-01-01", "2024-02-01")}
    cases = [
        ("http://a.x.org/p", "2024-01-04", "none", 0), ("http://a.x.org/p", "2024-01-05", "block", 1), ("HTTPS://u:p@A.X.ORG.:8080/p?q#f", "2024-01-09", "block", 2),
        ("http://x.org", "2024-01-10", "block", 1), ("http://notx.org/", "2024-01-20", "none", 0), ("http://www.x.org/good/page/", "2024-01-20", "allow", 3),
        ("http://www.x.org/goods", "2024-01-20", "block", 2), ("http://www.x.org/good", "2024-02-01", "block", 2), (None, "2024-01-20", "none", 0), ("http://x.org", None, "none", 0),
        ("", "2024-01-20", "none", 0), ("mailto:x.org", "2024-01-20", "none", 0), ("http://" + "a." * 100_000 + "x.org/" + "b/" * 100_000, "2024-01-20", "block", 2)]
    captures = spark.createDataFrame([(u, d, w, n, "p") for u, d, w, n in cases * 2], "url string, fetched string, want string, n long, pattern string")
    rows = url_lists.judge(captures, log).collect()
    assert len(rows) == 2 * len(cases) and all((r.verdict, r.n_active) == (r.row.want, r.row.n) for r in rows)
    assert {r.verdict for r in url_lists.judge(captures, log.limit(0)).collect()} == {"none"}
    assert url_lists.judge(captures.limit(0), log).count() == 0


def test_the_last_entry_of_a_day_counts(spark):
    log = spark.createDataFrame([
        ("l", "block", "domain", "x.org", action, f"2024-01-{day} {at}:00:00") for day, at, action in (
            ("05", "09", "remove"), ("05", "11", "add"), ("06", "10", "add"), ("06", "12", "remove"), ("08", "07", "add"), ("08", "07", "remove"))],
        "list string, verdict string, kind string, pattern string, action string, dated string")
    spans = {(str(r.valid_from), str(r.valid_to)) for r in url_lists.validity_intervals(log).collect()}
    assert spans == {("2024-01-05", "2024-01-06"), ("2024-01-08", "None")}


def test_every_event_is_an_entry_and_time_decides(spark):
    pages, events = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("pages", "events"))
    log = url_lists.report_log(pages, events)
    assert log.count() == events.count()
    assert url_lists.report_log(pages.limit(0), events).count() == url_lists.report_log(pages, events.limit(0)).count() == 0
    spans = url_lists.validity_intervals(log).toPandas()
    closed = spans[spans.valid_to.notna()]
    assert closed.pattern.nunique() > spans.pattern.nunique() / 2
    judged = url_lists.judge(url_lists.page_captures(pages), log).toPandas()
    assert (judged.verdict.value_counts() > 250).all() and set(judged.verdict) == {"allow", "block", "none"}
    # For one takedown list's pattern captures fall before, inside and after its intervals.
    takedowns = closed[closed.list == "takedowns"].merge(
        url_lists.page_captures(pages).select("fetched", url_lists.host_of(F.col("url")).alias("host"), url_lists.path_of(F.col("url")).alias("path")).toPandas().assign(
            pattern=lambda d: d.host + d.path), on="pattern")
    inside = (takedowns.valid_from <= takedowns.fetched) & (takedowns.fetched < takedowns.valid_to)
    assert (takedowns.fetched < takedowns.valid_from).sum() > 50 and inside.sum() > 50 and (takedowns.fetched >= takedowns.valid_to).sum() > 50


# Vectors

def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):  # sum() would compensate for rounding
        total += float(x) * float(y)
    return total


def brute(rows, is_query, k, value):
    out = {}
    clean = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    for q, a in clean:
        if is_query(q):
            best = {}
            for c, b in clean:
                if c != q:
                    best[c] = max(best.get(c, -np.inf), value(a, b))
            out[q] = sorted(((-s, c) for c, s in best.items()))[:k]
    return out


def test_exact_search(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(2000, None), (2100, [1.0, None]), (2200, [float("nan")] * 12), (2300, []), (2400, [0.0] * 12), (2500, [1.0, 2.0]), (None, [1.0] * 12)]
    rows += [rows[5], (2600, [3e38] * 12)]

    def score(a, b):
        n = max(-2**63, min(2**63 - 1, sum(int(np.floor(1024 * float(x))) * int(np.floor(1024 * float(y))) for x, y in zip(a, b))))
        return n

    got = {}
    for r in pivots.search(vectors_of(spark, rows), pivots.F.col("id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert got == brute(rows, lambda q: q % 100 == 0, 10, score)
    assert pivots.search(vectors_of(spark, rows[:0]), pivots.F.col("id") % 100 == 0).count() == 0
    assert pivots.search(vectors_of(spark, rows[:1]), pivots.F.col("id") % 100 == 0).count() == 0


def test_thresholds_leave_groups_unread(spark, monkeypatch):
    """Clusters far apart, groups of several blocks, copies and ties: the whole result, from a small share of the candidates."""
    monkeypatch.setattr(pivots, "CANDIDATES", 64)
    monkeypatch.setattr(pivots, "QUERIES", 2)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 20
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.2).astype(np.float32).tolist()) for i in range(1200)]
    rows += [(5000 + i, rows[100][1]) for i in range(150)]

    def score(a, b):
        return sum(int(np.floor(1024 * x)) * int(np.floor(1024 * y)) for x, y in zip(a, b))

    got, share = {}, {}
    for r in pivots.search(vectors_of(spark, rows), pivots.F.col("id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        share[r.query_id] = r.evaluated / (len(rows) - 1)
    assert got == brute(rows, lambda q: q % 100 == 0, 10, score)
    assert max(share.values()) <= 1 and np.mean(list(share.values())) < 0.6


def test_bounds_stop_the_search_early():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6)) * 4000
    rows = np.floor(np.repeat(centres, 500, axis=0) + rng.normal(size=(4000, 6)) * 40)
    far = pivots.distances(rows, pivots.choose(rows, 15))
    top, score, done = pivots.evaluate(rows[0], far[0], 0, np.arange(4000), rows, far, 10)
    want = sorted((-int(s), i) for i, s in enumerate(rows.astype(np.int64) @ rows[0].astype(np.int64)) if i)[:10]
    assert list(zip((-score).tolist(), top.tolist())) == want and done < 2000


def test_approximate_search(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.5, 2)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(3000 + i, rows[40][1]) for i in range(50)] + [(4000, None), (4020, [0.0] * 16), (4040, [float("inf")] * 16), (4060, [1.0, 2.0]), rows[7]]
    want = brute([(i, v) for i, v in rows if v and any(v)], lambda q: q % 20 == 0, 20, dot)
    got = {}
    for r in posting_lists.search(vectors_of(spark, rows), posting_lists.F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    hits = sum(len({v for v, _ in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and q not in dict(found)
        exact = {v: -s for s, v in brute([r for r in rows if r[0] in {q, *dict(found)}], lambda i: i == q, 99, dot)[q]}
        assert all(s == exact[v] for v, s in found)
    assert posting_lists.search(vectors_of(spark, rows[:0]), posting_lists.F.col("id") % 20 == 0).count() == 0
    assert posting_lists.search(vectors_of(spark, rows[:3]), posting_lists.F.col("id") % 20 == 0).count() == 2


# Pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.selectExpr("*", "'x' as row", "1 as slot", "2 as lang_pred").unionByName(
        docs.limit(1).selectExpr("-1L as doc_id", "cast(null as string) as text", "lang", "source", "n_chars", "'x' as row", "1 as slot", "2 as lang_pred"))
    now, seen = extra, extra.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF).cache()
        assert out.columns == now.columns and out.schema.simpleString() == now.schema.simpleString(), name
        assert stage(spark, now.limit(0), SF).count() == 0
        if name == "language_id":
            assert Counter(out.collect()) == Counter(r for r in now.collect() if any(map(str.isalpha, r.text or "")))
        if name == "line_dedup":
            before = {r.doc_id: r.text for r in now.collect()}
            assert all(set(r.text.split("\n")) <= set(before[r.doc_id].split("\n")) and r.n_chars == len(r.text) for r in out.collect())
        if name == "near_dedup":
            want = near_classes([(r.doc_id, r.text) for r in now.collect() if len(r.text) < 6000])
            assert {r.doc_id for r in out.collect() if len(r.text) < 6000} == set(want.values())
        if name == "source_mix":
            assert Counter(out.collect()) == Counter(now.collect())
        now, seen = out, out.count()
    final = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert final.count() == seen and {r.doc_id for r in final.collect()} == {r.doc_id for r in now.collect()}


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(len(r.ids) == 4 * r.n_tokens for r in rows)


def test_pipeline_keeps_the_mixed_order(spark, tmp_path):
    names = ["a", "a", "a", "b", None]
    docs = docs_of(spark, [(i, f"text {i} " + "x" * (i * 37 % 4000)) for i in range(600)], lambda n: names[n % 5])
    want = [r.doc_id for r in mixing.mix(docs).orderBy("slot", "place").select("row.doc_id").collect()]
    path = str(tmp_path / "mixed")
    # Uneven files: a scan takes the largest first.
    corpus_pipeline.source_mix(spark, docs, SF).write.option("maxRecordsPerFile", 70).parquet(path)
    read = spark.read.parquet(path)
    assert len(read.inputFiles()) > 4 and [r.doc_id for r in read.collect()] != want
    for table in (read, spark.createDataFrame(read.limit(0).collect(), read.schema)):
        rows = corpus_pipeline.byte_bpe(spark, table, SF).collect()
        assert sorted(r.position for r in rows) == list(range(len(rows)))
        assert [r.doc_id for r in sorted(rows, key=lambda r: r.position)] == want[:len(rows)]
    plain = corpus_pipeline.byte_bpe(spark, mixing.mix(docs).orderBy("slot", "place").select("row.*").coalesce(1), SF)
    assert [r.doc_id for r in plain.orderBy("position").collect()] == want


def test_dates_are_days():
    assert date.fromisoformat(url_lists.FIRST_DAY).year == 2024
