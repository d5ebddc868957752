"""Operators 4 and 5 against brute force."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import embeddings, jaccard
from ledgerlens.llm.queries import ORACLE
from ledgerlens.llm.shared import components, table
from tests.conftest import SF_SMALL
from tools.compare_oracle import digest

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = _WORD.findall((text or "").translate(_LOW))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def groups(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(docs):
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = groups(ids, links)
    return {d: (len(sets[d]), comp[d]) for d in ids}


def answers(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_test_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert answers(jaccard.linked(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_groups_chains_and_near_misses(spark):
    """Copies, near copies around the threshold, chains, and one common passage."""
    rng, docs = random.Random(3), []
    passage = [f"p{i}" for i in range(60)]
    for g in range(14):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 6, 40, 200, 200]))] + (passage if g % 3 == 0 else [])
        docs.append(base)
        for k in range(14):
            docs.append(edited(rng, rng.choice(docs[-1 - k:]), rng.choice([0, 0, 1, 2, 3, 5])))
    docs = [(i * 7 % 1009, " ".join(w)) for i, w in enumerate(docs)]
    want = brute(docs)
    assert 10 < len({c for _, c in want.values()}) < len(docs)
    df = spark.createDataFrame([(d, t.title(), d) for d, t in docs], "doc_id long, text string, n int").repartition(5)
    assert answers(jaccard.linked(df)) == want


def test_hot_grams_take_the_other_way(spark, monkeypatch):
    """With every n-gram hot, the aggregate and join give the same groups."""
    monkeypatch.setattr(jaccard, "HOT_LEAST", 0)
    monkeypatch.setattr(jaccard, "HOT_TIMES", 0)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    docs = [(i, " ".join(edited(rng, base, i % 4))) for i in range(40)]
    assert answers(jaccard.linked(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_sets_are_sent_only_where_they_can_be_similar(spark, monkeypatch):
    """Documents with one passage in common meet, but neither their sets are sent nor their
    n-grams compared again; an n-gram of two documents needs no further round."""
    made = {}

    def kept(df, name, *by):
        made.setdefault(name, []).append(out := stored(df, name, *by))
        return out

    stored = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", kept)
    rng, docs = random.Random(6), []
    for i in range(30):
        own = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        docs += [own + [f"p{i}q{k}" for k in range(8)], [f"v{rng.randrange(10**6)}" for _ in range(300)] + [f"p{i}q{k}" for k in range(8)]]
    docs += [edited(rng, docs[0], 2), list(docs[1])]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    monkeypatch.setattr(jaccard, "prefix_length", lambda n, percent=80: n)  # all n-grams meet
    monkeypatch.setattr(jaccard, "_place_fits", lambda *a: "true")
    assert answers(jaccard.linked(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)
    assert made["pairs"][0].count() >= 30
    assert {r[0] for df in made["asked"] for r in df.collect()} <= {0, 60}
    grams = {r.gram for r in made["left"][0].collect()}
    assert len(grams) <= 8  # those of the passage that three documents have


def test_sketches_lose_no_similar_pair():
    rng = np.random.default_rng(5)
    seen = set()
    for size in (1, 2, 7, 40, 700, 3000):
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 64, size, np.uint64, endpoint=False))
            keep = rng.random(len(a)) < rng.choice([0.1, 0.8, 0.9, 1])
            b = np.unique(np.concatenate([a[keep], rng.integers(0, 1 << 64, rng.integers(0, size // 5 + 2), np.uint64)]))
            exact, fit = jaccard.similar(a, b), jaccard.sketches_fit(jaccard.sketch(a), jaccard.sketch(b))
            assert fit or not exact
            seen.add((exact, fit))
    assert seen == {(True, True), (False, True), (False, False)}
    many = np.arange(2000, dtype=np.uint64)  # hashes that begin alike
    assert jaccard.sketch(many) == b"" and jaccard.sketches_fit(b"", jaccard.sketch(a))


def test_rows_without_words(spark):
    rows = [(1, None, 1), (2, "", 1), (3, " \t\n", 1), (4, "one two", 1), (5, "One  Two", 1), (6, "one", 1), (None, "one two", 1),
            (7, "x " * 30_000, 1), (8, "X " * 29_000, 1), (4, "one two", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = jaccard.linked(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert by == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), None: (1, None), 7: (1, 7), 8: (1, 7)}
    left = jaccard.one_of_each(df)
    assert left.columns == df.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 4, 6, 7]
    assert jaccard.linked(df.limit(0)).count() == 0


def test_filters_lose_no_similar_pair():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 60, 80, np.uint64))
        keep = rng.random(len(a)) < rng.choice([0.7, 0.85, 0.95])
        b = np.unique(np.concatenate([a[keep], rng.integers(0, 1 << 60, rng.integers(0, 12), np.uint64)]))
        exact = 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
        assert jaccard.similar(a, b) == exact
        if exact:
            assert jaccard.suffix_fits(a, b, 80)
            p, q = jaccard.prefix_length(len(a)), jaccard.prefix_length(len(b))
            assert set(a[:p].tolist()) & set(b[:q].tolist())


def test_shingle_sets_are_distinct_hashes():
    texts = ["a b c d e f", "A B c d e f ", "a b c", None, "", "\x0ba b c d e", "é É é ü ß x"]
    sets = [s.tolist() for s in jaccard.shingle_sets(pa.array(texts))]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[0] == sets[1] and sets[2] != sets[0] and set(sets[5]) < set(sets[0])


def test_components_of_stars_chains_and_loops(spark):
    edges = [(1, i) for i in range(2, 40)] + [(i, i + 1) for i in range(100, 160)] + [(7, 7), (300, 200), (200, 300)]
    ids = list(range(1, 60)) + list(range(100, 162)) + [200, 300]
    got = components(spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == groups(ids, edges)


def test_embeddings_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF_SMALL}/embeddings.parquet'")
    res = con.execute(ORACLE["op5_cover_tree"])
    df = embeddings.near_duplicates(table(spark, SF_SMALL, "embeddings"))
    rows = [tuple(r) for r in df.collect()]
    assert digest(df.columns, rows)[0] == digest([c[0] for c in res.description], res.fetchall())[0]


@pytest.mark.parametrize("block", [8, 1024])
def test_vectors_in_clusters(spark, monkeypatch, block):
    """Clusters, chains within the threshold, copies and scaled copies; small blocks make
    many cells and pairs of trees."""
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(5)
    x = []
    for _ in range(12):
        c = rng.normal(size=8)
        x += [c + rng.normal(size=8) * s for s in rng.choice([0, 0.03, 0.1, 0.3], 10)]
    x += [v * 3 for v in x[:5]] + [x[0]] * 4
    x = np.array(x)
    labels = [i % 2 for i in range(len(x))]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = [(a, b) for a in range(len(x)) for b in range(len(x)) if a != b and labels[a] == labels[b] and unit[a] @ unit[b] >= 0.98]
    comp = groups(range(len(x)), near)
    df = spark.createDataFrame([(i, v.tolist(), l, 0) for i, (v, l) in enumerate(zip(x, labels))],
                               "vec_id long, embedding array<double>, label int, n_links int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    assert got == {i: (sum(a == i for a, _ in near), comp[i], comp[i] == i) for i in range(len(x))}


def test_vectors_that_cannot_be_compared(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, -0.0], 1), (6, [nan, 1.0], 1),
            (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1e300, 0.0], 1), (12, [5e-324, 0.0], 1),
            (13, [1.0, 0.0], 2), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    linked = {1: (3, 1, True), 2: (3, 1, False), 11: (3, 1, False), 12: (3, 1, False)}
    assert got == {i: linked.get(i, (0, i, True)) for i, _, _ in rows}
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_vectors_that_share_an_id_and_labels_of_any_type(spark, kind):
    big = 1 << 40
    rows = [(1, [1.0, 0.0], big), (1, [0.0, 1.0], big), (2, [1.0, 0.01], big), (3, [0.0, 1.0], big + 1), (4, [0.0, 2.0], big + 1), (5, [0.0, 1.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").withColumn("label", F.col("label").cast(kind))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect())
    assert got == [(1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True)]
