"""Operators 11 to 13 against brute force and DuckDB."""

import base64
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

from ledgerlens.llm import ranking, shallot, warc
from ledgerlens.llm.queries import ORACLE, QUERIES
from ledgerlens.llm.shared import scratch
from tests.conftest import SF_SMALL
from tools.compare_oracle import digest


@pytest.mark.parametrize("name", ["op11_shallot", "op12_warc_index", "op13_lemp"])
def test_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    res = con.execute(ORACLE[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(
        [c[0] for c in res.description], res.fetchall())[0]


# --- 11

def lloyd(points, ids, k, rounds, seed=3):
    """k-means by its definition; points are lists of ints."""
    order = sorted(range(len(points)), key=lambda i: (
        hashlib.sha256(f"{seed}:{ids[i]}".encode()).hexdigest() if ids[i] is not None else "~", points[i]))
    centres = [points[i] for i in order[:k]]
    near = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        at = [near(p)[1] for p in points]
        for j in range(len(centres)):
            if members := [p for p, a in zip(points, at) if a == j]:
                centres[j] = [sum(x) // len(members) for x in zip(*members)]
    return [(*reversed(near(p)),) for p in points], centres


@pytest.mark.parametrize("seed,k,spread", [(1, 8, 40), (2, 5, 3), (3, 30, 200)])
def test_clusters_equal_lloyds(spark, seed, k, spread):
    rnd = random.Random(seed)
    middle = [[rnd.randint(-500, 500) for _ in range(4)] for _ in range(6)]
    points = [[m + rnd.randint(-spread, spread) for m in rnd.choice(middle)] for _ in range(400)]
    points += [points[0]] * 20 + [points[1]] * 20  # equal vectors, and ties between them
    df = spark.createDataFrame([(i, [float(x) for x in p], "x") for i, p in enumerate(points)],
                               "vec_id long, embedding array<float>, near string").repartition(3)
    got = {r.vec_id: r for r in shallot.clusters(df, k=k, rounds=7, parts=4, scale=1, block=64).collect()}
    want, centres = lloyd(points, list(range(len(points))), k, 7)
    assert [(got[i].cluster, got[i].distance) for i in range(len(points))] == want
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    assert all(r.centroid_sha256 == names[r.cluster] for r in got.values())
    assert {r.inertia for r in got.values()} == {sum(d for _, d in want)}
    assert all(r.cluster_inertia == sum(d for c, d in want if c == r.cluster) for r in got.values())


def test_the_search_ball_leaves_work_out():
    """Bounds and ball decide most comparisons of well separated vectors, and never one wrongly."""
    rnd = np.random.default_rng(5)
    middle = rnd.integers(-10_000, 10_000, (40, 8))
    points = (middle[rnd.integers(0, 40, 4000)] + rnd.integers(-200, 200, (4000, 8))).astype(np.int32)
    at = points[rnd.choice(4000, 40, replace=False)].astype(np.int64)
    near, second = np.zeros(4000, np.int32), np.ones(4000, np.int32)
    upper, lower = np.full(4000, np.inf), np.zeros(4000)
    before, work = None, []
    for _ in range(6):
        work.append(shallot.assign(points, near, second, upper, lower, shallot.Centres(at, before)))
        d = ((points[:, None, :].astype(np.int64) - at) ** 2).sum(2)
        assert (near == d.argmin(1)).all()
        before, at = at, np.stack([points[near == j].mean(0).astype(np.int64) if (near == j).any() else at[j] for j in range(40)])
    assert max(work[1:]) < 0.3 * 4000 * 40 and work[-1] < 0.1 * 4000 * 40


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [-0.5, 0.0]), (None, [3.0, 3.0]), (2, None), (3, []), (4, [1.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or 0, r.cluster, r.distance) for r in shallot.clusters(df, k=8, rounds=2, parts=2, scale=4).collect())
    # three equal or unequal rows of id 1 and the null id are centroids; equal rows share the smaller number
    assert [g[0] for g in got] == [0, 1, 1, 1] and {g[2] for g in got} == {0} and len({g[1] for g in got}) == 3
    assert shallot.clusters(df.where("vec_id > 1"), parts=2).count() == 0
    assert shallot.clusters(df.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    one = shallot.clusters(df.where("vec_id = 1"), k=1, rounds=3, parts=2, scale=4).collect()
    assert {r.cluster for r in one} == {0} and len(one) == 3
    with pytest.raises(Exception, match="do not fit a long"):
        shallot.clusters(spark.createDataFrame([(1, [1e20, 0.0])], "vec_id long, embedding array<double>"), parts=2).collect()


# --- 12

def history(rows):
    """(page_id, bytes, digest, type, refers_to) by the definition, sorted."""
    groups = {}
    for page, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((page, url))
    out = []
    for payload, pages in groups.items():
        name = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        last = max((p for p, _ in pages if p is not None), default=None)
        pages.sort(key=lambda p: (p[0] is None, -(p[0] or 0), p[1] is not None, p[1] or ""))
        out += [(p, len(payload), name, "revisit" if i else "response", last if i else None) for i, (p, _) in enumerate(pages)]
    return sorted(out, key=str)


PAGES = [(1, "http://b.example.com/x?b=2&a=1#f", "<p>one</p>"), (2, "https://www.a.example.com", "<p>one</p>"),
         (3, None, None), (4, "http://a b\r\nX: y", ""), (None, "http://c.example", "<p>null</p>"),
         (7, "http://ü.example:8080/é", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"),
         (7, "http://ü.example:8080/é", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"),
         (8, "http://b.example.com/x?a=1&b=2", "é" * 300_000), (-3, "http://[bad", "<p>one</p>"), (9, "", "\r\n\r\n")]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "z", 5) for r in rows], "page_id long, url string, html string, digest string, salt int")


@pytest.mark.parametrize("hot_share", [1, 1000])
def test_archives_read_back(spark, hot_share):
    rnd = random.Random(4)
    rows = PAGES + [(100 + i, f"http://h{rnd.randrange(9)}.example/{rnd.randrange(30)}", f"<p>{rnd.randrange(60)}</p>") for i in range(600)]
    rows += [(1000 + i, "http://hot.example/", "<p>hot</p>") for i in range(300)]
    index = warc.capture_index(pages_of(spark, rows).repartition(5), archive_bytes=4000, range_entries=100,
                               block_entries=7, hot_share=hot_share)
    got = index.collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == history(rows)
    # one order over all ranges, whole histories, many runs merged in each range
    order = sorted(got, key=lambda r: (r.range, r.place))
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in order]
    assert keys == sorted(keys) and len({r.range for r in got}) > 4 and len({r.archive for r in got}) > 10
    assert all([r.place for r in order if r.range == k] == list(range(sum(r.range == k for r in order))) for k in {r.range for r in got})
    assert len({(r.archive, r.offset) for r in got}) == len(rows)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_are_warc(spark, compression):
    out = scratch(spark, "warc-test")
    warc.write_archives(pages_of(spark, PAGES).coalesce(1), out, compression=compression)
    files = [warc.plain(f.content) for f in spark.read.format("binaryFile").load(out).collect()]
    seen = []
    for f in files:
        for at, length, headers, block in warc.records(f):
            assert f[at:at + 10] == b"WARC/1.1\r\n" and f[at + length:at + length + 4] == b"\r\n\r\n"
            assert len(block) == int(headers["Content-Length"])
            seen.append(headers["WARC-Record-ID"])
            if headers["WARC-Type"] == "revisit":
                assert headers["WARC-Refers-To"] != seen[-1] and headers["WARC-Profile"].endswith("identical-payload-digest")
            else:
                assert "sha1:" + base64.b32encode(hashlib.sha1(bytes(block).split(b"\r\n\r\n", 1)[1]).digest()).decode() == headers["WARC-Payload-Digest"]
    assert len(seen) == len(set(seen)) == len(PAGES)
    with pytest.raises(ValueError, match="damaged"):
        [warc.entry("a", *r) for f in files for r in warc.records(f.replace(b"<p>one", b"<p>two"))]
    assert warc.capture_index(pages_of(spark, PAGES).limit(0)).count() == 0


def test_url_keys():
    assert warc.url_key("HTTPS://WWW.Example.com:443/A?b=2&a=1#x") == "com,example)/A?a=1&b=2"
    assert warc.url_key("http://example.com:8080") == "com,example:8080)/"
    assert warc.url_key(None) == warc.url_key("") == ""
    assert warc.url_key("http://[bad").isascii() and warc.url_key("/é").isascii()


def test_loser_tree_merges_runs_that_join_late():
    rnd = random.Random(7)
    tree, out, want, low = warc.LoserTree(), [], [], 0
    for _ in range(40):
        blocks = [sorted(("k%05d" % rnd.randrange(low, low + 400), rnd.randrange(3), rnd.randrange(9)) for _ in range(rnd.randrange(1, 9)))
                  for _ in range(rnd.randrange(1, 5))]
        want += [e for b in blocks for e in b]
        tree.add(blocks)
        for _ in range(rnd.randrange(12)):
            if (key := tree.first()) is not None and key[0] < "k%05d" % (low + 20):
                out.append(tree.pop())
        low += 20
    while tree.first() is not None:
        out.append(tree.pop())
    assert out == sorted(want)


# --- 13

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranking_by_definition(docs, items, top):
    words = lambda t: _TERM.findall((t or "").translate(_LOW))
    lists = [(d, words(t)) for d, t in docs]
    lists = [(d, w) for d, w in lists if w]
    n, length = len(lists), sum(len(w) for _, w in lists)
    out = []
    for item, text in items:
        scores = []
        for d, w in lists:
            m, total = 100 - 50 + (50 * len(w) * n) // length, 0
            for t in set(words(text)):
                if tf := w.count(t):
                    df = sum(t in x for _, x in lists)
                    total += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if total > 0:
                scores.append((-total, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_ranking_equals_its_definition(spark):
    rnd = random.Random(11)
    vocabulary = ["w%d" % i for i in range(30)] + ["É", "é", "日本", "ABC", "x1"]
    text = lambda n: " ".join(rnd.choices(vocabulary, [1 / (i + 1) for i in range(35)], k=n))
    docs = [(i, text(rnd.choice([1, 3, 20, 200]))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "?!"), (None, "w1 w29"), (3, docs[3][1]), (3, docs[3][1]), (205, "Abc-ABC,abc\x00w7")]
    docs += [(300 + i, "w5 w9 w9") for i in range(20)]  # ties
    items = [(i, text(rnd.choice([1, 4, 12]))) for i in range(12)] + [(1, "w1"), (1, "w1"), (None, "w2 W2"), (50, None), (51, ""), (52, "nowhere")]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, score int").repartition(3)
    q = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, rank int")
    want = ranking_by_definition(docs, items, 10)
    assert sorted(map(tuple, ranking.ranked(d, q, top=10).collect()), key=str) == want
    assert sorted(map(tuple, ranking.ranked(d, q, top=10, item_bytes=40).collect()), key=str) == want  # blocks of items
    for a, b in ((d.limit(0), q), (d, q.limit(0)), (d.where("doc_id = 200"), q)):
        assert ranking.ranked(a, b).collect() == []


def test_bounds_leave_work_out_and_lose_nothing():
    rnd = random.Random(3)
    vocabulary = ["w%d" % i for i in range(400)]
    docs = [" ".join(rnd.choices(vocabulary, [1 / (i + 1) for i in range(400)], k=rnd.randrange(5, 120))) for _ in range(3000)]
    block = ranking.Block([" ".join(rnd.sample(vocabulary, 6)) for _ in range(30)])
    counted = [ranking.terms(t) for t in docs]
    df = np.zeros(len(block.numbers), np.int64)
    rows = dict(ids=[], sizes=[], ends=[], terms=[], counts=[])
    for i, words in enumerate(counted):
        have, times = np.unique([block.numbers[w] for w in words if block.numbers[w] >= 0], return_counts=True)
        if len(have):
            df[have.astype(int)] += 1
            rows["ids"].append(i); rows["sizes"].append(len(words))  # noqa: E702
            rows["terms"] += have.astype(int).tolist(); rows["counts"] += times.tolist()  # noqa: E702
            rows["ends"].append(len(rows["terms"]))
    weight, n, length = ranking.weights(np.append(df, [len(docs), sum(map(len, counted))]))
    row = {k: np.array(v, "<i4" if k in ("terms", "counts") else "<i8").tobytes() for k, v in rows.items()}
    s = ranking.Slice({**row, "known": np.ones(len(rows["ids"]), bool).tobytes()}, weight, n, length)
    best = ranking.Best(30, 5, np.ones(30, np.int64))
    work = ranking.searched(s, block, best)
    dense = np.zeros((len(s.ids), len(block.numbers)), np.int64)
    dense[np.repeat(np.arange(len(s.ids)), s.lens), s.term] = s.value
    for i in range(30):
        scores = dense[:, block.item(i)].sum(1)
        order = np.lexsort((s.ids, -scores))[:5]
        assert best.held[i][:, 2].tolist() == s.ids[order].tolist() and (-best.held[i][:, 0]).tolist() == scores[order].tolist()
    assert work < 0.25 * 30 * len(s.ids)
