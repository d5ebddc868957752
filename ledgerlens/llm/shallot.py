"""Operator 11: exact k-means in integers by Shallot search.

A vector remembers its nearest and second-nearest centroid, an upper bound of its distance
to the first and a lower bound of its distance to all others. When the centroids move, the
bounds move with them; a vector whose bounds still decide is not looked at. Any other one
starts from the closer of the two it remembers and scans that centroid's neighbours in order
of distance: a centroid farther from the start than the vector's distance to the start plus
that to the second-nearest so far cannot be among the nearest two, so the scan ends there,
and every closer second shrinks the ball. What is left is compared by integer distances.

Vectors live in blocks, a row each. A round rewrites the blocks with their new bounds and,
per block, what changed in each centroid's sum and count; Spark adds those up, and only
``k * (parts + 1)`` sums come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import discard, scratch

CENTROIDS, ROUNDS, PARTS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Vectors of a block.
BLOCK = 4096
#: Integer components are below this, so that a squared distance fits 64 bits.
LARGEST = 1 << 27
#: Far above the rounding errors of the distances' square roots, below any difference
#: that could matter for a bound: a vector this close to undecided is compared exactly.
SLACK = 1e-3

_BLOCK = ("ids binary, known binary, points binary, near binary, second binary, "
          "upper binary, lower binary, change array<long>")
_RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
           "centroid_sha256 string")


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row squared distances of integer vectors, exact."""
    d = a.astype(np.int64) - b
    return np.einsum("ij,ij->i", d, d)


class Centres:
    """Centroids with what a search needs: distances between them, each one's neighbours
    in order of distance, half the distance to the nearest, and how far each has moved."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at = at
        k = len(at)
        self.gap = np.sqrt(np.stack([squared(at, c[None, :]) for c in at]).astype(np.float64))
        away = self.gap + np.diag(np.full(k, np.inf))
        self.neighbours = np.argsort(away, 1, kind="stable")[:, :-1]
        self.half = away.min(1) / 2
        self.moved = np.sqrt(squared(at, before).astype(np.float64)) if before is not None else np.zeros(k)
        top = np.sort(self.moved)[::-1]
        self.others_moved = np.where((np.arange(k) == self.moved.argmax()) & (k > 1), top[min(1, k - 1)], top[0])


def assign(points: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray,
           lower: np.ndarray, centres: Centres) -> int:
    """Bring a block's ``near, second, upper, lower`` up to date, in place; returns the
    number of vector-centroid distances computed. Equal distances: the smaller number."""
    at, k = centres.at, len(centres.at)
    if k == 1:
        return 0
    upper += centres.moved[near]
    lower -= centres.others_moved[near]
    undecided = lambda i: i[upper[i] + SLACK >= np.maximum(lower[i], centres.half[near[i]])]
    live = undecided(np.arange(len(points)))
    first = squared(points[live], at[near[live]])
    upper[live] = np.sqrt(first)
    work = len(live)
    keep = np.isin(live, undecided(live), assume_unique=True)
    live, first = live[keep], first[keep]
    if not len(live):
        return work
    a, b = near[live].copy(), second[live].copy()
    p = points[live]
    other = squared(p, at[b])
    work += len(live)
    swap = (other < first) | ((other == first) & (b < a))
    a[swap], b[swap] = b[swap], a[swap]
    first[swap], other[swap] = other[swap], first[swap]
    start, begun, met = a.copy(), np.sqrt(first), b.copy()
    scan = np.arange(len(live))
    for place in range(k - 1):
        c = centres.neighbours[start[scan], place]
        inside = centres.gap[start[scan], c] <= begun[scan] + np.sqrt(other[scan]) + SLACK
        scan, c = scan[inside], c[inside]
        if not len(scan):
            break
        new = c != met[scan]
        i, c = scan[new], c[new]
        d = squared(p[i], at[c])
        work += len(i)
        best = (d < first[i]) | ((d == first[i]) & (c < a[i]))
        middle = ~best & ((d < other[i]) | ((d == other[i]) & (c < b[i])))
        j = i[best]
        b[j], other[j] = a[j], first[j]
        a[j], first[j] = c[best], d[best]
        j = i[middle]
        b[j], other[j] = c[middle], d[middle]
    near[live], second[live] = a, b
    upper[live], lower[live] = np.sqrt(first), np.sqrt(other)
    return work


def _change(points: np.ndarray, was: np.ndarray | None, now: np.ndarray, k: int) -> np.ndarray:
    """What a block adds to each centroid's sums and count (its last column)."""
    out = np.zeros((k, points.shape[1] + 1), np.int64)
    went = np.arange(len(now)) if was is None else np.flatnonzero(was != now)
    for sign, of in ((1, now), (-1, was)):
        if of is not None:
            for j in np.unique(of[went]):
                rows = went[of[went] == j]
                out[j, :-1] += sign * points[rows].sum(0, dtype=np.int64)
                out[j, -1] += sign * len(rows)
    return out


def _integers(vectors: DataFrame, parts: int) -> DataFrame:
    """``(vec_id, embedding)`` of the vectors that take part."""
    finite = "x is not null and not isnan(x) and abs(double(x)) <= 1.7976931348623157e308"
    return vectors.select("vec_id", "embedding").where(
        f"embedding is not null and size(embedding) = {parts} and forall(embedding, x -> {finite})")


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    whole = np.floor(scale * x)
    if whole.size and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"a component of {LARGEST // scale} or more: its squared distances do not fit a long")
    return whole


def _scaled(column: pa.Array, parts: int, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _whole(flat, scale).astype(np.int32).reshape(-1, parts)


def _row(*cells: bytes | list | None) -> pa.RecordBatch:
    names = [x.split()[0] for x in _BLOCK.split(", ")]
    return pa.record_batch([pa.array([c], t) for c, t in zip(
        cells, [pa.binary()] * 7 + [pa.list_(pa.int64())])], names)


def _cells(row: dict, parts: int) -> tuple[np.ndarray, ...]:
    points = np.frombuffer(row["points"], "<i4").reshape(-1, parts)
    return (points, *[np.frombuffer(row[c], t).copy() for c, t in (
        ("near", "<i4"), ("second", "<i4"), ("upper", "<f8"), ("lower", "<f8"))])


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, parts: int = PARTS,
             scale: int = SCALE, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per vector.

    A vector takes part if it has exactly ``parts`` components, none null or non-finite;
    others, null vectors and other columns are left out. Its components become
    ``floor(scale * x)``. The first centroids are the ``k`` vectors (all, if fewer) with the
    smallest sha256 of ``seed:vec_id`` (a null id comes last, rows of one id in order of
    their vectors). Rows with one id, and equal vectors, are vectors of their own. Without
    a vector the result is empty. A component of 2**27 or more after scaling is an error,
    since the distances would not fit a long. Each round's blocks are a table in the shared
    folder; the one before it is deleted.
    """
    spark = vectors.sparkSession
    kept = _integers(vectors, parts)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = kept.orderBy(digest.asc_nulls_last(), "embedding").limit(k).collect()
    if not chosen:
        return spark.createDataFrame([], _RESULT)
    at = _whole(np.array([r.embedding for r in chosen], np.float64), scale).astype(np.int64)
    k = len(at)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = Centres(at)
        for batch in batches:
            for i in range(0, batch.num_rows, block):
                part = batch.slice(i, block)
                points = _scaled(part.column(1), parts, scale)
                n = len(points)
                ids = part.column(0).cast(pa.int64())
                near, second = np.zeros(n, np.int32), np.full(n, min(1, k - 1), np.int32)
                upper, lower = np.full(n, np.inf), np.zeros(n)
                assign(points, near, second, upper, lower, centres)
                yield _row(ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                           ids.is_valid().to_numpy(zero_copy_only=False).tobytes(), points.tobytes(),
                           near.tobytes(), second.tobytes(), upper.tobytes(), lower.tobytes(),
                           _change(points, None, near, k).ravel().tolist())

    def moved(centres: Centres):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    points, near, second, upper, lower = _cells(row, parts)
                    was = near.copy()
                    assign(points, near, second, upper, lower, centres)
                    yield _row(row["ids"], row["known"], row["points"], near.tobytes(), second.tobytes(),
                               upper.tobytes(), lower.tobytes(), _change(points, was, near, k).ravel().tolist())
        return task

    def kept_as(df: DataFrame) -> tuple[str, DataFrame]:
        path = scratch(spark, "clusters")
        df.write.parquet(path)
        return path, spark.read.schema(_BLOCK).parquet(path)

    path, held = kept_as(kept.mapInArrow(blocks, _BLOCK))
    total = np.zeros((k, parts + 1), np.int64)
    for _ in range(rounds):
        got = held.select(F.posexplode("change")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
        for r in got:
            total[r.pos // (parts + 1), r.pos % (parts + 1)] += r.s
        filled = total[:, -1] > 0
        after = at.copy()
        after[filled] = total[filled, :-1] // total[filled, -1:]
        old, (path, held) = path, kept_as(held.mapInArrow(moved(Centres(after, at)), _BLOCK))
        discard(spark, old)
        at = after

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                points, near = _cells(row, parts)[:2]
                yield pa.record_batch([
                    pa.array(np.frombuffer(row["ids"], "<i8"), mask=~np.frombuffer(row["known"], bool)),
                    pa.array(near), pa.array(squared(points, at[near]))], ["vec_id", "cluster", "distance"])

    result = held.mapInArrow(distances, "vec_id long, cluster int, distance long")
    inertia = {r.cluster: r.s for r in result.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at.tolist()]
    by_cluster = spark.createDataFrame(
        [(j, inertia.get(j, 0), sum(inertia.values()), names[j]) for j in range(k)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return result.join(F.broadcast(by_cluster), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same by its definition: every distance, every round."""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS p FROM embeddings
  WHERE len(embedding) = {PARTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {PARTS})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, p) - 1 AS j, p
  FROM (SELECT sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) AS h, p FROM v) ORDER BY h NULLS LAST, p LIMIT {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rid, min({k} * CAST(list_sum(list_transform(range(1, {PARTS + 1}),
  lambda i: (v.p[i] - c.p[i]) * (v.p[i] - c.p[i]))) AS BIGINT) + j) AS code FROM v CROSS JOIN c{r} c GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""n{r} AS MATERIALIZED (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS p FROM (
  SELECT code % {k} AS j, i, CAST(sum(p[i]) AS BIGINT) AS s, count(*) AS n
  FROM a{r} JOIN v USING (rid) CROSS JOIN range(1, {PARTS + 1}) t(i) GROUP BY 1, 2) GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT * FROM n{r} UNION ALL SELECT * FROM c{r} WHERE j NOT IN (SELECT j FROM n{r}))""")
    return f"""WITH {', '.join(parts)}
SELECT vec_id, CAST(j AS INTEGER) AS cluster, code // {k} AS distance,
  CAST(sum(code // {k}) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
  CAST(sum(code // {k}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} c ON c.j = code % {k}"""


ORACLE_SQL = _oracle()
