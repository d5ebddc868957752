"""Operator 5: near-duplicate vectors by dual traversal of cover trees.

Vectors of a label, scaled to length 1, are held by nested levels of centres: a few cells
over all of them, and below a cell, for each block of its vectors, a cover tree whose
levels have halving radii. Two nodes are compared further only if their centres are no
farther apart than both covering radii and the threshold's distance; two blocks' trees are
walked down together, level by level, and the vectors that are left are compared exactly.
The cells' centres come from a bounded sample; covering radii and trees are of all vectors,
so no pair is lost whatever the sample.

Equal vectors are one class with a count, and a task returns each vector's number of links
and a root it is connected to, so a dense group is never written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import components, stored

THRESHOLD = 0.98
#: Vectors a block has on average, and a cell at least; cells of a label at most; vectors
#: of a label that its cells' centres are chosen from, about so many at most.
BLOCK, MOST_CELLS, SAMPLE = 1024, 256, 2048
#: Radius of a tree's first level below its root, and levels; each radius halves the last.
FIRST_RADIUS, LEVELS = 1.0, 5


def _valid() -> str:
    """SQL: a vector that can be compared: no null or non-finite part, not zero."""
    finite = "x is not null and not isnan(x) and abs(x) <= 1.7976931348623157e308"
    return (f"label is not null and embedding is not null and vec_id is not null and size(embedding) > 0 and "
            f"forall(embedding, x -> {finite}) and exists(embedding, x -> x <> 0)")


def _unit(vectors: pa.Array | list) -> np.ndarray:
    """Rows of doubles, scaled to length 1 after their largest part is 1 (no overflow)."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def farthest_first(x: np.ndarray, most: int, radius: float, chosen: list[int] | None = None) -> list[int]:
    """Centres, each the vector farthest from those before, until they cover all vectors
    with ``radius`` or are ``most``."""
    chosen = list(chosen or [])
    nearest = _distances(x, x[chosen]).min(1) if chosen else np.full(len(x), np.inf)
    while len(chosen) < most and nearest[far := int(nearest.argmax())] > radius:
        chosen.append(far)
        nearest = np.minimum(nearest, _distances(x, x[[far]])[:, 0])
    return chosen


class CoverTree:
    """Levels of ``(centres, parents, radii)`` over the rows of ``x``: a level's centres
    are farther apart than its radius and among the next one's; ``parents`` are places in
    the level above; ``radii`` cover all vectors below. The last level is every vector."""

    def __init__(self, x: np.ndarray):
        self.x = x
        level, chosen = [], []
        for k in range(LEVELS):
            chosen = farthest_first(x, len(x), FIRST_RADIUS / 2 ** k, chosen)
            level.append(np.array(chosen))
            if len(chosen) == len(x):
                break
        if len(level[-1]) < len(x):
            level.append(np.arange(len(x)))
        # a vector's path goes up by nearest centres
        below, members = np.arange(len(x)), np.zeros(len(x), np.int64)
        self.levels = []
        parents = [np.zeros(len(level[0]), np.int64)] + [
            _distances(x[b], x[a]).argmin(1) for a, b in zip(level, level[1:])]
        members = np.empty(len(x), np.int64)
        members[level[-1]] = below
        for at in range(len(level) - 1, -1, -1):
            gap = np.sqrt(((x - x[level[at]][members]) ** 2).sum(1))
            radii = np.zeros(len(level[at]))
            np.maximum.at(radii, members, gap)
            self.levels.insert(0, (level[at], parents[at], radii))
            members = parents[at][members]


def close_pairs(a: CoverTree, b: CoverTree, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of both trees with a dot product of ``threshold`` or more."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7
    alive = np.ones((1, 1), bool)
    for level in range(max(len(a.levels), len(b.levels))):
        (ca, pa_, ra), (cb, pb, rb) = (t.levels[min(level, len(t.levels) - 1)] for t in (a, b))
        # a tree that has ended stays at its vectors
        pa_, pb = (p if level < len(t.levels) else np.arange(len(c)) for t, c, p in ((a, ca, pa_), (b, cb, pb)))
        rows, cols = np.flatnonzero(alive.any(1)[pa_]), np.flatnonzero(alive.any(0)[pb])
        left = alive[np.ix_(pa_[rows], pb[cols])]
        left &= _distances(a.x[ca[rows]], b.x[cb[cols]]) <= ra[rows, None] + rb[cols] + reach
        alive = np.zeros((len(ca), len(cb)), bool)
        alive[np.ix_(rows, cols)] = left
    at, to = np.nonzero(alive)
    at, to = a.levels[-1][0][at], b.levels[-1][0][to]
    near = np.empty(len(at), bool)
    for k in range(0, len(at), 1 << 18):  # sums of doubles, pair by pair
        near[k:k + (1 << 18)] = np.einsum("ij,ij->i", a.x[at[k:k + (1 << 18)]], b.x[to[k:k + (1 << 18)]]) >= threshold
    return at[near], to[near]


def _centres(classes: DataFrame, size: int) -> DataFrame:
    """``(label, dim, cell, centre)``: cells of each label and length of vector. They are
    chosen from the vectors whose hashes are below a bound that follows from the count."""
    counts = classes.groupBy("label", "dim").agg(F.count("*").alias("n"), F.min("rep").alias("first"))
    share = F.col("n") * F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < F.lit(size << 20)
    some = classes.join(counts, ["label", "dim"]).where(share | (F.col("rep") == F.col("first")))

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep")
        x = _unit(rows["embedding"])
        at = farthest_first(x, min(MOST_CELLS, max(1, int(rows["n"].iloc[0]) // BLOCK)), 0.0)
        return pd.DataFrame({"label": rows["label"].iloc[0], "dim": rows["dim"].iloc[0], "cell": range(len(at)), "centre": list(x[at])})

    return some.select("label", "dim", "n", "rep", "embedding").groupBy("label", "dim").applyInPandas(
        choose, "label string, dim int, cell int, centre array<double>")


def _placed(classes: DataFrame, centres: DataFrame, salts: int) -> DataFrame:
    """``(label, dim, rep, many, unit, cell, gap)``: each class under its nearest centre.
    A label is dealt over ``salts`` tasks, each with the label's centres."""
    schema = "label string, dim int, rep long, many long, unit array<double>, cell int, gap double"

    def put(rows: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        cells, out = cells.sort_values("cell"), []
        for at in range(0, len(rows), 4096):
            part = rows.iloc[at:at + 4096]
            x, c = _unit(part["embedding"]), np.stack(cells["centre"])
            cell = _distances(x, c).argmin(1)
            out.append(part[["label", "dim", "rep", "many"]].assign(
                unit=list(x), cell=cell, gap=np.sqrt(((x - c[cell]) ** 2).sum(1))))
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

    dealt = classes.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(salts)).cast("int"))
    copies = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    key = ["label", "dim", "salt"]
    return dealt.groupBy(*key).cogroup(copies.groupBy(*key)).applyInPandas(put, schema)


_LEVELS = "array<struct<centres: binary, parents: binary, radii: binary>>"
_BLOCKS = f"label string, dim int, cell int, block int, reps binary, many binary, x binary, levels {_LEVELS}"


def _blocks(placed: DataFrame, cells: DataFrame) -> DataFrame:
    """A row for each block: its vectors and their tree."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep")
        tree = CoverTree(np.stack(rows["unit"]).astype(np.float64))
        levels = [{"centres": c.astype("<i8").tobytes(), "parents": p.astype("<i8").tobytes(), "radii": r.astype("<f8").tobytes()}
                  for c, p, r in tree.levels]
        one = rows.iloc[0]
        return pd.DataFrame({"label": [one["label"]], "dim": [one["dim"]], "cell": [one["cell"]], "block": [one["block"]],
                             "reps": [rows["rep"].to_numpy("<i8").tobytes()], "many": [rows["many"].to_numpy("<i8").tobytes()],
                             "x": [tree.x.tobytes()], "levels": [levels]})

    sizes = cells.select("label", "dim", "cell", F.ceil(F.col("n") / BLOCK).cast("long").alias("parts"))
    return placed.join(sizes, ["label", "dim", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("rep", F.lit("block")), F.col("parts")).cast("int")).groupBy(
        "label", "dim", "cell", "block").applyInPandas(build, _BLOCKS)


def _tree(row: dict, dim: int) -> CoverTree:
    tree = CoverTree.__new__(CoverTree)
    tree.x = np.frombuffer(row["x"], "<f8").reshape(-1, dim)
    tree.levels = [(np.frombuffer(v["centres"], "<i8"), np.frombuffer(v["parents"], "<i8"), np.frombuffer(v["radii"], "<f8"))
                   for v in row["levels"]]
    return tree


def _roots(n: int, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The smallest place that each of ``n`` places is connected to."""
    root = np.arange(n)
    while True:
        was = root.copy()
        least = np.minimum(root[at], root[to])
        np.minimum.at(root, at, least)
        np.minimum.at(root, to, least)
        root = root[root]
        if (root == was).all():
            return root


def _links(blocks: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """``(rep, links, root)``: for each class and pair of blocks, the vectors it is linked
    with there and a class it is connected to."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-7
    cell = lambda name: cells.select("label", "dim", F.col("cell").alias(name), F.col("centre").alias(f"{name}_c"), F.col("radius").alias(f"{name}_r"))
    apart = F.expr("sqrt(aggregate(zip_with(l_c, r_c, (x, y) -> (x - y) * (x - y)), 0D, (a, b) -> a + b))")
    # cells of a label: MOST_CELLS at most
    pairs = cell("l").join(cell("r"), ["label", "dim"]).where("l <= r").where(
        apart <= F.col("l_r") + F.col("r_r") + F.lit(reach)).select("label", "dim", "l", "r")
    named = lambda name: blocks.select("label", "dim", F.col("cell").alias(name), F.col("block").alias(f"{name}b"))
    side = lambda name: blocks.select("label", "dim", F.col("cell").alias(name), F.col("block").alias(f"{name}b"),
                                      F.struct("reps", "many", "x", "levels").alias(f"{name}_tree"))
    pairs = stored(pairs.join(named("l"), ["label", "dim", "l"]).join(named("r"), ["label", "dim", "r"]).where("l < r or lb <= rb"), "block-pairs")
    met = pairs.join(side("l"), ["label", "dim", "l", "lb"]).join(side("r"), ["label", "dim", "r", "rb"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                left, right = row["l_tree"], row["r_tree"]
                a, b = _tree(left, row["dim"]), _tree(right, row["dim"])
                at, to = close_pairs(a, b, threshold)
                if row["same"]:
                    at, to = at[at < to], to[at < to]
                reps = np.concatenate([np.frombuffer(t["reps"], "<i8") for t in ([left] if row["same"] else [left, right])])
                many = np.concatenate([np.frombuffer(t["many"], "<i8") for t in ([left] if row["same"] else [left, right])])
                to = to if row["same"] else to + len(a.x)
                links = np.zeros(len(reps), np.int64)
                np.add.at(links, at, many[to])
                np.add.at(links, to, many[at])
                some = np.flatnonzero(links)
                yield pa.record_batch([pa.array(reps[some]), pa.array(links[some]), pa.array(reps[_roots(len(reps), at, to)][some])],
                                      ["rep", "links", "root"])

    return met.select("dim", F.expr("l = r and lb = rb").alias("same"), "l_tree", "r_tree").repartition(
        2 * blocks.sparkSession.sparkContext.defaultParallelism).mapInArrow(task, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.

    Vectors are compared within equal non-null labels of any type (and lengths), as doubles. Null,
    empty and zero vectors, those with a null or non-finite part and rows with a null id
    or label have no links; a null id has a null component and is kept. Rows that share an
    id link like others, and ``component_id`` is the smallest id reached. Other columns
    are not read."""
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    valid = stored(rows.withColumn("ok", F.coalesce(F.expr(_valid()), F.lit(False))), "vectors")
    # equal vectors are one class; -0.0 is 0.0
    key = F.transform("embedding", lambda x: x + F.lit(0.0))
    good = valid.where("ok").select("vec_id", "label", key.alias("embedding"))
    classes = stored(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("many"))
                     .withColumns({"dim": F.size("embedding"), "rep": F.monotonically_increasing_id()}), "classes")
    centres = stored(_centres(classes, sample), "centres")
    salts = max(1, vectors.sparkSession.sparkContext.defaultParallelism)
    placed = stored(_placed(classes, centres, salts), "placed")
    cells = stored(centres.join(placed.groupBy("label", "dim", "cell").agg(
        F.max("gap").alias("radius"), F.count("*").alias("n")), ["label", "dim", "cell"]), "cells")
    links = stored(_links(stored(_blocks(placed, cells), "blocks"), cells, threshold), "links")
    joined = components(classes.select(F.col("rep").alias("id")), links.selectExpr("rep AS a", "root AS b")).withColumnRenamed("id", "rep")
    smallest = joined.join(classes.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("smallest"))
    joined = joined.join(smallest, "component").select("rep", F.col("smallest").alias("component"))
    degree = links.groupBy("rep").agg(F.sum("links").alias("others"))
    known = classes.join(joined, "rep").join(degree, "rep", "left").select(
        "label", "embedding", "component", (F.coalesce("others", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    answered = good.join(known, ["label", "embedding"]).select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = valid.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return answered.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


#: All pairs within a label, and the smallest id reached; for the small tables of a test.
ORACLE_SQL = """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l USING (a)),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), m AS (SELECT a, min(c) AS c FROM r GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, v.vec_id = m.c AS kept
FROM v JOIN m ON m.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id"""
