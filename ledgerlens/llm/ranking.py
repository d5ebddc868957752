"""Operator 13: ranked lexical search over impact vectors in norm buckets (LEMP).

A document's vector has a coordinate per term: the whole contribution of that term to a
score, an integer. An item's vector is 1 for each of its terms, so a score is a dot product.
Documents are held in slices; in a slice the vectors are ordered by length and cut into
buckets. A bucket is skipped for an item when Cauchy-Schwarz (item's length times the
longest vector) or the sum of the bucket's greatest coordinates stays below the item's
threshold. Inside a bucket the item's coordinates are split: those that together cannot
reach the threshold are left out, documents are found by the others, and a document
survives if its part in these plus a bound of the rest, from the coordinates and from what
is left of its length, reaches the threshold. Survivors are scored exactly in integers.

Thresholds are the best 50th score that any task finds among the longest vectors of its
slices, then rise with what a task finds itself. The items are taken in blocks of bounded
size against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.shared import added_up, gather, scratch, stored, text_slices

TOP = 50
#: Bytes of items searched for at a time (on average), and documents of a bucket.
ITEM_BYTES, BUCKET = 8 << 20, 512

#: A-Z become a-z; what is neither a letter or digit of ASCII nor beyond ASCII, a space.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_SLICE = "ids binary, known binary, sizes binary, ends binary, terms binary, counts binary"
_NAMES = [c.split()[0] for c in _SLICE.split(", ")]


def terms(text: str | bytes | None) -> list[bytes]:
    """The terms of a text, in UTF-8."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return data.translate(_TERMS).split()


class _Numbers(dict):
    """Term -> number, -1 for a term that no item has."""

    def __missing__(self, term: bytes) -> int:
        return -1


class Block:
    """Some items: the numbers of their terms, the terms of each item."""

    def __init__(self, texts: list[str]):
        self.numbers = _Numbers()
        lists = [sorted({self.numbers.setdefault(t, len(self.numbers)) for t in terms(x)}) for x in texts]
        self.ends = np.cumsum([len(x) for x in lists])
        self.flat = np.array([t for x in lists for t in x], np.int64)

    def __len__(self) -> int:
        return len(self.ends)

    def item(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i - 1] if i else 0:self.ends[i]]


def _counted(block: Block):
    """Task: slices of documents as counts of the block's terms, and (last rows) the numbers
    of documents with each term, documents with any term, and terms in all."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.numbers) + 2, np.int64)
        for batch in text_slices(batches):
            texts = [terms(t) for t in batch.column(1).to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            width = len(block.numbers) + 1
            number = block.numbers.__getitem__
            at = np.concatenate([np.fromiter(map(number, t), np.int64, len(t)) for t in texts])
            keys = np.repeat(np.arange(len(texts)), sizes) * width + at
            keys, counts = np.unique(keys[at >= 0], return_counts=True)
            doc, term = keys // width, keys % width
            total[:-2] += np.bincount(term, minlength=len(block.numbers))
            total[-2:] += (sizes > 0).sum(), sizes.sum()
            has = np.unique(doc)  # a document without any of the terms scores 0 with every item
            ids = batch.column(0).cast(pa.int64())
            yield pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in (
                ids.fill_null(0).to_numpy().astype("<i8")[has], ids.is_valid().to_numpy(zero_copy_only=False)[has],
                sizes[has].astype("<i8"), np.searchsorted(doc, has, "right").astype("<i8"),
                term.astype("<i4"), counts.astype("<i4"))] + [pa.array([None], pa.int32()), pa.array([None], pa.binary())],
                [*_NAMES, "part", "totals"])
        yield pa.record_batch([pa.array([None], pa.binary())] * 6 + [
            pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()])], [*_NAMES, "part", "totals"])
    return task


def weights(total: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(weight of each term, documents, terms) from the totals of ``_counted``."""
    df, (n, length) = total[:-2], total[-2:].tolist()
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64), n, length


class Slice:
    """Documents' impact vectors in buckets of falling length."""

    def __init__(self, row: dict, weight: np.ndarray, n: int, length: int):
        self.ids, self.known, sizes, ends = (np.frombuffer(row[c], t) for c, t in (
            ("ids", "<i8"), ("known", bool), ("sizes", "<i8"), ("ends", "<i8")))
        self.term = np.frombuffer(row["terms"], "<i4").astype(np.int64)
        count = np.frombuffer(row["counts"], "<i4").astype(np.int64)
        m = 100 - 50 + (50 * sizes * n) // max(1, length)
        lens = np.diff(ends, prepend=0)
        impact = (1_000_000_000 * count) // (1000 * count + 20 * np.repeat(m, lens))
        self.value = weight[self.term] * impact
        self.square = np.add.reduceat(self.value.astype(np.float64) ** 2, ends - lens) if len(lens) else np.zeros(0)
        order = np.argsort(-self.square, kind="stable")
        self.starts, self.lens = (ends - lens), lens
        self.buckets = [order[i:i + BUCKET] for i in range(0, len(order), BUCKET)]


class Bucket:
    """Documents ``docs`` of a slice, as postings by term."""

    def __init__(self, s: Slice, docs: np.ndarray, width: int):
        self.s, self.docs = s, docs
        self.lens = s.lens[docs]
        flat = gather(np.arange(len(s.term)), s.starts[docs], self.lens)
        self.term, self.value = s.term[flat], s.value[flat]
        self.starts = np.cumsum(self.lens) - self.lens
        by_term = np.argsort(self.term, kind="stable")
        self.posted = np.repeat(np.arange(len(docs)), self.lens)[by_term]
        self.posted_value = self.value[by_term]
        self.first = np.searchsorted(self.term[by_term], np.arange(width + 1))
        self.greatest = np.zeros(width, np.int64)
        np.maximum.at(self.greatest, self.term, self.value)
        self.square = s.square[docs]

    def survivors(self, item: np.ndarray, threshold: int) -> np.ndarray:
        """Documents whose score with ``item`` may reach ``threshold``."""
        top = self.greatest[item]
        order = np.argsort(top, kind="stable")
        low = np.cumsum(top[order])
        rest = int(np.searchsorted(low, threshold, "left"))  # the sum of so many stays below
        asked = item[order[rest:]]
        if not len(asked):
            return asked
        size = self.first[asked + 1] - self.first[asked]
        docs = gather(self.posted, self.first[asked], size)
        value = gather(self.posted_value, self.first[asked], size).astype(np.float64)
        part = np.bincount(docs, value, len(self.docs))
        left = np.maximum(self.square - np.bincount(docs, value * value, len(self.docs)), 0) * (1 + 1e-9)
        bound = part + np.minimum(float(low[rest - 1]) if rest else 0.0, np.sqrt(left * rest)) * (1 + 1e-9) + 1
        return np.flatnonzero((bound >= threshold) & (part > 0))

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Exact scores; ``asked`` says of each term whether the item has it."""
        lens = self.lens[docs]
        at = gather(np.arange(len(self.term)), self.starts[docs], lens)
        return np.add.reduceat(np.where(asked[self.term[at]], self.value[at], 0), np.cumsum(lens) - lens)


class Best:
    """The ``top`` best documents of each item so far: by score, then by id, nulls last."""

    def __init__(self, items: int, top: int, floor: np.ndarray):
        self.top, self.floor = top, np.maximum(floor, 1)
        self.held: list[np.ndarray | None] = [None] * items  # (-score, id is null, id)

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        good = score >= self.floor[item]
        new = np.stack([-score[good], ~known[good], ids[good]], 1).astype(np.int64)
        old = self.held[item]
        rows = new if old is None else np.concatenate([old, new])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))[:self.top]]
        self.held[item] = rows
        if len(rows) == self.top:
            self.floor[item] = max(self.floor[item], -rows[-1, 0])


def searched(s: Slice, block: Block, best: Best, buckets: int | None = None) -> int:
    """Put the documents of the (first) buckets of ``s`` into ``best``; returns how many
    scores were computed."""
    width, work = len(block.numbers), 0
    starts = np.append(0, block.ends[:-1])
    sizes = block.ends - starts
    filled = np.flatnonzero(sizes)
    asked = np.zeros(width, bool)
    for docs in s.buckets[:buckets]:
        longest = math.sqrt(float(s.square[docs[0]])) * (1 + 1e-9) + 1
        items = filled[np.sqrt(sizes[filled]) * longest >= best.floor[filled]]  # Cauchy-Schwarz
        if not len(items):
            break  # all later buckets are shorter
        b = Bucket(s, docs, width)
        most = np.add.reduceat(b.greatest[block.flat], starts[filled])
        items = items[most[np.searchsorted(filled, items)] >= best.floor[items]]
        for i in items.tolist():
            item = block.item(i)
            found = b.survivors(item, int(best.floor[i]))
            if len(found):
                asked[item] = True
                best.add(i, b.scores(found, asked), s.ids[docs[found]], s.known[docs[found]])
                asked[item] = False
                work += len(found)
    return work


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score
    above 0, equal scores by ascending doc_id (null last).

    A null text has no terms; a document or item without terms has no rank. Repeated
    document rows rank as documents of their own; repeated item rows are answered each.
    Without documents or items the result is empty. Other columns are not read. Items are
    read in blocks of about ``item_bytes``; a block's document counts and results are
    tables in the shared folder.
    """
    spark = docs.sparkSession
    asked = stored(items.where("text is not null").groupBy("item_id", "text").agg(F.count("*").alias("copies")), "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // item_bytes)
    results = [_block_ranked(docs, asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b), top)
               for b in range(blocks)]
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _block_ranked(docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    spark = docs.sparkSession
    held = sorted(((r.item_id, r.text, r.copies) for r in items.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    block = Block([r[1] for r in held])
    path = scratch(spark, "counted")
    docs.select("doc_id", "text").mapInArrow(_counted(block), f"{_SLICE}, part int, totals binary").write.parquet(path)
    table = spark.read.parquet(path)
    totals = added_up(table.where("totals is not null").select(
        F.lit(0).alias("all"), F.col("part").cast("long").alias("part"), F.col("totals").alias("counts")), "all", "int64").first()
    if totals is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    weight, n, length = weights(np.frombuffer(totals.counts, np.int64))
    slices = table.where("totals is null").select(_NAMES)

    def slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield Slice(batch.slice(i, 1).to_pylist()[0], weight, n, length)

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block), top, np.ones(len(block), np.int64))
        for s in slices_of(batches):
            searched(s, block, best, 1)
        yield pa.record_batch([pa.array([best.floor.tolist()], pa.list_(pa.int64()))], ["floor"])

    floor = np.ones(len(block), np.int64)
    for r in slices.mapInArrow(thresholds, "floor array<long>").select(F.posexplode("floor")).groupBy("pos").agg(
            F.max("col").alias("floor")).collect():
        floor[r.pos] = r.floor

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block), top, floor)
        for s in slices_of(batches):
            searched(s, block, best)
        for i, rows in enumerate(best.held):
            if rows is not None and len(rows):
                yield pa.record_batch([pa.array(np.full(len(rows), i)), pa.array(rows[:, 2], mask=rows[:, 1] == 1),
                                       pa.array(-rows[:, 0])], ["item", "doc_id", "score"])

    found = slices.mapInArrow(search, "item long, doc_id long, score long")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = stored(found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top), "ranked")
    names = spark.createDataFrame([(i, r[0], r[2]) for i, r in enumerate(held)], "item long, item_id long, copies long")
    return best.join(F.broadcast(names), "item").withColumn(  # a block's items
        "copy", F.explode(F.sequence(F.lit(1), "copies"))).select("item_id", "rank", "doc_id", "score")


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE_SQL = rf"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, t FROM (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_PATTERN}') AS t FROM documents) WHERE len(t) > 0),
c AS (SELECT count(*) AS nn, CAST(sum(len(t)) AS BIGINT) AS ll FROM d),
i AS MATERIALIZED (SELECT row_number() OVER () AS iid, item_id, text FROM benchmark),
q AS MATERIALIZED (SELECT DISTINCT iid, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_PATTERN}')) AS term FROM i),
tf AS MATERIALIZED (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) CROSS JOIN c),
s AS (SELECT iid, rid, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(t) * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (rid) CROSS JOIN c GROUP BY iid, rid),
r AS (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s JOIN d USING (rid) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r JOIN i USING (iid) WHERE rank <= {TOP}"""
