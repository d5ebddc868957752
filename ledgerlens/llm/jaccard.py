"""Operator 4: similarity join on the Jaccard of word n-grams, with prefix filtering.

Documents with one set of n-grams are one class, of which the smallest id goes on. The
n-grams of a set are ordered rare first by a count over the whole corpus. Two sets that
are similar enough share an n-gram among the first of each, so only documents with a
common prefix n-gram meet; their sizes, the places of a common n-gram in both and the
spread of the rest tell most pairs apart, and the others are verified, once, on whole
sets.

A group of documents with a common prefix n-gram is not expanded into pairs: it is first
compared with one of its members, round by round, while its pairs are many and a round
takes away some. Only pairs of members that are not connected by then are enumerated, by size
class, so no link between groups is lost whatever the rounds found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import added_up, components, stored, text_slices

WORDS, PERCENT = 5, 80
#: Counters for the order of n-grams: each counts the n-grams with its first bits. They
#: take 8 MB whatever the corpus; sharing one makes the order less exact, no result.
SKETCH_BITS, SKETCH_ROWS = 21, 64
#: Text that a task holds as words and hashes at a time.
HELD_BYTES = 4 << 20
#: Rounds of comparing with one member go on while all pairs of members would be more than
#: so many for each posting that met another, and while a round takes away such a share of the pairs.
PAIRS_A_MEMBER, WORTH_A_ROUND = 4, 0.2
#: An n-gram is hot if its counter is so many times the mean and so large. Groups of
#: others are met in sorted streams, hot ones by an aggregate and a join that Spark splits.
HOT_TIMES, HOT_LEAST = 8, 4096

_MULTIPLY = np.random.default_rng(5).integers(1 << 62, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, n: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct word n-grams; A-Z count as
    a-z, words are split at ASCII white space, fewer words than ``n`` are one n-gram."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = parts.offsets.to_numpy().astype(np.int64)
    words = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets -= offsets[0]
    real = np.concatenate([[0], np.cumsum(pc.not_equal(words, "").to_numpy(zero_copy_only=False))])
    coded = words.filter(pc.not_equal(words, "")).dictionary_encode()
    offsets = real[offsets]  # without the empty strings at the ends of a text
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    one = one[coded.indices.to_numpy(zero_copy_only=False)]
    runs = np.zeros(max(0, len(one) - n + 1), np.uint64)
    for k in range(n):
        runs += one[k:k + len(runs)] * _MULTIPLY[k]
    runs = _mix(runs)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= n:
            yield np.unique(runs[a:b - n + 1])
        elif b > a:
            yield _mix((one[a:b] * _MULTIPLY[:b - a]).sum(keepdims=True) + _MULTIPLY[n + b - a])
        else:
            yield one[:0]


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """So many of ``n`` ordered n-grams hold one of any similar set's first ones."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _profiles(docs: DataFrame, n: int) -> DataFrame:
    """Per row ``doc_id, n_shingles, sig`` (128 bits of the set), and per task the counts
    of n-grams by their first bits, in rows of their own."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "n_shingles", "sig", "row", "part", "counts"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary()]
        for batch in text_slices(batches, limit=HELD_BYTES):
            sizes, sigs, all_ = [], [], []
            for s in shingle_sets(batch.column(1), n):
                sizes.append(len(s))
                sigs.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                all_.append(s)
            counts += np.bincount((np.concatenate(all_) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64),
                                  minlength=1 << SKETCH_BITS).astype(np.uint32)
            empty = [pa.nulls(len(sizes), t) for t in types[3:]]
            yield pa.record_batch([batch.column(0), pa.array(sizes, types[1]), pa.array(sigs, types[2]), *empty], names)
        if counts.any():
            part = TaskContext.get().partitionId()
            rows = [c.astype("<u4").tobytes() for c in np.split(counts, SKETCH_ROWS)]
            yield pa.record_batch([*(pa.nulls(SKETCH_ROWS, t) for t in types[:3]), pa.array(range(SKETCH_ROWS), types[3]),
                                   pa.array([part] * SKETCH_ROWS, types[4]), pa.array(rows, types[5])], names)

    return docs.select("doc_id", "text").mapInArrow(
        task, "doc_id long, n_shingles long, sig binary, row int, part long, counts binary")


def _postings(docs: DataFrame, often: np.ndarray, n: int, percent: int) -> DataFrame:
    """``doc_id, n, grams, hot``: the ordered prefix of each non-empty set."""
    hot_at = max(HOT_LEAST, HOT_TIMES * float(often.mean()))
    shift, low = np.uint64(64 - SKETCH_BITS), np.uint64((1 << 64 - SKETCH_BITS) - 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=HELD_BYTES):
            ids, sizes, grams, hot = [], [], [], []
            for doc, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), n)):
                if doc is None or not len(s):
                    continue
                count = often[(s >> shift).astype(np.int64)]
                key = np.minimum(count, (1 << SKETCH_BITS) - 1).astype(np.uint64) << shift | (s & low)
                chosen = np.argsort(key, kind="stable")[:prefix_length(len(s), percent)]
                ids.append(doc)
                sizes.append(len(s))
                grams.append(s[chosen].view(np.int64))
                hot.append(count[chosen] >= hot_at)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()),
                                   pa.array(grams, pa.list_(pa.int64())), pa.array(hot, pa.list_(pa.bool_()))],
                                  ["doc", "n", "grams", "hot"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc long, n int, grams array<long>, hot array<boolean>")


_MET = "gram long, doc long, n int, pos int, pivot struct<doc: long, n: int, pos: int>, many boolean"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of postings in the order of their n-grams, those of n-grams with two documents or
    more, each with the first of its n-gram, and whether they are ``many``: more than two.
    The last n-gram of a batch is held back; it has fewer rows than a hot one."""
    held = None
    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(4)]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        if len(cols[0]):
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            held = [c[last:] for c in cols]
            yield _met_batch([c[:last] for c in cols])
    if held is not None:
        yield _met_batch(held)


def _met_batch(cols: list) -> pa.RecordBatch:
    kind = pa.struct([("doc", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])
    gram = cols[0]
    head = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])[:len(gram)])
    size = np.diff(head, append=len(gram))
    first, size = np.repeat(head, size), np.repeat(size, size)
    met = size > 1
    pivot = pa.StructArray.from_arrays([pa.array(c[first[met]], t.type) for c, t in zip(cols[1:], kind)], fields=list(kind))
    gram, doc, n, pos = (c[met] for c in cols)
    return pa.record_batch([pa.array(gram, pa.int64()), pa.array(doc, pa.int64()), pa.array(n, pa.int32()), pa.array(pos, pa.int32()),
                            pivot, pa.array(size[met] > 2)], ["gram", "doc", "n", "pos", "pivot", "many"])


def _size_fits(m: str, n: str, percent: int) -> str:
    """SQL: sets of ``m`` and ``n`` n-grams can be similar."""
    return f"100 * cast(least({m}, {n}) as long) >= {percent} * cast(greatest({m}, {n}) as long)"


def _place_fits(i: str, j: str, m: str, n: str, percent: int) -> str:
    """SQL: the places ``i`` and ``j`` of a common n-gram lie in the prefixes that sets of
    ``m`` and ``n`` need for each other. At the first n-gram that they have in common no
    more than it and what comes after it can be common, so of a similar pair that n-gram,
    at least, is at such places."""
    need = f"((cast({m} as long) + {n}) * {percent} + {99 + percent}) div {100 + percent}"
    return f"{i} <= {m} - {need} and {j} <= {n} - {need}"


def suffix_fits(a: np.ndarray, b: np.ndarray, percent: int, depth: int = 3) -> bool:
    """Split both sorted sets at the middles of the first, again and again: what the parts'
    sizes differ by cannot be common, which bounds the overlap of the whole sets."""
    need = percent * (len(a) + len(b)) / (100 + percent)
    cuts = a[np.linspace(0, len(a), 2 ** depth + 1).astype(np.int64)[1:-1]] if len(a) > 2 ** depth else a[:0]
    ours = np.diff(np.searchsorted(a, cuts), prepend=0, append=len(a))
    theirs = np.diff(np.searchsorted(b, cuts), prepend=0, append=len(b))
    return np.minimum(ours, theirs).sum() >= need


def sketch(s: np.ndarray) -> bytes:
    """How many of a sorted set's hashes begin with each of so many bits that there are two
    to four of them each; a byte each. Empty if one needs more, or the set is empty."""
    bits = max(1, (len(s) // 4).bit_length())
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if len(s) and counts.max() < 256 else b""


def sketches_fit(a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    """False only if the sets cannot be similar: no more is common than the smaller counts."""
    if not a or not b:
        return True
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
    size = min(len(x), len(y))
    x, y = x.reshape(size, -1).sum(1), y.reshape(size, -1).sum(1)
    common = int(np.minimum(x, y).sum())
    return 100 * common >= percent * (int(x.sum() + y.sum()) - common)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    if not suffix_fits(a, b, percent):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


class _Verifier:
    """Answers pairs of documents once each, on their whole sets."""

    def __init__(self, docs: DataFrame, n: int, percent: int):
        self.docs, self.n, self.percent = docs.select("doc_id", "text"), n, percent
        self.sets: DataFrame | None = None

    def _sets(self, pairs: DataFrame) -> DataFrame:
        """The sets of all documents in pairs so far, from their texts."""
        n = self.n

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, limit=HELD_BYTES):
                sets = list(shingle_sets(batch.column(1), n))
                yield pa.record_batch([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary()),
                                       pa.array([sketch(s) for s in sets], pa.binary())], ["doc", "grams", "sketch"])

        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        if self.sets is not None:
            ids = ids.join(self.sets.select(F.col("doc").alias("doc_id")), "doc_id", "left_anti")
        ids = stored(ids, "wanted")
        if ids.isEmpty():
            return self.sets
        new = stored(self.docs.join(ids, "doc_id", "left_semi").mapInArrow(task, "doc long, grams binary, sketch binary"), "sets")
        self.sets = new if self.sets is None else self.sets.union(new)
        return self.sets

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs ``(a, b)``, a written table, that are similar."""
        percent = self.percent

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [sketches_fit(x.as_py(), y.as_py(), percent) for x, y in zip(batch.column(2), batch.column(3))]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = batch.column(2), batch.column(3)
                keep = [similar(np.frombuffer(x[i].as_py(), np.uint64), np.frombuffer(y[i].as_py(), np.uint64), percent)
                        for i in range(batch.num_rows)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        sets = self._sets(pairs)
        if sets is None:
            return pairs
        side = lambda of, column, name: sets.select(F.col("doc").alias(of), F.col(column).alias(name))
        # the sets themselves are sent only for pairs that their sketches leave
        pairs = stored(pairs.join(side("a", "sketch", "x"), "a").join(side("b", "sketch", "y"), "b").select(
            "a", "b", "x", "y").mapInArrow(fit, "a long, b long").distinct(), "likely")
        # many pairs share a document: only sets that one asks for are sent to meet the others
        asked = lambda of: stored(pairs.select(of).distinct(), "asked")
        whole = pairs.join(side("a", "grams", "x").join(asked("a"), "a", "left_semi"), "a").join(
            side("b", "grams", "y").join(asked("b"), "b", "left_semi"), "b").select("a", "b", "x", "y")
        return stored(whole.mapInArrow(task, "a long, b long").distinct(), "links")


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``(a, b)`` of ``doc`` and ``pivot``, which have an n-gram in common,
    that the filters by size and place leave."""
    return met.where("doc <> pivot.doc").where(_size_fits("n", "pivot.n", percent)).where(
        _place_fits("pos", "pivot.pos", "n", "pivot.n", percent)).select(
        F.greatest("doc", "pivot.doc").alias("a"), F.least("doc", "pivot.doc").alias("b")).distinct()


def linked(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``.

    Null and empty texts have no n-grams and no links. Rows with a null id get a null
    component. Rows that share an id are one vertex; it has a link if one of its texts
    has. Other columns are not read. Two n-grams with one 64-bit hash count as one.
    """
    profiles = stored(_profiles(docs, n), "profiles")
    rows = profiles.where("row is null").select("doc_id", "n_shingles", "sig")
    summed = added_up(profiles.where("row is not null").select("row", "part", "counts"), "row", "<u4").collect()
    often = np.zeros((SKETCH_ROWS, (1 << SKETCH_BITS) // SKETCH_ROWS), np.uint32)
    for r in summed:  # SKETCH_ROWS of them
        often[r["row"]] = np.frombuffer(r["counts"], "<u4")
    classes = stored(rows.where("sig is not null and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("k")), "classes")

    # few documents are copies: they are taken out, by a small table, before anything is dealt
    copies = stored(rows.join(classes.where("k > 1").select("sig", "rep"), "sig").where("doc_id <> rep").select(F.col("doc_id").alias("doc")).distinct().join(
        classes.select(F.col("rep").alias("doc")), "doc", "left_anti"), "copies")
    prefixes = stored(_postings(docs, often.ravel(), n, percent).join(copies, "doc", "left_anti"), "prefixes")
    postings = lambda of: of.select("doc", "n", F.posexplode(F.arrays_zip("grams", "hot")).alias("pos", "g")).select(
        F.col("g.grams").alias("gram"), "doc", "n", "pos", F.col("g.hot").alias("hot"))
    cold = postings(prefixes).where("not hot").drop("hot").repartition("gram").sortWithinPartitions("gram", "doc").mapInArrow(_met, _MET)
    hot = postings(prefixes.where("array_contains(hot, true)")).where("hot").drop("hot")
    pivots = hot.groupBy("gram").agg(F.min(F.struct("doc", "n", "pos")).alias("pivot"), F.count("*").alias("k")).where("k > 1").select("gram", "pivot", F.expr("k > 2").alias("many"))
    met = stored(cold.unionByName(hot.join(pivots, "gram")), "met")

    verifier = _Verifier(docs, n, percent)
    tested = stored(_candidates(met, percent), "pairs")
    links = verifier.links(tested)
    # documents that are linked, with their components; any other is one by itself
    together = lambda links: stored(components(
        links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), links), "joined")
    joined = together(links)
    # two documents that share an n-gram alone have been compared by now
    several = met.where("many").drop("pivot", "many")
    turn, pairs_before, members = 0, float("inf"), met.count()
    while True:
        # n-grams whose documents are not yet connected
        left = several.join(joined.withColumnRenamed("id", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        sizes = left.groupBy("gram", "component").agg(F.count("*").alias("k")).groupBy("gram").agg(
            F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("own"), F.count("*").alias("components"))
        open_ = stored(sizes.where("components > 1"), "open")
        pairs_left = float(open_.agg(F.coalesce(F.sum((F.col("k") * F.col("k") - F.col("own")) / 2), F.lit(0))).first()[0])
        left = stored(left.join(open_.select("gram"), "gram"), "left")
        if pairs_left <= PAIRS_A_MEMBER * members or pairs_left > (1 - WORTH_A_ROUND) * pairs_before:
            break
        pairs_before = float(pairs_left)
        # another member to compare the others with
        turn += 1
        chosen = left.groupBy("gram").agg(F.min(F.struct(F.xxhash64(F.col("doc"), F.lit(turn)).alias("turn"), "doc", "n", "pos", "component")).alias("p"))
        star = left.join(chosen.select("gram", F.struct("p.doc", "p.n", "p.pos").alias("pivot"), F.col("p.component").alias("other")), "gram")
        pairs = stored(_candidates(star.where("component <> other"), percent).join(tested, ["a", "b"], "left_anti"), "pairs")
        new = verifier.links(pairs) if not pairs.isEmpty() else pairs
        tested = tested.union(pairs)
        if new.isEmpty():
            break
        links = links.union(new)
        joined = together(links)

    # the rest: pairs of members that are not connected, within a size class and the next
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent * 1.01)))
    ours = left.select("gram", "doc", "n", "pos", "component", band.alias("band"))
    theirs = left.select("gram", F.struct("doc", "n", "pos").alias("pivot"), F.col("component").alias("other"),
                         F.explode(F.array(band, band + 1)).alias("band"))
    across = ours.join(theirs, ["gram", "band"]).where(
        "component <> other and (n > pivot.n or n = pivot.n and doc > pivot.doc)")
    rest = stored(_candidates(across, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        new = verifier.links(rest)
        if not new.isEmpty():
            joined = together(links.union(new))

    of_class = classes.drop("k").join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "sig", F.coalesce("component", "rep").alias("component"))
    return rows.join(of_class, "sig", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one with the
    smallest id. All columns as they are; of repeated rows all or none stay, rows with a
    null id stay."""
    gone = linked(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
