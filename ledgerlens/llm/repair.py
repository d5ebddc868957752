"""Operator 8: token ids in binary files, compressed by a Re-Pair grammar.

A shard is a run of documents in doc_id order. In it, frequent pairs of adjacent ids are
replaced by nonterminals, again and again, until no pair pays for its rule. A file row
holds the shard's rules, the expansion length of each rule and the remaining symbols;
with the lengths, any range of ids is decoded without the ids before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import gather, scratch, text_slices
from ledgerlens.llm.units import file_encoder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Ids a shard holds, before the document that fills it ends.
SHARD_IDS = 1 << 21
#: Bytes of units that a task remembers: half the units of a task's texts are met once in
#: it, and in several tasks that one worker runs; with too few they are encoded each time.
UNIT_BYTES = 128 << 20
#: Nonterminals begin here; terminals are below.
FIRST_RULE = 1 << 16
#: A pair is frequent if found so often. A rule costs 16 bytes and saves 3 with every use,
#: so a pair met fewer times than LEAST_USES would cost more than it saves.
LEAST_COUNT, LEAST_USES = 16, 6


def _frequent(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys found ``least`` times, ascending, and each key's place among them or -1."""
    mixed = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).view(np.int64)
    at = np.flatnonzero((np.bincount(mixed, minlength=1 << 20) >= least)[mixed])  # a superset; counted exactly below
    coded = pa.array(keys[at]).dictionary_encode()
    names, index = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    often = np.flatnonzero(np.bincount(index, minlength=len(names)) >= least)
    often = often[np.argsort(names[often])]
    number = np.full(len(names), -1, np.int64)
    number[often] = np.arange(len(often))
    place = np.full(len(keys), -1, np.int64)
    place[at] = number[index]
    return names[often], place


def compress(ids: np.ndarray, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, lengths): rule ``k`` is the pair that ``FIRST_RULE + k`` stands
    for, and ``lengths[k]`` the number of ids it expands to.

    A round replaces all frequent pairs, the most frequent first where they overlap; rounds
    end when no pair is frequent that would still be used ``LEAST_USES`` times. A round
    looks only at pairs that can be frequent: those with a symbol made by the round before,
    and those that were frequent and not replaced."""
    seq, rules = ids.astype(np.uint32), []
    at = np.arange(max(0, len(seq) - 1))
    made, least_uses = FIRST_RULE, min(LEAST_USES, least)
    while True:
        pairs, rule = _frequent(seq[at].astype(np.uint64) << np.uint64(32) | seq[at + 1], least)
        if not len(pairs):
            break
        found = np.flatnonzero(rule >= 0)
        chosen, rule = at[found], rule[found]
        rank = np.empty(len(pairs), np.int32)
        rank[np.argsort(-np.bincount(rule, minlength=len(pairs)), kind="stable")] = np.arange(len(pairs))
        # an occurrence is taken if its pair precedes those of the occurrences it overlaps;
        # equal pairs in a row (a a a) are taken from the left, each second one
        mine, beside = rank[rule], np.diff(chosen) == 1
        left, right = np.full(len(mine), len(pairs), np.int32), np.full(len(mine), len(pairs), np.int32)
        np.copyto(left[1:], mine[:-1], where=beside)
        np.copyto(right[:-1], mine[1:], where=beside)
        take = (mine < left) & (mine <= right)
        same = np.flatnonzero(left == mine)
        if len(same):
            begins = np.diff(same, prepend=-1) > 1
            run = same[np.maximum.accumulate(np.where(begins, np.arange(len(same)), 0))] - 1
            take[same] = (mine[same] <= right[same]) & ((same - run) % 2 == 0)
            # beside a run of equal pairs an overlap can be left: the left one stays
            some = np.flatnonzero(take)
            take[some[1:][np.diff(chosen[some]) == 1]] = False
        used = np.bincount(rule[take], minlength=len(pairs)) >= least_uses
        take &= used[rule]
        some = np.flatnonzero(take)
        taken, by = chosen[some], rule[some]
        if not len(taken):
            break
        seq[taken] = made + (np.cumsum(used) - 1)[by]
        rules.append(np.stack([pairs[used] >> np.uint64(32), pairs[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        stay = np.ones(len(seq), bool)
        stay[taken + 1] = False
        # the next round looks at new symbols, with what is before them, and at pairs not replaced
        rest = ~take
        rest[1:] &= ~(beside & take[:-1])
        rest = np.flatnonzero(rest)
        again = chosen[rest] - np.cumsum(take)[rest]
        seq, new = seq[stay], taken - np.arange(len(taken))
        look = np.zeros(len(seq), bool)
        look[again] = look[new] = look[new[new > 0] - 1] = True
        at = np.flatnonzero(look[:-1])
        made += int(used.sum())
    table = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    lengths = np.ones(FIRST_RULE + len(table), np.int64)
    done = FIRST_RULE
    for part in rules:  # a rule is made of symbols of earlier rounds
        lengths[done:done + len(part)] = lengths[part].sum(1)
        done += len(part)
    return seq, table, lengths[FIRST_RULE:]


def expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids that ``symbols`` stand for: the rules are expanded once, then copied."""
    if not len(symbols):
        return symbols
    known = np.zeros(FIRST_RULE + len(rules), bool)
    known[symbols] = True
    asked = FIRST_RULE + np.flatnonzero(known[FIRST_RULE:])
    flat, owner = asked.astype(np.uint32), np.arange(len(asked))
    while len(flat) and (deep := flat >= FIRST_RULE).any():
        sizes = 1 + deep.astype(np.int64)
        heads = (np.cumsum(sizes) - sizes)[deep]
        pair = rules[flat[deep] - FIRST_RULE]
        flat, owner = np.repeat(flat, sizes), np.repeat(owner, sizes)
        flat[heads], flat[heads + 1] = pair[:, 0], pair[:, 1]
    size = np.bincount(owner, minlength=len(asked))
    # the terminals first, one each, then the expansions
    begin, length = np.arange(len(known)), np.ones(len(known), np.int64)
    begin[asked], length[asked] = FIRST_RULE + np.cumsum(size) - size, size
    return gather(np.append(np.arange(FIRST_RULE, dtype=np.uint32), flat), begin[symbols], length[symbols])


def expand_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, start: int, stop: int) -> np.ndarray:
    """The ids ``start`` to ``stop`` of a shard; expands only the symbols that hold them."""
    sizes = np.concatenate([np.ones(FIRST_RULE, np.int64), lengths])[symbols]
    ends = np.cumsum(sizes)
    first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
    base = int(ends[first - 1]) if first else 0
    return expand(symbols[first:last + 1], rules)[start - base:stop - base]


def _planes(symbols: np.ndarray) -> bytes:
    """Low 16 bits of all symbols, then the higher ones, a byte each (symbols < 2**24)."""
    return (symbols & 0xFFFF).astype("<u2").tobytes() + (symbols >> 16).astype(np.uint8).tobytes()


def _symbols(data: bytes) -> np.ndarray:
    n = len(data) // 3
    return np.frombuffer(data, "<u2", n).astype(np.uint32) | np.frombuffer(data, np.uint8, n, 2 * n).astype(np.uint32) << 16


_FILE = "shard_doc long, doc_ids binary, doc_ends binary, symbols binary, rules binary, lengths binary, n_ids long, task int, shard int"


def write_ids(docs: DataFrame, out: str, path: str = TOKENIZER, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode every whole text, append ``end_id``, and write the shards to the folder
    ``out`` in ascending doc_id order (null ids first; rows with one id by their text).
    A null text has no ids but the end id; other columns are not read. The files are
    Parquet, which Spark commits whole, with the shards as binary values."""
    from pyspark import TaskContext

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = file_encoder(path, UNIT_BYTES)
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        sizes: list[int] = []
        held = shard = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            symbols, rules, lengths = compress(ids)
            known = np.array([d is not None for d in doc_ids])
            values = np.array([d or 0 for d in doc_ids], "<i8")
            row = (next((d for d in doc_ids if d is not None), None), values.tobytes() + known.tobytes(),
                   np.cumsum(sizes).astype("<i8").tobytes(), _planes(symbols), rules.astype("<u4").tobytes(),
                   lengths.astype("<i8").tobytes(), len(ids), TaskContext.get().partitionId(), shard)
            return pa.record_batch([pa.array([v], t) for v, t in zip(
                row, [pa.int64()] + [pa.binary()] * 5 + [pa.int64(), pa.int32(), pa.int32()])],
                [x.split()[0] for x in _FILE.split(", ")])

        for batch in text_slices(batches):
            ids, ends = encoder.encode(batch.column(1))
            ids = np.insert(ids, ends, end_id)
            ends = ends + np.arange(1, len(ends) + 1)
            names, at = batch.column(0).to_pylist(), 0
            while at < len(ends):  # up to the document that fills the shard
                base = int(ends[at - 1]) if at else 0
                stop = min(len(ends), int(np.searchsorted(ends, base + shard_ids - held)) + 1)
                doc_ids += names[at:stop]
                sizes += np.diff(ends[at:stop], prepend=base).tolist()
                parts.append(ids[base:ends[stop - 1]])
                held += int(ends[stop - 1]) - base
                at = stop
                if held >= shard_ids:
                    yield close()
                    doc_ids, parts, sizes, held, shard = [], [], [], 0, shard + 1
        if doc_ids:
            yield close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(task, _FILE).write.option("compression", "zstd").parquet(out)


class Shard:
    """A shard as read from its row."""

    def __init__(self, row: dict):
        n = len(row["doc_ends"]) // 8
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8", n)
        self.known = np.frombuffer(row["doc_ids"], bool, n, 8 * n)
        self.ends = np.frombuffer(row["doc_ends"], "<i8")
        self.symbols = _symbols(row["symbols"])
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(row["lengths"], "<i8")

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's ``k``-th document, decoded alone."""
        return expand_range(self.symbols, self.rules, self.lengths, int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def read_digests(spark, out: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files of ``out``.

    ``start`` adds up the shards of a task before it and the tasks before; one row per
    writing task meets in one place."""
    files = spark.read.schema(_FILE).parquet(out)
    from pyspark.sql import Window

    sizes = files.select("task", "shard", "n_ids")
    first = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    # a row per task in one place, then each task's shards in their own
    tasks = sizes.groupBy("task").agg(F.sum("n_ids").alias("n")).withColumn("t", F.coalesce(F.sum("n").over(first("task")), F.lit(0)))
    before = sizes.withColumn("s", F.coalesce(F.sum("n_ids").over(first("task", "shard")), F.lit(0))).join(
        tasks.select("task", "t"), "task").select("task", "shard", (F.col("s") + F.col("t")).alias("base"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                s = Shard(row)
                data = memoryview(expand(s.symbols, s.rules).astype("<u4").tobytes())
                starts = np.append(0, s.ends[:-1])
                n = len(starts)
                yield pa.record_batch([
                    pa.array(np.full(n, row["task"]), pa.int32()), pa.array(np.full(n, row["shard"]), pa.int32()),
                    pa.array(s.doc_ids, mask=~s.known), pa.array(starts), pa.array(s.ends - starts),
                    pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), s.ends.tolist())], pa.int64())],
                    ["task", "shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    read = files.mapInArrow(task, "task int, shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return read.join(before, ["task", "shard"]).select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def grammar_digests(docs: DataFrame) -> DataFrame:
    """Write the documents' ids to new files in the shared folder and read them back."""
    spark = docs.sparkSession
    out = scratch(spark, "ids")
    write_ids(docs, out)
    return read_digests(spark, out)
