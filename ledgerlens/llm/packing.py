"""Operator 3: bounded-space online packing of token sequences.

A task keeps a fixed number of open windows. A piece goes into the fullest window that
has room for it; when none has, the fullest window is emitted and a new one opened. The
windows still open when a task ends are merged at the end, over groups of tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import SLICE_BYTES, stored, text_slices
from ledgerlens.llm.units import MAX_BYTES, file_encoder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
WINDOW = 2048
#: Open windows of a task, and tasks whose left windows are merged together.
OPEN_WINDOWS = 256
MERGED_TASKS = 32

#: A piece: (doc_id, start, length, ids_crc32, doc_tokens).
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PLACED = _PIECE + ", sequence_id long, offset long"


class OpenWindows:
    """At most ``most`` open windows of ``size`` tokens; ``add`` returns a window that
    has to be emitted, if any."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.by_fill: list[tuple[int, int]] = []  # (tokens, key), ascending
        self.pieces: dict[int, list[tuple]] = {}
        self.made = 0

    def add(self, piece: tuple) -> list[tuple] | None:
        length, out = piece[2], None
        at = bisect_left(self.by_fill, (self.size - length + 1, -1)) - 1
        if at >= 0:  # the fullest of those with room
            fill, key = self.by_fill.pop(at)
        else:
            if len(self.by_fill) >= self.most:
                out = self.pieces.pop(self.by_fill.pop()[1])
            fill, key = 0, self.made
            self.made += 1
            self.pieces[key] = []
        self.pieces[key].append(piece)
        if fill + length < self.size:
            insort(self.by_fill, (fill + length, key))
            return out
        return self.pieces.pop(key)  # full; then no other had to go, or it held a whole window itself

    def left(self) -> Iterator[list[tuple]]:
        for _, key in reversed(self.by_fill):
            yield self.pieces[key]


def _rows(window: list[tuple], sequence: int) -> Iterator[tuple]:
    offset = 0
    for piece in window:
        yield (*piece, sequence, offset)
        offset += piece[2]


def pack(docs: DataFrame, path: str = TOKENIZER, end_id: int = END_ID, size: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, slice_bytes: int = SLICE_BYTES, unit_bytes: int = MAX_BYTES) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Only
    documents longer than a window are cut, into whole windows and a rest. Rows are
    packed as they come (repeated ids too); other columns are not read. Sequence ids are
    unique, not gapless. The first pass is written to the shared folder. ``slice_bytes`` of
    text are encoded at a time and ``unit_bytes`` of units remembered: less memory, more time.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        encoder = file_encoder(path, unit_bytes)
        end = np.array([end_id], "<u4").tobytes()
        pa.default_memory_pool().release_unused()
        windows, sequence = OpenWindows(size, open_windows), TaskContext.get().partitionId() << 36
        out: list[tuple] = []

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(
                zip(*rows), [pa.int64()] * 7 + [pa.bool_(), pa.int64()])], _FIRST_NAMES)

        for batch in text_slices(batches, limit=slice_bytes):
            ids, ends = encoder.encode(batch.column(1))
            data, starts = memoryview(ids.astype("<u4").tobytes()), np.append(0, ends[:-1])
            for doc, a, b in zip(batch.column(0).to_pylist(), starts.tolist(), ends.tolist()):
                total = b - a + 1
                for start in range(0, total, size):
                    length = min(size, total - start)
                    last = start + length == total
                    crc = zlib.crc32(data[4 * (a + start):4 * (a + start + length - last)])
                    piece = (doc, start, length, zlib.crc32(end, crc) if last else crc, total)
                    done = [piece] if length == size else windows.add(piece)
                    if done:
                        out += [(*r, True, 0) for r in _rows(done, sequence)]
                        sequence += 1
            if out:
                yield frame(out)
                out = []
        group = TaskContext.get().partitionId() // MERGED_TASKS
        for window in windows.left():
            out += [(*r, False, group) for r in _rows(window, sequence)]
            sequence += 1
        if out:
            yield frame(out)

    first = stored(docs.select("doc_id", "text").mapInArrow(
        task, f"{_PLACED}, done boolean, merge_group long"), "packed")

    def merge(pieces: pd.DataFrame) -> pd.DataFrame:
        """Best fit over the pieces by falling length; the windows' ids are taken again.
        The windows stay as they came when that makes no fewer of them."""
        ids = sorted(pieces["sequence_id"].unique().tolist())
        cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        order = pieces.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        nulls = order["doc_id"].isna().tolist()
        windows, made = OpenWindows(size, len(order)), []
        for null, piece in zip(nulls, order[cols].astype("Int64").fillna(0).astype("int64").itertuples(index=False, name=None)):
            if full := windows.add((None if null else piece[0], *piece[1:])):
                made.append(full)
        made += windows.left()
        if len(made) < len(ids):
            out = pd.DataFrame([r for window, n in zip(made, ids) for r in _rows(window, n)], columns=[*cols, "sequence_id", "offset"])
        else:
            out = pieces[[*cols, "sequence_id", "offset"]]
        return out.astype({"doc_id": "Int64"})

    columns = [*_NAMES]
    return first.where("done").select(columns).unionByName(
        first.where("not done").groupBy("merge_group").applyInPandas(merge, _PLACED).select(columns))


_NAMES = [x.split()[0] for x in _PLACED.split(", ")]
_FIRST_NAMES = [*_NAMES, "done", "merge_group"]


def padding(packed: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(sequences, tokens, padded)`` of a packing: a sequence is padded to ``size``
    unless its length is a power of two."""
    lens = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    even = F.expr("n & (n - 1)") == 0
    return lens.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"),
                    F.sum(F.when(even, 0).otherwise(size - F.col("n"))).alias("padded"))
