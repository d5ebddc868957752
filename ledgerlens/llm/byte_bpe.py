"""Operator 9: byte-level BPE encoding and decoding from a rank file.

The tokenizers library encodes Arrow batches with a vocabulary and merges built from
the ranks; its tokens are strings of the byte-to-character table. Decoding reverses
that table to bytes, and a character split over tokens is whole again only there, so
offsets are kept in bytes and mapped to characters.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from ledgerlens.llm.shared import gather, text_slices
from ledgerlens.llm.units import UnitEncoder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 bytes for themselves,
    the others, in order, for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        table = byte_characters()
        text = lambda b: "".join(map(table.__getitem__, b))
        by_rank = sorted(ranks, key=ranks.get)
        # any two adjacent tokens whose bytes make a token may merge, at its rank
        merges = [(text(t[:i]), text(t[i:])) for t in by_rank for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks]
        tokenizer = Tokenizer(BPE({text(t): r for t, r in ranks.items()}, merges, ignore_merges=True))
        tokenizer.pre_tokenizer = Sequence([Split(Regex(pattern), "isolated"),
                                            ByteLevel(add_prefix_space=False, use_regex=False)])
        self.encoder = UnitEncoder(tokenizer)
        reverse = {c: b for b, c in enumerate(table)}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in tokenizer.get_vocab().items():
            tokens[i] = bytes(map(reverse.__getitem__, token))
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.begin = np.cumsum(self.size) - self.size
        decimals = [b"%d " % i for i in range(len(tokens))]
        self.decimal_size = np.array([len(t) for t in decimals], np.int64)
        self.decimal_flat = np.frombuffer(b"".join(decimals), np.uint8)
        self.decimal_begin = np.cumsum(self.decimal_size) - self.decimal_size

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``; only whole texts are sure to be valid UTF-8."""
        return gather(self.flat, self.begin[ids], self.size[ids])

    def decimals(self, ids: np.ndarray) -> np.ndarray:
        """The ids in decimal, a space after each."""
        return gather(self.decimal_flat, self.decimal_begin[ids], self.decimal_size[ids])

    def offsets(self, ids: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of each token in characters. A token that begins or ends inside
        a character has that character in its range, so the ranges of the tokens of a
        split character overlap in it."""
        ends = np.cumsum(self.size[ids])
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters begun before a byte
        starts = ends - self.size[ids]
        inside = np.zeros(len(ids), bool)
        if len(ids):
            inside = (data[np.minimum(starts, len(data) - 1)] & 0xC0) == 0x80
        return heads[starts] - inside, heads[ends]


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_texts(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``(doc_id, ids, starts, ends)``: the ids of every whole text and their ranges in
    characters. A null text has no ids; rows, ties and repeated ids are kept as they
    come; other columns are not read."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in text_slices(batches):
            ids, ends = bpe.encoder.encode(batch.column(1))
            starts = np.append(0, ends[:-1])
            spans = [bpe.offsets(part := ids[a:b], bpe.decode(part)) for a, b in zip(starts, ends)]
            yield pa.record_batch([
                batch.column(0), pa.array([ids[a:b].astype(np.int32) for a, b in zip(starts, ends)], pa.list_(pa.int32())),
                *(pa.array([s[k].astype(np.int64) for s in spans], pa.list_(pa.int64())) for k in (0, 1))],
                ["doc_id", "ids", "starts", "ends"])

    return docs.select("doc_id", "text").mapInArrow(
        task, "doc_id long, ids array<int>, starts array<long>, ends array<long>")


def decode_ids(encoded: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; bytes that are no UTF-8 (a cut through a
    character) become the replacement character. Null ids give a null text."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            texts = [None if ids is None else bpe.decode(np.array(ids, np.int64)).tobytes().decode("utf-8", "replace")
                     for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, text string")


def encoding_digests(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per document the digests of its ids and of what they decode to, and how many of
    its tokens begin inside a character. One narrow pass, no shuffle."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in text_slices(batches):
            ids, ends = bpe.encoder.encode(batch.column(1))
            starts = np.append(0, ends[:-1])
            data, digits = bpe.decode(ids), bpe.decimals(ids)
            # where the texts end in bytes and in digits
            byte_at = np.append(0, np.cumsum(bpe.size[ids]))
            digit_at = np.append(0, np.cumsum(bpe.decimal_size[ids]))
            inside = np.append(0, np.cumsum((data[byte_at[:-1]] & 0xC0) == 0x80)) if len(ids) else np.zeros(1, np.int64)
            sha = lambda x: hashlib.sha256(x).hexdigest()
            yield pa.record_batch([
                batch.column(0), pa.array(ends - starts, pa.int64()),
                pa.array([sha(digits[digit_at[a]:max(digit_at[a], digit_at[b] - 1)]) for a, b in zip(starts, ends)]),
                pa.array([sha(data[byte_at[a]:byte_at[b]]) for a, b in zip(starts, ends)]),
                pa.array(inside[ends] - inside[starts], pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split_tokens"])

    return docs.select("doc_id", "text").mapInArrow(
        task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split_tokens long")
