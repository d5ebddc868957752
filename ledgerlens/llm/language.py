"""Operator 7: language identification by error-correcting output codes.

Each language has a codeword; each bit is predicted by a binary classifier over hashed
byte n-grams (log odds of the languages with the bit against those without). A text gets
the language whose codeword loses least against the bits' margins, each bit weighted by
how well it separates the learned languages; a small lead over the second is ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import added_up, stored, text_slices

#: Hashed n-grams of 2 and 3 bytes; letters only, all else counts as a space.
DIMS = 1 << 14
#: More languages than this are an error: the model has languages x DIMS counts.
MOST_LANGUAGES = 512
#: Steepness of the bits' loss and of the score; a score below is ambiguous.
STEEPNESS, SHARPNESS, AMBIGUOUS = 4.0, 3.0, 0.6
UNKNOWN = "und"
#: The stage's evidence is how far a text's mean n-gram likelihood falls short of its best
#: language's own, 0 as the language and 1 as evenly spread n-grams, beyond what so many
#: n-grams fall short by chance (in standard deviations). A language claims a text up to
#: the shortfall that this share of its training texts keep, each left out of the counts.
CHANCE, CLAIMED_SHARE, BINS = 3.0, 0.995, 2000
#: Limits of the claimed shortfall, for languages whose training texts are all alike or
#: hold much that is none of theirs; and what an ambiguous text may fall short.
LEAST_SHORT, MOST_SHORT, AMBIGUOUS_SHORT = 0.2, 0.3, 0.1

_LETTER = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def _ngrams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: (index of the first, for every n-gram its text's place in the
    run, its hash)."""
    texts = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    for at in range(0, len(texts), 128):
        own = ends[at:at + 129]
        byte = _LETTER[data[own[0]:own[-1]]]
        of = np.repeat(np.arange(len(own) - 1), np.diff(own))
        if len(byte) < 3:
            yield at, np.empty(0, np.int64), np.empty(0, np.uint32)
            continue
        two = byte[:-1] * np.uint32(0x9E3779B1) + byte[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] * np.uint32(0xC2B2AE35) + byte[2:] * np.uint32(0x27D4EB2F)
        same2, same3 = of[:-1] == of[1:], of[:-2] == of[2:]
        hashes = np.concatenate([two[same2], three[same3]])
        hashes ^= hashes >> np.uint32(15)
        yield at, np.concatenate([of[:-1][same2], of[:-2][same3]]), (hashes * np.uint32(0x2545F491)) >> np.uint32(18)


def ngram_counts(docs: DataFrame) -> DataFrame:
    """``(lang, counts)``: the hashed n-grams of all texts of each non-null language.

    A task emits one row per language it met, and those are added up."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in text_slices(batches):
            langs = batch.column(0).to_pylist()
            names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            index = np.array([names[x] for x in langs])
            got = np.zeros((len(names), DIMS), np.int64)
            for at, of, hashes in _ngrams(batch.column(1)):
                got += np.bincount(index[at:at + 128][of] * DIMS + hashes, minlength=got.size).reshape(got.shape)
            for x, i in names.items():
                sums[x] = sums.get(x, 0) + got[i]
        if sums:
            n = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array(list(sums)), pa.array([n] * len(sums), pa.int64()),
                                   pa.array([s.astype("<i8").tobytes() for s in sums.values()])],
                                  ["lang", "part", "counts"])

    schema = "lang string, part long, counts binary"
    return added_up(stored(docs.where("lang is not null").select("lang", "text").mapInArrow(task, schema), "ngrams"), "lang", "<i8")


def codewords(k: int) -> np.ndarray:
    """``k`` rows of +1/-1: all splits of up to six languages, else the random code of
    10 log2(k) bits with the largest least distance among a hundred seeded ones."""
    if k <= 6:
        splits = [s for s in itertools.product([1, -1], repeat=k) if s[:1] == (1,) and -1 in s]
        return np.array(splits, np.int8).T.reshape(k, len(splits))
    rng, best, most = np.random.default_rng(k), None, -1
    for _ in range(100):
        code = rng.choice(np.array([1, -1], np.int8), (k, int(np.ceil(10 * np.log2(k)))))
        code = code[:, np.abs(code.sum(0)) < k].astype(np.int32)
        far = (code.shape[1] - code @ code.T) // 2 + code.shape[1] * np.eye(k, dtype=np.int32)
        if far.min() > most:
            best, most = code, far.min()
    return best.astype(np.int8)


@dataclass
class LanguageModel:
    """``classify`` gives (language, score, ambiguous) for a batch of texts."""

    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # DIMS x bits, so that a typical text has margins of about 1
    trust: np.ndarray  # bits

    def classify(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        n, k = len(texts), len(self.languages)
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        margins = np.zeros((n, self.weights.shape[1]))
        for at, of, hashes in _ngrams(texts):
            m = min(128, n - at)
            counts = np.bincount(of * DIMS + hashes, minlength=m * DIMS).reshape(m, DIMS)
            margins[at:at + m] = counts.astype(np.float32) @ self.weights / np.maximum(counts.sum(1), 1)[:, None]
        loss = np.zeros((n, k))
        for j in range(k):
            loss[:, j] = np.logaddexp(0, -STEEPNESS * margins * self.code[j]) @ self.trust
        if not k:
            return [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
        best = loss.argmin(1)
        score = 1 / np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True))).sum(1)
        score = np.where(letters, score.round(6), 0.0)
        return [self.languages[b] if x else UNKNOWN for b, x in zip(best, letters)], score, letters & (score < AMBIGUOUS)


def learned(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages in order and their counts, languages x DIMS."""
    rows = ngram_counts(docs).limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rows.sort(key=lambda r: r["lang"])
    return [r["lang"] for r in rows], np.array([np.frombuffer(r["counts"], "<i8") for r in rows]).reshape(-1, DIMS)


def fit(docs: DataFrame) -> LanguageModel:
    """Learn from all rows of ``(text, lang)`` with a language; languages weigh alike."""
    return model_of(*learned(docs))


def model_of(languages: list[str], counts: np.ndarray) -> LanguageModel:
    code = codewords(len(languages))
    if not languages:
        return LanguageModel([], code, np.zeros((DIMS, 0), np.float32), np.zeros(0))
    counts = counts + 0.5
    shares = counts / counts.sum(1, keepdims=True)
    mean = lambda b, sign: shares[code[:, b] == sign].mean(0)
    weights = np.stack([np.log(mean(b, 1) / mean(b, -1)) for b in range(code.shape[1])], 1) if code.shape[1] else np.zeros((DIMS, 0))
    typical = shares @ weights  # the margins of a text that is like its language
    scale = np.maximum(np.abs(typical).mean(0), 1e-9) if len(typical) else 1
    trust = np.maximum((typical / scale * code).min(0), 0.05)
    return LanguageModel(languages, code, (weights / scale).astype(np.float32), trust / max(trust.sum(), 1e-9))


#: Rows whose crc32 of the id, as text, leaves this rest are not learned from.
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)"


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, lang_pred, score, ambiguous)`` of every row's whole text.

    Null and letterless texts are ``und`` with score 0. ``lang``, ``source`` and
    ``doc_id`` are no inputs; repeated rows are answered each; other columns not read."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            langs, score, ambiguous = model.classify(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(langs), pa.array(score), pa.array(ambiguous)],
                                  ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out_languages(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and answer all."""
    model = fit(docs.where(f"not {HELD_OUT}"))
    return identify(docs, model).selectExpr("doc_id", f"{HELD_OUT} AS held_out", "lang_pred", "score", "ambiguous")


class Claims:
    """How far texts fall short of the learned languages; ``limits`` by language."""

    def __init__(self, counts: np.ndarray):
        self.totals = counts.sum(1) + 0.5 * DIMS
        logs = np.log((counts + 0.5) / self.totals[:, None])
        shares = (counts + 0.5) / self.totals[:, None]
        self.typical, even = (shares * logs).sum(1), logs.mean(1)
        self.spread = np.sqrt((shares * (logs - self.typical[:, None]) ** 2).sum(1))
        self.scale = np.maximum(self.typical - even, 1e-9)
        self.counts, self.logs = counts, logs.T.astype(np.float32)
        self.limits = np.full(len(counts), LEAST_SHORT)

    def _beyond(self, mean: np.ndarray, n: np.ndarray, of: np.ndarray | slice) -> np.ndarray:
        return (self.typical[of] - mean - CHANCE * self.spread[of] / np.sqrt(np.maximum(n, 1))) / self.scale[of]

    def short(self, texts: pa.Array) -> np.ndarray:
        """Texts x languages: the shortfall of each text."""
        out = np.zeros((len(texts), len(self.typical)))
        for at, of, hashes in _ngrams(texts):
            m = min(128, len(texts) - at)
            counts = np.bincount(of * DIMS + hashes, minlength=m * DIMS).reshape(m, DIMS).astype(np.float32)
            n = counts.sum(1, keepdims=True)
            out[at:at + m] = self._beyond((counts @ self.logs) / np.maximum(n, 1), n, slice(None))
        return out

    def left_out(self, texts: pa.Array, langs: np.ndarray) -> np.ndarray:
        """The shortfall of training texts from the rest of their languages' texts."""
        out = np.zeros(len(texts))
        for at, of, hashes in _ngrams(texts):
            m = min(128, len(texts) - at)
            counts = np.bincount(of * DIMS + hashes, minlength=m * DIMS)
            some = counts.nonzero()[0]
            text, own, n = some // DIMS, counts[some], counts.reshape(m, DIMS).sum(1)
            lang = langs[at:at + m]
            logs = np.log((self.counts[lang[text], some % DIMS] - own + 0.5) / (self.totals[lang] - n)[text])
            mean = np.bincount(text, own * logs, minlength=m) / np.maximum(n, 1)
            out[at:at + m] = self._beyond(mean, n, lang)
        return out


def claims_of(docs: DataFrame, languages: list[str], counts: np.ndarray) -> Claims:
    """The limits from a second pass over the training texts: a task emits one histogram
    of fixed size per language it met, and those are added up."""
    claims, index = Claims(counts), {x: i for i, x in enumerate(languages)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in text_slices(batches):
            langs = np.array([index[x] for x in batch.column(0).to_pylist()])
            short = claims.left_out(batch.column(1), langs)
            for i in np.unique(langs):
                bins = (np.clip(short[langs == i], 0, 1) * (BINS - 1)).round().astype(np.int64)
                sums[int(i)] = sums.get(int(i), 0) + np.bincount(bins, minlength=BINS)
        if sums:
            n = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array([languages[i] for i in sums]), pa.array([n] * len(sums), pa.int64()),
                                   pa.array([s.astype("<i8").tobytes() for s in sums.values()])],
                                  ["lang", "part", "counts"])

    rows = docs.where("lang is not null and rlike(text, '\\\\p{L}')").select("lang", "text")
    for r in added_up(stored(rows.mapInArrow(task, "lang string, part long, counts binary"), "shortfalls"), "lang", "<i8").collect():
        upto = np.frombuffer(r["counts"], "<i8").cumsum()
        limit = np.searchsorted(upto, CLAIMED_SHARE * upto[-1]) / (BINS - 1)
        claims.limits[index[r["lang"]]] = min(max(limit, LEAST_SHORT), MOST_SHORT)
    claims.counts = None  # only for the second pass
    return claims


def in_a_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that a language claims: not ``und``,
    and no further from a language than its own training texts are. The score is no
    evidence of that: it only compares the learned languages, so it never is low for all
    of them. No shuffle of documents: a task drops its own rows."""
    known, schema = docs.where(f"not {HELD_OUT}"), docs.schema
    languages, counts = learned(known)
    model, claims = model_of(languages, counts), claims_of(known, languages, counts)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = batch.column(batch.schema.get_field_index("text"))
            langs, _, ambiguous = model.classify(texts)
            limits = np.where(ambiguous[:, None], AMBIGUOUS_SHORT, claims.limits)
            claimed = (claims.short(texts) <= limits).any(1)
            yield batch.filter(pa.array([x != UNKNOWN and bool(c) for x, c in zip(langs, claimed)]))

    return docs.mapInArrow(task, schema)
