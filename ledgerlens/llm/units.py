"""Encode whole texts with the tokenizers library, each distinct unit once.

A unit is a stretch of text at whose ends every tokenizer used here cuts anyway: a word
with the one space before it, a mark behind a word, a line break. The ids of a text are
the ids of its units in order, so a task encodes a unit when it first meets it and copies
its ids afterwards. Units are cut and counted as bytes of an Arrow buffer, many at a time.

The memory of units is bounded in bytes (``max_bytes``, besides the units of the slice in
hand): when it is full, units met again since it last was stay, up to half of it, and the
others go; so frequent words stay known, and long texts without a place to cut are kept no
longer than their slice. This costs time and changes no result.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from ledgerlens.llm.shared import gather

#: Bytes of units and ids that a task remembers, and what a unit costs besides them.
MAX_BYTES, UNIT_COST = 48 << 20, 160
#: A word of letters that are one piece in every tokenizer's pattern (a superset need not be).
_WORD = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ɏЀ-ѿ]+)\\Z")


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others for characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


_ALPHABET = str.maketrans(dict(enumerate(_byte_alphabet())))


_SHOWN, _LETTER, _BEHIND, _FOLLOWS, _LEAD_2, _LEAD_3, _LEAD_4, _LEAD_LETTER = (1 << i for i in range(8))
#: What a byte of UTF-8 may be, as flags.
_KIND = np.zeros(256, np.uint8)
for _flag, _codes in ((_SHOWN, range(0x21, 0x7F)), (_LETTER, [*range(65, 91), *range(97, 123)]),
                      (_BEHIND, [c for c in range(0x21, 0x7F) if not chr(c).isalpha() and c != 0x27]),
                      (_FOLLOWS, range(0x80, 0xC0)), (_LEAD_2, range(0xC3, 0xE0)), (_LEAD_3, [0xE0, *range(0xE4, 0xF0)]),
                      (_LEAD_4, range(0xF0, 0xF5)), (_LEAD_LETTER, [*range(0xC3, 0xCA), 0xD0, 0xD1])):
    _KIND[[*_codes]] |= _flag


def cuts(b: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 whether a unit may begin with it.

    Before a space or line break that stands alone between characters known not to be white
    space, behind such a line break, and between a letter and a following ASCII character
    that is neither letter, space nor apostrophe. Characters of which this is not known from
    their first bytes are left uncut: no tokenizer pattern spans the places that are."""
    n = len(b)
    kinds = np.zeros(n + 5, np.uint8)
    np.take(_KIND, b, out=kinds[4:n + 4])
    here, p1, p2, p3, p4 = kinds[4:n + 4], kinds[3:n + 3], kinds[2:n + 2], kinds[1:n + 1], kinds[:n]
    gaps = np.flatnonzero((b == 0x20) | (b == 0x0A))
    # the character before a gap is no white space, nor is the one behind it
    k1, k2, k3 = p1[gaps], p2[gaps], p3[gaps]
    solid = (k1 & _SHOWN) | ((k1 & _FOLLOWS) > 0) & (((k2 & _LEAD_2) > 0) | ((k2 & _FOLLOWS) > 0) & (
        ((k3 & _LEAD_3) > 0) | ((k3 & _FOLLOWS) > 0) & ((p4[gaps] & _LEAD_4) > 0)))
    alone = gaps[(solid > 0) & ((kinds[gaps + 5] & (_SHOWN | _LEAD_2 | _LEAD_3 | _LEAD_4)) > 0)]
    out = np.zeros(n, bool)
    out[alone] = True
    out[alone[b[alone] == 0x0A] + 1] = True  # a gap is never the last byte
    marks = np.flatnonzero(here & _BEHIND)
    k1, k2 = p1[marks], p2[marks]
    letter = (k1 & _LETTER) | ((k1 & _FOLLOWS) > 0) & ((k2 & _LEAD_LETTER) > 0)
    marks = marks[letter > 0]
    last, lead = b[marks - 1], b[marks - 2]  # a mark behind a letter of two bytes is not among the first two
    # the two signs among Latin letters, and the one letter whose lower case ends in a mark
    other = (last > 0x7F) & (((lead == 0xC3) & ((last == 0x97) | (last == 0xB7))) | ((lead == 0xC4) & (last == 0xB0)))
    out[marks[~other]] = True
    return out


class UnitEncoder:
    """``encode`` gives the ids of a batch of texts as one array with offsets: those of the
    library's ``encode(text, add_special_tokens=False)``, in which the string of a special
    token is that token."""

    def __init__(self, tokenizer: Tokenizer, max_bytes: int = MAX_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task uses one core
        self.tokenizer, self.max_bytes = tokenizer, max_bytes
        self._special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        normalizer = tokenizer.normalizer
        letters = "".join(c for c in map(chr, range(65, 0x480)) if c != "İ" and _WORD.match(c))
        self._lowered = normalizer is not None
        #: whether plain words may go to the model: what the normalizer does to them is known
        self._plain = normalizer is None or normalizer.normalize_str(letters) == letters.lower()
        self.slot: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = self.bytes = 0
        self.begin, self.length, self.met = [np.zeros(1 << 14, np.int64) for _ in range(3)]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, unit: str) -> list[int] | None:
        """The ids of a plain word by the tokenizer's model, without its pattern; else None."""
        found = self._plain and _WORD.match(unit)
        if not found:
            return None
        if self._lowered:  # these drop white space, and of a word only its case changes
            if "İ" in unit:
                return None
            unit = found[2].lower()
        if unit.isascii():  # letters stand for themselves
            unit = "Ġ" + unit[1:] if unit[0] == " " else unit
        else:
            unit = unit.encode().decode("latin-1").translate(_ALPHABET)
        return [t.id for t in self._tokenize(unit)]

    def _learn(self, units: list[str], many: int = 4000) -> None:
        self._tokenize = self.tokenizer.model.tokenize
        got = [self._word(u) for u in units]
        rest = [i for i, ids in enumerate(got) if ids is None]
        for i in range(0, len(rest), many):
            for j, ids in zip(rest[i:i + many], self._whole([units[j] for j in rest[i:i + many]])):
                got[j] = ids
        n, m = len(self.slot), len(self.slot) + len(units)
        lens = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(chain.from_iterable(got), np.uint32, int(lens.sum()))
        while m > len(self.begin):
            self.begin, self.length, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length, self.met))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.begin[n:m] = self.used + np.cumsum(lens) - lens
        self.length[n:m] = lens
        self.met[n:m] = 0
        self.used += len(ids)
        self.bytes += sum(map(len, units)) + 4 * len(ids) + UNIT_COST * len(units)
        self.slot.update(zip(units, range(n, m)))

    def _trim(self) -> None:
        """Keep the units met in more than one slice since the last time, up to half the bound."""
        names = list(self.slot)
        met, size = self.met[:len(names)], np.fromiter(map(len, names), np.int64, len(names)) + UNIT_COST + 4 * self.length[:len(names)]
        order = np.argsort(-met, kind="stable")
        order = order[(np.cumsum(size[order]) <= self.max_bytes // 2) & (met[order] > 1)]
        lens = self.length[order]
        flat = gather(self.flat, self.begin[order], lens)
        self.slot = {names[i]: k for k, i in enumerate(order.tolist())}
        self.used, self.bytes = len(flat), int(size[order].sum())
        self.flat = np.concatenate([flat, np.empty(1 << 16, np.uint32)])
        self.length = np.concatenate([lens, np.zeros(1 << 14, np.int64)])
        self.begin = np.cumsum(self.length) - self.length
        self.met = np.concatenate([met[order] // 2, np.zeros(1 << 14, np.int64)])

    def _slots(self, units: list[str]) -> np.ndarray:
        slots = np.fromiter(map(self.slot.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = len(self.slot) + np.arange(len(new))  # as they are learned
            self._learn([units[i] for i in new.tolist()])
        self.met[slots] += 1
        return slots

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts, and where each text's ids end. Null: none."""
        if self.bytes > self.max_bytes:
            self._trim()
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        # a special token is found before anything else: such texts are left to the library
        odd = np.zeros(len(texts), bool)
        for token in self._special:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(odd)
        got = self._whole([texts[int(i)].as_py() for i in whole]) if len(whole) else []
        texts = pc.if_else(pa.array(odd), "", texts).cast(pa.large_string()) if len(whole) else texts
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        # a slice of a batch shares its buffer: only the slice's own bytes are looked at
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0]:bounds[-1]] if texts.buffers()[2] else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        starts = cuts(data)
        starts[bounds[:-1][bounds[:-1] < len(data)]] = True
        at = np.flatnonzero(starts)
        units = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data)).astype(np.int64).tobytes()),
                                                 pa.py_buffer(data))
        coded = units.dictionary_encode()
        slots = self._slots(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy(zero_copy_only=False)] if len(at) else np.zeros(0, np.int64)
        lens = self.length[slots]
        ids = gather(self.flat, self.begin[slots], lens)
        ends = np.append(0, np.cumsum(lens))[np.searchsorted(at, bounds[1:])]
        if len(whole):
            held = dict(zip(whole.tolist(), got))
            pieces = [np.array(held[i], np.uint32) if i in held else ids[a:b]
                      for i, (a, b) in enumerate(zip(np.append(0, ends[:-1]), ends))]
            return np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
        return ids, ends


@lru_cache(maxsize=1)
def file_encoder(path: str, max_bytes: int = MAX_BYTES) -> UnitEncoder:
    """The encoder of a tokenizer file; a Python worker holds one at a time."""
    return UnitEncoder(Tokenizer.from_file(path), max_bytes)
