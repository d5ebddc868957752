"""Operators 3, 8 and 9: against the tokenizer libraries, and exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerlens.llm import byte_bpe, packing, repair, units
from ledgerlens.llm.shared import scratch, table, text_slices
from ledgerlens.llm.units import MAX_BYTES, UnitEncoder
from tests.conftest import SF_SMALL

ODD = ["", None, " ", "a", "a  b", "a \n b\n \nc", "\n\n", "tab\t\tx  ", "it's I'm WE'LL", "naïve café́ ñ", "日本語 テスト 😀😀",
       "<|endoftext|> x<|endoftext|>", "1234567890 12,5", "x" * 5000, "wörter " * 3000, "a   b", "\x1c \x1d", "  lead", "trail  "]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and clashing columns."""
    rows = [(i, t, "n", 1) for i, t in enumerate(ODD)] + [(3, "a", "n", 1), (None, "null id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start int")


@pytest.fixture(scope="module")
def tik():
    with open(byte_bpe.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("path", [repair.TOKENIZER, packing.TOKENIZER])
@pytest.mark.parametrize("most", [MAX_BYTES, 500])
def test_units_equal_the_whole_text(path, most):
    """Ids as the library gives them by default, from it, from kept units, after trimming."""
    plain, encoder = Tokenizer.from_file(path), UnitEncoder(Tokenizer.from_file(path), most)
    rnd = random.Random(1)
    signs = list("abXYZ éÉßñ×÷İıſЖΣσς,.;'\n\n  \t\r  ́中文日本ไทย한국عربي😀👍🏽12345_-\"(<>≠|*\x00\x1c\x85\xa0　\u2003") + [
        "<|endoftext|>", "<|startoftext|>", "'s", "'ll", " \n", "\n\n", " '"]
    texts = ODD + ["".join(rnd.choices(signs, k=rnd.randrange(1, 60))) for _ in range(4000)]
    for i in range(0, len(texts), 300):
        part = texts[i:i + 300]
        for column in (pa.array(part), pa.array(["x", *part])[1:]):  # an array that begins inside its buffers
            ids, ends = encoder.encode(column)
            got = [ids[a:b].tolist() for a, b in zip(np.append(0, ends[:-1]), ends)]
            assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in part]
    assert encoder.encode(pa.array([], pa.string()))[1].tolist() == []


def test_units_memory_is_bounded_in_bytes():
    """Texts without a place to cut are not kept; frequent words are."""
    encoder, rnd = UnitEncoder(Tokenizer.from_file(repair.TOKENIZER), 1 << 20), random.Random(2)
    frequent = ["word%s" % "".join(rnd.choices("abcdef", k=6)) for _ in range(500)]
    for i in range(12):
        long = ["".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(30_000)) for _ in range(5)]
        rare = ["".join(rnd.choices("abcdefghij", k=12)) for _ in range(3000)]
        encoder.encode(pa.array([" ".join(frequent + rare), *long]))
        encoder.encode(pa.array([" ".join(frequent)]))
    assert encoder.bytes <= (1 << 20) + 3000 * 250 + 5 * 30_000 * 20 and all(" " + w in encoder.slot for w in frequent[1:])
    encoder._trim()
    assert encoder.bytes <= 1 << 19 and sum(map(len, encoder.slot)) < 1 << 19


def test_a_batch_in_slices_is_cut_once(monkeypatch):
    """A slice shares its batch's buffer: the bytes before it are not looked at again."""
    looked, cuts = [], units.cuts
    monkeypatch.setattr(units, "cuts", lambda b: (looked.append(len(b)), cuts(b))[1])
    texts = ["\nplain words, and more: 1234", " é\n\nß x", "", " two  gaps ", "é. x"] * 20
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    plain, encoder = Tokenizer.from_file(repair.TOKENIZER), UnitEncoder(Tokenizer.from_file(repair.TOKENIZER))
    got = []
    for part in text_slices([batch], limit=50):
        ids, ends = encoder.encode(part.column(0))
        got += [x.tolist() for x in np.split(ids, ends[:-1])]
    assert len(looked) > 20 and sum(looked) <= sum(len(t.encode()) for t in texts)
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_byte_bpe_equals_tiktoken(spark, tik, odd):
    for docs in (table(spark, SF_SMALL, "documents"), odd):
        texts = {(r.doc_id, r.text) for r in docs.collect()}
        want = sorted((d or -1, len(ids := tik.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()) for d, t in texts)
        got = {(r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.encoding_digests(docs).collect()}
        assert sorted(got) == sorted(set(want))


def test_byte_bpe_offsets_and_decoding(spark, odd):
    encoded = byte_bpe.encode_texts(odd)
    rows = {r.doc_id: r for r in encoded.collect()}
    back = {r.doc_id: r.text for r in byte_bpe.decode_ids(encoded).collect()}
    for i, t in enumerate(ODD):
        t, r = t or "", rows[i]
        assert back[i] == t
        covered = set()
        for a, b in zip(r.starts, r.ends):
            assert 0 <= a <= b <= len(t)
            covered.update(range(a, b))
        assert covered == set(range(len(t)))
        assert r.starts == sorted(r.starts) and r.ends == sorted(r.ends)
    emoji = rows[ODD.index("日本語 テスト 😀😀")]
    assert any(a == c for a, c in zip(emoji.starts, emoji.starts[1:]))  # tokens within one character
    cut = spark.createDataFrame([(1, emoji.ids[-1:]), (2, None)], "doc_id long, ids array<int>")
    assert [r.text for r in byte_bpe.decode_ids(cut).orderBy("doc_id").collect()] == ["�", None]


def _ids(text, path, end):
    t = Tokenizer.from_file(path)
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_grammar_files_give_back_every_id(spark, odd):
    for docs in (table(spark, SF_SMALL, "documents"), odd):
        at, want = 0, []
        for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
            ids = _ids(r.text, repair.TOKENIZER, 0)
            want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
        got = sorted(map(tuple, repair.grammar_digests(docs).collect()), key=lambda r: r[1])
        assert got == want


def test_random_access_decodes_one_document(spark):
    out = scratch(spark, "ids")
    docs = table(spark, SF_SMALL, "documents")
    repair.write_ids(docs, out, shard_ids=20_000)
    texts = {r.doc_id: r.text for r in docs.collect()}
    files = spark.read.parquet(out).collect()
    assert len(files) > 3
    symbols = 0
    for row in files:
        shard = repair.Shard(row.asDict())
        symbols += len(shard.symbols)
        for k in range(0, len(shard.ends), 7):
            assert shard.document(k).tolist() == _ids(texts[int(shard.doc_ids[k])], repair.TOKENIZER, 0).tolist()
    assert symbols < 0.95 * sum(r["n_ids"] for r in files)  # rules were found


def test_compress_expand_on_repetitive_and_random_ids():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(1000, np.uint32), rng.integers(0, 3, 5000, np.uint32), rng.integers(0, 50000, 5000, np.uint32),
                np.tile(np.arange(7, dtype=np.uint32), 900), np.empty(0, np.uint32), np.array([5], np.uint32)):
        symbols, rules, lengths = repair.compress(ids)
        assert repair.expand(symbols, rules).tolist() == ids.tolist()
        for a, b in ((0, len(ids)), (len(ids) // 3, len(ids) // 2)):
            assert repair.expand_range(symbols, rules, lengths, a, b).tolist() == ids[a:b].tolist()


def test_no_pair_is_left_that_pays_for_a_rule(spark):
    """Rounds go on until no pair occurs LEAST_COUNT times; rules grow over rounds."""
    encoder = UnitEncoder(Tokenizer.from_file(repair.TOKENIZER))
    ids, _ = encoder.encode(pa.array([r.text for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]))
    for least in (repair.LEAST_COUNT, 6):
        symbols, rules, lengths = repair.compress(ids, least)
        assert repair.expand(symbols, rules).tolist() == ids.tolist() and lengths.max() > 8
        pairs, counts = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)
        # a run of one symbol holds half as many uses as pairs
        often = (counts >= least) & (pairs[0] != pairs[1])
        assert not often.any()
        assert 3 * len(symbols) + 16 * len(rules) < 0.6 * 4 * len(ids)


def check_packing(docs, rows):
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == {d.doc_id for d in docs}
    for doc in docs:
        ids, own = _ids(doc.text, packing.TOKENIZER, 1), sorted(pieces[doc.doc_id], key=lambda r: r.start)
        copies = sum(d.doc_id == doc.doc_id for d in docs)
        assert sum(r.length for r in own) == copies * len(ids)
        for r in own:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    for own in windows.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.WINDOW


def test_packing_places_every_id_once(spark, odd):
    for docs in (table(spark, SF_SMALL, "documents"), odd):
        packed = packing.pack(docs)
        check_packing(docs.collect(), packed.collect())
    use = packing.padding(packing.pack(table(spark, SF_SMALL, "documents"))).first()
    assert use.padded < 0.02 * use.tokens


def test_merge_that_needs_more_windows_keeps_them(spark):
    """By falling length these make three windows, as they came two."""
    words = lambda n: " ".join(["the"] * (n - 1))  # noqa: E731  (n tokens with the end)
    docs = spark.createDataFrame([(i, words(n)) for i, n in enumerate([870, 580, 580, 870, 580, 580])], "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs).collect()
    assert sorted(r.length for r in rows) == [580] * 4 + [870] * 2 and len({r.sequence_id for r in rows}) == 2
    check_packing(docs.collect(), rows)


def test_open_windows_take_the_best_fit_and_emit_the_fullest():
    w = packing.OpenWindows(10, 2)
    assert w.add(("a", 0, 6)) is None and w.add(("b", 0, 7)) is None
    assert w.add(("c", 0, 2)) is None  # fits both: into b's window, the fuller
    assert w.add(("d", 0, 5)) == [("b", 0, 7), ("c", 0, 2)]  # fits none: the fullest goes
    assert w.add(("e", 0, 5)) == [("d", 0, 5), ("e", 0, 5)]  # full
    assert list(w.left()) == [[("a", 0, 6)]]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none).count() == 0
    assert byte_bpe.encoding_digests(none).count() == 0
    assert repair.grammar_digests(none).count() == 0


def test_packing_in_little_memory_gives_the_same_pieces(spark):
    """Smaller slices and fewer remembered units change no piece (one task)."""
    docs = table(spark, SF_SMALL, "documents").coalesce(1)
    some = lambda **k: sorted(map(tuple, packing.pack(docs, **k).collect()))
    assert some(slice_bytes=1 << 14, unit_bytes=1 << 14) == some()
