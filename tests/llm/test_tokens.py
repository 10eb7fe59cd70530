"""Packed ids and packed sequences against the tokenizers library, and round trips of the file format."""

import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from doctables.llm import bitpack, packing, shared, tokens


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ,.\n\t é'1中—<|>", max_size=30), max_size=6))
def test_encoder_is_the_library(texts):
    tok = library()
    ids, n = tokens.encoder(tokens.default_path()).encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [tok.encode(t, add_special_tokens=False).ids for t in texts] if texts else not len(ids)


def test_blanks_beside_spaces():
    tok = library()
    for t in ("b \xa0 \xa0 ", "a \xa0 \xa0\nb", "\u2003 a", "a\u3000b c", " ", " \n", "a b ", " a"):
        assert tokens.encoder(tokens.default_path()).encode([t])[0].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_pieces_of_classes():
    """Letters, digits, marks, apostrophes and blanks of all kinds, side by side; the cache holds words, not words with marks."""
    import random

    tok, r, enc = library(), random.Random(3), tokens.Encoder(tokens.default_path())
    parts = [*"abZst1éßЖ×÷²½Ɂɐ҃Ҁ,._中😀\n\t\r\x0b\x1c\x85\xa0\u2028\u3000\u0301\x00", "'", "'", "re", "ll", "%%", " ", " ", " ", "  ", "<|endoftext|>", "<|"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 14))) for _ in range(5000)]
    ids, n = enc.encode(texts)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    enc.clear()
    enc.encode(["one two, one. two! one\ntwo one;two"])
    assert sorted(enc.entries) == sorted([b"one", b" two", b",", b" one", b".", b"!", b"\n", b"two", b";"])


def test_cache_keeps_frequent_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 100)
    tok, enc = library(), tokens.Encoder(tokens.default_path())
    for k in range(8):
        text = "often " + " ".join(f"w{'abcdefghij'[i % 10] * (i // 10 + 1)}{'xyzuvwst'[k]}" for i in range(60)) + " often"
        assert enc.encode([text])[0].tolist() == tok.encode(text, add_special_tokens=False).ids
    assert b" often" in enc.entries and len(enc.entries) <= 170


def test_worker_holds_one_cache():
    """A worker that turns to another operator lets the encoder and its pieces go."""
    import gc

    enc = tokens.encoder(tokens.default_path())
    assert tokens.encoder(tokens.default_path()) is enc
    del enc
    gc.collect()
    shared.held("a language model", dict)
    assert not any(isinstance(x, tokens.Encoder) for x in gc.get_objects())
    shared.let_go()
    assert not shared._HELD


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 9999).astype(np.uint32)
    out = io.BytesIO()
    w = bitpack.Writer(out, bits)
    w.add([5, None], ids[:6000], np.array([0, 6000]))
    w.add([9], ids[6000:], np.array([3999]))
    w.close()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    r = bitpack.Reader(Source(out.getvalue()))
    assert r.doc_ids == [5, None, 9] and r.starts.tolist() == [0, 0, 6000] and r.n == 9999
    for a, n in [(0, 9999), (4095, 2), (6000, 3999), (8191, 1), (17, 0)]:
        assert (r.ids(a, n) == ids[a : a + n]).all()


def want_ids(docs):
    tok, start, out = library(), 0, []
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_packed_ids(odd_docs):
    got = [tuple(r) for r in bitpack.packed_ids(odd_docs, files=3).collect()]
    assert sorted(got, key=lambda r: r[1]) == want_ids(odd_docs)


def test_packed_ids_empty(odd_docs):
    assert bitpack.packed_ids(odd_docs.limit(0)).count() == 0


def check_packing(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packed_sequences(odd_docs):
    tok = library()
    rows = packing.packed(odd_docs, size=64).collect()
    check_packing(rows, 64)
    want = []
    for r in odd_docs.collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        k = -(-len(ids) // 64)
        cuts = [0, *(len(ids) - 64 * (k - 1 - i) for i in range(k))]
        want += [(r.doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    assert packing.packed(odd_docs.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=33, max_size=33))
def test_plan_uses_every_piece(counts):
    histogram = np.array(counts)
    histogram[0] = 0
    used = np.zeros_like(histogram)
    n = 0
    for lengths, count in packing.plan(histogram):
        assert sum(lengths) <= 32 and count > 0
        n += count
        for x in lengths:
            used[x] += count
    assert (used == histogram).all()
    total = int((histogram * np.arange(33)).sum())
    assert n <= 1.15 * -(-total // 32) + 2 or (histogram[17:32].sum() * 32 > 0.6 * total)
