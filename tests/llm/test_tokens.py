"""Packing, wavelet files and the cached tokenizer."""

import random
import zlib
from unicodedata import normalize

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barforge.llm import packing, wavelet
from barforge.llm.wavelet import WaveletMatrix
from barforge.llm.word_cache import Encoder
from tests.llm.conftest import ODD_ROWS, prose

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))


def plain(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_cached_ids_equal_whole_text_ids(path):
    r = random.Random(5)
    bits = ["a", "B", "Word", "don't", " ", "\n", "  ", "'s", "é", "É", "1", "22", ".", "!!", ",", "$$$", "<|endoftext|>", "\x01",
            "\x00", " ", "ſ", "Σς", "日本", "\t", "-", "\r\n", "​", "🙂", "é", "'ll", "İ", "ßen", "_x"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(16))) for _ in range(3000)] + [prose(1, 400), ""]
    ids, encode = Encoder(path).encode(texts), plain(path)
    assert all(a.tolist() == encode(t) for a, t in zip(ids, texts))


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_letters_that_change_length_before_signs(path):
    """Every letter whose lower or composed form is longer, before each kind of sign, and 100,000 random texts."""
    odd = [c for c in map(chr, range(0x80, 0x30000)) if c.isalpha() and (len(c.lower()) > 1 or normalize("NFC", c) != c)]
    assert "\u0130" in odd
    r = random.Random(9)
    bits = [*r.sample(odd, min(len(odd), 80)), "\u0130", "\u0130", "I", "a", ",", ".", "!)", "'s", " ", "\n", "\u0307", "7"]
    texts = [f"x{c}{s} y" for c in odd for s in (",", "''", "-a")]
    texts += ["".join(r.choice(bits) for _ in range(r.randrange(1, 9))) for _ in range(100_000)]
    ids = Encoder(path).encode(texts)
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    plain_ids = t.encode_batch_fast(texts, add_special_tokens=False)
    assert [x for x, a, b in zip(texts, ids, plain_ids) if a.tolist() != b.ids] == []


def test_cache_generations_do_not_change_ids(monkeypatch):
    monkeypatch.setattr("barforge.llm.word_cache.CACHE_PIECES", 20)
    encoder, encode = Encoder(BYTE), plain(BYTE)
    for k in range(5):
        texts = [prose(k, 60), prose(k + 1, 60)]
        assert [x.tolist() for x in encoder.encode(texts)] == [encode(t) for t in texts]


def test_packing_covers_every_id_once(frame):
    rows = ODD_ROWS + [(100 + k, prose(k, 500)) for k in range(30)]
    out = packing.pack(frame(rows).repartition(3), WORD, keep_ids=True).collect()
    by_sequence, by_doc, encode = {}, {}, plain(WORD)
    for p in out:
        assert p.length > 0 and zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append(p)
    fill = []
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        fill.append(at)
    assert sorted(by_sequence) == list(range(len(by_sequence))) and sorted(fill)[1:] == [4096] * (len(fill) - 1)
    for doc_id, text in rows[10:]:
        pieces = sorted(by_doc[doc_id], key=lambda p: p.start)
        joined = b"".join(p.ids for p in pieces)
        assert np.frombuffer(joined, "<u4").tolist() == [*encode(text), 2]
        assert all(p.doc_tokens == len(joined) // 4 for p in pieces)
    assert sum(fill) == sum(len(encode(t)) + 1 for _, t in rows)


def test_packing_of_nothing(frame):
    assert packing.pack(frame([]), WORD).collect() == []


def test_wavelet_matrix_answers():
    ids = np.random.default_rng(1).integers(0, 37, 5000).astype(np.uint32)
    matrix = WaveletMatrix.build(ids, 6)
    assert matrix.decode().tolist() == ids.tolist()
    assert matrix.access([0, 17, 511, 512, 4999]).tolist() == ids[[0, 17, 511, 512, 4999]].tolist()
    for symbol in (0, 5, 36):
        places = np.flatnonzero(ids == symbol).tolist()
        assert matrix.count(symbol) == len(places) and matrix.occurrences(symbol) == places
        assert [matrix.rank(symbol, e) for e in (0, 1, 512, 5000)] == [sum(p < e for p in places) for e in (0, 1, 512, 5000)]
    assert matrix.count(40) == matrix.count(1 << 20) == 0 and matrix.select(5, 10**6) == -1


def test_token_files_round_trip(frame, scratch, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_TOKENS", 400)
    rows = [(k, prose(k, 5 + 40 * (k % 7))) for k in range(60, 0, -1)] + [(None, "x y"), (0, None), (61, "")]
    path = f"{scratch}/files"
    out = wavelet.token_files(frame(rows), BYTE, path).collect()
    encode, at, expected = plain(BYTE), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*encode(text), 0], "<u4")
        expected.append((doc_id, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    assert sorted(map(tuple, out), key=lambda r: r[1]) == expected
    odd = wavelet.token_files(frame(ODD_ROWS), BYTE).collect()
    assert len(odd) == len(ODD_ROWS) and wavelet.token_files(frame([]), BYTE).collect() == []
