"""The cache of pieces: Python meets unseen pieces only, and every way to their ids gives the whole tokenizer's."""

import random

import numpy as np
import public_tokenizers
import pytest

from barforge.llm import word_cache
from barforge.llm.token_alignment import PieceTokenizer
from barforge.llm.word_cache import Encoder
from tests.llm.conftest import prose

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
BITS = ["a", "Word", "été", "ß", "é", "ſ", "漢", "7", ".", ",", "!!", "'s", "-", " ", "\n", "ǅ", "ª", "×", "é"]


def texts(seed):
    r = random.Random(seed)
    return ["".join(r.choice(BITS) for _ in range(r.randrange(14))) for _ in range(1500)] + [prose(seed, 200), "a", "", "é."]


def plain(enc, some):
    return [enc._plain(t).tolist() if t else [] for t in some]


@pytest.mark.parametrize("name", NAMES)
def test_only_unseen_pieces_reach_python(name, monkeypatch):
    enc, met, bases = Encoder(public_tokenizers.path(name)), [], Encoder._bases
    monkeypatch.setattr(Encoder, "_bases", lambda self, pieces: met.extend(pieces) or bases(self, pieces))
    first = [x.tolist() for x in enc.encode(texts(1))]
    # ("word" and "." are apart; a sign after another letter than an ASCII one is cut off later)
    assert met and len(met) == len(set(met)) and "a." not in met
    met.clear()
    assert [x.tolist() for x in enc.encode(texts(1))] == first and met == []


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("pieces, chars", [(1, 50), (30, 200), (300_000, 9_000_000)])
def test_ids_whatever_the_cache_holds(name, pieces, chars, monkeypatch):
    monkeypatch.setattr(word_cache, "CACHE_PIECES", pieces)
    monkeypatch.setattr(word_cache, "CHUNK_CHARS", chars)
    monkeypatch.setattr(word_cache, "MISS_WORDS", 7)
    enc = Encoder(public_tokenizers.path(name))
    for seed in (1, 2, 1):
        some = texts(seed)
        assert [x.tolist() for x in enc.encode(some)] == plain(enc, some)
        assert len(enc.pieces) <= 2 * pieces and len(enc.ids) == enc.counts.sum()


@pytest.mark.parametrize("name", NAMES)
def test_words_whose_symbols_have_no_id(name):
    enc = Encoder(public_tokenizers.path(name))
    words = [" word", " straße", "plain", " x"]
    expected = [enc._plain(p).tolist() for p in words]
    for unread in (False, True):
        if unread:  # as if the model had left out some symbol
            enc.symbols[:] = 0
        ids, counts = enc._words(words)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected


def test_pieces_of_the_other_tokenizer_keep_their_signs(monkeypatch):
    monkeypatch.setattr(word_cache, "CACHE_PIECES", 40)
    enc = PieceTokenizer(public_tokenizers.path("piece_bpe_32k.model"))
    some = ["one, two. three...", "it's, (a) b!\nnext. line", "é. été, x", *(prose(k, 90) for k in range(3))]
    expected = [enc.model.encode(t) for t in some]
    for _ in range(2):
        assert [x.tolist() for x in enc.token_ids(some)] == expected
