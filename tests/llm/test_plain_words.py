"""Short ways of the encoder and of the wavelet matrix give what the long ways give."""

import numpy as np
import public_tokenizers
import pytest

from barforge.llm.wavelet import WaveletMatrix
from barforge.llm.word_cache import Encoder


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_have_the_ids_of_the_whole_tokenizer(name):
    enc = Encoder(public_tokenizers.path(name))
    for word in ("word", "Straße", "été", "Aqwzxv", "antidisestablishmentarianism", "É", "a"):
        for piece in (word, " " + word):
            found = enc._word(piece)
            assert found is None or np.frombuffer(found, np.uint32).tolist() == enc._plain(piece).tolist(), piece
    assert enc._word(" word") is not None and enc._word("it's") is None and enc._word(" 漢") is None


def test_matrices_decode_to_their_ids():
    r = np.random.default_rng(7)
    for ids in (np.zeros(9), np.full(9, 65535), np.array([]), r.integers(0, 50_000, 4_001), r.integers(0, 3, 77)):
        ids = ids.astype(np.uint32)
        assert WaveletMatrix.build(ids, 16).decode().tolist() == ids.tolist()
