"""Batched tokenizer calls that encode each distinct piece of text once.

Both public BPE tokenizers used here cut a text before merging, and always
cut between a space or line break and the characters around it.  A batch is
therefore split at single spaces and line breaks, the distinct pieces are
looked up in a bounded per-process cache, and only unseen pieces go through
the tokenizers library.  Ids equal ``encode(text)`` exactly; a text whose
white space is not single (or that holds a NUL or SOH character) is encoded
whole.  ``tests/llm`` compares both ways on arbitrary texts.

The cache is an Arrow column of pieces, beside one array with the ids of all
of them: one dictionary encoding of the cache and the pieces of a batch finds
what is known and what is not, so Python meets unseen pieces only.
"""

from __future__ import annotations

import os
from string import ascii_letters, punctuation
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that stay when a worker's cache holds over twice as many: those used last.
CACHE_PIECES = 300_000
#: Characters of text that are cut and looked up at a time (a text is never divided).
CHUNK_CHARS = 9_000_000
#: Unseen pieces that are joined to one text, and plain words.
MISS_PIECES, MISS_WORDS = 500, 5000

#: White space that is not one space or line break between other characters,
#: and the two characters used as marks (RE2, in Arrow).
_UNSAFE = (
    r"[\x00\x01\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|^[ \n]|[ \n]$"
)
#: Latin letters below U+0250, after a space or not.
_WORD = r"^ ?[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+$"
_SIGNS = frozenset(punctuation)
_IS_SIGN, _IS_LETTER = (np.isin(np.arange(256), list(map(ord, some))) for some in (punctuation, ascii_letters))
_ENCODERS: dict[str, "Encoder"] = {}


def _byte_symbols() -> dict[int, str]:
    """The character by which byte-level BPE names a byte: printable Latin-1 as
    itself, the others in order from U+0100 (a fixed part of that format)."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(0x100 + k) for k, b in enumerate(others)}


_BYTE_SYMBOLS = _byte_symbols()
#: The same as code points; a line break, which parts words here, stays.
_CODES = np.array([10 if b == 10 else ord(_BYTE_SYMBOLS[b]) for b in range(256)], "<u4")
#: Stands between texts.
_PART = "\x01"


def _cut(flat: bytes, signs: bool) -> pa.Array:
    """The pieces of texts with ``_PART`` between: a space begins one; line breaks, parts and (if ``signs``) a sign that ends a word are one each."""
    raw = np.frombuffer(flat, np.uint8)
    alone = (raw == 10) | (raw == ord(_PART))
    cut = np.ones(len(raw) + 1, bool)
    cut[:-1] = alone | (raw == 32)
    cut[1:-1] |= alone[:-1]
    cut[0] = True
    if signs:  # one after an ASCII letter, at the end of a piece (for longer runs and other letters see Encoder._bases)
        cut[1:-1] |= _IS_SIGN[raw[1:]] & _IS_LETTER[raw[:-1]] & cut[2:]
    bounds = np.flatnonzero(cut)
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat))


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist


def _places(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``first``, one run after the other."""
    at = np.repeat(first - np.cumsum(counts) + counts, counts)
    at += np.arange(len(at))
    return at


class Encoder:
    """Encodes batches of texts to arrays of ids."""

    #: Whether a sign at the end of a word has ids of its own.
    parts_signs = True

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.drops_space = np.array_equal(self._plain(" a"), self._plain("a"))
        self.lowers = np.array_equal(self._plain("Ab"), self._plain("ab"))
        #: " \x01" before a piece marks where its ids begin.
        self.mark = self._plain(" \x01")
        #: The model alone, on lines of symbols, and the symbols that each id stands for.
        self.lines = Tokenizer(self.tokenizer.model)
        self.lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        vocabulary = self.tokenizer.get_vocab(True)
        self.symbols = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.symbols[list(vocabulary.values())] = list(map(len, vocabulary))
        self.suffix = len(getattr(self.tokenizer.model, "end_of_word_suffix", None) or "")
        self._empty_cache()

    def _empty_cache(self) -> None:
        # Pieces, where the ids of each begin and how many they are, all ids, and the chunk that used the piece last.
        self.pieces = pa.array([_PART], pa.large_string())
        self.first, self.counts, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.empty(0, np.uint32)
        self.chunk, self.used = 0, np.zeros(1, np.int64)

    def _plain(self, text: str) -> np.ndarray:
        one = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(one.ids, np.uint32)

    def _ends_in_letter(self, base: str) -> bool:
        """Whether a letter stands last once the tokenizer has normalised the text.

        Lowering can end a letter in a combining mark, and so can NFC; a mark
        goes with the signs after it.
        """
        if self.lowers and not base.isascii():
            base = normalize("NFC", base).lower()
        return base[-1:].isalpha()

    def _bases(self, pieces: list[str]) -> tuple[list[str], dict[int, str]]:
        """The pieces as they are looked up, and the ASCII signs that end some of them.

        After a letter both tokenizers keep a run of signs apart; a tokenizer
        that lowers its input needs one entry for both cases (ASCII only,
        where all lowering rules agree).
        """
        bases, tails = [], {}
        for p in pieces:
            if p[-1] in _SIGNS:
                base = p.rstrip(punctuation)
                if self._ends_in_letter(base):
                    tails[len(bases)] = p[len(base):]
                    p = base
            bases.append(p)
        if self.lowers:
            bases = [p.lower() if p.isascii() else p for p in bases]
        return bases, tails

    def _are_words(self, pieces: pa.Array) -> np.ndarray:
        """Which pieces are a space and Latin letters, or letters alone: one word for the BPE model."""
        found = pc.match_substring_regex(pieces, _WORD).to_numpy(zero_copy_only=False)
        if self.lowers:
            words = _strings(pieces.filter(pa.array(found)))
            found[found] = [p == p.lower() and (p.isascii() or is_normalized("NFC", p)) for p in words]
        return found

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of such words, by the model alone, and how many each has."""
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for k in range(0, len(words), MISS_WORDS):
            group = words[k: k + MISS_WORDS]
            raw = np.frombuffer("\n".join([p.lstrip(" ") for p in group] if self.drops_space else group).encode(), np.uint8)
            text = _CODES[raw].tobytes().decode("utf-32-le")
            some = np.array(self.lines.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            # A word ends where as many symbols are read as it has.
            ends = np.append(np.flatnonzero(raw == 10), len(raw)) + (self.suffix - 1) * np.arange(len(group)) + self.suffix
            read = np.cumsum(self.symbols[some])
            at = np.searchsorted(read, ends)
            if len(read) and read[-1] == ends[-1] and (read[at] == ends).all():
                ids.append(some)
                counts.append(np.diff(at, prepend=-1))
            else:  # some symbol has no id
                singly = [self._plain(p) for p in group]
                ids += singly
                counts.append(np.fromiter(map(len, singly), np.int64, len(group)))
        return np.concatenate(ids), np.concatenate(counts)

    def _word(self, piece: str) -> bytes | None:
        """The ids of a piece, if it is a plain word."""
        return self._words([piece])[0].tobytes() if self._are_words(pa.array([piece], pa.large_string()))[0] else None

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of unseen pieces: plain words by the model, others as a few long texts.

        Before a piece with a leading space stands the mark; the ids are cut
        apart there.  Other pieces (first of a line) are encoded singly.
        """
        out, plain = {}, self._are_words(pa.array(pieces, pa.large_string())).tolist()
        words = [p for p, is_plain in zip(pieces, plain) if is_plain]
        ids, counts = self._words(words)
        raw, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        out.update((p, raw[a:b]) for p, a, b in zip(words, [0, *ends], ends))
        pieces = [p for p, is_plain in zip(pieces, plain) if not is_plain]
        spaced = [p for p in pieces if p[0] == " "]
        bare = [p for p in pieces if p[0] != " "]
        for k in range(0, len(spaced), MISS_PIECES):
            group = spaced[k: k + MISS_PIECES]
            ids = self._plain("".join(" \x01" + p for p in group) + " \x01")
            n, at = len(self.mark), np.flatnonzero(ids == self.mark[-1])
            for d in range(1, n):
                at = at[at >= d]
                at = at[ids[at - d] == self.mark[-1 - d]]
            if len(at) != len(group) + 1:  # some piece has the mark's ids itself
                out.update((p, self._plain(p).tobytes()) for p in group)
                continue
            raw = ids.tobytes()
            cuts = zip(group, ((at[:-1] + 1) * 4).tolist(), ((at[1:] - n + 1) * 4).tolist())
            out.update((p, raw[a:b]) for p, a, b in cuts)
        for p, one in zip(bare, self.tokenizer.encode_batch_fast(bare, add_special_tokens=False)):
            out[p] = np.array(one.ids, np.uint32).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, in order."""
        out: list[np.ndarray | None] = [None] * len(texts)
        safe, size = [], 0
        unsafe = pc.match_substring_regex(pa.array(texts, pa.large_string()), _UNSAFE).to_pylist()
        total = sum(map(len, texts))
        most = total / max(1, -(-total // CHUNK_CHARS))  # even chunks: each meets the whole cache
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.empty(0, np.uint32)
            elif unsafe[i]:
                out[i] = self._plain(t)
            else:
                safe.append(i)
                size += len(t)
                if size >= most:
                    self._encode_safe(texts, safe, out)
                    safe, size = [], 0
        if safe:
            self._encode_safe(texts, safe, out)
        return out

    def _encode_safe(self, texts, rows, out) -> None:
        column = _cut(_PART.join([texts[i] for i in rows]).encode(), self.parts_signs)
        # Cached pieces keep their places in the dictionary, unseen ones follow.
        coded = pa.chunked_array([self.pieces, column]).dictionary_encode().chunk(1)
        del column
        index = coded.indices.to_numpy(zero_copy_only=False)
        self._remember(coded.dictionary, index)
        n = self.counts[index]
        ids = self.ids[_places(self.first[index], n)]
        for i, one in zip(rows, np.split(ids, np.cumsum(n)[index == 0])):
            out[i] = one
        if len(self.pieces) > 2 * CACHE_PIECES:
            self._forget()

    def _remember(self, pieces: pa.Array, index: np.ndarray) -> None:
        """The cache takes this dictionary, which begins with its own pieces; ``index`` is what is used of it."""
        unseen = pieces.slice(len(self.pieces))
        plain = self._are_words(unseen)
        ids, n = self._words(_strings(unseen.filter(pa.array(plain))))
        bases, tails = self._bases(_strings(unseen.filter(pa.array(~plain))))
        found = self._learn(list({*bases, *tails.values()}))
        parts = list(map(found.__getitem__, bases))
        for k, tail in tails.items():
            parts[k] += found[tail]
        counts = np.empty(len(unseen), np.int64)
        counts[plain], counts[~plain] = n, np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        # The ids of the words come before those of the others.
        order = np.argsort(~plain, kind="stable")
        first = np.empty(len(unseen), np.int64)
        first[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
        self.pieces, self.ids = pieces, np.concatenate([self.ids, ids, np.frombuffer(b"".join(parts), np.uint32)])
        self.first, self.counts = np.append(self.first, first), np.append(self.counts, counts)
        self.chunk += 1
        self.used = np.append(self.used, np.zeros(len(unseen), np.int64))
        self.used[index] = self.chunk

    def _forget(self) -> None:
        """Only the pieces used last stay in the cache, and the part between texts."""
        self.used[0] = self.chunk + 1
        kept = np.sort(np.argsort(-self.used, kind="stable")[:CACHE_PIECES])
        self.pieces, self.used, self.counts = self.pieces.take(pa.array(kept)), self.used[kept], self.counts[kept]
        self.ids = self.ids[_places(self.first[kept], self.counts)]
        self.first = np.cumsum(self.counts) - self.counts


def encoder(path: str) -> Encoder:
    """The process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
