"""Cross-tokenizer alignment with white-space-token anchors.

Every text is tokenised whole by both tokenizers: A, a byte-level BPE, on a
space and the text, and B, a SentencePiece model that adds the space itself.
Where both have a token end and the next tokens begin with a space mark, the
text is cut (the anchors); between anchors lie windows, mostly one word.  A
window's alignment depends on its token ids only, so it is worked out, and its
bytes of A and B compared, once for every pair of id tuples and kept in a
bounded memo, where a block looks each of its distinct windows up once.  In a
window, A and B tokens are cut into groups where both end, and a link is a
pair of tokens whose bytes overlap.

Corpus counts of linked id pairs: tasks write their documents in blocks of
about ``BLOCK_CHARS`` characters, each with a table of its distinct pairs and
the number of its documents that hold them.  The tables are summed up over the
corpus, and the sums go back to the blocks through a join on the pair; a
block's documents then meet its table by a cogroup.  What is shuffled is a
table row for each block and pair, not a row for each document and pair, and
nothing is broadcast or gathered.

Defined cases: null and empty texts, and texts whose joined A or B bytes
differ from a space and the text, have no tokens: zeros and an empty group
string.  Rows that are equal, or share ``doc_id``, are documents of their own
in all counts.  An empty table gives no row.  A very long text is one block;
its memory grows with its own tokens.  Only ``doc_id`` and ``text`` are read,
so other columns may have any names.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import materialise
from barforge.llm.word_cache import _BYTE_SYMBOLS, Encoder

#: Characters of text in a block, unless a single text is longer.
BLOCK_CHARS = 1_000_000
#: Rows of a batch that become Python texts at a time.
SLICE_ROWS = 500
#: Windows of a generation of the memo.
MEMO_WINDOWS = 100_000
SPACE_MARK = "▁"
#: Marks the ids of B in a window's key, so that a key tells both tuples apart.
_B_FLAG = np.uint32(1 << 31)
_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}


class ByteTokenizer:
    """A: byte-level BPE from its JSON file, run by tiktoken on the same vocabulary.

    The file's ids are in the order of its merges, so they serve as ranks.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        byte_of = {symbol: b for b, symbol in _BYTE_SYMBOLS.items()}
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: bytes(byte_of[c] for c in t) for t, i in data["model"]["vocab"].items() if t not in special}
        ranks = {token: i for i, token in self.tokens.items()}
        self.sizes = np.zeros(max(self.tokens) + 1, np.int64)
        self.sizes[list(self.tokens)] = [len(token) for token in self.tokens.values()]
        self.encoding = tiktoken.Encoding("from-file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def token_ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """The ids of a space and each text; None if they do not spell it out.

        Tokens spell the pattern's matches in their order, so nothing is
        missing if they have as many bytes as the text.
        """
        out = []
        for t in texts:
            ids = np.array(self.encoding.encode_ordinary(" " + t), np.uint32)
            out.append(ids if self.sizes[ids].sum() == len(t.encode()) + 1 else None)
        return out


class PieceTokenizer(Encoder):
    """B: a SentencePiece BPE model; each distinct word is encoded once.

    No piece holds a space mark after another character, and none holds a line
    break, so the pieces of a text with single spaces and line breaks are
    those of its words; other texts are encoded whole.
    """

    parts_signs = False

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self._empty_cache()
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p for p in pieces):
            raise ValueError("pieces across words: this model needs whole texts")
        self.tokens = {i: self._bytes(i, p) for i, p in enumerate(pieces)}
        self.line_break = self.model.encode("\n")
        if len(self.model.encode("a")) != 1 or len(self.model.encode("\na")) != len(self.line_break) + 1:
            raise ValueError("the model has no token for the letter a")

    def _bytes(self, i: int, piece: str) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def _plain(self, text: str) -> np.ndarray:
        # Texts come with "a " before them (see token_ids).
        return np.array([*self.model.encode("a"), *self.model.encode(text[2:])], np.uint32)

    def _are_words(self, pieces: pa.Array) -> np.ndarray:
        return np.zeros(len(pieces), bool)

    def _bases(self, pieces: list[str]) -> tuple[list[str], dict[int, str]]:
        return pieces, {}

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        spaced = [p for p in pieces if p[0] == " "]
        bare = [p for p in pieces if p[0] != " "]
        found = self.model.encode([p[1:] for p in spaced], num_threads=1)
        # After a line break a word has no space mark before it.
        after = len(self.line_break)
        for p, ids in zip(bare, self.model.encode(["\n" + p for p in bare], num_threads=1)):
            found.append(self.line_break[1:] if p == "\n" else ids[after:])
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) * 4).tolist()
        raw = np.fromiter(chain.from_iterable(found), np.uint32).tobytes()
        return {p: raw[i:j] for p, i, j in zip(spaced + bare, [0, *ends], ends)}

    def token_ids(self, texts: list[str]) -> list[np.ndarray]:
        # The word before keeps the text's first space; its one id is cut off again.
        return [ids[1:] for ids in self.encode(["a " + t for t in texts])]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of values between neighbouring offsets."""
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


class Aligner:
    """Both tokenizers and the memo of windows."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokenizer(a_path), PieceTokenizer(b_path)
        self.a_size, self.b_size = (self._table(t.tokens, len) for t in (self.a, self.b))
        self.a_space = self._table(self.a.tokens, lambda token: token[:1] == b" ").astype(bool)
        #: Two generations of windows: groups as text, their number, links (A id in the high half of each).
        self.new: dict[bytes, tuple[str, int, bytes] | None] = {}
        self.old: dict[bytes, tuple[str, int, bytes] | None] = {}

    @staticmethod
    def _table(tokens: dict[int, bytes], of) -> np.ndarray:
        out = np.zeros(max(tokens) + 1, np.int64)
        out[list(tokens)] = [of(t) for t in tokens.values()]
        return out

    def _tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B; none for a text that A does not spell out, or B not in as many bytes."""
        none = np.empty(0, np.uint32)
        a, b = [none] * len(texts), [none] * len(texts)
        some = [k for k, t in enumerate(texts) if t]
        spelled = self.a.token_ids([texts[k] for k in some])
        for k, x, y in zip(some, spelled, self.b.token_ids([texts[k] for k in some])):
            if x is not None and self.a_size[x].sum() == self.b_size[y].sum():
                a[k], b[k] = x, y
        return a, b

    def _learn(self, keys: list[bytes]) -> None:
        """Align windows that the memo lacks, all in one run; a window that A and B spell differently has no entry."""
        ids = np.frombuffer(b"".join(keys), np.uint32)
        sizes = np.fromiter(map(len, keys), np.int64, len(keys)) // 4
        window = np.repeat(np.arange(len(keys)), sizes)
        in_b = ids >= _B_FLAG
        a, b, of_a = ids[~in_b], ids[in_b] ^ _B_FLAG, window[~in_b]
        a_list, b_list = a.tolist(), b.tolist()
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_bytes, b_bytes = b"".join(map(self.a.tokens.__getitem__, a_list)), b"".join(map(self.b.tokens.__getitem__, b_list))
        # Every stretch between neighbouring ends, of A or B, is what one pair shares.
        ends = np.union1d(a_ends, b_ends)
        i, j = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        raw = ((a[i].astype(np.int64) << 32) | b[j].astype(np.int64)).tobytes()
        linked = np.searchsorted(of_a[i], np.arange(len(keys) + 1))
        shared = np.flatnonzero((a_ends[i] == ends) & (b_ends[j] == ends))
        grouped = np.searchsorted(of_a[i[shared]], np.arange(len(keys) + 1))
        # Names of the ids with the sign that follows each, group by group.
        a_last, b_last, done = np.zeros(len(a), bool), np.zeros(len(b), int), i[shared] + 1
        a_last[i[shared]], b_last[j[shared]], b_last[j[shared][grouped[1:] - 1]] = True, 1, 2
        names = [f"{x}|" if last else f"{x}," for x, last in zip(a_list, a_last.tolist())]
        names += [f"{y}{',;'[last]}" if last < 2 else str(y) for y, last in zip(b_list, b_last.tolist())]
        a_group = np.searchsorted(done, np.arange(len(a)), "right")
        b_group = np.searchsorted(j[shared] + 1, np.arange(len(b)), "right")
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        names = list(map(names.__getitem__, order.tolist()))
        upto, links, groups = np.concatenate([[0], np.cumsum(sizes)]).tolist(), (linked * 8).tolist(), np.diff(grouped).tolist()
        byte_ends = a_ends[np.cumsum(np.bincount(of_a, minlength=len(keys))) - 1].tolist() if a_bytes != b_bytes else []
        at = 0
        for k, key in enumerate(keys):
            if byte_ends:
                spelled = a_bytes[at:byte_ends[k]] == b_bytes[at:byte_ends[k]]
                at = byte_ends[k]
                if not spelled:
                    self.new[key] = None
                    continue
            self.new[key] = ("".join(names[upto[k]:upto[k + 1]]), groups[k], raw[links[k]:links[k + 1]])

    def _look_up(self, keys: list[bytes]) -> list[tuple[str, int, bytes] | None]:
        """What the memo holds for distinct windows, in their order; unseen ones are learnt first."""
        if len(self.new) > MEMO_WINDOWS:
            self.old, self.new = self.new, {}
        lacking = [k for k in keys if k not in self.new]
        self.new.update((k, self.old[k]) for k in lacking if k in self.old)
        if unseen := [k for k in lacking if k not in self.old]:
            self._learn(unseen)
        return list(map(self.new.__getitem__, keys))

    def align(self, texts: list[str | None]) -> dict:
        """n_a, n_b, n_groups and group text of every text; all links in order, with offsets per text."""
        a_rows, b_rows = self._tokens(texts)
        while True:
            n_a, n_b = (np.fromiter(map(len, rows), np.int64, len(rows)) for rows in (a_rows, b_rows))
            a, b = np.concatenate([np.empty(0, np.uint32), *a_rows]), np.concatenate([np.empty(0, np.uint32), *b_rows])
            a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            # Anchors: shared ends before a token with a space mark, and the ends of texts.
            at = np.searchsorted(b_ends, a_ends)
            shared = np.flatnonzero(b_ends[at] == a_ends) if len(a) else np.empty(0, np.int64)
            before = np.ones(len(a), bool)
            before[:-1] = self.a_space[a[1:]]
            before[np.cumsum(n_a)[n_a > 0] - 1] = True
            anchors = shared[before[shared]]
            windows = _windows(a, b, anchors + 1, at[anchors] + 1).dictionary_encode()
            index = windows.indices.to_numpy()
            found = self._look_up(windows.dictionary.to_numpy(zero_copy_only=False).tolist())
            # Windows up to the end of every text.
            upto = np.concatenate([[0], np.searchsorted(anchors, np.cumsum(n_a) - 1, "right")])
            if None not in found:
                break
            unlike = np.fromiter((f is None for f in found), bool, len(found))[index]
            for k in np.flatnonzero(_sums(unlike, upto)).tolist():
                a_rows[k], b_rows[k] = a_rows[k][:0], b_rows[k][:0]
        names, groups, links = zip(*found) if found else ((), (), ())
        named = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(names, pa.large_string()).take(windows.indices))
        linked, offsets = _gathered(links, index)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": _sums(np.array(groups, np.int64)[index], upto),
            "groups": pc.binary_join(named, pa.scalar(";", pa.large_string())).to_pylist(), "links": linked, "offsets": offsets[upto],
        }


def _windows(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> pa.LargeBinaryArray:
    """The ids of A, then the marked ids of B, of every window (in tokens of A and B up to its end)."""
    a_sizes, b_sizes = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    ids = np.empty(len(a) + len(b), np.uint32)
    ids[np.arange(len(a)) + np.repeat(b_ends - b_sizes, a_sizes)] = a
    ids[np.arange(len(b)) + np.repeat(a_ends, b_sizes)] = b | _B_FLAG
    offsets = np.concatenate([[0], (a_ends + b_ends) * 4]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(a_ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def _gathered(links: tuple[bytes, ...], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of the windows that ``index`` names, one after the other, and where each window's begin."""
    sizes = np.fromiter(map(len, links), np.int64, len(links)) // 8
    table, first = np.frombuffer(b"".join(links), np.int64), np.cumsum(sizes) - sizes
    n = sizes[index]
    offsets = np.concatenate([[0], np.cumsum(n)])
    return table[np.arange(offsets[-1]) + np.repeat(first[index] - offsets[:-1], n)], offsets


def aligner(a_path: str, b_path: str) -> Aligner:
    """The process's aligner for two tokenizer files."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


_ROWS = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()), ("slots", pa.list_(pa.int32())),
    ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())),
])
_SPARK_ROWS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
    "slots array<int>, times array<int>, pairs array<long>, held array<int>"
)


def _block_rows(block: int, ids: list[int | None], found: dict, keep_groups: bool) -> pa.RecordBatch:
    """A row per document with its distinct pairs (slots of the block's table), and the table's row."""
    n, offsets = len(ids), found["offsets"]
    coded = pa.array(found["links"]).dictionary_encode()
    pairs = coded.dictionary.to_numpy()
    doc = np.repeat(np.arange(n), np.diff(offsets))
    width = max(1, len(pairs))
    met, times = np.unique(doc * width + coded.indices.to_numpy(), return_counts=True)
    slots = (met % width).astype(np.int32)
    cuts = np.searchsorted(met, np.arange(n + 1) * width).astype(np.int32)
    held = np.bincount(slots, minlength=len(pairs)).astype(np.int32)
    texts = found["groups"]

    def lists(values: np.ndarray, kind: pa.DataType, cuts=cuts) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))

    rows = pa.RecordBatch.from_arrays([
        pa.array(np.full(n, block)), pa.array(ids, pa.int64()), pa.array(found["n_a"]), pa.array(found["n_b"]),
        pa.array(found["n_groups"]), pa.array(np.diff(offsets)),
        pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts], pa.string()),
        pa.array(texts if keep_groups else [None] * n, pa.string()), lists(slots, pa.int32()),
        lists(times, pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32())),
    ], schema=_ROWS)
    table = pa.RecordBatch.from_pylist([{"block": block, "pairs": pairs, "held": held}], schema=_ROWS)
    return pa.Table.from_batches([rows, table]).combine_chunks().to_batches()[0]


def align_blocks(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False) -> DataFrame:
    """Blocks of aligned documents, each with the table of its pairs (a row whose ``pairs`` is not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, both = TaskContext.get().partitionId(), aligner(a_path, b_path)
        number, ids, texts, size = 0, [], [], 0
        gc.freeze()  # the vocabularies and the memo hold no cycles: not worth a pass each time
        slices = (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS))
        for doc_id, text in (row for s in slices for row in zip(*(c.to_pylist() for c in s.columns))):
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size >= BLOCK_CHARS:
                yield _block_rows(part << 32 | number, ids, both.align(texts), keep_groups)
                number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield _block_rows(part << 32 | number, ids, both.align(texts), keep_groups)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SPARK_ROWS)


def pair_counts(tables: DataFrame) -> DataFrame:
    """pair, n (documents of the corpus that hold it) and whether it is the most frequent of its A id, ties included."""
    counts = tables.groupBy("pair").agg(F.sum("held").alias("n"))
    # At most one row per B id in a partition of the window.
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False) -> DataFrame:
    """Per document its tokens, groups, links, and how frequent its links are in the corpus."""
    rows = materialise(align_blocks(docs, a_path, b_path, keep_groups), "aligned")
    tables = rows.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("slot", "at"))
    tables = tables.select("block", "slot", F.col("at.pairs").alias("pair"), F.col("at.held").alias("held"))
    known = tables.join(pair_counts(tables), "pair").select(F.col("block").alias("of_block"), "slot", "n", "best")
    each = rows.where("pairs IS NULL").drop("pairs", "held")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        slot = right.column("slot").to_numpy()
        n, best = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        n[slot], best[slot] = right.column("n").to_numpy(), right.column("best").to_numpy()
        slots, times = (left.column(c).combine_chunks() for c in ("slots", "times"))
        offsets = np.concatenate([[0], np.cumsum(slots.value_lengths().to_numpy())])
        at, often = slots.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        out = left.drop_columns(["block", "slots", "times"])
        out = out.append_column("n_best", pa.array(_sums(often * best[at], offsets)))
        return out.append_column("count_sum", pa.array(_sums(often * n[at], offsets)))

    kinds = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
        "n_best long, count_sum long"
    )
    return each.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(meet, kinds)


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The columns of the query: no group texts, their digest."""
    return align_documents(docs, a_path, b_path).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
