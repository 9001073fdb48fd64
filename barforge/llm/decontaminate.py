"""Benchmark decontamination by the q-gram lemma.

An occurrence of an item of m characters with at most e edits shares at least
m + 1 - q (e + 1) character q-grams with it, on diagonals that differ by e at
most.  Shared q-grams are counted in overlapping diagonal bands; a band that
meets the bound is verified by a bit-parallel alignment of the item with the
characters on the band's diagonals.  The texts are scanned where they lie
(no shuffle); the benchmark is handed to the tasks in blocks of at most
``BLOCK_CHARS`` characters, one scan of the documents per block.

Texts are compared in lower case, all white space as spaces.  The edit budget
is ``EDITS`` of the item's length, rounded down.  An item is indexed by the
longest q-grams of ``QS`` whose bound is at least 1 at that budget, so that an
item of any length is found; below 10 characters that is its exact text.

Defined cases: null and empty texts hold nothing; null and empty items never
match; very long texts are scanned whole; equal items and repeated rows match
alike, each for itself; of equally good occurrences the first is reported; a
null ``doc_id`` or ``item_id`` is carried through; empty tables give empty
results; other columns are not read, or are kept as they are by
``drop_leaking``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.align import find_within
from barforge.llm.common import materialise

#: Lengths of q-grams, powers of two.
QS = (8, 4, 2, 1)
EDITS = 0.1
BLOCK_CHARS = 1_000_000
_CHUNK_CHARS = 1_000_000
_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.array([9, 10, 11, 12, 13, 0x85, 0xA0, 0x2028, 0x2029], np.uint32)

LEAKS = "doc_id long, item_id long, edits int, start int, end int"


def fold(text: str) -> str:
    """Lower case, character by character, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(fold(text).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = codes.copy()
    for c in _SPACES:
        out[out == c] = 32
    return out


def _hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q characters that start at each place, by doublings."""
    h = codes.astype(np.uint64)
    width, factor = 1, _BASE
    with np.errstate(over="ignore"):
        while width < q:
            h = h[: len(h) - width] * factor + h[width:]
            width, factor = 2 * width, factor * factor
        return h * _BASE ^ (h >> np.uint64(29))


def gram_bound(m: int, q: int, edits: float = EDITS) -> int:
    """q-grams that an item of m characters shares at least with an occurrence within its budget."""
    return m + 1 - q * (int(edits * m) + 1)


class Grams:
    """q-grams of some items, with a bit map that passes few other q-grams."""

    def __init__(self, items: list[tuple[int, np.ndarray]], q: int, edits: float = EDITS):
        self.q = q
        self.ids, self.codes, self.budgets, self.bounds = [], [], [], []
        grams, owners, places = [], [], []
        for item_id, codes in items:
            h = _hashes(codes, q)
            grams.append(h)
            owners.append(np.full(len(h), len(self.ids), np.int64))
            places.append(np.arange(len(h), dtype=np.int64))
            self.ids.append(item_id)
            self.codes.append(codes)
            self.budgets.append(int(edits * len(codes)))
            self.bounds.append(gram_bound(len(codes), q, edits))
        all_grams = np.concatenate(grams)
        order = np.argsort(all_grams, kind="stable")
        self.grams, self.first, self.times = np.unique(all_grams[order], return_index=True, return_counts=True)
        self.owners, self.places = np.concatenate(owners)[order], np.concatenate(places)[order]
        self.map = np.zeros(1 << _BITS, bool)
        self.map[(self.grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.budgets, self.bounds = np.array(self.budgets), np.array(self.bounds)

    def scan(self, codes: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item id, edits, start, end): the best occurrence of each item in each text."""
        q = self.q
        flat = np.concatenate(codes)
        if len(flat) < q:
            return []
        h = _hashes(flat, q)
        at = np.flatnonzero(self.map[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        gram = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        hit = self.grams[gram] == h[at]
        at, gram = at[hit], gram[hit]
        n = np.fromiter(map(len, codes), np.int64, len(codes))
        ends = np.cumsum(n)
        row = np.searchsorted(ends, at, "right")
        inside = at + q <= ends[row]
        at, gram, row = at[inside], gram[inside], row[inside]
        # One entry per shared q-gram and place in an item.
        times = self.times[gram]
        upto = np.cumsum(times)
        post = np.repeat(self.first[gram] - (upto - times), times) + np.arange(int(times.sum()))
        item = self.owners[post]
        row, place = np.repeat(row, times), np.repeat(at - (ends - n)[row], times)
        step = self.budgets[item] + 1
        band = (place - self.places[post]) // step
        # A band is two neighbouring strips of e + 1 diagonals: each lies in two bands.
        keys = np.stack([row, item, band])
        strips, counts = _count(keys)
        if not strips.shape[1]:
            return []
        both = counts.copy()
        next_is = (np.diff(strips[0]) == 0) & (np.diff(strips[1]) == 0) & (np.diff(strips[2]) == 1)
        both[:-1][next_is] += counts[1:][next_is]
        kept = np.flatnonzero(both >= self.bounds[strips[1]])
        # Every match has a lowest strip, so each band is tested at its lower strip.
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for r, i, b in strips[:, kept].T.tolist():
            e, m = int(self.budgets[i]), len(self.codes[i])
            lo = max(0, b * (e + 1) - e)
            hi = b * (e + 1) + 2 * e + 2 + m + e
            found = find_within(self.codes[i].tolist(), codes[r][lo: max(lo, hi)].tolist(), e)
            if found and (found[0], lo + found[1]) < best.get((r, i), (m + 1, 0, 0))[:2]:
                best[r, i] = (found[0], lo + found[1], lo + found[2])
        return [(r, self.ids[i], *found) for (r, i), found in best.items()]


class Index:
    """A block of items, each in the ``Grams`` of its q."""

    def __init__(self, items: list[tuple[int, str]], edits: float = EDITS):
        by_q: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            codes = _codes(text or "")
            # An empty item has no q.
            q = next((q for q in QS if gram_bound(len(codes), q, edits) >= 1), None)
            if q:
                by_q.setdefault(q, []).append((item_id, codes))
        self.parts = [Grams(some, q, edits) for q, some in by_q.items()]

    def scan(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item id, edits, start, end): the best occurrence of each item in each text."""
        out: list[tuple[int, int, int, int, int]] = []
        k = 0
        while self.parts and k < len(texts):
            some, size, end = [], 0, k
            while end < len(texts) and size < _CHUNK_CHARS:
                some.append(_codes(texts[end] or ""))
                size += len(some[-1])
                end += 1
            out += [(k + row, *rest) for part in self.parts for row, *rest in part.scan(some)]
            k = end
        return out


def _count(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns in order, and how often each occurs."""
    order = np.lexsort(keys[::-1])
    ordered = keys[:, order]
    if not ordered.shape[1]:
        return ordered, np.empty(0, np.int64)
    new = np.append(True, (np.diff(ordered) != 0).any(axis=0))
    starts = np.flatnonzero(new)
    return ordered[:, starts], np.diff(np.append(starts, ordered.shape[1]))


def _blocks(benchmark: DataFrame, edits: float) -> Iterator[tuple[bool, object]]:
    """The benchmark's blocks as broadcast indexes; True with the last one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length("text") > 0)
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-chars // BLOCK_CHARS))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        index = Index([(r["item_id"], r["text"]) for r in rows], edits)
        yield k == n - 1, benchmark.sparkSession.sparkContext.broadcast(index)


def find_leaks(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """One row per document and item that it holds, with the best occurrence."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    out = None
    for last, index in _blocks(benchmark, edits):

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = index.value.scan(batch.column(1).to_pylist())
                columns = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[r] for r in columns[0]], pa.int64()), pa.array(columns[1], pa.int64())]
                    + [pa.array(c, pa.int32()) for c in columns[2:]],
                    names=["doc_id", "item_id", "edits", "start", "end"],
                )

        found = texts.mapInArrow(scan, LEAKS)
        found = found if last else materialise(found, "leaks")
        out = found if out is None else out.unionByName(found)
    return out


def _clean(index):
    """A column function: whether a text holds no item of the block."""

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            ok = np.ones(len(batch), bool)
            for row, *_ in index.value.scan(batch.tolist()):
                ok[row] = False
            yield pd.Series(ok)

    return clean


def drop_leaking(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows, with all their columns, whose text holds no benchmark item."""
    for last, index in _blocks(benchmark, edits):
        docs = docs.where(_clean(index)(F.coalesce("text", F.lit(""))))
        docs = docs if last else materialise(docs, "decontaminated")
    return docs
