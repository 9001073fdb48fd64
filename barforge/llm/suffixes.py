"""Passages that repeat across documents: a sparse suffix array over words.

Only suffixes at content-selected places are kept: every window of
``MIN_WORDS`` words is assigned the place whose k-mer is the least of its first
``WINDOW`` words, so equal windows are assigned equal places, each followed by
at least ``KEY_WORDS`` more words of the window.  A window can repeat only if
the first words of its suffix (the key) stand in two documents.  Where they do,
the windows assigned to the suffix are told apart by a digest of all their
words, to the left of the place as well as to the right, and those that two
documents hold are kept.  No partner is chosen, so none can hide another.

Suffixes are sorted by key over all partitions, and windows by digest, both
with the document behind, so that a very frequent passage is spread over
several partitions by the sort; a task holds the rows of one document at a
time, and the ends of partitions are compared in a second step.

Words are runs of letters and digits in lower case; spans are word offsets.
Defined cases: null and empty texts have no passages; rows that are equal in
``doc_id`` and text are one document, and repeats inside one document do not
count; null ids are kept; empty tables give an empty result; only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import materialise

MIN_WORDS = 50
#: Places per window; a passage's first sample is at most WINDOW - 1 words in.
WINDOW = 32
KEY_WORDS = MIN_WORDS - WINDOW + 1
KMER = 4
#: Windows that a task holds before it hands them on.
MAX_HELD = 200_000
_MIX = np.uint64(0x94D049BB133111EB)
_ROWS = "doc_id long, tsig long, key long, first int, stop int"
_NAMES = ["doc_id", "tsig", "key", "first", "stop"]
#: What is known of a row: another document holds its key; the rows beyond the partition's end tell; the row is such an end.
SHARED, OPEN, EDGE = 0, 1, 2


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+"), ""), lambda w: F.lower(w))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


class _Digests:
    """Digests of any run of a document's words, from one prefix sum.

    The sum of word hash times base to the place, modulo 2 ** 64, of a run is
    a difference of prefix sums; the inverse power moves it to place 0.
    """

    _base = np.uint64(0x9E3779B97F4A7C15)
    _inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    _up = _down = np.ones(1, np.uint64)

    def __init__(self, h: np.ndarray):
        if len(self._up) <= len(h):
            size = 2 * len(h) + 1
            for name, base in (("_up", self._base), ("_down", self._inverse)):
                setattr(_Digests, name, np.cumprod(np.append(np.uint64(1), np.full(size, base)), dtype=np.uint64))
        self.n = len(h)
        self.sums = np.append(np.uint64(0), np.cumsum(h * self._up[: len(h)], dtype=np.uint64))

    def at(self, places: np.ndarray, words: int) -> np.ndarray:
        """Digests of the words from each place on; past the end they are shorter."""
        lo, hi = np.minimum(places, self.n), np.minimum(places + words, self.n)
        return _mixed((self.sums[hi] - self.sums[lo]) * self._down[lo] + (hi - lo).astype(np.uint64))


def sample_places(digests: _Digests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose k-mer is the least (the first of equal ones) of a window's first words, and the windows (first, stop) of each."""
    n = digests.n - KMER + 1
    if digests.n < MIN_WORDS:
        return (np.empty(0, np.int64),) * 3
    grams = digests.at(np.arange(n), KMER)
    width = WINDOW - KMER + 1
    # The least of every window by doubling, as the rank of the k-mer at its place.
    rank = np.empty(n, np.int64)
    rank[np.argsort(grams, kind="stable")] = np.arange(n)
    least, span = rank, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: n - width + 1], least[width - span: n - span + 1])
    place = np.empty(n, np.int64)
    place[rank] = np.arange(n)
    chosen = place[least[: digests.n - MIN_WORDS + 1]]
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    return chosen[first], first, np.append(first[1:], len(chosen))


def _samples(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
            row, key, first, stop = [], [], [], []
            with np.errstate(over="ignore"):
                for r, (a, b) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist())):
                    digests = _Digests(flat[a:b])
                    at, lo, hi = sample_places(digests)
                    if not len(at):
                        continue
                    row.append(np.full(len(at), r))
                    key.append(digests.at(at, KEY_WORDS).view(np.int64))
                    first.append(lo.astype(np.int32))
                    stop.append(hi.astype(np.int32))
            if row:
                rows = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows)]
                    + [pa.array(np.concatenate(x)) for x in (key, first, stop)],
                    names=_NAMES,
                )

    hashed = _rows(docs).select("doc_id", "tsig", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    return materialise(hashed.mapInArrow(run, _ROWS), "suffix-samples")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tsig"), words(F.col("text")).alias("words")
    )


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition, sorted by key and document, whose key two documents hold or may hold, with ``state``."""

    def out(table: pa.Table, state: int) -> Iterator[pa.RecordBatch]:
        for batch in table.combine_chunks().to_batches():
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, state, np.int32))], names=[*_NAMES, "state"]
            )

    # Of the last key so far: its first row, its rows as long as they are of one document, whether there are more documents.
    lead, held, several, begun, last = None, None, False, False, None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        goes_on = lead is not None and lead["key"][0].as_py() == table["key"][0].as_py()
        if lead is not None and not goes_on:
            # The key of the batch before has ended with it.
            if not begun:
                yield from out(pa.concat_tables([lead, last]), EDGE)
                if held is not None:
                    yield from out(held, OPEN)
                begun = True
            lead, held, several = None, None, False
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        key, sig = table["key"].to_numpy(), table["tsig"].to_numpy()
        ids = table["doc_id"].combine_chunks()
        known, none = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), pc.is_null(ids).to_numpy(zero_copy_only=False)
        same = key[1:] == key[:-1]
        other = same & ((sig[1:] != sig[:-1]) | (known[1:] != known[:-1]) | (none[1:] != none[:-1]))
        starts = np.flatnonzero(np.append(True, ~same))
        ends = np.append(starts[1:], table.num_rows)
        more = np.logical_or.reduceat(np.append(False, other), starts)
        more[0] |= several
        yield from out(table.filter(pa.array(np.repeat(more, ends - starts))), SHARED)
        if lead is None:
            lead = table.slice(0, 1)
        if len(starts) > 1:
            if not begun:
                yield from out(pa.concat_tables([lead, table.slice(int(ends[0]) - 1, 1)]), EDGE)
                if not more[0]:
                    yield from out(table.slice(0, int(ends[0])), OPEN)
                begun = True
            lead = table.slice(int(starts[-1]), 1)
        several = bool(more[-1])
        held = None if several else table.slice(int(starts[-1]))
        last = table.slice(table.num_rows - 1, 1)
    if lead is not None:
        yield from out(pa.concat_tables([lead, last]), EDGE)
        if held is not None:
            yield from out(held, OPEN)


def _held_by_two(rows: DataFrame, name: str) -> DataFrame:
    """The rows whose key rows of another document hold too: doc_id, tsig, first, stop."""
    order = ["key", "tsig", "doc_id", "first"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = ordered.mapInArrow(_marked, f"{_ROWS}, state int")
    # A key that is decided is not needed any more.
    marked = materialise(marked.withColumn("key", F.when(F.col("state") != SHARED, F.col("key"))), name)
    # At most four rows of each partition.
    document = F.struct("tsig", "doc_id")
    across = marked.where(F.col("state") == EDGE).groupBy("key").agg(F.min(document).alias("least"), F.max(document).alias("most"))
    across = across.where("not (least <=> most)").select("key")
    undecided = marked.where(F.col("state") == OPEN).join(across, "key", "left_semi")
    columns = ["doc_id", "tsig", "first", "stop"]
    return marked.where(F.col("state") == SHARED).select(columns).unionByName(undecided.select(columns))


def _windows(docs: DataFrame) -> DataFrame:
    """Every window (first to stop - 1) whose suffix's key another document holds too, with its digest as the key."""
    shared = _held_by_two(_samples(docs), "suffix-shared")
    wanted = shared.groupBy(F.col("doc_id").alias("__id"), F.col("tsig").alias("__sig")).agg(
        F.collect_set(F.struct("first", "stop")).alias("runs")
    )
    # Words cross the network as numbers.
    rows = _rows(docs).select("doc_id", "tsig", F.transform("words", lambda w: F.hash(w)).alias("w"))
    same = (rows["tsig"] == wanted["__sig"]) & rows["doc_id"].eqNullSafe(wanted["__id"])
    texts = rows.join(wanted, same).select("doc_id", "tsig", "w", "runs.first", "runs.stop")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, digest, held = [], [], [], 0

            def out() -> pa.RecordBatch:
                rows = pa.array(np.concatenate(row))
                columns = [batch.column(0).take(rows), batch.column(1).take(rows)]
                at = np.concatenate(start).astype(np.int32)
                columns += [pa.array(np.concatenate(digest).view(np.int64)), pa.array(at), pa.array(at + np.int32(1))]
                return pa.RecordBatch.from_arrays(columns, names=_NAMES)

            for r in range(batch.num_rows):
                w, first, stop = (batch.column(k)[r].values.to_numpy() for k in (2, 3, 4))
                at = np.concatenate([np.arange(a, b) for a, b in zip(first.tolist(), stop.tolist())])
                with np.errstate(over="ignore"):
                    digest.append(_Digests(_mixed(w.astype(np.int64).view(np.uint64) + _MIX)).at(at, MIN_WORDS))
                row.append(np.full(len(at), r))
                start.append(at)
                held += len(at)
                if held >= MAX_HELD:
                    yield out()
                    row, start, digest, held = [], [], [], 0
            if row:
                yield out()

    return materialise(texts.mapInArrow(run, _ROWS), "suffix-windows")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, tsig, ``spans`` (sorted array of start, end in words): words in passages that other documents hold too.

    One row per document that has such a passage.
    """
    found = _held_by_two(_windows(docs), "suffix-found")
    starts = found.groupBy("doc_id", "tsig").agg(F.array_sort(F.collect_set("first")).alias("starts"))
    # Windows that follow each other are one span.
    ahead = F.filter("starts", lambda s, k: (k == 0) | (F.get("starts", k - 1) + MIN_WORDS < s))
    last = F.filter("starts", lambda s, k: (k == F.size("starts") - 1) | (s + MIN_WORDS < F.get("starts", k + 1)))
    spans = F.zip_with("heads", "tails", lambda a, b: F.struct(a.alias("start"), (b + MIN_WORDS).alias("end")))
    return starts.select("doc_id", "tsig", ahead.alias("heads"), last.alias("tails")).select("doc_id", "tsig", spans.alias("spans"))


def report(spans: DataFrame) -> DataFrame:
    """doc_id, number of repeated passages, their words, and the spans as text."""
    total = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return spans.select(
        "doc_id", F.size("spans").cast("long").alias("passages"), total.cast("long").alias("repeated_words"), text.alias("spans")
    )
