"""Packing of documents into training sequences: concatenate and cut.

Pass 1 tokenizes every text once, on its own partition, and writes the ids
with their place in that partition.  The partitions' token totals (one row
per partition) give every partition its global offset by a prefix sum.
Pass 2 cuts the virtual concatenation at every multiple of the window; each
document yields one boundary record (piece) per window it touches.  There is
no shuffle of texts or ids and only the last sequence is not full.

Defined cases: a null text counts as empty (its end id only); a null
``doc_id`` is kept; equal rows are packed as often as they occur; an empty
table gives no piece.  Only ``doc_id`` and ``text`` are read, so columns of
other names never clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import materialise, release_memory
from barforge.llm.word_cache import encoder

WINDOW = 4096
END_ID = 2
#: Documents encoded and handed on at a time: a worker holds the ids of so many.
_ENCODED, _ROWS = 4096, 512

_TOKENS = "part int, first long, doc_id long, ids binary, n long"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Ids of every document with its token offset inside its partition (written)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        for batch in (whole.slice(k, _ENCODED) for whole in batches for k in range(0, whole.num_rows, _ENCODED)):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            end = np.array([end_id], np.uint32)
            found = [np.concatenate([x, end]) for x in enc.encode([t or "" for t in texts])]
            n = np.fromiter(map(len, found), np.int64, len(found))
            starts = first + np.cumsum(n) - n
            first += int(n.sum())
            for k in range(0, len(found), _ROWS):
                some = found[k: k + _ROWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), part, np.int32)),
                        pa.array(starts[k: k + _ROWS]),
                        ids.slice(k, len(some)),
                        pa.array([x.tobytes() for x in some], pa.binary()),
                        pa.array(n[k: k + _ROWS]),
                    ],
                    names=["part", "first", "doc_id", "ids", "n"],
                )
        release_memory()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return materialise(source.mapInArrow(encode, _TOKENS), "packing-tokens")


def with_offsets(tokens: DataFrame) -> DataFrame:
    """Adds ``at``, the document's offset in the concatenation of all documents."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    # One row per partition of the input: a prefix sum over those few rows.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # One row of 16 bytes per input partition, whatever the partitions hold.
    return tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("first"))


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """One row per piece (see ``PIECES``), with the ids as uint32 bytes if ``keep_ids``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[] for _ in range(8)]
            columns = (batch.column(k).to_pylist() for k in range(3))
            for doc_id, raw, at in zip(*columns):
                n, start = len(raw) // 4, 0
                while start < n:
                    sequence, offset = divmod(at + start, window)
                    length = min(n - start, window - offset)
                    piece = raw[4 * start: 4 * (start + length)]
                    values = (doc_id, start, length, zlib.crc32(piece), n, sequence, offset, piece)
                    for column, value in zip(rows, values):
                        column.append(value)
                    start += length
            arrays = [pa.array(x, pa.int64()) for x in rows[:7]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                arrays, names = [*arrays, pa.array(rows[7], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    placed = with_offsets(tokenized(docs, tokenizer, end_id))
    return placed.select("doc_id", "ids", "at").mapInArrow(cut, PIECES + (", ids binary" if keep_ids else ""))
