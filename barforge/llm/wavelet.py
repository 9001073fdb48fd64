"""Token ids on disk as wavelet matrices, one per shard.

Documents are ordered by ``doc_id`` with a range partitioning, tokenized once
and gathered into shards of about ``SHARD_TOKENS`` ids.  A shard is one row of
a compressed Parquet file: one packed bit-plane per bit of an id, the zeros
per plane, a rank directory, and the documents with their lengths.  Random
access, counting, and occurrence lookup work on the planes alone
(``WaveletMatrix``); ``read_documents`` decodes whole shards.

Defined cases: a null text counts as empty (its end id only); rows with a
null ``doc_id`` come first; equal ``doc_id`` are ordered by the text's hash;
an empty table gives no shard.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.llm.common import scratch_path
from barforge.llm.word_cache import encoder

SHARD_TOKENS = 1 << 20
END_ID = 0
BLOCK = 512  # bits per entry of the rank directory

SHARDS = (
    "part int, shard int, n long, doc_ids array<long>, lengths array<long>, "
    "zeros array<long>, planes array<binary>, ranks array<binary>"
)


class WaveletMatrix:
    """Bit-planes of a sequence of ids, the highest bit first.

    In every plane the ids stand as sorted (stably) by the bits above; those
    with bit 0 go on to the front of the next plane, those with bit 1 after
    them.
    """

    def __init__(self, n: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.zeros = n, zeros
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, np.uint32) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        row = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for b in range(bits - 1, -1, -1):
            bit = (row >> b) & 1 != 0
            plane = np.packbits(bit)
            planes.append(plane.tobytes())
            ones = np.bitwise_count(plane)
            ones = np.pad(ones, (0, -len(ones) % (BLOCK // 8))).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
            ranks.append((np.cumsum(ones, dtype=np.uint32) - ones).tobytes())
            front, back = np.compress(~bit, row), np.compress(bit, row)
            zeros.append(len(front))
            row = np.concatenate([front, back])
        return cls(len(ids), zeros, planes, ranks)

    def _bit(self, k: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[k][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones of plane ``k`` before each place (0 to n)."""
        at = np.asarray(at, np.int64)
        block = np.minimum(at // BLOCK, len(self.ranks[k]) - 1)
        out = self.ranks[k][block].astype(np.int64)
        for j, (a, b) in enumerate(zip(block.tolist(), at.tolist())):
            out[j] += int(np.unpackbits(self.planes[k][a * BLOCK // 8: b // 8 + 1])[: b - a * BLOCK].sum())
        return out

    def access(self, places) -> np.ndarray:
        """The ids at these places."""
        at = np.asarray(places, np.int64)
        out = np.zeros(len(at), np.int64)
        for k, z in enumerate(self.zeros):
            bit, one = self._bit(k, at).astype(bool), self._ones(k, at)
            out = out << 1 | bit
            at = np.where(bit, z + one, at - one)
        return out

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        a, b = 0, end
        for k, z in enumerate(self.zeros):
            one = self._ones(k, np.array([a, b]))
            if symbol >> (len(self.zeros) - 1 - k) & 1:
                a, b = z + int(one[0]), z + int(one[1])
            else:
                a, b = a - int(one[0]), b - int(one[1])
        return a, b

    def rank(self, symbol: int, end: int) -> int:
        """How often the id occurs before place ``end``."""
        if self.n == 0 or symbol >> len(self.zeros):
            return 0
        a, b = self._range(symbol, end)
        return b - a

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """The place of the id's occurrence number ``k`` (from 0); -1 if it has fewer."""
        if k < 0 or k >= self.count(symbol):
            return -1
        at = self._range(symbol, self.n)[0] + k
        for level in range(len(self.zeros) - 1, -1, -1):
            z = self.zeros[level]
            want = symbol >> (len(self.zeros) - 1 - level) & 1
            at = self._find(level, at - z if want else at, want)
        return at

    def _find(self, level: int, k: int, want: int) -> int:
        """The place of bit number ``k`` of this value in a plane, by its rank directory."""
        before = self.ranks[level].astype(np.int64)
        if not want:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, "right")) - 1
        last = min(self.n, (block + 1) * BLOCK)
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8: (last + 7) // 8])[: last - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == want)[k - before[block]])

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane upwards."""
        bits = len(self.zeros)
        row = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for k in range(bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n).view(bool)
            up = np.empty_like(row)
            # By places, not by masks: a mask costs four times as much.
            up[np.flatnonzero(~bit)] = row[: self.zeros[k]]
            up[np.flatnonzero(bit)] = row[self.zeros[k]:] | row.dtype.type(1 << (bits - 1 - k))
            row = up
        return row


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Write all documents' ids, in ascending ``doc_id`` order, as shard files."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        bits = max(1, (enc.tokenizer.get_vocab_size(True) - 1).bit_length())
        end = np.array([end_id], np.uint32)
        names, found, size = [], [], 0

        def row() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(found), bits)
            one = {
                "part": part, "shard": shard, "n": matrix.n, "doc_ids": names, "lengths": [len(x) for x in found],
                "zeros": matrix.zeros, "planes": [p.tobytes() for p in matrix.planes],
                "ranks": [r.tobytes() for r in matrix.ranks],
            }
            return pa.RecordBatch.from_pylist([one], schema=_ARROW)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, some in zip(ids, enc.encode([t or "" for t in texts])):
                names.append(doc_id)
                found.append(np.concatenate([some, end]))
                size += len(some) + 1
                if size >= SHARD_TOKENS:
                    yield row()
                    names, found, size, shard = [], [], 0, shard + 1
        if found:
            yield row()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    tie = F.xxhash64("text")
    ordered = texts.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    ordered.mapInArrow(shards, SHARDS).write.option("compression", "zstd").parquet(path)


_ARROW = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("n", pa.int64())]
    + [(k, pa.list_(pa.int64())) for k in ("doc_ids", "lengths", "zeros")]
    + [(k, pa.list_(pa.binary())) for k in ("planes", "ranks")]
)
_DOCS = "part int, shard int, doc_id long, place long, n_tokens long, ids_crc32 long"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the shard files: start, n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1).to_pylist()[0]
                matrix = WaveletMatrix(one["n"], one["zeros"], one["planes"], one["ranks"])
                ids = matrix.decode().astype("<u4")
                n = np.array(one["lengths"], np.int64)
                ends = np.cumsum(n)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), one["part"], np.int32)),
                        pa.array(np.full(len(n), one["shard"], np.int32)),
                        pa.array(one["doc_ids"], pa.int64()), pa.array(ends - n), pa.array(n),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "shard", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.parquet(path)
    # Prefix sums over shard totals: inside a partition, then over partitions (one row each).
    sizes = shards.select("part", "shard", "n")
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("total"))
    parts = parts.select("part", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("before"))
    bases = sizes.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part")
    bases = bases.select("part", "shard", (F.col("before") + F.col("inner")).alias("base"))
    found = shards.mapInArrow(decode, _DOCS).join(bases, ["part", "shard"])
    return found.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the shard files (to ``path``, or to the shared scratch folder) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "wavelet")
    write_shards(docs, tokenizer, path)
    return read_documents(spark, path)
