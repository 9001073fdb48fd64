"""Shared helpers: scratch tables and constants of the operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a shingle and the least similarity of a near copy.
SHINGLE_WORDS = 5
NEAR = 0.8
#: Bits of one bitmap of Spark's bitmap functions, and how many bits ``probably_in`` gives each id.
BITMAP_BITS, BITS_PER_ID = 32_768, 32
#: Bitmaps that are broadcast at most (64 MB); beyond that more rows pass by chance.
MOST_BITMAPS = 16_384


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a local one only if unset (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with signs added to it if a column of ``df`` is called so (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one intermediate table in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """At the end of a task: hands what it has freed back to the system, as its Python worker stays for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def probably_in(df: DataFrame, id_: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose id (a 64-bit hash) is in ``wanted``, a stored table of its name, and a few others.

    One bit per id in broadcast bitmaps decides, so rows are left out before
    a shuffle; an exact semi-join has to follow.
    """
    n_bitmaps = min(MOST_BITMAPS, 1 + wanted.count() * BITS_PER_ID // BITMAP_BITS)
    place = F.pmod(F.col(id_), F.lit(n_bitmaps * BITMAP_BITS))
    bitmap, bits, at = (free_name(df, name) for name in ("__bitmap", "__bits", "__at"))
    of, bit = (place / BITMAP_BITS).cast("int"), (place % BITMAP_BITS).cast("long")
    bitmaps = wanted.select(of.alias(bitmap), bit.alias(at)).groupBy(bitmap).agg(F.bitmap_construct_agg(at).alias(bits))
    byte = F.conv(F.hex(F.substring(bits, 1 + F.floor(bit / 8).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = df.join(F.broadcast(bitmaps), of == bitmaps[bitmap])
    return marked.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*(df[c] for c in df.columns))
