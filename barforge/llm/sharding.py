"""Shards of near equal bytes by sampled splitters, in DataFrame functions only.

Records are ordered by a hash of the text, then ``doc_id``, so equal texts
stand together.  Keys are drawn with a chance in proportion to a record's size
(half of it to the record itself, so that very many small records count too);
the quantiles of the draws are the splitters.  A key that is several splitters
at once (a large group of equal texts) is a range of its own, the keys between
two splitters are another.  Totals of every range then say which hold more
than twice their share: those are subdivided, a single key by ``doc_id`` and a
random number, other ranges by another hash of the key, so that smaller groups
of equal texts stay whole.  Running sums over the ranges and inside each range
(sorted in its own task) place every record on one line of all bytes, and the
line is cut into equal shards.  A group of equal texts goes whole to the shard
that its middle falls in, unless it is over ``1 / WHOLE`` of a shard's share in
bytes or records; larger ones are spread, as the law asks.

The law is ``bytes``: a shard differs from an equal share by at most half such
a group, or half a record, at either end.  Slots count the records of a shard
from 0 in the order of the line.

Defined cases: a null text has no bytes and counts as equal to an empty one; a
null ``doc_id`` comes first among equal texts; rows equal in both are placed
one by one (which of them comes first may change from run to run); an empty
table gives no row; with fewer records than shards, or very long texts, some
shards stay empty.  Other columns are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barforge.llm.common import materialise, scratch_path

SHARDS = 24
#: Ranges that a shard's share is made of, at least.
FINE = 128
#: A group of equal texts up to this part of a shard stays whole.
WHOLE = 16
#: Bytes of a range, as long as there are no more than MOST_RANGES.
RANGE_BYTES = 16_000_000
#: Bounds of what is broadcast: ranges after the subdivision, and splitters.
MOST_RANGES, MOST_SPLITTERS = 200_000, 16_384
#: Draws for each splitter.
DRAWS = 8
#: Bytes that a record takes besides its text.
RECORD_BYTES = 8


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def free_name(taken: list[str], name: str) -> str:
    """The name, with signs added until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def draw_splitters(keyed: DataFrame, ranges: int, total_size: int, total_rows: int) -> list[tuple[int, bool]]:
    """Quantiles of a size-weighted sample of keys, ascending, each with whether it is several at once.

    A record has a weight of its share of all bytes plus its share of all
    records; its draws are the weight over the step, rounded up or down by its
    salt.  About ``ranges * DRAWS`` draws come together, whatever the table's
    size, so one task may order them and the driver hold the quantiles.
    """
    step = 2.0 / (ranges * DRAWS)
    weight = F.col("size") / total_size + F.lit(1.0 / total_rows)
    draws = F.floor(weight / step + F.col("salt")).cast("long")
    drawn = keyed.select("key", draws.alias("draws")).where("draws > 0").groupBy("key").agg(F.sum("draws").alias("draws"))
    upto = F.sum("draws").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    crossed = F.floor(upto / DRAWS) - F.floor((upto - F.col("draws")) / DRAWS)
    found = drawn.select("key", crossed.alias("crossed")).where("crossed > 0").orderBy("key").collect()
    return [(r.key, r.crossed > 1) for r in found]


def range_number(key: Column, splitters: list[tuple[int, bool]]) -> Column:
    """Twice the number of splitters below the key, and one more where the key is a large splitter."""
    if not splitters:
        return F.lit(0)

    def constant(values, kind: str) -> Column:
        return F.split(F.lit(",".join(values)), ",").cast(f"array<{kind}>")

    keys = constant((str(k) for k, _ in splitters), "bigint")
    large = constant((str(b).lower() for _, b in splitters), "boolean")
    bits = F.array(*(F.lit(1 << b) for b in reversed(range(len(splitters).bit_length()))))

    # Binary search for the number of splitters below the key, its highest bit first.
    def further(low: Column, bit: Column) -> Column:
        inside = (low + bit <= len(splitters)) & (F.get(keys, low + bit - 1) < key)
        return F.when(inside, low + bit).otherwise(low)

    below = F.aggregate(bits, F.lit(0), further)
    return F.transform(F.array(below), lambda k: k * 2 + F.when((F.get(keys, k) == key) & F.get(large, k), 1).otherwise(0))[0]


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write all records as Parquet, a folder per shard: the struct ``record`` and its ``position`` on the line.

    The keyed records are first written to the shared folder, so that every
    pass sees the same keys and salts, also after an executor is lost.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.struct("*").alias("record"), docs["doc_id"].alias("id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("key"),
        record_size(docs["text"]).alias("size"), F.rand(17).alias("salt"),
    )
    records = materialise(keyed, "shard-records")
    light = records.drop("record")
    rows, total = light.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    fine = max(shards * FINE, min(MOST_RANGES, total // RANGE_BYTES))
    splitters = draw_splitters(light, min(fine, MOST_SPLITTERS), total, rows) if rows else []

    numbered = light.select("*", range_number(F.col("key"), splitters).alias("range"))
    load = F.greatest(F.sum("size") / max(total, 1), F.count(F.lit(1)) / max(rows, 1)) * fine
    loads = numbered.groupBy("range").agg(load.alias("load")).where(F.col("load") > FINE / WHOLE)
    # At most 2 * fine / (FINE / WHOLE) ranges can be that full.
    overfull = F.broadcast(loads.select("range", F.ceil("load").cast("int").alias("parts")))

    def split(frame: DataFrame) -> DataFrame:
        spread = F.when(F.col("range") % 2 == 1, F.xxhash64("id", "salt")).otherwise(F.xxhash64("key"))
        met = frame.join(overfull, "range", "left")
        return met.withColumn("part", F.pmod(spread, F.coalesce("parts", F.lit(1))))

    totals = split(numbered).groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "range", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )

    # Neighbouring ranges meet in one task, which so writes few shards.
    dealt = split(records.withColumn("range", range_number(F.col("key"), splitters))).repartitionByRange("range", "part")
    line = Window.partitionBy("range", "part").orderBy("key", "id", "salt")
    group = Window.partitionBy("range", "part", "key")
    run = dealt.select(
        "*", F.coalesce(F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("run"),
        (F.row_number().over(line) - 1).alias("nth"),
    ).select("*", F.min("run").over(group).alias("first"), F.sum("size").over(group).alias("all"))
    run = run.join(F.broadcast(starts), ["range", "part"])
    spread = (F.col("range") % 2 == 1) & F.col("parts").isNotNull()
    middle = F.col("bytes_before") + F.when(spread, F.col("run") + F.col("size") / 2).otherwise(F.col("first") + F.col("all") / 2)
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / max(total, 1)).cast("int"))
    placed = run.select("record", (F.col("rows_before") + F.col("nth")).alias("position"), shard.alias("shard"))
    placed.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The records (columns of ``schema``) with ``shard`` and ``slot``, under names that the schema has free."""
    kept = StructType().add("record", schema).add("position", "long").add("shard", "integer")
    stored = spark.read.schema(kept).parquet(path)
    # One row per shard.
    firsts = F.broadcast(stored.groupBy("shard").agg(F.min("position").alias("first")))
    shard, slot = free_name(schema.names, "shard"), free_name(schema.names, "slot")
    return stored.join(firsts, "shard").select(
        *(F.col("record").getField(c).alias(c) for c in schema.names), F.col("shard").alias(shard),
        (F.col("position") - F.col("first")).alias(slot),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, path: str | None = None) -> DataFrame:
    """Write the shard files (to ``path``, or to the shared scratch folder) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    write_shards(docs, path, shards)
    return read_shards(spark, path, docs.schema)


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per stored record: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    stored = shard_documents(docs.select("doc_id", "text"), shards)
    return stored.select(
        "doc_id", record_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
