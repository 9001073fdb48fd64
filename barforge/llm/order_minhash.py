"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document's words (lower case, letters and digits) give occurrence-labelled
k-mers of five words.  Each of ``FUNCTIONS`` hash functions samples the
``PICKS`` k-mers with the least hashes and keeps them in text order; equal
samples are candidates.  Such sketches depend on the order of the k-mers as
well as on their number, so they follow edit similarity.  Documents of at most
``SHORT`` k-mers are sampled with fewer picks; documents near that length are
sampled both ways.

Equal word sequences form one class before anything else.  For the links of
a class every pair of classes that share a sample is aligned once; copies are
not expanded.  Where only classes and groups are asked for (``drop_near`` and
the registered query), a bucket of equal samples is not expanded into its pairs either: its members are aligned
with one leader.  While a bucket holds more than one connected component, members
outside its least component lead in turn and are aligned with the members of
the other components, so no connection inside a bucket is lost; a bucket that
has become one component is not read again.  From the second round on a member
meets a leader only if bitmaps of their words differ in at most two bits for
each edit allowed (an edit takes one word out and puts one in), less the
difference of their lengths, which no near pair fails.  Before a pair is aligned, its
common pairs of neighbouring words are counted: an edit touches two of them at
most, so a pair that lacks more is not near.  Two classes
are linked if their word-level edit distance is at most (1 - NEAR) of the longer;
groups are the connected components.

Defined cases: documents without a word (null and empty texts too) are never
near anything; equal rows are one document of one class; a null ``doc_id`` is
kept in the result, and the id of a class or group is the least that is not
null; very long texts are read whole; tables may be empty; other columns are not read, or are kept as they are
by ``drop_near``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.align import edit_distance
from barforge.llm.common import NEAR, SHINGLE_WORDS, free_name, materialise, release_memory
from barforge.llm.components import connected_components

FUNCTIONS = 48
PICKS, SHORT_PICKS = 6, 2
#: Lengths in k-mers: up to SHORT few picks are taken, from LONG on many.
#: SHORT * NEAR is at least LONG, so that near copies always share a way.
SHORT, LONG = 40, 32
#: Leaders a bucket names in the first round, and by how much more in each further one.
FIRST_LEADERS, MORE_LEADERS = 1, 4
#: Leaders of a round at most, so that Spark cuts a bucket to them before the shuffle.
MOST_LEADERS = 512
#: Bits of a word bitmap for each word, at least.
WORD_BITS = 8
_ODD = np.random.default_rng(20240501).integers(1, 2**63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words(text: Column) -> Column:
    """Lower-case words; empty for a text without letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def signature(word_list: Column) -> Column:
    """Digest of a word sequence; null if it is empty."""
    return F.when(F.size(word_list) > 0, F.md5(F.array_join(word_list, " ")))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


def labelled_kmers(hashes: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """One hash per k-mer of words, different for each of its occurrences."""
    k = min(k, len(hashes))
    h = hashes.astype(np.int64).view(np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = _mixed(out + h[j: len(h) - k + 1 + j])
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    if not new.all():
        place = np.arange(len(out))
        nth = place - np.maximum.accumulate(np.where(new, place, 0))
        out[order] = ranked + nth.astype(np.uint64) * _MIX
    return _mixed(out)


def _samples(kmers: np.ndarray, picks: int) -> np.ndarray:
    """A key per hash function: the sampled k-mers in text order."""
    picks = min(picks, len(kmers))
    out = np.empty(FUNCTIONS, np.uint64)
    step = max(1, 2_000_000 // len(kmers))  # long documents: few functions at a time
    for lo in range(0, FUNCTIONS, step):
        ranks = kmers[None, :] * _ODD[lo: lo + step, None]
        at = np.argpartition(ranks, picks - 1, axis=1)[:, :picks] if picks < len(kmers) else np.tile(
            np.arange(picks), (len(ranks), 1))
        at.sort(axis=1)
        key = np.arange(lo, lo + len(ranks), dtype=np.uint64) * np.uint64(64) + np.uint64(picks)
        for j in range(picks):
            key = _mixed(key + kmers[at[:, j]])
        out[lo: lo + step] = key
    return out


def sketch(hashes: np.ndarray) -> np.ndarray:
    """All keys of a document's word hashes."""
    with np.errstate(over="ignore"):
        if not len(hashes):
            return np.empty(0, np.int64)
        kmers = labelled_kmers(hashes)
        keys = []
        if len(kmers) <= SHORT:
            keys.append(_samples(kmers, SHORT_PICKS))
        if len(kmers) >= LONG:
            keys.append(_samples(kmers, PICKS))
        return np.unique(np.concatenate(keys)).view(np.int64)


def _sketched(docs: DataFrame) -> DataFrame:
    """doc_id, sig (null without words), node (a number from sig), keys and words of every row (written)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
            starts = np.append(0, ends[:-1])
            keys = [sketch(flat[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            sizes = np.append(0, np.cumsum([len(x) for x in keys])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([*keys, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, pa.array((ends - starts).astype(np.int32))], names=["doc_id", "sig", "keys", "n"])
        release_memory()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))
    hashed = rows.select("doc_id", signature(F.col("words")).alias("sig"), F.transform("words", lambda w: F.xxhash64(w)).alias("words"))
    out = hashed.mapInArrow(run, "doc_id long, sig string, keys array<long>, n int")
    return materialise(out.withColumn("node", F.conv(F.substring("sig", 1, 15), 16, 10).cast("long")), "sketches")


def _may_be_near(x: np.ndarray, y: np.ndarray, most: int) -> bool:
    """False if two word sequences are more than ``most`` edits apart by the q-gram lemma: an edit touches two pairs of neighbours."""

    def neighbours(w: np.ndarray) -> np.ndarray:
        w = w.astype(np.int64)
        return np.unique((w[:-1] << 32) ^ (w[1:] & 0xFFFFFFFF))

    a, b = neighbours(x), neighbours(y)
    common = len(np.intersect1d(a, b, assume_unique=True))
    return max(len(a), len(b)) - common <= 2 * most


def _aligned(pairs: DataFrame, texts: DataFrame, near: float) -> DataFrame:
    """The pairs (a, b) whose word sequences are near, with their distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, far = [], []
            for k in range(batch.num_rows):  # one pair at a time as Python numbers
                x, y = (batch.column(c)[k].values.to_numpy() for c in (4, 5))
                most = int((1 - near) * max(len(x), len(y)) + 1e-9)
                d = edit_distance(x.tolist(), y.tolist(), most) if _may_be_near(x, y, most) else None
                if d is not None:
                    ok.append(k)
                    far.append(d)
            rows = pa.array(ok, pa.int64())
            columns = [batch.column(k).take(rows) for k in range(4)] + [pa.array(far, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "sig_a", "sig_b", "distance"])
        release_memory()

    side = {k: texts.select(F.col("node").alias(k), F.col("sig").alias(f"sig_{k}"), F.col("words").alias(f"w{k}")) for k in "ab"}
    both = pairs.join(side["a"], "a").join(side["b"], "b")
    near_length = F.least(F.size("wa"), F.size("wb")) >= F.greatest(F.size("wa"), F.size("wb")) * near
    # Every distinct word that the other side lacks costs an edit: far pairs end here.
    most = F.floor(F.greatest(F.size("wa"), F.size("wb")) * (1 - near) + 1e-9)
    near_words = (F.size(F.array_except("wa", "wb")) <= most) & (F.size(F.array_except("wb", "wa")) <= most)
    out = both.where(near_length).where(near_words).select("a", "b", "sig_a", "sig_b", "wa", "wb").mapInArrow(
        run, "a long, b long, sig_a string, sig_b string, distance int"
    )
    return materialise(out, "alignments")


def _candidates(members: DataFrame, near: float) -> DataFrame:
    """Every pair (a, b) of classes that share a sample and whose lengths can be near, once."""
    other = members.select(F.col("key").alias("at"), F.col("node").alias("b"), F.col("n").alias("m"))
    near_length = F.least("n", "m") >= F.greatest("n", "m") * near
    met = members.join(other, (F.col("key") == F.col("at")) & (F.col("node") < F.col("b")) & near_length)
    return materialise(met.select(F.col("node").alias("a"), "b").distinct(), "pairs")


def word_bits(hashes: np.ndarray) -> np.ndarray:
    """A bitmap (64-bit words, their number a power of two) of a text's words, the parity of those that fall on one bit.

    An edit changes at most two bits of it, and so of its folded halves.
    """
    longs = 1 << max(0, (max(1, len(hashes)) * WORD_BITS - 1) // 64).bit_length()
    with np.errstate(over="ignore"):
        labelled = labelled_kmers(hashes, 1) if len(hashes) else np.empty(0, np.uint64)
    at = (labelled >> np.uint64(32)).astype(np.int64) & (64 * longs - 1)
    odd = (np.bincount(at, minlength=64 * longs) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _word_bitmaps(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, its word bitmap (``bits``) and that folded to half its size (``folded``; written)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [word_bits(words.values.to_numpy()) for words in batch.column(1)]
            half = [x[: len(x) // 2] ^ x[len(x) // 2:] if len(x) > 1 else x for x in whole]
            lists = (pa.array(x, pa.list_(pa.int64())) for x in (whole, half))
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["node", "bits", "folded"])

    wanted = texts.join(nodes, "node", "left_semi").select("node", "words")
    return materialise(wanted.mapInArrow(run, "node long, bits array<long>, folded array<long>"), "word-bits")


def _bits_near(near: float) -> Column:
    """Whether the bitmaps (bits, folded) and (bits2, folded2) of texts of n and m words allow a near pair."""

    def apart(x: str, y: str) -> Column:
        counts = F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        return F.aggregate(counts, F.lit(0), lambda total, one: total + one)

    # Two bits an edit, but one where it makes the lengths differ.
    most = 2 * F.floor(F.greatest("n", "m") * (1 - near) + 1e-9) - F.abs(F.col("n") - F.col("m"))
    size, size2 = F.size("bits"), F.size("bits2")
    return (
        F.when(size == size2, apart("bits", "bits2")).when(size == 2 * size2, apart("folded", "bits2"))
        .when(size2 == 2 * size, apart("bits", "folded2")).otherwise(0) <= most
    )


def _mixed_buckets(members: DataFrame, of: str) -> DataFrame:
    """The members of buckets in which ``of`` has more than one value, and its least (``base``)."""
    bucket = Window.partitionBy("key")
    bounded = members.withColumn("base", F.min(of).over(bucket)).withColumn("top", F.max(of).over(bucket))
    return bounded.where("base <> top").drop("top")


def near_links(docs: DataFrame, sketches: DataFrame, near: float = NEAR, whole: bool = True) -> DataFrame:
    """Verified links (sig_a, sig_b, distance) between classes of equal word sequences.

    All links of the candidates, or (``whole`` False) enough of them to connect the groups.
    """
    nodes = sketches.where("sig is not null").groupBy("sig").agg(F.first("node").alias("node"), F.min("doc_id").alias("doc_id"))
    keyed = sketches.where("sig is not null").select("node", "n", F.explode("keys").alias("key")).distinct()
    # Members of the buckets that hold more than one class.
    members = materialise(_mixed_buckets(keyed, "node").select("key", "node", "n"), "members")
    wanted = members.select("node").distinct().join(nodes, "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))
    # Words cross the network as numbers.
    texts = texts.select(
        "doc_id", signature(F.col("words")).alias("sig"), F.transform("words", lambda w: F.hash(w)).alias("words")
    ).where("sig is not null")
    same = (texts["sig"] == wanted["sig"]) & texts["doc_id"].eqNullSafe(wanted["doc_id"])
    texts = texts.join(wanted, same).select(wanted["node"], wanted["sig"], "words").dropDuplicates(["node", "sig"])
    texts = materialise(texts, "class-words")

    if whole:
        found = _aligned(_candidates(members, near), texts, near)
        return found.select("sig_a", "sig_b", "distance").distinct()

    links, done, count, bitmaps = None, None, FIRST_LEADERS, None
    # At first every member is a component of its own, and all these buckets are mixed.
    mixed = members.select("key", "node", "n", F.col("node").alias("part"), F.lit(False).alias("led"))
    while True:
        # There, members outside the least component that have not led the bucket yet may lead it.
        free = mixed.where("part <> base and not led") if links is not None else mixed
        first = Window.partitionBy("key").orderBy("node")
        # Cut to the leaders before the shuffle (window group limit), also in a very large bucket.
        leaders = free.withColumn("k", F.row_number().over(first)).where(F.col("k") <= count).select("key", "node", "part", "n")
        leaders = materialise(leaders, "leaders")
        if leaders.isEmpty():
            break
        other = leaders.select(F.col("key").alias("at"), F.col("node").alias("leader"), F.col("part").alias("leads"), F.col("n").alias("m"))
        # Texts whose lengths are too far apart never meet.
        may_meet = (F.col("part") != F.col("leads")) & (F.least("n", "m") >= F.greatest("n", "m") * near)
        met = mixed
        if bitmaps is not None:  # what the first round has not connected is mostly not near
            met = mixed.join(bitmaps, "node")
            other = other.join(bitmaps.toDF("leader", "bits2", "folded2"), "leader")
            may_meet = may_meet & _bits_near(near)
        met = met.join(other, (F.col("key") == F.col("at")) & may_meet)
        pairs = met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        found = _aligned(pairs, texts, near)
        # Members that are connected by now need no further comparison: new links join components found before.
        joints = found.select("a", "b")
        if links is not None:
            for end in "ab":
                at = mixed.select(F.col("node").alias(end), F.col("part").alias("of")).distinct()
                joints = joints.join(at, end).drop(end).withColumnRenamed("of", end)
        parts = connected_components(joints).toDF("part", "component")
        links = found if links is None else links.unionByName(found)
        done = pairs if done is None else done.unionByName(pairs)
        marks = leaders.select("key", "node", "n", "part", F.lit(True).alias("led"))
        rows = mixed.select(marks.columns).unionByName(marks).groupBy("key", "node", "n", "part").agg(F.max("led").alias("led"))
        placed = rows.join(parts, "part", "left").select("key", "node", "n", F.coalesce("component", "part").alias("part"), "led")
        # Buckets with more than one component; a bucket that has become one stays one and is not read again.
        mixed = materialise(_mixed_buckets(placed, "part"), "mixed")
        bitmaps = _word_bitmaps(texts, mixed.select("node").distinct()) if bitmaps is None else bitmaps
        count = min(count * MORE_LEADERS, MOST_LEADERS)
    if links is None:
        return docs.sparkSession.createDataFrame([], "sig_a string, sig_b string, distance int")
    return links.select("sig_a", "sig_b", "distance").distinct()


def near_groups(docs: DataFrame, near: float = NEAR, whole: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, group_id, links of its class, and ``sig``.

    ``links`` counts the other classes that the class is near to, if ``whole``;
    else only links that connect the group.  ``class_id`` and ``group_id`` are the least ``doc_id`` with the same words
    and in the same connected component; without words the row's own.
    """
    sketches = _sketched(docs)
    links = materialise(near_links(docs, sketches, near, whole), "near-links")
    parts = connected_components(links.select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b")))
    ends = links.select(F.col("sig_a").alias("sig")).unionAll(links.select(F.col("sig_b").alias("sig")))
    degree = ends.groupBy("sig").agg(F.count(F.lit(1)).alias("links"))
    classes = sketches.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("class_id"))
    classes = classes.join(parts.withColumnRenamed("node", "sig"), "sig", "left").join(degree, "sig", "left")
    classes = classes.select(
        "sig", "class_id", F.coalesce("component", "sig").alias("component"), F.coalesce("links", F.lit(0)).alias("links")
    )
    groups = classes.groupBy("component").agg(F.min("class_id").alias("group_id"))
    classes = classes.join(groups, "component").select("sig", "class_id", "group_id", "links", "component")
    rows = sketches.select("doc_id", "sig").join(classes, "sig", "left")
    return rows.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"), "sig", "component",
    )


def drop_near(docs: DataFrame, near: float = NEAR) -> DataFrame:
    """One document of each group, with all its columns: that of the least ``doc_id`` (then digest).

    Of rows that share that id and the words, the one with the least hash of
    its text (then of its other columns) stays.  Documents without a word all
    stay.
    """
    groups = near_groups(docs, near, whole=False).where("sig is not null")
    # The least (doc_id, digest) of a group: null ids count as the largest.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("sig").alias("digest"))
    kept = groups.groupBy("component").agg(F.min(order).alias("least"))
    of, id_, sig, place = (free_name(docs, name) for name in ("__of", "__id", "__sig", "__place"))
    kept = kept.select(F.col("least.id").alias(id_), F.col("least.digest").alias(sig))
    has_word = F.coalesce(F.col("text").rlike(r"[\p{L}\p{N}]"), F.lit(False))
    marked = docs.where(has_word).withColumn(of, signature(words(F.col("text"))))
    same = (F.col(of) == F.col(sig)) & F.col("doc_id").eqNullSafe(F.col(id_))
    hashed = [F.col(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    first = Window.partitionBy("doc_id", of).orderBy(F.xxhash64("text"), F.xxhash64(*hashed))
    chosen = marked.join(kept, same, "left_semi").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    return chosen.drop(of, place).unionByName(docs.where(~has_word))
