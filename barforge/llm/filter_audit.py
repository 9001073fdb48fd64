"""Filter interaction audit: what each filter of a chain removes, in every order.

Text features come from one pass of a table-driven byte transducer.  ``CLASS``
maps a byte to its class; the state before a byte (between words, inside one)
follows from the class of the byte before it, so a whole block of documents
runs as table look-ups: ``OUT[state, class]`` says what the byte does (begins a
code point, is a capital, is a symbol, opens a word, closes one).  The spans of
words go into an open-addressing hash table; a span counts as seen only if its
bytes equal those of the entry it meets (a verified table).

``failures`` turns the features into a bit per filter, ``audit`` counts the
documents by part and set of failed filters, which is all that any order of
the filters depends on: the 120 orders of five filters are played on those few
rows, not on documents.

Defined cases: a null text counts as empty (no word: it fails A and no other
filter but E); a null ``doc_id`` stands after all others, so its text repeats
that of any other id, and rows with equal ids do not repeat each other; a null
``lang`` is the part ''; ids that ``labels`` holds more than once are good or
toxic if any of their rows says so, ids it lacks are neither; an empty table
gives no part and no row.  Very long texts are cut at blanks into pieces of
``BLOCK`` bytes, whose words meet in one table (a single word of any length is
never cut).  Only ``doc_id``, ``text`` and ``lang`` are read, so other columns
may have any names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import materialise

#: Bytes of text that are run at a time.
BLOCK = 4_000_000

# Classes of bytes.
BLANK, PLAIN, CAPITAL, SYMBOL, FOLLOWING, END = range(6)
# What a byte does.
POINT, UPPER, SIGN, OPENS, CLOSES = 1, 2, 4, 8, 16
#: The byte after every document; UTF-8 never holds it.
END_BYTE = b"\xff"
#: The blanks between words, and the symbols that are counted.
BLANKS, SYMBOLS = b"\x20\x09\x0a\x0b\x0c\x0d", b"#$%&*|"


def _classes() -> np.ndarray:
    out = np.full(256, PLAIN, np.uint8)
    out[0x80:0xC0] = FOLLOWING
    out[list(BLANKS)] = BLANK
    out[ord("A"): ord("Z") + 1] = CAPITAL
    out[list(SYMBOLS)] = SYMBOL
    out[END_BYTE[0]] = END
    return out


def _actions() -> np.ndarray:
    """What a byte of each class does in the states 0 (between words) and 1 (inside one)."""
    out = np.zeros((2, 6), np.uint8)
    for kind, counted in ((BLANK, POINT), (PLAIN, POINT), (CAPITAL, POINT | UPPER), (SYMBOL, POINT | SIGN)):
        out[:, kind] = counted
    for kind in range(6):
        if kind in (BLANK, END):
            out[1, kind] |= CLOSES
        else:
            out[0, kind] |= OPENS
    return out


CLASS, OUT = _classes(), _actions()
#: The state after a byte of each class.
STATE = np.array([k not in (BLANK, END) for k in range(6)], np.uint8)

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: A random odd number per byte value, and the base of the spans' polynomial hash with its inverse modulo 2**64.
_BYTE_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256).astype(np.uint64) | np.uint64(1)
_BASE, _INVERSE = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the process."""
    if base not in _powers or len(_powers[base]) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.multiply.accumulate(factors)
    return _powers[base][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span's bytes, from prefix sums of a polynomial."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power(_BASE, len(data)), out=sums[1:])
    return (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes from a and from b on are equal, for spans of these sizes (from 1)."""
    if not len(a):
        return np.empty(0, bool)
    first = np.cumsum(size) - size
    inner = np.arange(int(size.sum())) - np.repeat(first, size)
    same = data[np.repeat(a, size) + inner] == data[np.repeat(b, size) + inner]
    return np.logical_and.reduceat(same, first)


def first_of_equals(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """One span (its index) of every set of spans that have the same owner and the same bytes.

    All spans enter an open-addressing table at once, round by round: a span
    that meets an empty slot takes it (if several do, one of them), one that
    meets an equal span is done, any other goes on by its own odd step.
    """
    n = len(starts)
    bits = max(4, int(2 * n).bit_length())
    size, mask = ends - starts, np.int64((1 << bits) - 1)
    key = (span_hashes(data, starts, ends) + owner.astype(np.uint64) * _MIX) * _STEP
    key ^= key >> np.uint64(31)
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    step = (key & np.uint64(mask)).astype(np.int64) | 1
    table = np.full(1 << bits, -1, np.int64)
    left, kept = np.arange(n), []
    while len(left):
        at = slot[left]
        free = table[at] < 0
        table[at[free]] = left[free]
        met = table[at]
        mine = met == left
        kept.append(left[mine])
        alike = ~mine & (key[met] == key[left]) & (owner[met] == owner[left]) & (size[met] == size[left])
        some = np.flatnonzero(alike)
        alike[some] = equal_spans(data, starts[met[some]], starts[left[some]], size[left[some]])
        left = left[~(mine | alike)]
        slot[left] = (slot[left] + step[left]) & mask
    return np.concatenate(kept) if kept else np.empty(0, np.int64)


def run_block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(counts, data, starts and ends of the distinct words) of texts that are run together.

    ``counts`` has a row per text: words, distinct words, capitals, code
    points, symbols.
    """
    data = np.frombuffer(END_BYTE.join(texts) + END_BYTE, np.uint8)
    kinds = CLASS[data]
    state = np.zeros(len(data), np.uint8)
    state[1:] = STATE[kinds[:-1]]
    does = OUT[state, kinds]
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.cumsum(size) - size

    def count(action: int) -> np.ndarray:
        return np.add.reduceat((does & action) != 0, first, dtype=np.int64)

    starts, ends = np.flatnonzero(does & OPENS), np.flatnonzero(does & CLOSES)
    owner = np.searchsorted(first, starts, "right") - 1
    distinct = first_of_equals(data, starts, ends, owner)
    counts = np.column_stack([
        np.bincount(owner, minlength=len(texts)), np.bincount(owner[distinct], minlength=len(texts)),
        count(UPPER), count(POINT), count(SIGN),
    ])
    return counts, data, starts[distinct], ends[distinct]


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces of about ``BLOCK`` bytes that end at blanks."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        if end < len(text):
            cut = max(text.rfind(bytes([b]), at, end) for b in BLANKS)
            if cut < 0:
                cut = min((k for b in BLANKS if (k := text.find(bytes([b]), end)) >= 0), default=len(text) - 1)
            end = cut + 1
        yield text[at:end]
        at = end


def run_long(text: bytes) -> np.ndarray:
    """The counts of one text, piece by piece."""
    total, words = np.zeros(5, np.int64), set()
    for piece in _pieces(text):
        counts, data, starts, ends = run_block([piece])
        raw = data.tobytes()
        words.update(raw[a:b] for a, b in zip(starts.tolist(), ends.tolist()))
        total += counts[0]
    total[1] = len(words)
    return total


def run(texts: list[bytes]) -> np.ndarray:
    """words, distinct_words, capitals, code_points and symbols of every text (UTF-8)."""
    out = np.zeros((len(texts), 5), np.int64)
    some, size = [], 0

    def flush() -> None:
        if some:
            out[some] = run_block([texts[k] for k in some])[0]

    for k, text in enumerate(texts):
        if len(text) > BLOCK:
            out[k] = run_long(text)
            continue
        if size + len(text) > BLOCK:
            flush()
            some, size = [], 0
        some.append(k)
        size += len(text) + 1
    flush()
    return out


COUNTS = ("words", "distinct_words", "capitals", "code_points", "symbols")


def features(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (of the text) and the five counts of every document."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = run([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()])
            kept = [batch.column(c) for c in ("doc_id", "part", "digest")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(found[:, k]) for k in range(5))], names=["doc_id", "part", "digest", *COUNTS]
            )

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"),
    )
    kinds = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(each, f"doc_id long, part string, digest binary, {kinds}")


def text_filters() -> dict[str, Column]:
    """Failure conditions on the features of one document: few words, repeated words, capitals, symbols."""
    words, distinct, capitals, points, symbols = map(F.col, COUNTS)
    return {"A": words < 100, "B": 100 * distinct < 80 * words, "C": 100 * capitals > 10 * points, "D": symbols > 0}


#: The filter that looks at the whole table: a smaller id has the same text.
COPY = "E"


def failures(feats: DataFrame) -> DataFrame:
    """doc_id, part and ``failed``: a bit per filter, in the order A to E.

    The least id of a text is found by a grouping and met again on the text's
    digest together with the id, so copies of one text are spread over all
    tasks.
    """
    feats = materialise(feats, "features")
    bits = F.lit(0)
    for k, failed in enumerate(text_filters().values()):
        bits = bits.bitwiseOR(F.when(failed, 1 << k).otherwise(0))
    copy = 1 << len(text_filters())
    firsts = feats.groupBy("digest").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("digest", "first_digest")
    is_first = (F.col("digest") == F.col("first_digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    met = feats.join(firsts, is_first, "left")
    repeats = F.when(F.col("first_digest").isNull(), copy).otherwise(0)
    return met.select("doc_id", "part", bits.bitwiseOR(repeats).cast("int").alias("failed"))


def _orders(letters: str) -> list[dict]:
    """Every order and step: its filter's letter and bit, and the bits of the filters before it."""
    out = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return out


def audit(failed: DataFrame, letters: str) -> DataFrame:
    """Counts per part, order of the filters and step.

    ``failed`` has part, failed (bits), good and toxic (booleans) per
    document.  ``shapley`` is what the step's filter removes, summed over all
    orders: a document that fails k filters is removed by each of them in one
    k-th of the orders.
    """
    sets = failed.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    steps = _orders(letters)
    kind = "array<struct<filter_order: string, step: int, bit: int, before: int>>"
    each = sets.select("*", F.explode(F.from_json(F.lit(json.dumps(steps)), kind)).alias("at")).select("*", "at.*")
    fails, earlier = F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("long")

    share = F.lit(len(steps) // len(letters)) * F.col("n") / F.greatest(F.bit_count("failed"), F.lit(1))
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"), total(F.col("failed") == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"), total(fails & ~earlier, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over all documents, with the losses by label."""
    failed = failures(features(docs))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    marked = failed.join(marks, "doc_id", "left").na.fill(False, ["good", "toxic"])
    return audit(marked, "".join(text_filters()) + COPY)


def oracle() -> str:
    """``audit_documents`` in DuckDB SQL."""
    return r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM texts),
marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), doc_id IS NULL AND min(doc_id) OVER (PARTITION BY t) IS NOT NULL) AS e
  FROM words LEFT JOIN marks USING (doc_id)),
sets AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
    || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM docs GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT v.x || w.x || y.x || z.x || u.x AS filter_order
  FROM letters v JOIN letters w ON w.x <> v.x JOIN letters y ON y.x NOT IN (v.x, w.x)
  JOIN letters z ON z.x NOT IN (v.x, w.x, y.x) JOIN letters u ON u.x NOT IN (v.x, w.x, y.x, z.x)),
played AS (
  SELECT s.*, filter_order, step, filter_order[step] AS letter, contains(failed, filter_order[step]) AS fails,
    length(translate(failed, filter_order[1:step - 1], '')) < length(failed) AS earlier
  FROM sets s, orders, generate_series(1, 5) AS g(step)),
taken AS (
  SELECT part, letter, sum(n) FILTER (fails AND NOT earlier) AS shapley FROM played GROUP BY part, letter)
SELECT p.part, p.filter_order, CAST(p.step AS INTEGER) AS step,
  CAST(coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (fails AND NOT earlier), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (fails AND earlier), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (failed = p.letter), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (fails AND NOT earlier), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (fails AND NOT earlier), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(any_value(shapley), 0) AS BIGINT) AS shapley
FROM played p JOIN taken t ON t.part = p.part AND t.letter = p.letter
GROUP BY p.part, p.filter_order, p.step, p.letter"""
