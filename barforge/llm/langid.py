"""Language identification by prediction by partial matching (PPM).

Per language a context tree over the bytes of lower-case text is fitted up to
``ORDER`` bytes of context.  A byte's code length is that of the longest known
context, with an escape (method C: t / (n + t) for t distinct bytes among n)
for every longer context that has not seen the byte; the last resort is 8
bits.  Statistics are frozen before scoring, so the length of a byte depends
only on the ORDER + 1 bytes that end there: each batch counts its distinct
byte groups, looks these up once and sums up per text.  The language with the
shortest code wins (ties: first by name); the score is its share of
2 ** -length over all languages.

The trees are fitted on a bounded sample: per language at most ``DOCS`` texts
(smallest id hashes, one text for each id) of at most ``CHARS`` characters
together, whole texts.  More than ``MAX_LANGUAGES`` languages are an error.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
rows with a null lang or ``doc_id`` are not learned from; without any language
every text is ``und``; repeated rows are predicted alike; an id that is
repeated within a language is learned from once, by its text with the least
hash; very long texts are scored whole; columns other than ``doc_id``, ``text``
and ``lang`` are not read and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = 3
DOCS = 400
CHARS = 1_500_000
#: More values of lang than this are an error: a model holds a column for each.
MAX_LANGUAGES = 1000
_CHUNK = 2_000_000


def _grams(raw: np.ndarray, k: int) -> np.ndarray:
    """The k bytes that end at each place, as one number."""
    out = raw[k - 1:].astype(np.uint64)
    for j in range(1, k):
        out |= raw[k - 1 - j: len(raw) - j].astype(np.uint64) << np.uint64(8 * j)
    return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


@dataclass
class Model:
    """Per order: known groups with code lengths, known contexts with escape lengths (columns: languages)."""

    languages: list[str]
    grams: list[np.ndarray]
    lengths: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def length(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Code length of the last byte of each group of order + 1 bytes, per language."""
        if order < 0:
            return np.full((len(keys), len(self.languages)), 8.0)
        at, known = _find(self.grams[order], keys)
        out = np.empty((len(keys), len(self.languages)))
        if known.any():
            out[known] = self.lengths[order][at[known]]
        rest = np.flatnonzero(~known)
        if len(rest):
            out[rest] = self.length(keys[rest] & np.uint64((1 << (8 * order)) - 1), order - 1)
            at, seen = _find(self.contexts[order], keys[rest] >> np.uint64(8))
            out[rest[seen]] += self.escapes[order][at[seen]]
        return out

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in bits, per language."""
        k = len(self.grams)
        pad = b"\n" * (k - 1)  # every text starts after line breaks
        n = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        raw = np.frombuffer(b"".join(pad + t for t in texts) or b"", np.uint8)
        if not n.sum():
            return np.zeros((len(texts), len(self.languages)))
        owner = np.repeat(np.arange(len(texts)), n + k - 1)
        inside = owner[k - 1:] == owner[: len(owner) - k + 1]
        distinct, index = np.unique(_grams(raw, k)[inside], return_inverse=True)
        lengths = self.length(distinct, k - 1)
        owner = np.repeat(np.arange(len(texts)), n)
        return np.stack([
            np.bincount(owner, weights=lengths[index, j], minlength=len(texts))
            for j in range(len(self.languages))
        ], axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        lettered = pc.fill_null(pc.match_substring_regex(pa.array(texts, pa.large_string()), r"\p{L}"), False)
        rows = np.flatnonzero(lettered.to_numpy(zero_copy_only=False)) if self.languages else []
        some, size = [], 0
        for at, i in enumerate(rows):
            some.append(i)
            size += len(texts[i])
            if size >= _CHUNK or at == len(rows) - 1:
                bits = self.totals([texts[j].lower().encode("utf-8", "replace") for j in some])
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(np.clip(bits.min(axis=1)[:, None] - bits, -1000, 0)).sum(axis=1)
                for j, b, s in zip(some, best, share):
                    names[j], scores[j] = self.languages[b], s
                some, size = [], 0
        return names, scores


def build(samples: dict[str, list[str]], order: int = ORDER) -> Model:
    """Context trees of all languages from their sample texts."""
    languages = sorted(samples)
    model = Model(languages, [], [], [], [])
    pad = b"\n" * order
    raw = {k: np.frombuffer(b"".join(pad + t.lower().encode("utf-8", "replace") for t in samples[k]), np.uint8)
           for k in languages}
    for o in range(order + 1):
        counted = {k: np.unique(_grams(raw[k], o + 1), return_counts=True) for k in languages if len(raw[k]) > o}
        grams = np.unique(np.concatenate([np.empty(0, np.uint64), *(g for g, _ in counted.values())]))
        contexts = np.unique(grams >> np.uint64(8))
        shorter = model.length(grams & np.uint64((1 << (8 * o)) - 1), o - 1)
        lengths, escapes = np.empty((len(grams), len(languages))), np.zeros((len(contexts), len(languages)))
        of = np.searchsorted(contexts, grams >> np.uint64(8))
        for j, name in enumerate(languages):
            g, c = counted.get(name, (np.empty(0, np.uint64), np.empty(0, np.int64)))
            count = np.zeros(len(grams))
            count[np.searchsorted(grams, g)] = c
            n = np.bincount(of, weights=count, minlength=len(contexts))
            t = np.bincount(of, weights=count > 0, minlength=len(contexts))
            seen = n > 0
            escapes[seen, j] = np.log2((n[seen] + t[seen]) / t[seen])
            has = count > 0
            lengths[has, j] = np.log2((n + t)[of][has] / count[has])
            lengths[~has, j] = escapes[of[~has], j] + shorter[~has, j]
        model.grams.append(grams)
        model.lengths.append(lengths)
        model.contexts.append(contexts)
        model.escapes.append(escapes)
    return model


def learn_fold(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def fit(docs: DataFrame, per_language: int = DOCS, chars: int = CHARS, order: int = ORDER) -> Model:
    """Fit on a bounded sample of the learnable rows (see the module's docstring)."""
    ids = F.col("doc_id").cast("long").alias("doc_id")
    known = docs.select(ids, F.col("lang"), F.col("text")).where("lang is not null and doc_id is not null and text <> ''")
    known = known.where(learn_fold(F.col("doc_id")))
    rows = known.select("doc_id", "lang", F.struct(F.xxhash64("text").alias("sig"), F.length("text").alias("n")).alias("one"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in lang")
    if not counts:
        return build({}, order)
    # Only ids whose hash lies in a share that holds about four times the wanted
    # number are ranked, so a language with a third of all rows is one small group.
    shares = [(r["lang"], min(1.0, 4 * per_language / r["ids"])) for r in counts]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    near = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    # An id that is repeated within a language stands for its text with the least hash.
    near = near.groupBy("lang", "doc_id").agg(F.min("one").alias("one")).select("lang", "doc_id", "one.sig", "one.n")
    first = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)), "doc_id")
    ranked = near.withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language)
    upto = Window.partitionBy("lang").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    picks = ranked.withColumn("upto", F.sum("n").over(upto)).where((F.col("upto") <= chars) | (F.col("k") == 1))
    # per_language rows for each language at most: small by the parameters.
    signed = known.withColumn("sig", F.xxhash64("text"))
    texts = signed.join(F.broadcast(picks.select("lang", "doc_id", "sig")), ["lang", "doc_id", "sig"])
    texts = texts.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    samples: dict[str, list[str]] = {}
    for row in sorted(texts.collect(), key=lambda r: (r["lang"], r["doc_id"])):
        samples.setdefault(row["lang"], []).append(row["text"])
    return build(samples, order)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    out = texts.mapInArrow(predict, "doc_id long, lang_pred string, score double")
    held = F.coalesce(~learn_fold(F.col("doc_id")), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
