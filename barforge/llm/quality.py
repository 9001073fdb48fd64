"""Quality classifier: positive-unlabelled learning with the non-negative risk.

Trusted positives are documents labelled 1; unlabelled web text is any other
document.  With the class prior p (share of label 1 among the labels that may
be learned from) and the logistic loss l, a linear model minimises

    p E+[l(z)] + max(0, Eu[l(-z)] - p E+[l(-z)]),

the unbiased risk with its negative part kept from falling below zero.  The
fit uses a bounded sample (``POSITIVES`` and ``UNLABELLED`` documents, those
with the smallest id hashes); every document is scored over its whole text.

A text is described by the frequencies of its character-class trigrams and by
how often its words repeat; nothing but the text enters a score.

Defined cases: null and empty texts have only zero features and get the score
of the intercept; labels that are null, or that disagree for one ``doc_id``,
are not learned from; without labels every score is 0.5; repeated rows are
scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITIVES = 2000
UNLABELLED = 5000
CLASSES = 11
_CHUNK_BYTES = 2_000_000
#: Parts into which each repetition measure is cut.
_STEPS = 10


def _class_table() -> np.ndarray:
    """The class of every byte: letters by case, digits, white space, kinds of signs."""
    table = np.full(256, 10, np.uint8)  # control characters and what is not named below
    named = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,", "!?")
    for k, chars in enumerate((*named, "#$%&*@^~", "|<>/\\=+_-{}[]", "\"'();:`")):
        table[np.frombuffer(chars.encode(), np.uint8)] = k
    table[128:] = 0
    return table


_TABLE = _class_table()
_TRIGRAMS = CLASSES**3
FEATURES = _TRIGRAMS + 2 * (_STEPS + 1)


def _repetition(text: str) -> tuple[float, float]:
    """Share of words equal to the one before, and share of distinct words among the first 200 times as many."""
    words = text.split()
    if len(words) < 2:
        return 0.0, 0.0
    same = sum(map(eq, words, words[1:])) / (len(words) - 1)
    # Long texts repeat words anyway: distinct words are set against a power of the length.
    return same, 1 - min(1.0, len(set(words)) / len(words) ** 0.8)


def features(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` float32 values per text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    k = 0
    while k < len(texts):
        raw, size, end = [], 0, k
        while end < len(texts) and size < _CHUNK_BYTES:
            raw.append(texts[end].encode("utf-8", "replace"))
            size += len(raw[-1])
            end += 1
        n = np.fromiter(map(len, raw), np.int64, len(raw))
        for lo in range(0, len(raw), 64):  # the counts of 64 texts at a time stay small
            some, m = raw[lo: lo + 64], n[lo: lo + 64]
            c = _TABLE[np.frombuffer(b"".join(some), np.uint8)].astype(np.int32)
            if len(c) < 3:
                continue
            gram = c[:-2] * (CLASSES * CLASSES) + c[1:-1] * CLASSES + c[2:]
            owner = np.repeat(np.arange(len(some), dtype=np.int32), m)
            inside = owner[:-2] == owner[2:]
            counts = np.bincount(
                (owner[:-2] * _TRIGRAMS + gram)[inside], minlength=len(some) * _TRIGRAMS
            ).reshape(len(some), _TRIGRAMS)
            share = counts / np.maximum(1, m - 2)[:, None]
            out[k + lo: k + lo + len(some), :_TRIGRAMS] = np.sqrt(share)
        for i in range(k, end):
            for j, x in enumerate(_repetition(texts[i])):
                at = _TRIGRAMS + j * (_STEPS + 1)
                out[i, at] = x
                if x:
                    out[i, at + 1 + min(_STEPS - 1, int(x * _STEPS))] = 1
        k = end
    return out


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.empty(len(texts))
        for k in range(0, len(texts), 512):
            z = features(texts[k: k + 512]) @ self.weights + self.intercept
            out[k: k + 512] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return out


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05,
             decay: float = 1e-4) -> Model:
    """Minimise the non-negative PU risk by Adam on the whole sample."""
    x = np.concatenate([positive, unlabelled]).astype(np.float32)
    n = len(positive)
    w = np.zeros(x.shape[1] + 1, np.float64)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = x @ w[:-1].astype(np.float32) + w[-1]
        up = 1 / (1 + np.exp(-np.clip(z, -40, 40)))  # d l(-z) / dz; of l(z): up - 1
        negative = np.logaddexp(0, z[n:]).mean() - prior * np.logaddexp(0, z[:n]).mean()
        slope = np.empty_like(z)
        if negative >= 0:
            slope[:n] = prior * (up[:n] - 1) / n - prior * up[:n] / n
            slope[n:] = up[n:] / (len(z) - n)
        else:  # the negative risk is below zero: only push it up again
            slope[:n] = prior * up[:n] / n
            slope[n:] = -up[n:] / (len(z) - n)
        grad = np.append(x.T @ slope.astype(np.float32), slope.sum()) + decay * np.append(w[:-1], 0)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def learn_fold(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on a bounded sample of the learnable rows (see the module's docstring)."""
    ids = F.col("doc_id").cast("long").alias("doc_id")
    known = (
        labels.select(ids, F.col("quality"))
        .where(learn_fold(F.col("doc_id")) & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
    )
    prior = known.agg(F.avg(F.col("high").cast("double"))).first()[0]
    if prior is None:
        return Model(np.zeros(FEATURES, np.float32), 0.0)
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    trusted = known.where("high = 1").select("doc_id").orderBy(*order).limit(positives)
    others = docs.select(ids).where(learn_fold(F.col("doc_id"))).distinct().orderBy(*order).limit(unlabelled)
    picks = trusted.withColumn("trusted", F.lit(True)).union(others.withColumn("trusted", F.lit(False)))
    texts = docs.select(ids, F.coalesce("text", F.lit("")).alias("text"))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = features(batch["text"].tolist())
            yield pd.DataFrame({"trusted": batch["trusted"], "x": [row.tobytes() for row in rows]})

    # At most positives + unlabelled ids, and one text for each (the least): a fixed bound.
    sample = texts.join(F.broadcast(picks), "doc_id").groupBy("doc_id", "trusted").agg(F.min("text").alias("text"))
    rows = sample.select("trusted", "text").mapInPandas(describe, "trusted boolean, x binary").collect()
    x = {kind: [np.frombuffer(r["x"], np.float32) for r in rows if r["trusted"] is kind] for kind in (True, False)}
    if not x[True] or not x[False]:
        return Model(np.zeros(FEATURES, np.float32), 0.0)
    return fit_nnpu(np.stack(x[True]), np.stack(x[False]), min(max(prior, 0.01), 0.99))


def scorer(model: Model):
    """A column function: the score of a text column."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.score(batch.tolist()))

    return lambda text: score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), scorer(model)(F.col("text")).alias("score")
    )
    held = F.coalesce(~learn_fold(F.col("doc_id")), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with all their columns, whose text is not rejected."""
    return docs.where(scorer(fit(docs, labels))(F.col("text")) >= 0.5)
