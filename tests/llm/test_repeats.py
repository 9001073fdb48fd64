"""Repeated ids in the fits, columns named like internal ones, ties."""

import pytest
from pyspark.sql import functions as F

from barforge.llm import langid, lines, order_minhash, quality
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def repeated(spark):
    """2,000 rows, of which every second one has one and the same id."""
    rows = [(7 if k % 2 else 10_000 + k, prose(k, 12), "en" if k % 4 < 2 else "de") for k in range(2000)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_fit_is_bounded(repeated, monkeypatch):
    monkeypatch.setattr(langid, "build", lambda samples, order: samples)
    samples = langid.fit(repeated, per_language=100)
    assert {k: len(v) for k, v in samples.items()} == {"en": 100, "de": 100}
    assert samples == langid.fit(repeated.repartition(5, "text"), per_language=100)


def test_quality_fit_is_bounded(spark, repeated, monkeypatch):
    labels = repeated.select("doc_id").distinct().withColumn("quality", (F.col("doc_id") % 4 == 2).cast("int"))
    labels = labels.unionByName(labels)
    monkeypatch.setattr(quality, "fit_nnpu", lambda x, u, prior: (sorted(map(bytes, x)), sorted(map(bytes, u)), prior))
    trusted, others, prior = quality.fit(repeated, labels, positives=50, unlabelled=150)
    assert (len(trusted), len(others)) == (50, 150)
    assert (trusted, others, prior) == quality.fit(repeated.repartition(5, "text"), labels, positives=50, unlabelled=150)


ODD_NAMES = ["__GONE", "__id", "__sig", "__text", "__of", "__place", "digest", "component"]


def test_columns_named_like_internal_ones(spark):
    same = prose(1, 60)
    rows = [(1, same, *"abcdefgh"), (2, f"{same}\n{prose(2, 9)}", *"ijklmnop"), (3, prose(3, 60), *"qrstuvwx")]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *ODD_NAMES])
    cut = lines.drop_lines(docs)
    assert cut.columns == docs.columns
    assert sorted(map(tuple, cut.collect())) == [rows[0], (2, prose(2, 9), *"ijklmnop"), rows[2]]
    again = spark.createDataFrame([*rows, (4, same, *"zzzzzzzz")], docs.schema)
    left = order_minhash.drop_near(again)
    assert left.columns == docs.columns
    assert {1, 3} <= {r.doc_id for r in left.collect()} <= {1, 2, 3}


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    text = prose(5, 50)
    rows = [(1, text, "a"), (1, text.upper(), "b"), (1, text + "!", "c"), (1, text + "!", "d"), (2, text, "e")]
    found = {
        tuple(map(tuple, order_minhash.drop_near(spark.createDataFrame(some, "doc_id long, text string, source string")).collect()))
        for some in (rows, rows[::-1])
    }
    assert len(found) == 1 and len(next(iter(found))) == 1 and next(iter(found))[0][0] == 1
