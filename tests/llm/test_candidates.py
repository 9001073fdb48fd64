"""Filters that keep far pairs out of joins and shuffles, and lose none that is near."""

import random

from pyspark.sql import functions as F

from barforge.llm import lines
from barforge.llm.common import materialise, probably_in


def _distances(spark, pairs):
    rows = spark.createDataFrame(pairs, "x string, y string").select(
        "x", "y", lines._letter_distance(lines._letters(F.col("x")), lines._letters(F.col("y"))).alias("d"))
    return {(r.x, r.y): r.d for r in rows.collect()}


def test_lines_that_differ_in_rarer_letters_do_not_meet(spark):
    x, y = "the same end of a line, and hhllddcc", "the same end of a line, and uummffpp"
    assert _distances(spark, [(x, y)])[x, y] > 2 * lines.MAX_EDITS


def test_letter_distance_is_at_most_twice_the_edits(spark):
    r, pairs = random.Random(3), []
    for _ in range(60):
        x = "".join(r.choice("eehllpñ 🙂t") for _ in range(r.randrange(20, 90)))
        y, edits = x, r.randrange(3)
        for _ in range(edits):
            k = r.randrange(len(y))
            y = r.choice([y[:k] + y[k + 1:], y[:k] + "e" + y[k:], y[:k] + "p" + y[k + 1:]])
        pairs.append((x, y))
    # A count that passes a multiple of sixteen is still near.
    pairs += [("e" * 15 + "h" * 31, "e" * 16 + "h" * 32), ("l" * 300, "l" * 302)]
    assert max(_distances(spark, pairs).values()) <= 2 * lines.MAX_EDITS


def test_keys_of_bytes_and_of_characters_agree(spark):
    rows = spark.createDataFrame([("plain words of one byte each", "plain words of one byte eachñ")], "x string, y string")
    x, y = (lines.segment_keys(F.col(c), F.length(c)) for c in "xy")
    # The longer line's keys of one character less meet the first two segments of the other.
    met = rows.select(F.arrays_overlap(x["key"], y["key"]).alias("met")).first().met
    assert met


def test_probably_in_keeps_all_wanted_and_few_others(spark, tmp_path):
    ids = spark.range(0, 40_000).select(F.xxhash64("id").alias("id"), F.col("id").alias("n"))
    wanted = materialise(ids.where("n % 100 = 7").select("id"), "wanted")
    some = probably_in(ids, "id", wanted)
    assert some.columns == ["id", "n"]
    assert some.where("n % 100 = 7").count() == 400
    assert some.count() < 6_000
    assert probably_in(ids, "id", wanted.where("false")).count() == 0


def test_each_bucket_is_written_once_before_the_first_round(frame, monkeypatch):
    from barforge.llm import order_minhash
    from tests.llm.conftest import prose

    written, write = [], order_minhash.materialise

    def noted(df, name):
        written.append(name)
        return write(df, name)

    monkeypatch.setattr(order_minhash, "materialise", noted)
    text = prose(5, 120)
    docs = frame([(1, text), (2, text + " end"), (3, text), (4, prose(6, 120))])
    groups = {r.doc_id: r.group_id for r in order_minhash.near_groups(docs, whole=False).collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 4: 4}
    assert "keys" not in written and written[: written.index("leaders")] == ["sketches", "members", "class-words"]


def test_mixed_buckets_hold_more_than_one_value(spark):
    from barforge.llm.order_minhash import _mixed_buckets

    rows = spark.createDataFrame([(1, 5, 5), (1, 6, 5), (2, 7, 7), (2, 8, 9), (3, 4, 4)], "key long, node long, part long")
    assert sorted(map(tuple, _mixed_buckets(rows, "part").collect())) == [(2, 7, 7, 7), (2, 8, 9, 7)]
