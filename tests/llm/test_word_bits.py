"""Members and leaders that no edit budget can join never meet."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.llm import order_minhash
from tests.llm.conftest import prose
from tests.llm.test_near import edited, levenshtein


def test_bitmaps_allow_every_near_pair(spark):
    r, rows = random.Random(8), []
    for k in range(150):
        x = [r.randrange(r.choice((3, 30, 3000))) for _ in range(r.randint(1, 40))]
        y = list(x)
        for _ in range(r.randrange(9)):
            at = r.randrange(len(y) + 1)
            y[at: at + r.randrange(2)] = [r.randrange(3000)] * r.randrange(2)
        d, both = levenshtein(x, y), []
        for w in (x, y):
            bits = order_minhash.word_bits(np.array(w, np.int32))
            half = len(bits) // 2
            both += [bits.tolist(), (bits[:half] ^ bits[half:] if half else bits).tolist(), len(w)]
        rows.append((*both, d <= int(0.2 * max(len(x), len(y)) + 1e-9)))
    rows += [([1], [1], 0, [1, 2, 3, 4], [1, 2], 9, False)]
    names = "bits array<long>, folded array<long>, n int, bits2 array<long>, folded2 array<long>, m int, near boolean"
    found = spark.createDataFrame(rows, names).select("near", order_minhash._bits_near(0.8).alias("meets")).collect()
    assert all(f.meets for f in found if f.near) and sum(f.near for f in found) > 20
    assert sum(not f.meets for f in found) > 20


@pytest.mark.parametrize("n_words", [30, 200])
def test_strangers_of_a_bucket_are_not_paired(frame, monkeypatch, n_words):
    """Before, a bucket of strangers gave every pair of them once."""
    counts, write = {}, order_minhash.materialise

    def counted(df, name):
        out = write(df, name)
        counts.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(order_minhash, "materialise", counted)
    rows = [(k, prose(700 + k, n_words)) for k in range(40)] + [(100 + k, edited(prose(720, n_words), k, 1)) for k in range(5)]
    sketches = order_minhash._sketched(frame(rows)).withColumn("keys", F.array(F.lit(1).cast("long")))
    links = order_minhash.near_links(frame(rows), sketches, whole=False).collect()
    of = {r.sig: r.doc_id for r in sketches.collect()}
    assert {of[x] for r in links for x in (r.sig_a, r.sig_b)} == {20, *range(100, 105)} and len(links) >= 5
    # The first round's leader meets the bucket; later only near pairs.
    assert sum(counts["pairs"]) <= 2 * len(rows) and len(counts["pairs"]) > 1
