"""Repeated passages beside documents that share only a part of them, and keys over the ends of batches and partitions."""

import random

import pytest

from barforge.llm import suffixes
from tests.llm.conftest import prose
from tests.llm.test_near import passages


def test_a_partner_that_shares_only_the_tail_hides_no_other(frame):
    rows = []
    for k in range(20):
        passage = prose(5000 + k, 50)
        tail = " ".join(passage.split(" ")[-(30 + k % 3 * 8):])
        rows.append((k, f"{prose(6000 + k, 45)} {tail} {prose(7000 + k, 40)}"))
        rows += [(100 + 2 * k + j, f"{prose(8000 + 2 * k + j, 20)} {passage} {prose(9000 + 2 * k + j, 60)}") for j in range(2)]
    found = suffixes.repeated_spans(frame(rows).repartition(3)).collect()
    expected = passages(rows)
    assert len(expected) == 40
    assert {x.doc_id: [tuple(s) for s in x.spans] for x in found} == expected


@pytest.mark.parametrize("cut", [1, 2, 7, 1000])
def test_keys_over_the_ends_of_batches_and_partitions(spark, monkeypatch, cut):
    r = random.Random(cut)
    # Few keys, one of them in most rows; ids may be null; one document can hold a key several times.
    rows = [(r.choice((None, *range(6))), r.choice((5, 5, 6)), r.choice((1, 1, 1, *range(2, 40))), k, k + 1) for k in range(120)]
    inner = suffixes._marked

    def pieces(batches):
        return inner(b.slice(k, cut) for b in batches for k in range(0, b.num_rows, cut))

    monkeypatch.setattr(suffixes, "_marked", pieces)
    monkeypatch.setattr(suffixes, "materialise", lambda df, name: df)
    confs = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        found = suffixes._held_by_two(spark.createDataFrame(rows, suffixes._ROWS), "x").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    holders = {}
    for i, sig, key, _, _ in rows:
        holders.setdefault(key, set()).add((i, sig))
    assert sorted(x.first for x in found) == [k for _, _, key, k, _ in rows if len(holders[key]) > 1]
