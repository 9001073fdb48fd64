"""Benchmark items of every length against a plain semi-global alignment of all pairs."""

import random

import pytest

from barforge.llm import decontaminate
from tests.llm.conftest import prose
from tests.llm.test_models import benchmark


def best(item, text):
    """Least edits of an occurrence of the item anywhere in the text."""
    row = [0] * (len(text) + 1)
    for k, c in enumerate(item, 1):
        new = [k]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


@pytest.mark.parametrize("block", [1_000_000, 60])
def test_leaks_equal_brute_force(spark, frame, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    r = random.Random(21)
    items = [(n, "".join(r.choice("abcdefgh ") for _ in range(n))) for n in range(1, 45)]
    items += [(100, items[20][1]), (101, None), (102, "")]
    rows = [(1, None), (2, ""), (None, items[30][1])]
    for k in range(90):
        chars = list(items[k % 44][1])
        for at in r.sample(range(len(chars)), min(len(chars), r.randrange(5))):
            chars[at] = r.choice(("", "x", chars[at] + "x"))
        left, right = ("".join(r.choice("abcdefgh ") for _ in range(r.randrange(30))) for _ in range(2))
        rows.append((10 + k, f"{left}{''.join(chars)}{right}"))
    expected = {}
    for doc, text in rows:
        for item_id, item in items:
            if text and item:
                d = best(item, text)
                if d <= int(0.1 * len(item)):
                    expected[doc, item_id] = d
    found = decontaminate.find_leaks(frame(rows), benchmark(spark, items)).collect()
    assert len(found) == len(expected) and {(x.doc_id, x.item_id): x.edits for x in found} == expected
    # Lengths at which the budget is above what 8-grams allow.
    assert any(d == 1 and i in range(10, 16) for (_, i), d in expected.items())
    kept = decontaminate.drop_leaking(frame(rows), benchmark(spark, items)).collect()
    assert sorted(str(x.doc_id) for x in kept) == sorted(str(d) for d, _ in rows if d not in {k for k, _ in expected})


def test_long_items_keep_eight_grams():
    index = decontaminate.Index([(1, prose(1, 20)), (2, "abc"), (3, "a" * 12)])
    assert {g.q: len(g.ids) for g in index.parts} == {8: 1, 2: 1, 4: 1}
