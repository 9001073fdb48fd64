"""Line dedup on lines of every length."""

import random

from barforge.llm import lines
from tests.llm.test_near import levenshtein


def brute_force(rows):
    """line_classes from all pairs of distinct lines."""
    each = [(i, k, line) for i, text in rows for k, line in enumerate(text.split("\n")) if line.strip()]
    first = {}
    for i, k, line in sorted(each):
        first.setdefault(line, (i, k))
    near = {x: [first[y] for y in first if x != y and levenshtein(x, y) <= min(2, min(len(x), len(y)) // 10)] for x in first}
    return sorted((i, k, *first[x], len(near[x]), (i, k) == first[x] and all(first[x] < y for y in near[x])) for i, k, x in each)


def test_lines_of_every_length_equal_brute_force(frame):
    r, rows = random.Random(11), []
    pool = ["".join(r.choice("abcde ") for _ in range(n)) + "." for n in range(28) for _ in range(2)]
    for k in range(60):
        body = []
        for _ in range(r.randrange(1, 6)):
            line = r.choice(pool)
            for _ in range(r.choice((0, 0, 1, 1, 2, 3))):
                at = r.randrange(len(line))
                line = line[:at] + r.choice(("", "q", line[at] + "z")) + line[at + 1:]
            body.append(line)
        rows.append((k, "\n".join([*body, ""])))
    found = sorted(map(tuple, lines.line_classes(frame(rows)).drop("tsig").collect()))
    assert found == brute_force(rows)
    lengths = {i: t.split("\n") for i, t in rows}
    assert {0, 1} <= {min(len(lengths[x[0]][x[1]]) // 10, 2) for x in found if not x[5]}


def test_exact_repeats_of_short_lines_go(frame):
    rows = [(1, "ok\nfirst text"), (2, "ok\nsecond text"), (3, "ok"), (4, "no\n\nsecond text")]
    out = lines.drop_lines(frame(rows)).collect()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out) == [(1, "ok\nfirst text", 13), (2, "second text", 11), (4, "no\n", 3)]
