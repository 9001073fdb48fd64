"""Order MinHash, alignments, components, repeated passages and line dedup."""

import itertools
import random

import duckdb
import pytest

from barforge.llm import lines, order_minhash, suffixes
from barforge.llm.align import edit_distance, find_within
from barforge.llm.components import connected_components
from tests.llm.conftest import ODD_ROWS, VOCABULARY, prose


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(text, seed, edits):
    r, w = random.Random(seed), text.split(" ")
    for _ in range(edits):
        k = r.randrange(len(w))
        w[k: k + r.randrange(2)] = [r.choice(VOCABULARY) + "x"]
    return " ".join(w)


def test_alignments_equal_the_plain_program():
    r = random.Random(3)
    for _ in range(4000):
        a = "".join(r.choice("abc") for _ in range(r.randrange(14)))
        b = "".join(r.choice("abc") for _ in range(r.randrange(14)))
        e, d = r.randrange(15), levenshtein(a, b)
        assert edit_distance(a, b, e) == (d if d <= e else None), (a, b, e)
    for _ in range(800):
        a = "".join(r.choice("abc") for _ in range(r.randint(1, 6)))
        b = "".join(r.choice("abc") for _ in range(r.randint(1, 12)))
        best = min(levenshtein(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        found = find_within(a, b, 5)
        if best < len(a) and best <= 5:
            assert found[0] == best == levenshtein(a, b[found[1]: found[2]])


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(12)] + [(20, 21), (30, 20), (5, 5), (40, 40)], "a long, b long")
    found = {r.node: r.component for r in connected_components(links).collect()}
    assert found == {**{k: 0 for k in range(13)}, 20: 20, 21: 20, 30: 20}


def near_rows():
    rows = []
    for k in range(12):
        base = prose(k, 120)
        rows += [(10 * k, base), (10 * k + 1, base.upper() + "!"), (10 * k + 2, edited(base, k, 2)), (10 * k + 3, edited(base, k + 50, 3))]
    return rows + [(500 + k, prose(900 + k, 120)) for k in range(20)]


def test_near_groups_equal_brute_force(frame):
    rows = near_rows()
    words = {i: t.lower().rstrip("!").split() for i, t in rows}
    parent = {i: i for i in words}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = dict.fromkeys(words, 0)
    for a, b in itertools.combinations(words, 2):
        most = max(len(words[a]), len(words[b]))
        if edit_distance(words[a], words[b], most // 5) is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = order_minhash.near_groups(frame(rows)).collect()
    assert {r.doc_id: r.group_id for r in found} == {i: root(i) for i in words}
    assert all(r.class_id == r.doc_id - (r.doc_id < 500 and r.doc_id % 10 == 1) for r in found)
    kept = order_minhash.drop_near(frame(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({root(i) for i in words})
    assert kept.columns == frame(rows).columns


def test_near_groups_of_short_and_odd_rows(frame):
    rows = ODD_ROWS + [(50, "one two three four five six"), (51, "ONE two, three four five six"), (52, "something else entirely")]
    found = order_minhash.near_groups(frame(rows)).collect()
    group = {r.doc_id: r.group_id for r in found}
    assert len(found) == len(rows) and group[51] == 50 and group[52] == 52 and group[1] == 1 and group[-7] == -7
    kept = [(r.doc_id, r.text) for r in order_minhash.drop_near(frame(rows)).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [
        (1, None), (2, ""), (3, "   "), (4, "same"), (5, ODD_ROWS[6][1]), (None, None), (6, ODD_ROWS[8][1]), (-7, "a lonely text"),
        (50, rows[10][1]), (52, rows[12][1]),
    ]))
    assert order_minhash.near_groups(frame([])).collect() == [] and order_minhash.drop_near(frame([])).collect() == []


def test_a_bucket_is_resolved_by_leaders(frame, monkeypatch):
    """One bucket with two groups and strangers: links only where texts are near."""
    import numpy as np

    monkeypatch.setattr(order_minhash, "_samples", lambda kmers, picks: np.full(2, picks, np.uint64))
    rows = [(k, edited(prose(k % 3, 60), k, 1)) for k in range(12)] + [(100 + k, prose(50 + k, 60)) for k in range(6)]
    links = order_minhash.near_links(frame(rows), order_minhash._sketched(frame(rows)))
    assert links.count() >= 9
    groups = {r.doc_id: r.group_id for r in order_minhash.near_groups(frame(rows)).collect()}
    assert {i: groups[i] for i in range(12)} == {i: i % 3 for i in range(12)} and all(groups[100 + k] == 100 + k for k in range(6))


def passages(rows):
    """Brute force: merged spans of 50-word windows that another document holds."""
    where = {}
    words = {i: t.lower().split() for i, t in rows if t}
    for i, w in words.items():
        for k in range(len(w) - 49):
            where.setdefault(tuple(w[k: k + 50]), set()).add(i)
    out = {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            if len(where[tuple(w[k: k + 50])]) > 1:
                spans = out.setdefault(i, [])
                if spans and k <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], k + 50)
                else:
                    spans.append((k, k + 50))
    return out


@pytest.mark.parametrize("held", [200_000, 5])
def test_repeated_passages_equal_brute_force(frame, monkeypatch, held):
    monkeypatch.setattr(suffixes, "MAX_HELD", held)
    shared = [prose(1000 + k, n) for k, n in enumerate((49, 50, 51, 60, 75, 200))]
    r, rows = random.Random(2), []
    for k in range(60):
        parts = [prose(2000 + k, r.randrange(80))]
        for p in r.sample(shared, r.randrange(3)):
            parts += [p, prose(3000 + 7 * k + len(parts), r.randrange(60))]
        rows.append((k, " ".join(x for x in parts if x)))
    rows += [(200, shared[5] + " " + shared[5]), (201, rows[0][1]), (202, rows[0][1])]
    found = suffixes.repeated_spans(frame(rows).repartition(3)).collect()
    assert {x.doc_id: [tuple(s) for s in x.spans] for x in found} == passages(rows)


def test_repeats_inside_one_document_do_not_count(frame):
    text = prose(1, 80)
    assert suffixes.repeated_spans(frame([(1, text + " " + text), (2, prose(2, 100)), (2, prose(2, 100))])).collect() == []
    both = suffixes.repeated_spans(frame([(1, text), (None, text)] + ODD_ROWS)).collect()
    assert sorted((str(x.doc_id), x.spans[0].end) for x in both) == [("1", 80), ("None", 80)]
    assert suffixes.report(suffixes.repeated_spans(frame([]))).collect() == []


def line_rows():
    r, rows = random.Random(4), []
    pool = [prose(k, 8) for k in range(12)]
    for k in range(40):
        body = []
        for _ in range(r.randrange(1, 5)):
            line = r.choice(pool)
            for _ in range(r.choice((0, 0, 1, 2, 3))):
                at = r.randrange(len(line))
                line = line[:at] + r.choice(("", "q", line[at] + "z")) + line[at + 1:]
            body.append(line)
        rows.append((k, "\n".join([*body, "short line", ""])))
    return rows


def test_line_classes_equal_sql(frame):
    rows = line_rows()
    found = sorted(map(tuple, lines.line_classes(frame(rows)).drop("tsig").collect()))
    with duckdb.connect() as con:
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
        assert found == sorted(con.execute(lines.oracle()).fetchall())
    assert any(x[4] for x in found) and any(not x[5] for x in found)


def test_dropped_lines(frame):
    a, b, c = (f"this is the {k} line of the example text" for k in ("first", "second", "next"))
    rows = [(1, f"{a}\n\n{b}"), (2, f"{b}!\nshort\n{c}"), (3, f"{a}\n{b}"), (4, None), (5, ""), (6, "short"), (7, "short"), (7, "short"),
            (None, c), (None, f"{c}\nand one more line, quite different")]
    out = lines.drop_lines(frame(rows))
    assert out.columns == frame(rows).columns
    # "short" stands first in document 2, so documents 6 and 7 hold nothing else.
    assert sorted((str(r.doc_id), r.text, r.n_chars) for r in out.collect() if r.text is not None) == sorted([
        ("1", rows[0][1], len(rows[0][1])), ("2", f"short\n{c}", len(c) + 6), ("5", "", 0), ("None", "and one more line, quite different", 34),
    ])
    assert lines.drop_lines(frame([])).collect() == [] and lines.line_classes(frame(ODD_ROWS[:8])).count() == 5
