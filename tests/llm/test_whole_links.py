"""Links of near classes, against all pairs."""

import itertools

from barforge.llm import order_minhash
from barforge.llm.align import edit_distance
from tests.llm.conftest import prose


def test_links_of_a_class_equal_brute_force(frame):
    rows = []
    for g in range(3):
        base = prose(400 + g, 120).split(" ")
        rows.append((100 * g, " ".join(base)))
        for k in range(6):  # each differs from the others in two words at most
            copy = list(base)
            copy[15 * k + 10] = f"changed{k}"
            rows += [(100 * g + 2 * k + 1, " ".join(copy)), (100 * g + 2 * k + 2, " ".join(copy).upper())]
    rows += [(900 + k, prose(950 + k, 120)) for k in range(5)]
    classes = {tuple(t.lower().split(" ")) for _, t in rows}
    links = dict.fromkeys(classes, 0)
    for a, b in itertools.combinations(classes, 2):
        if edit_distance(a, b, max(len(a), len(b)) // 5) is not None:
            links[a] += 1
            links[b] += 1
    found = {r.doc_id: (r.group_id, r.links) for r in order_minhash.near_groups(frame(rows)).collect()}
    assert {i: n for i, (_, n) in found.items()} == {i: links[tuple(t.lower().split(" "))] for i, t in rows}
    connected = {r.doc_id: r.group_id for r in order_minhash.near_groups(frame(rows), whole=False).collect()}
    assert connected == {i: g for i, (g, _) in found.items()}
