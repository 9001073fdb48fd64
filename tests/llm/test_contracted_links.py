"""Components of dense groups are found from few rows."""

import random

from barforge.llm import components


def test_contracted_components_equal_brute_force(spark, monkeypatch):
    r, links = random.Random(5), []
    links += [(k, k + 1) for k in range(40)]
    links += [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(45)]
    links += [(a, b) for a in range(200, 230) for b in range(a + 1, 230)]
    links += [(a, r.choice((300, 301, 302))) for a in range(303, 340)] + [(340, 400), (400, 339), (9, 9), (500, 500)] * 2
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    written, write = [], components.materialise

    def counted(df, name):
        out = write(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(components, "materialise", counted)
    found = {x.node: x.component for x in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {x for x in parent if not any(x in link and link[0] != link[1] for link in links)}
    assert found == {x: root(x) for x in parent if x not in alone}
    # The second list of links is what the rounds read, both ways: less than one way of all distinct links.
    (_, all_links), (_, read) = [w for w in written if w[0] == "links"]
    assert read < all_links / 2
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).collect() == []
