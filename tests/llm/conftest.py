import random

import pytest

VOCABULARY = "the of and to in river stone cloud green paper window morning quiet letter garden copper signal harbor winter yellow".split()


def prose(seed: int, n: int) -> str:
    """n words of invented prose."""
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture()
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use inside."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), 1, "k") for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, key int, words string"
        )

    return make


#: Nulls in both columns, empty and blank texts, ties, repeated rows, a long text.
ODD_ROWS = [
    (1, None), (2, ""), (3, "   "), (None, "a lonely text"), (4, "same"), (4, "same"), (5, "é🙂 ñandú\tx  y\n\nz"),
    (None, None), (6, "word " * 30_000), (-7, "a lonely text"),
]
