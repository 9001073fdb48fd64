"""Filter audit, shards and token alignment."""

import json
import random
from collections import Counter
from itertools import permutations
import hashlib
import zlib

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barforge.llm import filter_audit, sharding, token_alignment
from barforge.llm.word_cache import _BYTE_SYMBOLS
from tests.llm.conftest import ODD_ROWS, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- op11


def plain_counts(text):
    words = [w for w in text.replace("\x1c", "x").encode().split()]
    return [len(words), len(set(words)), sum("A" <= c <= "Z" for c in text), len(text), sum(c in "#$%&*|" for c in text)]


def odd_texts():
    r = random.Random(3)
    bits = ["a", "B", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "é", "日本", "🙂", "#", "|", "the", "The", "\x1c", "\x00", " "]
    return ["".join(r.choice(bits) for _ in range(r.randrange(60))) for _ in range(400)] + ["", " ", "x", prose(1, 500)]


def test_transducer_counts_as_a_plain_reading():
    texts = odd_texts()
    assert filter_audit.run([t.encode() for t in texts]).tolist() == [plain_counts(t) for t in texts]


def test_long_texts_go_in_pieces(monkeypatch):
    texts = odd_texts() + ["y" * 500, "z" * 300 + " " + "z" * 300 + " end"]
    expected = [plain_counts(t) for t in texts]
    monkeypatch.setattr(filter_audit, "BLOCK", 64)
    assert filter_audit.run([t.encode() for t in texts]).tolist() == expected


def test_table_verifies_spans_with_equal_hashes(monkeypatch):
    import numpy as np

    # All hashes equal: only the bytes tell the words apart.
    monkeypatch.setattr(filter_audit, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    texts = ["a b a c aa b", "a a a", "q"]
    assert [x[:2] for x in filter_audit.run([t.encode() for t in texts]).tolist()] == [[6, 4], [3, 1], [1, 1]]


def plain_audit(rows, labels):
    """The audit of (doc_id, text, lang) rows, one order and document at a time."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    docs = []
    for i, text, lang in rows:
        text = text or ""
        n, distinct, capitals, points, symbols = plain_counts(text)
        order = (i is None, i or 0)
        copy = any((t or "") == text and (j is None, j or 0) < order for j, t, _ in rows)
        fails = {k for k, f in zip("ABCDE", (n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * points, symbols > 0, copy)) if f}
        docs.append((lang or "", fails, i in good, i in toxic))
    shapley, out = Counter(), []
    for order in permutations("ABCDE"):
        for part, fails, *_ in docs:
            shapley[part, next((k for k in order if k in fails), "")] += 1
    for part in {d[0] for d in docs}:
        mine = [d[1:] for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[:step - 1])
                kept = [d for d in mine if not d[0] & (before | {letter})]
                gone = [d for d in mine if letter in d[0] and not d[0] & before]
                out.append((part, "".join(order), step, len(kept), len(gone), sum(letter in d[0] and bool(d[0] & before) for d in mine),
                            sum(d[0] == {letter} for d in mine), sum(d[1] for d in gone), sum(d[2] for d in gone), shapley[part, letter]))
    return sorted(out)


def audit_rows():
    r = random.Random(8)
    texts = [prose(k, n) for k, n in enumerate((20, 120, 130, 99, 100, 200))] + ["", "AB cd", "x # y", " ".join(["same"] * 120)]
    rows = [(k, r.choice(texts) + r.choice(("", "", "!", " $")), r.choice(("en", "de", None, ""))) for k in range(60)]
    rows += [(None, texts[0], "en"), (None, texts[0], "en"), (None, "alone", "xx"), (3, rows[3][1], "en"), (70, None, "en"), (71, None, "fr")]
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 60, 2)] + [(1, None, None), (1, 1, 0), (None, 1, 1), (2, 0, 1)]
    return rows, labels


def test_audit_equals_plain_and_sql(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS part", "2 AS digest", "3 AS words")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = filter_audit.audit_documents(docs, marks)
    found = sorted(map(tuple, out.collect()))
    assert found == plain_audit(rows, [x for x in labels if x[0] is not None])
    with duckdb.connect() as con:
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
        con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
        con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
        rel = con.sql(filter_audit.oracle())
        assert rel.columns == out.columns and sorted(rel.fetchall()) == found


def test_audit_of_odd_rows(frame, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_documents(frame([]), none).collect() == []
    out = filter_audit.audit_documents(frame(ODD_ROWS), none).collect()
    assert len(out) == 600 and {r.kept + r.removed + r.redundant for r in out if r.step == 1} == {len(ODD_ROWS)}


# --- op12


def laws(rows, shards=24):
    """Every shard's slots are gapless; returns bytes per shard."""
    slots, sizes = {}, Counter()
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    return sizes


def test_shards_are_near_equal_and_groups_whole(frame, monkeypatch):
    r = random.Random(2)
    rows = [(k, prose(k, r.randrange(1, 60))) for k in range(1500)]
    rows += [(2000 + k, prose(k % 30, 25)) for k in range(90)]  # small groups of copies
    out = sharding.report(frame(rows).repartition(5), 8).collect()
    assert sorted((x.doc_id, x.size, x.text_crc32) for x in out) == sorted(
        (i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in rows)
    sizes = laws(out, 8)
    share = sum(sizes.values()) / 8
    assert max(abs(s - share) for s in sizes.values()) <= share / sharding.WHOLE
    shard_of = {x.doc_id: x.shard for x in out}
    assert all(len({shard_of[2000 + k] for k in range(g, 90, 30)}) == 1 for g in range(30))
    assert {(x.law, x.grown_shard) for x in out} == {("bytes", None)}


@pytest.mark.parametrize("hot", ["", "the very same text " * 20])
def test_hot_text_is_spread(frame, hot):
    rows = [(k, prose(k, 30)) for k in range(600)] + [(1000 + k, hot) for k in range(400)] + [(7, hot)] * 200
    out = sharding.report(frame(rows).repartition(3), 6).collect()
    sizes = laws(out, 6)
    share = sum(sizes.values()) / 6
    assert len(out) == len(rows) and max(abs(s - share) for s in sizes.values()) <= share / 8


def test_shards_of_odd_rows(frame, spark, scratch):
    out = sharding.report(frame(ODD_ROWS)).collect()
    assert sorted((str(x.doc_id), x.size) for x in out) == sorted((str(i), len((t or "").encode()) + 8) for i, t in ODD_ROWS)
    laws(out)
    assert sharding.report(frame([])).collect() == []
    # Columns with the names that are used inside stay as they are.
    docs = frame(ODD_ROWS).selectExpr("*", "'x' AS shard", "9 AS Slot", "1.5 AS record", "2 AS position", "3 AS size")
    kept = sharding.shard_documents(docs, 3, f"{scratch}/files")
    assert kept.columns == [*docs.columns, "shard_", "slot_"]
    assert sorted(map(str, kept.select(docs.columns).collect())) == sorted(map(str, docs.collect()))


# --- op13


def plain_alignment(texts):
    """Per text (n_a, n_b, groups, links as id pairs), token by token with the libraries themselves."""
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {s: b for b, s in _BYTE_SYMBOLS.items()}

    def piece(i):
        name = sp.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if sp.is_byte(i) else name.replace("▁", " ").encode()

    out = []
    for text in texts:
        a = [(i, bytes(byte_of[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, piece(i)) for i in sp.encode(text)] if text else []
        data = (" " + (text or "")).encode()
        if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            out.append((0, 0, "", []))
            continue

        def spans(tokens):
            at, found = 0, []
            for i, x in tokens:
                found.append((at, at + len(x), i))
                at += len(x)
            return found

        a, b = spans(a), spans(b)
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in a} & {y[1] for y in b})
        groups = ";".join(
            ",".join(str(x[2]) for x in a if p < x[1] <= q) + "|" + ",".join(str(y[2]) for y in b if p < y[1] <= q)
            for p, q in zip([0, *ends], ends))
        out.append((len(a), len(b), groups, links))
    return out


def plain_report(rows):
    each = plain_alignment([t for _, t in rows])
    count = Counter(p for *_, links in each for p in set(links))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(n, best.get(a, 0))
    return sorted(
        (str(i), n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(count[p] == best[p[0]] for p in links),
         sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for (i, _), (n_a, n_b, groups, links) in zip(rows, each))


def alignment_texts():
    r = random.Random(6)
    bits = ["a", "Word", "don't", " ", " ", "\n", "  ", "'s", "é", "É", "22", ".", "!!", ",", "<|endoftext|>", "<s>", "\x01", "\x00",
            "▁", "日本", "\t", "-", "\r\n", "🙂", "İ", "_x", "ﬁ", "́", "thheingble", "Inlyin", " "]
    return ["".join(r.choice(bits) for _ in range(r.randrange(20))) for _ in range(250)] + [prose(k, 40) for k in range(20)] + ["", None]


def test_alignment_equals_brute_force(frame, monkeypatch):
    rows = [(k % 200, t) for k, t in enumerate(alignment_texts())] + [(None, "a lonely text"), (5, "a lonely text")]
    monkeypatch.setattr(token_alignment, "BLOCK_CHARS", 400)
    out = token_alignment.report(frame(rows).repartition(3), A, B).collect()
    assert sorted((str(x[0]), *x[1:]) for x in out) == plain_report(rows)
    assert any(x[1] for x in out) and any(not x[1] for x in out)


def test_memo_that_starts_anew_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_alignment, "MEMO_WINDOWS", 5)
    both = token_alignment.Aligner(A, B)
    texts = alignment_texts()
    for k in range(0, len(texts), 40):
        some = texts[k:k + 40]
        found = both.align(some)
        assert found["groups"] == [x[2] for x in plain_alignment(some)]


def test_byte_tokens_equal_the_library_for_every_character():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"x{c}y{c}1{c}" for c in points[k:k + 200]) for k in range(0, len(points), 200)]
    plain = t.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)
    assert all(a.tolist() == b.ids for a, b in zip(token_alignment.ByteTokenizer(A).token_ids(texts), plain))


def test_alignment_of_odd_rows(frame):
    assert token_alignment.report(frame([]), A, B).collect() == []
    out = token_alignment.align_documents(frame(ODD_ROWS), A, B, keep_groups=True).collect()
    # The long row is 30,000 times the same word: its groups are those of 50, and 29,950 more in the middle.
    plain = plain_alignment([t if t is None or len(t) < 1000 else t[:250] for _, t in ODD_ROWS])
    for k, (i, t) in enumerate(ODD_ROWS):
        if t and len(t) >= 1000:
            head, *_, tail = plain[k][2].split(";")
            assert plain[k][2] == ";".join([head] * 50 + [tail])
            plain[k] = (0, 0, ";".join([head] * 30_000 + [tail]))
    assert sorted((str(x.doc_id), x.groups) for x in out) == sorted((str(i), p[2]) for (i, _), p in zip(ODD_ROWS, plain))
