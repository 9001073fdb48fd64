"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line counts as repeated if an earlier line (by document, then place) is
equal or within the edit budget of the shorter of the two: ``MAX_EDITS`` from
``MIN_CHARS`` characters on, below that the same share of the length, rounded
down (1 from 10 characters on), so that it falls to 0 and the shortest lines
repeat only if they are equal.  Every distinct line of n characters and budget
e is indexed by its e + 1 segments; a line probes the indexes of its own
length and of up to MAX_EDITS characters less, with just those substrings that
a match can shift to (the multi-match-aware window of segment joins).  Lines
that share a segment and whose letter counts can be that near are candidates;
they are verified by ``levenshtein`` with its threshold, which computes the
band around the diagonal only.

Every line takes part but blank ones, which are left alone.
Equal lines are gathered first, so a line in a third of all documents is one
row of the join.  The letter counts are part of the join's condition: rows
that cannot match are not made, also in a large group with a common segment.

Defined cases: a null text has no line, an empty text one empty line; ids that
are null come last in the order; rows equal in ``doc_id`` and text are one
document, whose lines are kept or go together; empty tables give empty
results; other columns are not read, or are kept as they are by ``drop_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import free_name, materialise, probably_in

MAX_EDITS = 2
#: Characters from which a line has all its edits.
MIN_CHARS = 20
#: Letters that the SQL twin counts for its filter (fixed: frequent ones of Latin scripts).
COUNTED = "entairos"
#: Letters that are counted here, one after the other: twice as many, so that fewer far lines meet.
LETTERS = COUNTED + "hldcumfp"
#: Bits of a count.
COUNT_BITS = 4


def probe_places(edits: int = MAX_EDITS) -> list[tuple[int, int, int]]:
    """(characters less, segment, shift) of all substrings by which a line meets one as long or shorter."""
    k, out = edits + 1, []
    for less in range(edits + 1):
        for i in range(1, k + 1):
            for shift in range(max(1 - i, less - (k - i)), min(i - 1, less + (k - i)) + 1):
                out.append((less, i, shift))
    return out


def edit_budget(n: Column, edits: int = MAX_EDITS) -> Column:
    """Edits by which a line of n characters may differ from one as long or longer."""
    return F.least(F.lit(edits), F.floor(n * edits / MIN_CHARS).cast("int"))


def segment_keys(line: Column, n: Column, edits: int = MAX_EDITS) -> Column:
    """Key and role (2 probing, 3 indexed as well) of every place: hash of the length, the segment's number (from 1) and its text.

    A line's own segments stand among the places that it probes, unshifted.
    Only places whose indexed length has the budget they were made for; the
    last segments of a line take the remainder of its length.  One lambda over
    the places keeps the compiled code small.
    """
    names = ("less", "i", "shift", "budget", "role")
    places = [
        (less, i, shift, budget, 3 if less == shift == 0 else 2)
        for budget in range(1, edits + 1)
        for less, i, shift in probe_places(budget)
    ]

    def array(some: list[tuple[int, ...]]) -> Column:
        return F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(names, p))) for p in some))

    wanted = F.when(n >= MIN_CHARS + edits, array([p for p in places if p[3] == edits])).otherwise(
        F.filter(array(places), lambda p: edit_budget(n - p["less"], edits) == p["budget"])
    )

    def keys_of(text: Column) -> Column:
        def key(p: Column) -> Column:
            length, k = n - p["less"], p["budget"] + 1
            base, longer = F.floor(length / k).cast("int"), (length % k).cast("int")
            start = 1 + (p["i"] - 1) * base + F.greatest(F.lit(0), p["i"] - 1 - (k - longer)) + p["shift"]
            size = base + F.when(p["i"] > k - longer, 1).otherwise(0)
            return F.struct(F.xxhash64(length, p["i"], F.substring(text, start, size)).alias("key"), p["role"].alias("role"))

        return F.transform(wanted, key)

    # Where all characters are single bytes, a place in bytes needs no counting
    # of characters; the hash of equal bytes is the same.
    return F.when(F.octet_length(line) == n, keys_of(line.cast("binary"))).otherwise(keys_of(line))


def _letters(line: Column) -> Column:
    """Counts of the letters modulo 16, four bits each, in one number.

    A letter is taken out of what the ones before it have left, so every step
    reads a shorter text.
    """
    out, rest = F.lit(0).cast("long"), line
    for c in LETTERS:
        less = F.replace(rest, F.lit(c), F.lit(""))
        count = (F.octet_length(rest) - F.octet_length(less)).bitwiseAND(F.lit(2**COUNT_BITS - 1))
        out, rest = F.shiftleft(out, COUNT_BITS).bitwiseOR(count.cast("long")), less
    return out


def _letter_distance(a: Column, b: Column) -> Column:
    """At most the sum of the differences of all counts: each is taken the shorter way round."""
    most = 2**COUNT_BITS

    def count(x: Column, k: int) -> Column:
        return F.shiftrightunsigned(x, COUNT_BITS * k).bitwiseAND(F.lit(most - 1))

    out = F.lit(0).cast("long")
    for k in range(len(LETTERS)):
        apart = F.abs(count(a, k) - count(b, k))
        out = out + F.least(apart, most - apart)
    return out


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, tsig, line_no (from 0) and line of every line that takes part."""
    # What stands beside an explode is computed for each of its rows: all else comes first.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tsig"), "text").select(
        "doc_id", "tsig",
        # An outer explode: an inner one would split the texts again for a filter.
        F.posexplode_outer(F.split("text", "\n", -1)).alias("line_no", "line"),
    )
    return rows.where(F.col("line").rlike(r"\S"))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def near_lines(docs: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """Links (a, b, edits) between different lines, by their digests."""
    texts = _lines(docs).select(
        "line", F.length("line").alias("n"), F.xxhash64("line").alias("id"), _letters(F.col("line")).alias("letters")
    )

    long_enough = texts.where(edit_budget(F.col("n"), edits) > 0)
    keys = segment_keys(F.col("line"), F.col("n"), edits)
    each = long_enough.select("id", "letters", F.explode_outer(keys).alias("at")).select("id", "letters", "at.key", "at.role")
    # One scan and one shuffle by key for both sides of the join; equal lines
    # are one row where they meet, with the roles in which the key is theirs.
    each = each.repartition("key").groupBy("key", "id", "letters").agg(F.bit_or("role").alias("roles"))
    index = each.where(F.col("roles").bitwiseAND(F.lit(1)) != 0).select("key", F.col("id").alias("ia"), F.col("letters").alias("la"))
    probe = each.where(F.col("roles").bitwiseAND(F.lit(2)) != 0).select("key", F.col("id").alias("ib"), F.col("letters").alias("lb"))
    near = _letter_distance(F.col("la"), F.col("lb")) <= 2 * edits
    met = index.join(probe, (index["key"] == probe["key"]) & (F.col("ia") != F.col("ib")) & near)
    pairs = materialise(met.select(F.least("ia", "ib").alias("ia"), F.greatest("ia", "ib").alias("ib")).distinct(), "line-pairs")
    wanted = materialise(pairs.select(F.col("ia").alias("id")).unionAll(pairs.select(F.col("ib").alias("id"))).distinct(), "line-ids")
    # Most texts are in no pair: they stay where they are.
    some = probably_in(texts.select("id", "line"), "id", wanted)
    found = materialise(some.join(wanted, "id", "left_semi").distinct(), "line-texts")
    both = pairs.join(found.select(F.col("id").alias("ia"), F.col("line").alias("x")), "ia")
    both = both.join(found.select(F.col("id").alias("ib"), F.col("line").alias("y")), "ib")
    most = edit_budget(F.least(F.length("x"), F.length("y")), edits)
    measured = both.select("x", "y", F.levenshtein("x", "y", edits).alias("edits"), most.alias("most")).where("edits between 1 and most")
    return measured.select(_digest(F.col("x")).alias("a"), _digest(F.col("y")).alias("b"), "edits")


def line_classes(docs: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """One row per line that takes part: where its class (equal lines) first stands, its links, whether it is kept."""
    seen = materialise(
        _lines(docs).select("doc_id", "tsig", "line_no", _digest(F.col("line")).alias("digest")), "lines"
    )
    # Ids that are null are ordered last.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tsig", "line_no")
    firsts = seen.groupBy("digest").agg(F.min(place).alias("first"))
    links = materialise(near_lines(docs, edits), "line-links")
    ends = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = ends.join(firsts.select(F.col("digest").alias("b"), F.col("first").alias("other")), "b")
    near = near.groupBy(F.col("a").alias("digest")).agg(F.min("other").alias("earlier"), F.count(F.lit(1)).alias("links"))
    classes = firsts.join(near, "digest", "left")
    kept = (place == F.col("first")) & F.coalesce(F.col("first") < F.col("earlier"), F.lit(True))
    return seen.join(classes, "digest").select(
        "doc_id", "tsig", "line_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"), kept.alias("kept"),
    )


def drop_lines(docs: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """The rows, with all their columns, without repeated lines; ``n_chars`` follows the text.

    A document of which only blank text is left goes.
    """
    missing, id_, sig, cut_text = (free_name(docs, name) for name in ("__gone", "__id", "__sig", "__text"))
    gone = line_classes(docs, edits).where("not kept").groupBy("doc_id", "tsig").agg(F.collect_set("line_no").alias(missing))
    gone = gone.select(F.col("doc_id").alias(id_), F.col("tsig").alias(sig), missing)
    same = (F.xxhash64(docs["text"]) == gone[sig]) & docs["doc_id"].cast("long").eqNullSafe(gone[id_])
    joined = docs.join(gone, same, "left")
    # Sections between kept lines are joined again by line breaks.
    rest = F.array_join(
        F.filter(F.split("text", "\n", -1), lambda line, k: ~F.array_contains(F.col(missing), k)), "\n"
    )
    text = F.when(F.col(missing).isNull(), F.col("text")).otherwise(rest)
    cut = joined.withColumn(cut_text, text).where(F.col(missing).isNull() | F.col(cut_text).rlike(r"\S"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col(cut_text).alias("text"))
        elif name == "n_chars":
            length = F.length(cut_text).cast(docs.schema["n_chars"].dataType)
            columns.append(F.when(F.col(missing).isNull(), F.col("n_chars")).otherwise(length).alias("n_chars"))
        else:
            columns.append(F.col(name))
    return cut.select(*columns)


def oracle(edits: int = MAX_EDITS) -> str:
    """``line_classes`` (without tsig) in DuckDB SQL, for unique ids."""
    counts = ", ".join(f"length(line) - length(replace(line, '{c}', '')) AS c{k}" for k, c in enumerate(COUNTED))
    apart = " + ".join(f"abs(x.c{k} - y.c{k})" for k in range(len(COUNTED)))
    return f"""
WITH each AS (
  SELECT doc_id, unnest(generate_series(0, len(ls) - 1)) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
seen AS (SELECT * FROM each WHERE regexp_matches(line, '\\S')),
firsts AS (
  SELECT line, row_number() OVER (ORDER BY fd, fl) AS ord, fd, fl, length(line) AS n, {counts}
  FROM (SELECT line, min(doc_id) AS fd, arg_min(line_no, doc_id * 1000000 + line_no) AS fl FROM seen GROUP BY line)),
links AS (
  SELECT x.line AS a, y.ord AS other
  FROM (SELECT *, unnest(generate_series(n - {edits}, n + {edits})) AS m FROM firsts WHERE n * {edits} >= {MIN_CHARS} - {edits} * {edits}) x
  JOIN firsts y ON y.n = x.m AND x.ord <> y.ord AND {apart} <= {2 * edits}
  WHERE levenshtein(x.line, y.line) <= least({edits}, least(x.n, y.n) * {edits} // {MIN_CHARS})),
near AS (SELECT a, min(other) AS earlier, count(*) AS links FROM links GROUP BY a)
SELECT s.doc_id, CAST(s.line_no AS INTEGER) AS line_no, f.fd AS first_doc_id, CAST(f.fl AS INTEGER) AS first_line_no,
  coalesce(links, 0) AS links,
  s.doc_id = f.fd AND s.line_no = f.fl AND coalesce(f.ord < earlier, true) AS kept
FROM seen s JOIN firsts f USING (line) LEFT JOIN near ON near.a = s.line"""
