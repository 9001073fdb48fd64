"""Document fingerprints: I-Match with randomised lexicon subsets.

The lexicon keeps the terms whose document frequency lies in a chosen band
(``LOW`` to ``HIGH`` of all documents).  Its size is bounded whatever the
corpus: a document holds some hundred distinct terms, and every lexicon term
takes ``LOW`` of all documents, so there are at most (mean distinct terms) /
LOW terms.  Every level cuts the lexicon at random into parts and uses some of
them as subsets; a document's sorted distinct terms of a subset are hashed.
The fingerprint lists the hashes of the subsets in which the document has
terms.  Likeness is the share of equal hashes among the subsets that either
document has: subsets of many sizes make it fall gradually with the edits.

DataFrame functions only.  Defined cases: a null text counts as empty; a text
without lexicon terms has the digest of itself instead (subset 99), so only
equal ones are alike; rows with a null ``doc_id`` come last in the
order, by the text's hash, as do rows that share a ``doc_id``; a single row is
its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import materialise

#: Document frequency of lexicon terms, in thousandths of all documents.
LOW, HIGH = 2, 250
#: (parts a level cuts the lexicon into, how many of them are used).
LEVELS = ((16, 16), (64, 24), (256, 28), (1024, 24))
#: Documents in one run of the order.
RUN_ROWS = 1000
_BREAK = r"[^\p{L}\p{N}]+"
_WHOLE = "99"


def subset_names(levels=LEVELS) -> list[tuple[int, int, str]]:
    """(level, part, two-digit name) of every subset."""
    slots = [(k, part) for k, (_, used) in enumerate(levels) for part in range(used)]
    return [(k, part, f"{n:02d}") for n, (k, part) in enumerate(slots)]


def terms(text: Column) -> Column:
    """Distinct lower-case terms."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _BREAK)), "")


def lexicon(docs: DataFrame, low: int = LOW, high: int = HIGH, levels=LEVELS) -> DataFrame:
    """Terms within the frequency band, with the numbers of the subsets that hold them."""
    n = docs.count()
    # An outer explode: an inner one would compute the terms again for a filter.
    each = docs.select(F.explode_outer(terms(F.col("text"))).alias("term")).where("term is not null")
    df = each.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = df.where((F.col("df") * 1000 >= n * low) & (F.col("df") * 1000 <= n * high))
    digest, slots, name = F.md5("term"), [], 0
    for k, (parts, used) in enumerate(levels):
        # Six hexadecimal digits for each level, from one digest.
        part = F.conv(F.substring(digest, 1 + 6 * k, 6), 16, 10).cast("long") % parts
        slots.append(F.when(part < used, (part + name).cast("int")))
        name += used
    return kept.select("term", F.array_compact(F.array(*slots)).alias("subsets"))


def _runs(docs: DataFrame, run_rows: int) -> DataFrame:
    """Adds ``run``: a range of ids with about ``run_rows`` rows; null ids by hash, below 0."""
    one = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, n = one["lo"] or 0, max(1, one["n"])
    width = max(1, -(-((one["hi"] or 0) - lo + 1) * run_rows // n))
    by_hash = F.pmod(F.xxhash64("text"), F.lit(-(-n // run_rows)))
    by_id = F.floor((F.col("doc_id") - F.lit(lo)) / F.lit(width))
    return docs.withColumn("run", F.when(F.col("doc_id").isNull(), -1 - by_hash).otherwise(by_id).cast("long"))


def _before(runs: DataFrame) -> DataFrame:
    """(of_run, run): after the last row of ``of_run`` comes the first of ``run``; one row per run."""
    down = Window.orderBy(F.col("run").desc())
    every = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("run").over(down), F.first("run").over(every))
    return runs.select(F.col("run").alias("of_run"), following.alias("run"))


def in_order(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """Rows with ``next_text``: the text of the next row by descending ``doc_id``, the first's after the last.

    A run is ordered in one task; the runs' first texts (one in ``run_rows``
    rows) are handed to the run before.  Texts are shuffled once, by run.
    """
    docs = _runs(docs, run_rows)
    order = Window.partitionBy("run").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    inside = docs.select(
        "run", "doc_id", "text", F.lead("text").over(order).alias("after"), F.row_number().over(order).alias("place"),
    )
    links = _before(docs.select("run").distinct())
    # The same shuffled rows serve both sides of the join.
    handed = inside.where("place = 1").join(links, "run").select(F.col("of_run").alias("run"), F.col("text").alias("top"))
    return inside.join(handed, "run", "left").select(
        "run", "place", "doc_id", "text", F.coalesce("after", "top").alias("next_text")
    )


def edited(text: Column, other: Column) -> Column:
    """The text whose last half is replaced by as much of the other's beginning."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def _marks(found: Column) -> Column:
    """Subset names with hashes of their sorted terms, of an array of lexicon rows; null if it is empty."""
    each = F.flatten(F.transform(found, lambda t: F.transform(t["subsets"], lambda s: F.struct(s.alias("subset"), t["term"].alias("term")))))

    def mark(acc: Column) -> Column:
        one = F.concat(F.lpad(acc["subset"].cast("string"), 2, "0"), F.substring(F.md5(acc["text"]), 1, 8))
        return F.when(acc["subset"] < 0, acc["marks"]).otherwise(F.concat(acc["marks"], F.array(one)))

    def step(acc: Column, x: Column) -> Column:
        more = F.struct(acc["marks"].alias("marks"), acc["subset"].alias("subset"), F.concat_ws(" ", acc["text"], x["term"]).alias("text"))
        new = F.struct(mark(acc).alias("marks"), x["subset"].alias("subset"), x["term"].alias("text"))
        return F.when(x["subset"] == acc["subset"], more).otherwise(new)

    first = F.struct(F.array().cast("array<string>").alias("marks"), F.lit(-1).alias("subset"), F.lit("").alias("text"))
    # In the order of subsets and terms every subset is one run.
    return F.when(F.size(found) > 0, F.aggregate(F.array_sort(each), first, step, mark))


def fingerprint(docs: DataFrame, lex: DataFrame) -> DataFrame:
    """run, place, doc_id, n_chars, edited_sha256, ``own`` and ``other``: marks of the text and its edited text.

    Terms are expanded, matched with the lexicon and gathered again inside the
    run's partition: one shuffle of the texts in all.
    """

    def whole(text: Column) -> Column:
        return F.concat(F.lit(_WHOLE), F.substring(F.md5(text), 1, 8))

    rows = in_order(docs).withColumn("edited", edited(F.col("text"), F.col("next_text"))).select(
        "run", "place", "text", "edited",
        F.struct(
            "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            whole(F.col("text")).alias("own"), whole(F.col("edited")).alias("other"),
        ).alias("info"),
    )
    # One entry per side and term, and one that carries the row itself.
    each = rows.select("run", "place", "info", F.posexplode(F.array(F.col("text"), F.col("edited"), F.lit(None))))
    each = each.select("run", "place", F.col("pos").alias("side"), F.when(F.col("pos") == 2, F.col("info")).alias("info"),
                       F.explode_outer(terms(F.col("col"))).alias("term"))
    # The lexicon's size is bounded by its band (see the module's docstring).
    hits = each.join(F.broadcast(lex), "term", "left").where("side = 2 or subsets is not null")
    found = F.struct("term", "subsets")
    lists = hits.groupBy("run", "place").agg(
        F.max("info").alias("info"),
        F.collect_list(F.when(F.col("side") == 0, found)).alias("own"),
        F.collect_list(F.when(F.col("side") == 1, found)).alias("other"),
    )
    marks = (F.coalesce(_marks(F.col(k)), F.array(F.col("info")[k])).alias(k) for k in ("own", "other"))
    return lists.select("run", "place", "info.doc_id", "info.n_chars", "info.edited_sha256", *marks)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either has."""
    same = F.size(F.array_intersect(a, b))
    names = F.transform(F.concat(a, b), lambda m: F.substring(m, 1, 2))
    return (same / F.size(F.array_distinct(names))).cast("double")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and their likeness."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = materialise(fingerprint(texts, lexicon(texts)), "marks")
    order = Window.partitionBy("run").orderBy("place")
    links = _before(rows.select("run").distinct())
    handed = rows.where("place = 1").join(links, "run").select(F.col("of_run").alias("run"), F.col("own").alias("top"))
    following = rows.withColumn("after", F.lead("own").over(order)).join(handed, "run", "left")
    out = following.withColumn("next", F.coalesce("after", "top"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256",
        F.array_join("own", " ").alias("fingerprint"), F.array_join("other", " ").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def oracle(low: int = LOW, high: int = HIGH, levels=LEVELS) -> str:
    """The same result in DuckDB SQL."""
    parts = ", ".join(f"CAST('0x' || substr(md5(term), {1 + 6 * k}, 6) AS BIGINT) % {m} AS p{k}" for k, (m, _) in enumerate(levels))
    slots = ", ".join(f"({k}, {part}, '{name}')" for k, part, name in subset_names(levels))
    on = " OR ".join(f"(s.level = {k} AND l.p{k} = s.part)" for k in range(len(levels)))
    words = f"list_filter(list_distinct(string_split_regex(lower(%s), '{_BREAK}')), lambda w: w <> '')"
    return f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS rid, doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT *, coalesce(lead(text) OVER (ORDER BY rid), first_value(text) OVER (ORDER BY rid)) AS nxt FROM d),
e AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(nxt, 1, length(text) // 2) AS edited FROM c),
sides AS (SELECT rid, 0 AS side, text AS t FROM e UNION ALL SELECT rid, 1, edited FROM e UNION ALL SELECT rid, 2, nxt FROM e),
w AS (SELECT rid, side, {words % 't'} AS ws FROM sides),
df AS (SELECT term, count(*) AS df FROM (SELECT unnest(ws) AS term FROM w WHERE side = 0) GROUP BY term),
lex AS (SELECT term, {parts} FROM df WHERE df * 1000 >= {low} * (SELECT count(*) FROM d) AND df * 1000 <= {high} * (SELECT count(*) FROM d)),
slots(level, part, name) AS (VALUES {slots}),
own AS (
  SELECT rid, side, s.name, string_agg(x.term, ' ' ORDER BY x.term) AS t
  FROM (SELECT rid, side, unnest(ws) AS term FROM w) x JOIN lex l USING (term) JOIN slots s ON {on}
  GROUP BY rid, side, s.name),
found AS (SELECT rid, side, list(name || substr(md5(t), 1, 8) ORDER BY name) AS marks FROM own GROUP BY rid, side),
marks AS (
  SELECT rid, side, coalesce(marks, ['{_WHOLE}' || substr(md5(t), 1, 8)]) AS marks
  FROM sides LEFT JOIN found USING (rid, side))
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(a.marks, ' ') AS fingerprint, array_to_string(b.marks, ' ') AS edited_fingerprint,
  len(list_intersect(a.marks, b.marks)) / len(list_distinct([substr(x, 1, 2) for x in list_concat(a.marks, b.marks)])) AS near_edited,
  len(list_intersect(a.marks, n.marks)) / len(list_distinct([substr(x, 1, 2) for x in list_concat(a.marks, n.marks)])) AS near_next
FROM e JOIN marks a ON a.rid = e.rid AND a.side = 0 JOIN marks b ON b.rid = e.rid AND b.side = 1 JOIN marks n ON n.rid = e.rid AND n.side = 2"""
