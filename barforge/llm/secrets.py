"""Secret scan through a trigram inverted index, in DataFrame functions only.

From every rule's regular expression a Boolean trigram query is derived: an OR
of clauses, each an AND of trigrams that a match must hold.  ``build_index``
writes postings (trigram, doc_id) of all documents, for the trigrams that the
rules need or for all trigrams; ``candidates`` intersects them.  Only candidate
documents are verified by the expression itself; a rule without a mandatory
trigram is verified on every document.

Defined cases: a null text counts as empty; rows with a null ``doc_id`` cannot
be posted and are always verified; rows that share a ``doc_id`` are candidates
together and verified one by one; an empty table gives an empty result.  Other
columns are not read.  Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import materialise

#: Clauses a rule may expand to before it counts as having no mandatory trigram.
MAX_CLAUSES = 64


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if its group has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
#: What the method adds: private key headers and signed web tokens.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of ANDs of lower-case trigrams that every match holds; None: no condition."""
    clauses = {text for text in _literals(sre_parser.parse(pattern))}
    grams = {frozenset(run[k: k + 3] for run in text.split("\0") for k in range(len(run) - 2)) for text in clauses}
    if not grams or len(grams) > MAX_CLAUSES or frozenset() in grams:
        return None
    return sorted((g for g in grams if not any(h < g for h in grams)), key=sorted)


def _literals(nodes) -> list[str]:
    """All expansions of the literal text; NUL stands where anything may be."""
    out = [""]
    for op, arg in nodes:
        if op is sre.LITERAL:
            more = [chr(arg).lower()]
        elif op is sre.SUBPATTERN:
            more = _literals(arg[-1])
        elif op is sre.BRANCH:
            more = [x for branch in arg[1] for x in _literals(branch)]
        elif op is sre.MAX_REPEAT and arg[:2] == (0, 1):
            more = ["", *_literals(arg[2])]
        elif op is sre.MAX_REPEAT and arg[0] == arg[1] and arg[0] < 16:
            more = [x * arg[0] for x in _literals(arg[2])]
        else:
            more = ["\0"]
        if len(out) * len(more) > MAX_CLAUSES:
            more = ["\0"]
        out = [a + b for a in out for b in more]
    return out


def vocabulary(rules) -> list[str]:
    """The trigrams that the rules' queries name."""
    return sorted({g for r in rules for clause in trigram_query(r.pattern) or [] for g in clause})


def build_index(docs: DataFrame, grams: list[str] | None = None) -> DataFrame:
    """Postings (gram, doc_id) over the lower-case texts of all rows, written.

    ``grams``: only these trigrams (what one set of rules needs), else all.
    """
    low = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("low"))
    low = low.where("doc_id is not null and low is not null")
    if grams is None:
        found = F.array_distinct(F.regexp_extract_all("low", F.lit("(?s)(?=(...))"), F.lit(1)))
    else:
        found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams)))
    # An outer explode: an inner one would search the texts again for a filter.
    postings = low.select("doc_id", F.explode_outer(found).alias("gram")).where("gram is not null")
    return materialise(postings, "secrets-postings")


def candidates(index: DataFrame, rules) -> DataFrame:
    """doc_id and a bit mask of the rules (by position) whose trigram query it meets."""
    need = [
        (g, r, c, 1 << k, (1 << len(clause)) - 1)
        for r, rule in enumerate(rules)
        for c, clause in enumerate(trigram_query(rule.pattern) or [])
        for k, g in enumerate(sorted(clause))
    ]
    spark = index.sparkSession
    # One row per trigram of the rules: fixed by the rules, not by the data.
    wanted = F.broadcast(spark.createDataFrame(need, "gram string, rule int, clause int, bit long, full long"))
    met = (
        index.join(wanted, "gram")
        .groupBy("doc_id", "rule", "clause")
        .agg(F.bit_or("bit").alias("bits"), F.max("full").alias("full"))
        .where("bits = full")
    )
    return met.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of struct(start, order, kind, end) of a rule's matches in a text."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    size_of = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    between = F.split(text, rule.pattern, -1)
    rows = F.arrays_zip(
        F.transform(whole, F.length).alias("n"),
        F.transform(size_of, F.length).alias("g"),
        F.transform(F.slice(between, 1, F.size(whole)), F.length).alias("gap"),
    )
    nothing = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")

    def step(acc: Column, row: Column) -> Column:
        start = acc["at"] + row["gap"]
        end = start + row["n"]
        one = F.struct(
            start.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        kept = F.when(row["g"] >= rule.least, F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    first = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    return F.aggregate(rows, first, step, lambda acc: acc["out"])


def find_secrets(docs: DataFrame, rules=(*BASE_RULES, *MORE_RULES), index: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``found``, its sorted spans."""
    rules = tuple(rules)
    index = build_index(docs, vocabulary(rules)) if index is None else index
    marked = candidates(index, rules).withColumnRenamed("doc_id", "cand_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(marked, texts["doc_id"] == F.col("cand_id"), "left")
    mask = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.coalesce("rules", F.lit(0)))
    nothing = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    found = []
    for k, rule in enumerate(rules):
        flag = F.lit(True) if trigram_query(rule.pattern) is None else F.col("mask").bitwiseAND(F.lit(1 << k)) != 0
        probe = F.col("text").rlike(_probe(rule))
        found.append(F.when(flag & probe, spans(F.col("text"), rule, k)).otherwise(nothing))
    return joined.select("doc_id", "text", mask.alias("mask")).select(
        "doc_id", F.array_sort(F.concat(*found)).alias("found")
    )


def _probe(rule: Rule) -> str:
    """Holds wherever the rule can have a match that counts; for a run of one class, of the least length."""
    if rule.group == 0 and rule.least and rule.pattern.endswith("]+") and rule.pattern.startswith("["):
        return f"{rule.pattern[:-1]}{{{rule.least}}}"
    return rule.pattern


def report(found: DataFrame, base=BASE_RULES) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    kept = F.filter("found", lambda s: s["order"] < len(base))
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(r.kind) for r in base), F.sha2(joined(kept), 256).alias("base_sha256"), joined(F.col("found")).alias("spans")
    )


def oracle() -> str:
    """The same report in DuckDB SQL."""
    parts = []
    for k, r in enumerate((*BASE_RULES, *MORE_RULES)):
        p = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT doc_id, rid, {k} AS ord, '{r.kind}' AS kind, regexp_extract_all(text, '{p}', 0) AS m, "
            f"regexp_extract_all(text, '{p}', {r.group}) AS g, regexp_split_to_array(text, '{p}') AS gaps, "
            f"{r.least} AS least FROM d"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
hits AS ({' UNION ALL '.join(parts)}),
each AS (SELECT doc_id, rid, ord, kind, m, g, gaps, least, unnest(range(1, len(m) + 1)) AS i FROM hits WHERE len(m) > 0),
span AS (
  SELECT rid, ord, kind,
    list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0) AS s,
    length(m[i]) AS n, ord < {len(BASE_RULES)} AS base
  FROM each WHERE length(g[i]) >= least),
agg AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, ord) FILTER (base) AS b,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, ord) AS spans
  FROM span GROUP BY rid)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (rid)"""
