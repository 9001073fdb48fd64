"""Data-quality checks (Q1-Q4). Each check returns its violations as a
DataFrame; an empty result is a pass. ``layer_report`` runs all checks of a
layer in two passes (one aggregate for the column checks, one grouping for
uniqueness) and returns one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.functions import bar_key

REPORT_COLUMNS = ["layer", "check", "column", "violations"]

# The reference's declared tests per layer.
SUITE = {
    "stg_daily_prices": {"not_null": ["date", "symbol", "close"],
                         "unique": ["symbol || '-' || date"], "accepted_values": {}},
    "weekly_prices": {"not_null": ["date", "symbol", "close"],
                      "unique": ["symbol || '-' || date"], "accepted_values": {}},
    "monthly_prices": {"not_null": ["date", "symbol", "close"],
                       "unique": ["symbol || '-' || date"], "accepted_values": {}},
    "weekly_technical_analysis": {
        "not_null": ["date", "symbol"], "unique": [],
        "accepted_values": {"is_breakout_13w": [0, 1], "is_breakout_26w": [0, 1],
                            "is_breakout_52w": [0, 1], "is_breakout_104w": [0, 1]}},
}
BAR_KEY_EXPR = "symbol || '-' || date"


def key_column(expr: str) -> Column:
    return bar_key() if expr == BAR_KEY_EXPR else F.expr(expr)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL (Q1)."""
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, expr: str) -> DataFrame:
    """Key values occurring more than once; NULL keys ignored (Q2)."""
    k = key_column(expr).alias("unique_field")
    return (df.select(k).where(F.col("unique_field").isNotNull())
              .groupBy("unique_field").agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside ``values``; NULL ignored (Q3)."""
    c = F.col(column)
    return (df.where(c.isNotNull() & ~c.isin(*values))
              .groupBy(c.alias("value_field")).agg(F.count(F.lit(1)).alias("n_records")))


def layer_report(layer: str, df: DataFrame, not_null: Sequence[str] = (),
                 unique: Sequence[str] = (),
                 accepted_values: Mapping[str, Sequence] | None = None,
                 known_nulls: Mapping[str, int] | None = None) -> DataFrame:
    """Violation counts of a layer's checks, one row per check (Q4).

    ``known_nulls`` are NULLs per column counted while the layer was written
    (``Version.figures``): the not-null checks then read nothing.

    The layer is read once: with a uniqueness check, one grouping by the key
    also counts the NULLs of each column (partial sums per key, then
    summed); without one, a single global aggregate does the column checks.
    Distinct-value checks cannot be summed over key groups, so they get a
    pass of their own only when they meet a uniqueness check."""
    accepted_values = dict(accepted_values or {})
    unique = list(unique)
    labels: list[tuple[str, str]] = []
    parts: list[DataFrame] = []

    def stacked(row: DataFrame, labels: list[tuple[str, str]]) -> DataFrame:
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(chk).alias("check"), F.lit(col).alias("column"),
                     F.col(f"_v{i}").cast("bigint").alias("violations"))
            for i, (chk, col) in enumerate(labels)])))

    if known_nulls is not None and not_null:
        given = ", ".join(f"('not_null', '{c}', {int(known_nulls[c])}L)" for c in not_null)
        parts.append(df.sparkSession.sql(f"SELECT * FROM VALUES {given} AS v(check, column, violations)"))
        not_null = []
    if unique:
        first, rest = unique[0], unique[1:]
        nn = [F.count_if(F.col(c).isNull()).alias(f"_nn{i}") for i, c in enumerate(not_null)]
        # symbol || '-' || date has a date of fixed width, so the pair is the same
        # key; grouping by it reuses a partitioning on (symbol, date).
        keys = [F.col("symbol"), F.col("date")] if first == BAR_KEY_EXPR else [key_column(first).alias("_k")]
        given = F.lit(True)
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *nn)
        for c in ("symbol", "date") if first == BAR_KEY_EXPR else ("_k",):
            given = given & F.col(c).isNotNull()
        aggs = [F.coalesce(F.sum(f"_nn{i}"), F.lit(0)).alias(f"_v{i}") for i in range(len(not_null))]
        labels = [("not_null", c) for c in not_null]
        aggs.append(F.count_if(given & (F.col("_n") > 1)).alias(f"_v{len(aggs)}"))
        labels.append(("unique", first))
        parts.append(stacked(g.agg(*aggs), labels))
        not_null = []
    else:
        rest = []
    aggs, labels = [], []
    for c in not_null:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_v{len(aggs)}"))
        labels.append(("not_null", c))
    for c, vals in accepted_values.items():
        bad = F.when(F.col(c).isNotNull() & ~F.col(c).isin(*vals), F.col(c))
        aggs.append(F.count_distinct(bad).alias(f"_v{len(aggs)}"))
        labels.append(("accepted_values", c))
    if aggs:
        parts.append(stacked(df.agg(*aggs), labels))
    for expr in rest:
        v = check_unique(df, expr).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(v.select(F.lit("unique").alias("check"), F.lit(expr).alias("column"),
                              "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(layer).alias("layer"), "check", "column", "violations")


def quality_report(layers: Mapping[str, DataFrame],
                   suite: Mapping[str, Mapping] = SUITE,
                   known_nulls: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """The declared checks over every given layer, as one report."""
    out = None
    for name, df in layers.items():
        spec = suite[name]
        r = layer_report(name, df, spec["not_null"], spec["unique"], spec["accepted_values"],
                         (known_nulls or {}).get(name))
        out = r if out is None else out.unionByName(r)
    return out
