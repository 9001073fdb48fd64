"""Key-based upsert as a DataFrame function.

``MERGE ... WHEN MATCHED UPDATE ALL WHEN NOT MATCHED INSERT ALL`` equals
"target rows whose key is absent from the source, plus every source row",
once the source holds one row per key. The anti-join needs the source's
keys only: AQE broadcasts them when the increment is small (the daily
case) and keeps a sort-merge anti-join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from barforge.operators.staging import DEDUP_ORDER, keep_first


def dedup_by_key(source: DataFrame, keys: Sequence[str],
                 order: Sequence[str] | None = DEDUP_ORDER) -> DataFrame:
    """One source row per key, chosen by the staging rule; the reference's
    merge would reject or mis-handle duplicate source keys."""
    if order is None:
        return source
    order = [c for c in order if c in source.columns and c not in keys]
    if not order:
        raise ValueError("no column to choose between duplicate keys; pass order=None "
                         "if the source is unique by key")
    return keep_first(source, list(keys), order)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str] | None = DEDUP_ORDER) -> DataFrame:
    """Target rows not matched by key, plus all (de-duplicated) source rows.

    Columns are matched by name; source columns absent in the target are an
    error, target columns absent in the source become NULL."""
    src = dedup_by_key(source, keys, order)
    missing = [c for c in src.columns if c not in target.columns]
    if missing:
        raise ValueError(f"source columns not in target: {missing}")
    kept = target.join(src.select(*keys), on=list(keys), how="left_anti")
    return kept.unionByName(src.select(*[c for c in target.columns if c in src.columns]),
                            allowMissingColumns=True).select(*target.columns)
