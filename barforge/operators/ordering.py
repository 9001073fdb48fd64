"""Global row order as a column (O1), without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Low bits of ``monotonically_increasing_id`` that number a partition's rows.
ROW_BITS = 33


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with every row's place (from 1) in the order of these columns.

    Rows are range-partitioned (sampled bounds) and sorted, numbered inside
    their partition and written once, so that all later reads see the same
    numbers; the rows before each partition are running sums over one row per
    partition, which is what is broadcast. The order should be total: equal
    rows keep whatever order the sort gave them."""
    from barforge.sources.storage import materialise

    row_id = F.monotonically_increasing_id()
    out = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", row_id)
    out = materialise(out)
    part = F.shiftright("__row", ROW_BITS)
    counts = out.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    inside = F.col("__row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (out.withColumn("__part", part).join(starts, "__part")
               .withColumn(name, F.col("__before") + inside + 1)
               .select(*df.columns, name))
