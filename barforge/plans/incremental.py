"""Entry A: the incremental load (C11).

Order, as in the reference: classify -> plan -> extract (+ retry) ->
bronze upsert -> control upsert -> refresh -> summary. Bronze is written
before control, so a crash between the two re-fetches the same rows next
time, which the key-based upsert absorbs. The control table is merged on
symbol (``inc.control_upsert``) and published as a whole. The figures of the
run summary are observed while the extract is written.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barforge.operators import incremental as inc
from barforge.plans.changes import record_changes
from barforge.schemas import CONTROL, LOOKBACK_MONTHS, conform
from barforge.session import ensure_checkpoint_dir
from barforge.sources import storage
from barforge.sources.landing import to_bronze


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """The control table: one row per symbol. A table that does not exist yet
    is empty (every symbol is then NEW); read errors are raised, not swallowed."""
    if not storage.table_exists(spark, path):
        return spark.createDataFrame([], CONTROL)
    return conform(storage.read_table(spark, path), CONTROL)


def write_control(spark: SparkSession, control: DataFrame, path: str) -> None:
    """Publish the whole control table (one row per symbol: small). Readers
    see the old table or the new one."""
    storage.replace_table(conform(control, CONTROL), path, sort_by=("symbol",))


def run_incremental(spark: SparkSession, master: DataFrame, landing_norm: DataFrame,
                    control_path: str, bronze_path: str, run_date: dt.date,
                    run_ts: dt.datetime | None = None, run_id: str | None = None,
                    retry_landing_norm: DataFrame | None = None,
                    months: int = LOOKBACK_MONTHS,
                    bronze_layout: dict | None = None,
                    changes_path: str | None = None) -> DataFrame | None:
    """Load new landing rows into bronze and record the run in the control
    table. Returns the one-row run summary, or ``None`` when nothing was
    fetched (bronze and control are then left untouched, C10).

    ``bronze_layout`` is the partition spec of bronze (default: by month;
    see ``storage.day_partition`` and ``storage.symbol_buckets``).
    ``changes_path``: where the changed symbols, each with its earliest
    changed date, are recorded for the incremental transform, before bronze
    is published."""
    ensure_checkpoint_dir(spark)
    run_ts = run_ts or dt.datetime.now().replace(microsecond=0)
    run_id = run_id or uuid.uuid4().hex[:8]
    control = read_control(spark, control_path)
    # Small per-symbol frames are materialised in the shared checkpoint folder.
    classified = inc.classify(master, inc.read_watermarks(control), run_date).checkpoint(eager=True)
    plan = inc.extract_plan(classified, run_date, months).checkpoint(eager=True)
    # First attempt: one scan of the landing data, written once; results,
    # failures and the bronze write read the columns they need.
    first, figures = write_observed(inc.extract(landing_norm, plan))
    failed = inc.failed_results(plan, inc.extract_results(first), run_date)
    rplan = inc.retry_plan(failed, plan, run_date, months).checkpoint(eager=True)
    tagged = first.withColumn("attempt", F.lit(1))
    # The same landing data cannot hold what it did not hold before: a second
    # attempt reads only a source of its own.
    if retry_landing_norm is not None and not rplan.isEmpty():
        second, more = write_observed(inc.extract(retry_landing_norm, rplan))
        tagged = inc.union_extracts(tagged, second.withColumn("attempt", F.lit(2)))
        figures = inc.add_figures(figures, more)
    if not figures["total_rows"]:
        return None
    run = inc.from_tagged(classified, plan, rplan, tagged, run_date)
    change = storage.plan_upsert(spark, to_bronze(run.all_extracted), bronze_path,
                                 keys=("symbol", "date"),
                                 partitions=bronze_layout or storage.month_partition())
    storage.apply_upsert(spark, change, before_publish=(
        lambda c: record_changes(spark, changes_path, c.rows, run_id)) if changes_path else None)
    summary = inc.run_summary(run.classified, run.results, figures=figures).checkpoint(eager=True)
    write_control(spark, inc.control_upsert(control, run.results, run_id, run_ts), control_path)
    return summary


def write_observed(extracted: DataFrame) -> tuple[DataFrame, dict]:
    """An extract written to the shared checkpoint folder, and its figures
    (rows, date range, NULLs of the required columns) taken in that pass."""
    seen = Observation(f"extract {uuid.uuid4().hex}")
    rows = storage.materialise(extracted.observe(seen, *inc.extract_figures()))
    return rows, seen.get
