"""Incremental load: watermarks, classification, extract plans, results and
the control merge (C1-C10, J5-J7, A5-A9, U1).

Everything is a plan over distributed frames; ``tag_attempts`` writes the
joined extract once. The only values that reach the driver are scalars: the
shared DELTA start date is a scalar subquery (one row, computed once and
inlined), never a collected list.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.functions import day_after, lookback_start, wall_clock
from barforge.operators.upsert import upsert
from barforge.schemas import CONTROL, LOOKBACK_MONTHS, conform

NEW, DELTA, UP_TO_DATE = "NEW", "DELTA", "UP_TO_DATE"
FULL = "FULL"
SUCCESS, FAILED = "SUCCESS", "FAILED"


def read_watermarks(control: DataFrame) -> DataFrame:
    """``symbol -> last_extract_date`` of SUCCESS rows."""
    return (control.where(F.col("last_status") == F.lit(SUCCESS))
                   .select("symbol", "last_extract_date"))


def classify(master: DataFrame, watermarks: DataFrame, run_date: dt.date) -> DataFrame:
    """NEW (no watermark), DELTA (watermark before run_date) or UP_TO_DATE
    (C2, J5). One row per distinct, non-NULL master symbol: a symbol listed
    twice is planned and fetched once."""
    wm = watermarks.select("symbol", "last_extract_date", F.lit(True).alias("_known"))
    symbols = master.select("symbol").where(F.col("symbol").isNotNull()).distinct()
    j = symbols.join(wm, on="symbol", how="left")
    cls = (F.when(F.col("_known").isNull(), F.lit(NEW))
            .when(F.col("last_extract_date") >= F.lit(run_date), F.lit(UP_TO_DATE))
            .otherwise(F.lit(DELTA)))
    return j.select("symbol", "last_extract_date", cls.alias("class"))


def new_symbols(master: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Symbols never loaded successfully."""
    return master.select("symbol").join(watermarks.select("symbol"), "symbol", "left_anti")


def known_symbols(master: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Symbols with a watermark."""
    return master.select("symbol").join(watermarks.select("symbol"), "symbol", "left_semi")


def class_counts(classified: DataFrame) -> DataFrame:
    """Number of NEW / DELTA / UP_TO_DATE symbols, one row."""
    c = F.col("class")
    return classified.agg(F.count_if(c == NEW).alias("new_symbols"),
                          F.count_if(c == DELTA).alias("delta_symbols"),
                          F.count_if(c == UP_TO_DATE).alias("up_to_date_symbols"))


def delta_start_date(classified: DataFrame) -> DataFrame:
    """One shared start for every DELTA symbol: min watermark + 1 day (A6,
    F11). NULL when there is no DELTA symbol."""
    return (classified.where(F.col("class") == DELTA)
                      .agg(day_after(F.min("last_extract_date")).alias("delta_start_date")))


def extract_plan(classified: DataFrame, run_date: dt.date,
                 months: int = LOOKBACK_MONTHS) -> DataFrame:
    """Per symbol to fetch: run type and start date (C3). NEW -> full
    lookback; DELTA -> the shared start; UP_TO_DATE -> not planned."""
    shared = delta_start_date(classified).scalar()
    is_new = F.col("class") == NEW
    return (classified.where(F.col("class") != UP_TO_DATE)
                      .select("symbol", "class",
                              F.when(is_new, F.lit(FULL)).otherwise(F.lit(DELTA)).alias("run_type"),
                              F.when(is_new, lookback_start(run_date, months))
                               .otherwise(shared).alias("start_date"),
                              "last_extract_date"))


def extract(normalized: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of planned symbols from their start date on.

    The plan has one row per symbol; AQE broadcasts it when its measured
    size is under the threshold and splits a hot symbol otherwise."""
    p = plan.select("symbol", "run_type", "start_date")
    return (normalized.join(p, on="symbol", how="inner")
                      .where(F.col("date") >= F.col("start_date"))
                      .drop("start_date"))


def extract_results(extracted: DataFrame) -> DataFrame:
    """Per fetched symbol: rows, last date, type, SUCCESS."""
    return (extracted.groupBy("symbol", F.col("run_type").alias("last_run_type"))
                     .agg(F.max("date").alias("last_extract_date"),
                          F.count(F.lit(1)).alias("rows_extracted"))
                     .withColumn("last_status", F.lit(SUCCESS)))


def failed_results(plan: DataFrame, results: DataFrame, run_date: dt.date) -> DataFrame:
    """Planned symbols that returned nothing (C7): rows 0, FAILED; the date
    is run_date for a full load and the old watermark for a delta."""
    missed = plan.join(results.select("symbol"), "symbol", "left_anti")
    return missed.select(
        "symbol",
        F.when(F.col("run_type") == FULL, F.lit(run_date))
         .otherwise(F.col("last_extract_date")).alias("last_extract_date"),
        F.lit(0).cast("bigint").alias("rows_extracted"),
        F.col("run_type").alias("last_run_type"),
        F.lit(FAILED).alias("last_status"))


def retry_plan(failed: DataFrame, plan: DataFrame, run_date: dt.date,
               months: int = LOOKBACK_MONTHS) -> DataFrame:
    """Second attempt for failed symbols (C5): full lookback for NEW, the
    symbol's own watermark + 1 day for DELTA."""
    p = plan.join(failed.select("symbol"), "symbol", "left_semi")
    return p.select("symbol", "class", "run_type",
                    retry_start(p, run_date, months).alias("start_date"), "last_extract_date")


RESULT_COLUMNS = ["symbol", "last_extract_date", "rows_extracted", "last_run_type", "last_status"]


def combine_results(success: DataFrame, failed: DataFrame) -> DataFrame:
    """Results of one attempt: its successes and its failures (disjoint by
    symbol)."""
    return success.select(*RESULT_COLUMNS).unionByName(failed.select(*RESULT_COLUMNS))


def control_rows(results: DataFrame, run_id: str, run_ts: dt.datetime) -> DataFrame:
    """Results as control rows stamped with the run (C8). ``updated_at`` is
    the run time on both merge branches (set on update, default on insert)."""
    ts = wall_clock(run_ts)
    return conform(results.select(
        "symbol", "last_extract_date", "rows_extracted",
        F.lit(run_id).alias("last_run_id"), ts.alias("last_run_timestamp"),
        "last_run_type", "last_status", ts.alias("updated_at")), CONTROL)


def control_upsert(control: DataFrame, results: DataFrame, run_id: str,
                   run_ts: dt.datetime) -> DataFrame:
    """MERGE results into the control table on symbol (C9). Successes and
    failures are disjoint by symbol, so one pass equals the two merges."""
    return upsert(conform(control, CONTROL), control_rows(results, run_id, run_ts),
                  ["symbol"], order=None)


def extract_figures() -> list[Column]:
    """What is counted of an extract, as aggregates: for ``DataFrame.observe``
    in the pass that writes it, or for ``agg`` (A5, A8, Q1)."""
    return [F.count(F.lit(1)).alias("total_rows"), F.min("date").alias("min_date"), F.max("date").alias("max_date"),
            *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("symbol", "date", "close"))]


def add_figures(a: dict, b: dict) -> dict:
    """The figures of two extracts together."""
    known = lambda k: [x[k] for x in (a, b) if x[k] is not None]
    pick = {"min_date": min, "max_date": max}
    return {k: (pick.get(k, sum)(known(k)) if known(k) else None) for k in a}


def run_summary(classified: DataFrame, results: DataFrame, extracted: DataFrame | None = None,
                figures: dict | None = None) -> DataFrame:
    """One-row run report (A8, A9): class counts, successes, failures,
    rows fetched and their date range. The class counts are a scalar
    subquery (one struct), so no join of one-row frames is needed.

    ``figures`` are those observed while the extract was written; without
    them they are a second scalar subquery over ``extracted``."""
    st = F.col("last_status")
    if figures is None:
        r = extracted.agg(F.struct(*extract_figures()).alias("r")).scalar()
        rows = [r.getField(k).alias(k) for k in ("total_rows", "min_date", "max_date")]
    else:
        rows = [F.lit(figures["total_rows"]).cast("bigint").alias("total_rows"),
                *(F.lit(figures[k]).cast("date").alias(k) for k in ("min_date", "max_date"))]
    c = F.col("class")
    cls = classified.agg(F.struct(F.count_if(c == NEW).alias("new"),
                                  F.count_if(c == DELTA).alias("delta"),
                                  F.count_if(c == UP_TO_DATE).alias("up")).alias("c")).scalar()
    return (results.agg(F.count_if(st == SUCCESS).alias("symbols_ok"),
                        F.count_if(st == FAILED).alias("symbols_failed"))
                   .select(cls.getField("new").alias("new_symbols"),
                           cls.getField("delta").alias("delta_symbols"),
                           cls.getField("up").alias("up_to_date_symbols"),
                           "symbols_ok", "symbols_failed", *rows))


def failed_symbols(results: DataFrame) -> DataFrame:
    """Symbols that ended the run FAILED."""
    return results.where(F.col("last_status") == FAILED).select("symbol")


def union_extracts(*frames: DataFrame) -> DataFrame:
    """All extracted frames by column name; missing columns become NULL
    (U1). No de-duplication here: the bronze upsert does it."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


@dataclass
class IncrementalRun:
    """Lazy frames of one run (first pass, retry, combined)."""
    classified: DataFrame
    plan: DataFrame
    tagged: DataFrame          # every extracted row with its attempt number
    extracted: DataFrame       # first attempt
    success: DataFrame
    failed: DataFrame
    retry_plan: DataFrame
    retried_rows: DataFrame    # second attempt
    retried: DataFrame
    all_extracted: DataFrame
    results: DataFrame
    first_pass_results: DataFrame


def retry_start(plan: DataFrame, run_date: dt.date, months: int = LOOKBACK_MONTHS) -> Column:
    """Start date of a second attempt (C5): the full lookback for NEW, the
    symbol's own watermark + 1 day for DELTA."""
    return (F.when(F.col("class") == NEW, lookback_start(run_date, months))
             .otherwise(day_after("last_extract_date")))


def tag_attempts(plan: DataFrame, landing_norm: DataFrame, retry_landing_norm: DataFrame,
                 run_date: dt.date, months: int = LOOKBACK_MONTHS) -> DataFrame:
    """Both attempts in one join (C4, C5, U1): rows the first attempt fetches
    (landing from the shared start) and rows the retry fetches (its source
    from each symbol's own start), the latter kept only for symbols the
    first attempt found nothing for. The joined rows are written once; the
    per-symbol success flag is a partial aggregate over them."""
    from barforge.sources.storage import materialise

    p = plan.select("symbol", "run_type", "start_date",
                    retry_start(plan, run_date, months).alias("_retry_start"))
    src = (landing_norm.withColumn("attempt", F.lit(1))
           .unionByName(retry_landing_norm.withColumn("attempt", F.lit(2))))
    one, two = F.col("attempt") == 1, F.col("attempt") == 2
    cand = (src.join(p, on="symbol", how="inner")
               .where((one & (F.col("date") >= F.col("start_date")))
                      | (two & (F.col("date") >= F.col("_retry_start"))))
               .drop("start_date", "_retry_start"))
    cand = materialise(cand)
    found = cand.where(one).groupBy("symbol").agg(F.lit(True).alias("_found"))
    return (cand.join(found, on="symbol", how="left")
                .where(one | F.col("_found").isNull())
                .drop("_found"))


def plan_run(master: DataFrame, control: DataFrame, landing_norm: DataFrame,
             run_date: dt.date, retry_landing_norm: DataFrame | None = None,
             months: int = LOOKBACK_MONTHS) -> IncrementalRun:
    """C1-C7 and U1 as one lazy plan. ``retry_landing_norm`` is what the
    second attempt sees (by default the same landing data)."""
    wm = read_watermarks(control)
    classified = classify(master, wm, run_date)
    plan = extract_plan(classified, run_date, months)
    retry_src = retry_landing_norm if retry_landing_norm is not None else landing_norm
    tagged = tag_attempts(plan, landing_norm, retry_src, run_date, months)
    first = tagged.where(F.col("attempt") == 1).drop("attempt")
    rplan = retry_plan(failed_results(plan, extract_results(first), run_date), plan,
                       run_date, months)
    return from_tagged(classified, plan, rplan, tagged, run_date)


def from_tagged(classified: DataFrame, plan: DataFrame, rplan: DataFrame,
                tagged: DataFrame, run_date: dt.date) -> IncrementalRun:
    """Every result of a run from the tagged extract. A symbol has rows of
    one attempt at most, so the final results are one grouping of all rows
    (successes of either attempt) plus the planned symbols with no row at
    all (failures). Pass a checkpointed ``tagged`` and the landing data is
    joined only once for the bronze write, the results and the summary."""
    extracted = tagged.where(F.col("attempt") == 1).drop("attempt")
    retried_rows = tagged.where(F.col("attempt") == 2).drop("attempt")
    success = extract_results(extracted)
    failed = failed_results(plan, success, run_date)
    all_rows = tagged.drop("attempt")
    found = extract_results(all_rows)
    results = combine_results(found, failed_results(plan, found, run_date))
    return IncrementalRun(
        classified=classified, plan=plan, tagged=tagged, extracted=extracted,
        success=success, failed=failed, retry_plan=rplan, retried_rows=retried_rows,
        retried=extract_results(retried_rows), all_extracted=all_rows,
        results=results,
        first_pass_results=combine_results(success, failed),
    )
