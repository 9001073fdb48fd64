"""The daily job: incremental load, then the transform, then the checks,
in one Spark application (scheduling is left to the user)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from barforge.plans.incremental import run_incremental
from barforge.plans.transform import TransformPaths, run_transform
from barforge.sources.master import write_master


def run_daily_job(spark: SparkSession, master: DataFrame, landing_norm: DataFrame,
                 root: str, run_date: dt.date, run_ts: dt.datetime | None = None,
                 run_id: str | None = None,
                 retry_landing_norm: DataFrame | None = None,
                 bronze_layout: dict | None = None,
                 publish_master: bool = True) -> dict[str, DataFrame | None]:
    """``root`` holds ``master_data/`` (the published master list, S6),
    ``bronze/``, ``control/``, ``silver/``, ``gold/`` and the change set
    (``changes/``). Silver and gold are refreshed for the changed symbols
    (built in full on the first run)."""
    root = root.rstrip("/")
    changes = f"{root}/changes"
    if publish_master:
        # The list may have been read from the folder it is written to, so
        # it is materialised first (one row per index member).
        master = master.checkpoint(eager=True)
        write_master(master, f"{root}/master_data")
    summary = run_incremental(spark, master, landing_norm, f"{root}/control", f"{root}/bronze",
                              run_date, run_ts, run_id, retry_landing_norm,
                              bronze_layout=bronze_layout, changes_path=changes)
    report = run_transform(spark, f"{root}/bronze",
                           TransformPaths(silver=f"{root}/silver", gold=f"{root}/gold"),
                           changes_path=changes)
    return {"summary": summary, "quality": report}
