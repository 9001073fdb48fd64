"""One-time lake setup: the empty control table, the layer namespaces, and
a report of which objects exist (the reference's setup script, S12, S14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barforge.plans.incremental import write_control
from barforge.plans.transform import GOLD_SCHEMA, SILVER_SCHEMA
from barforge.schemas import CONTROL
from barforge.sources import storage


def lake_paths(root: str) -> dict[str, str]:
    root = root.rstrip("/")
    return {"control": f"{root}/control", "bronze": f"{root}/bronze",
            "master_data": f"{root}/master_data",
            "weekly_prices": f"{root}/silver/weekly_prices",
            "monthly_prices": f"{root}/silver/monthly_prices",
            "weekly_technical_analysis": f"{root}/gold/weekly_technical_analysis"}


def setup_lake(spark: SparkSession, root: str, silver_schema: str | None = None,
               gold_schema: str | None = None, replace_control: bool = False) -> DataFrame:
    """Create the control table (empty, declared schema) unless it exists or
    ``replace_control`` is set, create the layer namespaces, and return the
    verification report (one row per expected object)."""
    paths = lake_paths(root)
    if replace_control or not storage.table_exists(spark, paths["control"]):
        write_control(spark, spark.createDataFrame([], CONTROL), paths["control"])
    names = [storage.layer_name(silver_schema, SILVER_SCHEMA),
             storage.layer_name(gold_schema, GOLD_SCHEMA)]
    storage.ensure_namespaces(spark, names)
    report = storage.verify_layers(spark, paths)
    dbs = {d.name for d in spark.catalog.listDatabases()}
    extra = spark.createDataFrame([(f"namespace:{n}", n, n in dbs) for n in names],
                                  "name string, path string, exists boolean")
    return report.unionByName(extra)
