"""Registered queries do not depend on the session time zone."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

KEYS = ["landing_normalized", "control_upsert", "weekly_prices", "incremental_run", "extract_plan"]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Los_Angeles"])
def test_results_independent_of_session_zone(spark, zone):
    base = {k: sorted(E.queries()[k](spark, SF_SMALL).collect()) for k in KEYS}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for k in KEYS:
            assert sorted(E.queries()[k](spark, SF_SMALL).collect()) == base[k], k
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
