import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barforge.schemas import BRONZE  # noqa: E402
from barforge.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="barforge-tests", shuffle_partitions=4,
                  conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="barforge-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never wiped)."""
    return tempfile.mkdtemp(prefix="barforge-test-")


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def bronze_rows(spark, rows):
    """rows: (date, symbol, open, high, low, close, volume) tuples."""
    full = [(D(d) if isinstance(d, str) else d, o, h, lo, c, v, 0.0, 0.0, s)
            for d, s, o, h, lo, c, v in rows]
    return spark.createDataFrame(full, BRONZE)
