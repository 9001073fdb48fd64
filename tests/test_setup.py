from barforge.plans.incremental import read_control, write_control
from barforge.plans.setup import setup_lake
from barforge.schemas import CONTROL


def test_setup_creates_control_and_namespaces(spark, scratch):
    rep = {r["name"]: r["exists"] for r in setup_lake(spark, f"{scratch}/lake").collect()}
    assert rep["control"] is True and rep["bronze"] is False
    assert rep["namespace:silver"] is True and rep["namespace:gold"] is True
    ctl = read_control(spark, f"{scratch}/lake/control")
    assert ctl.count() == 0 and ctl.schema == CONTROL
    # idempotent: a second setup keeps an existing control table
    write_control(spark, spark.createDataFrame([("A", None, 1, "r", None, "FULL", "SUCCESS", None)], CONTROL),
                  f"{scratch}/lake/control")
    setup_lake(spark, f"{scratch}/lake")
    assert read_control(spark, f"{scratch}/lake/control").count() == 1
