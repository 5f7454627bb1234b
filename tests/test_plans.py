"""Plan shape: filters and projections reach the parquet scan; spatial and
district joins never plan as nested loops or cartesian products."""

import re

import __spark_entry__ as entry_mod
from tests.conftest import SF


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_filter_is_pushed_to_the_scan(spark):
    plan = _plan(entry_mod.queries()["scan_parquet_month_filter"](spark, SF))
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert scan and "l_shipdate" in scan[0] and ">= 1996-01-01" in scan[0]
    # only the six projected lineitem columns are read
    cols = re.search(r"FileScan parquet \[([^\]]*)\]", scan[0]).group(1).split(",")
    assert len(cols) == 6


def test_joins_are_equi_joins(spark):
    for key in ("radius_count", "nearest_road", "ridership_near", "district_of_road"):
        plan = _plan(entry_mod.queries()[key](spark, SF))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, key
