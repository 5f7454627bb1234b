"""Driver contract: the flagship runs, every query has a callable, and a
sample of queries agrees with its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from plotwise.sources.tables import TABLES
from tests.conftest import SF

SAMPLE = ["clean_price_m2", "radius_count", "fill_district_max", "geocode_lookup", "monthly_ridership",
          "regression_metrics", "point_in_polygon", "wkt_parse"]


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"district", "n_sales", "avg_price"}


def test_registry_shape():
    qs, orc = entry_mod.queries(), entry_mod.oracle_sql()
    assert len(qs) > 100
    assert set(orc) <= set(qs)


@pytest.mark.parametrize("key", SAMPLE)
def test_oracle_sample(spark, key):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = entry_mod.queries()[key](spark, SF)
    cols = sorted(sdf.columns)
    s = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
    res = con.execute(entry_mod.oracle_sql()[key])
    names = [d[0] for d in res.description]
    rows = [dict(zip(names, r)) for r in res.fetchall()]
    d = sorted(tuple(str(r[c]) for c in cols) for r in rows)
    assert len(s) == len(d)
    assert s == d
