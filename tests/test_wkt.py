"""Well-known text of every kind into nested geometries."""

import pytest
from pyspark.sql import functions as F

from plotwise.functions.wkt import parse_wkt

CASES = {
    "POINT (1 2)": [("POINT", [[(1, 2)]])],
    " point(1.5 -2e-1)": [("POINT", [[(1.5, -0.2)]])],
    "POINT Z (1 2 3)": [("POINT", [[(1, 2)]])],
    "LINESTRING (0 0, 1 1,2 .5)": [("LINESTRING", [[(0, 0), (1, 1), (2, 0.5)]])],
    "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))":
        [("POLYGON", [[(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]])],
    "MULTIPOINT (1 2, 3 4)": [("POINT", [[(1, 2)]]), ("POINT", [[(3, 4)]])],
    "MULTIPOINT ((1 2), (3 4))": [("POINT", [[(1, 2)]]), ("POINT", [[(3, 4)]])],
    "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3, 4 4))": [("LINESTRING", [[(0, 0), (1, 1)]]), ("LINESTRING", [[(2, 2), (3, 3), (4, 4)]])],
    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5 5, 5 6, 6 6, 5 5)))":
        [("POLYGON", [[(0, 0), (1, 0), (1, 1), (0, 0)]]), ("POLYGON", [[(5, 5), (6, 5), (6, 6), (5, 5)], [(5, 5), (5, 6), (6, 6), (5, 5)]])],
    "GEOMETRYCOLLECTION (POINT (1e2 2), GEOMETRYCOLLECTION (LINESTRING (0 0, 1E+1 1), MULTIPOINT (7 8)), POLYGON ((0 0, 1 0, 1 1, 0 0)))":
        [("POINT", [[(100, 2)]]), ("LINESTRING", [[(0, 0), (10, 1)]]), ("POINT", [[(7, 8)]]), ("POLYGON", [[(0, 0), (1, 0), (1, 1), (0, 0)]])],
    "GEOMETRYCOLLECTION (POINT EMPTY, POINT (1 2))": [("POINT", [[(1, 2)]])],
    "GEOMETRYCOLLECTION (GEOMETRYCOLLECTION (POINT (1 2)))": [("POINT", [[(1, 2)]])],
    "MULTIPOLYGON EMPTY": [], "GEOMETRYCOLLECTION EMPTY": [], "LINESTRING EMPTY": [],
    "": None, "nothing": None, "POINT (x y)": None, "POINT (1 2": None, "LINESTRING (1 2, 3)": None, "POINT (1^2 3)": None,
}


def test_every_kind(spark):
    df = spark.createDataFrame([(t,) for t in CASES] + [(None,)], "wkt string")
    got = {r.wkt: r.g for r in df.select("wkt", parse_wkt(F.col("wkt")).alias("g")).collect()}
    assert got.pop(None) is None
    for text, want in CASES.items():
        g = got[text]
        if want is None:
            assert g is None, (text, g)
        else:
            assert g is not None, text
            assert [(m.kind, [[(v.lon, v.lat) for v in p] for p in m.parts]) for m in g] == \
                [(k, [[(float(x), float(y)) for x, y in p] for p in parts]) for k, parts in want], text


def test_long_text(spark):
    n = 20_000
    text = "MULTIPOINT (" + ", ".join(f"{i}e0 {i + 0.5}" for i in range(n)) + ")"
    g = spark.createDataFrame([(text,)], "wkt string").select(parse_wkt(F.col("wkt")).alias("g")).select(
        F.size("g"), F.element_at("g", -1)["parts"][0][0]["lat"]).first()
    assert tuple(g) == (n, pytest.approx(n - 0.5))
