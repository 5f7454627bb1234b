"""Domain tables derived from the driver's TPC-H-style tables.

The driver's tables carry no coordinates, roads or ridership, so every domain
table is a deterministic projection of them with integer arithmetic that
Spark and DuckDB evaluate alike (see FIXTURES.md §C). Each builder here has a
DuckDB twin in ``SQL`` so the oracle reads exactly the same rows.

All work grows with the base tables: nothing here is a fixed in-memory input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.functions.numeric import sig, sig_sql
from plotwise.sources.tables import read_table

# FIXED VALUES: proxy point formula and the amenity type of each p_type.
LAT0, LAT_SPAN = 2.6, 1.1
LON0, LON_SPAN = 100.9, 1.4
PTYPE_TO_AMENITY = {
    "ECONOMY": "mall",
    "LARGE": "school",
    "MEDIUM": "park",
    "PROMO": "river",
    "SMALL": "lake",
    "STANDARD": "rail station",
}
ALL_STATIONS = "A0: All Stations"
NODE_SPREAD = 0.01
STATION_SPREAD = 0.006      # a station stands up to 0.67 km north and east of the sales of every 15th customer
HIGHWAY_CLASSES = ["motorway", "trunk", "primary", "secondary", "tertiary",
                   "residential", "service", "footway", "cycleway", "path"]


def lat_of(k: Column) -> Column:
    return F.lit(LAT0) + ((k * 7919) % 10000).cast("double") / 10000.0 * LAT_SPAN


def lon_of(k: Column) -> Column:
    return F.lit(LON0) + ((k * 104729) % 10000).cast("double") / 10000.0 * LON_SPAN


def _lat_sql(k: str) -> str:
    return f"(CAST(({k}) * 7919 % 10000 AS DOUBLE) / 10000.0 * CAST({LAT_SPAN} AS DOUBLE) + CAST({LAT0} AS DOUBLE))"


def _lon_sql(k: str) -> str:
    return f"(CAST(({k}) * 104729 % 10000 AS DOUBLE) / 10000.0 * CAST({LON_SPAN} AS DOUBLE) + CAST({LON0} AS DOUBLE))"


def _amenity_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in PTYPE_TO_AMENITY.items())
    return f"(CASE {whens} END)"


# ---------------------------------------------------------------------------
# Spark builders
# ---------------------------------------------------------------------------

def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One property transaction per order; the road is the customer."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("o_orderkey")
    return j.select(
        k.alias("records_id"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("date"),
        F.year("o_orderdate").alias("year"),
        F.col("c_mktsegment").alias("property_type"),
        F.when(k % 2 == 0, "Freehold").otherwise("Leasehold").alias("tenure"),
        F.col("n_name").alias("district"),
        F.concat(F.lit(" Mukim "), (F.col("c_nationkey") % 5).cast("string"), F.lit("\t")).alias("mukim"),
        F.concat(F.lit("road_"), F.col("c_custkey").cast("string")).alias("road_name"),
        F.when(k % 13 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("way_id"),
        F.col("o_totalprice").alias("transaction_price"),
        ((k * 17) % 3000 + 10).alias("property_m2"),
        ((k * 31) % 400 - 10).alias("land_m2"),
        ((k % 40) - 3).alias("unit_level"),
        lat_of(F.col("c_custkey")).alias("lat"),
        lon_of(F.col("c_custkey")).alias("lon"),
    )


def amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    mapping = F.create_map(*[F.lit(x) for kv in PTYPE_TO_AMENITY.items() for x in kv])
    k = F.col("p_partkey") * 13 + 1237
    return p.select(
        F.col("p_partkey").alias("osm_id"),
        F.lit("node").alias("osm_type"),
        F.col("p_name").alias("name"),
        mapping[F.col("p_type")].alias("feature_type"),
        lat_of(k).alias("lat"),
        lon_of(k).alias("lon"),
    )


# FIXED VALUES: vertex formulas of amenities with an extent, as SQL text that both engines read
LINE_TYPES, AREA_TYPES = ("river",), ("lake", "park")


def _river_xy(k: str, i: str) -> tuple[str, str]:
    return f"(lon + {i} * 1e-2)", f"(lat + CAST(({k} * 7919 * ({i} + 1)) % 1000 AS DOUBLE) / 1e3 * 2e-2)"


def _corner_xy(k: str, i: str, hole: bool = False) -> tuple[str, str]:
    east, north = (f"(CASE WHEN {i} IN ({at}) THEN 1e0 ELSE 0e0 END)" for at in ("1, 2", "2, 3"))
    if hole:
        east, north = f"(25e-2 + 5e-1 * {east})", f"(25e-2 + 5e-1 * {north})"
    return (f"(lon + CAST({k} * 31 % 50 + 10 AS DOUBLE) / 1e3 * {east})",
            f"(lat + CAST({k} * 37 % 50 + 10 AS DOUBLE) / 1e3 * {north})")


def amenity_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amenities with their extent: rivers are lines of four vertices, lakes
    and parks rectangles (every third lake with an island), others points."""
    def part(last: int, xy: tuple[str, str]) -> str:
        return f"transform(sequence(0, {last}), i -> named_struct('lon', {xy[0]}, 'lat', {xy[1]}))"

    k = "osm_id"
    ring, island = part(4, _corner_xy(k, "i")), part(4, _corner_xy(k, "i", hole=True))
    parts = (f"CASE WHEN feature_type IN {AREA_TYPES!r} THEN IF(feature_type = 'lake' AND {k} % 3 = 0, array({ring}, {island}), array({ring})) "
             f"WHEN feature_type = '{LINE_TYPES[0]}' THEN array({part(3, _river_xy(k, 'i'))}) "
             f"ELSE array(array(named_struct('lon', lon, 'lat', lat))) END")
    return amenities(spark, sf_dir).select(
        "osm_id", "feature_type", F.expr(parts).alias("parts"),
        F.coalesce(F.col("feature_type").isin(*AREA_TYPES), F.lit(False)).alias("is_area"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey") * 15
    north, east = (((F.col("s_suppkey") * m) % 1000).cast("double") / 1000.0 * STATION_SPREAD for m in (7919, 104729))
    return s.select(
        F.col("s_suppkey").alias("osm_id"),
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        F.lit("rail station").alias("feature_type"),
        F.concat(F.lit("Line "), (F.col("s_nationkey") % 3).cast("string")).alias("line_name"),
        (F.col("s_nationkey") % 3).alias("train_id"),
        (lat_of(k) + north).alias("lat"),
        (lon_of(k) + east).alias("lon"),
    )


def _station_label(key: Column) -> Column:
    return F.concat(key.cast("string"), F.lit(": Station "), key.cast("string"))


def od_ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origin–destination passenger counts; the all-stations marker appears
    as destination on line 1 and as origin on line 2."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_returnflag", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity")
    return li.select(
        F.col("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("service"),
        F.when(F.col("l_linenumber") == 2, F.lit(ALL_STATIONS))
         .otherwise(_station_label(F.col("l_suppkey"))).alias("origin"),
        F.when(F.col("l_linenumber") == 1, F.lit(ALL_STATIONS))
         .otherwise(_station_label(F.col("l_partkey") % 100)).alias("destination"),
        F.col("l_quantity").alias("passengers"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual ``y`` and predicted ``p`` per order (zero actuals included)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    g = li.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("ys"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("p"),
    )
    # sums are rounded to 12 significant digits so the order of addition
    # (partition layout) cannot change a bit of the result
    return g.select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit(0.0)).otherwise(sig(F.col("ys"), 12)).alias("y"),
        sig(F.col("p"), 12).alias("p"),
        F.when(F.col("l_orderkey") % 10 < 7, "train").otherwise("test").alias("split"),
    )


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties with the twelve distance columns (km), some NULL, one
    district entirely NULL."""
    from plotwise.config import DISTANCE_COLS
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("o_orderkey").alias("records_id"), F.col("n_name").alias("district"), "c_nationkey"))
    k = F.col("records_id")
    cols = [
        F.when(((k + i) % 7 == 0) | (F.col("c_nationkey") == 3), F.lit(None).cast("double"))
         .otherwise(((k * (31 + 2 * i)) % 2000).cast("double") / 100.0).alias(name)
        for i, name in enumerate(DISTANCE_COLS)
    ]
    return base.select("records_id", "district", *cols)


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    return c.select(F.col("c_custkey").alias("node_id"),
                    lat_of(F.col("c_custkey")).alias("lat"),
                    lon_of(F.col("c_custkey")).alias("lon"))


def graph_edges(spark: SparkSession, sf_dir: str, mode: str = "drive") -> DataFrame:
    """Directed road graph over customer keys. ``drive``: k→k+1, k→3k+1;
    ``walk``: k↔k+1 with its own lengths."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    n = c.select(F.count(F.lit(1))).scalar()
    k = F.col("c_custkey")
    if mode == "drive":
        length = ((k * 7919) % 900 + 100).cast("double")
        a = c.select(k.alias("src"), ((k + 1) % n).alias("dst"), length.alias("length_m"))
        b = c.select(k.alias("src"), ((k * 3 + 1) % n).alias("dst"), length.alias("length_m"))
    elif mode == "walk":
        length = ((k * 104729) % 700 + 50).cast("double")
        a = c.select(k.alias("src"), ((k + 1) % n).alias("dst"), length.alias("length_m"))
        b = c.select(((k + 1) % n).alias("src"), k.alias("dst"), length.alias("length_m"))
    else:
        raise ValueError(f"unknown graph mode {mode!r}")
    return a.unionByName(b)


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road centroids bunched into twenty groups plus scattered ones."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    hub = (k % 20) * 37 + 5
    lat = F.when(k % 29 == 0, lat_of(k * 13 + 7)).otherwise(
        lat_of(hub) + ((k * 7919) % 1000).cast("double") / 1000.0 * 0.02)
    lon = F.when(k % 29 == 0, lon_of(k * 13 + 7)).otherwise(
        lon_of(hub) + ((k * 104729) % 1009).cast("double") / 1009.0 * 0.02)
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(F.concat(F.lit("road_"), k.cast("string")).alias("road_name"),
                     k.alias("road_id"), F.col("n_name").alias("district"),
                     F.col("c_nationkey").alias("nation_key"),
                     F.element_at(F.array(*[F.lit(h) for h in HIGHWAY_CLASSES]),
                                  (k % len(HIGHWAY_CLASSES) + 1).cast("int")).alias("highway"),
                     lat.alias("lat"), lon.alias("lon")))


DISTRICT_ROWS, DISTRICT_COLS = 5, 5
DISTRICT_DLAT = LAT_SPAN / DISTRICT_ROWS
DISTRICT_DLON = LON_SPAN / DISTRICT_COLS


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One square polygon per nation on a 5×5 grid over the point box.
    Geometry: ``rings`` ARRAY<ARRAY<STRUCT<lon,lat>>>, first ring outer."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    r = (F.col("n_nationkey") / DISTRICT_COLS).cast("int")
    cidx = F.col("n_nationkey") % DISTRICT_COLS
    lat0 = F.lit(LAT0) + r.cast("double") * DISTRICT_DLAT
    lon0 = F.lit(LON0) + cidx.cast("double") * DISTRICT_DLON
    lat1 = lat0 + DISTRICT_DLAT
    lon1 = lon0 + DISTRICT_DLON

    def pt(lo, la):
        return F.struct(lo.alias("lon"), la.alias("lat"))

    ring = F.array(pt(lon0, lat0), pt(lon1, lat0), pt(lon1, lat1), pt(lon0, lat1), pt(lon0, lat0))
    return n.select(F.col("n_name").alias("district"), F.col("n_nationkey").alias("district_id"),
                    F.array(ring).alias("rings"))


def way_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OSM-style way membership: way = customer, nodes = its orders in key order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.select(F.col("o_custkey").alias("way_id"), F.col("o_orderkey").alias("pos"),
                    F.col("o_orderkey").alias("node_id"))


def osm_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node coordinates near the way's customer point (ways stay local);
    every 11th node is missing from the extract."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").filter(F.col("o_orderkey") % 11 != 0)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(k.alias("node_id"),
                    (lat_of(c) + ((k * 7919) % 1000).cast("double") / 1000.0 * NODE_SPREAD).alias("lat"),
                    (lon_of(c) + ((k * 104729) % 1000).cast("double") / 1000.0 * NODE_SPREAD).alias("lon"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geocoder candidates per road name, in rank order (1 = best)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey").filter(F.col("c_custkey") % 17 != 0)
    k = F.col("c_custkey")
    rk = F.col("rank")
    kind = (k + rk) % 4
    g = c.select(k, F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("rank"))
    return g.select(
        F.concat(F.lit("road_"), k.cast("string")).alias("query"),
        rk.alias("rank"),
        F.when(kind == 0, "node").when(kind == 1, "relation").otherwise("way").alias("osm_type"),
        (k * 10 + rk).alias("osm_id"),
        F.concat(F.lit("Address "), k.cast("string"), F.lit("/"), rk.cast("string")).alias("address"),
        (lat_of(k * 10 + rk) + F.when((k % 5 == 0) & (rk == 1), F.lit(1.5)).otherwise(F.lit(0.0))).alias("lat"),
        lon_of(k * 10 + rk).alias("lon"),
    )


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual way-id corrections for the NULL-way records; several per id,
    ``seq`` orders them, a NULL way id is a real correction."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    li = li.filter(F.col("l_orderkey") % 13 == 0)
    return li.select(
        F.col("l_orderkey").alias("records_id"),
        F.when(F.col("l_linenumber") == 3, F.lit(None).cast("bigint")).otherwise(F.col("l_partkey")).alias("way_id"),
        (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("seq"),
    )


# ---------------------------------------------------------------------------
# DuckDB twins (CTE bodies over the pre-registered driver views)
# ---------------------------------------------------------------------------

def _highway_sql(k: str) -> str:
    arr = ", ".join(f"'{h}'" for h in HIGHWAY_CLASSES)
    return f"([{arr}])[CAST({k} % {len(HIGHWAY_CLASSES)} AS INTEGER) + 1]"


def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


SQL: dict[str, str] = {}

SQL["properties"] = f"""
SELECT o_orderkey AS records_id,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       c_mktsegment AS property_type,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Freehold' ELSE 'Leasehold' END AS tenure,
       n_name AS district,
       ' Mukim ' || CAST(c_nationkey % 5 AS VARCHAR) || chr(9) AS mukim,
       'road_' || CAST(c_custkey AS VARCHAR) AS road_name,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS way_id,
       o_totalprice AS transaction_price,
       (o_orderkey * 17) % 3000 + 10 AS property_m2,
       (o_orderkey * 31) % 400 - 10 AS land_m2,
       (o_orderkey % 40) - 3 AS unit_level,
       {_lat_sql('c_custkey')} AS lat,
       {_lon_sql('c_custkey')} AS lon
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

SQL["amenities"] = f"""
SELECT p_partkey AS osm_id, 'node' AS osm_type, p_name AS name,
       {_amenity_case('p_type')} AS feature_type,
       {_lat_sql('p_partkey * 13 + 1237')} AS lat,
       {_lon_sql('p_partkey * 13 + 1237')} AS lon
FROM part
"""


def _shape_edges_sql() -> str:
    def edges(n: int, area: bool, xy, where: str) -> str:
        (x1, y1), (x2, y2) = xy("i"), xy("(i + 1)")
        return (f"SELECT osm_id, feature_type, {str(area).lower()} AS is_area, {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 "
                f"FROM amenities, range({n}) t(i) WHERE {where}")

    return "\nUNION ALL\n".join([
        f"SELECT osm_id, feature_type, false AS is_area, lon AS x1, lat AS y1, lon AS x2, lat AS y2 FROM amenities "
        f"WHERE feature_type IS NULL OR feature_type NOT IN {LINE_TYPES + AREA_TYPES!r}",
        edges(3, False, lambda i: _river_xy("osm_id", i), f"feature_type = '{LINE_TYPES[0]}'"),
        edges(4, True, lambda i: _corner_xy("osm_id", i), f"feature_type IN {AREA_TYPES!r}"),
        edges(4, True, lambda i: _corner_xy("osm_id", i, hole=True), "feature_type = 'lake' AND osm_id % 3 = 0")])


SQL["shape_edges"] = _shape_edges_sql()

SQL["stations"] = f"""
SELECT s_suppkey AS osm_id, CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name,
       'rail station' AS feature_type,
       'Line ' || CAST(s_nationkey % 3 AS VARCHAR) AS line_name,
       s_nationkey % 3 AS train_id,
       {_lat_sql('s_suppkey * 15')} + CAST((s_suppkey * 7919) % 1000 AS DOUBLE) / 1000.0 * {_d(STATION_SPREAD)} AS lat,
       {_lon_sql('s_suppkey * 15')} + CAST((s_suppkey * 104729) % 1000 AS DOUBLE) / 1000.0 * {_d(STATION_SPREAD)} AS lon
FROM supplier
"""

SQL["od_ridership"] = f"""
SELECT l_shipdate AS date, l_returnflag AS service,
       CASE WHEN l_linenumber = 2 THEN '{ALL_STATIONS}'
            ELSE CAST(l_suppkey AS VARCHAR) || ': Station ' || CAST(l_suppkey AS VARCHAR) END AS origin,
       CASE WHEN l_linenumber = 1 THEN '{ALL_STATIONS}'
            ELSE CAST(l_partkey % 100 AS VARCHAR) || ': Station ' || CAST(l_partkey % 100 AS VARCHAR) END AS destination,
       l_quantity AS passengers
FROM lineitem
"""

SQL["predictions"] = f"""
SELECT l_orderkey AS id,
       CASE WHEN l_orderkey % 97 = 0 THEN CAST(0.0 AS DOUBLE) ELSE {sig_sql('sum(l_extendedprice)', 12)} END AS y,
       {sig_sql('sum(l_extendedprice * (1 - l_discount))', 12)} AS p,
       CASE WHEN l_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split
FROM lineitem GROUP BY l_orderkey
"""


def _distances_sql() -> str:
    from plotwise.config import DISTANCE_COLS
    cols = ",\n       ".join(
        f"CASE WHEN (o_orderkey + {i}) % 7 = 0 OR c_nationkey = 3 THEN NULL "
        f"ELSE CAST((o_orderkey * {31 + 2 * i}) % 2000 AS DOUBLE) / 100.0 END AS {name}"
        for i, name in enumerate(DISTANCE_COLS))
    return f"""
SELECT o_orderkey AS records_id, n_name AS district,
       {cols}
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


SQL["distances"] = _distances_sql()

SQL["graph_nodes"] = f"""
SELECT c_custkey AS node_id, {_lat_sql('c_custkey')} AS lat, {_lon_sql('c_custkey')} AS lon FROM customer
"""

SQL["drive_edges"] = """
SELECT c_custkey AS src, (c_custkey + 1) % (SELECT count(*) FROM customer) AS dst,
       CAST((c_custkey * 7919) % 900 + 100 AS DOUBLE) AS length_m FROM customer
UNION ALL
SELECT c_custkey AS src, (c_custkey * 3 + 1) % (SELECT count(*) FROM customer) AS dst,
       CAST((c_custkey * 7919) % 900 + 100 AS DOUBLE) AS length_m FROM customer
"""

SQL["walk_edges"] = """
SELECT c_custkey AS src, (c_custkey + 1) % (SELECT count(*) FROM customer) AS dst,
       CAST((c_custkey * 104729) % 700 + 50 AS DOUBLE) AS length_m FROM customer
UNION ALL
SELECT (c_custkey + 1) % (SELECT count(*) FROM customer) AS src, c_custkey AS dst,
       CAST((c_custkey * 104729) % 700 + 50 AS DOUBLE) AS length_m FROM customer
"""

SQL["roads"] = f"""
SELECT 'road_' || CAST(c_custkey AS VARCHAR) AS road_name, c_custkey AS road_id, n_name AS district,
       c_nationkey AS nation_key, {_highway_sql('c_custkey')} AS highway,
       CASE WHEN c_custkey % 29 = 0 THEN {_lat_sql('c_custkey * 13 + 7')}
            ELSE {_lat_sql('(c_custkey % 20) * 37 + 5')} + CAST((c_custkey * 7919) % 1000 AS DOUBLE) / 1000.0 * {_d(0.02)} END AS lat,
       CASE WHEN c_custkey % 29 = 0 THEN {_lon_sql('c_custkey * 13 + 7')}
            ELSE {_lon_sql('(c_custkey % 20) * 37 + 5')} + CAST((c_custkey * 104729) % 1009 AS DOUBLE) / 1009.0 * {_d(0.02)} END AS lon
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

SQL["way_nodes"] = "SELECT o_custkey AS way_id, o_orderkey AS pos, o_orderkey AS node_id FROM orders"

SQL["osm_nodes"] = f"""
SELECT o_orderkey AS node_id,
       {_lat_sql('o_custkey')} + CAST((o_orderkey * 7919) % 1000 AS DOUBLE) / 1000.0 * {_d(NODE_SPREAD)} AS lat,
       {_lon_sql('o_custkey')} + CAST((o_orderkey * 104729) % 1000 AS DOUBLE) / 1000.0 * {_d(NODE_SPREAD)} AS lon
FROM orders WHERE o_orderkey % 11 <> 0
"""

SQL["gazetteer"] = f"""
SELECT 'road_' || CAST(c_custkey AS VARCHAR) AS query, r AS rank,
       CASE WHEN (c_custkey + r) % 4 = 0 THEN 'node' WHEN (c_custkey + r) % 4 = 1 THEN 'relation' ELSE 'way' END AS osm_type,
       c_custkey * 10 + r AS osm_id,
       'Address ' || CAST(c_custkey AS VARCHAR) || '/' || CAST(r AS VARCHAR) AS address,
       {_lat_sql('c_custkey * 10 + r')} + CASE WHEN c_custkey % 5 = 0 AND r = 1 THEN 1.5 ELSE 0.0 END AS lat,
       {_lon_sql('c_custkey * 10 + r')} AS lon
FROM customer, (SELECT unnest([1, 2, 3]) AS r) ranks
WHERE c_custkey % 17 <> 0
"""

SQL["corrections"] = """
SELECT l_orderkey AS records_id,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_partkey END AS way_id,
       l_linenumber * 1000000 + l_partkey AS seq
FROM lineitem WHERE l_orderkey % 13 = 0
"""


def _districts_sql() -> str:
    r = f"CAST(floor(n_nationkey / {DISTRICT_COLS}) AS INTEGER)"
    c = f"(n_nationkey % {DISTRICT_COLS})"
    lat0 = f"(CAST({r} AS DOUBLE) * {_d(DISTRICT_DLAT)} + {_d(LAT0)})"
    lon0 = f"(CAST({c} AS DOUBLE) * {_d(DISTRICT_DLON)} + {_d(LON0)})"
    return f"""
SELECT n_name AS district, n_nationkey AS district_id,
       {lat0} AS lat0, {lon0} AS lon0,
       {lat0} + {_d(DISTRICT_DLAT)} AS lat1, {lon0} + {_d(DISTRICT_DLON)} AS lon1
FROM nation
"""


SQL["district_boxes"] = _districts_sql()


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the named proxy CTEs."""
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
    return f"WITH {ctes}\n{body}" if names else body


# ---------------------------------------------------------------------------
# OSM-shaped extracts (elements with tags, relation memberships, boundary ways)
# ---------------------------------------------------------------------------

def _tags_spark(k: Column) -> Column:
    cat = k % 7
    kv = (F.when(cat == 0, F.create_map(F.lit("amenity"), F.lit("school")))
           .when(cat == 1, F.create_map(F.lit("shop"), F.lit("supermarket")))
           .when(cat == 2, F.create_map(F.lit("leisure"), F.lit("park")))
           .when(cat == 3, F.create_map(F.lit("waterway"), F.lit("river")))
           .when((cat == 4) & (k % 2 == 0), F.create_map(F.lit("natural"), F.lit("water"), F.lit("water"), F.lit("lake")))
           .when(cat == 4, F.create_map(F.lit("natural"), F.lit("water")))
           .when(cat == 5, F.create_map(F.lit("railway"), F.lit("station")))
           .otherwise(F.create_map(F.lit("highway"), F.lit("bus_stop"))))
    name = F.when(k % 5 == 0, F.create_map()).otherwise(
        F.create_map(F.lit("name"), F.concat(F.lit("Place "), k.cast("string"))))
    return F.map_concat(kv, name.cast("map<string,string>"))


def osm_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overpass-style elements: (osm_id, osm_type, tags, coords) where coords
    is ARRAY<ARRAY<DOUBLE>> of [lat, lon]: one pair for a node or a relation
    centre (missing for some relations), the node list for a way (closed for
    some ways)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    kind = F.when(k % 3 == 0, "node").when(k % 3 == 1, "way").otherwise("relation")
    wn = way_nodes(spark, sf_dir).join(osm_nodes(spark, sf_dir), "node_id")
    lines = (wn.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "lat", "lon"))).alias("_p"))
               .select(F.col("way_id").alias("c_custkey"),
                       F.transform("_p", lambda p: F.array(p["lat"], p["lon"])).alias("_line")))
    pair = F.array(F.array(lat_of(k), lon_of(k)))
    closed = F.when(F.size("_line") > 0, F.concat(F.col("_line"), F.array(F.col("_line")[0])))
    coords = (F.when(kind == "node", pair)
               .when(kind == "relation", F.when(k % 4 == 0, F.lit(None)).otherwise(pair))
               .otherwise(F.when(k % 4 == 1, closed).otherwise(F.col("_line"))))
    return (c.join(lines, "c_custkey", "left")
             .select(k.alias("osm_id"), kind.alias("osm_type"), _tags_spark(k).alias("tags"), coords.alias("coords")))


def relation_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transit-line relations: (relation_id, pos, member_type, ref, role)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return s.select((F.col("s_nationkey") % 3).cast("bigint").alias("relation_id"),
                    F.col("s_suppkey").alias("pos"),
                    F.when(F.col("s_suppkey") % 10 == 0, "way").otherwise("node").alias("member_type"),
                    F.col("s_suppkey").alias("ref"),
                    F.when(F.col("s_suppkey") % 10 == 0, "").otherwise("stop").alias("role"))


def relation_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation").select("n_nationkey").filter(F.col("n_nationkey") < 3)
    r = F.col("n_nationkey").cast("bigint")
    return n.select(r.alias("relation_id"), F.create_map(
        F.lit("name"), F.concat(F.lit("Line "), r.cast("string")),
        F.lit("alt_name"), F.concat(F.lit("L"), r.cast("string")),
        F.lit("from"), F.concat(F.lit("Terminal A"), r.cast("string")),
        F.lit("to"), F.concat(F.lit("Terminal B"), r.cast("string"))).alias("tags"))


def station_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node extract of the stations; every 9th lacks coordinates."""
    st = stations(spark, sf_dir)
    bad = F.col("osm_id") % 9 == 0
    return st.select(F.col("osm_id").alias("node_id"),
                     F.when(bad, F.lit(None).cast("double")).otherwise(F.col("lat")).alias("lat"),
                     F.when(bad, F.lit(None).cast("double")).otherwise(F.col("lon")).alias("lon"),
                     F.create_map(F.lit("name"), F.col("name"), F.lit("ref"),
                                  F.concat(F.lit("S"), F.col("station_id"))).alias("tags"))


def boundary_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District boundary relations as member ways with node lists:
    (relation_id, way_id, role, pts ARRAY<STRUCT<lon,lat>>). The outer square
    is split into two ways (the second reversed on odd ids); every 4th
    district has a square hole."""
    d = districts(spark, sf_dir).select("district_id", F.col("rings")[0].alias("r"))
    rid = F.col("district_id").cast("bigint")
    r = F.col("r")
    a = F.array(r[0], r[1], r[2])
    b = F.when(rid % 2 == 1, F.array(r[0], r[3], r[2])).otherwise(F.array(r[2], r[3], r[0]))
    lo = F.lit(DISTRICT_DLON * 0.25)
    la = F.lit(DISTRICT_DLAT * 0.25)

    def pt(x, y):
        return F.struct(x.alias("lon"), y.alias("lat"))

    x0, y0 = r[0]["lon"] + lo, r[0]["lat"] + la
    x1, y1 = r[2]["lon"] - lo, r[2]["lat"] - la
    hole = F.array(pt(x0, y0), pt(x0, y1), pt(x1, y1), pt(x1, y0), pt(x0, y0))
    parts = F.array(F.struct(F.lit(1).alias("k"), F.lit("outer").alias("role"), a.alias("pts")),
                    F.struct(F.lit(2).alias("k"), F.lit("outer").alias("role"), b.alias("pts")),
                    F.struct(F.lit(3).alias("k"), F.lit("inner").alias("role"), hole.alias("pts")))
    m = d.select(rid.alias("relation_id"), F.explode(parts).alias("m"))
    m = m.filter((F.col("m.k") < 3) | (F.col("relation_id") % 4 == 0))
    return m.select("relation_id", (F.col("relation_id") * 10 + F.col("m.k")).alias("way_id"),
                    F.col("m.role").alias("role"), F.col("m.pts").alias("pts"))
