"""Geocoding and road geometry: gazetteer lookups, way lines from node
extracts, nearest road, manual corrections, success summaries.

Remote geocoders are re-aimed at tables (a gazetteer of ranked candidates,
node and way extracts); every lookup is an equi-join on the name or id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.geo import KM_PER_DEG_LAT

# FIXED VALUE: highway classes the road search ignores (unanchored regex)
EXCLUDED_HIGHWAY_REGEX = ("footway|cycleway|pedestrian|path|steps|corridor|bridleway|proposed|"
                          "construction|abandoned|platform|raceway")
# FIXED VALUE: search box (south, west, north, east)
ROAD_BBOX = (2.471, 100.775, 3.801, 102.637)


def road_class_filter(roads: DataFrame, cls: str = "highway", lat: str = "lat", lon: str = "lon",
                      bbox=ROAD_BBOX, regex: str = EXCLUDED_HIGHWAY_REGEX) -> DataFrame:
    s, w, n, e = bbox
    return roads.filter(F.col(cls).isNotNull() & ~F.col(cls).rlike(regex)
                        & F.col(lat).between(s, n) & F.col(lon).between(w, e))


# FIXED VALUE: geocoder search box and result limit
GEOCODE_BBOX = (2.553, 3.716, 100.841, 102.39)  # lat_min, lat_max, lon_min, lon_max
GEOCODE_LIMIT = 5


def geocode_lookup(df: DataFrame, gazetteer: DataFrame, name_col: str = "road_name",
                   bbox=GEOCODE_BBOX, limit: int = GEOCODE_LIMIT) -> DataFrame:
    """Name → way id via ranked gazetteer candidates.

    Per distinct non-NULL name: keep candidates in the box, the best
    ``limit`` by rank; ``way_id`` = first candidate of type 'way'; if there
    is none and the top candidate is a 'node', ``found_node_id`` and
    ``found_node_name`` (its address). Results are mapped back onto all rows
    by a left join on the name.
    """
    from pyspark.sql import Window
    la0, la1, lo0, lo1 = bbox
    cand = gazetteer.filter(F.col("lat").between(la0, la1) & F.col("lon").between(lo0, lo1))
    # row_number ≤ k is planned as a per-partition group limit before the shuffle
    w = Window.partitionBy("query").orderBy("rank", "osm_id")
    cand = cand.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit)
    per_name = cand.groupBy(F.col("query").alias("_name")).agg(
        F.min(F.when(F.col("osm_type") == "way", F.struct("_rn", "osm_id"))).getField("osm_id").alias("_way"),
        F.min_by(F.struct("osm_type", "osm_id", "address"), "_rn").alias("_top"))
    per_name = per_name.select(
        "_name",
        F.col("_way").alias("way_id"),
        F.when(F.col("_way").isNull() & (F.col("_top.osm_type") == "node"), F.col("_top.osm_id")).alias("found_node_id"),
        F.when(F.col("_way").isNull() & (F.col("_top.osm_type") == "node"), F.col("_top.address")).alias("found_node_name"))
    base = df.drop("way_id", "found_node_id", "found_node_name")
    return base.join(per_name, base[name_col] == per_name["_name"], "left").drop("_name")


def geocode_summary(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    way = F.count_if(F.col("way_id").isNotNull())
    node = F.count_if(F.col("found_node_id").isNotNull())
    return df.agg(n.alias("total"), way.alias("way_found"), node.alias("node_found"),
                  (n - way - node).alias("not_found"),
                  (way / n * 100.0).alias("way_pct"), (node / n * 100.0).alias("node_pct"),
                  ((n - way - node) / n * 100.0).alias("not_found_pct"))


def way_lines(way_nodes: DataFrame, nodes: DataFrame, way_ids: DataFrame | None = None) -> DataFrame:
    """(way_id, line) for ways with ≥ 2 nodes present in the extract.

    One equi-join of memberships with node coordinates, one grouped
    ``collect_list`` per way (an OSM way has at most 2,000 nodes, so the
    group is bounded), sorted by position.
    """
    wn = way_nodes if way_ids is None else way_nodes.join(way_ids, "way_id", "left_semi")
    pts = wn.join(nodes, "node_id", "inner")
    g = pts.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("_pts"))
    return (g.filter(F.size("_pts") >= 2)
             .select("way_id", F.transform("_pts", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("line")))


def way_geometry_join(df: DataFrame, way_nodes: DataFrame, nodes: DataFrame, id_col: str = "way_id") -> DataFrame:
    """Adds ``line`` (NULL when the way has < 2 known nodes) for distinct ids."""
    ids = df.select(F.col(id_col).alias("way_id")).filter(F.col("way_id").isNotNull()).distinct()
    lines = way_lines(way_nodes, nodes, ids).withColumnRenamed("way_id", "_wid")
    return df.join(lines, df[id_col] == lines["_wid"], "left").drop("_wid")


def way_geometry_inner(df: DataFrame, way_nodes: DataFrame, nodes: DataFrame, name_col: str = "road_name",
                       id_col: str = "way_id", order_col: str = "records_id") -> DataFrame:
    """Notebook-3 variant: rows without a line are dropped, then one row per
    name (lowest ``order_col``) with name, id and line."""
    withg = way_geometry_join(df, way_nodes, nodes, id_col).filter(F.col("line").isNotNull())
    first = withg.groupBy(name_col).agg(F.min_by(F.struct(id_col, "line"), F.col(order_col)).alias("_f"))
    return first.select(name_col, F.col(f"_f.{id_col}").alias(id_col), F.col("_f.line").alias("line"))


def apply_corrections(df: DataFrame, corrections: DataFrame, id_col: str = "records_id",
                      value_col: str = "way_id", seq_col: str = "seq") -> DataFrame:
    """Set ``value_col`` from the corrections table; for an id corrected more
    than once the last (highest ``seq``) wins, and a NULL correction
    overwrites (so no coalesce)."""
    last = corrections.groupBy(F.col(id_col).alias("_cid")).agg(
        F.max_by(F.col(value_col), F.struct(F.col(seq_col), F.col(value_col))).alias("_new"))
    j = df.join(last, df[id_col] == last["_cid"], "left")
    return j.withColumn(value_col, F.when(F.col("_cid").isNotNull(), F.col("_new")).otherwise(F.col(value_col))) \
            .drop("_cid", "_new")


def failed_names_anti(df: DataFrame, geom_col: str = "line", name_col: str = "road_name") -> DataFrame:
    """Rows whose name never received a geometry (left anti join on names
    that have a non-NULL geometry)."""
    ok = df.filter(F.col(geom_col).isNotNull()).select(name_col).distinct()
    return df.join(ok, name_col, "left_anti")


def names_except(df: DataFrame, geom_col: str = "line", name_col: str = "road_name") -> DataFrame:
    names = df.select(name_col).filter(F.col(name_col).isNotNull())
    ok = df.filter(F.col(geom_col).isNotNull()).select(name_col)
    return names.subtract(ok)


#: Grid of the segment search, in degrees: a few times the radius, so that most segments touch one to four cells.
SEGMENT_CELL_DEG = 0.005


def nearest_road(points: DataFrame, way_nodes: DataFrame, nodes: DataFrame, roads: DataFrame,
                 point_id: str = "records_id", radius_m: float = 50.0, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Point → road: among roads of a drivable class in the search box
    (``road_class_filter``) that pass within ``radius_m`` of the point with any
    segment, the one with the nearest vertex (great-circle); ties → smaller way
    id. Adds ``near_way_id``, ``near_road_name`` ('' if unnamed),
    ``near_road_type`` ('' if unclassed) and ``near_dist_m`` (to that vertex);
    none → NULLs.

    Each distinct point is searched once. Segments go to the grid cells that
    their box, widened by the radius, covers; points only to their own.
    """
    from pyspark.sql import Window

    from plotwise.functions.geo import haversine_km
    allowed = road_class_filter(roads).select(F.col("road_id").alias("way_id"), F.coalesce("road_name", F.lit("")).alias("near_road_name"),
                                              F.coalesce("highway", F.lit("")).alias("near_road_type"))
    verts = (way_nodes.join(allowed.select("way_id"), "way_id", "left_semi").join(nodes, "node_id")
                      .select("way_id", "pos", F.col("lat").alias("vlat"), F.col("lon").alias("vlon")))
    # a way has at most 2,000 nodes; its last vertex closes as a segment of length 0, so one-vertex ways count too
    step = Window.partitionBy("way_id").orderBy("pos")
    segs = verts.select("way_id", "vlat", "vlon", F.coalesce(F.lead("vlat").over(step), "vlat").alias("wlat"),
                        F.coalesce(F.lead("vlon").over(step), "vlon").alias("wlon"))
    km = radius_m / 1000.0
    reach_lat = km / KM_PER_DEG_LAT
    reach_lon = F.lit(reach_lat) / F.cos(F.radians(F.greatest(F.abs("vlat"), F.abs("wlat")) + reach_lat))

    def cells(x: str, y: str, reach) -> Column:
        c = SEGMENT_CELL_DEG
        return F.sequence(F.floor((F.least(x, y) - reach) / c), F.floor((F.greatest(x, y) + reach) / c))

    dealt = (segs.withColumn("cell_r", F.explode(cells("vlat", "wlat", reach_lat)))
                 .withColumn("cell_c", F.explode(cells("vlon", "wlon", reach_lon))))
    pts = (points.select(F.col(lat).alias("_plat"), F.col(lon).alias("_plon")).distinct()
                 .withColumns({"cell_r": F.floor(F.col("_plat") / SEGMENT_CELL_DEG), "cell_c": F.floor(F.col("_plon") / SEGMENT_CELL_DEG)}))
    # plane around the point: exact to centimetres over a street
    flat = F.cos(F.radians("_plat"))
    ax, ay = (F.col("vlon") - F.col("_plon")) * flat, F.col("vlat") - F.col("_plat")
    bx, by = (F.col("wlon") - F.col("_plon")) * flat, F.col("wlat") - F.col("_plat")
    dx, dy = bx - ax, by - ay
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(-(ax * dx + ay * dy), dx * dx + dy * dy), F.lit(0.0))))
    away = F.hypot(ax + t * dx, ay + t * dy) * KM_PER_DEG_LAT
    passed = pts.join(dealt, ["cell_r", "cell_c"]).filter(away <= km).select("_plat", "_plon", "way_id").distinct()
    best = (passed.join(verts, "way_id").withColumn("d_km", haversine_km("_plat", "_plon", "vlat", "vlon"))
                  .groupBy("_plat", "_plon").agg(F.min(F.struct("d_km", "way_id")).alias("_b"))
                  .select("_plat", "_plon", F.col("_b.way_id").alias("near_way_id"), (F.col("_b.d_km") * 1000.0).alias("near_dist_m")))
    found = best.join(allowed.withColumnRenamed("way_id", "near_way_id"), "near_way_id")
    return (points.join(found, (F.col(lat) == F.col("_plat")) & (F.col(lon) == F.col("_plon")), "left").drop("_plat", "_plon"))
