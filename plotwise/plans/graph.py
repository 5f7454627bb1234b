"""§2.8 graph: scan/union of graphs, node snapping, network distances,
walk/drive merge; §2.4 amenity features (composition)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.config import AMENITY_TYPES
from plotwise.operators import graph as gr
from plotwise.operators.amenities import radius_count
from plotwise.plans.common import SQL, hav, sig, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies


def _slug(t):
    return t.lower().replace(" ", "_")


SQL["wp"] = """
SELECT way_id, arg_min(lat, records_id) AS lat, arg_min(lon, records_id) AS lon
FROM properties WHERE way_id IS NOT NULL GROUP BY way_id"""
SQL["wn"] = f"""
SELECT way_id, arg_min(n.node_id, ({hav('wp.lat', 'wp.lon', 'n.lat', 'n.lon')}, n.node_id)) AS node_id,
       min({hav('wp.lat', 'wp.lon', 'n.lat', 'n.lon')}) AS snap_km
FROM wp, graph_nodes n GROUP BY way_id"""
SQL["an"] = f"""
SELECT a.osm_id, a.feature_type AS grp,
       arg_min(n.node_id, ({hav('a.lat', 'a.lon', 'n.lat', 'n.lon')}, n.node_id)) AS node_id
FROM amenities a, graph_nodes n GROUP BY a.osm_id, a.feature_type"""


def _dist_sql(edges: str) -> str:
    return f"""
SELECT node_id, grp, d FROM (
WITH RECURSIVE dist(node_id, grp, d) USING KEY (node_id, grp) AS (
  SELECT DISTINCT node_id, grp, CAST(0.0 AS DOUBLE) AS d FROM an
  UNION
  (SELECT c.node_id, c.grp, c.d FROM (
      SELECT e.src AS node_id, dist.grp, min(dist.d + e.len) AS d
      FROM dist JOIN (SELECT src, dst, min(length_m) AS len FROM {edges} GROUP BY src, dst) e ON e.dst = dist.node_id
      GROUP BY e.src, dist.grp) c
   LEFT JOIN recurring.dist r ON r.node_id = c.node_id AND r.grp = c.grp
   WHERE r.d IS NULL OR c.d < r.d))
SELECT * FROM dist)"""


SQL["drive_dist"] = _dist_sql("drive_edges")
SQL["walk_dist"] = _dist_sql("walk_edges")


def _per_way_sql(dist_view: str, prefix: str) -> str:
    cols = ", ".join(f"min(d) FILTER (WHERE grp = '{t}') / 1000.0 AS {prefix}{_slug(t)}" for t in AMENITY_TYPES)
    return f"SELECT wn.way_id, {cols} FROM wn JOIN {dist_view} USING (node_id) GROUP BY wn.way_id"


SQL["drive_way"] = _per_way_sql("drive_dist", "dist_to_")
SQL["walk_way"] = _per_way_sql("walk_dist", "walk_dist_to_")
_G = ("properties", "amenities", "graph_nodes", "wp", "wn", "an")


@query("scan_graph", with_views("""
SELECT src, dst, min(length_m) AS length_m FROM (
  SELECT * FROM drive_edges WHERE src < 1000 UNION ALL SELECT * FROM drive_edges WHERE src >= 500
  UNION ALL SELECT * FROM walk_edges)
GROUP BY src, dst""", "drive_edges", "walk_edges"))
def q_scan_graph(spark, sf):
    d = proxies.graph_edges(spark, sf, "drive")
    w = proxies.graph_edges(spark, sf, "walk")
    return gr.union_graphs(d.filter(F.col("src") < 1000), d.filter(F.col("src") >= 500), w)


@query("node_snap", with_views(f"\nSELECT way_id, node_id, {sig_sql('snap_km')} AS snap_km FROM wn", *_G))
def q_node_snap(spark, sf):
    p = proxies.properties(spark, sf).filter(F.col("way_id").isNotNull())
    ways = p.groupBy("way_id").agg(F.min_by(F.struct("lat", "lon"), "records_id").alias("_p")) \
            .select("way_id", "_p.lat", "_p.lon")
    s = gr.snap_to_nodes(ways, proxies.graph_nodes(spark, sf), "way_id")
    return s.select("way_id", "node_id", sig(F.col("snap_km")).alias("snap_km"))


def _drive(spark, sf, mode="drive", prefix="dist_to_"):
    p = proxies.properties(spark, sf).select("records_id", "way_id", "lat", "lon")
    return gr.network_distance(p, proxies.amenities(spark, sf), proxies.graph_nodes(spark, sf),
                               proxies.graph_edges(spark, sf, mode), AMENITY_TYPES, prefix=prefix)


_DRIVE_COLS = [f"dist_to_{_slug(t)}" for t in AMENITY_TYPES]
_WALK_COLS = [f"walk_dist_to_{_slug(t)}" for t in AMENITY_TYPES]


@query("network_distance", with_views(f"""
SELECT p.records_id, {', '.join(f'{sig_sql("w." + c)} AS {c}' for c in _DRIVE_COLS)}
FROM properties p LEFT JOIN drive_way w USING (way_id)""", *_G, "drive_edges", "drive_dist", "drive_way"))
def q_network_distance(spark, sf):
    d = _drive(spark, sf)
    return d.select("records_id", *[sig(F.col(c)).alias(c) for c in _DRIVE_COLS])


@query("walk_drive_merge", with_views(f"""
SELECT p.records_id, {', '.join(f'{sig_sql(c)} AS {c}' for c in _WALK_COLS + _DRIVE_COLS)}
FROM properties p LEFT JOIN (walk_way FULL JOIN drive_way USING (way_id)) USING (way_id)""",
    *_G, "drive_edges", "walk_edges", "drive_dist", "walk_dist", "drive_way", "walk_way"))
def q_walk_drive_merge(spark, sf):
    walk = _drive(spark, sf, "walk", "walk_dist_to_").select("way_id", *_WALK_COLS).dropDuplicates(["way_id"])
    drive = _drive(spark, sf).select("way_id", *_DRIVE_COLS).dropDuplicates(["way_id"])
    walk = walk.filter(F.col("way_id").isNotNull())
    drive = drive.filter(F.col("way_id").isNotNull())
    p = proxies.properties(spark, sf).select("records_id", "way_id")
    m = gr.walk_drive_merge(p, walk, drive)
    return m.select("records_id", *[sig(F.col(c)).alias(c) for c in _WALK_COLS + _DRIVE_COLS])


@query("amenity_features")
def q_amenity_features(spark, sf):
    """Counts within 1 km plus walk and drive network distances per type."""
    p = proxies.properties(spark, sf).select("records_id", "way_id", "lat", "lon")
    counted = radius_count(p, proxies.amenities(spark, sf), 1.0, "degrees")
    walk = _drive(spark, sf, "walk", "walk_dist_to_").select("records_id", *_WALK_COLS)
    drive = _drive(spark, sf).select("records_id", *_DRIVE_COLS)
    return counted.join(walk, "records_id", "left").join(drive, "records_id", "left")
