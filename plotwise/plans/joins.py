"""§2.4 joins: amenity radius joins and nearest distances, geocoding, way
geometry, corrections, districts."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.config import AMENITY_TYPES, KM_PER_DEGREE
from plotwise.operators import amenities as am
from plotwise.operators import districts as dist
from plotwise.operators import geocode as geo
from plotwise.plans.common import SQL, deg, hav, sig, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies


def _slug(t):
    return t.lower().replace(" ", "_")


def _props(spark, sf):
    return proxies.properties(spark, sf).select("records_id", "lat", "lon")


# ---------------------------------------------------------------- amenities --

_R1 = f"{1.0 / KM_PER_DEGREE:.17e}"


def _radius_count_sql() -> str:
    counts = ", ".join(f"CAST(coalesce(c.n_{_slug(t)}, 0) AS INTEGER) AS {_slug(t)}_count" for t in AMENITY_TYPES)
    inner = ", ".join(f"count_if(a.feature_type = '{t}') AS n_{_slug(t)}" for t in AMENITY_TYPES)
    return with_views(f"""
, pairs AS (SELECT p.records_id, a.osm_id, a.feature_type FROM properties p JOIN amenities a
            ON {deg('p.lat', 'p.lon', 'a.lat', 'a.lon')} <= {_R1}),
c AS (SELECT records_id, {inner.replace('a.feature_type', 'feature_type')}, count(*) AS n_total,
             array_to_string(list_transform(list_sort(list_distinct(list(osm_id) FILTER (WHERE feature_type = 'rail station'))),
                                            lambda x: CAST(x AS VARCHAR)), ', ') AS tids
      FROM pairs GROUP BY records_id)
SELECT p.records_id, {counts}, CAST(coalesce(c.n_total, 0) AS INTEGER) AS total_amenity_count,
       coalesce(c.tids, '') AS train_ids
FROM properties p LEFT JOIN c USING (records_id)""", "properties", "amenities")


@query("radius_count", _radius_count_sql())
def q_radius_count(spark, sf):
    return am.radius_count(_props(spark, sf), proxies.amenities(spark, sf), 1.0, "degrees").drop("lat", "lon")


@query("radius_join", with_views(f"""
SELECT p.records_id, a.osm_id AS a_id, a.feature_type AS a_type,
       {sig_sql(hav('p.lat', 'p.lon', 'a.lat', 'a.lon'))} AS dist
FROM properties p JOIN amenities a ON {hav('p.lat', 'p.lon', 'a.lat', 'a.lon')} <= 1.0""",
                                 "properties", "amenities"))
def q_radius_join(spark, sf):
    pairs = am.amenity_pairs(_props(spark, sf), proxies.amenities(spark, sf), 1.0, "haversine")
    return pairs.withColumn("dist", sig(F.col("dist")))


def _nearest_sql() -> str:
    cols = ", ".join(f"coalesce({sig_sql('m.d_' + _slug(t))}, CAST('inf' AS DOUBLE)) AS nearest_{_slug(t)}"
                     for t in AMENITY_TYPES)
    mins = ", ".join(f"min(d) FILTER (WHERE feature_type = '{t}') AS d_{_slug(t)}" for t in AMENITY_TYPES)
    return with_views(f"""
, pts AS (SELECT DISTINCT lat, lon FROM properties),
m AS (SELECT pts.lat, pts.lon, {mins}
      FROM (SELECT pts.lat, pts.lon, a.feature_type, {hav('pts.lat', 'pts.lon', 'a.lat', 'a.lon')} AS d
            FROM pts, amenities a) pts GROUP BY pts.lat, pts.lon)
SELECT p.records_id, {cols} FROM properties p JOIN m USING (lat, lon)""", "properties", "amenities")


@query("nearest_amenity", _nearest_sql())
def q_nearest_amenity(spark, sf):
    out = am.nearest_amenity(_props(spark, sf), proxies.amenities(spark, sf), start_km=1.0)
    cols = [f"nearest_{_slug(t)}" for t in AMENITY_TYPES]
    return out.select("records_id", *[sig(F.col(c)).alias(c) for c in cols])


# ----------------------------------------------------------------- geocoding --

SQL["gaz_pick"] = """
SELECT query, min(CASE WHEN osm_type = 'way' THEN rn END) AS way_rn, min(rn) AS top_rn FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY rank, osm_id) AS rn FROM gazetteer
  WHERE lat BETWEEN 2.553 AND 3.716 AND lon BETWEEN 100.841 AND 102.39) c
WHERE rn <= 5 GROUP BY query"""
SQL["geocoded_names"] = """
SELECT g.query, w.osm_id AS way_id,
       CASE WHEN w.osm_id IS NULL AND t.osm_type = 'node' THEN t.osm_id END AS found_node_id,
       CASE WHEN w.osm_id IS NULL AND t.osm_type = 'node' THEN t.address END AS found_node_name
FROM gaz_pick g
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY query ORDER BY rank, osm_id) AS rn FROM gazetteer
           WHERE lat BETWEEN 2.553 AND 3.716 AND lon BETWEEN 100.841 AND 102.39) w
  ON w.query = g.query AND w.rn = g.way_rn
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY query ORDER BY rank, osm_id) AS rn FROM gazetteer
           WHERE lat BETWEEN 2.553 AND 3.716 AND lon BETWEEN 100.841 AND 102.39) t
  ON t.query = g.query AND t.rn = g.top_rn"""
SQL["geocoded_props"] = """
SELECT p.records_id, p.road_name, n.way_id, n.found_node_id, n.found_node_name
FROM properties p LEFT JOIN geocoded_names n ON p.road_name = n.query"""
_GEO_VIEWS = ("properties", "gazetteer", "gaz_pick", "geocoded_names", "geocoded_props")


def geocoded_props(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "road_name")
    return geo.geocode_lookup(p, proxies.gazetteer(spark, sf))


@query("geocode_lookup", with_views("\nSELECT * FROM geocoded_props", *_GEO_VIEWS))
def q_geocode_lookup(spark, sf):
    return geocoded_props(spark, sf)


@query("geocode_summary", with_views("""
SELECT count(*) AS total, count(way_id) AS way_found, count(found_node_id) AS node_found,
       count(*) - count(way_id) - count(found_node_id) AS not_found,
       count(way_id) / count(*) * 100.0 AS way_pct, count(found_node_id) / count(*) * 100.0 AS node_pct,
       (count(*) - count(way_id) - count(found_node_id)) / count(*) * 100.0 AS not_found_pct
FROM geocoded_props""", *_GEO_VIEWS))
def q_geocode_summary(spark, sf):
    return geo.geocode_summary(geocoded_props(spark, sf))


# -------------------------------------------------------------- way geometry --

SQL["way_pts"] = """
SELECT w.way_id, w.pos, n.lon, n.lat,
       lag(n.lon) OVER (PARTITION BY w.way_id ORDER BY w.pos) AS plon,
       lag(n.lat) OVER (PARTITION BY w.way_id ORDER BY w.pos) AS plat
FROM way_nodes w JOIN osm_nodes n USING (node_id)"""
SQL["way_stats"] = f"""
SELECT way_id, count(*) AS n_points,
       {sig_sql('sum(CASE WHEN plon IS NULL THEN 0 ELSE sqrt((lon - plon) * (lon - plon) + (lat - plat) * (lat - plat)) END)')}
         AS length_deg,
       arg_min(lon, pos) AS first_lon, arg_min(lat, pos) AS first_lat,
       arg_max(lon, pos) AS last_lon, arg_max(lat, pos) AS last_lat
FROM way_pts GROUP BY way_id HAVING count(*) >= 2"""
_WAY_VIEWS = ("way_nodes", "osm_nodes", "way_pts", "way_stats")


def _line_stats(df):
    from plotwise.functions.geometry import line_length_sql
    return df.select(
        *[c for c in df.columns if c != "line"],
        F.size("line").alias("n_points"),
        sig(F.expr(line_length_sql("line"))).alias("length_deg"),
        F.col("line")[0]["lon"].alias("first_lon"), F.col("line")[0]["lat"].alias("first_lat"),
        F.element_at("line", -1)["lon"].alias("last_lon"), F.element_at("line", -1)["lat"].alias("last_lat"))


@query("way_geometry_join", with_views("""
SELECT p.records_id, p.way_id, s.n_points, s.length_deg, s.first_lon, s.first_lat, s.last_lon, s.last_lat
FROM properties p LEFT JOIN way_stats s ON p.way_id = s.way_id""", "properties", *_WAY_VIEWS))
def q_way_geometry_join(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "way_id")
    g = geo.way_geometry_join(p, proxies.way_nodes(spark, sf), proxies.osm_nodes(spark, sf))
    out = _line_stats(g.fillna({}))
    return out.withColumn("n_points", F.when(F.col("n_points") >= 0, F.col("n_points").cast("bigint")))


@query("way_geometry_inner", with_views("""
SELECT road_name, arg_min(p.way_id, records_id) AS way_id, arg_min(s.n_points, records_id) AS n_points
FROM properties p JOIN way_stats s ON p.way_id = s.way_id GROUP BY road_name""", "properties", *_WAY_VIEWS))
def q_way_geometry_inner(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "road_name", "way_id")
    g = geo.way_geometry_inner(p, proxies.way_nodes(spark, sf), proxies.osm_nodes(spark, sf))
    return g.select("road_name", "way_id", F.size("line").cast("bigint").alias("n_points"))


def _with_lines(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "road_name", "way_id")
    return geo.way_geometry_join(p, proxies.way_nodes(spark, sf), proxies.osm_nodes(spark, sf))


@query("failed_names_anti", with_views("""
, ok AS (SELECT DISTINCT road_name FROM properties p JOIN way_stats s ON p.way_id = s.way_id)
SELECT records_id, road_name FROM properties WHERE road_name NOT IN (SELECT road_name FROM ok)""",
                                       "properties", *_WAY_VIEWS))
def q_failed_names_anti(spark, sf):
    return geo.failed_names_anti(_with_lines(spark, sf)).select("records_id", "road_name")


@query("names_except", with_views("""
SELECT road_name FROM properties
EXCEPT SELECT road_name FROM properties p JOIN way_stats s ON p.way_id = s.way_id""", "properties", *_WAY_VIEWS))
def q_names_except(spark, sf):
    return geo.names_except(_with_lines(spark, sf))


@query("apply_corrections", with_views("""
, last AS (SELECT records_id, way_id FROM (
             SELECT *, row_number() OVER (PARTITION BY records_id ORDER BY seq DESC, way_id DESC NULLS LAST) AS rn
             FROM corrections) WHERE rn = 1)
SELECT p.records_id, CASE WHEN l.records_id IS NOT NULL THEN l.way_id ELSE p.way_id END AS way_id
FROM properties p LEFT JOIN last l USING (records_id)""", "properties", "corrections"))
def q_apply_corrections(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "way_id")
    return geo.apply_corrections(p, proxies.corrections(spark, sf))


# drivable roads in the box, written out: no class of the excluded list, centre inside the four bounds
_DRIVABLE = """SELECT road_id FROM roads WHERE highway IS NOT NULL
  AND NOT regexp_matches(highway, 'footway|cycleway|pedestrian|path|steps|corridor|bridleway|proposed|construction|abandoned|platform|raceway')
  AND lat >= 2.471 AND lat <= 3.801 AND lon >= 100.775 AND lon <= 102.637"""


@query("nearest_road", with_views(f"""
, pts AS (SELECT DISTINCT lat, lon FROM properties),
v AS (SELECT w.way_id, w.pos, n.lat AS vlat, n.lon AS vlon FROM way_nodes w JOIN osm_nodes n USING (node_id)
      WHERE w.way_id IN ({_DRIVABLE})),
s AS (SELECT way_id, vlat, vlon, coalesce(lead(vlat) OVER o, vlat) AS wlat, coalesce(lead(vlon) OVER o, vlon) AS wlon
      FROM v WINDOW o AS (PARTITION BY way_id ORDER BY pos)),
-- metres east and north of the point, then the foot of the perpendicular held to the segment
m AS (SELECT pts.lat, pts.lon, way_id, (vlon - lon) * cos(radians(lat)) * 111194.92664455873 AS x0, (vlat - lat) * 111194.92664455873 AS y0,
             (wlon - vlon) * cos(radians(lat)) * 111194.92664455873 AS ex, (wlat - vlat) * 111194.92664455873 AS ey
      FROM pts, s WHERE lat BETWEEN least(vlat, wlat) - 0.001 AND greatest(vlat, wlat) + 0.001
                    AND lon BETWEEN least(vlon, wlon) - 0.001 AND greatest(vlon, wlon) + 0.001),
f AS (SELECT *, CASE WHEN ex * ex + ey * ey = 0 THEN 0 ELSE greatest(0, least(1, -(x0 * ex + y0 * ey) / (ex * ex + ey * ey))) END AS t FROM m),
near AS (SELECT DISTINCT lat, lon, way_id FROM f WHERE sqrt((x0 + t * ex) * (x0 + t * ex) + (y0 + t * ey) * (y0 + t * ey)) <= 50.0),
d AS (SELECT near.lat, near.lon, way_id, {hav('near.lat', 'near.lon', 'v.vlat', 'v.vlon')} AS d FROM near JOIN v USING (way_id)),
best AS (SELECT lat, lon, arg_min(way_id, (d, way_id)) AS near_way_id, min(d) AS d FROM d GROUP BY lat, lon)
SELECT p.records_id, b.near_way_id, {sig_sql('b.d * 1000.0')} AS near_dist_m,
       CASE WHEN b.near_way_id IS NULL THEN NULL ELSE coalesce(r.road_name, '') END AS near_road_name,
       CASE WHEN b.near_way_id IS NULL THEN NULL ELSE coalesce(r.highway, '') END AS near_road_type
FROM properties p LEFT JOIN best b USING (lat, lon) LEFT JOIN roads r ON r.road_id = b.near_way_id""",
                                  "properties", "way_nodes", "osm_nodes", "roads"))
def q_nearest_road(spark, sf):
    out = geo.nearest_road(_props(spark, sf), proxies.way_nodes(spark, sf), proxies.osm_nodes(spark, sf),
                           proxies.roads(spark, sf))
    return out.select("records_id", "near_way_id", sig(F.col("near_dist_m")).alias("near_dist_m"),
                      "near_road_name", "near_road_type")


# ----------------------------------------------------------------- districts --

@query("point_in_polygon", with_views("""
SELECT p.records_id, coalesce(p.lat >= b.lat0 AND p.lat < b.lat1 AND p.lon >= b.lon0 AND p.lon < b.lon1, false)
       AS in_expected_district
FROM properties p LEFT JOIN district_boxes b ON p.district = b.district""", "properties", "district_boxes"))
def q_point_in_polygon(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "district", "lat", "lon")
    return dist.point_in_polygon(p, proxies.districts(spark, sf)).select("records_id", "in_expected_district")


def road_lines(spark, sf):
    lines = geo.way_lines(proxies.way_nodes(spark, sf), proxies.osm_nodes(spark, sf))
    r = proxies.roads(spark, sf).select(F.col("road_id").alias("way_id"), "road_name", "district")
    return lines.join(r, "way_id")


def validated_roads(spark, sf):
    return dist.district_of_road(road_lines(spark, sf), proxies.districts(spark, sf), ["way_id"])


SQL["segs"] = """
SELECT way_id, plon AS sx0, plat AS sy0, lon AS sx1, lat AS sy1,
       sqrt((lon - plon) * (lon - plon) + (lat - plat) * (lat - plat)) AS slen
FROM way_pts WHERE plon IS NOT NULL"""
SQL["clip"] = """
SELECT s.way_id, b.district AS d, b.district_id AS did,
       greatest(0.0, least(1.0,
                CASE WHEN sx1 = sx0 THEN CASE WHEN sx0 >= lon0 AND sx0 < lon1 THEN 1.0 ELSE -1.0 END
                     ELSE greatest((lon0 - sx0) / (sx1 - sx0), (lon1 - sx0) / (sx1 - sx0)) END,
                CASE WHEN sy1 = sy0 THEN CASE WHEN sy0 >= lat0 AND sy0 < lat1 THEN 1.0 ELSE -1.0 END
                     ELSE greatest((lat0 - sy0) / (sy1 - sy0), (lat1 - sy0) / (sy1 - sy0)) END)
              - greatest(0.0,
                CASE WHEN sx1 = sx0 THEN 0.0 ELSE least((lon0 - sx0) / (sx1 - sx0), (lon1 - sx0) / (sx1 - sx0)) END,
                CASE WHEN sy1 = sy0 THEN 0.0 ELSE least((lat0 - sy0) / (sy1 - sy0), (lat1 - sy0) / (sy1 - sy0)) END)) * slen AS len
FROM segs s, district_boxes b
WHERE least(sx0, sx1) <= lon1 AND greatest(sx0, sx1) >= lon0 AND least(sy0, sy1) <= lat1 AND greatest(sy0, sy1) >= lat0"""
SQL["validated"] = f"""
, per AS (SELECT way_id, d, did, sum(len) AS ov FROM clip GROUP BY ALL HAVING sum(len) > 1e-12),
best AS (SELECT way_id, arg_max(d, (ov, -did)) AS d, max(ov) AS ov FROM per GROUP BY way_id),
tot AS (SELECT way_id, sum(slen) AS tl FROM segs GROUP BY way_id)
SELECT r.road_id AS way_id, r.road_name, r.district,
       coalesce(b.d, 'Outside any district') AS actual_district,
       coalesce(b.d = r.district, false) AS is_in_correct_district,
       {sig_sql('coalesce(b.ov, 0.0)', 8)} AS overlap_length,
       {sig_sql('coalesce(t.tl, 0.0)', 8)} AS total_road_length,
       {sig_sql('CASE WHEN coalesce(t.tl, 0) > 0 THEN coalesce(b.ov, 0.0) / t.tl * 100.0 ELSE 0.0 END', 8)}
         AS overlap_percentage
FROM roads r JOIN (SELECT DISTINCT way_id FROM segs) w ON w.way_id = r.road_id
LEFT JOIN best b ON b.way_id = r.road_id LEFT JOIN tot t ON t.way_id = r.road_id"""


def _sig8(df, cols):
    return df.withColumns({c: sig(F.col(c), 8) for c in cols})


@query("district_of_road", with_views(SQL["validated"], "roads", "way_nodes", "osm_nodes", "way_pts", "segs",
                                      "district_boxes", "clip"))
def q_district_of_road(spark, sf):
    v = validated_roads(spark, sf).drop("line")
    return _sig8(v, ["overlap_length", "total_road_length", "overlap_percentage"])


@query("join_validated", with_views(SQL["validated"].replace(
    "\nSELECT r.road_id AS way_id", ", v AS (\nSELECT r.road_id AS way_id", 1) + """)
SELECT p.records_id, p.road_name, p.way_id, v.actual_district, v.is_in_correct_district
FROM properties p LEFT JOIN v ON p.road_name = v.road_name AND p.way_id = v.way_id""",
    "properties", "roads", "way_nodes", "osm_nodes", "way_pts", "segs", "district_boxes", "clip"))
def q_join_validated(spark, sf):
    v = validated_roads(spark, sf).select("road_name", "way_id", "actual_district", "is_in_correct_district")
    p = proxies.properties(spark, sf).select("records_id", "road_name", "way_id")
    return p.join(v, ["road_name", "way_id"], "left")


@query("district_boundaries", """
SELECT n_name AS district, n_nationkey AS district_id, 1 AS n_rings FROM nation WHERE n_nationkey % 6 <> 5""")
def q_district_boundaries(spark, sf):
    from plotwise.sources.tables import read_table
    d = read_table(spark, sf, "nation").select(F.col("n_name").alias("district"), F.col("n_nationkey").alias("district_id"))
    b = proxies.districts(spark, sf).filter(F.col("district_id") % 6 != 5).select("district_id", "rings")
    out = dist.district_boundaries(d, b)
    return out.select("district", "district_id", F.size("rings").alias("n_rings"))
