"""§2.5 aggregates and distinct, §2.7 set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.config import AMENITY_TYPES
from plotwise.operators import aggregates as ag
from plotwise.operators import amenities as am
from plotwise.plans.common import KM_DEG, deg, sig, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies


def _slug(t):
    return t.lower().replace(" ", "_")


@query("road_centroids", with_views(f"""
SELECT road_name, {sig_sql('median(lat)')} AS lat, {sig_sql('median(lon)')} AS lon,
       arg_min(district, records_id) FILTER (WHERE district IS NOT NULL) AS district, count(*) AS n_properties
FROM properties WHERE road_name IS NOT NULL GROUP BY road_name""", "properties"))
def q_road_centroids(spark, sf):
    c = ag.road_centroids(proxies.properties(spark, sf))
    return c.withColumns({"lat": sig(F.col("lat")), "lon": sig(F.col("lon"))})


@query("amenity_type_counts", with_views("""
SELECT feature_type, count(*) AS count FROM amenities GROUP BY feature_type ORDER BY count DESC, feature_type LIMIT 10""",
                                         "amenities"))
def q_amenity_type_counts(spark, sf):
    return ag.value_counts(proxies.amenities(spark, sf), "feature_type", 10)


def _pivot_sql():
    cols = ", ".join(f"count_if(a.feature_type = '{t}') AS \"{_slug(t)}\"" for t in AMENITY_TYPES)
    return with_views(f"""
SELECT p.records_id, {cols}
FROM properties p JOIN amenities a ON {deg('p.lat', 'p.lon', 'a.lat', 'a.lon')} <= {KM_DEG(1.0)}
GROUP BY p.records_id""", "properties", "amenities")


@query("amenity_pivot", _pivot_sql())
def q_amenity_pivot(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "lat", "lon")
    return am.amenity_pivot(p, proxies.amenities(spark, sf), radius_km=1.0, metric="degrees")


@query("distinct_ids_concat", with_views(f"""
SELECT p.records_id,
       array_to_string(list_transform(list_sort(list_distinct(list(a.osm_id))), lambda x: CAST(x AS VARCHAR)), ', ') AS ids
FROM properties p JOIN amenities a ON {deg('p.lat', 'p.lon', 'a.lat', 'a.lon')} <= {KM_DEG(2.0)}
WHERE a.feature_type = 'rail station'
GROUP BY p.records_id""", "properties", "amenities"))
def q_distinct_ids_concat(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "lat", "lon")
    a = proxies.amenities(spark, sf).filter(F.col("feature_type") == "rail station")
    return am.ids_near(p, a, 2.0, "degrees")


@query("drop_duplicates_key", with_views("""
SELECT way_id, arg_min(records_id, records_id) AS records_id, arg_min(road_name, records_id) AS road_name,
       arg_min(transaction_price, records_id) AS transaction_price
FROM properties WHERE way_id IS NOT NULL GROUP BY way_id""", "properties"))
def q_drop_duplicates_key(spark, sf):
    p = proxies.properties(spark, sf).select("way_id", "records_id", "road_name", "transaction_price")
    return ag.first_per_key(p.filter(F.col("way_id").isNotNull()), ["way_id"], "records_id")


@query("count_distinct", with_views("""
SELECT count(DISTINCT road_name) AS n_road_name, count(DISTINCT way_id) AS n_way_id, count(DISTINCT district) AS n_district
FROM properties""", "properties"))
def q_count_distinct(spark, sf):
    return ag.count_distinct(proxies.properties(spark, sf), ["road_name", "way_id", "district"])


@query("prediction_summary", with_views(f"""
SELECT count(p) AS count, {sig_sql('avg(p)')} AS mean, {sig_sql('median(p)')} AS median, min(p) AS min, max(p) AS max
FROM predictions""", "predictions"))
def q_prediction_summary(spark, sf):
    s = ag.prediction_summary(proxies.predictions(spark, sf), "p")
    return s.withColumns({"mean": sig(F.col("mean")), "median": sig(F.col("median"))})


@query("union_pois", with_views("""
SELECT osm_id, osm_type, name, lower(feature_type) AS feature_type, lat, lon,
       CAST(NULL AS VARCHAR) AS station_id, CAST(NULL AS VARCHAR) AS line_name, CAST(NULL AS INTEGER) AS train_id
FROM amenities
UNION ALL
SELECT osm_id, NULL, name, lower(feature_type), lat, lon, station_id, line_name, train_id FROM stations""",
                                "amenities", "stations"))
def q_union_pois(spark, sf):
    return ag.union_pois(proxies.amenities(spark, sf), proxies.stations(spark, sf))


_LINES = [("Kelana Jaya", 0), ("Ampang", 1), ("Kajang", 2)]


@query("union_lines", with_views("\n" + "\nUNION ALL\n".join(
    f"SELECT *, '{n}' AS line, {i} AS line_id FROM stations WHERE train_id = {i}" for n, i in _LINES),
    "stations"))
def q_union_lines(spark, sf):
    return ag.union_lines(proxies.stations(spark, sf), _LINES)
