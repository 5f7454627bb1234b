"""§2.1 scans, sources and sinks. Each query writes data that Spark derives
from the driver tables to the shared scratch location, then reads it back
through the operator under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.operators.validate import coords_in_range
from plotwise.plans.common import with_views
from plotwise.plans.registry import query
from plotwise.session import scratch_path
from plotwise.sources import files, proxies

_PROP_COLS = ["records_id", "date", "property_type", "tenure", "district", "road_name", "way_id",
              "transaction_price", "property_m2", "land_m2", "unit_level", "lat", "lon"]
_PROP_SCHEMA = ("records_id bigint, date date, property_type string, tenure string, district string, "
                "road_name string, way_id bigint, transaction_price double, property_m2 bigint, land_m2 bigint, "
                "unit_level bigint, lat double, lon double")


@query("scan_csv", with_views(f"\nSELECT {', '.join(_PROP_COLS)} FROM properties", "properties"))
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "raw") + ".csv"
    proxies.properties(spark, sf).select(*_PROP_COLS).write.mode("overwrite").option("header", True).csv(path)
    return files.load_raw(spark, path, schema=_PROP_SCHEMA)


@query("scan_stage", with_views(f"\nSELECT {', '.join(_PROP_COLS)}, coords_valid FROM properties, "
                                "(SELECT true AS coords_valid)", "properties"))
def q_scan_stage(spark, sf):
    base = scratch_path(spark, "stages")
    geo = coords_in_range(proxies.properties(spark, sf).select(*_PROP_COLS))
    files.save_stage(geo, base, "geocoded")
    return files.load_stage(spark, base, "geocoded")


@query("scan_training", with_views(f"\nSELECT {', '.join(_PROP_COLS)} FROM properties", "properties"))
def q_scan_training(spark, sf):
    """Without a clustered stage the merged one is used."""
    base = scratch_path(spark, "stages")
    files.save_stage(proxies.properties(spark, sf).select(*_PROP_COLS), base, "merged")
    return files.load_training(spark, base)


@query("sink_stage", with_views(f"\nSELECT 'raw' AS stage, count(*) AS rows, CAST({len(_PROP_COLS)} AS INTEGER) AS columns FROM properties", "properties"))
def q_sink_stage(spark, sf):
    base = scratch_path(spark, "stages")
    rep = files.save_stage(proxies.properties(spark, sf).select(*_PROP_COLS), base, "raw")
    return spark.createDataFrame([(rep["stage"], rep["rows"], rep["columns"])], "stage string, rows long, columns int")


@query("sink_failed_csv", with_views("""
SELECT records_id, way_id FROM properties WHERE way_id IS NULL""", "properties"))
def q_sink_failed_csv(spark, sf):
    path = scratch_path(spark, "failed") + ".csv"
    df = coords_in_range(proxies.properties(spark, sf).select("records_id", "way_id", "lat", "lon"))
    n = files.sink_failed_csv(df, path)
    if n == 0:
        return spark.createDataFrame([], "records_id bigint, way_id bigint")
    return files.load_raw(spark, path, schema="records_id bigint, way_id bigint, lat double, lon double, "
                                              "coords_valid boolean").select("records_id", "way_id")


@query("sink_predictions", with_views("\nSELECT id, y, p AS prediction FROM predictions", "predictions"))
def q_sink_predictions(spark, sf):
    path = scratch_path(spark, "predictions") + ".csv"
    files.sink_predictions(proxies.predictions(spark, sf).select("id", "y", F.col("p").alias("prediction")), path)
    return files.load_raw(spark, path, schema="id bigint, y double, prediction double")


def _osm_json_lines(spark, sf):
    el = proxies.osm_elements(spark, sf)
    wn = proxies.way_nodes(spark, sf).groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "node_id"))).alias("_n"))
    wn = wn.select(F.col("way_id").alias("osm_id"), F.transform("_n", lambda x: x["node_id"]).alias("nodes"))
    j = el.filter(F.col("osm_type").isin("node", "way")).join(wn, "osm_id", "left")
    obj = F.struct(F.col("osm_type").alias("type"), F.col("osm_id").alias("id"),
                   F.when(F.col("osm_type") == "node", F.col("coords")[0][0]).alias("lat"),
                   F.when(F.col("osm_type") == "node", F.col("coords")[0][1]).alias("lon"),
                   F.when(F.col("osm_type") == "way", F.col("nodes")).alias("nodes"), F.col("tags"))
    return j.select(F.to_json(obj).alias("value"))


@query("scan_osm_json", with_views(f"""
SELECT c_custkey AS node_id, {proxies._lat_sql('c_custkey')} AS lat, {proxies._lon_sql('c_custkey')} AS lon,
       CAST(NULL AS BIGINT) AS n_refs, 'node' AS type
FROM customer WHERE c_custkey % 3 = 0
UNION ALL
SELECT c_custkey, NULL, NULL, (SELECT count(*) FROM way_nodes w WHERE w.way_id = c_custkey), 'way'
FROM customer WHERE c_custkey % 3 = 1""", "way_nodes"))
def q_scan_osm_json(spark, sf):
    path = scratch_path(spark, "overpass") + ".jsonl"
    _osm_json_lines(spark, sf).write.mode("overwrite").text(path)
    nodes, ways = files.scan_osm_json(spark, path)
    n = nodes.select("node_id", "lat", "lon", F.lit(None).cast("bigint").alias("n_refs"), F.lit("node").alias("type"))
    w = ways.select(F.col("way_id").alias("node_id"), F.lit(None).cast("double").alias("lat"),
                    F.lit(None).cast("double").alias("lon"), F.coalesce(F.size("nodes"), F.lit(0)).cast("bigint").alias("n_refs"),
                    F.lit("way").alias("type"))
    return n.unionByName(w)


def _write_osm_xml(spark, sf, path):
    """Nodes and ways written by Spark's XML writer (root <osm>, attributes
    from ``_``-prefixed columns, one part file per task)."""
    nodes = proxies.osm_nodes(spark, sf).select(F.col("node_id").alias("_id"), F.col("lat").alias("_lat"),
                                                F.col("lon").alias("_lon"))
    wn = proxies.way_nodes(spark, sf).groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "node_id"))).alias("_n"))
    ways = wn.select(F.col("way_id").alias("_id"),
                     F.transform("_n", lambda x: F.struct(x["node_id"].alias("_ref"))).alias("nd"),
                     F.array(F.struct(F.lit("name").alias("_k"),
                                      F.concat(F.lit("road_"), F.col("way_id").cast("string")).alias("_v"))).alias("tag"))
    nodes.write.mode("overwrite").format("xml").option("rootTag", "osm").option("rowTag", "node").save(f"{path}/nodes")
    ways.write.mode("overwrite").format("xml").option("rootTag", "osm").option("rowTag", "way").save(f"{path}/ways")


@query("scan_osm_xml", with_views("""
SELECT w.way_id, count(*) AS n_refs, count(n.node_id) AS n_located, min(w.node_id) AS first_ref
FROM way_nodes w LEFT JOIN osm_nodes n USING (node_id) GROUP BY w.way_id""", "way_nodes", "osm_nodes"))
def q_scan_osm_xml(spark, sf):
    path = scratch_path(spark, "osm")
    _write_osm_xml(spark, sf, path)
    nodes, way_nodes, _ = files.scan_osm_xml(spark, f"{path}/*")
    j = way_nodes.join(nodes, "node_id", "left")
    return j.groupBy("way_id").agg(F.count(F.lit(1)).alias("n_refs"), F.count("lat").alias("n_located"),
                                   F.min_by("node_id", "pos").alias("first_ref"))
