"""File sources and sinks: raw CSV/Parquet/JSON, named stage tables, OSM
extracts (JSON lines, XML).

Stage tables and every other scratch output live under the shared
checkpoint directory (see ``session.scratch_path``) or a base directory the
caller passes – never a machine-local temp folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STAGES = ("raw", "geocoded", "with_features", "merged", "clustered", "processed")
FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json"}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_raw(spark: SparkSession, path: str, file_type: str = "auto", schema: StructType | str | None = None) -> DataFrame:
    """Read a raw table; the suffix decides the format ('auto'); unknown
    suffix → ValueError; missing path → FileNotFoundError; a header-only CSV
    gives zero rows."""
    if file_type == "auto":
        ext = os.path.splitext(path.rstrip("/"))[1].lower()
        if ext not in FORMATS:
            raise ValueError(f"Unsupported file type: {ext or path}")
        file_type = FORMATS[ext]
    if file_type not in set(FORMATS.values()):
        raise ValueError(f"Unsupported file type: {file_type}")
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if file_type == "csv":
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    if file_type == "json":
        return reader.json(path)
    return reader.parquet(path)


def stage_path(base: str, stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(f"Unknown stage {stage!r}; expected one of {STAGES}")
    return os.path.join(base, stage)


def save_stage(df: DataFrame, base: str, stage: str, fmt: str = "parquet") -> dict:
    """Overwrite the stage table; returns rows × columns, counted while
    writing (``Observation``), not by a second pass."""
    obs = Observation(f"stage_{stage}")
    path = stage_path(base, stage)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt) \
      .options(**({"header": True} if fmt == "csv" else {})).save(path)
    return {"stage": stage, "rows": obs.get["rows"], "columns": len(df.columns), "path": path}


def load_stage(spark: SparkSession, base: str, stage: str, custom_path: str | None = None) -> DataFrame:
    path = custom_path or stage_path(base, stage)
    if not _exists(spark, path):
        raise FileNotFoundError(f"No {stage!r} data at {path}; run the earlier pipeline stage first")
    return spark.read.parquet(path)


def load_training(spark: SparkSession, base: str, data_path: str | None = None, use_clustered: bool = True) -> DataFrame:
    """Custom path, else the clustered stage, else the merged one."""
    if data_path:
        return load_raw(spark, data_path)
    if use_clustered and _exists(spark, stage_path(base, "clustered")):
        return load_stage(spark, base, "clustered")
    return load_stage(spark, base, "merged")


def sink_failed_csv(df: DataFrame, path: str, way: str = "way_id", valid: str = "coords_valid") -> int:
    """Write only the rows that failed geocoding, and only when there are
    any; returns how many were written (counted while writing)."""
    from plotwise.operators.validate import failed_geocodes
    failed = failed_geocodes(df, way, valid)
    if failed.isEmpty():
        return 0
    obs = Observation("failed_rows")
    failed.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("header", True).csv(path)
    return obs.get["n"]


def sink_predictions(scored: DataFrame, path: str, fmt: str = "csv") -> None:
    scored.write.mode("overwrite").format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)


# ---------------------------------------------------------------------------
# OSM extracts
# ---------------------------------------------------------------------------

OSM_JSON_SCHEMA = ("type string, id long, lat double, lon double, nodes array<long>, "
                   "members array<struct<type:string,ref:long,role:string>>, tags map<string,string>")


def scan_osm_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Overpass elements (one JSON object per line) → (nodes, ways)."""
    el = spark.read.schema(OSM_JSON_SCHEMA).json(path)
    nodes = el.filter(F.col("type") == "node").select(F.col("id").alias("node_id"), "lat", "lon", "tags")
    ways = el.filter(F.col("type") == "way").select(F.col("id").alias("way_id"), "nodes", "tags")
    return nodes, ways


OSM_XML_NODE_SCHEMA = "_id long, _lat double, _lon double, tag array<struct<_k:string,_v:string>>"
OSM_XML_WAY_SCHEMA = "_id long, nd array<struct<_ref:long>>, tag array<struct<_k:string,_v:string>>"


def scan_osm_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """OSM XML → node, way (ordered refs, exploded with position) and tag
    tables, with Spark's built-in XML reader and explicit schemas (no
    inference pass; single children still read as arrays)."""
    nodes = (spark.read.format("xml").option("rowTag", "node").schema(OSM_XML_NODE_SCHEMA).load(path)
             .select(F.col("_id").alias("node_id"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon")))
    way_raw = spark.read.format("xml").option("rowTag", "way").schema(OSM_XML_WAY_SCHEMA).load(path)
    way_nodes = (way_raw.select(F.col("_id").alias("way_id"), F.posexplode(F.col("nd")).alias("pos", "nd"))
                        .select("way_id", "pos", F.col("nd._ref").alias("node_id")))
    way_tags = (way_raw.select(F.col("_id").alias("way_id"), F.explode_outer("tag").alias("t"))
                       .select("way_id", F.col("t._k").alias("k"), F.col("t._v").alias("v")))
    return nodes, way_nodes, way_tags


OSM_XML_RELATION_SCHEMA = ("_id long, member array<struct<_type:string,_ref:long,_role:string>>, "
                           "tag array<struct<_k:string,_v:string>>")


def scan_osm_relations(spark: SparkSession, path: str, fmt: str = "xml") -> tuple[DataFrame, DataFrame]:
    """Relations of an OSM XML extract or of Overpass JSON lines → members
    (relation_id, pos, member_type, ref, role; in file order) and tags
    (relation_id, tags)."""
    if fmt == "xml":
        raw = spark.read.format("xml").option("rowTag", "relation").schema(OSM_XML_RELATION_SCHEMA).load(path)
        rel = raw.select(F.col("_id").alias("relation_id"),
                         F.transform("member", lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role"))).alias("members"),
                         F.map_from_entries(F.transform(F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>")),
                                                        lambda t: F.struct(t["_k"], t["_v"]))).alias("tags"))
    elif fmt == "json":
        rel = (spark.read.schema(OSM_JSON_SCHEMA).json(path).filter(F.col("type") == "relation")
               .select(F.col("id").alias("relation_id"), "members", "tags"))
    else:
        raise ValueError(f"unknown format {fmt!r}; expected xml or json")
    members = (rel.select("relation_id", F.posexplode("members").alias("pos", "m"))
                  .select("relation_id", "pos", F.col("m.type").alias("member_type"), F.col("m.ref").alias("ref"),
                          F.coalesce("m.role", F.lit("")).alias("role")))
    return members, rel.select("relation_id", "tags")
