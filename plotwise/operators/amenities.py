"""Amenity features: counts within a radius, nearest distances, pivots.

Pairs come from the grid equi-join in ``spatial``; everything after is a
grouped aggregate with map-side partial aggregation, then one left join back
to the properties. The per-type counts use the known type list, so no extra
pass is needed to discover pivot values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.config import AMENITY_RADIUS_KM, AMENITY_TYPES, KM_PER_DEGREE, TRAIN_TYPE_NAME
from plotwise.operators.aggregates import distinct_ids_concat
from plotwise.operators.shapes import shape_join
from plotwise.operators.spatial import nearest, radius_join


def type_slug(t: str) -> str:
    return str(t).lower().replace(" ", "_")


def _amenity_side(amenities: DataFrame, amen_id: str, type_col: str, lat: str, lon: str) -> DataFrame:
    return amenities.select(F.col(amen_id).alias("a_id"), F.col(type_col).alias("a_type"),
                            F.col(lat).alias("r_lat"), F.col(lon).alias("r_lon"))


def amenity_pairs(props: DataFrame, amenities: DataFrame, radius_km: float = AMENITY_RADIUS_KM,
                  metric: str = "degrees", prop_id: str = "records_id", amen_id: str = "osm_id",
                  type_col: str = "feature_type", lat: str = "lat", lon: str = "lon",
                  a_lat: str = "lat", a_lon: str = "lon") -> DataFrame:
    """(prop_id, a_id, a_type, dist) for every amenity within the radius.

    ``degrees`` reproduces the reference's buffer of radius_km/111 degrees in
    EPSG:4326; ``haversine`` measures great-circle km.
    """
    radius = radius_km / KM_PER_DEGREE if metric == "degrees" else radius_km
    a = _amenity_side(amenities, amen_id, type_col, a_lat, a_lon)
    p = props.select(prop_id, lat, lon)
    return radius_join(p, a, radius, metric, lat, lon, "r_lat", "r_lon").select(prop_id, "a_id", "a_type", "dist")


def _distinct_points(props: DataFrame, lat: str, lon: str) -> DataFrame:
    """Sales geocoded to the same road share one point: join each distinct
    point once, then map results back with an equi-join on (lat, lon)."""
    return props.select(lat, lon).filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).distinct() \
                .withColumn("_pt", F.struct(lat, lon))


def _counts(pairs: DataFrame, by: list[str], types: list[str], train_type: str) -> DataFrame:
    """Per group of pairs: ``{type}_count``, ``total_amenity_count`` and ``train_ids``."""
    aggs = [F.count_if(F.col("a_type") == ty).cast("int").alias(f"{type_slug(ty)}_count") for ty in types]
    aggs.append(F.count(F.lit(1)).cast("int").alias("total_amenity_count"))
    train = F.array_sort(F.collect_set(F.when(F.lower(F.col("a_type")) == train_type.lower(), F.col("a_id"))))
    aggs.append(F.array_join(F.transform(train, lambda x: x.cast("string")), ", ").alias("train_ids"))
    return pairs.groupBy(*by).agg(*aggs)


def _no_counts(types: list[str]) -> dict:
    return {**{f"{type_slug(ty)}_count": 0 for ty in types}, "total_amenity_count": 0, "train_ids": ""}


def shape_pairs(roads: DataFrame, amenities: DataFrame, radius_km: float = AMENITY_RADIUS_KM, road_id: str = "way_id",
                amen_id: str = "osm_id", type_col: str = "feature_type") -> DataFrame:
    """(road_id, a_id, a_type, dist) of amenity shapes (points, lines, areas;
    see ``shapes``) within radius_km/111 degrees of a road's line. Amenity ids are unique."""
    a = amenities.select(F.col(amen_id).alias("a_id"), F.col(type_col).alias("a_type"), "parts", "is_area")
    near = shape_join(roads, a, radius_km / KM_PER_DEGREE, road_id, "a_id")
    return near.join(a.select("a_id", "a_type").hint("merge"), "a_id").select(road_id, "a_id", "a_type", "dist")


def shape_count(props: DataFrame, roads: DataFrame, amenities: DataFrame, radius_km: float = AMENITY_RADIUS_KM,
                types: list[str] | None = None, road_id: str = "way_id", amen_id: str = "osm_id",
                type_col: str = "feature_type", train_type: str = TRAIN_TYPE_NAME) -> DataFrame:
    """``radius_count`` from the line of each sale's road to whole amenity
    shapes. Sales of a road share its counts; a sale whose road has no line counts nothing."""
    types = AMENITY_TYPES if types is None else types
    per_road = _counts(shape_pairs(roads, amenities, radius_km, road_id, amen_id, type_col), [road_id], types, train_type)
    return props.join(per_road, road_id, "left").fillna(_no_counts(types))


def radius_count(props: DataFrame, amenities: DataFrame, radius_km: float = AMENITY_RADIUS_KM,
                 metric: str = "degrees", types: list[str] | None = None, prop_id: str = "records_id",
                 amen_id: str = "osm_id", type_col: str = "feature_type", train_type: str = TRAIN_TYPE_NAME,
                 lat: str = "lat", lon: str = "lon", a_lat: str = "lat", a_lon: str = "lon") -> DataFrame:
    """Adds ``{type}_count`` per amenity type, ``total_amenity_count`` and
    ``train_ids`` (distinct ids of the train type, ascending, joined ', ')."""
    types = AMENITY_TYPES if types is None else types
    pts = props.select(lat, lon).filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).distinct()
    radius = radius_km / KM_PER_DEGREE if metric == "degrees" else radius_km
    pairs = radius_join(pts, _amenity_side(amenities, amen_id, type_col, a_lat, a_lon), radius, metric,
                        lat, lon, "r_lat", "r_lon")
    per_pt = _counts(pairs, [lat, lon], types, train_type)
    return props.join(per_pt, [lat, lon], "left").fillna(_no_counts(types))


def amenity_pivot(props: DataFrame, amenities: DataFrame, types: list[str] | None = None,
                  radius_km: float = AMENITY_RADIUS_KM, metric: str = "degrees",
                  prop_id: str = "records_id", amen_id: str = "osm_id", type_col: str = "feature_type",
                  lat: str = "lat", lon: str = "lon", a_lat: str = "lat", a_lon: str = "lon") -> DataFrame:
    """Pair counts by (property, type) pivoted wide over the given types, 0-filled;
    properties without any pair are absent (as in an unstack). Each distinct point is joined once."""
    types = AMENITY_TYPES if types is None else types
    radius = radius_km / KM_PER_DEGREE if metric == "degrees" else radius_km
    pts = _distinct_points(props, lat, lon).select(lat, lon)
    pairs = radius_join(pts, _amenity_side(amenities, amen_id, type_col, a_lat, a_lon), radius, metric, lat, lon, "r_lat", "r_lon")
    per_pt = pairs.groupBy(lat, lon).pivot("a_type", types).count()
    wide = props.select(prop_id, lat, lon).join(per_pt, [lat, lon]).groupBy(prop_id).agg(*[F.sum(F.col(f"`{t}`")).alias(t) for t in types])
    return wide.fillna(0, subset=types).withColumnsRenamed({t: type_slug(t) for t in types})


def ids_near(props: DataFrame, amenities: DataFrame, radius_km: float = AMENITY_RADIUS_KM, metric: str = "degrees",
             prop_id: str = "records_id", amen_id: str = "osm_id", type_col: str = "feature_type", lat: str = "lat",
             lon: str = "lon", a_lat: str = "lat", a_lon: str = "lon", out: str = "ids") -> DataFrame:
    """(prop_id, ids): distinct ids of the amenities within the radius, ascending, joined ', '; properties without
    any are absent. Properties of the same point (or points, where an id repeats) share one list, which is made
    once and met by an equi-join, so pairs are never shuffled per property."""
    radius = radius_km / KM_PER_DEGREE if metric == "degrees" else radius_km
    at = (props.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
               .groupBy(prop_id).agg(F.array_sort(F.collect_set(F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")))).alias("_pts")))
    pts = at.select("_pts").distinct().select("_pts", F.explode("_pts").alias("_p")).select("_pts", "_p.lat", "_p.lon")
    pairs = radius_join(pts, _amenity_side(amenities, amen_id, type_col, a_lat, a_lon), radius, metric, "lat", "lon", "r_lat", "r_lon")
    return at.join(distinct_ids_concat(pairs, "_pts", "a_id", out), "_pts").select(prop_id, out)


def nearest_amenity(props: DataFrame, amenities: DataFrame, prop_id: str = "records_id",
                    type_col: str | None = "feature_type", start_km: float = 1.0,
                    lat: str = "lat", lon: str = "lon", a_lat: str = "lat", a_lon: str = "lon",
                    out_prefix: str = "nearest_", types: list[str] | None = None) -> DataFrame:
    """Great-circle km to the nearest amenity (per type); none → +inf."""
    tg = amenities.select(*( [F.col(type_col).alias("a_type")] if type_col else []),
                          F.col(a_lat).alias("r_lat"), F.col(a_lon).alias("r_lon"))
    pts = _distinct_points(props, lat, lon)
    best = nearest(pts, tg, "_pt", "haversine", start_km, lat, lon,
                   group_col="a_type" if type_col else None, dist_col="dist")
    best = pts.join(best, "_pt").drop("_pt")
    if not type_col:
        out = props.join(best, [lat, lon], "left")
        return out.withColumn(f"{out_prefix}km", F.coalesce(F.col("dist"), F.lit(float("inf")))).drop("dist")
    types = AMENITY_TYPES if types is None else types
    wide = best.groupBy(lat, lon).pivot("a_type", types).agg(F.min("dist"))
    out = props.join(wide, [lat, lon], "left")
    cols = {f"{out_prefix}{type_slug(t)}": F.coalesce(F.col(f"`{t}`"), F.lit(float("inf"))) for t in types}
    return out.withColumns(cols).drop(*types)
