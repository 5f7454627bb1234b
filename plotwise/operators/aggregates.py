"""Grouped aggregates, distinct counts, deterministic de-duplication and
set operations.

All of these are single ``groupBy`` stages with map-side partial
aggregation. Where the reference takes "the first row" of a group, we take
the row with the smallest ordering key (``min_by``), which is deterministic
and, unlike a window, is reduced partially before the shuffle, so a group
holding a third of the data never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def road_centroids(df: DataFrame, road: str = "road_name", lat: str = "lat", lon: str = "lon",
                   district: str = "district", order_col: str = "records_id") -> DataFrame:
    """Per road: median lat/lon (exact, linear; skew-safe) and the first non-NULL district."""
    from plotwise.operators.quantiles import exact_percentiles
    d = df.filter(F.col(road).isNotNull())
    la = exact_percentiles(d, lat, [0.5], [road]).withColumnRenamed("p0", lat)
    lo = exact_percentiles(d, lon, [0.5], [road]).withColumnRenamed("p0", lon)
    rest = d.groupBy(road).agg(
        F.min_by(F.col(district), F.when(F.col(district).isNotNull(), F.col(order_col))).alias(district),
        F.count(F.lit(1)).alias("n_properties"))
    return rest.join(la, road).join(lo, road).select(road, lat, lon, district, "n_properties")


def value_counts(df: DataFrame, col: str, top: int | None = 10) -> DataFrame:
    """Counts per value, most frequent first (ties by value); ``top`` rows."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))
    return out.limit(top) if top else out


def first_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The row with the smallest ``order_col`` per key (drop_duplicates(keep='first'))."""
    cols = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in cols])
    g = df.groupBy(*keys).agg(F.min_by(packed, F.col(order_col)).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def count_distinct(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    fn = (lambda c: F.approx_count_distinct(c, 0.01)) if approx else F.count_distinct
    return df.agg(*[fn(F.col(c)).alias(f"n_{c}") for c in cols])


def distinct_ids_concat(pairs: DataFrame, key: str, id_col: str, out: str = "ids") -> DataFrame:
    """Distinct ids per key, ascending, as text joined by ', '."""
    ids = F.array_sort(F.collect_set(F.col(id_col)))
    return pairs.groupBy(key).agg(F.array_join(F.transform(ids, lambda x: x.cast("string")), ", ").alias(out))


def prediction_summary(df: DataFrame, col: str = "prediction") -> DataFrame:
    from plotwise.operators.quantiles import exact_percentiles
    c = F.col(col)
    med = exact_percentiles(df, col, [0.5]).first()[0]
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.lit(med).cast("double").alias("median"),
                  F.min(c).alias("min"), F.max(c).alias("max"))


def union_pois(amenities: DataFrame, stations: DataFrame, type_col: str = "feature_type") -> DataFrame:
    """Amenities ∪ stations; columns missing on one side are NULL; types lowered."""
    u = amenities.unionByName(stations, allowMissingColumns=True)
    return u.withColumn(type_col, F.lower(F.col(type_col)))


def union_lines(stations: DataFrame, lines: list[tuple[str, int]], line_col: str = "train_id") -> DataFrame:
    """Stack per-line station tables, each tagged with its line name and id."""
    parts = [stations.filter(F.col(line_col) == lid)
                     .withColumns({"line": F.lit(name), "line_id": F.lit(lid)}) for name, lid in lines]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
