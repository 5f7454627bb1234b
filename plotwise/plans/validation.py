"""§2.3 filters, predicates and validation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.config import DISTANCE_COLS
from plotwise.operators import clean, validate
from plotwise.plans.common import SQL, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies

# ---------------------------------------------------------------------------
# geocoded view: properties with some coordinates missing or out of range
# ---------------------------------------------------------------------------


def geocoded(spark, sf):
    p = proxies.properties(spark, sf)
    k = F.col("records_id")
    lat = (F.when(k % 23 == 0, F.lit(None).cast("double")).when(k % 31 == 0, F.col("lat") * 40.0)
            .otherwise(F.col("lat")))
    lon = F.when(k % 37 == 0, F.col("lon") - 250.0).otherwise(F.col("lon"))
    return p.withColumns({"lat": lat, "lon": lon})


SQL["geocoded"] = """
SELECT * REPLACE (
  CASE WHEN records_id % 23 = 0 THEN NULL WHEN records_id % 31 = 0 THEN lat * 40.0 ELSE lat END AS lat,
  CASE WHEN records_id % 37 = 0 THEN lon - 250.0 ELSE lon END AS lon)
FROM properties"""


@query("coords_in_range", with_views("""
SELECT records_id, coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false) AS coords_valid
FROM geocoded""", "properties", "geocoded"))
def q_coords_in_range(spark, sf):
    return validate.coords_in_range(geocoded(spark, sf)).select("records_id", "coords_valid")


@query("coords_report", with_views("""
, r AS (SELECT count(*) AS total_properties,
               count_if(lat BETWEEN 1.0 AND 7.0 AND lon BETWEEN 99.0 AND 120.0
                        AND lat IS NOT NULL AND lon IS NOT NULL) AS valid_coordinates,
               count_if(lat IS NULL OR lon IS NULL) AS missing_coordinates
        FROM geocoded)
SELECT total_properties, valid_coordinates,
       total_properties - valid_coordinates - missing_coordinates AS invalid_coordinates,
       missing_coordinates, CAST(NULL AS VARCHAR) AS issue
FROM r""", "properties", "geocoded"))
def q_coords_report(spark, sf):
    return validate.coords_report(geocoded(spark, sf))


def cleaned_features(spark, sf):
    """Cleaned properties (price by land) with the twelve distance columns."""
    p = proxies.properties(spark, sf).transform(clean.clean_price_m2)
    d = proxies.distances(spark, sf).drop("district")
    return p.join(d, "records_id")


SQL["cleaned_features"] = """
SELECT p.*, CASE WHEN land_m2 = 0 THEN NULL ELSE transaction_price / CAST(land_m2 AS DOUBLE) END AS price_m2,
       d.* EXCLUDE (records_id, district)
FROM properties p JOIN distances d USING (records_id)"""


def _range_sql() -> str:
    ranges = [("property_m2", 10, 10000), ("unit_level", 0, 100), ("price_m2", 100, 200000)]
    ranges += [(c, 0, 50) for c in DISTANCE_COLS]
    parts = [
        f"SELECT '{f}' AS feature, CAST({lo} AS DOUBLE) AS min_value, CAST({hi} AS DOUBLE) AS max_value, "
        f"count_if({f} < {lo}) AS n_below, count_if({f} > {hi}) AS n_above FROM cleaned_features"
        for f, lo, hi in ranges]
    body = "\nUNION ALL\n".join(parts)
    return with_views(f"""
, r AS ({body})
SELECT feature, min_value, max_value, n_below, n_above, n_below + n_above AS n_out_of_range,
       (n_below + n_above) = 0 AS passed, {len(ranges)} AS total_features FROM r""",
                      "properties", "distances", "cleaned_features")


@query("range_report", _range_sql())
def q_range_report(spark, sf):
    return validate.range_report(cleaned_features(spark, sf))


# duplicates: every 101st record appears twice
def _with_dupes(spark, sf):
    df = cleaned_features(spark, sf)
    return df.unionByName(df.filter(F.col("records_id") % 101 == 0))


SQL["with_dupes"] = """
SELECT * FROM cleaned_features UNION ALL SELECT * FROM cleaned_features WHERE records_id % 101 = 0"""


@query("dataset_report", with_views("""
, s AS (SELECT count(*) AS n_rows,
               count(*) - count(DISTINCT records_id) AS dup_ids,
               count_if(way_id IS NULL) AS missing_way,
               count_if(price_m2 < 0) AS neg_price,
               count_if(price_m2 > (SELECT avg(price_m2) + 3 * stddev_samp(price_m2) FROM with_dupes)
                        OR price_m2 < (SELECT avg(price_m2) - 3 * stddev_samp(price_m2) FROM with_dupes)) AS outliers
        FROM with_dupes)
SELECT 'with_features' AS stage, 'warning' AS severity, 'duplicate_ids' AS "check", dup_ids AS n,
       format('{:d} rows repeat an earlier record id', dup_ids) AS message FROM s WHERE dup_ids > 0
UNION ALL
SELECT 'with_features', 'error', 'missing_way_id', missing_way,
       format('{:d} properties without a way id', missing_way) FROM s WHERE missing_way > 0
UNION ALL
SELECT 'with_features', 'error', 'negative_price', neg_price,
       format('{:d} prices below zero', neg_price) FROM s WHERE neg_price > 0
UNION ALL
SELECT 'with_features', 'warning', 'price_outliers', outliers,
       format('{:d} prices over three standard deviations from the mean', outliers) FROM s WHERE outliers > 0
""", "properties", "distances", "cleaned_features", "with_dupes"))
def q_dataset_report(spark, sf):
    return validate.dataset_report(_with_dupes(spark, sf), stage="with_features")


@query("outlier_3sigma", with_views("""
SELECT records_id, price_m2 FROM cleaned_features
WHERE price_m2 > (SELECT avg(price_m2) + 3 * stddev_samp(price_m2) FROM cleaned_features)
   OR price_m2 < (SELECT avg(price_m2) - 3 * stddev_samp(price_m2) FROM cleaned_features)""",
                                    "properties", "distances", "cleaned_features"))
def q_outlier_3sigma(spark, sf):
    return validate.outlier_3sigma(cleaned_features(spark, sf)).select("records_id", "price_m2")


def _missing_sql() -> str:
    cols = ["records_id", "date", "year", "property_type", "tenure", "district", "mukim", "road_name", "way_id",
            "transaction_price", "property_m2", "land_m2", "unit_level", "lat", "lon", "price_m2"] + DISTANCE_COLS
    dbl = {"transaction_price", "lat", "lon", "price_m2", *DISTANCE_COLS}
    parts = [
        f"SELECT '{c}' AS \"column\", count_if({c} IS NULL{' OR isnan(' + c + ')' if c in dbl else ''}) AS missing_count, "
        f"count(*) AS n FROM cleaned_features" for c in cols]
    body = "\nUNION ALL\n".join(parts)
    crit = "('way_id', 'price_m2')"
    return with_views(f"""
, m AS ({body})
SELECT "column", missing_count, missing_count / n * 100.0 AS missing_percent, "column" IN {crit} AS critical
FROM m WHERE missing_count > 0""", "properties", "distances", "cleaned_features")


@query("missing_report", _missing_sql())
def q_missing_report(spark, sf):
    return validate.missing_report(cleaned_features(spark, sf), critical_columns=["way_id", "price_m2"])


_SUMMARY_TYPES = [("records_id", "bigint"), ("date", "date"), ("year", "int"), ("property_type", "string"),
                  ("tenure", "string"), ("district", "string"), ("mukim", "string"), ("road_name", "string"),
                  ("way_id", "bigint"), ("transaction_price", "double"), ("property_m2", "bigint"),
                  ("land_m2", "bigint"), ("unit_level", "bigint"), ("lat", "double"), ("lon", "double")]


def _summary_sql() -> str:
    parts = [f"SELECT count(*) AS n_rows, {len(_SUMMARY_TYPES)} AS n_columns, '{c}' AS \"column\", '{t}' AS dtype, "
             f"count_if({c} IS NULL) AS null_count FROM properties" for c, t in _SUMMARY_TYPES]
    return with_views("\n" + "\nUNION ALL\n".join(parts), "properties")


@query("data_summary", _summary_sql())
def q_data_summary(spark, sf):
    return validate.data_summary(proxies.properties(spark, sf))


@query("split_report", with_views("""
, r AS (SELECT count_if(year < 2000) AS pre_split_count, count_if(year >= 2000) AS post_split_count,
               count(*) AS total_count FROM properties)
SELECT 2000 AS split_year, pre_split_count, post_split_count, total_count,
       pre_split_count / total_count * 100.0 AS pre_split_percent,
       post_split_count / total_count * 100.0 AS post_split_percent, CAST(NULL AS VARCHAR) AS error
FROM r""", "properties"))
def q_split_report(spark, sf):
    return validate.split_report(proxies.properties(spark, sf), "year", 2000)


@query("failed_geocodes", with_views("""
, g AS (SELECT *, coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false) AS coords_valid FROM geocoded)
SELECT records_id, way_id, coords_valid FROM g WHERE way_id IS NULL OR NOT coalesce(coords_valid, true)""",
                                     "properties", "geocoded"))
def q_failed_geocodes(spark, sf):
    g = validate.coords_in_range(geocoded(spark, sf))
    return validate.failed_geocodes(g).select("records_id", "way_id", "coords_valid")


@query("feature_guard", with_views("""
, v AS (SELECT [CAST(transaction_price AS DOUBLE), property_m2, land_m2, unit_level, lat, lon] AS x FROM properties)
SELECT CAST(min(len(x)) AS BIGINT) AS min_n, CAST(max(len(x)) AS BIGINT) AS max_n,
       CAST(sum(len(list_filter(x, lambda a: isnan(a)))) AS BIGINT) AS n_nan,
       CAST(sum(len(list_filter(x, lambda a: isinf(a)))) AS BIGINT) AS n_inf FROM v""", "properties"))
def q_feature_guard(spark, sf):
    """Assemble the numeric columns, run the guard (raises on bad input),
    return its counts as one row."""
    from pyspark.ml.feature import VectorAssembler
    df = proxies.properties(spark, sf)
    cols = ["transaction_price", "property_m2", "land_m2", "unit_level", "lat", "lon"]
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    counts = validate.feature_guard(vec, expected=len(cols))
    return spark.createDataFrame([counts])


@query("all_station_filter", with_views("""
SELECT date, service, origin, destination, passengers FROM od_ridership
WHERE origin = 'A0: All Stations' OR destination = 'A0: All Stations'""", "od_ridership"))
def q_all_station_filter(spark, sf):
    from plotwise.operators.transit import all_station_filter
    return all_station_filter(proxies.od_ridership(spark, sf))


_BAD_CLASSES = "footway|cycleway|pedestrian|path|steps|corridor|bridleway|proposed|construction|abandoned|platform|raceway"


@query("road_class_filter", with_views(f"""
SELECT road_id, road_name, highway FROM roads
WHERE NOT regexp_matches(highway, '{_BAD_CLASSES}')
  AND lat BETWEEN 2.471 AND 3.801 AND lon BETWEEN 100.775 AND 102.637""", "roads"))
def q_road_class_filter(spark, sf):
    from plotwise.operators.geocode import road_class_filter
    return road_class_filter(proxies.roads(spark, sf)).select("road_id", "road_name", "highway")
