"""Flagship: the notebook's spatial merge in one lineage.

properties → standardise strings → amenity counts within 5 km (great-circle,
grid equi-join) → district-max distance fill → per-district market profile.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.operators.amenities import radius_count
from plotwise.operators.clean import standardise_strings
from plotwise.operators.windows import fill_district_max
from plotwise.plans.common import SQL, hav, npround_sql, sig, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies

FLAGSHIP_RADIUS_KM = 5.0

_ORACLE = with_views(f"""
, p AS (SELECT records_id, lower(trim(district)) AS district, transaction_price, lat, lon FROM properties),
pairs AS (
  SELECT p.records_id, a.feature_type FROM p JOIN amenities a
  ON {hav('p.lat', 'p.lon', 'a.lat', 'a.lon')} <= {FLAGSHIP_RADIUS_KM}),
cnt AS (
  SELECT records_id, count(*) AS total, count_if(feature_type = 'rail station') AS rail,
         count_if(feature_type = 'school') AS school
  FROM pairs GROUP BY records_id),
j AS (
  SELECT p.records_id, p.district, p.transaction_price,
         CAST(coalesce(cnt.total, 0) AS INTEGER) AS total, CAST(coalesce(cnt.rail, 0) AS INTEGER) AS rail,
         CAST(coalesce(cnt.school, 0) AS INTEGER) AS school, d.dist_to_mall
  FROM p LEFT JOIN cnt USING (records_id) JOIN distances d USING (records_id)),
f AS (
  SELECT j.*, {npround_sql('coalesce(dist_to_mall, max(dist_to_mall) OVER (PARTITION BY district), 21.0)', 3)} AS mall_km
  FROM j)
SELECT district,
       count(*) AS n_sales,
       {sig_sql('avg(transaction_price)')} AS avg_price,
       {sig_sql('avg(total)')} AS avg_amenities_5km,
       CAST(sum(rail) AS BIGINT) AS rail_station_pairs,
       CAST(max(school) AS INTEGER) AS max_school_count,
       {sig_sql('avg(mall_km)')} AS avg_dist_to_mall
FROM f GROUP BY district
""", "properties", "amenities", "distances").replace("WITH properties", "WITH properties", 1)


def market_profile(spark, sf_dir):
    props = proxies.properties(spark, sf_dir).transform(standardise_strings)
    ams = proxies.amenities(spark, sf_dir)
    counted = radius_count(props.select("records_id", "district", "transaction_price", "lat", "lon"),
                           ams, radius_km=FLAGSHIP_RADIUS_KM, metric="haversine")
    dist = proxies.distances(spark, sf_dir).select("records_id", "dist_to_mall")
    filled = counted.join(dist, "records_id").transform(fill_district_max, cols=["dist_to_mall"])
    return filled.groupBy("district").agg(
        F.count(F.lit(1)).alias("n_sales"),
        sig(F.avg("transaction_price")).alias("avg_price"),
        sig(F.avg("total_amenity_count")).alias("avg_amenities_5km"),
        F.sum("rail_station_count").cast("bigint").alias("rail_station_pairs"),
        F.max("school_count").alias("max_school_count"),
        sig(F.avg("dist_to_mall")).alias("avg_dist_to_mall"),
    )


query("market_profile", _ORACLE)(market_profile)
