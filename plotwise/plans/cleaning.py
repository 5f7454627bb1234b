"""§2.2 projections, casts and scalar cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.operators import clean
from plotwise.plans.common import npround_sql, sig, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies

P = proxies.properties


@query("clean_price_m2", with_views("""
SELECT records_id, land_m2,
       CASE WHEN land_m2 = 0 THEN NULL ELSE transaction_price / CAST(land_m2 AS DOUBLE) END AS price_m2
FROM properties""", "properties"))
def q_clean_price_m2(spark, sf):
    return P(spark, sf).transform(clean.clean_price_m2).select("records_id", "land_m2", "price_m2")


@query("clean_unit_level", with_views("""
SELECT records_id, CASE WHEN unit_level < 0 THEN 0 ELSE unit_level END AS unit_level FROM properties""",
                                      "properties"))
def q_clean_unit_level(spark, sf):
    return P(spark, sf).transform(clean.clean_unit_level).select("records_id", "unit_level")


@query("drop_redundant", with_views("""
SELECT year, property_type, tenure, district, property_m2, unit_level, lat, lon FROM properties""",
                                    "properties"))
def q_drop_redundant(spark, sf):
    return P(spark, sf).transform(clean.drop_redundant)


@query("rescale_area", with_views("""
SELECT records_id, CAST(property_m2 AS DOUBLE) / 100.0 AS property_m2, CAST(land_m2 AS DOUBLE) / 100.0 AS land_m2
FROM properties""", "properties"))
def q_rescale_area(spark, sf):
    return P(spark, sf).transform(clean.rescale_area).select("records_id", "property_m2", "land_m2")


@query("price_per_property_m2", with_views(f"""
SELECT records_id, {npround_sql('transaction_price / CAST(property_m2 AS DOUBLE)', 2)} AS price_m2
FROM properties""", "properties"))
def q_price_per_property_m2(spark, sf):
    return P(spark, sf).transform(clean.price_per_property_m2).select("records_id", "price_m2")


@query("flag_freehold", with_views("""
SELECT records_id, CAST(coalesce(tenure = 'Freehold', false) AS INTEGER) AS freehold FROM properties""",
                                   "properties"))
def q_flag_freehold(spark, sf):
    return P(spark, sf).transform(clean.flag_freehold).select("records_id", "freehold")


_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


@query("standardise_strings", with_views(f"""
SELECT records_id, date, year, lower(trim(property_type, {_WS})) AS property_type,
       lower(trim(tenure, {_WS})) AS tenure, lower(trim(district, {_WS})) AS district,
       lower(trim(mukim, {_WS})) AS mukim, lower(trim(road_name, {_WS})) AS road_name,
       way_id, transaction_price, property_m2, land_m2, unit_level, lat, lon
FROM properties""", "properties"))
def q_standardise_strings(spark, sf):
    return P(spark, sf).transform(clean.standardise_strings)


_DATE_TEXT_SQL = """CASE WHEN o_orderkey % 50 = 0 THEN 'not a date'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


@query("parse_dates", f"""
SELECT o_orderkey AS records_id, {_DATE_TEXT_SQL} AS date_text,
       CAST(try_strptime({_DATE_TEXT_SQL}, '%Y-%m-%d') AS TIMESTAMP) AS date
FROM orders""")
def q_parse_dates(spark, sf):
    from plotwise.sources.tables import read_table
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    text = F.when(F.col("o_orderkey") % 50 == 0, F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    df = o.select(F.col("o_orderkey").alias("records_id"), text.alias("date_text"), text.alias("date"))
    return clean.parse_dates(df, ("date",), "yyyy-MM-dd")


@query("month_key", with_views("""
SELECT year_month, count(*) AS n_rows
FROM (SELECT strftime(date, '%Y-%m') AS year_month FROM od_ridership WHERE date >= TIMESTAMP '1996-01-01')
GROUP BY year_month""", "od_ridership"))
def q_month_key(spark, sf):
    od = proxies.od_ridership(spark, sf).filter(F.col("date") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    return clean.month_key(od).groupBy("year_month").agg(F.count(F.lit(1)).alias("n_rows"))


@query("split_station_id", with_views("""
SELECT DISTINCT origin AS station_name, split_part(origin, ':', 1) AS station_id FROM od_ridership""",
                                      "od_ridership"))
def q_split_station_id(spark, sf):
    od = proxies.od_ridership(spark, sf).select(F.col("origin").alias("station_name")).distinct()
    return clean.split_station_id(od)


def _coord_text_spark(k):
    good = F.concat((F.lit(2) + k % 3).cast("string"), F.lit("."), (k % 997).cast("string"), F.lit(", "),
                    (F.lit(101) + k % 2).cast("string"), F.lit("."), (k % 991).cast("string"))
    return (F.when(k % 17 == 0, F.lit("n/a"))
             .when(k % 19 == 0, F.concat((k % 7).cast("string"), F.lit(";"), (k % 5).cast("string")))
             .when(k % 23 == 0, F.lit("1.5, 2.5, 3.5"))
             .otherwise(good))


_COORD_TEXT_SQL = """CASE WHEN o_orderkey % 17 = 0 THEN 'n/a'
     WHEN o_orderkey % 19 = 0 THEN CAST(o_orderkey % 7 AS VARCHAR) || ';' || CAST(o_orderkey % 5 AS VARCHAR)
     WHEN o_orderkey % 23 = 0 THEN '1.5, 2.5, 3.5'
     ELSE CAST(2 + o_orderkey % 3 AS VARCHAR) || '.' || CAST(o_orderkey % 997 AS VARCHAR) || ', ' ||
          CAST(101 + o_orderkey % 2 AS VARCHAR) || '.' || CAST(o_orderkey % 991 AS VARCHAR) END"""


@query("parse_coordinate", f"""
WITH t AS (SELECT o_orderkey AS records_id, {_COORD_TEXT_SQL} AS coordinates FROM orders),
s AS (SELECT records_id, coordinates,
             CASE WHEN len(string_split(coordinates, ',')) = 2
                  THEN TRY_CAST(trim(string_split(coordinates, ',')[1]) AS DOUBLE) END AS la,
             CASE WHEN len(string_split(coordinates, ',')) = 2
                  THEN TRY_CAST(trim(string_split(coordinates, ',')[2]) AS DOUBLE) END AS lo
      FROM t)
SELECT records_id, coordinates,
       CASE WHEN la IS NOT NULL AND lo IS NOT NULL THEN la END AS lat,
       CASE WHEN la IS NOT NULL AND lo IS NOT NULL THEN lo END AS lon,
       (la IS NOT NULL AND lo IS NOT NULL) AS coord_parsed
FROM s""")
def q_parse_coordinate(spark, sf):
    from plotwise.sources.tables import read_table
    o = read_table(spark, sf, "orders").select("o_orderkey")
    t = o.select(F.col("o_orderkey").alias("records_id"), _coord_text_spark(F.col("o_orderkey")).alias("coordinates"))
    return clean.parse_coordinate(t)


_DCOLS6 = ["dist_to_mall", "dist_to_school", "dist_to_park", "dist_to_river", "dist_to_lake", "dist_to_rail_station"]


@query("rename_prefix", with_views(f"""
SELECT records_id, {', '.join(f'{c} AS walk_{c}' for c in _DCOLS6)} FROM distances""", "distances"))
def q_rename_prefix(spark, sf):
    d = proxies.distances(spark, sf).select("records_id", *_DCOLS6)
    return clean.rename_prefix(d)


@query("resolve_suffixes", with_views(f"""
SELECT p.records_id, p.district AS district, p.road_name AS road_name,
       {npround_sql('d.dist_to_mall * CAST(1.234567 AS DOUBLE)', 4)} AS dist_to_mall,
       {npround_sql('d.walk_dist_to_park * CAST(1.234567 AS DOUBLE)', 4)} AS walk_dist_to_park
FROM properties p JOIN distances d USING (records_id)""", "properties", "distances"))
def q_resolve_suffixes(spark, sf):
    p = P(spark, sf).select("records_id", F.col("district").alias("district_x"), F.col("road_name").alias("road_name_x"))
    d = proxies.distances(spark, sf).select(
        "records_id", F.col("district").alias("district_y"),
        (F.col("dist_to_mall") * 1.234567).alias("dist_to_mall"),
        (F.col("walk_dist_to_park") * 1.234567).alias("walk_dist_to_park"))
    return clean.resolve_suffixes(p.join(d, "records_id"))


@query("log1p_target", with_views(f"""
SELECT records_id, {sig_sql('ln(1 + transaction_price / CAST(property_m2 AS DOUBLE))')} AS log_price_m2
FROM properties""", "properties"))
def q_log1p_target(spark, sf):
    df = P(spark, sf).withColumn("price_m2", F.col("transaction_price") / F.col("property_m2"))
    return clean.log1p_target(df).select("records_id", sig(F.col("log_price_m2")).alias("log_price_m2"))


@query("expm1_prediction", with_views(f"""
SELECT id, {sig_sql('exp(ln(1 + p) / 2) - 1')} AS prediction FROM predictions""", "predictions"))
def q_expm1_prediction(spark, sf):
    df = proxies.predictions(spark, sf).withColumn("prediction_log", F.log1p("p") / 2)
    return clean.expm1_prediction(df).select("id", sig(F.col("prediction")).alias("prediction"))


@query("clip_prediction", with_views("""
, t AS (SELECT id, p - 150000.0 AS prediction FROM predictions)
SELECT id, CASE WHEN (SELECT bool_or(prediction <= 0) FROM t) THEN greatest(prediction, 1.0) ELSE prediction END
       AS prediction
FROM t""", "predictions"))
def q_clip_prediction(spark, sf):
    df = proxies.predictions(spark, sf).select("id", (F.col("p") - 150000.0).alias("prediction"))
    return clean.clip_prediction(df)
