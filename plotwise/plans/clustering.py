"""§2.9 clustering of road centroids; cluster statistics and back-join."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.config import CLUSTER_PREFIXES
from plotwise.operators import cluster as cl
from plotwise.operators.clean import clean_price_m2
from plotwise.plans.common import SQL, hav, sig, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies

# district names of the reference region, cycled over the proxy's nations
# (the twelfth slot is outside the prefix table → 'XX')
_LABELS = list(CLUSTER_PREFIXES) + ["outer region"]


def labelled_roads(spark, sf):
    r = proxies.roads(spark, sf)
    lab = F.element_at(F.array(*[F.lit(x) for x in _LABELS]), (F.col("nation_key") % len(_LABELS) + 1).cast("int"))
    return r.select("road_id", "road_name", lab.alias("district"), "lat", "lon")


_LAB_SQL = "[" + ", ".join(f"'{x}'" for x in _LABELS) + "]"
SQL["lroads"] = f"""
SELECT road_id, road_name, ({_LAB_SQL})[CAST(nation_key % {len(_LABELS)} AS INTEGER) + 1] AS district, lat, lon FROM roads"""
SQL["rpairs"] = f"""
SELECT a.road_id AS id, b.road_id AS id2, {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS d FROM lroads a, lroads b"""
SQL["kd"] = """
SELECT id, d FROM (SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d, id2) AS rn FROM rpairs) WHERE rn = 5"""
SQL["eps"] = """
SELECT count(*) AS n, quantile_cont(d, 0.9) AS p90, quantile_cont(d, 0.95) AS p95,
       (quantile_cont(d, 0.9) + quantile_cont(d, 0.95)) / 2 AS e FROM kd"""
SQL["nb"] = "SELECT id, id2 FROM rpairs, eps WHERE d <= e"
SQL["core"] = "SELECT id FROM nb GROUP BY id HAVING count(*) >= 5"
SQL["ce"] = """
SELECT nb.id, nb.id2 FROM nb JOIN core c1 ON c1.id = nb.id JOIN core c2 ON c2.id = nb.id2 WHERE nb.id <> nb.id2"""
SQL["lab"] = """
SELECT id, l FROM (
WITH RECURSIVE lab(id, l) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  (SELECT c.id, c.l FROM (SELECT ce.id2 AS id, min(lab.l) AS l FROM lab JOIN ce ON ce.id = lab.id GROUP BY ce.id2) c
   JOIN recurring.lab r ON r.id = c.id WHERE c.l < r.l))
SELECT * FROM lab)"""
SQL["border"] = """
SELECT nb.id, min(lab.l) AS l FROM nb JOIN lab ON lab.id = nb.id2 WHERE nb.id NOT IN (SELECT id FROM core)
GROUP BY nb.id"""
SQL["dbs"] = """
SELECT r.road_id, r.road_name, r.district,
       CAST(coalesce(dense_rank() OVER (ORDER BY a.l) - 1, -1) AS INTEGER) AS dr, a.l,
       r.road_id IN (SELECT id FROM core) AS is_core, a.l IS NULL AS is_noise
FROM lroads r LEFT JOIN (SELECT * FROM lab UNION ALL SELECT * FROM border) a ON a.id = r.road_id"""
SQL["dbs2"] = """
SELECT road_id, road_name, district, CASE WHEN l IS NULL THEN -1 ELSE dr END AS market_cluster, is_core, is_noise
FROM dbs"""
_DB = ("roads", "lroads", "rpairs", "kd", "eps", "nb", "core", "ce", "lab", "border", "dbs", "dbs2")


def _dbscan(spark, sf):
    r = labelled_roads(spark, sf)
    eps = cl.optimal_eps(cl.k_distance(r, "road_id")).first()["eps_km"]
    return r.join(cl.dbscan(r, eps, "road_id"), "road_id")


@query("k_distance_eps", with_views(f"""
SELECT n, {sig_sql('p90')} AS kdist_p90_km, {sig_sql('p95')} AS kdist_p95_km, {sig_sql('e')} AS eps_km,
       {sig_sql('e / 6371.0')} AS eps_rad FROM eps""", "roads", "lroads", "rpairs", "kd", "eps"))
def q_k_distance_eps(spark, sf):
    e = cl.optimal_eps(cl.k_distance(labelled_roads(spark, sf), "road_id"))
    return e.select("n", *[sig(F.col(c)).alias(c) for c in ("kdist_p90_km", "kdist_p95_km", "eps_km", "eps_rad")])


@query("dbscan_roads", with_views("\nSELECT road_id, market_cluster, is_core, is_noise FROM dbs2", *_DB))
def q_dbscan_roads(spark, sf):
    return _dbscan(spark, sf).select("road_id", "market_cluster", "is_core", "is_noise")


@query("kmeans_roads")
def q_kmeans_roads(spark, sf):
    return cl.kmeans(labelled_roads(spark, sf), id_col="road_id").select("road_id", "market_cluster")


# DBSCAN's labels as long as its noise stays under the limit, as it does here; K-means beyond is no SQL
@query("cluster_auto", with_views("""
SELECT road_id, market_cluster, 'dbscan' AS clustering_method, is_noise FROM dbs2
WHERE (SELECT avg(CAST(is_noise AS INTEGER)) FROM dbs2) <= 0.15""", *_DB))
def q_cluster_auto(spark, sf):
    out = cl.cluster_roads(labelled_roads(spark, sf), "auto", "road_id")
    return out.select("road_id", "market_cluster", "clustering_method", "is_noise")


_IDS_SQL = """
SELECT road_name, CASE WHEN is_noise THEN 'NOISE'
       ELSE coalesce(MAP {%s}[lower(district)], 'XX') || '_' || lpad(CAST(market_cluster AS VARCHAR), 3, '0') END
       AS market_cluster_id
FROM dbs2""" % ", ".join(f"'{k}': '{v}'" for k, v in CLUSTER_PREFIXES.items())
SQL["cids"] = _IDS_SQL


def road_clusters(spark, sf):
    return cl.cluster_ids(_dbscan(spark, sf))


@query("cluster_ids", with_views("\nSELECT * FROM cids", *_DB, "cids"))
def q_cluster_ids(spark, sf):
    return road_clusters(spark, sf).select("road_name", "market_cluster_id")


@query("cluster_back_join", with_views("""
SELECT p.records_id, c.market_cluster_id FROM properties p LEFT JOIN cids c USING (road_name)""",
                                       "properties", *_DB, "cids"))
def q_cluster_back_join(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "road_name")
    return cl.cluster_back_join(p, road_clusters(spark, sf)).select("records_id", "market_cluster_id")


@query("cluster_stats", with_views(f"""
, j AS (SELECT p.records_id, p.district, p.property_m2,
               CASE WHEN p.land_m2 = 0 THEN NULL ELSE p.transaction_price / CAST(p.land_m2 AS DOUBLE) END AS price_m2,
               c.market_cluster_id
        FROM properties p LEFT JOIN cids c USING (road_name))
SELECT market_cluster_id, count(price_m2) AS property_count, {sig_sql('avg(price_m2)')} AS avg_price_m2,
       {sig_sql('median(price_m2)')} AS median_price_m2, {sig_sql('stddev_samp(price_m2)')} AS std_price_m2,
       min(price_m2) AS min_price_m2, max(price_m2) AS max_price_m2,
       {sig_sql('avg(property_m2)')} AS avg_property_size,
       arg_min(district, records_id) FILTER (WHERE district IS NOT NULL) AS district
FROM j GROUP BY market_cluster_id""", "properties", *_DB, "cids"))
def q_cluster_stats(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "road_name", "district", "property_m2",
                                             "transaction_price", "land_m2").transform(clean_price_m2)
    j = cl.cluster_back_join(p, road_clusters(spark, sf))
    s = cl.cluster_stats(j)
    return s.withColumns({c: sig(F.col(c)) for c in ("avg_price_m2", "median_price_m2", "std_price_m2",
                                                      "avg_property_size")})
