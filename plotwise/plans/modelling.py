"""§2.10 features and models: splits, scaling, encoding, assembly, the
regressors, training, cross-validation, grid search, persistence, scoring."""

from __future__ import annotations

import logging

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plotwise.config import COUNT_COLS, DISTANCE_COLS, RANDOM_STATE, TEST_SIZE
from plotwise.functions.vectors import length
from plotwise.operators import clean, features as fe, models as md
from plotwise.operators.amenities import radius_count
from plotwise.operators.cluster import cluster_back_join
from plotwise.operators.windows import fill_district_max
from plotwise.plans.common import sig, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.session import scratch_path
from plotwise.sources import proxies

log = logging.getLogger(__name__)

SPLIT_YEAR = 2001  # proxy sales run 1995 – Aug 2001: the last months are the holdout
CONTINUOUS = ["property_m2", "unit_level"] + DISTANCE_COLS + COUNT_COLS + [
    "incoming_ridership_within_1km", "outgoing_ridership_within_1km"]
CATEGORICAL = ["property_type", "market_cluster_id", "freehold", "transit", "district"]

_MEMO: dict = {}


def _memo(spark, key, build):
    k = (spark.sparkContext.applicationId, key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def model_frame(spark, sf):
    """One row per sale with every feature of the model, built from the proxy
    tables and checkpointed once per session. Sales without a price per m² > 0
    have a NULL label: they are scored, not learned from."""
    def build():
        from plotwise.plans.clustering import road_clusters
        from plotwise.plans.transit import near
        p = (proxies.properties(spark, sf)
             .transform(clean.clean_unit_level).transform(clean.flag_freehold).transform(clean.clean_price_m2))
        base = p.select("records_id", "year", "property_type", "district", "road_name", "property_m2", "unit_level",
                        "freehold", "price_m2", "lat", "lon")
        counts = radius_count(base.select("records_id", "lat", "lon"), proxies.amenities(spark, sf), 1.0, "degrees")
        dist = fill_district_max(proxies.distances(spark, sf)).drop("district")
        rider = near(spark, sf).select("records_id", "incoming_ridership_within_1km", "outgoing_ridership_within_1km")
        clusters = road_clusters(spark, sf).select("road_name", "market_cluster_id")
        j = (base.join(counts.drop("lat", "lon"), "records_id").join(dist, "records_id").join(rider, "records_id"))
        j = cluster_back_join(j, clusters)
        j = j.withColumns({"transit": F.when(F.col("rail_station_count") > 0, "yes").otherwise("no"),
                           "label": F.when(F.col("price_m2") > 0, F.log1p("price_m2"))})
        return j.checkpoint()
    return _memo(spark, ("frame", sf), build)


def three_splits(spark, sf):
    """(train, test, holdout): the early years 70 / 30 by a hash of the id, the last year aside."""
    early, holdout = fe.temporal_split(model_frame(spark, sf).filter(F.col("label").isNotNull()), SPLIT_YEAR)
    return (*fe.random_split(early), holdout)


def splits(spark, sf):
    """(rows to fit on, rows held out by time)."""
    train, _, holdout = three_splits(spark, sf)
    return train, holdout


def preprocessor(spark, sf):
    def build():
        train, _ = splits(spark, sf)
        return fe.build_preprocessor(train, CONTINUOUS, CATEGORICAL)
    return _memo(spark, ("prep", sf), build)


def trained(spark, sf, name, **overrides):
    def build():
        train, _ = splits(spark, sf)
        prep, _ = preprocessor(spark, sf)
        return md.fit(name, prep, train, **overrides)
    return _memo(spark, ("model", sf, name, tuple(sorted(overrides.items()))), build)


# ------------------------------------------------------------------ splits --

@query("temporal_split", with_views(f"""
SELECT records_id, year, CASE WHEN year < {SPLIT_YEAR} THEN 'train' ELSE 'test' END AS split
FROM properties WHERE year IS NOT NULL""", "properties"))
def q_temporal_split(spark, sf):
    p = proxies.properties(spark, sf).select("records_id", "year")
    tr, te = fe.temporal_split(p, SPLIT_YEAR)
    return tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))


@query("random_split", with_views(f"""
SELECT records_id, CASE WHEN (records_id % {fe.HASH_MODULUS} * {fe.HASH_FACTOR} + {RANDOM_STATE}) % {fe.HASH_MODULUS} % 1000 < {round(TEST_SIZE * 1000)}
       THEN 'test' ELSE 'train' END AS split
FROM properties""", "properties"))
def q_random_split(spark, sf):
    p = proxies.properties(spark, sf).select("records_id")
    tr, te = fe.random_split(p)
    return tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))


# ----------------------------------------------------------- preprocessing --

_SCALE_COLS = ["property_m2", "unit_level"] + DISTANCE_COLS


def _scale_frame(spark, sf):
    p = proxies.properties(spark, sf).transform(clean.clean_unit_level).select(
        "records_id", "year", "property_m2", "unit_level")
    return p.join(fill_district_max(proxies.distances(spark, sf)).drop("district"), "records_id")


def _scale_sql():
    from plotwise.plans.windows import _fill_sql
    fill = _fill_sql()
    fill_body = fill[fill.index("\nSELECT records_id, district"):]
    stats = ", ".join(f"{sig_sql(f'avg(ln(1 + {c}))', 9)} AS m_{c}, {sig_sql(f'stddev_pop(ln(1 + {c}))', 9)} AS s_{c}"
                      for c in _SCALE_COLS)
    cols = ", ".join(
        f"{sig_sql(f'(ln(1 + {c}) - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END')} AS {c}_scaled"
        for c in _SCALE_COLS)
    return with_views(f"""
, filled AS ({fill_body}),
f AS (SELECT p.records_id, p.year, p.property_m2, CASE WHEN p.unit_level < 0 THEN 0 ELSE p.unit_level END AS unit_level,
             {', '.join('d.' + c for c in DISTANCE_COLS)}
      FROM properties p JOIN filled d USING (records_id)),
st AS (SELECT {stats} FROM f WHERE year < {SPLIT_YEAR})
SELECT records_id, {cols} FROM f, st""", "properties", "distances")


@query("log_scale_features", _scale_sql())
def q_log_scale_features(spark, sf):
    df = _scale_frame(spark, sf)
    train, _ = fe.temporal_split(df, SPLIT_YEAR)
    scaler, _ = fe.fit_log_scaler(train, _SCALE_COLS, stat_digits=9)
    out = scaler.transform(df)
    return out.select("records_id", *[sig(F.col(f"{c}_scaled")).alias(f"{c}_scaled") for c in _SCALE_COLS])


_OH = ["property_type", "district", "freehold"]


def _oh_sql():
    ranks = []
    for c in _OH:
        ranks.append(f"""
l_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS rk
          FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM f WHERE year < {SPLIT_YEAR} AND {c} IS NOT NULL))""")
    sel = ", ".join(f"CAST(coalesce((SELECT rk FROM l_{c} WHERE v = CAST(f.{c} AS VARCHAR)) - 1, -1) AS INTEGER) AS {c}_slot"
                    for c in _OH)
    return with_views(f"""
, f AS (SELECT records_id, year, property_type, district,
               CAST(coalesce(tenure = 'Freehold', false) AS INTEGER) AS freehold FROM properties),
{','.join(ranks)}
SELECT records_id, {sel} FROM f""", "properties")


@query("one_hot_drop_first", _oh_sql())
def q_one_hot_drop_first(spark, sf):
    p = proxies.properties(spark, sf).transform(clean.flag_freehold).select("records_id", "year", *_OH)
    train, _ = fe.temporal_split(p, SPLIT_YEAR)
    stages, _ = fe.fit_one_hot_drop_first(train, _OH)
    from pyspark.ml import PipelineModel
    out = PipelineModel(stages=stages).transform(p)
    slots = {}
    for c in _OH:
        col = f"{c}_ohd" if f"{c}_ohd" in out.columns else None
        slots[f"{c}_slot"] = ((F.array_position(vector_to_array(col), 1.0) - 1).cast("int") if col
                              else F.lit(-1))
    return out.select("records_id", *[v.alias(k) for k, v in slots.items()])


@query("assemble_features")
def q_assemble_features(spark, sf):
    train, test = splits(spark, sf)
    prep, names = preprocessor(spark, sf)
    feats = prep.transform(model_frame(spark, sf))
    return feats.select("records_id", length("features").alias("n_features"),
                        F.lit(len(names)).alias("n_names"))


@query("feature_guard_model")
def q_feature_guard_model(spark, sf):
    """The scoring guard on the assembled model features (size, NaN, inf)."""
    from plotwise.operators.validate import feature_guard
    prep, names = preprocessor(spark, sf)
    feats = prep.transform(model_frame(spark, sf))
    return spark.createDataFrame([feature_guard(feats, "features", len(names))])


# -------------------------------------------------------------- regressors --

def _holdout_predictions(spark, sf, name, **overrides):
    _, test = splits(spark, sf)
    m = trained(spark, sf, name, **overrides)
    return md.predict(m, test.select("records_id", *CONTINUOUS, *CATEGORICAL, "label"), log_space=True) \
             .select("records_id", "label", sig(F.col("prediction")).alias("prediction_log"))


for _key, _name in [("reg_linear", "Linear Regression"), ("reg_ridge", "Ridge"), ("reg_lasso", "Lasso"),
                    ("reg_tree", "Decision Tree"), ("reg_forest", "Random Forest"), ("reg_gbt", "Gradient Boosting")]:
    query(_key)(lambda spark, sf, _n=_name: _holdout_predictions(spark, sf, _n))


def _knn_sql():
    scaled = _scale_sql()
    head = scaled[:scaled.rindex("\nSELECT records_id, ")]
    cols = ", ".join(f"{sig_sql(f'(ln(1 + {c}) - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END')} AS {c}_x" for c in _SCALE_COLS)
    dist = " + ".join(f"(q.{c}_x - t.{c}_x) * (q.{c}_x - t.{c}_x)" for c in _SCALE_COLS)
    return head + f""",
x AS (SELECT records_id, f.year, {cols} FROM f, st),
l AS (SELECT records_id, ln(1 + transaction_price / land_m2) AS label FROM properties WHERE land_m2 > 0 AND transaction_price > 0),
t AS (SELECT x.*, label FROM x JOIN l USING (records_id) WHERE year < {SPLIT_YEAR}
      AND (records_id % {fe.HASH_MODULUS} * {fe.HASH_FACTOR} + {RANDOM_STATE}) % {fe.HASH_MODULUS} % 1000 >= {round(TEST_SIZE * 1000)}),
d AS (SELECT q.records_id, t.label, t.records_id AS tid, {dist} AS d FROM x q, t WHERE q.year >= {SPLIT_YEAR}),
k AS (SELECT records_id, label FROM d QUALIFY row_number() OVER (PARTITION BY records_id ORDER BY d, tid) <= 5)
SELECT k.records_id, {sig_sql('l.label', 9)} AS label, {sig_sql('avg(k.label)', 9)} AS prediction_log
FROM k JOIN l USING (records_id) GROUP BY k.records_id, l.label"""


@query("reg_knn", _knn_sql())
def q_reg_knn(spark, sf):
    """Five nearest neighbours over the log-scaled columns; training rows and holdout as for the other models."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer, VectorAssembler
    df = _scale_frame(spark, sf)
    early, _ = fe.temporal_split(df, SPLIT_YEAR)
    scaler, _ = fe.fit_log_scaler(early, _SCALE_COLS, stat_digits=9)
    rounded = scaler.transform(df).select("records_id", "year", *[sig(F.col(f"{c}_scaled")).alias(f"{c}_x") for c in _SCALE_COLS])
    p = proxies.properties(spark, sf).transform(clean.clean_price_m2).filter(F.col("price_m2") > 0)
    rows = rounded.join(p.select("records_id", F.log1p("price_m2").alias("label")), "records_id").checkpoint()
    early, holdout = fe.temporal_split(rows, SPLIT_YEAR)
    train, _ = fe.random_split(early)
    assemble = PipelineModel(stages=[SQLTransformer(statement="SELECT * FROM __THIS__"),
                                     VectorAssembler(inputCols=[f"{c}_x" for c in _SCALE_COLS], outputCol="features")])
    model = md.KnnModel(assemble, assemble.transform(train), "label")
    return model.transform(holdout).select("records_id", sig(F.col("label"), 9).alias("label"),
                                           sig(F.col("prediction_log"), 9).alias("prediction_log"))


@query("train_models")
def q_train_models(spark, sf):
    """Every model fitted on the training years, scored on the holdout."""
    rows = []
    _, test = splits(spark, sf)
    for name in md.MODEL_NAMES:
        try:
            m = trained(spark, sf, name)
        except Exception as exc:  # noqa: BLE001 - training goes on; the failure is a row of the result
            log.warning("model %s failed: %s", name, exc)
            rows.append((name, None, None, f"{type(exc).__name__}: {str(exc)[:200]}"))
            continue
        s = md.predict(m, test, log_space=True)
        e = F.col("label") - F.col("prediction")
        r = s.agg((1 - F.sum(e * e) / (F.var_pop("label") * F.count("label"))).alias("r2"),
                  F.sqrt(F.avg(e * e)).alias("rmse")).first()
        rows.append((name, float(r["r2"]), float(r["rmse"]), None))
    return spark.createDataFrame(rows, "model string, test_r2_log double, test_rmse_log double, error string")


def prediction_table(spark, sf):
    """Prices and predictions of every trained model, written once per session as a table
    partitioned by model and split: records_id, y, p."""
    def build():
        path = scratch_path(spark, "predictions")
        for name in md.MODEL_NAMES:
            model = trained(spark, sf, name)
            for split, rows in zip(("train", "test", "holdout"), three_splits(spark, sf)):
                scored = md.predict(model, rows.select("records_id", *CONTINUOUS, *CATEGORICAL, "label"))
                scored.select("records_id", F.expm1("label").alias("y"), F.col("prediction").alias("p"), F.lit(name).alias("model"), F.lit(split).alias("split")) \
                    .write.mode("append").partitionBy("model", "split").parquet(path)
        return path
    return _memo(spark, ("predictions", sf), build)


@query("trained_evaluation")
def q_trained_evaluation(spark, sf):
    """Every trained model on the rows it learned from, on those kept back and on the last year, in prices and in logs."""
    from plotwise.operators import evaluate as ev
    preds = spark.read.parquet(prediction_table(spark, sf))
    original = ev.regression_metrics(preds, prefix="", include_mape=True, group_by=["model", "split"]).withColumn("scale", F.lit("original"))
    logs = preds.withColumns({"y": F.log1p("y"), "p": F.log1p("p")})
    return original.unionByName(ev.regression_metrics(logs, prefix="", include_mape=False, group_by=["model", "split"]).withColumn("scale", F.lit("log")), allowMissingColumns=True)


@query("trained_comparison")
def q_trained_comparison(spark, sf):
    """The trained models ranked by R² on the last year."""
    from plotwise.operators import evaluate as ev
    from plotwise.operators.windows import model_ranking
    holdout = spark.read.parquet(prediction_table(spark, sf)).filter("split = 'holdout'")
    return model_ranking(ev.regression_metrics(holdout, prefix="test", include_mape=True, group_by=["model"]), "test_r2", "model")


@query("cv_metrics")
def q_cv_metrics(spark, sf):
    """Ten folds of every model, with its own defaults."""
    train, _ = splits(spark, sf)
    prep, _ = preprocessor(spark, sf)
    return spark.createDataFrame(md.cross_validate(md.MODEL_NAMES, prep, train))


#: The documented grid: 81 settings.
GRID = {"numTrees": [100, 200, 300], "maxDepth": [20, 25, 30], "minSamplesSplit": [2, 5, 10], "minInstancesPerNode": [1, 2, 4]}


@query("grid_search")
def q_grid_search(spark, sf):
    """Forest grid search by R² over the documented grid, at ten folds."""
    train, _ = splits(spark, sf)
    prep, _ = preprocessor(spark, sf)
    _, rows = md.grid_search(prep, train, GRID, refit=False)
    return spark.createDataFrame(rows)


@query("save_load_model")
def q_save_load_model(spark, sf):
    prep, names = preprocessor(spark, sf)
    m = trained(spark, sf, "Decision Tree")
    path = scratch_path(spark, "model")
    md.save_model(m, path, {"model_name": "Decision Tree", "feature_names": names}, spark)
    loaded, meta = md.load_model(path, spark)
    _, test = splits(spark, sf)
    return md.batch_predict(loaded, test.select("records_id", *CONTINUOUS, *CATEGORICAL)) \
             .select("records_id", sig(F.col("predicted_price")).alias("predicted_price"),
                     F.lit(len(meta["feature_names"])).alias("n_features"))


@query("batch_predict")
def q_batch_predict(spark, sf):
    """Score every sale with the forest: log price → expm1 → clip."""
    m = trained(spark, sf, "Random Forest")
    rows = model_frame(spark, sf).select("records_id", *CONTINUOUS, *CATEGORICAL)
    return md.batch_predict(m, rows, "predicted_price").select("records_id", "predicted_price")


@query("feature_importance_topk")
def q_feature_importance_topk(spark, sf):
    _, names = preprocessor(spark, sf)
    m = trained(spark, sf, "Random Forest")
    _, top = md.feature_importance(m, names, 10)
    return spark.createDataFrame(top, "feature string, importance double")
