"""§2.11 evaluation aggregates and §2.6 model ranking, over prediction tables."""

from __future__ import annotations

import sys

from pyspark.sql import functions as F

from plotwise.operators import evaluate as ev
from plotwise.plans.common import SQL, sig_cols, sig_sql, with_views
from plotwise.plans.registry import query
from plotwise.sources import proxies

_EPS = repr(sys.float_info.epsilon)


def _metrics_sql(y="y", p="p", mape=True, prefix=""):
    pre = f"{prefix}_" if prefix else ""
    cols = [f"{sig_sql(f'avg(({y} - {p}) * ({y} - {p}))')} AS {pre}mse",
            f"{sig_sql(f'sqrt(avg(({y} - {p}) * ({y} - {p})))')} AS {pre}rmse",
            f"{sig_sql(f'avg(abs({y} - {p}))')} AS {pre}mae",
            f"{sig_sql(f'1.0 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y}))')} AS {pre}r2",
            f"count(CASE WHEN {y} IS NOT NULL AND {p} IS NOT NULL THEN 1 END) AS {pre}n"]
    if mape:
        cols.append(f"{sig_sql(f'avg(abs({y} - {p}) / greatest(abs({y}), {_EPS})) * 100.0')} AS {pre}mape")
    return ", ".join(cols)


_METRIC_NAMES = ["mse", "rmse", "mae", "r2", "mape"]


def _preds(spark, sf):
    return proxies.predictions(spark, sf)


@query("regression_metrics", with_views(f"\nSELECT {_metrics_sql()} FROM predictions", "predictions"))
def q_regression_metrics(spark, sf):
    return sig_cols(ev.regression_metrics(_preds(spark, sf)), _METRIC_NAMES)


@query("mape_zero_modes", with_views(f"""
SELECT 'exclude' AS mode, {sig_sql('avg(CASE WHEN abs(y) >= 1e-10 THEN abs(y - p) / abs(y) END) * 100.0')} AS mape,
       count_if(abs(y) < 1e-10) AS n_zero, count(*) AS n FROM predictions
UNION ALL
SELECT 'epsilon', {sig_sql('avg(abs(y - p) / CASE WHEN abs(y) < 1e-10 THEN 1e-10 ELSE abs(y) END) * 100.0')},
       count_if(abs(y) < 1e-10), count(*) FROM predictions""", "predictions"))
def q_mape_zero_modes(spark, sf):
    df = _preds(spark, sf)
    parts = [ev.mape(df, zero_handling=m).withColumn("mode", F.lit(m)) for m in ("exclude", "epsilon")]
    return sig_cols(parts[0].unionByName(parts[1]), ["mape"]).select("mode", "mape", "n_zero", "n")


@query("within_tolerance", with_views(f"""
SELECT {sig_sql('count_if(abs(y) >= 1e-10 AND abs(y - p) / y <= 0.15) / count_if(abs(y) >= 1e-10) * 100.0')}
         AS accuracy_pct,
       count_if(abs(y) >= 1e-10 AND abs(y - p) / y <= 0.15) AS n_within, count_if(abs(y) >= 1e-10) AS n_total
FROM predictions""", "predictions"))
def q_within_tolerance(spark, sf):
    return sig_cols(ev.within_tolerance(_preds(spark, sf)), ["accuracy_pct"])


SQL["scaled_preds"] = "SELECT id, y / 50.0 AS y, p / 50.0 AS p, split FROM predictions"


@query("price_band_metrics", with_views(f"""
SELECT band, {_metrics_sql()} FROM (
  SELECT *, CASE WHEN y >= 0 AND y < 3000 THEN 'Budget' WHEN y >= 3000 AND y < 8000 THEN 'Mid-tier'
                 WHEN y >= 8000 THEN 'Luxury' END AS band FROM scaled_preds)
WHERE band IS NOT NULL GROUP BY band""", "predictions", "scaled_preds"))
def q_price_band_metrics(spark, sf):
    df = _preds(spark, sf).select("id", (F.col("y") / 50.0).alias("y"), (F.col("p") / 50.0).alias("p"))
    return sig_cols(ev.price_band_metrics(df), _METRIC_NAMES)


@query("residual_stats", with_views(f"""
SELECT {sig_sql('avg(y - p)')} AS mean_residual, {sig_sql('stddev_pop(y - p)')} AS std_residual,
       {sig_sql('min(y - p)')} AS min_residual, {sig_sql('max(y - p)')} AS max_residual,
       {sig_sql('quantile_cont(y - p, 0.5)')} AS median_residual, {sig_sql('quantile_cont(y - p, 0.25)')} AS q25_residual,
       {sig_sql('quantile_cont(y - p, 0.75)')} AS q75_residual,
       count_if(y - p < 0) AS n_overpredicted, count_if(y - p > 0) AS n_underpredicted
FROM predictions""", "predictions"))
def q_residual_stats(spark, sf):
    r = ev.residual_stats(_preds(spark, sf))
    return sig_cols(r, ["mean_residual", "std_residual", "min_residual", "max_residual", "median_residual",
                        "q25_residual", "q75_residual"])


@query("model_evaluation", with_views(f"""
SELECT split, {_metrics_sql()}, 'original' AS scale FROM predictions GROUP BY split
UNION ALL
SELECT split, {_metrics_sql('ln(1 + y)', 'ln(1 + p)', mape=False)}, NULL AS mape, 'log' AS scale
FROM predictions GROUP BY split""", "predictions"))
def q_model_evaluation(spark, sf):
    return sig_cols(ev.model_evaluation(_preds(spark, sf)), _METRIC_NAMES)


# four scoring variants of the same actuals stand in for four fitted models
_MODELS_SQL = """
SELECT 'baseline' AS model, id, y, p FROM predictions
UNION ALL SELECT 'blend', id, y, 0.5 * y + 0.5 * p FROM predictions
UNION ALL SELECT 'inflated', id, y, p * 1.1 FROM predictions
UNION ALL SELECT 'noisy', id, y, y + CAST(id % 100 - 50 AS DOUBLE) * 10.0 FROM predictions"""
SQL["models"] = _MODELS_SQL


def model_preds(spark, sf):
    d = _preds(spark, sf)
    parts = [d.select(F.lit("baseline").alias("model"), "id", "y", "p"),
             d.select(F.lit("blend").alias("model"), "id", "y", (0.5 * F.col("y") + 0.5 * F.col("p")).alias("p")),
             d.select(F.lit("inflated").alias("model"), "id", "y", (F.col("p") * 1.1).alias("p")),
             d.select(F.lit("noisy").alias("model"), "id", "y",
                      (F.col("y") + ((F.col("id") % 100) - 50).cast("double") * 10.0).alias("p"))]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


_CMP = f"SELECT model, {_metrics_sql(prefix='test')} FROM models GROUP BY model"


@query("model_comparison", with_views(f"""
SELECT *, row_number() OVER (ORDER BY test_r2 DESC, model) AS rank FROM ({_CMP})""", "predictions", "models"))
def q_model_comparison(spark, sf):
    m = ev.regression_metrics(model_preds(spark, sf), prefix="test", include_mape=True, group_by=["model"])
    m = sig_cols(m, [f"test_{c}" for c in _METRIC_NAMES])
    from plotwise.operators.windows import model_ranking
    return model_ranking(m, "test_r2", "model")


@query("model_ranking", with_views(f"""
SELECT model, test_r2, row_number() OVER (ORDER BY test_r2 DESC, model) AS rank FROM ({_CMP})""",
                                   "predictions", "models"))
def q_model_ranking(spark, sf):
    return q_model_comparison(spark, sf).select("model", "test_r2", "rank")
