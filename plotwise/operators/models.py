"""Regression models, training, cross-validation, persistence and scoring.

The target is log1p(price). Linear models are Spark ML estimators; trees, forests and boosted trees
of any depth are ``operators.trees``. Parameter meanings:

* Ridge α → ``regParam = α / n · std_pop(y)`` with the normal-equation solver
  (Spark scales the penalty by the label's standard deviation and by 1/n);
* Lasso α → ``regParam = α``, ``elasticNetParam = 1``;
* trees: depth None is unlimited; the forest considers all features per split; leaf and split
  sizes count the copies of a bootstrap sample.

k-nearest-neighbours has no Spark estimator; ``KnnModel`` searches exactly, in
blocks of queries against blocks of training rows, whose vectors stay as they are stored.

Cross-validation and grid search fit all folds together (``linear``, ``trees``) and write
their scores unit by unit, so a rerun goes on where a lost run stopped.
"""

from __future__ import annotations

import json
import logging
import re
import time
from dataclasses import dataclass, replace
from math import gcd

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.config import CV_FOLDS, RANDOM_STATE
from plotwise.functions.vectors import length, stored
from plotwise.operators import linear, trees
from plotwise.operators.scores import ScoreLog

log = logging.getLogger(__name__)

#: (depth, learning rate) of the boosted models.
BOOSTED = {"Gradient Boosting": (3, 0.1), "Gradient Boosting (depth 6)": (6, 0.3), "Gradient Boosting (depth 5)": (5, 0.1)}
MODEL_NAMES = ["Linear Regression", "Ridge", "Lasso", "KNeighbors Regressor", "Decision Tree",
               "Random Forest", "Gradient Boosting", "Gradient Boosting (depth 6)", "Gradient Boosting (depth 5)"]


#: Spark's normal equations take so many features at most; beyond, least squares are found by gradients over sparse rows.
NORMAL_FEATURES = 4096
WIDE = dict(solver="l-bfgs", maxIter=1000, tol=1e-10)
#: Beyond so many columns a lasso is fitted on those that can differ from 0.
LASSO_FEATURES = 512
#: Up to so many columns folds share cross products, a matrix per fold and task; beyond, linear models are fitted fold by fold.
CROSS_FEATURES = 512


def _width(feats: DataFrame, features: str) -> int:
    row = feats.select(length(features).alias("n")).first()
    return row["n"] if row else 0


def make_regressor(name: str, train: DataFrame | None = None, label: str = "label", features: str = "features",
                   seed: int = RANDOM_STATE, **overrides):
    """A Spark estimator for one of the reference's model names."""
    common = dict(featuresCol=features, labelCol=label, predictionCol="prediction_log")
    wide = name in ("Linear Regression", "Ridge") and train is not None and _width(train, features) > NORMAL_FEATURES
    if name == "Linear Regression":
        if wide:        # the scale of a column does not change the best fit, only how fast it is found
            return LinearRegression(regParam=0.0, standardization=True, **WIDE, **common)
        return LinearRegression(regParam=0.0, standardization=False, solver="normal", **common)
    if name == "Ridge":
        alpha = overrides.get("alpha", 1.0)
        st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
        reg = alpha / max(st["n"], 1) * (st["s"] or 1.0)
        if wide:        # this solver scales the penalty by the sample's deviation
            reg *= (st["n"] / (st["n"] - 1)) ** 0.5 if st["n"] > 1 else 1.0
            return LinearRegression(regParam=reg, elasticNetParam=0.0, standardization=False, **WIDE, **common)
        return LinearRegression(regParam=reg, elasticNetParam=0.0, standardization=False, solver="normal", **common)
    if name == "Lasso":
        return LinearRegression(regParam=overrides.get("alpha", 0.1), elasticNetParam=1.0, standardization=False,
                                maxIter=overrides.get("maxIter", 1000), **common)
    if name in BOOSTED:
        depth, rate = BOOSTED[name]
        return GBTRegressor(maxIter=overrides.get("maxIter", 100), maxDepth=overrides.get("maxDepth", depth),
                            stepSize=rate, seed=seed, **common)
    raise ValueError(f"unknown model {name!r}")


def _correlated(feats: DataFrame, rest: str, features: str) -> DataFrame:
    """(i, c): per column the mean over all rows of its value times ``rest``, whose mean is 0; columns that are 0 throughout are left out."""
    indices, values = stored(features)
    places = F.coalesce(indices, F.sequence(F.lit(0), F.size(values) - 1))
    n = feats.count()
    each = feats.select(F.col(rest).alias("_r"), F.explode(F.arrays_zip(places.alias("i"), values.alias("v"))).alias("_e"))
    return each.groupBy(F.col("_e.i").alias("i")).agg((F.sum(F.col("_e.v") * F.col("_r")) / n).alias("c"))


def fit_lasso(feats: DataFrame, label: str = "label", features: str = "features", **overrides) -> list:
    """The stages of a fitted lasso. Up to ``LASSO_FEATURES`` columns are fitted at once. Of more, only those that can differ from 0: first
    those that move with the label by more than alpha, then all that move so with what the fit leaves, until there are no
    others. That is the condition of a lasso solution, so the fit is that of all columns; the driver sees only the ones in use."""
    alpha = overrides.get("alpha", 0.1)
    if _width(feats, features) <= LASSO_FEATURES:
        return [make_regressor("Lasso", feats, label, features, **overrides).fit(feats)]
    rows = feats.select(F.col(label).cast("double").alias(label), features).checkpoint()
    mean = rows.agg(F.avg(label)).first()[0]
    pulls = _correlated(rows.withColumn("_rest", F.col(label) - F.lit(mean)), "_rest", features).checkpoint()
    used: set[int] = {r["i"] for r in pulls.filter(F.abs("c") > alpha).collect()} or {pulls.agg(F.max_by("i", F.abs("c"))).first()[0] or 0}
    while True:
        pick = VectorSlicer(inputCol=features, outputCol=f"{features}_used", indices=sorted(used))
        model = make_regressor("Lasso", feats, label, f"{features}_used", **overrides).fit(pick.transform(rows))
        told = model.transform(pick.transform(rows)).withColumn("_rest", F.col(label) - F.col("prediction_log"))
        more = {r["i"] for r in _correlated(told, "_rest", features).filter(F.abs("c") > alpha * (1 + 1e-6)).collect()} - used
        if not more:
            return [pick, model]
        used |= more


def tree_job(name: str, seed: int = RANDOM_STATE, **overrides) -> trees.Job | None:
    """The ensemble of a tree model's name; None for other models."""
    leaf = overrides.get("minInstancesPerNode", 1)
    if name == "Decision Tree":
        return trees.Job(name, 1, leaf=leaf, depth=overrides.get("maxDepth"), bootstrap=False, seed=seed)
    if name == "Random Forest":
        return trees.Job(name, overrides.get("numTrees", 100), leaf=leaf, depth=overrides.get("maxDepth"), seed=seed)
    if name in BOOSTED:
        depth, rate = BOOSTED[name]
        return trees.Job(name, overrides.get("maxIter", 100), leaf=leaf, depth=overrides.get("maxDepth", depth), bootstrap=False, seed=seed, rate=rate)
    return None


def fit(name: str, preprocessor: PipelineModel, train: DataFrame, label: str = "label", **overrides):
    """Fit one named model on preprocessed rows → PipelineModel(preprocess + model)."""
    feats = preprocessor.transform(train)
    if name == "KNeighbors Regressor":
        return KnnModel(preprocessor, feats, label, k=overrides.get("k", 5))
    job = tree_job(name, **overrides)
    if job is not None:
        return trees.ForestModel.fit(preprocessor, feats, label, job)
    if name == "Lasso":
        return PipelineModel(stages=[*preprocessor.stages, *fit_lasso(feats, label, **overrides)])
    est = make_regressor(name, feats, label, **overrides)
    model = est.fit(feats)
    return PipelineModel(stages=[*preprocessor.stages, model])


def train_models(preprocessor: PipelineModel, train: DataFrame, names: list[str] | None = None,
                 label: str = "label", **overrides) -> dict:
    """(model, seconds) per name; a model that fails is logged and its exception stands in the result."""
    out = {}
    for name in names or MODEL_NAMES:
        t0 = time.perf_counter()
        try:
            out[name] = (fit(name, preprocessor, train, label, **overrides), time.perf_counter() - t0)
        except Exception as exc:  # noqa: BLE001 - the reference logs and continues
            log.warning("model %s failed: %s", name, exc)
            out[name] = (exc, time.perf_counter() - t0)
    return out


def predict(model, df: DataFrame, out: str = "prediction", log_space: bool = False, clip: bool = True) -> DataFrame:
    """Predict log price, back-transform with expm1 and (optionally) clip."""
    scored = model.transform(df)
    if log_space:
        return scored.withColumnRenamed("prediction_log", out)
    scored = scored.withColumn(out, F.expm1("prediction_log"))
    if clip:
        from plotwise.operators.clean import clip_prediction
        # clipping asks for the least score of all: scores are written, so no row is scored twice
        scored = trees.written(scored.select(*df.columns, "prediction_log", out), "scores")
        scored = clip_prediction(scored, out, mode="reference")
    return scored


def batch_predict(model, df: DataFrame, price_col: str = "predicted_price") -> DataFrame:
    """Input columns plus the prediction column (name chosen by the caller)."""
    keep = df.columns
    return predict(model, df, out=price_col).select(*keep, price_col)


def _fold_scores(told: DataFrame) -> DataFrame:
    """(model, fold, n, r2, mse, mae) of rows (model, fold, y, p)."""
    e = F.col("y") - F.col("p")
    return told.groupBy("model", "fold").agg(
        F.count(F.lit(1)).alias("n"), (1 - F.sum(e * e) / (F.var_pop("y") * F.count("y"))).alias("r2"),
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"))


_SCORES = "model string, fold int, n long, r2 double, mse double, mae double"


def cross_validate(names: list[str], preprocessor: PipelineModel, train: DataFrame, id_col: str = "records_id", label: str = "label",
                   k: int = CV_FOLDS, seed: int = RANDOM_STATE, scores: ScoreLog | None = None, **overrides) -> list[dict]:
    """Shuffled k-fold (hash folds) of several models: mean R², population std of R²,
    sqrt(mean MSE), mean MAE. The fold scores of a model are written before the next begins."""
    from plotwise.operators.features import fold_column
    folded = fold_column(train, id_col, k, seed)
    feats = trees.written(preprocessor.transform(folded).select(F.col(id_col).alias("records_id"), F.col(label).alias("label"), F.col("fold").cast("int").alias("fold"), "features"), "cv-features")
    scores = scores or ScoreLog.of(feats.selectExpr("records_id", "label", "fold", "cast(features as string) AS features"), "cv", k, seed, tuple(sorted(overrides.items())))
    binned: list = []

    def told(name: str) -> DataFrame:
        if name in linear.SOLVERS:
            if _width(feats, "features") > CROSS_FEATURES:
                return _fold_by_fold(name, feats, k)
            return linear.out_of_fold(feats, [name])
        if name == "KNeighbors Regressor":
            q, t = _vectors(feats, "records_id", "q", None, "fold"), _vectors(feats, "records_id", "t", "label", "fold")
            near = _nearest_mean(q, t, overrides.get("k", 5))
            return near.join(feats.select("records_id", "fold", "label"), F.col("qid") == F.col("records_id")) \
                       .select(F.lit(name).alias("model"), "fold", F.col("label").alias("y"), F.col("prediction_log").alias("p"))
        base = tree_job(name, **overrides)
        if base is None:
            raise ValueError(f"unknown model {name!r}")
        if not binned:
            columns = trees.columns_of(preprocessor, feats)
            binned.extend([columns, trees.written(trees.chunked(feats, columns, "records_id", "label", "fold"), "cv-chunks")])
        jobs = [replace(base, fold=f) for f in range(k)]
        held = trees.held_out(binned[1], jobs, binned[0], ((None, 0),))
        return held.groupBy(F.col("job").alias("fold"), "id").agg(F.first("y").alias("y"), (F.sum("p0") / base.divisor).alias("p")) \
                   .select(F.lit(name).alias("model"), "fold", "y", "p")

    out = []
    for name in names:
        unit = "model=" + re.sub(r"[^A-Za-z0-9]+", "-", name).strip("-")
        rows = scores.rows(unit, _SCORES, lambda: _fold_scores(told(name)))
        r2, n = [r["r2"] for r in rows], len(rows)
        mean = sum(r2) / n
        out.append({"model": name, "cv_r2_mean": mean, "cv_r2_std": (sum((x - mean) ** 2 for x in r2) / n) ** 0.5,
                    "cv_rmse_mean": (sum(r["mse"] for r in rows) / n) ** 0.5, "cv_mae_mean": sum(r["mae"] for r in rows) / n})
    return out


def _fold_by_fold(name: str, feats: DataFrame, k: int, **overrides) -> DataFrame:
    out = None
    for f in range(k):
        train = feats.filter(F.col("fold") != f)
        stages = fit_lasso(train, **overrides) if name == "Lasso" else [make_regressor(name, train, "label", **overrides).fit(train)]
        part = PipelineModel(stages=stages).transform(feats.filter(F.col("fold") == f)).select(F.lit(name).alias("model"), "fold", F.col("label").alias("y"), F.col("prediction_log").alias("p"))
        out = part if out is None else out.unionByName(part)
    return out


def cv_metrics(name: str, preprocessor: PipelineModel, train: DataFrame, id_col: str = "records_id",
               label: str = "label", k: int = CV_FOLDS, seed: int = RANDOM_STATE, **overrides) -> dict:
    """``cross_validate`` of one model."""
    return cross_validate([name], preprocessor, train, id_col, label, k, seed, **overrides)[0]


def grid_search(preprocessor: PipelineModel, train: DataFrame, grid: dict, label: str = "label", folds: int = CV_FOLDS,
                seed: int = RANDOM_STATE, scores: ScoreLog | None = None, refit: bool = True, id_col: str = "records_id"):
    """Forest grid search by mean R² over the folds: (best model or None, one row per setting).
    Keys: numTrees, maxDepth, minInstancesPerNode, minSamplesSplit.

    Only the leaf size changes how trees grow. The most trees of the greatest depth are grown per fold and
    leaf size; fewer trees are the first of them, and less depth or larger split
    sizes stop earlier on the same way down. A fold's scores are written before the next fold begins.
    """
    from plotwise.operators.features import fold_column
    unknown = set(grid) - {"numTrees", "maxDepth", "minInstancesPerNode", "minSamplesSplit"}
    if unknown:
        raise ValueError(f"no such parameters: {sorted(unknown)}")
    counts = sorted(grid.get("numTrees", [100]))
    leaves = grid.get("minInstancesPerNode", [1])
    cuts = tuple((d, s) for d in grid.get("maxDepth", [None]) for s in grid.get("minSamplesSplit", [0]))
    deepest = None if any(d is None for d, _ in cuts) else max(d for d, _ in cuts)
    common = gcd(*counts)
    step = max(d for d in range(1, trees.BLOCK_TREES + 1) if common % d == 0)
    feats = trees.written(preprocessor.transform(fold_column(train, id_col, folds, seed))
                          .select(F.col(id_col).alias("records_id"), F.col(label).alias("label"), F.col("fold").cast("int").alias("fold"), "features"), "grid-features")
    scores = scores or ScoreLog.of(feats.selectExpr("records_id", "label", "fold", "cast(features as string) AS features"), "grid", sorted(grid.items()), folds, seed)
    schema = "leaf int, trees int, cut int, fold int, r2 double"
    columns = trees.columns_of(preprocessor, feats)
    chunks = trees.written(trees.chunked(feats, columns, "records_id", "label", "fold"), "grid-chunks")

    def fold_rows(f: int) -> DataFrame:
        jobs = [trees.Job("Random Forest", counts[-1], fold=f, leaf=leaf, depth=deepest, seed=seed, step=step) for leaf in leaves]
        held = trees.held_out(chunks, jobs, columns, cuts)
        sums = held.groupBy("job", "id").agg(F.first("y").alias("y"), *[
            (F.sum(F.when(F.col("tree") < n, F.col(f"p{i}"))) / n).alias(f"p{i}_{n}") for i in range(len(cuts)) for n in counts])
        square = F.var_pop("y") * F.count("y")
        wide = sums.groupBy("job").agg(*[(1 - F.sum((F.col("y") - F.col(f"p{i}_{n}")) ** 2) / square).alias(f"s{i}_{n}") for i in range(len(cuts)) for n in counts])
        each = F.array(*[F.struct(F.lit(n).alias("trees"), F.lit(i).alias("cut"), F.col(f"s{i}_{n}").alias("r2")) for i in range(len(cuts)) for n in counts])
        leaf = F.element_at(F.array(*[F.lit(x) for x in leaves]), F.col("job") + 1)
        return wide.select(leaf.alias("leaf"), F.explode(each).alias("e")).select("leaf", "e.trees", "e.cut", F.lit(f).alias("fold"), "e.r2")

    told = [r for f in range(folds) for r in scores.rows(f"fold={f}", schema, lambda: fold_rows(f))]
    rows = []
    for n in counts:
        for i, (d, s) in enumerate(cuts):
            for leaf in leaves:
                r2 = [r["r2"] for r in told if (r["leaf"], r["trees"], r["cut"]) == (leaf, n, i)]
                setting = {"numTrees": n, "maxDepth": d, "minInstancesPerNode": leaf, "minSamplesSplit": s}
                rows.append({**{key: setting[key] for key in grid}, "cv_r2": sum(r2) / len(r2)})
    best = max(rows, key=lambda r: r["cv_r2"])
    model = fit("Random Forest", preprocessor, train, label, **{key: v for key, v in best.items() if key != "cv_r2"}) if refit else None
    return model, rows


def feature_importance(model: PipelineModel, names: list[str], top_n: int | None = 10):
    """(feature, importance) sorted desc; the full list and its top n."""
    last = model.stages[-1]
    imp = getattr(last, "featureImportances", None)
    if imp is None:
        raise ValueError("model has no feature importances")
    pairs = sorted(zip(names, imp.toArray().tolist()), key=lambda t: (-t[1], t[0]))
    return pairs, pairs[:top_n] if top_n else pairs


def save_model(model, path: str, metadata: dict, spark) -> None:
    """Preprocessing and estimator together + one-row JSON metadata."""
    kind = "knn" if isinstance(model, KnnModel) else "trees" if isinstance(model, trees.ForestModel) else "pipeline"
    if kind != "pipeline":
        model.save(f"{path}/{kind}")
    else:
        model.write().overwrite().save(f"{path}/model")
    metadata = {**metadata, "kind": kind}
    spark.createDataFrame([(json.dumps(metadata, default=str),)], "metadata string") \
         .write.mode("overwrite").json(f"{path}/metadata")


def load_model(path: str, spark):
    meta = json.loads(spark.read.json(f"{path}/metadata").first()["metadata"])
    own = {"knn": KnnModel, "trees": trees.ForestModel}.get(meta.get("kind"))
    model = own.load(f"{path}/{meta['kind']}", spark) if own else PipelineModel.load(f"{path}/model")
    return model, meta


# ---------------------------------------------------------------------------
# exact k-nearest-neighbours regression
# ---------------------------------------------------------------------------

#: Rows per block of the search; a block of 25 entries a row takes 0.6 MB, however wide its vectors are.
KNN_BLOCK_ROWS = 2_000
#: Blocks of one side that meet the same blocks of the other, at most, and keys wanted so that all tasks have work.
KNN_SHELF, KNN_KEYS = 100, 64
#: A column that one row in so many of a block holds is multiplied as a matrix's; others are met entry by entry.
KNN_COMMON = 32
#: Queries whose distances to a block are held at once, and pairs whose exact distances are.
KNN_STRIP, KNN_PAIRS = 256, 16_384


def _blocks(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """(block, <cols as one array per block>): rows dealt into blocks of bounded expected size by a hash of their id."""
    blocks = max(1, -(-n // KNN_BLOCK_ROWS))
    return (df.withColumn("block", F.pmod(F.xxhash64(cols[0]), F.lit(blocks)).cast("int"))
              .groupBy("block").agg(F.collect_list(F.struct(*cols)).alias("rows")))


@dataclass
class _Entries:
    """Vectors of a block by their entries other than 0, row by row and in order of their columns."""
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    rows: int

    @classmethod
    def of(cls, block, side: str) -> "_Entries":
        """Of an Arrow struct array; indices are null where a vector is stored densely."""
        at, values = block.field(f"{side}i"), block.field(f"{side}v")
        sizes = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        listed = at.is_valid().to_numpy(zero_copy_only=False)
        column[listed[row]] = at.flatten().to_numpy(zero_copy_only=False)
        value = values.flatten().to_numpy(zero_copy_only=False)
        has = value != 0
        return cls(row[has], column[has], value[has], len(sizes))

    @property
    def squares(self) -> np.ndarray:
        return np.bincount(self.row, self.value * self.value, self.rows)

    def matrix(self, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows x these (ascending) columns, and the places of the entries that lie in others."""
        out = np.zeros((self.rows, len(columns)))
        if not len(columns):
            return out, np.arange(len(self.row))
        at = np.minimum(np.searchsorted(columns, self.column), len(columns) - 1)
        here = columns[at] == self.column
        out[self.row[here], at[here]] = self.value[here]
        return out, np.flatnonzero(~here)

    def spread(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the pick, place) of all entries of the picked rows."""
        ends = np.searchsorted(self.row, np.arange(self.rows + 1))
        return _ranges(ends[rows], ends[rows + 1])


def _ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, member) of all members of ranges [first, end)."""
    n = end - first
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n - first, n)


def _squared_distances(q: _Entries, t: _Entries, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Per pair the sum of squared differences, in order of columns: it depends on the two vectors only."""
    (pq, eq), (pt, et) = q.spread(rows), t.spread(others)
    pair, column, value = (np.concatenate(x) for x in ((pq, pt), (q.column[eq], t.column[et]), (q.value[eq], -t.value[et])))
    order = np.lexsort((column, pair))
    pair, column, value = pair[order], column[order], value[order]
    first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (column[1:] != column[:-1])]) if len(pair) else pair
    gaps = np.add.reduceat(value, first) if len(first) else value
    return np.bincount(pair[first], gaps * gaps, len(rows))


def _near(q: _Entries, t: _Entries, qg: np.ndarray, tg: np.ndarray, k: int, worst: np.ndarray):
    """(row of q, row of t, squared distance) of all pairs that may be among the k nearest of t and are no further than ``worst``."""
    columns, counts = np.unique(t.column, return_counts=True)
    common = columns[counts * KNN_COMMON >= t.rows]
    (a, qr), (b, tr) = q.matrix(common), t.matrix(common)
    tr = tr[np.argsort(t.column[tr], kind="stable")]
    aa, bb, grouped = q.squares, t.squares, np.isin(qg, tg).any()
    slack = 1e-9 * (aa + bb.max(initial=0.0) + 1.0)
    top = min(k, t.rows)
    for s in range(0, q.rows, KNN_STRIP):
        e = min(s + KNN_STRIP, q.rows)
        dots = a[s:e] @ b.T
        # entries in columns that few rows of t have
        mine = qr[np.searchsorted(q.row[qr], s):np.searchsorted(q.row[qr], e)]
        which, at = _ranges(*(np.searchsorted(t.column[tr], q.column[mine], side=x) for x in ("left", "right")))
        np.add.at(dots, (q.row[mine[which]] - s, t.row[tr[at]]), q.value[mine[which]] * t.value[tr[at]])
        # the expanded square rounds: it only narrows down, the choice is made on exact differences
        rough = dots
        rough *= -2.0
        rough += bb
        rough += aa[s:e, None]
        if grouped:
            rough[qg[s:e, None] == tg] = np.inf
        limit = worst[s:e]
        if not np.isfinite(limit).all():
            limit = np.minimum(limit, np.partition(rough, top - 1, axis=1)[:, top - 1])
        r, c = np.nonzero((rough <= (limit + slack[s:e])[:, None]) & (rough < np.inf))
        for x in range(0, len(r), KNN_PAIRS):
            rows, others = r[x:x + KNN_PAIRS] + s, c[x:x + KNN_PAIRS]
            yield rows, others, _squared_distances(q, t, rows, others)


class KnnModel:
    """Mean label of the k nearest training rows: Euclidean distance, ties by id.

    Nearest neighbours in hundreds of dimensions leave nothing to prune, so
    the search is exact and exhaustive: every block of queries meets every
    block of training rows in a task of its own, keeps its k best per query,
    and the best of all blocks are merged by a grouped top k. One path for
    every size; nothing passes through the driver but two counts.
    """

    def __init__(self, preprocessor: PipelineModel, train_feats: DataFrame, label: str, k: int = 5,
                 id_col: str = "records_id", features: str = "features"):
        self.preprocessor, self.k, self.features, self.id_col = preprocessor, k, features, id_col
        at, values = stored(features)
        self.train = train_feats.select(F.col(id_col).alias("tid"), at.alias("ti"), values.alias("tv"),
                                        F.col(label).cast("double").alias("y")).checkpoint()
        self.stages = preprocessor.stages

    def save(self, path: str) -> None:
        """Preprocessing, training rows and k; ``load`` reads them back."""
        self.preprocessor.write().overwrite().save(f"{path}/preprocessor")
        self.train.write.mode("overwrite").parquet(f"{path}/train")
        self.train.sparkSession.createDataFrame([(self.k, self.features, self.id_col)], "k int, features string, id_col string") \
            .write.mode("overwrite").json(f"{path}/settings")

    @classmethod
    def load(cls, path: str, spark) -> "KnnModel":
        row = spark.read.schema("k int, features string, id_col string").json(f"{path}/settings").first()
        out = cls.__new__(cls)
        out.preprocessor = PipelineModel.load(f"{path}/preprocessor")
        out.k, out.features, out.id_col, out.stages = row["k"], row["features"], row["id_col"], out.preprocessor.stages
        out.train = spark.read.parquet(f"{path}/train")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction_log``; rows are told apart by the id column."""
        at, values = stored(self.features)
        q = self.preprocessor.transform(df).select(F.col(self.id_col).alias("qid"), at.alias("qi"), values.alias("qv"), F.lit(-1).alias("qg")) \
            .dropDuplicates(["qid"]).checkpoint()
        preds = _nearest_mean(q, self.train.withColumn("tg", F.lit(-2)), self.k)
        return df.join(preds.withColumnRenamed("qid", "_qid"), F.col(self.id_col) == F.col("_qid"), "left").drop("_qid")


def _vectors(feats: DataFrame, id_col: str, side: str, label: str | None, group: str) -> DataFrame:
    at, values = stored("features")
    cols = [F.col(id_col).alias(f"{side}id"), at.alias(f"{side}i"), values.alias(f"{side}v"), F.col(group).alias(f"{side}g")]
    return feats.select(*cols, *([F.col(label).cast("double").alias("y")] if label else []))


def _nearest_mean(q: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """(qid, prediction_log): mean y of the k nearest of ``train`` (tid, ti, tv, tg, y) whose group
    isn't the query's own, for every row of ``q`` (qid, qi, qv, qg). Vectors travel as they are stored."""
    from pyspark.sql import Window
    nq, nt = q.count(), train.count()
    ids = (q.schema["qid"].dataType.simpleString(), train.schema["tid"].dataType.simpleString())
    blocks = [max(1, -(-n // KNN_BLOCK_ROWS)) for n in (nq, nt)]
    shelf = min(KNN_SHELF, max(1, int((blocks[0] * blocks[1] / KNN_KEYS) ** 0.5)))
    g, h = (-(-n // shelf) for n in blocks)

    def shelved(df: DataFrame, n: int, cols: list[str], name: str, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        return _blocks(df, n, *cols).select(F.col("rows").alias(name), (F.col("block") % own_n).alias(own),
                                            F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))).alias(other))
    pairs = shelved(q, nq, ["qid", "qi", "qv", "qg"], "queries", "g", g, "h", h) \
        .join(shelved(train, nt, ["tid", "ti", "tv", "y", "tg"], "rows", "h", h, "g", g), ["g", "h"]).select("queries", "rows")

    def nearest(batches):
        import pyarrow as pa

        def least(found):
            """The k best a query of what several blocks gave."""
            qs, ts, d, y = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((ts, d, qs))
            qs, ts, d, y = qs[order], ts[order], d[order], y[order]
            first = np.r_[True, qs[1:] != qs[:-1]]
            keep = np.arange(len(qs)) - np.flatnonzero(first)[np.cumsum(first) - 1] < k
            return qs[keep], ts[keep], d[keep], y[keep]

        def record(qid, best):
            qs, ts, d, y = best
            return pa.RecordBatch.from_arrays([pa.array(qid[qs], types[0]), pa.array(ts, types[1]), pa.array(d, pa.float64()), pa.array(y, pa.float64())], names=["qid", "tid", "d", "y"])

        best, before, types = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                qs, ts = batch.column("queries")[i].values, batch.column("rows")[i].values
                qid, tid, y = qs.field("qid").to_numpy(zero_copy_only=False), ts.field("tid").to_numpy(zero_copy_only=False), ts.field("y").to_numpy(zero_copy_only=False)
                types = qs.field("qid").type, ts.field("tid").type
                # a block of queries meets its shelf's blocks one after the other: only the best of all of them go on
                if before is None or not np.array_equal(before, qid):
                    if best is not None:
                        yield record(before, best)
                    best, before, q = None, qid, _Entries.of(qs, "q")
                    worst = np.full(len(qid), np.inf)
                qg, tg = qs.field("qg").to_numpy(zero_copy_only=False), ts.field("tg").to_numpy(zero_copy_only=False)
                for rows, others, d in _near(q, _Entries.of(ts, "t"), qg, tg, k, worst):
                    best = least([*([best] if best is not None else []), (rows, tid[others], d, y[others])])
                if best is not None:
                    counts = np.bincount(best[0], minlength=len(qid))
                    full = counts == k
                    worst[full] = best[2][np.cumsum(counts)[full] - 1]
        if best is not None:
            yield record(before, best)

    best = pairs.mapInArrow(nearest, f"qid {ids[0]}, tid {ids[1]}, d double, y double")
    # row_number <= k is planned as a group limit before the shuffle
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("d", "tid"))
    preds = best.withColumn("rn", rank).filter(F.col("rn") <= k).groupBy("qid").agg(F.avg("y").alias("prediction_log"))
    return preds
