"""Trees against an exhaustive search, forests against each other, searches on real fits and after a break."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from plotwise.operators import linear, models, scores, trees

LEAVES = ((None, 0),)


def rows(n, seed=0, groups=(4, 9)):
    rng = np.random.default_rng(seed)
    bins = np.column_stack([*[rng.integers(0, 20, n) for _ in range(3)], *[rng.integers(0, k, n) for k in groups]]).astype(np.uint16)
    y = 0.2 * bins[:, 0] + np.sin(bins[:, 1]) + 2.0 * (bins[:, 3] == 2) + rng.normal(size=n)
    y = np.round(y * 2 ** 24) / 2 ** 24     # exact sums, as ``chunked`` makes them
    return bins, y, np.arange(bins.shape[1]) >= 3


def exhaustive(bins, y, w, grouped, leaf, depth, level=0):
    """Nested (mean, column, code, left, right) by trying every split of every node."""
    mean = (w * y).sum() / w.sum()
    best = None
    if depth is None or level < depth:
        for c in range(bins.shape[1]):
            for code in np.unique(bins[:, c]):
                left = bins[:, c] == code if grouped[c] else bins[:, c] <= code
                lw, rw = w[left].sum(), w[~left].sum()
                if (grouped[c] and code == 0) or lw < leaf or rw < leaf:
                    continue
                ly, ry = (w * y)[left].sum(), (w * y)[~left].sum()
                gain = ly * ly / lw + ry * ry / rw
                if gain - (w * y).sum() ** 2 / w.sum() > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, c, int(code), left)
    if best is None:
        return (mean,)
    _, c, code, left = best
    return (mean, c, code, exhaustive(bins[left], y[left], w[left], grouped, leaf, depth, level + 1),
            exhaustive(bins[~left], y[~left], w[~left], grouped, leaf, depth, level + 1))


def nested(tree, n=0):
    column, code, left, value = tree[:4]
    if column[n] < 0:
        return (value[n],)
    return (value[n], int(column[n]), int(code[n]), nested(tree, left[n]), nested(tree, left[n] + 1))


def same(a, b):
    return len(a) == len(b) and a[0] == pytest.approx(b[0], abs=1e-9) and (len(a) == 1 or (a[1:3] == b[1:3] and same(a[3], b[3]) and same(a[4], b[4])))


@pytest.mark.parametrize("leaf,depth", [(1, None), (3, None), (2, 4)])
def test_growth_equals_an_exhaustive_search(leaf, depth):
    bins, y, grouped = rows(150)
    w = trees.weights(1, 2, np.arange(150))
    r = w > 0
    assert same(nested(trees.grow(bins, y, w, grouped, leaf, depth)), exhaustive(bins[r], y[r], w[r], grouped, leaf, depth))


def test_leaves_of_one_row_and_of_equal_rows():
    bins, y, grouped = rows(400)
    p = trees.walk(trees.grow(bins, y, np.ones(400), grouped), bins, grouped)[0]
    _, back = np.unique(bins, axis=0, return_inverse=True)
    means = np.bincount(back, y) / np.bincount(back)
    assert p == pytest.approx(means[back], abs=1e-9)
    assert trees.grow(bins[:0], y[:0], np.zeros(0), grouped)[3].tolist() == [0.0]
    assert len(trees.grow(bins, np.ones(400), np.ones(400), grouped)[0]) == 1


def peeled(n, seed=3):
    """Rows of many codes, each with a mean of its own far from the others', so that splits take a code off at a time."""
    rng = np.random.default_rng(seed)
    code = rng.integers(0, n // 10, n)
    bins = np.column_stack([*[rng.integers(0, 64, n) for _ in range(20)], code]).astype(np.uint16)
    y = np.round((np.exp(rng.normal(size=n // 10) * 2)[code] + 0.01 * bins[:, 0]) * 2 ** 16) / 2 ** 16
    return bins, y, np.arange(21) == 20


@pytest.mark.parametrize("leaf,depth", [(1, None), (2, 9), (4, None)])
def test_sums_and_sorted_positions_choose_the_same_splits(leaf, depth, monkeypatch):
    bins, y, grouped = peeled(3000)
    w = trees.weights(5, 1, np.arange(3000))
    want = trees.grow(bins, y, w, grouped, leaf, depth)
    for few, together in ((8, 100), (10_000, 8192)):        # sums down to a few rows, sorted positions from the root on
        monkeypatch.setattr(trees, "FEW_ROWS", few, raising=False)
        monkeypatch.setattr(trees, "ORDERED", together, raising=False)
        assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(trees.grow(bins, y, w, grouped, leaf, depth), want))


def test_a_code_is_split_off_without_sorting_all_rows_again():
    import time
    bins, y, grouped = peeled(30_000)

    def seconds(work):
        t = time.process_time()
        work()
        return time.process_time() - t
    sort = min(seconds(lambda: np.argsort(bins.T.astype(np.int64), axis=1, kind="stable")) for _ in range(3))
    assert seconds(lambda: trees.grow(bins, y, np.ones(30_000), grouped, 1, 400)) < 150 * sort


def test_cuts_equal_growth_with_limits():
    bins, y, grouped = rows(800)
    tree = trees.grow(bins, y, np.ones(800), grouped, 2)
    cuts = ((3, 0), (7, 0), (None, 0), (5, 40))
    p = trees.walk(tree, bins, grouped, cuts)
    for i, (d, s) in enumerate(cuts[:3]):
        assert np.array_equal(p[i], trees.walk(trees.grow(bins, y, np.ones(800), grouped, 2, d), bins, grouped)[0])
    small = trees.walk(tree, bins, grouped, ((None, 40),))[0]
    assert {round(v, 9) for v in small} <= {round(v, 9) for v, h in zip(tree[3], tree[6]) if h < 2 * 800}
    stops = (tree[6] < 40) | (tree[0] < 0)
    assert set(np.round(small, 9)) <= set(np.round(tree[3][stops], 9))


def test_bootstrap_weights_are_poisson():
    w = trees.weights(7, 3, np.arange(200_000))
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert not np.array_equal(w, trees.weights(7, 4, np.arange(200_000))) and np.array_equal(w[5:9], trees.weights(7, 3, np.arange(5, 9)))


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(600, 4)), 2)
    y = x[:, 0] + np.abs(x[:, 1]) * 2 + 0.3 * rng.normal(size=600)
    y = np.round(y * 2 ** 20) / 2 ** 20
    df = spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(600)], "records_id long, a double, b double, c double, d double, label double")
    return x, y, df.repartition(3), PipelineModel(stages=[VectorAssembler(inputCols=list("abcd"), outputCol="features")])


def predictions(model, df):
    return np.array([r["prediction_log"] for r in model.transform(df).select("records_id", "prediction_log").orderBy("records_id").collect()])


def test_large_nodes_are_split_in_spark(frame, monkeypatch):
    """The same forest, whether every tree fits one task or only nodes of 90 rows do; the same scores, joined or in place."""
    x, y, df, prep = frame
    one = models.fit("Random Forest", prep, df, numTrees=4, maxDepth=6)
    monkeypatch.setattr(trees, "TASK_ROWS", 90)
    many = models.fit("Random Forest", prep, df, numTrees=4, maxDepth=6)
    assert not one.tops and len(many.tops) == 4 and max(t.depth[-1] for t in many.tops.values()) >= 2
    p = predictions(one, df)
    assert p == pytest.approx(predictions(many, df), abs=1e-9)
    assert np.array(one.featureImportances) == pytest.approx(np.array(many.featureImportances), abs=1e-9)
    assert np.array(one.featureImportances).argmax() in (0, 1) and sum(one.featureImportances) == pytest.approx(1.0)
    monkeypatch.setattr(trees, "BROADCAST_BYTES", 0)
    assert p == pytest.approx(predictions(one, df), abs=1e-12)


def test_growth_searches_a_few_columns_at_a_time(monkeypatch):
    import tracemalloc
    rng = np.random.default_rng(4)
    bins = rng.integers(0, 50, (60_000, 40)).astype(np.uint16)
    y = np.round((bins[:, 3] * 0.1 + rng.normal(size=60_000)) * 2 ** 20) / 2 ** 20
    grouped = np.arange(40) >= 37
    want = trees.grow(bins, y, np.ones(60_000), grouped, 1, 5)
    monkeypatch.setattr(trees, "CELLS", 1 << 17, raising=False)
    tracemalloc.start()
    got = trees.grow(bins, y, np.ones(60_000), grouped, 1, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.array_equal(a, b) for a, b in zip(got, want))
    assert peak < 64e6          # all columns at once: 2.4 million cells of 50 bytes and more


def test_a_model_keeps_one_tree_a_row(frame, monkeypatch):
    """No row of a model holds a block of trees, and groups of few rows give the scores of one group."""
    x, y, df, prep = frame
    m = models.fit("Random Forest", prep, df, numTrees=12, maxDepth=8)
    assert m.subtrees.count() == 12
    p = predictions(m, df)
    monkeypatch.setattr(trees, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(trees, "CHUNK_ROWS", 50)
    monkeypatch.setattr(trees, "SCORED_ROWS", 120, raising=False)
    assert p == pytest.approx(predictions(m, df), abs=1e-12)


def test_held_out_scores_of_split_trees(frame, monkeypatch):
    from plotwise.operators.features import fold_column
    x, y, df, prep = frame
    feats = prep.transform(fold_column(df, "records_id", 3))
    columns = trees.columns_of(prep, feats)
    jobs = [trees.Job("f", 3, fold=f, leaf=2) for f in range(3)]
    cuts = ((1, 0), (2, 0), (4, 30), (None, 0))

    def told():
        chunks = trees.written(trees.chunked(feats, columns, "records_id", "label", "fold"), "t")
        held = trees.held_out(chunks, jobs, columns, cuts).groupBy("job", "id").agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in range(4)]).orderBy("id")
        return np.array([tuple(r) for r in held.collect()])
    whole = told()
    assert len(whole) == 600
    monkeypatch.setattr(trees, "TASK_ROWS", 60)
    assert whole == pytest.approx(told(), abs=1e-9)


def test_trees_are_saved_and_loaded(spark, frame, tmp_path):
    x, y, df, prep = frame
    for name in ("Decision Tree", "Gradient Boosting"):
        m = models.fit(name, prep, df, maxIter=5)
        models.save_model(m, str(tmp_path / name), {"model_name": name}, spark)
        again, meta = models.load_model(str(tmp_path / name), spark)
        assert np.array_equal(predictions(m, df), predictions(again, df)) and meta["kind"] == "trees"


def test_unlimited_tree_learns_rows_by_heart(frame):
    x, y, df, prep = frame
    columns = trees.columns_of(prep, prep.transform(df))
    bins = columns.bins(x)
    _, back = np.unique(bins, axis=0, return_inverse=True)
    want = (np.bincount(back, y) / np.bincount(back))[back]
    assert predictions(models.fit("Decision Tree", prep, df), df) == pytest.approx(want, abs=1e-9)


def test_boosting_follows_the_residuals(frame):
    x, y, df, prep = frame
    bins = trees.columns_of(prep, prep.transform(df)).bins(x)
    grouped, p = np.zeros(4, dtype=bool), np.full(600, y.mean())
    grain = trees.grain_of(np.abs(y - p).max())
    for _ in range(6):
        p = p + 0.1 * trees.walk(trees.grow(bins, np.round((y - p) / grain) * grain, np.ones(600), grouped, 1, 3), bins, grouped)[0]
    assert predictions(models.fit("Gradient Boosting", prep, df, maxIter=6), df) == pytest.approx(p, abs=1e-9)


def test_encoded_groups_become_one_column(spark):
    from plotwise.operators.features import build_preprocessor
    df = spark.createDataFrame([(i, float(i % 7), "abcd"[i % 4], "xy"[i % 2], float(i)) for i in range(80)], "records_id long, n double, k string, l string, label double")
    prep, names = build_preprocessor(df, ["n"], ["k", "l"])
    columns = trees.columns_of(prep, prep.transform(df))
    assert columns.slots == (0,) and columns.groups == ((1, 4), (4, 5)) and [names[columns.slot(1, c)] for c in (1, 2, 3)] == ["k_b", "k_c", "k_d"]
    x = np.array([r["features"].toArray() for r in prep.transform(df).orderBy("records_id").collect()])
    assert columns.bins(x)[:4, 1].tolist() == [0, 1, 2, 3] and columns.bins(x)[:2, 2].tolist() == [0, 1]


# ---------------------------------------------------------------- searches --

def test_closed_forms_of_ridge_and_lasso(spark, frame):
    """Against numpy on all rows, and against the estimators that fit the same models."""
    x, y, df, prep = frame
    g = sum(linear.cross_products(prep.transform(df.withColumn("fold", F.col("records_id") % 2))).values())
    xc, yc = x - x.mean(axis=0), y - y.mean()
    for alpha in (0.5, 1.0, 20.0):
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
        assert linear.ridge(g, alpha) == pytest.approx([y.mean() - x.mean(axis=0) @ w, *w], abs=1e-9)
        m = models.fit("Ridge", prep, df, alpha=alpha).stages[-1]
        assert [m.intercept, *m.coefficients] == pytest.approx(linear.ridge(g, alpha), abs=1e-6)
    for alpha in (0.01, 0.1, 0.6):
        beta = linear.lasso(g, alpha)
        pull = xc.T @ (yc - xc @ beta[1:]) / 600       # the condition of a lasso solution
        assert all(abs(c) <= alpha + 1e-8 if b == 0 else c == pytest.approx(alpha * np.sign(b), abs=1e-8) for c, b in zip(pull, beta[1:]))
        m = models.fit("Lasso", prep, df, alpha=alpha).stages[-1]
        assert [m.intercept, *m.coefficients] == pytest.approx(beta, abs=1e-4)
    assert linear.least_squares(g)[1:] == pytest.approx(np.linalg.lstsq(xc, yc, rcond=None)[0], abs=1e-9)


def folds_by_hand(x, y, ids, k, fit):
    from plotwise.config import RANDOM_STATE
    from plotwise.operators.features import HASH_FACTOR, HASH_MODULUS
    fold = ((ids % HASH_MODULUS * HASH_FACTOR + RANDOM_STATE + 1) % HASH_MODULUS % (1000 * k)) % k
    r2, mse, mae = [], [], []
    for f in range(k):
        p = fit(x[fold != f], y[fold != f], x[fold == f])
        e, t = y[fold == f] - p, y[fold == f]
        r2.append(1 - (e @ e) / ((t - t.mean()) @ (t - t.mean())))
        mse.append((e @ e) / len(e))
        mae.append(np.abs(e).mean())
    return {"cv_r2_mean": np.mean(r2), "cv_r2_std": np.std(r2), "cv_rmse_mean": np.sqrt(np.mean(mse)), "cv_mae_mean": np.mean(mae)}


def test_cross_validation_equals_ten_fits(frame):
    x, y, df, prep = frame

    def ols(a, b, q):
        return np.column_stack([np.ones(len(q)), q]) @ np.linalg.lstsq(np.column_stack([np.ones(len(a)), a]), b, rcond=None)[0]

    def knn(a, b, q):
        return np.array([b[np.argsort(((a - r) ** 2).sum(axis=1), kind="stable")[:5]].mean() for r in q])

    def tree(a, b, q):
        cols = trees.columns_of(prep, prep.transform(df))
        t = trees.grow(cols.bins(a), b, np.ones(len(a)), np.zeros(4, dtype=bool))
        return trees.walk(t, cols.bins(q), np.zeros(4, dtype=bool))[0]
    for name, by_hand in (("Linear Regression", ols), ("KNeighbors Regressor", knn), ("Decision Tree", tree)):
        got = models.cv_metrics(name, prep, df)
        want = folds_by_hand(x, y, np.arange(600), 10, by_hand)
        assert {k: got[k] for k in want} == pytest.approx(want, abs=1e-7), name


def test_grid_equals_separate_forests(frame, tmp_path):
    """Prefixes, depths and split sizes of one growth, against a growth per setting."""
    x, y, df, prep = frame
    grid = {"numTrees": [2, 6], "maxDepth": [2, 30], "minSamplesSplit": [2, 25], "minInstancesPerNode": [1, 4]}
    _, got = models.grid_search(prep, df, grid, folds=3, refit=False)
    assert len(got) == 16
    cols = trees.columns_of(prep, prep.transform(df))
    flat = np.zeros(4, dtype=bool)
    for setting in got:
        def forest(a, b, q, s=setting):
            ids = np.array([lookup[tuple(r)] for r in a])
            out = np.zeros(len(q))
            for t in range(s["numTrees"]):
                grown = trees.grow(cols.bins(a), b, trees.weights(42, t, ids), flat, s["minInstancesPerNode"], s["maxDepth"])
                out += trees.walk(grown, cols.bins(q), flat, ((None, s["minSamplesSplit"]),))[0]
            return out / s["numTrees"]
        lookup = {tuple(r): i for i, r in enumerate(x)}
        assert setting["cv_r2"] == pytest.approx(folds_by_hand(x, y, np.arange(600), 3, forest)["cv_r2_mean"], abs=1e-9), setting


def test_searches_go_on_where_they_broke_off(spark, frame, tmp_path, monkeypatch):
    x, y, df, prep = frame
    grid, done = {"numTrees": [2], "maxDepth": [3, 5]}, []
    log = scores.ScoreLog(spark, str(tmp_path / "grid"))
    plain = trees.held_out

    def breaks(chunks, jobs, *rest):
        if len(done) == 2:
            raise RuntimeError("lost")
        done.append(jobs[0].fold)
        return plain(chunks, jobs, *rest)
    monkeypatch.setattr(trees, "held_out", breaks)
    with pytest.raises(RuntimeError):
        models.grid_search(prep, df, grid, folds=4, refit=False, scores=log)
    monkeypatch.setattr(trees, "held_out", lambda chunks, jobs, *rest: done.append(jobs[0].fold) or plain(chunks, jobs, *rest))
    _, again = models.grid_search(prep, df, grid, folds=4, refit=False, scores=log)
    assert done == [0, 1, 2, 3]
    _, whole = models.grid_search(prep, df, grid, folds=4, refit=False, scores=scores.ScoreLog(spark, str(tmp_path / "other")))
    assert again == whole and len(done) == 8
    _, known = models.grid_search(prep, df, grid, folds=4, refit=False, scores=log)
    assert known == whole and len(done) == 8


def test_a_log_belongs_to_its_data(spark, frame):
    _, _, df, _ = frame
    a, b = scores.ScoreLog.of(df, 1), scores.ScoreLog.of(df.repartition(5), 1)
    assert a.path == b.path != scores.ScoreLog.of(df.limit(599), 1).path and a.path != scores.ScoreLog.of(df, 2).path


def test_registered_searches_are_whole(spark):
    """The documented grid and all nine models, on real fits."""
    from math import prod

    from plotwise.plans import modelling as pm
    assert prod(map(len, pm.GRID.values())) == 81
    tiny = {"numTrees": [20], "maxDepth": [30], "minSamplesSplit": [2, 5, 10], "minInstancesPerNode": [1, 4]}
    whole, pm.GRID = pm.GRID, tiny
    try:
        assert pm.q_grid_search(spark, "/root/testdata/sf0.001").count() == 6
    finally:
        pm.GRID = whole
    rows = pm.q_cv_metrics(spark, "/root/testdata/sf0.001").collect()
    assert [r["model"] for r in rows] == models.MODEL_NAMES and all(r["cv_rmse_mean"] > 0 for r in rows)


def test_trained_models_are_evaluated_on_their_predictions(spark):
    """The written table, read by DuckDB with the metrics' SQL; splits are those that the models were fitted with."""
    import duckdb

    from plotwise.plans import evaluation as pe, modelling as pm
    sf = "/root/testdata/sf0.001"
    got = {(r["model"], r["split"], r["scale"]): r for r in pm.q_trained_evaluation(spark, sf).collect()}
    path = pm.prediction_table(spark, sf)
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW t AS SELECT * FROM read_parquet('{path}/**/*.parquet', hive_partitioning = true)")
    for scale, y, p in (("original", "y", "p"), ("log", "ln(1 + y)", "ln(1 + p)")):
        rel = duck.sql(f"SELECT model, split, {pe._metrics_sql(y, p)} FROM t GROUP BY model, split")
        rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
        assert len(rows) == 27 and {r["model"] for r in rows} == set(models.MODEL_NAMES)
        for r in rows:
            mine = got[r["model"], r["split"], scale]
            assert all(mine[k] == pytest.approx(r[k], rel=1e-8) for k in ("mse", "rmse", "mae", "r2", "n"))
    best = duck.sql(f"SELECT model FROM (SELECT model, {pe._metrics_sql()} FROM t WHERE split = 'holdout' GROUP BY model) ORDER BY r2 DESC, model").fetchall()
    assert [r["model"] for r in pm.q_trained_comparison(spark, sf).orderBy("rank").collect()] == [m for m, in best]
    n = {s: f.count() for s, f in zip(("train", "test", "holdout"), pm.three_splits(spark, sf))}
    assert all(got[m, s, "log"]["n"] == n[s] for m in models.MODEL_NAMES for s in n)
    assert got["Decision Tree", "train", "log"]["r2"] > 0.9 > got["Lasso", "train", "log"]["r2"]


def test_boosting_beyond_a_task_grows_the_same_trees(frame, monkeypatch):
    """Level by level over chunks of rows, what is left written every three trees: the model of one task, its held-out scores too."""
    from plotwise.operators.features import fold_column
    x, y, df, prep = frame
    want = models.fit("Gradient Boosting (depth 5)", prep, df, maxIter=8)
    feats = prep.transform(fold_column(df, "records_id", 2)).repartition(3)
    columns = trees.columns_of(prep, feats)
    chunks = trees.written(trees.chunked(feats, columns, "records_id", "label", "fold"), "t")
    jobs = [trees.Job("b", 4, fold=f, depth=3, bootstrap=False, rate=0.1) for f in range(2)]

    def told():
        return [tuple(r) for r in trees.held_out(chunks, jobs, columns, ((None, 0), (1, 0))).select("job", "id", "y", "p0", "p1").orderBy("id").collect()]
    whole = told()
    monkeypatch.setattr(trees, "TASK_ROWS", 90)
    monkeypatch.setattr(trees, "CHUNK_ROWS", 70)
    monkeypatch.setattr(trees, "REWRITE", 3)
    got = models.fit("Gradient Boosting (depth 5)", prep, df, maxIter=8)
    assert isinstance(got, trees.ForestModel) and got.subtrees.count() == 9
    assert predictions(got, df) == pytest.approx(predictions(want, df), abs=1e-12)
    assert np.array(got.featureImportances) == pytest.approx(np.array(want.featureImportances), abs=1e-12)
    assert len(whole) == 600 and np.array(told()) == pytest.approx(np.array(whole), abs=1e-12)


def test_groups_of_many_indicators_keep_their_codes():
    n = 70_000
    columns = trees.Columns((0,), ((0.5,),), ((1, n + 1),))
    got = columns.bins_of([np.array([0, n]), np.array([1])], [np.array([1.0, 1.0]), np.array([1.0])])
    assert got.tolist() == [[1, n], [0, 1]]
