"""Feature preparation: splits, log-scaling, drop-first one-hot encoding,
assembly into one vector – fitted on the training rows only and kept as
stages of a ``PipelineModel`` so scoring applies exactly the same transform.

Fitting touches the data with one aggregate (means and population standard
deviations) and one ``StringIndexer`` fit per categorical column; only those
scalars and category lists reach the driver.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler,
                                VectorSlicer)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.config import RANDOM_STATE, TEMPORAL_SPLIT_YEAR, TEST_SIZE


def temporal_split(df: DataFrame, split_year: int = TEMPORAL_SPLIT_YEAR, year_col: str = "year"):
    """(train: year < split, test: year ≥ split); NULL years fall in neither."""
    return df.filter(F.col(year_col) < split_year), df.filter(F.col(year_col) >= split_year)


#: Modulus and multiplier of the congruential hash that any SQL engine can repeat on integer ids.
HASH_MODULUS, HASH_FACTOR = 2147483647, 48271


def hash_fraction(id_col: str, seed: int = RANDOM_STATE, buckets: int = 1000):
    spread = F.pmod(F.col(id_col).cast("long"), F.lit(HASH_MODULUS)) * HASH_FACTOR + seed
    return spread % HASH_MODULUS % buckets


def random_split(df: DataFrame, id_col: str = "records_id", test_size: float = TEST_SIZE,
                 seed: int = RANDOM_STATE):
    """Seeded split by a hash of the row id: the same row always lands on the
    same side, whatever the partitioning (unlike ``randomSplit``)."""
    h = hash_fraction(id_col, seed)
    cut = int(round(test_size * 1000))
    return df.filter(h >= cut), df.filter(h < cut)


def fold_column(df: DataFrame, id_col: str = "records_id", k: int = 10, seed: int = RANDOM_STATE,
                out: str = "fold") -> DataFrame:
    return df.withColumn(out, hash_fraction(id_col, seed + 1, 1000 * k) % k)


def _round_sig(v: float, digits: int | None) -> float:
    return float(f"{v:.{digits - 1}e}") if digits and v else v


def fit_log_scaler(train: DataFrame, cols: list[str], suffix: str = "_scaled",
                   stat_digits: int | None = None) -> tuple[SQLTransformer, dict]:
    """log1p, then (x − mean) / population std fitted on ``train`` (std 0 → 1).
    Spark's StandardScaler uses the sample std, so the fit is one aggregate
    and the transform a persisted SQL statement. ``stat_digits`` rounds the
    fitted statistics (makes fits reproducible across summation orders)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.log1p(F.col(c))).alias(f"m_{c}"), F.stddev_pop(F.log1p(F.col(c))).alias(f"s_{c}")]
    row = train.agg(*aggs).first()
    stats = {c: (_round_sig(row[f"m_{c}"] or 0.0, stat_digits), _round_sig(row[f"s_{c}"] or 0.0, stat_digits))
             for c in cols}
    exprs = []
    for c, (m, s) in stats.items():
        s = s if s and s > 0 else 1.0
        exprs.append(f"(log1p(`{c}`) - {m!r}D) / {s!r}D AS `{c}{suffix}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"), stats


def fit_one_hot_drop_first(train: DataFrame, cols: list[str]) -> tuple[list, list[str]]:
    """Levels sorted alphabetically on ``train``; the first level is dropped;
    unseen levels encode as all zeros. Returns fitted stages and names."""
    stages, names = [], []
    for c in cols:
        to_str = SQLTransformer(statement=f"SELECT *, CAST(`{c}` AS STRING) AS `{c}__s` FROM __THIS__")
        t = to_str.transform(train.select(c))
        idx = StringIndexer(inputCol=f"{c}__s", outputCol=f"{c}_idx", stringOrderType="alphabetAsc",
                            handleInvalid="keep").fit(t)
        levels = list(idx.labels)
        # index len(levels) is the 'unknown' slot; dropLast removes exactly it
        enc = OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_oh", dropLast=True,
                            handleInvalid="keep").fit(idx.transform(t))
        stages += [to_str, idx, enc]
        keep = list(range(1, len(levels)))  # drop the alphabetically first level
        if keep:
            stages.append(VectorSlicer(inputCol=f"{c}_oh", outputCol=f"{c}_ohd", indices=keep))
            names += [f"{c}_{levels[i]}" for i in keep]
    return stages, names


def build_preprocessor(train: DataFrame, continuous: list[str], categorical: list[str],
                       out: str = "features") -> tuple[PipelineModel, list[str]]:
    """Fitted preprocessing pipeline and the ordered feature names."""
    scaler, _ = fit_log_scaler(train, continuous)
    oh_stages, oh_names = fit_one_hot_drop_first(train, categorical)
    inputs = [f"{c}_scaled" for c in continuous]
    sliced = [s.getOutputCol() for s in oh_stages if isinstance(s, VectorSlicer)]
    assembler = VectorAssembler(inputCols=inputs + sliced, outputCol=out, handleInvalid="keep")
    return PipelineModel(stages=[scaler, *oh_stages, assembler]), continuous + oh_names
