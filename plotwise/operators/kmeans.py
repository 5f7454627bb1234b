"""K-means on planar points, all restarts in the same passes over the data.

Points at one place are one weighted location. Starts come from k-means||:
every round draws about 2k locations a restart, with a chance in proportion to
weight times squared distance, and the drawn ones are thinned to k on the
driver (k-means++ over some 4k weighted candidates). Lloyd's iterations follow.
A pass holds all centres of all restarts (n_init x k points), tasks send one
sum per restart and cluster, and restarts that have come to rest drop out, so
ten restarts read the data as often as the slowest one alone.

Draws depend on location, seed and round only: a task that runs again draws
the same, and restart r of seed s is restart 0 of seed s + r.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 2              # least number of k-means|| rounds
MAX_ITER, TOL = 300, 1e-4


@dataclass
class Fit:
    """One restart: its centres (k x 2: y, x), its cost, the passes it took."""
    centres: np.ndarray
    cost: float
    iterations: int


def _nearest(yx: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (ties: the first) and the squared distance."""
    d = ((yx[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(yx)), at]


def _uniform(h: np.ndarray, stream: int) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit hashes and a stream number."""
    with np.errstate(over="ignore"):
        z = h.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(stream & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _sums(locations: DataFrame, sets: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per restart one row per centre: weight, weighted y and x, cost. One pass for all restarts."""
    def run(batches):
        acc = {r: np.zeros((len(c), 4)) for r, c in sets.items()}
        for b in batches:
            yx, w = b[["y", "x"]].to_numpy(), b["w"].to_numpy(dtype=float)
            for r, centres in sets.items():
                at, d = _nearest(yx, centres)
                for j, v in enumerate((w, w * yx[:, 0], w * yx[:, 1], w * d)):
                    acc[r][:, j] += np.bincount(at, weights=v, minlength=len(centres))
        for r, a in acc.items():
            yield pd.DataFrame({"restart": r, "cluster": np.arange(len(a)), "w": a[:, 0], "y": a[:, 1], "x": a[:, 2], "cost": a[:, 3]})

    rows = (locations.mapInPandas(run, "restart int, cluster int, w double, y double, x double, cost double")
                     .groupBy("restart", "cluster").agg(*[F.sum(c).alias(c) for c in ("w", "y", "x", "cost")]).collect())
    out = {r: np.zeros((len(c), 4)) for r, c in sets.items()}
    for row in rows:
        out[row.restart][row.cluster] = row.w, row.y, row.x, row.cost
    return out


def _draw(locations: DataFrame, sets: dict[int, np.ndarray], cost: dict[int, float], size: int, streams: dict[int, int]) -> dict[int, np.ndarray]:
    """New candidates of every restart, about ``size`` each, in one pass."""
    def run(batches):
        for b in batches:
            yx, w, h = b[["y", "x"]].to_numpy(), b["w"].to_numpy(dtype=float), b["h"].to_numpy(dtype=np.int64)
            for r, centres in sets.items():
                took = _uniform(h, streams[r]) * cost[r] < size * w * _nearest(yx, centres)[1]
                if took.any():
                    yield pd.DataFrame({"restart": r, "y": yx[took, 0], "x": yx[took, 1]})

    rows = locations.mapInPandas(run, "restart int, y double, x double").orderBy("restart", "y", "x").collect()
    return {r: np.array([(q.y, q.x) for q in rows if q.restart == r]).reshape(-1, 2) for r in sets}


def _thin(candidates: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of the weighted candidates by k-means++."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(candidates), p=weight / weight.sum()))]
    while len(chosen) < k:
        d = weight * _nearest(candidates, candidates[chosen])[1]
        if d.sum() > 0:
            chosen.append(int(rng.choice(len(candidates), p=d / d.sum())))
        else:                       # what is left lies on chosen places or has no weight
            chosen.append(next(i for i in range(len(candidates)) if i not in chosen))
    return candidates[chosen]


def _starts(locations: DataFrame, k: int, seed: int, n_init: int) -> dict[int, np.ndarray]:
    first = locations.agg(*[F.min_by(F.struct("y", "x"), F.struct(F.xxhash64("y", "x", F.lit(seed + r)), "y", "x")).alias(f"c{r}")
                            for r in range(n_init)]).first()
    sets = {r: np.array([[first[f"c{r}"].y, first[f"c{r}"].x]]) for r in range(n_init)}
    turn = 0
    while turn < ROUNDS or any(len(c) < k for c in sets.values()):
        # a restart's rounds don't depend on those of others: it stops once it has enough
        open_ = {r: c for r, c in sets.items() if turn < ROUNDS or len(c) < k}
        cost = {r: float(s[:, 3].sum()) for r, s in _sums(locations, open_).items()}
        new = _draw(locations, open_, cost, 2 * k, {r: (seed + r) * 1_000_003 + turn for r in open_})
        for r in open_:
            sets[r] = np.vstack([sets[r], new[r]])
        turn += 1
    weights = _sums(locations, sets)
    return {r: _thin(c, weights[r][:, 0], k, seed + r) for r, c in sets.items()}


def fit_restarts(points: DataFrame, k: int, y: str = "lat", x: str = "lon", seed: int = 42, n_init: int = 10,
                 max_iter: int = MAX_ITER, tol: float = TOL) -> list[Fit]:
    """Lloyd's algorithm from ``n_init`` starts; one Fit per restart, [] without points.

    Points with a null or non-finite coordinate take no part; k is held to the
    number of distinct places. A restart rests once its centres move by less
    than ``tol`` of the mean variance (sum of squares); an empty cluster keeps its centre."""
    locations = (points.select(F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x"))
                       .filter((F.abs("y") < float("inf")) & (F.abs("x") < float("inf")))
                       .groupBy("y", "x").agg(F.count(F.lit(1)).alias("w"))
                       .withColumn("h", F.xxhash64("y", "x")).checkpoint())
    s = locations.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"),
                      F.sum(F.col("w") * F.col("y")).alias("sy"), F.sum(F.col("w") * F.col("x")).alias("sx")).first()
    if not s.n:
        return []
    my, mx = s.sy / s.w, s.sx / s.w
    spread = locations.agg(F.sum(F.col("w") * (F.pow(F.col("y") - my, 2) + F.pow(F.col("x") - mx, 2)))).first()[0]
    rest = tol * spread / s.w / 2
    k = max(1, min(k, s.n))
    centres = _starts(locations, k, seed, n_init)
    moving, fits = set(centres), {}
    for turn in range(1, max_iter + 1):
        for r, a in _sums(locations, {r: centres[r] for r in sorted(moving)}).items():
            held = a[:, 0] > 0
            new = centres[r].copy()
            new[held] = a[held, 1:3] / a[held, :1]
            moved = float(((new - centres[r]) ** 2).sum())
            centres[r] = new
            if moved <= rest or turn == max_iter:
                moving.discard(r)
                fits[r] = turn
        if not moving:
            break
    final = _sums(locations, centres)
    return [Fit(centres[r], float(final[r][:, 3].sum()), fits[r]) for r in sorted(centres)]


def assign(points: DataFrame, centres: np.ndarray, y: str = "lat", x: str = "lon", out: str = "cluster") -> DataFrame:
    """Adds the number of the nearest centre (ties: the smaller); null without a finite place."""
    rows = F.array(*[F.struct(F.lit(float(cy)).alias("y"), F.lit(float(cx)).alias("x"), F.lit(i).alias("i")) for i, (cy, cx) in enumerate(centres)])
    py, px = F.col(y).cast("double"), F.col(x).cast("double")
    best = F.array_min(F.transform(rows, lambda c: F.struct(
        ((py - c["y"]) * (py - c["y"]) + (px - c["x"]) * (px - c["x"])).alias("d"), c["i"].alias("i"))))
    return points.withColumn(out, F.when((F.abs(py) < float("inf")) & (F.abs(px) < float("inf")), best["i"]))
