"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the evidence of its characters and of itself: log odds of its
character n-grams (boundaries included) and of the whole word, taken from hashed tables of document
counts. Windows of 32 words, each half overlapping the next, run through a
forward and a backward GRU; attention pools the states and one
unit gives the window's logit. All windows of every text are scored; the
text's score is its strongest window, calibrated.

Training is plain numpy on a bounded sample of labelled rows: tables are cross-fitted (a text's
evidence never counts its own fold), windows are chosen as in multiple-instance learning (the strongest
window stands for its text), and gradients come from back-propagation
through time. Scoring is numpy inside Spark tasks, a bounded block of windows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import text_of

WINDOW, STRIDE = 32, 16
HIDDEN = 8
GRAMS = (3, 4, 5, 6, 7)
TABLE = 1 << 18
THRESHOLD = 0.3
#: Bounds of the labelled sample that the model is fitted on (rows by hash of their id).
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 3000
HELD_OUT = 2            # rows whose crc32(id) mod 4 is this are never learned from
FOLDS = 3
SMOOTHING = 3.0
BLOCK_WINDOWS = 2048
BLOCK_WORDS = 60_000
#: Distinct words whose evidence a worker remembers; emptied when full.
MEMORY = 300_000
#: Training: gradient steps in all, batch, and how often the strongest windows are chosen anew.
STEPS, BATCH, TURNS = 600, 128, 3
SEED = 7

_TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words, ASCII punctuation read as space."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split() if text else []


def _slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Starts of the words in their joined bytes, table slots of whole words, and per
    n-gram length the positions that have one and their slots."""
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    buf = np.frombuffer(b"\x02" + b"\x03\x02".join(words) + b"\x03", dtype=np.uint8).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    left = np.repeat(starts + lens, lens) - np.arange(len(buf))         # bytes from here to the word's end
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    grams, h = [], np.zeros(len(buf), dtype=np.uint32)
    for n in range(1, GRAMS[-1] + 1):
        h = h[:len(buf) - n + 1] * np.uint32(0x01000193) + buf[n - 1:]
        if n in GRAMS:
            at = np.flatnonzero(left[:len(h)] >= n)
            x = h[at] * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            grams.append((at, (x >> np.uint32(14)).astype(np.int64) & (TABLE - 1)))
    return starts, (own & np.uint64(TABLE - 1)).astype(np.int64), grams


def evidence(words: list[bytes], gram_odds: np.ndarray, word_odds: np.ndarray) -> np.ndarray:
    """Inputs of each word: strongest, weakest and mean n-gram, strongest
    n-gram at its start, the whole word, its length."""
    starts, own, grams = _slots(words)
    n = int(starts[-1]) + len(words[-1]) + 2
    high, low, total, count = np.full(n, -9, np.float32), np.full(n, 9, np.float32), np.zeros(n, np.float32), np.zeros(n, np.float32)
    for at, slot in grams:
        v = gram_odds[slot]
        high[at] = np.maximum(high[at], v)
        low[at] = np.minimum(low[at], v)
        total[at] += v
        count[at] += 1
    return np.stack([
        np.maximum.reduceat(high, starts), np.minimum.reduceat(low, starts),
        np.add.reduceat(total, starts) / np.maximum(np.add.reduceat(count, starts), 1),
        high[starts], word_odds[own],
        np.log1p(np.diff(np.append(starts, n)) - 2).astype(np.float32) / 3], axis=1).astype(np.float32)


INPUTS = 6


# -- the network ------------------------------------------------------------

def _new_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {}
    for d in ("f", "b"):
        w["x" + d] = rng.normal(0, 0.4, (INPUTS, 3 * HIDDEN))
        w["u" + d] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        w["c" + d] = np.zeros(3 * HIDDEN)
    w["att"] = rng.normal(0, 0.3, 2 * HIDDEN)
    w["out"] = rng.normal(0, 0.3, 2 * HIDDEN)
    w["bias"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(w: dict, x: np.ndarray, mask: np.ndarray | None, keep: bool) -> tuple[np.ndarray, list]:
    """Logits of windows x (steps, windows, inputs); mask is 1 where a word is, None if everywhere."""
    steps, n, _ = x.shape
    states, tapes = [], []
    for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        proj = (x.reshape(steps * n, INPUTS) @ w["x" + d] + w["c" + d]).reshape(steps, n, 3 * HIDDEN)
        h = np.zeros((n, HIDDEN), np.float32)
        out, tape = np.empty((steps, n, HIDDEN), np.float32), []
        for t in order:
            rec = h @ w["u" + d]
            gates = _sigmoid(proj[t, :, :2 * HIDDEN] + rec[:, :2 * HIDDEN])
            r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
            cand = np.tanh(proj[t, :, 2 * HIDDEN:] + r * rec[:, 2 * HIDDEN:])
            new = cand + z * (h - cand)
            if mask is not None:
                new = h + mask[t][:, None] * (new - h)
            if keep:
                tape.append((t, h, r, z, cand, rec[:, 2 * HIDDEN:]))
            out[t] = h = new
        states.append(out)
        tapes.append(tape)
    hs = np.concatenate(states, axis=2)
    score = hs @ w["att"]
    if mask is not None:
        score = np.where(mask > 0, score, -1e9)
    a = np.exp(score - score.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", a, hs)
    return pooled @ w["out"] + w["bias"][0], [hs, a, pooled, tapes]


def _gradients(w: dict, x: np.ndarray, mask: np.ndarray, kept: list, dlogit: np.ndarray) -> dict[str, np.ndarray]:
    """Back-propagation through attention, both directions and time."""
    hs, a, pooled, tapes = kept
    steps, n, _ = x.shape
    g = {k: np.zeros_like(v) for k, v in w.items()}
    g["out"], g["bias"] = pooled.T @ dlogit, np.array([dlogit.sum()], np.float32)
    dpool = dlogit[:, None] * w["out"]
    da = np.einsum("nh,tnh->tn", dpool, hs)
    dscore = a * (da - (a * da).sum(axis=0))
    g["att"] = np.einsum("tn,tnh->h", dscore, hs)
    dhs = a[:, :, None] * dpool[None] + dscore[:, :, None] * w["att"]
    for k, d in enumerate("fb"):
        u = w["u" + d]
        carry = np.zeros((n, HIDDEN), np.float32)
        for t, h, r, z, cand, rec_c in reversed(tapes[k]):
            total = dhs[t, :, k * HIDDEN:(k + 1) * HIDDEN] + carry
            m = mask[t][:, None]
            dnew = total * m
            dz, dcand = dnew * (h - cand) * z * (1 - z), dnew * (1 - z) * (1 - cand * cand)
            dr = dcand * rec_c * r * (1 - r)
            drec = np.concatenate([dr, dz, dcand * r], axis=1)
            dproj = np.concatenate([dr, dz, dcand], axis=1)
            carry = total * (1 - m) + dnew * z + drec @ u.T
            g["u" + d] += h.T @ drec
            g["x" + d] += x[t].T @ dproj
            g["c" + d] += dproj.sum(axis=0)
    return g


def _starts(n: int) -> list[int]:
    """Starts of the windows over n words; the last one ends with the text."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _stack(inputs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    mask = (at < ends[None, :]).astype(np.float32)
    return inputs[np.minimum(at, len(inputs) - 1)] * mask[:, :, None], mask


@dataclass
class Model:
    gram_odds: np.ndarray
    word_odds: np.ndarray
    weights: dict[str, np.ndarray]
    scale: float
    shift: float
    prior: float

    def calibrated(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logit + self.shift, -40, 40)))


def _windows(lens: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end of its text and number of its text for every window over texts laid end to end."""
    first = np.concatenate(([0], np.cumsum(lens)[:-1])).astype(np.int64)
    starts, ends, owner = [], [], []
    for i, n in enumerate(lens):
        if n:
            s = _starts(n)
            starts += [int(first[i]) + a for a in s]
            ends += [int(first[i]) + n] * len(s)
            owner += [i] * len(s)
    return tuple(np.asarray(v, dtype=np.int64) for v in (starts, ends, owner))


def _logits(weights: dict, inputs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts))
    full = ends - starts >= WINDOW
    for which, masked in ((full, False), (~full, True)):
        at = np.flatnonzero(which)
        for k in range(0, len(at), BLOCK_WINDOWS):
            sel = at[k:k + BLOCK_WINDOWS]
            x, mask = _stack(inputs, starts[sel], ends[sel])
            out[sel] = _run(weights, x, mask if masked else None, keep=False)[0]
    return out


def window_logits(weights: dict, inputs: np.ndarray, lens: list[int]) -> np.ndarray:
    """Largest window logit per text, -inf without words; ``inputs`` holds the words of all texts end to end."""
    starts, ends, owner = _windows(lens)
    best = np.full(len(lens), -np.inf)
    np.maximum.at(best, owner, _logits(weights, inputs, starts, ends))
    return best


def _odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Log odds of the share of toxic texts that have a slot, smoothed towards none."""
    a = (toxic / max(n_toxic, 1) * 100 + SMOOTHING) / (clean / max(n_clean, 1) * 100 + SMOOTHING)
    return np.log(a).astype(np.float32)


def train(texts: list[str], labels: list[int], weights: list[float]) -> Model:
    """Fit tables, network and calibration; ``weights`` undo the sample's share of toxic rows.
    Without both labels the model says the labels' mean for every text."""
    y = np.asarray(labels, dtype=np.float32)
    rng = np.random.default_rng(SEED)
    grams, words_t = np.zeros((FOLDS, 2, TABLE), np.float32), np.zeros((FOLDS, 2, TABLE), np.float32)
    fold = np.arange(len(y)) % FOLDS
    prior = float(np.average(y, weights=weights)) if len(y) else 0.0
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(TABLE, np.float32), np.zeros(TABLE, np.float32), _new_weights(rng), 0.0,
                     float(np.log((prior + 1e-3) / (1 - prior + 1e-3))), prior)
    # words are read off a text whenever they are needed: those of all texts at once would take ten times the texts
    lens_all = np.zeros(len(y), dtype=np.int64)
    for i, t in enumerate(texts):
        ws = words_of(t)
        lens_all[i] = len(ws)
        if ws:
            _, own, gr = _slots(list(dict.fromkeys(ws)))
            words_t[fold[i], int(y[i]), np.unique(own)] += 1
            grams[fold[i], int(y[i]), np.unique(np.concatenate([s for _, s in gr]))] += 1
    size = lambda f, c: float(((fold != f) & (y == c)).sum())
    has = np.flatnonzero(lens_all)
    if not len(has):
        return Model(np.zeros(TABLE, np.float32), np.zeros(TABLE, np.float32), _new_weights(rng), 0.0,
                     float(np.log((prior + 1e-3) / (1 - prior + 1e-3))), prior)
    lens = lens_all[has].tolist()
    first = np.concatenate([[0], np.cumsum(lens_all)[:-1]])
    flat = np.zeros((int(lens_all.sum()), INPUTS), np.float32)
    for f in range(FOLDS):
        g = _odds(grams.sum(0)[1] - grams[f, 1], grams.sum(0)[0] - grams[f, 0], size(f, 1), size(f, 0))
        o = _odds(words_t.sum(0)[1] - words_t[f, 1], words_t.sum(0)[0] - words_t[f, 0], size(f, 1), size(f, 0))
        for i in has[fold[has] == f]:
            flat[first[i]:first[i] + lens_all[i]] = evidence(words_of(texts[i]), g, o)
    w = _new_weights(rng)
    starts, ends, owner = _windows(lens)
    target = y[has][owner]
    hint = np.empty(len(starts), np.float32)
    for a in range(0, len(starts), BLOCK_WINDOWS):
        at, end = starts[None, a:a + BLOCK_WINDOWS] + np.arange(WINDOW)[:, None], ends[a:a + BLOCK_WINDOWS]
        hint[a:a + BLOCK_WINDOWS] = np.partition(np.where(at < end, flat[np.minimum(at, len(flat) - 1), 0], 0), -3, axis=0)[-3:].sum(axis=0)
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for turn in range(TURNS):
        # the window that stands for its text: by evidence at first, then by the network
        if turn:
            hint = _logits(w, flat, starts, ends)
        order = np.lexsort((hint, owner))
        strongest = order[np.append(owner[order][1:] != owner[order][:-1], True)]
        clean = np.flatnonzero(target == 0)
        for _ in range(max(1, STEPS // TURNS // max(1, 2 * len(strongest) // BATCH))):
            # clean texts add as many windows drawn from all of theirs
            chosen = rng.permutation(np.concatenate([strongest, rng.choice(clean, min(len(clean), len(strongest)), replace=False)]))
            for at in range(0, len(chosen), BATCH):
                part = chosen[at:at + BATCH]
                x, mask = _stack(flat, starts[part], ends[part])
                logit, kept = _run(w, x, mask, keep=True)
                g = _gradients(w, x, mask, kept, ((_sigmoid(logit) - target[part]) / len(part)).astype(np.float32))
                step += 1
                for k in w:         # Adam
                    m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                    m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                    w[k] -= (0.01 * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    best = window_logits(w, flat, lens)
    scale, shift = _platt(best, y[has], np.asarray(weights, dtype=float)[has])
    total_t, total_c = float((y == 1).sum()), float((y == 0).sum())
    return Model(_odds(grams.sum(0)[1], grams.sum(0)[0], total_t, total_c),
                 _odds(words_t.sum(0)[1], words_t.sum(0)[0], total_t, total_c), w, scale, shift, prior)


def _platt(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted one-dimensional logistic regression by Newton's method, slope held positive."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        d, c = weight * (p - y), weight * p * (1 - p)
        ga, gb = (d * logit).sum() + 1e-2 * (a - 1), d.sum() + 1e-3 * b
        haa, hab, hbb = (c * logit * logit).sum() + 1e-2, (c * logit).sum(), c.sum() + 1e-3
        det = haa * hbb - hab * hab
        a, b = a - np.clip((hbb * ga - hab * gb) / det, -1, 1), b - np.clip((haa * gb - hab * ga) / det, -1, 1)
    return max(float(a), 0.05), float(b)


# -- Spark ------------------------------------------------------------------

def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", n_toxic: int = TRAIN_TOXIC, n_clean: int = TRAIN_CLEAN) -> Model:
    """Train on at most ``n_toxic`` and ``n_clean`` labelled rows that aren't held out,
    those whose ids come first by hash."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
                   .groupBy(F.col(id_col).alias("_lid")).agg(F.max(F.col(label_col).cast("int")).alias("_y")))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    ids = None
    for value, most in ((1, n_toxic), (0, n_clean)):
        part = known.filter(F.col("_y") == value).orderBy(F.xxhash64("_lid"), "_lid").limit(most)
        ids = part if ids is None else ids.unionByName(part)
    # at most n_toxic + n_clean ids: a proven bound for the broadcast and for what reaches the driver
    rows = (docs.join(F.broadcast(ids), F.col(id_col) == F.col("_lid")).groupBy("_lid", "_y").agg(F.min(text_of(text_col)).alias("text"))
                .orderBy(F.xxhash64("_lid"), "_lid").collect())
    texts, y = [r["text"] for r in rows], [r["_y"] for r in rows]
    del rows
    got = {v: max(1, y.count(v)) for v in (0, 1)}
    return train(texts, y, [counts.get(v, 0) / got[v] for v in y])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted.

    Null or empty text and text without words scores 0. Ids, sources and other columns never
    enter a score, so equal texts score alike. Extra columns are not read. An empty table gives an empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[bytes, int] = {}
        table = np.zeros((1024, INPUTS), np.float32)

        def known(words: list[bytes]) -> np.ndarray:
            """Inputs of the words in order, from the worker's memory of distinct words."""
            nonlocal table
            new = [x for x in dict.fromkeys(words) if x not in place]
            if new:
                if len(place) + len(new) > MEMORY:
                    place.clear()
                    new = list(dict.fromkeys(words))
                at = len(place)
                if at + len(new) > len(table):
                    table = np.concatenate([table, np.zeros((max(len(table), at + len(new) - len(table)), INPUTS), np.float32)])
                table[at:at + len(new)] = evidence(new, model.gram_odds, model.word_odds)
                place.update(zip(new, range(at, at + len(new)), strict=True))
            return table[np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words))]

        for b in batches:
            scores, inputs, lens = [], [], []

            def flush() -> None:
                if lens:
                    logit = window_logits(model.weights, np.concatenate(inputs) if inputs else np.zeros((0, INPUTS), np.float32), lens)
                    scores.extend(np.where(np.isneginf(logit), 0.0, model.calibrated(np.where(np.isneginf(logit), 0, logit))).tolist())
                    inputs.clear()
                    lens.clear()

            for t in b.column(1):
                ws = words_of(t.as_py())
                lens.append(len(ws))
                if ws:
                    inputs.append(known(ws))
                if sum(lens) >= BLOCK_WORDS:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    src = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(run, f"id {kind}, score double")
               .select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on the labels, score every text."""
    return score(docs, fit(docs, labels, id_col, text_col), id_col, text_col)
