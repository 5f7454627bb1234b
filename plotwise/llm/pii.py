"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs
them, and a span classifier trained on the weighed votes decides.

One pass over the texts finds the base spans (fixed patterns) and further
candidates of looser shape, each with the votes of seven labelers: patterns,
checks, gazetteers and contexts. Equal vote patterns are counted over the whole corpus by a grouped count
(there are only so many patterns), expectation-maximisation estimates each
labeler's reliability from these counts without any label, and a logistic regression on votes and shapes is fitted to the
posteriors. Candidates that it accepts join the base spans, which always stay.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import materialise, text_of

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = 4
#: Labelers with the share of right votes that estimation starts from; it counts as STRENGTH votes.
LABELERS = {"pattern": 0.95, "check": 0.95, "gazetteer": 0.75, "cue": 0.65, "counter_cue": 0.75, "shape": 0.7, "border": 0.65}
STRENGTH = 20
ROUNDS = 200            # of expectation-maximisation, which stops earlier once nothing moves
ACCEPT = 0.5

# Gazetteers and cue words, lower case.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl pl ru cn jp br in au ca ch at be se no dk fi pt ie eu us mx ar".split())
CARD_PREFIXES = ("34", "36", "37", "38", "4", "51", "52", "53", "54", "55", "6011", "62", "65", "35", "22", "23", "24", "25", "26", "27")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54",
                 "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "351", "352", "353", "358", "420")
SECRET_NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "private_key", "auth")
CUES = {"email": ("mail", "contact", "write", "reach", "schreib", "correo", "courriel"),
        "ip": ("ip", "host", "server", "address", "login", "from", "connect"),
        "card": ("card", "visa", "credit", "mastercard", "karte", "carte", "tarjeta", "pay"),
        "phone": ("phone", "call", "tel", "fax", "mobile", "anruf", "appel", "llam"),
        "secret": SECRET_NAMES}
COUNTER_CUES = ("version", "isbn", "issn", "page", "order", "invoice", "section", "figure", "doi", "build", "release", "example")

_LOCAL = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\bat\b) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\bdot\b) ?[A-Za-z0-9-]{1,63})++", re.IGNORECASE)
_NATIONAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_ASSIGNED = re.compile(rf"(?:{'|'.join(map(re.escape, SECRET_NAMES))})\s*+[=:][ \t]*+[\"']?([^\s\"',;<>]{{6,}}+)", re.IGNORECASE)
_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(t: str) -> Iterator[tuple[int, int]]:
    """From each @ back over the run of local characters and on over the domain: the
    leftmost non-overlapping matches, in linear time on any text."""
    free, p = 0, t.find("@")
    while p >= 0:
        run = t[free:p]
        start = p - (len(run) - len(run.rstrip(_LOCAL)))
        m = _DOMAIN.match(t, p) if start < p else None
        if m:
            yield start, m.end()
        free = m.end() if m else p + 1
        p = t.find("@", free)


def _quads(t: str) -> Iterator[tuple[int, int, list[str]]]:
    """Four digit runs joined by single dots, from the left, without overlap."""
    for m in _DOTTED.finditer(t):
        if m.group().count(".") < 3:
            continue
        at, runs = m.start(), []
        for part in m.group().split("."):
            runs = [*runs, (at, part)] if part else []
            at += len(part) + 1
            if len(runs) == 4:
                yield runs[0][0], at - 1, [r for _, r in runs]
                runs = []


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, ordered by start, then kind."""
    out = [(a, 0, b) for a, b in _emails(t)] if "@" in t else []
    out += [(a, 1, b) for a, b, runs in _quads(t) if all(len(r.lstrip("0")) <= 3 and int(r[-3:]) <= 255 for r in runs)]
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 12:
            d = _DIGITS.sub("", m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in t:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(t) if 9 <= len(_DIGITS.sub("", m.group())) <= 15]
    return sorted(out)


def _loose(t: str) -> list[tuple[int, int, int]]:
    """Candidates of looser shape than the base patterns."""
    out = []
    if "dot" in t or "DOT" in t or "Dot" in t:
        out += [(m.start(), 0, m.end()) for m in _SPELLED.finditer(t)]
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 13 and 13 <= len(_DIGITS.sub("", m.group())) <= 19:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _NATIONAL.finditer(t)]
    out += [(a, 1, b) for a, b, _ in _quads(t)]
    if "=" in t or ":" in t:
        out += [(m.start(1), 4, m.end(1)) for m in _ASSIGNED.finditer(t)]
    return out


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def votes(t: str, start: int, kind: int, end: int, strict: bool) -> tuple[int, ...]:
    """Per labeler 1 for personal data, -1 against, 0 for no opinion."""
    span, name = t[start:end], KINDS[kind]
    digits = _DIGITS.sub("", span)
    before, after = t[max(0, start - 40):start].lower(), t[end:end + 1]
    if kind == 0:
        tail = re.split(r"[.\s()\[\]]+", span.lower())[-1]
        check, known = 1 if re.search(r"[a-z]", tail) else -1, 1 if tail in TOP_DOMAINS else 0
        shape = 1 if strict else (1 if re.search(r"[\[(]at[\])]", span, re.IGNORECASE) else -1)
    elif kind == 1:
        parts = span.split(".")
        fit = all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts)
        check, known = 1 if fit else -1, -1 if fit and parts[0] in ("0", "00", "000") else 0
        shape = -1 if any(len(p) > 1 and p[0] == "0" for p in parts) or all(len(p) == 1 for p in parts) else 1
    elif kind == 2:
        check, known = 1 if luhn(digits) else -1, 1 if digits.startswith(CARD_PREFIXES) else -1
        groups = re.split(r"[ -]", span)
        shape = 1 if len(digits) in (15, 16) and (len(groups) == 1 or all(len(g) in (4, 5, 6) for g in groups)) else -1
    elif kind == 3:
        check = 1 if 9 <= len(digits) <= 15 else -1
        known = (1 if digits.startswith(CALLING_CODES) else -1) if span[0] == "+" else 0
        shape = 1 if span[0] == "+" or "(" in span or span.count("-") == 2 else 0
    else:
        check, known = 1 if _entropy(span) >= 2.5 else -1, 1
        shape = 1 if re.search(r"[0-9]", span) and len(span) >= 8 else -1
    cue = 1 if any(c in before for c in CUES[name]) else 0
    against = -1 if any(c in before for c in COUNTER_CUES) else 0
    border = -1 if (start and t[start - 1].isalnum() and span[0].isalnum()) or (after.isalnum() and span[-1].isalnum()) else 1
    return (1 if strict else 0, check, known, cue, against, shape, border)


def _code(v: tuple[int, ...], span: str) -> int:
    """Votes and the binned shape of a span as one number: the key of the counts."""
    size = min(len(span) // 6, 7)
    share = min(3, 4 * sum(c.isdigit() for c in span) // max(1, len(span)))
    code = 0
    for x in v:
        code = code * 3 + x + 1
    return (code * 8 + size) * 4 + share


def _decode(code: int) -> tuple[list[int], int, int]:
    code, share = divmod(code, 4)
    code, size = divmod(code, 8)
    v = []
    for _ in LABELERS:
        code, x = divmod(code, 3)
        v.append(x - 1)
    return v[::-1], size, share


def reliabilities(kinds: np.ndarray, v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation on counted vote patterns: probability that each pattern is
    personal data, and per kind the labelers' shares of right votes. Votes are taken as
    independent given the truth; the shares that estimation starts from also hold rarely used labelers."""
    start = np.asarray(list(LABELERS.values()))
    post, right = np.full(len(n), 0.5), np.tile(start, (len(KINDS), 1))
    prior = np.full(len(KINDS), 0.5)
    for _ in range(ROUNDS):
        logit = np.log(prior[kinds] / (1 - prior[kinds])) + (v * np.log(right[kinds] / (1 - right[kinds]))).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        moved, post = np.abs(new - post).max(initial=0), new
        for k in range(len(KINDS)):
            at = kinds == k
            if at.any():
                w, p, x = n[at][:, None], post[at][:, None], v[at]
                good = (w * (p * (x == 1) + (1 - p) * (x == -1))).sum(axis=0)
                said = (w * (x != 0)).sum(axis=0)
                right[k] = np.clip((good + STRENGTH * start) / (said + STRENGTH), 0.05, 0.99)
                prior[k] = np.clip(((w * p).sum() + 1) / (w.sum() + 2), 0.02, 0.98)
        if moved < 1e-9:
            break
    return post, right


def _design(kind: int, v: list[int], size: int, share: int) -> np.ndarray:
    x = np.zeros(len(KINDS) + 2 * len(v) + 8 + 4)
    x[kind] = 1
    for j, a in enumerate(v):
        if a:
            x[len(KINDS) + 2 * j + (a < 0)] = 1
    x[len(KINDS) + 2 * len(v) + size] = 1
    x[len(KINDS) + 2 * len(v) + 8 + share] = 1
    return x


@dataclass
class SpanModel:
    weights: np.ndarray
    right: np.ndarray

    def probability(self, kind: int, code: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(_design(kind, *_decode(code)) @ self.weights, -30, 30))))


def train(counts: list[tuple[int, int, int]]) -> SpanModel:
    """Fit on (kind, code, count) patterns: reliabilities, then a logistic regression on their posteriors (Newton, ridge 1)."""
    width = len(KINDS) + 2 * len(LABELERS) + 12
    if not counts:
        return SpanModel(np.zeros(width), np.tile(np.asarray(list(LABELERS.values())), (len(KINDS), 1)))
    counts = sorted(counts)
    kinds, n = np.asarray([c[0] for c in counts]), np.asarray([c[2] for c in counts], dtype=float)
    v = np.asarray([_decode(c[1])[0] for c in counts], dtype=float)
    post, right = reliabilities(kinds, v, n)
    x = np.stack([_design(c[0], *_decode(c[1])) for c in counts])
    w = np.zeros(width)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(width), x.T @ (n * (post - p)) - w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return SpanModel(w, right)


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, and per candidate its start, kind, end, whether it is a base span, and the code of votes and shape."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("base", pa.bool_()), ("code", pa.int32())])
        for b in batches:
            found = []
            for cell in b.column(1):
                t = cell.as_py()
                base = base_spans(t)
                known = set(base)
                spans = [(*s, True) for s in base] + [(*s, False) for s in dict.fromkeys(_loose(t)) if s not in known]
                found.append([{"start": a, "kind": k, "end": e, "base": strict, "code": _code(votes(t, a, k, e, strict), t[a:e])}
                              for a, k, e, strict in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(item))], names=["id", "found"])

    src = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(find, f"id {kind}, found array<struct<start bigint, kind int, end bigint, base boolean, code int>>")


def _merged(spans) -> list[tuple[int, int]]:
    """Disjoint intervals that cover the spans, in order (base spans of two kinds may overlap)."""
    out: list[tuple[int, int]] = []
    for a, e in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((a, e))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in sorted(spans))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone (base spans),
    base_spans and spans (kind:start:end, comma-joined, code points, end exclusive).

    Null or empty text has none. Added spans never overlap a base span or each
    other (the likelier one stays, then the earlier). Null ids and repeated rows are kept as rows; extra columns
    are not read. An empty table gives an empty table.
    """
    found = materialise(find_candidates(docs, id_col, text_col), "pii-candidates")
    # at most 5 kinds x 3^7 votes x 32 shapes can occur, however many documents there are
    counts = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.code").count().collect()
    model = train([(r["kind"], r["code"], r["count"]) for r in counts])
    sure = {(r["kind"], r["code"]): model.probability(r["kind"], r["code"]) for r in counts}

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for cell in b.column(1).to_pylist():
                base = [(c["start"], c["kind"], c["end"]) for c in cell if c["base"]]
                taken = _merged((a, e) for a, _, e in base)
                spans = list(base)
                for c in sorted((c for c in cell if not c["base"] and sure[c["kind"], c["code"]] >= ACCEPT),
                                key=lambda c: (-sure[c["kind"], c["code"]], c["start"], c["kind"])):
                    at = bisect_left(taken, (c["start"], c["end"]))
                    if (at == 0 or taken[at - 1][1] <= c["start"]) and (at == len(taken) or c["end"] <= taken[at][0]):
                        taken.insert(at, (c["start"], c["end"]))
                        spans.append((c["start"], c["kind"], c["end"]))
                per = Counter(k for _, k, _ in base)
                for i in range(BASE_KINDS):
                    out[i].append(per[i])
                out[4].append(_joined(base))
                out[5].append(_joined(spans))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(o, pa.int64()) for o in out[:4]], *[pa.array(o, pa.string()) for o in out[4:]]],
                                             names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans"])

    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(decide, f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string").withColumnRenamed("id", id_col)
