"""Repair of the turn structure of conversations.

A conversation should read ``(s?(ua)+)?``: perhaps a system turn, then user and
assistant in turns. The cheapest edits that make it so come from a four-state automaton:
nothing yet, after system, after user, after assistant. Hirschberg's scheme finds them in
linear space: cost vectors over the four states run forward from the start and backward
from the end and meet in the middle; the crossing on an optimal path with
the least audit is fixed, and both halves recurse.

Forward vectors carry, beside each cost, the rank of the least audit that leads there.
Two audits of the same rows that end in different states differ before either
ends, so ranks decide ties without any audit being stored.

Rows are sorted once by range and cut into segments of 1,024. A conversation inside
one segment is solved there. One that crosses a border is summed up per
segment by a 4 x 4 matrix; the same scheme over matrices fixes the states at
the borders, and each segment is solved between them. So a conversation of any length takes
one task only its matrices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import materialise

#: Rows a segment.
SEGMENT = 1024
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Next state and role letter of a turn that fits into the pattern.
_NEXT = {NOTHING: (USER, "u"), SYSTEM: (USER, "u"), USER: (ASSISTANT, "a"), ASSISTANT: (USER, "u")}
#: What completes the pattern after the last row.
_TAIL = {NOTHING: (0, ""), SYSTEM: (2 * INSERT, "IuIa"), USER: (INSERT, "Ia"), ASSISTANT: (0, "")}
_LEGAL = {(0, 1), (1, 2), (2, 1)}

EDITS = "key string, positions array<long>, steps array<string>"
_RUN = "key string, seg long, positions array<long>, steps array<string>, codes array<int>, costs array<int>, ranks array<int>, illegal long, first int, last int"


# ------------------------------------------------------------ the automaton --

@lru_cache(maxsize=None)
def moves(code: int) -> tuple[dict[int, tuple[int, str, str]], ...]:
    """Per state: {state after the row: (cost, audit, steps)}. ``code`` is the class of the role
    (0 system, 1 user, 2 assistant, 3 other) + 4 if the row must go + 8 if it is truncated."""
    cls, gone, extra = code & 3, code & 4, TRUNCATED if code & 8 else 0
    out = []
    for start in range(4):
        best: dict[int, tuple[int, str, str]] = {}

        def offer(state: int, cost: int, audit: str, steps: str, best: dict = best) -> None:
            if state not in best or (cost, audit) < best[state][:2]:
                best[state] = (cost, audit, steps)

        state, cost, audit, steps = start, 0, "", ""
        for _ in range(3):      # no insert, one, two: three lead back to one
            offer(state, cost + DELETE, audit + "D", steps + "D-")
            if not gone:
                after, letter = _NEXT[state]
                offer(after, cost + REROLE + extra, audit + "R", steps + "R" + letter)
                if cls == 0 and state == NOTHING:
                    offer(SYSTEM, cost + extra, audit + "K", steps + "K-")
                elif (cls, after) in ((1, USER), (2, ASSISTANT)):
                    offer(after, cost + extra, audit + "K", steps + "K-")
            state, letter = _NEXT[state]
            cost, audit, steps = cost + INSERT, audit + "I", steps + "I" + letter
        out.append(best)
    return tuple(out)


def forward(items: list, start: int) -> dict[int, tuple[int, int]]:
    """{state: (least cost, rank of its least audit)} after ``items``; an item gives
    per state {state: (cost, key, ..)}, keys ordered like audits among those of one state."""
    vec = {start: (0, 0)}
    for item in items:
        best: dict[int, tuple] = {}
        for s, (cost, rank) in vec.items():
            for t, way in item[s].items():
                mine = (cost + way[0], rank, way[1])
                if t not in best or mine < best[t]:
                    best[t] = mine
        order = sorted(best, key=lambda t: best[t][1:])
        vec = {t: (best[t][0], i) for i, t in enumerate(order)}
    return vec


def backward(items: list, end: int) -> dict[int, int]:
    """{state: least cost from it through ``items`` to ``end``}."""
    vec = {end: 0}
    for item in reversed(items):
        vec = {s: min(c) for s in range(4) if (c := [way[0] + vec[t] for t, way in item[s].items() if t in vec])}
    return vec


def crossings(items: list, start: int, end: int | None = None) -> list[int]:
    """States before, between and after ``items`` on the cheapest path of least audit; without ``end``
    to where completing the pattern is cheapest."""
    n = len(items)
    states = [start] * (n + 1)
    if end is None:
        vec = forward(items, start)
        end = min(vec, key=lambda t: (vec[t][0] + _TAIL[t][0], vec[t][1]))
    states[n] = end
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        ahead, back = forward(items[lo:mid], states[lo]), backward(items[mid:hi], states[hi])
        states[mid] = min((s for s in ahead if s in back), key=lambda s: (ahead[s][0] + back[s], ahead[s][1]))
        todo += [(lo, mid), (mid, hi)]
    return states


def solve(codes, start: int = NOTHING, end: int | None = None) -> list[str]:
    """Steps of each row, as pairs of edit and role letter, ending at ``end`` or, without it, complete."""
    items = [moves(int(c)) for c in codes]
    states = crossings(items, start, end)
    steps = [item[s][t][2] for item, s, t in zip(items, states, states[1:])]
    if end is None and steps:
        steps[-1] += _TAIL[states[-1]][1]
    return steps


def _illegal(codes) -> int:
    return sum((int(a) & 3, int(b) & 3) not in _LEGAL for a, b in zip(codes, codes[1:]))


# ------------------------------------------------------------------- tasks --

def _segment(rows: pd.DataFrame) -> pd.DataFrame:
    """One segment: whole conversations solved, those at its borders summed up."""
    rows = rows.sort_values("pos", kind="stable")
    keys, codes, pos = rows["key"].to_numpy(), rows["code"].to_numpy(), rows["pos"].to_numpy()
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        run = codes[a:b]
        steps = costs = ranks = kept = None
        if a and b < len(keys):
            steps = solve(run)
        else:
            items = [moves(int(c)) for c in run]
            vecs = [forward(items, s) for s in range(4)]
            costs, ranks = ([v[t][i] if t in v else -1 for v in vecs for t in range(4)] for i in (0, 1))
            kept = run.tolist()
        out.append((keys[a], int(rows["seg"].iloc[0]), pos[a:b].tolist(), steps, kept, costs, ranks,
                    _illegal(run), int(run[0]) & 3, int(run[-1]) & 3))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _RUN.split(", ")])


def _borders(runs: pd.DataFrame) -> pd.DataFrame:
    """States at the borders of one conversation's segments, from their matrices."""
    runs = runs.sort_values("seg", kind="stable")
    items = [tuple({t: (int(c[4 * s + t]), int(r[4 * s + t])) for t in range(4) if c[4 * s + t] >= 0} for s in range(4))
             for c, r in zip(runs["costs"], runs["ranks"])]
    states = crossings(items, NOTHING)
    first, last = runs["first"].to_numpy(), runs["last"].to_numpy()
    between = sum((int(x), int(y)) not in _LEGAL for x, y in zip(last, first[1:]))
    n = len(runs)
    return pd.DataFrame({"bkey": runs["key"], "bseg": runs["seg"], "start": states[:-1], "end": states[1:],
                         "tail": [""] * (n - 1) + [_TAIL[states[-1]][1]], "between": [between] + [0] * (n - 1)})


def _between_borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for runs in batches:
        steps = [solve(c, int(s), int(e)) for c, s, e in zip(runs["codes"], runs["start"], runs["end"])]
        for mine, tail in zip(steps, runs["tail"]):
            mine[-1] += tail
        yield pd.DataFrame({"key": runs["key"], "positions": runs["positions"], "steps": steps})


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit and SHA-256 of conversations that arrive in order; of texts only the one at hand is held."""
    key, audit, sha, any_line = None, [], hashlib.sha256(), False
    for rows in batches:
        done = []
        for k, edit, line in zip(rows["key"], rows["edit"], rows["line"]):
            if k != key:
                if key is not None:
                    done.append((key, "".join(audit), sha.hexdigest()))
                key, audit, sha, any_line = k, [], hashlib.sha256(), False
            audit.append(edit)
            if edit != "D":
                sha.update((("\n" if any_line else "") + line).encode("utf-8"))
                any_line = True
        yield pd.DataFrame(done, columns=["dkey", "audit", "repaired_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, "".join(audit), sha.hexdigest())], columns=["dkey", "audit", "repaired_sha256"])


# --------------------------------------------------------------- operators --

def _key(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c.cast("string")))


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text with every twentieth turn each dropped, emptied, stripped of its
    ``[.!?]``, repeated or given to the user, by the CRC-32 of ``conv_id:turn``. Null roles and texts become
    one space, as null ids and turns do inside the hashed name; the columns keep their nulls."""
    space = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (conv_col, turn_col)])) % 20
    return (turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), space).alias("r"),
                         F.coalesce(F.col(text_col), space).alias("t"), kind.alias("k")).filter("k != 0")
                 .select("conv_id", "turn", F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("r")).alias("role"),
                         F.when(F.col("k") == 1, F.lit("")).when(F.col("k") == 2, F.regexp_replace("t", "[.!?]", "")).otherwise(F.col("t")).alias("text"),
                         F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy"))


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows with their place in the order of (conversation, turn, role, text's hash), and their faults."""
    digest = F.md5(F.col("text").cast("binary"))
    # equal rows are told apart by a number, so that no range of the sort is one row repeated
    src = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")) \
               .withColumns({"key": _key(F.col("conv_id")), "digest": digest, "tie": F.monotonically_increasing_id()})
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("tie")]
    rows = src.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    cls = F.element_at(F.create_map(F.lit("s"), F.lit(0), F.lit("u"), F.lit(1), F.lit("a"), F.lit(2)), F.substring("role", 1, 1))
    rows = materialise(rows.select("key", "conv_id", "turn", "role", "text", "digest", "pos", F.coalesce(cls, F.lit(3)).alias("cls"),
                                   (~F.col("text").rlike("[^\\x20\\x09-\\x0D]")).alias("blank"),
                                   (~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")).alias("open")), "conversation-rows")
    seen = rows.groupBy("key", "role", "digest").agg(F.min("pos").alias("first")).select("first")
    later = F.col("first").isNull()
    return rows.join(seen, F.col("pos") == F.col("first"), "left").select(
        "key", "conv_id", "turn", "role", "text", "pos", "cls", F.when(F.col("blank"), F.lit("blank")).when(later, F.lit("duplicate"))
        .when(F.col("open"), F.lit("truncated")).alias("fault"))


def _runs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edits of all rows, illegal neighbours): what ``repair`` and the report need."""
    code = F.col("cls") + F.when(F.col("fault").isin("blank", "duplicate"), 4).when(F.col("fault") == "truncated", 8).otherwise(0)
    narrow = rows.select("key", "pos", (F.col("pos") - F.col("pos") % SEGMENT).alias("seg"), code.cast("int").alias("code"))
    runs = materialise(narrow.groupBy("seg").applyInPandas(_segment, _RUN), "conversation-runs")
    cut = runs.filter("steps is null")
    borders = materialise(cut.select("key", "seg", "costs", "ranks", "first", "last").groupBy("key").applyInPandas(
        _borders, "bkey string, bseg long, start int, end int, tail string, between long"), "conversation-borders")
    rest = (cut.join(borders, (F.col("key") == F.col("bkey")) & (F.col("seg") == F.col("bseg")))
               .select("key", "positions", "codes", "start", "end", "tail").mapInPandas(_between_borders, EDITS))
    edits = runs.filter("steps is not null").select("key", "positions", "steps").unionByName(rest)
    illegal = (runs.select("key", "illegal").unionByName(borders.select(F.col("bkey").alias("key"), F.col("between").alias("illegal")))
                   .groupBy("key").agg(F.sum("illegal").alias("illegal")))
    return edits.select(F.explode(F.arrays_zip("positions", "steps")).alias("e")).select(
        F.col("e.positions").alias("at"), F.col("e.steps").alias("steps")), illegal


def _edits(rows: DataFrame, steps: DataFrame) -> DataFrame:
    pair = F.transform(F.sequence(F.lit(0), (F.length("steps") / 2 - 1).cast("int")), lambda i: F.struct(
        F.substr(F.col("steps"), i * 2 + 1, F.lit(1)).alias("edit"), F.substr(F.col("steps"), i * 2 + 2, F.lit(1)).alias("letter"), i.alias("step")))
    wide = rows.join(steps, F.col("pos") == F.col("at")).select("key", "conv_id", "turn", "role", "text", "pos", "fault", F.explode(pair).alias("p"))
    new = F.when(F.col("p.letter") == "u", F.lit("user")).otherwise(F.lit("assistant"))
    own = F.col("p.edit") != "I"
    return wide.select("key", "conv_id", "pos", F.col("p.step").alias("step"), F.col("p.edit").alias("edit"), F.when(own, F.col("turn")).alias("turn"),
                       F.when(F.col("p.letter") == "-", F.col("role")).otherwise(new).alias("role"),
                       F.when(own, F.col("text")).otherwise("").alias("text"), F.when(own, F.col("fault")).alias("fault"))


def repair(turns: DataFrame) -> DataFrame:
    """The edits of least cost: conv_id, pos, step, edit (K, R, D or I), turn, role, text, fault, one row
    each; by (pos, step) they read as the audit, and without D as the repaired conversation.

    ``turns`` has conv_id, turn, role and text; other columns aren't read. Rows are taken by turn, nulls first;
    equal turns by role, then by a hash of their text. Null ids are one conversation. Null
    roles and texts read as one space; a role counts by its first character. Repeated rows are duplicates.
    An empty table gives an empty table.
    """
    rows = materialise(_ordered(turns), "conversation-faults")
    return _edits(rows, _runs(rows)[0]).drop("key")


def report(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns``: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256; see ``repair`` for nulls, ties and repeats.

    Audit and hash are one value per conversation and so are written by one task, in a stream
    that holds the audit and one batch of rows.
    """
    rows = materialise(_ordered(turns), "conversation-faults")
    steps, illegal = _runs(rows)
    edits = materialise(_edits(rows, steps), "conversation-edits")
    count = {f: F.count(F.when(F.col("fault") == f, 1)) for f in ("blank", "duplicate", "truncated")}
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    facts = rows.groupBy("key").agg(F.min("conv_id").alias("conv_id"), gaps.cast("long").alias("gaps"), *[c.alias(f) for f, c in count.items()])
    price = (F.when(F.col("edit") == "D", DELETE).when(F.col("edit") == "R", REROLE).when(F.col("edit") == "I", INSERT).otherwise(0)
             + F.when((F.col("edit") != "D") & (F.col("fault") == "truncated"), TRUNCATED).otherwise(0))
    cost = edits.groupBy(F.col("key").alias("ckey")).agg(F.sum(price).alias("cost"))
    lines = (edits.select("key", "pos", "step", "edit", F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text")).alias("line"))
                  .repartition("key").sortWithinPartitions("key", "pos", "step").select("key", "edit", "line"))
    said = lines.mapInPandas(_digest, "dkey string, audit string, repaired_sha256 string")
    return (facts.join(illegal.withColumnRenamed("key", "ikey"), F.col("key") == F.col("ikey")).join(cost, F.col("key") == F.col("ckey"))
                 .join(said, F.col("key") == F.col("dkey"))
                 .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


def damaged_report(conversations: DataFrame) -> DataFrame:
    """``report`` of the damaged turns, for every conversation that there was before the damage: one
    that lost all its turns has zeros, an empty audit and the hash of nothing."""
    every = conversations.select(F.col("conv_id").alias("original")).distinct()
    found = report(damage(conversations))
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("original").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
