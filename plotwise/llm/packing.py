"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. Pieces are packed in decreasing order:
each goes into the open bin with the least room that still takes it; when none
does, a bin is opened at the length whose cost per token that the rest of the
group can still fill is least; at the end every bin shrinks to the smallest
permitted length that holds its contents.

Pieces are dealt into groups of bounded expected size and each group is
packed by one task; a group wastes at most part of its last bins. Only ids and
sizes travel, never texts.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import materialise, text_of, word_count

CAPACITIES = (256, 512, 1024, 2048, 4096)
#: Cost of a sequence of n tokens: n * (1 + n / ATTENTION); attention grows with the square.
ATTENTION = 16384
GROUP_ROWS = 20_000


def sequence_cost(n: int) -> float:
    return n * (1.0 + n / ATTENTION)


def pack_sizes(sizes, capacities=CAPACITIES) -> tuple[list[int], list[int], dict[int, int]]:
    """Bin and offset of each size (each in 1 .. max capacity), and the final
    capacity of each bin. Equal sizes keep their order."""
    caps = sorted(capacities)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    # tokens in pieces of at most s, to judge how much of a new bin the rest can fill
    small = np.zeros(caps[-1] + 1)
    for s in sizes:
        small[s] += s
    small = np.cumsum(small)
    packed = 0
    rooms: list[int] = []                       # distinct rooms left, ascending
    by_room: dict[int, list[int]] = {}          # room -> open bins, latest last
    used: list[int] = []
    where, at = [0] * len(sizes), [0] * len(sizes)
    rest_total = float(small[-1])
    for i in order:
        s = sizes[i]
        k = bisect_left(rooms, s)
        if k < len(rooms):
            room = rooms[k]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(k)
        else:
            left = rest_total - packed - s      # what is not packed yet, this piece aside
            best = None
            for c in caps:
                if c >= s:
                    fill = s + min(c - s, left, max(0.0, float(small[min(c - s, s)])))
                    score = sequence_cost(c) / fill
                    if best is None or score < best[0]:
                        best = (score, c)
            b, room = len(used), best[1]
            used.append(0)
        where[i], at[i] = b, used[b]
        used[b] += s
        packed += s
        room -= s
        if room:
            if room not in by_room:
                insort(rooms, room)
                by_room[room] = []
            by_room[room].append(b)
    return where, at, {b: caps[bisect_left(caps, u)] for b, u in enumerate(used)}


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None,
           longest: int = CAPACITIES[-1]) -> DataFrame:
    """doc_id, piece, start, size: documents longer than ``longest`` are cut into
    pieces of that length and a rest; a document of size 0 is one piece of size 0."""
    n = word_count(text_of(text_col)) if size_col is None else F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    return (docs.select(F.col(id_col).alias("_id"), n.alias("_n"))
                .withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_n") / longest) - 1, F.lit(0)).cast("int"))))
                .withColumn("start", F.col("piece").cast("long") * longest)
                .select(F.col("_id").alias(id_col), "piece", "start",
                        F.least(F.col("_n") - F.col("start"), F.lit(longest)).cast("int").alias("size")))


def best_fit_pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None,
                  capacities=CAPACITIES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: id, piece, start and size (words), bin_id, bin_offset,
    capacity, bin_used.

    Every piece of every row is packed exactly once; repeated rows are packed
    as often as they occur. Rows without words (null or empty text) come back
    with size 0, a null bin and capacity 0. Null ids are kept. Extra columns
    are not read. An empty table gives an empty table.
    """
    caps = sorted(capacities)
    # dealt by the row's place in the written table: equal ids spread, and a rerun of a task sees the same rows
    p = materialise(pieces(docs, id_col, text_col, size_col, caps[-1]), "pack-pieces")
    groups = max(1, math.ceil(p.filter("size > 0").count() / group_rows))
    dealt = p.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_g", F.pmod(F.xxhash64("_at"), F.lit(groups)))
    id_type = p.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, piece int, start long, size int, bin_id string, bin_offset int, "
              "capacity int, bin_used int")

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at", kind="stable").reset_index(drop=True)
        where, at, cap = pack_sizes(pdf["size"].tolist(), caps)
        pdf["bin_id"] = [f"{key[0]}-{b}" for b in where]
        pdf["bin_offset"] = np.asarray(at, dtype="int32")
        pdf["capacity"] = np.asarray([cap[b] for b in where], dtype="int32")
        pdf["bin_used"] = pdf.groupby("bin_id")["size"].transform("sum").astype("int32")
        return pdf[[id_col, "piece", "start", "size", "bin_id", "bin_offset", "capacity", "bin_used"]]

    packed = dealt.filter("size > 0").groupBy("_g").applyInPandas(pack, schema)
    empty = dealt.filter("size = 0").select(
        id_col, "piece", "start", "size", F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("int").alias("bin_offset"),
        F.lit(0).alias("capacity"), F.lit(0).alias("bin_used"))
    return packed.unionByName(empty)
