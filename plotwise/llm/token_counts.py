"""Exact token counts of a byte-level BPE at every prefix of a text.

Inside one pre-token a dynamic programme walks its bytes: the encoding of the
first i bytes is the encoding of the first j bytes plus one token ending at i, for
the only token whose pair with the last token before it is left alone by the
merges. So ``last[i]`` and ``count[i]`` of every prefix follow from shorter ones, and
no prefix is encoded again. A text's table is the running sum of its
pre-tokens' counts; the total is its last entry, and counts at a cut inside a pre-token and the
longest prefix within a budget come from it and the prefix counts of the pre-token in question.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import text_of

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Pre-tokens whose counts a worker remembers; the memory is emptied when full.
MEMORY = 400_000
#: Pre-tokens longer than this many characters are not remembered.
LONGEST_REMEMBERED = 64


def _byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in the vocabulary file: printable ones
    stand for themselves, the rest follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class PrefixCounter:
    """Token counts of all prefixes under one vocabulary file."""

    def __init__(self, path: str | None = None):
        with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        model = spec["model"]
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        skip = set(self.specials)
        self.ids = {as_bytes(t): i for t, i in model["vocab"].items() if t not in skip}
        self.longest = max(map(len, self.ids))
        self.merges: dict[tuple[int, int], int] = {}        # pair -> rank
        self.rank_of, self.halves = dict.fromkeys(self.ids.values(), -1), {}
        for rank, m in enumerate(model["merges"]):
            a, b = map(as_bytes, m.split(" ") if isinstance(m, str) else m)
            pair, made = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.merges[pair] = rank
            self.rank_of[made], self.halves[made] = rank, pair
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self._pairs: dict[tuple[int, int], bool] = {}
        self._seen: dict[str, int] = {}

    def _stand(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens side by side. Their making is undone from
        the latest merge back; if the two pieces at the border could merge before the merge
        undone last (or at the same rank, further left), the tokens would not have come about."""
        rank_of, halves, merges, key = self.rank_of, self.halves, self.merges, (left, right)
        limit = 1 << 30
        while merges.get((left, right), limit) >= limit:
            a, b = rank_of[left], rank_of[right]
            if a < 0 and b < 0:
                self._pairs[key] = True
                return True
            if a > b:
                limit, left = a, halves[left][1]
            else:
                limit, right = b + 1, halves[right][0]
        self._pairs[key] = False
        return False

    def prefix_counts(self, b: bytes) -> list[int]:
        """Tokens of the first 0, 1, .. len(b) bytes of one pre-token."""
        n, ids, longest, pairs, stand = len(b), self.ids, self.longest, self._pairs, self._stand
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            for j in range(i - longest if i > longest else 0, i):
                t = ids.get(b[j:i])
                if t is not None:
                    known = pairs.get((last[j], t)) if j else True      # a token that begins the text is its own encoding
                    if known or (known is None and stand(last[j], t)):
                        last[i], count[i] = t, count[j] + 1
                        break
        return count

    def _count(self, token: str) -> int:
        c = self.prefix_counts(token.encode("utf-8"))[-1]
        if len(token) <= LONGEST_REMEMBERED:
            if len(self._seen) >= MEMORY:
                self._seen.clear()
            self._seen[token] = c
        return c

    def parts(self, text: str) -> tuple[list[str], list[int]]:
        """Pre-tokens of the whole text, special strings among them, and the tokens of each."""
        if self.cut is None or not any(s in text for s in self.specials):
            parts = self.pattern.findall(text)
        else:
            parts = [p for i, s in enumerate(self.cut.split(text)) for p in ([s] if i % 2 else self.pattern.findall(s))]
        seen, one = self._seen.get, self._count
        special = set(self.specials)
        counts = [seen(p) or (1 if p in special else one(p)) for p in parts]
        return parts, counts

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """End (in characters) of every pre-token and the tokens up to it; both start with 0."""
        parts, counts = self.parts(text)
        return [0, *accumulate(map(len, parts))], [0, *accumulate(counts)]

    def total(self, text: str) -> int:
        """Last entry of the table."""
        return sum(self.parts(text)[1])

    def inside(self, text: str, table: tuple[list[int], list[int]], i: int) -> list[int]:
        """Exact tokens of the prefixes of ``text`` that end 1, 2, .. characters into pre-token ``i``, the whole of it included.
        The prefix may split otherwise than the whole text does: white space at its end is one
        pre-token, and a special string or contraction that it cuts is plain text."""
        ends, sums = table
        start, end = ends[i], ends[i + 1]
        piece = text[start:end]
        run = i                                             # first pre-token of the white space that ends here or before this one
        while run and text[ends[run - 1]:ends[run]].isspace():
            run -= 1
        if piece.isspace():
            return self._char_counts(text[ends[run]:end], sums[run])[start - ends[run]:]
        if piece in self.specials:
            if run:
                run -= 1                                    # its start may join what stands before it
            while run and text[ends[run - 1]:ends[run]].isspace():
                run -= 1
            return [*(sums[run] + self.total(text[ends[run]:k]) for k in range(start + 1, end)), sums[i + 1]]
        if piece[0] == "'" and piece[1:].isalpha():
            return [*(sums[i] + self.total(text[start:k]) for k in range(start + 1, end)), sums[i + 1]]
        counts = self._char_counts(piece, sums[i])
        if piece[0].isspace() and run < i:
            counts[0] = self._char_counts(text[ends[run]:start + 1], sums[run])[-1]
        return counts

    def _char_counts(self, piece: str, before: int) -> list[int]:
        """``before`` and the tokens of the first 1, 2, .. characters of one pre-token."""
        counts = self.prefix_counts(piece.encode("utf-8"))
        return [before + counts[at] for at in accumulate(len(c.encode("utf-8")) for c in piece)]

    def count_at(self, text: str, table: tuple[list[int], list[int]], chars: int) -> int:
        """Exact tokens of the first ``chars`` characters."""
        ends, sums = table
        if chars <= 0 or chars >= ends[-1]:
            return sums[0 if chars <= 0 else -1]
        i = bisect_left(ends, chars) - 1
        return self.inside(text, table, i)[chars - ends[i] - 1]

    def fit(self, text: str, table: tuple[list[int], list[int]], budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens, which may end inside a pre-token."""
        ends, sums = table
        if sums[-1] <= budget:
            return ends[-1]
        last = max(bisect_right(sums, budget) - 1, 0)
        # white space, and what a special string is cut from, may take fewer tokens with the next pre-token's start
        while last + 2 < len(ends) and (text[ends[last]:ends[last + 1]].isspace() or text[ends[last + 1]:ends[last + 2]] in self.specials):
            last += 1
        for i in range(last, -1, -1):
            counts = self.inside(text, table, i)
            for k in range(len(counts) - 1, -1, -1):
                if counts[k] <= budget:
                    return ends[i] + k + 1
        return 0


_COUNTERS: dict[str | None, PrefixCounter] = {}


def counter(path: str | None = None) -> PrefixCounter:
    """The worker's counter for a vocabulary file, loaded once a process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
                 path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit.

    Null text counts as empty, with 0 bytes and 0 tokens. Repeated rows and null ids are kept. Extra
    columns are not read. An empty table gives an empty table.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([own.total(t.as_py()) for t in b.column(2)], pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), text_of(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
               .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def prefix_tables(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """id, ends, counts: the table of each text, for later truncation and budget
    questions (``truncate`` answers one). Null text is empty: [0], [0]."""
    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for b in batches:
            made = [own.table(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m[0] for m in made], pa.list_(pa.int32())),
                                              pa.array([m[1] for m in made], pa.list_(pa.int32()))], names=["id", "ends", "counts"])

    src = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(tables, f"id {kind}, ends array<int>, counts array<int>").withColumnRenamed("id", id_col)


def truncate(docs: DataFrame, tables: DataFrame, budget: int, id_col: str = "doc_id", text_col: str = "text",
             path: str | None = None) -> DataFrame:
    """``docs`` with each text cut to its longest prefix of at most ``budget`` tokens: the tables
    name the pre-token that crosses the budget, only that one is counted again, at each of its characters."""
    @F.arrow_udf("int")
    def cut(texts: pa.Array, ends: pa.Array, counts: pa.Array) -> pa.Array:
        own = counter(path)
        return pa.array([own.fit(t.as_py(), (e.as_py(), c.as_py()), budget)
                         for t, e, c in zip(texts, ends, counts, strict=True)], pa.int32())

    t = tables.select(F.col(id_col).alias("_tid"), F.col("ends").alias("_ends"), F.col("counts").alias("_counts"))
    return (docs.join(t, F.col(id_col).eqNullSafe(F.col("_tid")))
                .withColumn(text_col, F.substring(text_of(text_col), F.lit(1), cut(text_of(text_col), "_ends", "_counts")))
                .select(*docs.columns))
