"""Repair of conversations against an exhaustive search, in whole and cut into tiny segments."""

import hashlib
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from plotwise.llm import conversations as cv
from plotwise.llm.conversation_sql import OP11_SQL
from plotwise.llm.queries import op11_conversations

WS = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        out.append("blank" if not text.strip(WS) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(WS)[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired) of one short conversation: all edits tried, up to two inserts in every gap."""
    best = None
    fault = faults(rows)

    def shape(roles):
        body = roles[1:] if roles[:1] == "s" else roles
        return not roles or (bool(body) and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))

    choices = []
    for (_, role, text), f in zip(rows, fault):
        extra = 3 if f == "truncated" else 0
        own = [(4, "D", None)]
        if f not in ("blank", "duplicate"):
            own += [(extra, "K", (role[:1], f"{role}:{text}"))] + [(3 + extra, "R", (r[:1], f"{r}:{text}")) for r in ("user", "assistant")]
        choices.append(own)
    gaps = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    for own in itertools.product(*choices):
        for new in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, lines, roles = 0, "", [], ""
            for i, g in enumerate(new):
                for r in g:
                    cost, audit, roles = cost + 3, audit + "I", roles + r[0]
                    lines.append(r + ":")
                if i < len(own):
                    c, e, line = own[i]
                    cost, audit = cost + c, audit + e
                    if line:
                        roles += line[0]
                        lines.append(line[1])
            if shape(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(lines))
    return best


def table(spark, convs):
    rows = [(c, t, r, x) for c, rs in convs.items() for t, r, x in rs]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("segment", [1024, 3])
def test_least_cost_and_audit(spark, monkeypatch, segment):
    monkeypatch.setattr(cv, "SEGMENT", segment)
    rng = random.Random(5)
    convs = {c: [(t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]), rng.choice(["a.", "b?", "open", "", "c!"]))
                 for t in range(rng.randint(1, 3))] for c in range(60)}
    got = {r["conv_id"]: r for r in cv.report(table(spark, convs)).collect()}
    for c, rows in convs.items():
        cost, audit, text = brute(rows)
        r = got[c]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows
        f = faults(rows)
        assert (r["blank"], r["duplicate"], r["truncated"]) == tuple(map(f.count, ("blank", "duplicate", "truncated")))
        assert r["illegal"] == sum(a[1][0] + b[1][0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))


def test_segments_agree(spark, monkeypatch):
    """One long conversation between short ones: cut anywhere, the same edits."""
    rng = random.Random(9)
    convs = {1: [(0, "user", "hi.")], 3: [(0, "assistant", "no")],
             2: [(t, rng.choice(["system", "user", "assistant", "x"]), f"{rng.randint(0, 200)}{rng.choice('.!x')}") for t in range(500)]}
    results = []
    for segment in (1024, 64, 7):
        monkeypatch.setattr(cv, "SEGMENT", segment)
        results.append(sorted(map(tuple, cv.report(table(spark, convs)).collect())))
    assert results[0] == results[1] == results[2]


def test_repair_reads_as_the_pattern(spark):
    src = table(spark, {7: [(2, "assistant", "late."), (1, "system", "rule."), (None, "user", None), (1, "system", "rule.")]})
    rows = cv.repair(src.withColumn("steps", F.lit(1)).withColumn("key", F.lit("x"))).orderBy("pos", "step").collect()
    assert "".join(r["edit"] for r in rows) == "DKDIK"
    assert [(r["role"], r["text"]) for r in rows if r["edit"] != "D"] == [("system", "rule."), ("user", ""), ("assistant", "late.")]
    assert [r["fault"] for r in rows] == ["blank", None, "duplicate", None, None]


def test_edges(spark):
    rows = [(None, None, None, None), (None, 5, "user", "null id."), (1, None, "user", " "), (1, 3, None, "no role."),
            (2, 0, "user", "x" * 50_000), (3, 1, "", "empty role."), (3, 1, "", "empty role.")]
    src = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("clash")).withColumn("fault", F.lit(0))
    got = {r["conv_id"]: r for r in cv.report(src).collect()}
    assert set(got) == {None, 1, 2, 3}
    assert got[None]["blank"] == 1 and got[None]["gaps"] == 0
    assert got[3]["duplicate"] == 1 and got[2]["truncated"] == 1 and got[1]["gaps"] == 0
    assert cv.report(src.filter("false")).count() == 0 and cv.damaged_report(src.filter("false")).count() == 0
    lost = spark.createDataFrame([(4, t, "user", "gone.") for t in range(400)], "conv_id long, turn long, role string, text string")
    dropped = lost.filter(F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))) % 20 == 0)
    assert dropped.count() > 0
    r = cv.damaged_report(dropped).first()
    assert r["audit"] == "" and r["cost"] == 0 and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    rel = duck.sql(OP11_SQL)
    got = op11_conversations(spark, sf).select(*rel.columns)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())
