"""The pipeline against a plain retelling of its stages."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from plotwise.llm.common import documents
from plotwise.llm.toxicity import fit, score
from tests.conftest import SF
from tests.llm.test_methods import brute_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = [], documents(spark, SF)
    for k, (_, f) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        f(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return [documents(spark, SF), *out]


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "near dedup", "mixing", "packing"]
    for s in stages[1:5]:
        assert s.columns == stages[0].columns


def test_toxic_documents_go(spark, stages):
    m = fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r["doc_id"] for r in score(stages[0], m).filter("predicted = 1").collect()}
    assert set(texts(stages[1])) == set(texts(stages[0])) - bad


def test_repeated_lines_go(stages):
    before, after = texts(stages[1]), texts(stages[2])
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(low)
    held = {}
    for i in sorted(before):
        for x in before[i].split("\n"):
            held.setdefault(key(x), set()).add(i)
    for i, t in before.items():
        want = [x for x in t.split("\n") if len(key(x)) < 10 or min(held[key(x)]) == i]
        assert after[i] == "\n".join(want)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    before = texts(stages[2])
    want = {c for _, c in brute_components(before).values()}
    assert set(texts(stages[3])) == want


def test_mix_and_pack(stages):
    copies = Counter(r["doc_id"] for r in stages[4].collect())
    assert max(copies.values()) <= 2 and set(copies) <= set(texts(stages[3]))
    packed = Counter()
    for r in stages[5].collect():
        packed[r["doc_id"]] += r["size"]
    for i, t in texts(stages[4]).items():
        assert packed[i] == copies[i] * len(WORD.findall(t))


def test_hostile_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, extra columns and empty tables pass through all stages."""
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, "a text without id, " * 20, "en", "a", 5), (3, "line one is long\nline two is long", "en", "b", 33),
            (3, "line one is long\nline two is long", "en", "b", 33), (4, "w " * 9000, "en", "b", 18000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit("x")).withColumn("key", F.lit("y"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs, full in ((df, True), (df.filter("false"), False)):
        for name, f in cp.STAGES:
            nxt = f(spark, docs, str(tmp_path))
            if name != "packing":
                assert nxt.columns == df.columns
            docs = nxt
        assert (docs.count() > 0) == full
