import math
from collections import Counter

import pytest

from larkspur.llm import mixing


def test_sources_reach_their_weights(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 100 = 1 THEN 'rare' ELSE 'rest' END AS source", "'t' AS text")
    rows = mixing.mix_sources(docs, {"hot": 1, "rare": 1, "rest": 2, "none": 5 * 0}).collect()
    counts = Counter(r["source"] for r in rows)
    for source, share in (("hot", 0.25), ("rare", 0.25), ("rest", 0.5)):
        assert abs(counts[source] - share * 30_000) < 6 * math.sqrt(share * 30_000)
    per_doc = Counter(r["doc_id"] for r in rows if r["source"] == "rest")
    rate = 0.5 * 30_000 / docs.where("source = 'rest'").count()
    total = docs.where("source = 'rest'").count()
    for k, expected in ((0, math.exp(-rate)), (1, rate * math.exp(-rate)), (2, rate**2 / 2 * math.exp(-rate))):
        seen = sum(v == k for v in per_doc.values()) if k else total - len(per_doc)
        assert abs(seen - expected * total) < 6 * math.sqrt(expected * total)
    assert {tuple(r) for r in rows} == {tuple(r) for r in mixing.mix_sources(docs.repartition(5), {"hot": 1, "rare": 1, "rest": 2}).collect()}


def test_large_rates_and_copies_are_numbered(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(5)], "doc_id long, source string")
    rows = mixing.mix_sources(docs, total=10_000).collect()
    assert abs(len(rows) - 10_000) < 600
    for i in range(5):
        copies = sorted(r["copy"] for r in rows if r["doc_id"] == i)
        assert copies == list(range(1, len(copies) + 1))


def test_odd_rows(documents, spark):
    docs = documents(["a", "a", None, ""], ids=[1, 1, None, 2], source=[None, None, "s", "s"])
    rows = mixing.mix_sources(docs, total=400).collect()
    assert {r["source"] for r in rows} == {None, "s"} and rows[0].asDict().keys() >= set(docs.columns)
    assert mixing.mix_sources(documents([])).count() == 0
    assert mixing.mix_sources(docs, {"other": 1.0}).count() == 0
    assert mixing.mix_sources(docs, {}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"s": -1})
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, copy="text")


def test_many_sources_are_joined_by_shuffling(documents, monkeypatch):
    docs = documents([str(i) for i in range(50)], source=[f"s{i % 9}" for i in range(50)])
    few = sorted(map(tuple, mixing.mix_sources(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert sorted(map(tuple, mixing.mix_sources(docs).collect())) == few


def test_plan_has_no_python(documents):
    plan = mixing.mix_sources(documents(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_very_large_rates_take_linear_time(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(4)], "doc_id long, source string")
    rows = mixing.mix_sources(docs, total=400_000)
    counts = {r["doc_id"]: (r["n"], r["most"], r["kinds"]) for r in rows.groupBy("doc_id").agg({"*": "count"}).withColumnRenamed("count(1)", "n").join(
        rows.groupBy("doc_id").agg(mixing.F.max("copy").alias("most"), mixing.F.count_distinct("copy").alias("kinds")), "doc_id").collect()}
    assert len(counts) == 4 and len({n for n, _, _ in counts.values()}) > 1
    for n, most, kinds in counts.values():
        assert n == most == kinds and abs(n - 100_000) < 6 * math.sqrt(100_000)
