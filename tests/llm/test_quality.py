import random

from pyspark.sql import functions as F

from larkspur.llm import quality
from tests.llm.brute import word_counts

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_equal_brute_force(documents):
    random.seed(2)
    texts = [None, "", " \t\x0b\x0c\r\n", "a", "a b", "a b c", "a a a a", "x y z x y z", "l1\nl1\n \n \nl1", "é# ü|<> b", "w " * 20_000]
    texts += [" ".join(random.choice("abcdef#\n") for _ in range(random.randint(0, 60))) for _ in range(200)]
    found = quality.word_statistics(documents(texts).withColumnRenamed("lang", "n_words")).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in found} == {i: word_counts(t) for i, t in enumerate(texts)}
    assert quality.word_statistics(documents([])).count() == 0


def make(documents, spark, n=300):
    good = ["some plain words go here " * 4 + f"and{i} more{i * 7} of{i * 3} them " * 8 for i in range(n)]
    bad = ["odd### words%%% " + " ".join(f"w{i}x{k}##" for k in range(60)) for i in range(n)]
    texts = [t for pair in zip(good, bad, strict=True) for t in pair]
    labels = spark.createDataFrame([(i, (i + 1) % 2, 0) for i in range(2 * n)] + [(0, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    return quality.word_statistics(documents(texts)), labels


def test_rules_are_learned_and_kept_apart(documents, spark):
    statistics, labels = make(documents, spark)
    rules = quality.learn_rules(statistics, labels)
    assert rules
    judged = quality.judge(statistics, rules).withColumn("bad", F.col("doc_id") % 2 == 1)
    assert judged.where("bad").where("rule = 0").count() == 0
    assert judged.where("NOT bad").where("rule > 0").count() == 0
    assert rules == quality.learn_rules(statistics.repartition(7), labels.repartition(3))


def test_no_labels_no_rules(documents, spark):
    statistics, labels = make(documents, spark, 10)
    assert quality.learn_rules(statistics, labels.limit(0)) == []
    assert quality.learn_rules(statistics, labels.where("quality = 1")) == []
    assert quality.judge(statistics, []).where("kept = base_failed").count() == 0


def test_plan_has_no_python(documents, spark):
    statistics, labels = make(documents, spark, 5)
    plan = quality.judge(statistics, quality.learn_rules(statistics, labels))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
