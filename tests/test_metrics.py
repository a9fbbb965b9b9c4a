import pytest
from pyspark.sql import functions as F

from larkspur.operators import metrics

# Published rates and the only confusion counts (tp, fp, fn, tn) that round to them.
GOLDEN = [
    ((285, 247, 101, 1242), (0.8144, 0.5357, 0.7383, 0.6209)),
    ((300, 298, 86, 1191), (0.7952, 0.5017, 0.7772, 0.6098)),
    ((383, 385, 114, 1618), (0.8004, 0.4987, 0.7706, 0.6055)),
    ((295, 292, 91, 1197), (0.7957, 0.5026, 0.7642, 0.6064)),
    ((320, 372, 66, 1117), (0.7664, 0.4624, 0.8290, 0.5937)),
    ((44, 53, 453, 1950), (0.7976, None, 0.0885, 0.1481)),
]

TIED = [(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.8), (0, 0.8), (1, 0.9)]


@pytest.fixture(scope="module")
def tied(spark):
    return spark.createDataFrame(TIED, "label int, score double")


@pytest.mark.parametrize("counts,published", GOLDEN)
def test_published_rates_follow_from_their_counts(spark, counts, published):
    cells = zip(((1, 1), (0, 1), (1, 0), (0, 0)), counts)
    expanded = [(label, pred) for (label, pred), n in cells for _ in range(n)]
    df = spark.createDataFrame(expanded, "label int, pred int")
    assert tuple(metrics.confusion_counts(df).first()) == counts
    found = metrics.classification_rates(df).first()
    for name, value in zip(metrics.RATES, published):
        if value is not None:
            assert round(found[name], 4) == value


def test_no_predicted_positive_gives_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, pred int")
    found = metrics.classification_rates(df).first()
    assert (found["precision"], found["recall"], found["f1"], found["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_confusion_matrix_lists_all_cells(spark, collect):
    df = spark.createDataFrame([(1, 1), (1, 1)], "label int, pred int")
    assert collect(metrics.confusion_matrix(df)) == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 2)]


def test_auc_counts_ties_half(tied):
    wins = sum(
        1.0 if p > n else 0.5 if p == n else 0.0
        for y, p in TIED if y == 1 for z, n in TIED if z == 0
    )
    assert metrics.ranking_quality(tied).first()["roc_auc"] == pytest.approx(wins / 9)
    assert wins / 9 == pytest.approx(0.777778, abs=1e-6)


def test_average_precision(tied):
    # Thresholds .9, .8, .4: precision 1, 2/3, 3/5 at recall 1/3, 2/3, 1.
    expected = (1 + 2 / 3 + 3 / 5) / 3
    assert metrics.ranking_quality(tied).first()["average_precision"] == pytest.approx(expected)


def test_roc_points(tied):
    found = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(tied).collect())
    expected = [(0, 0), (0, 1 / 3), (1 / 3, 2 / 3), (2 / 3, 1), (1, 1)]
    assert [x for p in found for x in p] == pytest.approx([x for p in expected for x in p])


def test_precision_recall_curve_closes(tied):
    found = metrics.precision_recall_curve(tied).where("threshold IS NULL").first()
    assert (found["precision"], found["recall"]) == (1.0, 0.0)


def test_auc_over_many_ranges_equals_pair_counting(spark):
    df = spark.range(400).select(
        (F.col("id") % 3 == 0).cast("int").alias("label"),
        (F.col("id") * 37 % 101 / 101.0).alias("score"),
    )
    rows = df.collect()
    positives = [r["score"] for r in rows if r["label"] == 1]
    negatives = [r["score"] for r in rows if r["label"] == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    expected = wins / (len(positives) * len(negatives))
    assert metrics.ranking_quality(df).first()["roc_auc"] == pytest.approx(expected)


def test_groups_do_not_mix(spark, tied):
    flipped = tied.withColumn("score", 1 - F.col("score")).withColumn("model", F.lit("b"))
    both = tied.withColumn("model", F.lit("a")).unionByName(flipped)
    found = {r["model"]: r["roc_auc"] for r in metrics.compare_models(both).collect()}
    assert found["a"] == pytest.approx(0.777778, abs=1e-6)
    assert found["b"] == pytest.approx(1 - 0.777778, abs=1e-6)


def test_threshold_table_and_goals(tied):
    table = metrics.threshold_table(tied, [0.5, 0.4])
    found = {r["threshold"]: (r["precision"], r["recall"]) for r in table.collect()}
    assert found[0.5] == pytest.approx((2 / 3, 2 / 3)) and found[0.4] == pytest.approx((3 / 5, 1.0))
    assert [r["threshold"] for r in metrics.thresholds_meeting(table).collect()] == [0.4]


def test_summary_report(tied):
    found = dict(map(tuple, metrics.summary_report(tied, 0.5).collect()))
    assert found["roc_auc"] == 0.7778 and found["recall"] == 0.6667


def test_soft_vote_needs_no_order(spark, collect):
    left = spark.createDataFrame([(1, 0.2), (2, 0.8)], "row_id int, score double")
    right = spark.createDataFrame([(2, 0.4), (1, 0.6)], "row_id int, score double")
    expected = [(1, 0.4), (2, pytest.approx(0.6))]
    assert collect(metrics.soft_vote(left, right)) == expected
    assert collect(metrics.mean_score(left.unionByName(right))) == expected
