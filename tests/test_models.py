import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from larkspur.operators import encoding, metrics, models, sampling

N = 400


@pytest.fixture(scope="module")
def customers(spark):
    """Separable up to noise: old customers with low balance leave."""
    key = F.col("id")
    age = (20 + key * 7 % 50).cast("int")
    balance = (key * 13 % 100).cast("double")
    df = spark.range(N).select(
        key.alias("customer_id"),
        age.alias("age"),
        balance.alias("balance"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (key % 3 + 1).cast("int")).alias("country"),
        ((age > 45) & (balance < 60)).cast("int").alias("churn"),
    )
    return sampling.assign_fold(sampling.add_balanced_weight(df), "customer_id").persist()


def encoder(scaler=None):
    return encoding.feature_pipeline(["age", "balance"], {"country": "onehot"}, scaler=scaler)


def auc(scores):
    assert scores.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    return metrics.ranking_quality(scores).first()["roc_auc"]


CASES = {
    "deep": lambda: models.deep_boosting(rounds=5, depth=4),
    "fold": lambda: models.fold_boosting(rounds=3, depth=4),
    "shallow": lambda: models.shallow_boosting(rounds=5),
    "wide": lambda: models.wide_boosting(rounds=5),
    "forest": lambda: models.random_forest(trees=10, depth=8),
    "tree": lambda: models.decision_tree(depth=8),
    "logistic": lambda: models.logistic_regression(N),
    "net": lambda: models.neural_network(epochs=60),
}


@pytest.mark.parametrize("name", CASES)
def test_models_separate(customers, name):
    scaler = "standard" if name == "net" else None
    fitted = Pipeline(stages=[encoder(scaler), CASES[name]()]).fit(customers)
    scores = models.score_table(fitted, customers, name)
    assert scores.count() == N and auc(scores) > 0.75
    assert set(r[0] for r in models.predictions(fitted, customers).select("pred").distinct().collect()) <= {0, 1}


def test_penalty_follows_total_weight(customers):
    total = models.total_weight(customers)
    assert total == pytest.approx(N)
    assert models.logistic_regression(total, c=0.02).getRegParam() == pytest.approx(1 / (0.02 * N))
    assert models.total_weight(customers, None) == N


def test_reported_settings_are_the_defaults(spark):
    deep, shallow, wide, fold = (m.settings for m in (models.deep_boosting(), models.shallow_boosting(), models.wide_boosting(), models.fold_boosting()))
    assert (deep.rounds, deep.depth, deep.leaves, deep.rate, deep.column_share) == (120, 8, 34, 0.01, 0.8)
    assert (shallow.rounds, shallow.depth, shallow.leaves, shallow.l1, shallow.l2) == (700, 4, 16, 0.1, 1.0)
    assert (wide.rounds, wide.depth, wide.leaves, fold.rounds, fold.depth, fold.leaves) == (300, None, 100, 140, 10, 52)
    with pytest.raises(ValueError):
        models.random_forest(depth=40)
    assert models.random_forest().getNumTrees() == 1000
    net = models.neural_network()
    assert (net.hidden, net.epochs, net.rate) == ((64, 32), 1000, 0.01)


def test_every_row_gets_one_out_of_fold_score(customers):
    scores = models.out_of_fold_scores(customers, encoder(), models.decision_tree(depth=5), 5, "oof")
    assert scores.count() == N and scores.select("row_id").distinct().count() == N
    assert auc(scores) > 0.75


def test_soft_vote_is_the_mean(spark):
    rows = [(1, 1, "a", 0.2), (1, 1, "b", 0.6), (2, 0, "a", 0.1), (2, 0, "b", 0.1)]
    scores = spark.createDataFrame(rows, "row_id long, label int, model string, score double")
    found = {r["row_id"]: (r["label"], r["score"]) for r in models.soft_vote_scores(scores).collect()}
    assert found == {1: (1, pytest.approx(0.4)), 2: (0, pytest.approx(0.1))}
