"""Classifiers as spark.ml estimators with the reported settings as defaults.

Scores come back as long tables ``row_id, label, model, score``, which the metric operators and
the averaging operators take as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.boosting import LeafwiseBoosting, Settings
from larkspur.operators.forest import Forest
from larkspur.operators.network import AdamNetwork
from larkspur.session import shared_folder

SEED = 42

# Fixed thresholds: plain, the tuned one of the ensemble, and that of the fold average.
ENSEMBLE_THRESHOLD = 0.47
FOLD_THRESHOLD = 0.4

# Positive-class weights of the two boosted models.
DEEP_POSITIVE_WEIGHT = 5.0
SHALLOW_POSITIVE_WEIGHT = 4.0

# Deepest tree spark.ml grows.
MAX_DEPTH = 30


def logistic_regression(
    total_weight: float,
    c: float = 0.02,
    label: str = "churn",
    weight: str | None = "weight",
    max_iter: int = 100,
    tol: float = 1e-5,
) -> Estimator:
    """Logistic regression with inverse strength ``c`` on a summed loss.

    spark.ml averages the loss over ``total_weight``, hence the penalty ``1 / (c * total_weight)``.
    """
    estimator = LogisticRegression(
        labelCol=label,
        regParam=1.0 / (c * total_weight),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )
    return estimator if weight is None else estimator.setWeightCol(weight)


def total_weight(train: DataFrame, weight: str | None = "weight") -> float:
    value = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return float(train.agg(value.alias("w")).first()["w"])


def deep_boosting(label: str = "churn", weight: str | None = "weight", rounds: int = 120, depth: int | None = 8, leaves: int = 34, **more) -> Estimator:
    """Boosted deep trees with few leaves, each on four fifths of the features."""
    settings = {"rate": 0.01, "column_share": 0.8, "least_rows": 20, "seed": SEED, **more}
    return LeafwiseBoosting(Settings(rounds, leaves, depth, **settings), label, weight)


def fold_boosting(label: str = "churn", weight: str | None = "weight", rounds: int = 140, depth: int | None = 10, leaves: int = 52, **more) -> Estimator:
    """The boosted model of the cross-validation runs."""
    return deep_boosting(label, weight, rounds, depth, leaves, **{"column_share": 1.0, **more})


def wide_boosting(label: str = "churn", weight: str | None = "weight", rounds: int = 300, depth: int | None = None, leaves: int = 100, **more) -> Estimator:
    """The boosted model of the oversampled rows: many leaves, no limit of depth."""
    return deep_boosting(label, weight, rounds, depth, leaves, **{"column_share": 1.0, **more})


def shallow_boosting(label: str = "churn", weight: str | None = "weight", rounds: int = 700, depth: int = 4, **more) -> Estimator:
    """Many boosted shallow trees with penalised leaf weights."""
    settings = {"rate": 0.01, "l1": 0.1, "l2": 1.0, "least_hessian": 1.0, "seed": SEED, **more}
    return LeafwiseBoosting(Settings(rounds, 2**depth, depth, **settings), label, weight)


def random_forest(
    label: str = "churn",
    weight: str | None = "weight",
    trees: int = 1000,
    depth: int = MAX_DEPTH,
    **params,
) -> Estimator:
    """Random forest of full trees; a split needs two rows, as one row per leaf implies."""
    if depth > MAX_DEPTH:
        raise ValueError(f"trees grow to depth {MAX_DEPTH} at most, as in spark.ml, not {depth}")
    return Forest(trees, depth, label, weight, **{"seed": SEED, **params})


def decision_tree(label: str = "churn", depth: int = MAX_DEPTH, **params) -> Estimator:
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth, **{"seed": SEED, **params})


def neural_network(label: str = "churn", hidden: Sequence[int] = (64, 32), epochs: int = 1000, rate: float = 0.01, **more) -> Estimator:
    """Feed-forward net with two hidden ReLU layers, trained by Adam; feed it scaled features."""
    return AdamNetwork(hidden, epochs, rate, label, **{"seed": SEED, **more})


def score_table(
    model: Model, rows: DataFrame, name: str, key: str = "customer_id", label: str = "churn"
) -> DataFrame:
    """Class-1 probabilities as ``row_id, label, model, score``."""
    probability = vector_to_array(F.col("probability"))[1]
    return model.transform(rows).select(
        F.col(key).alias("row_id"),
        F.col(label).alias("label"),
        F.lit(name).alias("model"),
        probability.alias("score"),
    )


def predictions(
    model: Model, rows: DataFrame, key: str = "customer_id", label: str = "churn"
) -> DataFrame:
    """Hard labels as ``row_id, label, pred``, decided by the model's own threshold."""
    return model.transform(rows).select(
        F.col(key).alias("row_id"),
        F.col(label).alias("label"),
        F.col("prediction").cast("int").alias("pred"),
    )


def soft_vote_scores(scores: DataFrame, name: str = "ensemble") -> DataFrame:
    """Mean score per row over the models of a long score table, under a new model name."""
    labels = scores.groupBy("row_id").agg(F.max("label").alias("label"), F.avg("score").alias("score"))
    return labels.select("row_id", "label", F.lit(name).alias("model"), "score")


def out_of_fold_scores(
    rows: DataFrame,
    encoder: Pipeline,
    estimator: Estimator,
    folds: int,
    name: str,
    key: str = "customer_id",
    label: str = "churn",
) -> DataFrame:
    """Every row scored by the model of the fold that did not see it, exactly once.

    ``rows`` carry ``fold``. Encoder and model are fitted per fold, on the other folds; folds are fitted side by
    side, as their passes leave cores idle.
    """
    shared_folder(rows.sparkSession)
    rows = rows.checkpoint()

    def scored(fold: int) -> DataFrame:
        train, held_out = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        fitted = Pipeline(stages=[encoder, estimator]).fit(train)
        return score_table(fitted, held_out, name, key, label)

    with ThreadPoolExecutor(folds) as pool:
        parts = list(pool.map(inheritable_thread_target(rows.sparkSession)(scored), range(folds)))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
