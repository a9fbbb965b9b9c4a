"""Encoder and model runs on the snapshot view of the customers.

Training is iterative, so SQL cannot restate it; the encoder before it and the averaging, threshold and metric
steps after it are checked by SQL elsewhere, and ``*_checks`` hold what must be true of each trained model.
All models are trained with the reported settings, which are the library's defaults. A session trains each
model once for a folder and keeps it, but for the forest, whose trees are stored and not held.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.operators import encoding, features, metrics, models, sampling
from larkspur.operators.boosting import LeafwiseBoosting
from larkspur.operators.oversample import oversample
from larkspur.plans.churn import AGE_RANK_SQL, CHURN_DATE, CHURN_SQL, churn_view, hash_sql, snapshot_view
from larkspur.plans.registry import query
from larkspur.session import shared_folder

#: Fitted models by session, folder and name, with the encoder they need.
MODELS: dict[tuple[str, str, str], tuple[Transformer, Model]] = {}

PASSTHROUGH = [
    "credit_score",
    "age",
    "tenure",
    "balance",
    "products_number",
    "credit_card",
    "active_member",
    "estimated_salary",
    "product_mean_balance",
    "balance_to_salary",
]

NATIONS = [f"NATION_{i}" for i in range(25)]
AGES = ["30대", "30대이하", "40대", "50대", "60대이상"]
SLOTS = {
    **{f"onehot__country_{n}": f"CAST(country = '{n}' AS DOUBLE)" for n in NATIONS},
    **{f"onehot_age_rank__risk_age_rank_{a}": f"CAST(coalesce({AGE_RANK_SQL} = '{a}', false) AS DOUBLE)" for a in AGES},
    "ordinal_gender__gender": "CASE gender WHEN 'Male' THEN 0.0 ELSE 1.0 END::DOUBLE",
    **{f"remainder__{name}": f"round({name}::DOUBLE, 6)" for name in PASSTHROUGH[:8]},
    "remainder__product_mean_balance": "round(balance / nullif(products_number, 0), 6)",
    "remainder__balance_to_salary": "round(balance / nullif(estimated_salary, 0), 6)",
}


def _split_features(view):
    """Engineered features with their split, written once: fitting reads them many times."""
    shared_folder(view.sparkSession)
    return sampling.assign_split(features.create_features(view), "customer_id").checkpoint()


def _parts(spark, folder):
    rows = _split_features(snapshot_view(spark, folder))
    return [rows.where(F.col("split") == part) for part in ("train", "valid", "test")]


def _encoder(scaler=None):
    return encoding.feature_pipeline(PASSTHROUGH, scaler=scaler)


def _filled(rows):
    """Ratios without a value as 0, for models that can't take missing values."""
    return rows.na.fill(0.0)


def _prepared(spark, folder, weigh, scaler=None):
    """Encoded train, validation and test rows, ``features`` fitted on the training rows."""
    train, valid, test = map(_filled, _parts(spark, folder))
    fitted = _encoder(scaler).fit(train)
    return fitted.transform(weigh(train)), fitted.transform(valid), fitted.transform(test)


def _fitted(spark, folder, name: str, fit: Callable) -> tuple[Transformer, Model]:
    key = spark.sparkContext.applicationId, folder, name
    if key not in MODELS:
        MODELS[key] = fit(spark, folder)
    return MODELS[key]


def _boosted(estimator, weigh):
    """Encoder and model; boosted trees take ratios without a value as missing."""

    def fit(spark, folder):
        train = _parts(spark, folder)[0]
        encoder = _encoder().fit(train)
        return encoder, estimator.fit(encoder.transform(weigh(train)))

    return fit


def _oversampled(spark, folder):
    """The whole encoded matrix of the training rows, oversampled, with balanced weights, and its encoder."""
    train = _filled(_parts(spark, folder)[0])
    encoder = _encoder().fit(train)
    encoded = encoder.transform(train)
    names = [f"x{i}" for i in range(encoding.feature_count(encoded))]
    values = encoded.select("customer_id", "churn", vector_to_array("features").alias("x"))
    flat = values.select("customer_id", "churn", *[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(names)])
    balanced = sampling.add_balanced_weight(oversample(flat, names, "customer_id"))
    return encoder, VectorAssembler(inputCols=names, outputCol="features").transform(balanced).checkpoint()


def _on_oversampled(estimator):
    def fit(spark, folder):
        encoder, rows = _oversampled(spark, folder)
        return encoder, estimator.fit(rows)

    return fit


def _network(spark, folder):
    train = _filled(_parts(spark, folder)[0])
    encoder = _encoder("standard").fit(train)
    return encoder, models.neural_network().fit(encoder.transform(train))


def _models() -> dict[str, Callable]:
    return {
        "deep_boosting": _boosted(models.deep_boosting(), _deep_weight),
        "shallow_boosting": _boosted(models.shallow_boosting(), _shallow_weight),
        "wide_boosting": _on_oversampled(models.wide_boosting()),
        "random_forest": _on_oversampled(models.random_forest()),
        "neural_network": _network,
    }


#: Models that take missing values as such.
BOOSTED = ("deep_boosting", "shallow_boosting")


def _model(spark, folder, name):
    fit = _models()[name]
    return fit(spark, folder) if name == "random_forest" else _fitted(spark, folder, name, fit)


def _scores(spark, folder, name, part, fitted=None, parts=None):
    """Score table of the validation (1) or test (2) rows."""
    encoder, model = fitted or _model(spark, folder, name)
    rows = (parts or _parts(spark, folder))[part]
    return models.score_table(model, encoder.transform(rows if name in BOOSTED else _filled(rows)), name)


def _unweighted(rows):
    return rows


def _deep_weight(rows):
    return sampling.add_positive_weight(rows, models.DEEP_POSITIVE_WEIGHT)


def _shallow_weight(rows):
    return sampling.add_positive_weight(rows, models.SHALLOW_POSITIVE_WEIGHT)


def _rounded(scores):
    return scores.withColumn("score", F.round("score", 6))


@query(
    "encoded_features",
    CHURN_SQL
    + f", held AS (SELECT * FROM churn_view WHERE {hash_sql('customer_id')} % 16 < 4)"
    + " UNION ALL ".join(
        f"SELECT customer_id, '{name}' AS feature, {value} AS value FROM held"
        for name, value in SLOTS.items()
    ),
)
def encoded_features(spark, folder):
    """Encoder fitted on training rows and applied to test rows, one row per feature slot."""
    rows = _split_features(churn_view(spark, folder))
    fitted = _encoder().fit(rows.where(F.col("split") == "train"))
    encoded = fitted.transform(rows.where(F.col("split") == "test"))
    names = encoding.feature_names(fitted, encoded)
    slots = F.posexplode(vector_to_array("features")).alias("slot", "value")
    named = F.get(F.array(*[F.lit(n) for n in names]), F.col("slot"))
    value = F.when(F.isnan("value"), F.lit(None)).otherwise(F.round("value", 6))
    return encoded.select("customer_id", slots).select(
        "customer_id", named.alias("feature"), value.alias("value")
    )


@query("logistic_regression_scores")
def logistic_regression_scores(spark, folder):
    """Balanced logistic regression, validation scores."""
    train, valid, _ = _prepared(spark, folder, sampling.add_balanced_weight)
    model = models.logistic_regression(models.total_weight(train)).fit(train)
    return _rounded(models.score_table(model, valid, "logistic"))


@query("final_logistic_predictions")
def final_logistic_predictions(spark, folder):
    """Unweighted logistic regression with weaker penalty, test labels."""
    train, _, test = _prepared(spark, folder, _unweighted)
    weight = models.total_weight(train, None)
    model = models.logistic_regression(weight, c=0.1, weight=None, tol=1e-4).fit(train)
    return models.predictions(model, test)


@query("deep_boosting_scores")
def deep_boosting_scores(spark, folder):
    """120 rounds of trees with 34 leaves, validation scores."""
    return _rounded(_scores(spark, folder, "deep_boosting", 1))


@query("shallow_boosting_scores")
def shallow_boosting_scores(spark, folder):
    """700 rounds of trees of depth 4 with penalised leaves, validation scores."""
    return _rounded(_scores(spark, folder, "shallow_boosting", 1))


@query("oversampled_boosting_scores")
def oversampled_boosting_scores(spark, folder):
    """300 rounds of trees with 100 leaves on the oversampled encoded matrix, validation scores."""
    return _rounded(_scores(spark, folder, "wide_boosting", 1))


@query("random_forest_scores")
def random_forest_scores(spark, folder):
    """1,000 full trees on the oversampled encoded matrix, validation scores."""
    return _rounded(_scores(spark, folder, "random_forest", 1))


@query("decision_tree_scores")
def decision_tree_scores(spark, folder):
    train, valid, _ = _prepared(spark, folder, _unweighted)
    model = models.decision_tree().fit(train)
    return _rounded(models.score_table(model, valid, "decision_tree"))


@query("neural_network_scores")
def neural_network_scores(spark, folder):
    """1,000 epochs on scaled features, validation scores."""
    return _rounded(_scores(spark, folder, "neural_network", 1))


@query("out_of_fold_scores")
def out_of_fold_scores(spark, folder):
    """Five folds over the training rows; every row is scored once, by the fold it was kept from."""
    train, _, _ = _parts(spark, folder)
    rows = sampling.assign_fold(_deep_weight(train), "customer_id")
    scores = models.out_of_fold_scores(rows, _encoder(), models.fold_boosting(), sampling.FOLDS, "folds")
    return features.add_prediction(_rounded(scores), models.FOLD_THRESHOLD)


def _members(spark, folder, part):
    """Score tables of the two boosted models on the validation (1) or test (2) rows; they are fitted side by side."""
    with ThreadPoolExecutor(len(BOOSTED)) as pool:
        fitted = list(pool.map(inheritable_thread_target(spark)(lambda name: _model(spark, folder, name)), BOOSTED))
    parts = _parts(spark, folder)
    return [_scores(spark, folder, name, part, each, parts) for name, each in zip(BOOSTED, fitted, strict=True)]


def _ensemble(spark, folder, part):
    """Soft vote of the two boosted models on the validation (1) or test (2) rows."""
    deep, shallow = _members(spark, folder, part)
    return models.soft_vote_scores(deep.unionByName(shallow))


@query("ensemble_thresholds")
def ensemble_thresholds(spark, folder):
    """Threshold comparison of the soft vote on the validation rows."""
    table = metrics.threshold_table(_ensemble(spark, folder, 1))
    return table.withColumns({name: F.round(name, 4) for name in metrics.RATES})


@query("ensemble_summary")
def ensemble_summary(spark, folder):
    """Summary of the soft vote on the test rows at the tuned threshold."""
    return metrics.summary_report(_ensemble(spark, folder, 2), models.ENSEMBLE_THRESHOLD)


LABEL_SQL = f"""WITH labels AS (SELECT c_custkey, coalesce(max(o_orderdate) < TIMESTAMP '{CHURN_DATE}', true) AS churned,
        CASE WHEN {hash_sql('c_custkey')} % 16 < 4 THEN 'test' WHEN {hash_sql('c_custkey')} % 16 < 7 THEN 'valid' ELSE 'train' END AS split
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)"""


def _check_sql(held_out: str) -> str:
    return (
        LABEL_SQL
        + f""" SELECT count(*) FILTER (split = 'train') AS fitted_rows, count(*) FILTER (split = 'train' AND churned) AS fitted_positives,
    count(*) FILTER (split = '{held_out}') AS scored_rows, count(*) FILTER (split = '{held_out}' AND churned) AS scored_positives,
    true AS in_range, true AS unbiased FROM labels"""
    )


def _checks(model, train, scored, weight=None, tolerance=1e-3):
    """Row and label counts, whether scores lie in 0 to 1, and whether residuals cancel in training.

    Logistic regression with a free intercept and unpruned trees both fit the weighted share of the
    positive class exactly, wherever their fit has converged.
    """
    weights = F.col(weight) if weight else F.lit(1.0)
    fitted = model.transform(train).select("churn", vector_to_array("probability")[1].alias("p"), weights.alias("w"))
    residual = F.abs(F.sum(F.col("w") * (F.col("p") - F.col("churn")))) / F.sum("w")
    left = fitted.agg(F.count("*").alias("fitted_rows"), F.sum("churn").alias("fitted_positives"), (residual < tolerance).alias("unbiased"))
    scores = models.score_table(model, scored, "checked")
    right = scores.agg(
        F.count("*").alias("scored_rows"), F.sum("label").alias("scored_positives"), F.min(F.col("score").between(0, 1)).alias("in_range")
    )
    one = F.lit(1).alias("one")
    return left.select(one, "*").join(right.select(one, "*"), "one").drop("one")


@query("logistic_regression_checks", _check_sql("valid"))
def logistic_regression_checks(spark, folder):
    train, valid, _ = _prepared(spark, folder, sampling.add_balanced_weight)
    model = models.logistic_regression(models.total_weight(train)).fit(train)
    return _checks(model, train, valid, "weight")


@query("decision_tree_checks", _check_sql("test"))
def decision_tree_checks(spark, folder):
    train, _, test = _prepared(spark, folder, _unweighted)
    return _checks(models.decision_tree().fit(train), train, test)


@query(
    "final_logistic_checks",
    LABEL_SQL + " SELECT count(*) AS \"rows\", count(*) FILTER (churned) AS positives, count(*) AS agreeing FROM labels WHERE split = 'test'",
)
def final_logistic_checks(spark, folder):
    """The hard labels of the final model against its scores at one half."""
    train, _, test = _prepared(spark, folder, _unweighted)
    model = models.logistic_regression(models.total_weight(train, None), c=0.1, weight=None, tol=1e-4).fit(train)
    both = models.predictions(model, test).join(models.score_table(model, test, "final").select("row_id", "score"), "row_id")
    agrees = F.col("pred") == (F.col("score") > 0.5).cast("int")
    return both.agg(F.count("*").alias("rows"), F.sum("label").cast("long").alias("positives"), F.count_if(agrees).alias("agreeing"))


def _trained_sql(part: str, **facts: str) -> str:
    """What must be true of a trained model: its rows by SQL, ``facts`` as stated."""
    rest = "".join(f", {value} AS {name}" for name, value in facts.items())
    return LABEL_SQL + f" SELECT count(*) AS scored_rows, count(*) FILTER (churned) AS scored_positives, true AS in_range{rest} FROM labels WHERE split = '{part}'"


def _trained(scores, **facts):
    return scores.agg(
        F.count("*").alias("scored_rows"),
        F.sum("label").cast("long").alias("scored_positives"),
        F.min(F.col("score").between(0, 1)).alias("in_range"),
        *[(value if isinstance(value, Column) else F.lit(value)).alias(name) for name, value in facts.items()],
    )


def _boosted_checks(spark, folder, name, weigh):
    """Limits of the trees, falling loss, the first tree's leaf weights against sums of its rows, and whether trees
    grown pass by pass are those that one task grows."""
    encoder, model = _model(spark, folder, name)
    settings, share = model.settings, 1 / (1 + 2.718281828459045 ** -model.base)
    rows = encoder.transform(weigh(_parts(spark, folder)[0]))
    passes = LeafwiseBoosting(replace(settings, rounds=3), weight="weight", one_task_cells=0).fit(rows)
    sums = rows.groupBy(model.leaf(0).alias("leaf")).agg(
        F.sum(F.col("weight") * (share - F.col("churn"))).alias("g"), F.sum(F.col("weight") * share * (1 - share)).alias("h")
    )
    shrunk = F.signum("g") * F.greatest(F.abs("g") - settings.l1, F.lit(0.0))
    weight = F.get(F.array(*[F.lit(v) for v in model.trees[0].value]), F.col("leaf").cast("int"))
    off = sums.agg(F.max(F.abs(weight + settings.rate * shrunk / (F.col("h") + settings.l2))).alias("off")).first()["off"]
    return _trained(
        _scores(spark, folder, name, 1),
        rounds=len(model.trees),
        within_limits=all(t.leaves <= settings.leaves and t.depth <= settings.depth for t in model.trees),
        loss_falls=all(b < a for a, b in zip(model.losses, model.losses[1:])),
        leaf_weights=off < 1e-6,
        same_by_passes=passes.trees == model.trees[:3],
    )


BOOSTING_FACTS = {"within_limits": "true", "loss_falls": "true", "leaf_weights": "true", "same_by_passes": "true"}


@query("deep_boosting_checks", _trained_sql("valid", rounds="120", **BOOSTING_FACTS))
def deep_boosting_checks(spark, folder):
    return _boosted_checks(spark, folder, "deep_boosting", _deep_weight)


@query("shallow_boosting_checks", _trained_sql("valid", rounds="700", **BOOSTING_FACTS))
def shallow_boosting_checks(spark, folder):
    return _boosted_checks(spark, folder, "shallow_boosting", _shallow_weight)


@query("random_forest_checks", _trained_sql("valid", trees="1000"))
def random_forest_checks(spark, folder):
    fitted = _model(spark, folder, "random_forest")
    return _trained(_scores(spark, folder, "random_forest", 1, fitted), trees=fitted[1].getNumTrees)


@query("neural_network_checks", _trained_sql("valid", epochs="1000", loss_fell="true"))
def neural_network_checks(spark, folder):
    losses = _model(spark, folder, "neural_network")[1].losses
    return _trained(_scores(spark, folder, "neural_network", 1), epochs=len(losses), loss_fell=losses[-1] < losses[0])


@query("ensemble_checks", _trained_sql("test", means="count(*)"))
def ensemble_checks(spark, folder):
    """The soft vote against the mean of its two members."""
    members = _members(spark, folder, 2)
    deep, shallow = (scores.select("row_id", F.col("score").alias(name)) for name, scores in zip(BOOSTED, members, strict=True))
    both = models.soft_vote_scores(members[0].unionByName(members[1])).join(deep, "row_id").join(shallow, "row_id")
    mean = (F.col(BOOSTED[0]) + F.col(BOOSTED[1])) / 2
    return _trained(both, means=F.count_if(F.abs(F.col("score") - mean) < 1e-12))
