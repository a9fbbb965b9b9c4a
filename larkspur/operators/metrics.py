"""Binary-classification metrics over ``(label, score)`` or ``(label, pred)`` rows.

Counts aggregate map-side. Curves are built on distinct scores with range-wise running totals, so
neither many rows nor many equal scores end in one task. ``by`` names grouping columns, e.g. a model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.numeric import ratio_or_zero
from larkspur.operators.ordered import running_totals, with_ranges

# The compared thresholds and the goals they are judged by.
THRESHOLDS = (0.50, 0.47)
RECALL_GOAL = 0.7
PRECISION_GOAL = 0.5

RATES = ("accuracy", "precision", "recall", "f1")


def _cells(label: Column, pred: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((label == 1) & (pred == 1)),
        "fp": F.count_if((label == 0) & (pred == 1)),
        "fn": F.count_if((label == 1) & (pred == 0)),
        "tn": F.count_if((label == 0) & (pred == 0)),
    }


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio_or_zero(tp + tn, tp + fp + fn + tn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def confusion_counts(
    rows: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()
) -> DataFrame:
    """One row (per group): ``tp, fp, fn, tn``."""
    cells = _cells(F.col(label), F.col(pred))
    return rows.groupBy(*by).agg(*[cell.alias(name) for name, cell in cells.items()])


def confusion_matrix(rows: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Long form ``label, pred, n`` with all four cells, empty ones as 0."""
    cells = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    listed = F.array(
        *[
            F.struct(F.lit(a).alias("label"), F.lit(p).alias("pred"), F.col(c).alias("n"))
            for c, a, p in cells
        ]
    )
    return confusion_counts(rows, label, pred).select(F.inline(listed))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1; a rate with an empty denominator is 0."""
    return counts.withColumns(_rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def classification_rates(
    rows: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()
) -> DataFrame:
    return with_rates(confusion_counts(rows, label, pred, by)).select(*by, *RATES)


def _cumulative(
    scores: DataFrame, label: str, score: str, by: Sequence[str]
) -> DataFrame:
    """Per distinct score: positives, negatives, their running totals from the top, group totals."""
    counts = scores.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    running = running_totals(
        with_ranges(counts, "threshold"), ["threshold"], ["pos", "neg"], by=by, descending=True
    ).withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})
    totals = {
        "all_pos": F.count_if(F.col(label) == 1),
        "all_neg": F.count_if(F.col(label) == 0),
    }
    if by:
        whole = scores.groupBy(*by).agg(*[c.alias(n) for n, c in totals.items()])
        return running.join(whole, list(by))
    whole = scores.agg(F.struct(*[c.alias(n) for n, c in totals.items()]).alias("w")).scalar()
    return running.withColumn("w", whole).select("*", "w.all_pos", "w.all_neg").drop("w")


def roc_curve(
    scores: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """``threshold, fpr, tpr`` for every distinct score, plus the start (0, 0) with NULL threshold."""
    points = _cumulative(scores, label, score, by).select(
        *by,
        "threshold",
        F.try_divide(F.col("fp"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    start = scores.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def precision_recall_curve(
    scores: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """``threshold, precision, recall`` for every distinct score, plus the closing point (1, 0)."""
    points = _cumulative(scores, label, score, by).select(
        *by,
        "threshold",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("all_pos")).alias("recall"),
    )
    close = scores.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(close)


def ranking_quality(
    scores: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """One row (per group): exact ``roc_auc`` (ties count half) and ``average_precision``.

    A distinct score adds a trapezoid whose left height is its running total without itself, so
    no look at the row before is needed.
    """
    height = (F.col("tp") - F.col("pos") / 2) * F.col("neg")
    gain = F.col("pos") * F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    area = F.sum(height.cast("double"))
    positives = F.max("all_pos")
    return (
        _cumulative(scores, label, score, by)
        .groupBy(*by)
        .agg(
            F.try_divide(area, positives.cast("double") * F.max("all_neg")).alias("roc_auc"),
            F.try_divide(F.sum(gain), positives.cast("double")).alias("average_precision"),
        )
    )


def threshold_table(
    scores: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    label: str = "label",
    score: str = "score",
) -> DataFrame:
    """The four rates at every threshold, from one pass: all cells are counted side by side."""
    counted = {}
    for i, t in enumerate(thresholds):
        reached = (F.col(score) >= t).cast("int")
        for name, cell in _cells(F.col(label), reached).items():
            counted[f"{name}{i}"] = cell
    row = scores.agg(*[cell.alias(name) for name, cell in counted.items()])
    entries = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            *[F.col(f"{c}{i}").alias(c) for c in ("tp", "fp", "fn", "tn")],
        )
        for i, t in enumerate(thresholds)
    ]
    return with_rates(row.select(F.inline(F.array(*entries)))).select("threshold", *RATES)


def thresholds_meeting(
    table: DataFrame, recall: float = RECALL_GOAL, precision: float = PRECISION_GOAL
) -> DataFrame:
    return table.where((F.col("recall") >= recall) & (F.col("precision") >= precision))


def summary_report(
    scores: DataFrame, threshold: float, label: str = "label", score: str = "score", digits: int = 4
) -> DataFrame:
    """``metric, value`` rows: ranking and rates at one threshold, rounded."""
    rates = threshold_table(scores, [threshold], label, score)
    auc = ranking_quality(scores, label, score).select("roc_auc").scalar()
    names = ("roc_auc", *RATES)
    entries = [
        F.struct(F.lit(n).alias("metric"), F.round(F.col(n), digits).alias("value")) for n in names
    ]
    return rates.withColumn("roc_auc", auc).select(F.inline(F.array(*entries)))


def compare_models(
    scores: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score"
) -> DataFrame:
    """All metrics for every ``model`` of a long score table."""
    labelled = scores.withColumn("pred", (F.col(score) >= threshold).cast("int"))
    rates = classification_rates(labelled, label, "pred", by=["model"])
    return rates.join(ranking_quality(scores, label, score, by=["model"]), "model")


def mean_score(scores: DataFrame, key: str = "row_id", score: str = "score") -> DataFrame:
    """Soft vote: the mean score per row over the models of a long score table."""
    return scores.groupBy(key).agg(F.avg(score).alias(score))


def soft_vote(
    left: DataFrame, right: DataFrame, key: str = "row_id", score: str = "score"
) -> DataFrame:
    """Mean of two models' scores aligned by row key."""
    other = right.select(key, F.col(score).alias("__other"))
    return left.join(other, key).withColumn(score, (F.col(score) + F.col("__other")) / 2).drop("__other")
