"""Metric queries. Labels come from ``labels``; scores are scaled lengths from ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import features, metrics, pairing
from larkspur.plans.registry import query
from larkspur.sources.tables import table

# Two score columns in [0, 1): longer texts score higher, and a coarse one with many ties.
LENGTH_SCORE = "n_chars / (n_chars + 500.0::DOUBLE)"
COARSE_SCORE = "n_chars // 100 / (n_chars // 100 + 5.0::DOUBLE)"

SCORES_SQL = f"""
WITH scores AS (
    SELECT l.doc_id AS row_id, quality AS label, {LENGTH_SCORE} AS score,
           {COARSE_SCORE} AS coarse
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id
), pred AS (SELECT *, CAST(score >= 0.47 AS INTEGER) AS p FROM scores),
cells AS (SELECT count(*) FILTER (label = 1 AND p = 1) AS tp, count(*) FILTER (label = 0 AND p = 1) AS fp,
    count(*) FILTER (label = 1 AND p = 0) AS fn, count(*) FILTER (label = 0 AND p = 0) AS tn FROM pred)
"""


def _length_scores(spark, folder):
    chars = F.col("n_chars").cast("double")
    hundreds = F.floor(F.col("n_chars") / 100).cast("double")
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"),
        (chars / (chars + 500.0)).alias("score"),
        (hundreds / (hundreds + 5.0)).alias("coarse"),
    )


def _labels(spark, folder):
    return table(spark, folder, "labels").select(
        F.col("doc_id").alias("row_id"), F.col("quality").alias("label")
    )


def label_scores(spark, folder):
    """``row_id, label, score, coarse``: labels and scores aligned by key."""
    return pairing.pair_by_key(_labels(spark, folder), _length_scores(spark, folder), "row_id")


def _model_scores(spark, folder):
    """Long ``row_id, label, model, score`` over two scorers, from one read of the rows."""
    models = F.array(
        F.struct(F.lit("length").alias("model"), F.col("score")),
        F.struct(F.lit("coarse").alias("model"), F.col("coarse").alias("score")),
    )
    return label_scores(spark, folder).select("row_id", "label", F.inline(models))


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "paired_labels_scores",
    SCORES_SQL + "SELECT row_id, label, round(score, 6) AS score FROM scores",
)
def paired_labels_scores(spark, folder):
    return _rounded(label_scores(spark, folder), "score").drop("coarse")


@query(
    "pairing_report",
    """SELECT (SELECT count(*) FROM labels) AS left_rows, (SELECT count(*) FROM documents) AS right_rows,
    (SELECT count(*) FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)) AS matched_keys,
    (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS left_only,
    (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS right_only,
    (SELECT count(*) FROM (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1 UNION
        SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)) AS repeated_keys""",
)
def pairing_report(spark, folder):
    return pairing.pairing_report(_labels(spark, folder), _length_scores(spark, folder), "row_id")


@query(
    "threshold_predictions",
    SCORES_SQL + "SELECT row_id, label, p AS pred FROM pred",
)
def threshold_predictions(spark, folder):
    return features.add_prediction(label_scores(spark, folder), 0.47).select(
        "row_id", "label", "pred"
    )


@query(
    "soft_vote_pair",
    SCORES_SQL + "SELECT row_id, round((score + coarse) / 2, 6) AS score FROM scores",
)
def soft_vote_pair(spark, folder):
    scores = _length_scores(spark, folder)
    labels = _labels(spark, folder).select("row_id")
    fine = labels.join(scores.select("row_id", "score"), "row_id")
    coarse = scores.select("row_id", F.col("coarse").alias("score"))
    return _rounded(metrics.soft_vote(fine, coarse), "score")


@query(
    "mean_model_score",
    SCORES_SQL + "SELECT row_id, round((score + coarse) / 2, 6) AS score FROM scores",
)
def mean_model_score(spark, folder):
    return _rounded(metrics.mean_score(_model_scores(spark, folder)), "score")


@query(
    "confusion_matrix",
    SCORES_SQL
    + """SELECT CAST(a AS INTEGER) AS label, CAST(b AS INTEGER) AS pred, count(row_id) AS n
    FROM range(2) x(a) CROSS JOIN range(2) y(b) LEFT JOIN pred ON label = a AND p = b GROUP BY a, b""",
)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(features.add_prediction(label_scores(spark, folder), 0.47))


RATES_SQL = """round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
    round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"""


@query("classification_rates", SCORES_SQL + f"SELECT {RATES_SQL} FROM cells")
def classification_rates(spark, folder):
    rows = features.add_prediction(label_scores(spark, folder), 0.47)
    return _rounded(metrics.classification_rates(rows), *metrics.RATES)


CURVE_SQL = """, points AS (
    SELECT {s} AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY {s}
), run AS (
    SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
           sum(neg) OVER (ORDER BY threshold DESC) AS fp,
           sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg FROM points
)"""


@query(
    "roc_curve",
    SCORES_SQL
    + CURVE_SQL.format(s="score")
    + """SELECT round(threshold, 6) AS threshold, round(fp / all_neg, 6) AS fpr,
    round(tp / all_pos, 6) AS tpr FROM run UNION ALL SELECT NULL, 0.0, 0.0""",
)
def roc_curve(spark, folder):
    curve = metrics.roc_curve(label_scores(spark, folder))
    return _rounded(curve, "threshold", "fpr", "tpr")


@query(
    "precision_recall_curve",
    SCORES_SQL
    + CURVE_SQL.format(s="coarse")
    + """SELECT round(threshold, 6) AS threshold, round(tp / (tp + fp), 6) AS precision,
    round(tp / all_pos, 6) AS recall FROM run UNION ALL SELECT NULL, 1.0, 0.0""",
)
def precision_recall_curve(spark, folder):
    curve = metrics.precision_recall_curve(label_scores(spark, folder), score="coarse")
    return _rounded(curve, "threshold", "precision", "recall")


@query(
    "roc_auc",
    SCORES_SQL
    + """SELECT round(sum(CASE WHEN a.coarse > b.coarse THEN 1.0 WHEN a.coarse = b.coarse THEN 0.5
    ELSE 0.0 END) / count(*), 6)::DOUBLE AS roc_auc FROM scores a, scores b
    WHERE a.label = 1 AND b.label = 0""",
)
def roc_auc(spark, folder):
    quality = metrics.ranking_quality(label_scores(spark, folder), score="coarse")
    return _rounded(quality.select("roc_auc"), "roc_auc")


@query(
    "average_precision",
    SCORES_SQL
    + CURVE_SQL.format(s="coarse")
    + """SELECT round(sum(pos / all_pos * (tp / (tp + fp))), 6) AS average_precision FROM run""",
)
def average_precision(spark, folder):
    quality = metrics.ranking_quality(label_scores(spark, folder), score="coarse")
    return _rounded(quality.select("average_precision"), "average_precision")


THRESHOLD_SQL = (
    SCORES_SQL
    + """, t AS (SELECT unnest([0.5, 0.47])::DOUBLE AS threshold),
    per AS (SELECT threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp,
        count(*) FILTER (label = 0 AND score >= threshold) AS fp,
        count(*) FILTER (label = 1 AND score < threshold) AS fn,
        count(*) FILTER (label = 0 AND score < threshold) AS tn FROM scores, t GROUP BY threshold),
    rated AS (SELECT threshold, """
    + RATES_SQL
    + " FROM per)"
)


@query("threshold_table", THRESHOLD_SQL + "SELECT * FROM rated")
def threshold_table(spark, folder):
    return _rounded(metrics.threshold_table(label_scores(spark, folder)), *metrics.RATES)


@query(
    "thresholds_meeting_goals",
    THRESHOLD_SQL + "SELECT * FROM rated WHERE recall >= 0.7 AND precision >= 0.5",
)
def thresholds_meeting_goals(spark, folder):
    found = metrics.thresholds_meeting(metrics.threshold_table(label_scores(spark, folder)))
    return _rounded(found, *metrics.RATES)


@query(
    "summary_report",
    SCORES_SQL
    + CURVE_SQL.format(s="score")
    + f""", auc AS (SELECT sum((tp - pos / 2) * neg) / (max(all_pos) * max(all_neg)) AS roc_auc FROM run),
    rated AS (SELECT {RATES_SQL} FROM cells)
    SELECT 'roc_auc' AS metric, round(roc_auc, 4) AS value FROM auc
    UNION ALL SELECT 'accuracy', round(accuracy, 4) FROM rated
    UNION ALL SELECT 'precision', round(precision, 4) FROM rated
    UNION ALL SELECT 'recall', round(recall, 4) FROM rated
    UNION ALL SELECT 'f1', round(f1, 4) FROM rated""",
)
def summary_report(spark, folder):
    return metrics.summary_report(label_scores(spark, folder), 0.47)


def _model_sql(name: str, column: str) -> str:
    return f"""SELECT '{name}' AS model, {RATES_SQL},
    round((SELECT sum(CASE WHEN a.{column} > b.{column} THEN 1.0 WHEN a.{column} = b.{column} THEN 0.5
        ELSE 0.0 END) / count(*) FROM scores a, scores b WHERE a.label = 1 AND b.label = 0), 6)::DOUBLE
        AS roc_auc,
    (SELECT round(sum(pos / all_pos * (tp / (tp + fp))), 6) FROM (
        SELECT pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS all_pos
        FROM (SELECT {column} AS t, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY 1)
        WINDOW w AS (ORDER BY t DESC))) AS average_precision
    FROM (SELECT count(*) FILTER (label = 1 AND {column} >= 0.5) AS tp,
        count(*) FILTER (label = 0 AND {column} >= 0.5) AS fp,
        count(*) FILTER (label = 1 AND {column} < 0.5) AS fn,
        count(*) FILTER (label = 0 AND {column} < 0.5) AS tn FROM scores)"""


@query(
    "model_comparison",
    SCORES_SQL + _model_sql("length", "score") + " UNION ALL " + _model_sql("coarse", "coarse"),
)
def model_comparison(spark, folder):
    table_ = metrics.compare_models(_model_scores(spark, folder))
    return _rounded(table_, *metrics.RATES, "roc_auc", "average_precision")
