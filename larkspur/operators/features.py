"""Customer features: dropped and projected columns, ratios, age ranks, cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.binning import interval_label, interval_ordinal
from larkspur.functions.numeric import safe_ratio, threshold_label

# Age cut points and their labels; tenure cut points and their labels.
AGE_CUTS = [0, 30, 40, 50, 60, 100]
AGE_LABELS = ["30대이하", "30대", "40대", "50대", "60대이상"]
TENURE_CUTS = list(range(0, 11))
TENURE_LABELS = [f"{year}년" for year in range(1, 11)]


def split_target(
    customers: DataFrame, target: str = "churn", key: str = "customer_id"
) -> tuple[DataFrame, DataFrame]:
    """Features without key and target, and the target alone."""
    return customers.drop(key, target), customers.select(target)


def cohort(customers: DataFrame, value: int, target: str = "churn") -> DataFrame:
    return customers.where(F.col(target) == value)


def add_ratios(customers: DataFrame) -> DataFrame:
    """Balance per product and balance per salary; NULL where the divisor is zero."""
    return customers.withColumns(
        {
            "product_mean_balance": safe_ratio(F.col("balance"), F.col("products_number")),
            "balance_to_salary": safe_ratio(F.col("balance"), F.col("estimated_salary")),
        }
    )


def add_age_rank(
    customers: DataFrame, cuts: Sequence[float] = AGE_CUTS, labels: Sequence[str] = AGE_LABELS
) -> DataFrame:
    """Age interval as label ``risk_age_rank`` and 0-based ``risk_age_ordinal``."""
    age = F.col("age")
    return customers.withColumns(
        {
            "risk_age_rank": interval_label(age, cuts, labels, include_lowest=True),
            "risk_age_ordinal": interval_ordinal(age, cuts, include_lowest=True),
        }
    )


def add_tenure_band(customers: DataFrame) -> DataFrame:
    """Tenure year label; tenure 0 is below the lowest interval and gets NULL."""
    return customers.withColumn(
        "tenure_band", interval_label(F.col("tenure"), TENURE_CUTS, TENURE_LABELS)
    )


def create_features(customers: DataFrame) -> DataFrame:
    """The three engineered features together."""
    return customers.transform(add_ratios).transform(add_age_rank)


def add_prediction(scores: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    return scores.withColumn("pred", threshold_label(F.col(score), threshold))
