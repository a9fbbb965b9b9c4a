"""Row alignment by key, repeat marking, head."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Align two tables on a row key (labels with scores, scores with scores)."""
    return left.join(right, key)


def pairing_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: rows on both sides, matched rows and rows without a partner.

    Sides are tagged and counted per key, so repeated keys show up instead of multiplying rows.
    """
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = tagged.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    both = (F.col("l") > 0) & (F.col("r") > 0)

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return per_key.agg(
        total(F.col("l")).alias("left_rows"),
        total(F.col("r")).alias("right_rows"),
        F.count_if(both).alias("matched_keys"),
        total(F.when(F.col("r") == 0, F.col("l")).otherwise(0)).alias("left_only"),
        total(F.when(F.col("l") == 0, F.col("r")).otherwise(0)).alias("right_only"),
        F.count_if((F.col("l") > 1) | (F.col("r") > 1)).alias("repeated_keys"),
    )


def check_pairing(left: DataFrame, right: DataFrame, key: str) -> None:
    """Raise unless both sides hold exactly the same keys, once each."""
    report = pairing_report(left, right, key).first().asDict()
    if report["left_only"] or report["right_only"] or report["repeated_keys"]:
        raise ValueError(f"rows do not pair up on {key}: {report}")


def first_rows(rows: DataFrame, order: str, n: int = 5) -> DataFrame:
    return rows.orderBy(order).limit(n)


def blank_repeats(rows: DataFrame, value: str, position: str, out: str = "shown") -> DataFrame:
    """Blank every repeat of ``value``, keeping it at its first ``position`` (unique) only.

    First positions come from a partial minimum and join back on the position. Joining on the
    value or ranking within it would send each value's rows to a single task.
    """
    firsts = rows.groupBy(value).agg(F.min(position).alias(position)).select(
        position, F.lit(True).alias("__first")
    )
    shown = F.when(F.col("__first"), F.col(value)).when(F.col(value).isNotNull(), F.lit(""))
    return rows.join(firsts, position, "left").withColumn(out, shown).drop("__first")
