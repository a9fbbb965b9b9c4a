"""Stored summaries of a column, one for each group of rows (a day, a file), that merge into one.

A summary holds the count, mean, squared deviations and limits of its rows, and a KLL sketch of their order.
New rows only need a summary of their own, and any union of groups is described from their summaries alone.
Exact quantiles take one pass over the rows: the merged sketch says between which values each rank lies, the
pass counts what is beside and inside these spans. A span that misses its rank, which the counts show, is not
used: the quantiles are then found without the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.explore import QUARTILES
from larkspur.operators.ordered import ORDERED_ROWS, exact_quantiles
from larkspur.session import shared_folder

#: Size of a sketch: it keeps about three times as many values.
SKETCH_SIZE = 2048


def rank_error(size: int) -> float:
    """How far, as a share of the rows, the rank of a sketched value may be off; 99 of 100 are nearer.

    Fixed values of the published error curve of KLL sketches, with half as much again to spare.
    """
    return 1.5 * 2.296 / size**0.9021


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def summarize(df: DataFrame, column: str, by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """One summary per group: ``by, n, missing, mean, m2, low, high, sketch``.

    NULL and NaN count as missing. One pass; groups combine before the shuffle.
    """
    rows = df.select(*by, _number(column).alias("__v"))
    return rows.groupBy(*by).agg(
        F.count("__v").alias("n"),
        (F.count(F.lit(1)) - F.count("__v")).alias("missing"),
        F.avg("__v").alias("mean"),
        (F.var_pop("__v") * F.count("__v")).alias("m2"),
        F.min("__v").alias("low"),
        F.max("__v").alias("high"),
        F.kll_sketch_agg_double("__v", F.lit(size)).alias("sketch"),
    )


def merge(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summaries of unions of groups; ``by`` are the columns that stay."""
    held = F.col("n") > 0
    # Means are taken from a value in their midst, so that squares of large ones don't cancel.
    middle = summaries.agg(F.avg("mean")).scalar()
    shift = F.col("mean") - F.col("__middle")
    weighted = summaries.withColumn("__middle", middle).groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("missing").alias("missing"),
        F.max("__middle").alias("__middle"),
        F.sum(F.col("n") * shift).alias("__total"),
        F.sum("m2").alias("__m2"),
        F.sum(F.col("n") * shift * shift).alias("__squares"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double(F.when(held, F.col("sketch"))).alias("sketch"),
    )
    off = F.try_divide(F.col("__total"), F.col("n"))
    between = F.greatest(F.lit(0.0), F.col("__squares") - F.col("__total") * off)
    mean = F.col("__middle") + off
    return weighted.select(*by, "n", "missing", mean.alias("mean"), (F.col("__m2") + between).alias("m2"), "low", "high", "sketch")


def _spans(summary: DataFrame, shares: Sequence[float], rows: int, size: int) -> list[tuple[float, float]]:
    """For each share the values between which its two ranks should lie, overlapping spans joined."""
    error = rank_error(size)
    ends = []
    for share in shares:
        place = share * (rows - 1)
        ends += [math.floor(place) / rows - error, (math.ceil(place) + 1) / rows + error]
    asked = [F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, e)))) for e in ends]
    found = summary.select(F.array(*asked)).first()[0]
    values = [-math.inf if e <= 0 else math.inf if e >= 1 else v for e, v in zip(ends, found, strict=True)]
    joined: list[tuple[float, float]] = []
    for low, high in sorted(zip(values[::2], values[1::2], strict=True)):
        if joined and low <= joined[-1][1]:
            joined[-1] = joined[-1][0], max(high, joined[-1][1])
        else:
            joined.append((low, high))
    return joined


def quantiles(df: DataFrame, column: str, summaries: DataFrame, shares: Sequence[float], size: int = SKETCH_SIZE) -> DataFrame:
    """One row ``q0, q1, …``: exact quantiles of ``column`` with linear interpolation, missing values left out.

    ``summaries`` are those of all rows of ``df``, in any number of groups. Should they be of other rows, or too many
    values lie in a span, the result is the same but takes more passes.
    """
    summary = merge(summaries)
    rows = summary.select("n").first()[0] or 0
    plain = df.select(_number(column).alias(column))
    if rows == 0 or 3 * rank_error(size) * rows > ORDERED_ROWS:
        return exact_quantiles(plain, column, shares)
    spans = _spans(summary, shares, rows, size)
    value, region = F.col(column), F.lit(0)
    for i, (low, high) in enumerate(spans):
        # Odd regions are spans, even ones what lies between them.
        region = F.when(value.between(low, high), 2 * i + 1).when(value > high, 2 * i + 2).otherwise(region)
    inside = F.when(F.col("region") % 2 == 1, value)
    counts = plain.where(value.isNotNull()).select(region.alias("region"), column).groupBy("region", inside.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    shared_folder(df.sparkSession)
    counts = counts.checkpoint()
    totals = counts.groupBy("region").agg(F.sum("n").alias("total"))
    before = Window.orderBy("region").rowsBetween(Window.unboundedPreceding, -1)  # a row per region
    offsets = totals.select("region", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    so_far = Window.partitionBy("region").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("cum", F.sum("n").over(so_far)).join(F.broadcast(offsets), "region")
    last = F.col("offset") + F.col("cum")
    first = last - F.col("n")

    def at(rank: int) -> Column:
        return F.max(F.when((first <= rank) & (rank < last), F.col("v")))

    places = [share * (rows - 1) for share in shares]
    found = ranked.agg(
        F.sum("n").alias("n"),
        *[at(math.floor(p)).alias(f"l{i}") for i, p in enumerate(places)],
        *[at(math.ceil(p)).alias(f"h{i}") for i, p in enumerate(places)],
    )
    row = found.first()
    if row["n"] != rows or any(v is None for v in row):
        return exact_quantiles(plain, column, shares)
    results = [row[f"l{i}"] + (row[f"h{i}"] - row[f"l{i}"]) * (p - math.floor(p)) for i, p in enumerate(places)]
    return df.sparkSession.createDataFrame([tuple(results)], ", ".join(f"q{i} double" for i in range(len(places))))


def approximate_quantiles(summaries: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by, q0, q1, …`` from the summaries alone: ranks are off by :func:`rank_error` at most, mostly."""
    asked = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias(f"q{i}") for i, s in enumerate(shares)]
    return merge(summaries, by).where(F.col("n") > 0).select(*by, *asked)


def describe(df: DataFrame, column: str, summaries: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """As ``explore.describe``, in one pass over the rows: all but the quartiles comes from the summaries."""
    exact = quantiles(df, column, summaries, QUARTILES, size)
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    summary = merge(summaries).select(F.coalesce("n", F.lit(0)).alias("count"), "mean", deviation.alias("std"), F.col("low").alias("min"), F.col("high").alias("max"))
    fitted = exact.select(F.struct("*").alias("q")).scalar()
    names = [F.col(f"q.q{i}").alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return summary.withColumn("q", fitted).select("count", "mean", "std", "min", *names, "max")
