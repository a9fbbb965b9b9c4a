"""Exploratory statistics: cross counts, summaries, histograms, value counts, box-plot figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.binning import (
    edge_bin,
    equal_width_bin,
    equal_width_range,
    interval_ordinal,
)
from larkspur.operators.ordered import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def cross_count(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Counts of ``rows`` by the listed ``values`` of ``columns``, missing pairs as 0."""
    named = [
        F.count_if(F.col(columns) == value).alias(f"{columns}_{value}") for value in values
    ]
    return df.groupBy(rows).agg(*named)


def describe(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row: count, mean, sample deviation, minimum, quartiles, maximum.

    ``approximate`` replaces the exact quartiles by a sketch in the same single pass.
    """
    value = F.col(column).cast("double")
    basics = [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
    ]
    top = F.max(value).alias("max")
    if approximate:
        sketch = F.percentile_approx(value, list(QUARTILES), 10000).alias("q")
        row = df.agg(*basics, sketch, top)
        quartiles = [F.col("q")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
        return row.select("count", "mean", "std", "min", *quartiles, "max")
    exact = exact_quantiles(df, column, QUARTILES).select(F.struct("q0", "q1", "q2").alias("q"))
    row = df.agg(*basics, top).withColumn("q", exact.scalar())
    quartiles = [F.col(f"q.q{i}").alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return row.select("count", "mean", "std", "min", *quartiles, "max")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column as ``column_name, nulls``; NaN counts as missing in doubles."""

    def missing(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.count_if(value.isNull() | F.isnan(value))
        return F.count_if(value.isNull())

    counts = df.agg(*[missing(f).alias(f.name) for f in df.schema.fields])
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").alias("nulls"))
            for name in df.columns
        ]
    )
    return counts.select(F.inline(pairs))


def _with_empty_bins(
    counts: DataFrame, bins: int, cohort: str | None, cohorts: Sequence[int]
) -> DataFrame:
    """Every bin (of every cohort) once, with 0 where nothing was counted."""
    grid = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    keys = ["bin"]
    if cohort is not None:
        grid = grid.withColumn(cohort, F.explode(F.array(*[F.lit(c) for c in cohorts])))
        keys.append(cohort)
    return grid.join(counts, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def histogram(
    df: DataFrame,
    column: str,
    edges: Sequence[float],
    cohort: str | None = None,
    cohorts: Sequence[int] = (0, 1),
) -> DataFrame:
    """Counts per given-edge bin (and cohort): ``bin, low, high[, cohort], n``."""
    keys = ["bin"] + ([cohort] if cohort else [])
    binned = df.select(edge_bin(F.col(column), edges).alias("bin"), *keys[1:])
    counts = binned.where(F.col("bin").isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"))
    limits = F.array(*[F.lit(float(edge)) for edge in edges])
    full = _with_empty_bins(counts, len(edges) - 1, cohort, cohorts)
    return full.select(
        "bin",
        F.get(limits, F.col("bin")).alias("low"),
        F.get(limits, F.col("bin") + 1).alias("high"),
        *keys[1:],
        "n",
    )


def equal_width_histogram(
    df: DataFrame,
    column: str,
    bins: int,
    cohort: str | None = None,
    cohorts: Sequence[int] = (0, 1),
) -> DataFrame:
    """Counts per equal-width bin over the common range: ``bin, low, high[, cohort], n``.

    The range is a scalar subquery (one pass, one row); binning and counting is a second pass.
    """
    value = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("s")).scalar()
    keys = ["bin"] + ([cohort] if cohort else [])
    low, high = F.col("__span.lo"), F.col("__span.hi")
    binned = (
        df.where(value.isNotNull())
        .withColumn("__span", span)
        .select(equal_width_bin(value, low, high, bins).alias("bin"), *keys[1:])
    )
    counts = binned.groupBy(*keys).agg(F.count("*").alias("n"))
    start, width = equal_width_range(low, high, bins)
    full = _with_empty_bins(counts, bins, cohort, cohorts).withColumn("__span", span)
    return full.select("bin", start.alias("start"), width.alias("width"), *keys[1:], "n").select(
        "bin",
        (F.col("start") + F.col("bin") * F.col("width")).alias("low"),
        (F.col("start") + (F.col("bin") + 1) * F.col("width")).alias("high"),
        *keys[1:],
        "n",
    )


def interval_counts(
    df: DataFrame,
    column: str,
    cuts: Sequence[float],
    labels: Sequence[str],
    include_lowest: bool = False,
) -> DataFrame:
    """Counts per right-closed interval in interval order, empty ones as 0: ``bin, label, n``."""
    ordinal = interval_ordinal(F.col(column), cuts, include_lowest)
    counts = df.select(ordinal.alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(label) for label in labels])
    full = _with_empty_bins(counts, len(labels), None, ())
    return full.select("bin", F.get(names, F.col("bin")).alias("label"), "n").orderBy("bin")


def with_percent(counts: DataFrame, n: str = "n", out: str = "percent") -> DataFrame:
    """Share of the total in percent, one decimal. ``counts`` is a short, aggregated table."""
    whole = F.sum(n).over(Window.partitionBy(F.lit(0)))
    return counts.withColumn(out, F.round(F.try_divide(F.lit(100.0) * F.col(n), whole), 1))


def box_figures(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """One row of box-plot figures: quartiles, whiskers and the number of outliers.

    Whiskers end at the outermost values within ``reach`` times the quartile distance.
    """
    value = F.col(column).cast("double")
    box = exact_quantiles(df, column, QUARTILES).select(F.struct("q0", "q1", "q2").alias("b"))
    fenced = df.where(value.isNotNull()).select(value.alias("v")).withColumn("b", box.scalar())
    spread = (F.col("b.q2") - F.col("b.q0")) * reach
    low, high = F.col("b.q0") - spread, F.col("b.q2") + spread
    inside = (F.col("v") >= low) & (F.col("v") <= high)
    return fenced.agg(
        F.max("b.q0").alias("q1"),
        F.max("b.q1").alias("median"),
        F.max("b.q2").alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
