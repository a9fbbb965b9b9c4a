"""Running totals, ranks and exact quantiles over a total order, without a one-task window.

A window that only orders puts every row in one partition. For running totals the order is cut
into ranges first: totals per range are few and are accumulated on their own, and each range then
sums its own rows from that offset. Where the ranges lie changes only the balance. Quantiles need
single ranks, which are enclosed in narrow intervals instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.numeric import PRIME
from larkspur.session import shuffle_width

# Errors of the first quantile sketch and of further ones, and how many distinct values one task
# may put in order.
COARSE_ERROR = 1e-3
FINE_ERROR = 1e-4
ORDERED_ROWS = 200_000
RANGE = "__range"


def _range_count(df: DataFrame) -> int:
    """As many ranges as the session shuffles into, which is set by the size of its data."""
    return max(2, shuffle_width(df.sparkSession))


def with_ranges(df: DataFrame, key: str) -> DataFrame:
    """Add the range number of ``key``, from approximate quantiles of it fitted now.

    Fixed bounds make every use of the range agree, also after a lost task runs again.
    """
    parts = _range_count(df)
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, shares, 5 * parts)).first()[0]
    bounds = sorted(set(found or []))
    if not bounds:
        return df.withColumn(RANGE, F.lit(0.0))
    splits = [float("-inf"), *bounds, float("inf")]
    return Bucketizer(
        inputCol=key, outputCol=RANGE, splits=splits, handleInvalid="keep"
    ).transform(df)


def with_hash_ranges(df: DataFrame, key: str) -> DataFrame:
    """Add the range number of a portable hash, whose values are uniform by construction."""
    return df.withColumn(RANGE, F.floor(F.col(key) * _range_count(df) / PRIME))


def running_totals(
    ranged: DataFrame,
    order: Sequence[str],
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<name>`` for every name in ``sums``: the total up to and including the row.

    ``ranged`` carries the range number of the first ``order`` column. ``order`` must be unique
    within ``by``: rows are expected to be aggregated to distinct order values already.
    """
    keys = [*by, RANGE]
    totals = ranged.groupBy(*keys).agg(*[F.sum(s).alias(f"__t_{s}") for s in sums])
    direction = F.col(RANGE).desc() if descending else F.col(RANGE).asc()
    # One row per group and range reach this window.
    before = Window.partitionBy(*by).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"__t_{s}").over(before), F.lit(0)).alias(f"__o_{s}") for s in sums]
    )
    columns = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    inside = Window.partitionBy(*keys).orderBy(*columns).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(s).over(inside).alias(f"cum_{s}") for s in sums])
    return local.join(offsets, keys).select(
        *[c for c in ranged.columns if c != RANGE],
        *[(F.col(f"cum_{s}") + F.col(f"__o_{s}")).alias(f"cum_{s}") for s in sums],
    )


def hash_rank(df: DataFrame, hash_column: str, key: str, out: str = "rank") -> DataFrame:
    """1-based rank of every row by ``(hash_column, key)``."""
    counted = with_hash_ranges(df.withColumn("__one", F.lit(1).cast("long")), hash_column)
    ranked = running_totals(counted, [hash_column, key], ["__one"])
    return ranked.withColumnRenamed("cum___one", out).drop("__one")


def _sketched(values: DataFrame, shares: Sequence[float], error: float):
    """Row count and, per share, an interval sure to hold the ranks next to it; one pass.

    The sketch is off by at most ``error`` times the rows. Three times that on either side also
    covers the neighbouring rank, if there are more than ``1 / error`` rows.
    """
    wanted = [max(0.0, min(1.0, s + side * 3 * error)) for s in shares for side in (-1, 1)]
    sketch = F.percentile_approx("v", wanted, round(1 / error)).alias("q")
    row = values.agg(F.count(F.lit(1)).alias("n"), sketch).first()
    if row["n"] == 0:
        return 0, []
    spans = []
    for i in range(len(shares)):
        low, high = wanted[2 * i], wanted[2 * i + 1]
        start = row["q"][2 * i] if low > 0 else float("-inf")
        end = row["q"][2 * i + 1] if high < 1 else float("inf")
        spans.append((start, end))
    return row["n"], spans


def _narrow(values: DataFrame, span: tuple[float, float], rank: int, limit: int, error: float):
    """Narrow one interval further until a task can put its values in order."""
    start, end = span
    while start < end:
        inside = F.col("v").between(start, end)
        counted = values.agg(
            F.count_if(F.col("v") < start).alias("below"), F.count_if(inside).alias("inside")
        ).first()
        if counted["inside"] <= max(limit, 2 / error):
            break
        share = (rank - counted["below"]) / counted["inside"]
        _, found = _sketched(values.where(inside), [share], error)
        closer = max(start, found[0][0]), min(end, found[0][1])
        if closer == (start, end):
            break
        start, end = closer
    return start, end


def exact_quantiles(
    df: DataFrame, column: str, shares: Sequence[float], limit: int = ORDERED_ROWS
) -> DataFrame:
    """One row ``q0, q1, …``: exact quantiles with linear interpolation, NULLs left out.

    The built-in exact percentile keeps all distinct values in one buffer. Here a sketch with a
    sure error bound encloses each wanted rank first; then one pass counts what lies below and how
    often each of the few enclosed values occurs. No pass shuffles the column.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    rows, spans = _sketched(values, shares, COARSE_ERROR)
    positions = [share * max(0, rows - 1) for share in shares]
    if rows <= max(limit, 2 / COARSE_ERROR):
        spans = [(float("-inf"), float("inf"))] * len(shares)
    elif 8 * COARSE_ERROR * rows > limit:
        pairs = zip(spans, positions)
        spans = [_narrow(values, span, math.floor(p), limit, FINE_ERROR) for span, p in pairs]
    value = F.col("v")
    holding = F.array_compact(
        F.array(*[F.when(value.between(a, b), F.lit(i)) for i, (a, b) in enumerate(spans)])
    )
    inside = None
    for a, b in spans:
        inside = value.between(a, b) if inside is None else inside | value.between(a, b)
    counts = (
        values.where(inside)
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("v", "n", F.explode(holding).alias("span"))
    )
    below = values.agg(F.array(*[F.count_if(value < a) for a, _ in spans]).alias("b")).scalar()
    so_far = Window.partitionBy("span").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("cum", F.sum("n").over(so_far)).withColumn("b", below)
    last = F.get("b", F.col("span")) + F.col("cum")
    first = last - F.col("n")

    def at(rank: int, span: int) -> Column:
        here = (F.col("span") == span) & (first <= rank) & (rank < last)
        return F.max(F.when(here, value))

    def interpolate(span: int, position: float) -> Column:
        low, high = at(math.floor(position), span), at(math.ceil(position), span)
        return (low + (high - low) * (position - math.floor(position))).alias(f"q{span}")

    return ranked.agg(*[interpolate(i, p) for i, p in enumerate(positions)])
