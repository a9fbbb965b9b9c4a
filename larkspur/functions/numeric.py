"""Ratios, thresholds, scaling and the portable integer hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the portable hash (two rounds of the Lehmer generator).
PRIME = 2147483647
FIRST_FACTOR = 48271
SECOND_FACTOR = 16807
DEFAULT_SEED = 42


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """A share whose empty denominator counts as zero, as the binary metrics do."""
    return F.coalesce(safe_ratio(numerator, denominator), F.lit(0.0))


def threshold_label(score: Column, threshold: float) -> Column:
    """1 where the score reaches the threshold (inclusive), else 0."""
    return (score >= F.lit(threshold)).cast("int")


def portable_hash(key: Column, seed: int = DEFAULT_SEED) -> Column:
    """Uniform integer in ``[0, PRIME)`` that any SQL engine computes alike.

    The key is reduced first, so 64-bit keys of any size cannot overflow.
    """
    reduced = F.pmod(key.cast("long"), F.lit(PRIME).cast("long"))
    first = (reduced * FIRST_FACTOR + seed) % PRIME
    return (first * SECOND_FACTOR) % PRIME
