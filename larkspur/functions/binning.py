"""Interval bins. Two conventions exist side by side: cut points close on the right,
histogram edges close on the left (except the last bin, which closes on both sides)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def interval_ordinal(value: Column, cuts: Sequence[float], include_lowest: bool = False) -> Column:
    """0-based index of the right-closed interval holding ``value``; NULL outside all of them."""
    low, *uppers = cuts
    inside = (value >= low) if include_lowest else (value > low)
    chain = None
    for index, upper in enumerate(uppers):
        test = inside & (value <= upper) if index == 0 else value <= upper
        chain = F.when(~inside, F.lit(None).cast("int")) if chain is None else chain
        chain = chain.when(test, F.lit(index))
    return chain


def interval_label(
    value: Column, cuts: Sequence[float], labels: Sequence[str], include_lowest: bool = False
) -> Column:
    """Label of the right-closed interval holding ``value``; NULL outside all of them."""
    if len(labels) != len(cuts) - 1:
        raise ValueError("one label per interval is needed")
    names = F.array(*[F.lit(name) for name in labels])
    return F.get(names, interval_ordinal(value, cuts, include_lowest))


def edge_bin(value: Column, edges: Sequence[float]) -> Column:
    """Histogram bin for given edges: left-closed, last bin closed, NULL outside."""
    last = len(edges) - 2
    chain = F.when((value < edges[0]) | (value > edges[-1]), F.lit(None).cast("int"))
    for index, upper in enumerate(edges[1:-1]):
        chain = chain.when(value < upper, F.lit(index))
    return chain.when(value <= edges[-1], F.lit(last))


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of ``bins`` equal widths over ``[low, high]``.

    A range of width zero is widened by one half on both sides, so all of it lands in one bin.
    """
    start, width = equal_width_range(low, high, bins)
    return F.least(F.floor((value - start) / width), F.lit(bins - 1)).cast("int")


def equal_width_range(low: Column, high: Column, bins: int) -> tuple[Column, Column]:
    """Start and bin width of the range that :func:`equal_width_bin` cuts."""
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low) / bins
    return start, width
