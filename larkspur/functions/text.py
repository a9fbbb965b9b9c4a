"""Tokens, sentences and whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns; both Java's and RE2's regular expressions read them alike.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"
SENTENCE_BREAK = r"[.!?\n]+"


def strip_text(value: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode spaces included."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def tokens(value: Column) -> Column:
    """Lower-case runs of letters and digits, in order, repeats kept."""
    return F.array_remove(F.split(F.lower(value), TOKEN_BREAK), "")


def each_token(words: Column) -> Column:
    """Generator over a computed token array, with one NULL row for an empty one.

    A plain explode makes Spark test the array's size below it, which computes the tokens again.
    """
    return F.explode_outer(words)


def token_set(value: Column) -> Column:
    return F.array_distinct(tokens(value))


def sentences(value: Column) -> Column:
    """Non-blank sentences in order, stripped."""
    return F.array_remove(F.transform(F.split(value, SENTENCE_BREAK), strip_text), "")


def containment(part: Column, whole: Column) -> Column:
    """Share of the distinct tokens of ``part`` found in ``whole`` (both token arrays); 0 if none."""
    distinct = F.array_distinct(part)
    shared = F.size(F.array_intersect(distinct, whole))
    return F.coalesce(F.try_divide(shared.cast("double"), F.size(distinct).cast("double")), F.lit(0.0))
