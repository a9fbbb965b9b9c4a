"""Hold-out splits, folds and class weights, all decided per row by a portable hash of its key.

A hash needs no shuffle, gives the same answer on any cluster size and after any lost task, and
can be checked in any SQL engine. The exact-size variants rank rows by that hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.numeric import DEFAULT_SEED, portable_hash
from larkspur.operators.ordered import hash_rank

# Fixed shares: a quarter for test, then a quarter of the rest for validation.
TEST_SHARE = 0.25
VALID_SHARE = 0.25
FOLDS = 5

# 16 buckets cut those shares exactly: 4 test, 3 validation, 9 training.
BUCKETS = 16


def assign_split(df: DataFrame, key: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Add ``split``: ``test`` (25 %), ``valid`` (18.75 %) or ``train``."""
    bucket = portable_hash(F.col(key), seed) % BUCKETS
    tests = int(TEST_SHARE * BUCKETS)
    valids = int(VALID_SHARE * (BUCKETS - tests))
    split = (
        F.when(bucket < tests, "test").when(bucket < tests + valids, "valid").otherwise("train")
    )
    return df.withColumn("split", split)


def assign_exact_split(df: DataFrame, key: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Add ``split`` with exact sizes: ``ceil(n/4)`` test rows, then ``ceil(rest/4)`` validation."""
    ranked = hash_rank(df.withColumn("__hash", portable_hash(F.col(key), seed)), "__hash", key)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    tests = F.ceil(F.col("__n") * TEST_SHARE)
    valids = F.ceil((F.col("__n") - tests) * VALID_SHARE)
    split = (
        F.when(F.col("rank") <= tests, "test")
        .when(F.col("rank") <= tests + valids, "valid")
        .otherwise("train")
    )
    return ranked.withColumn("__n", rows).withColumn("split", split).drop("__hash", "__n", "rank")


def assign_fold(
    df: DataFrame, key: str, folds: int = FOLDS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Add ``fold`` in ``[0, folds)``; sizes are equal up to chance."""
    return df.withColumn("fold", (portable_hash(F.col(key), seed) % folds).cast("int"))


def assign_exact_fold(
    df: DataFrame, key: str, folds: int = FOLDS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Add ``fold`` with sizes that differ by one at most, the larger ones first."""
    ranked = hash_rank(df.withColumn("__hash", portable_hash(F.col(key), seed)), "__hash", key)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    size = F.floor(F.col("__n") / folds)
    extra = F.col("__n") % folds
    position = F.col("rank") - 1
    in_larger = position < extra * (size + 1)
    fold = F.when(in_larger, F.floor(position / (size + 1))).otherwise(
        extra + F.floor((position - extra * (size + 1)) / size)
    )
    numbered = ranked.withColumn("__n", rows).withColumn("fold", fold.cast("int"))
    return numbered.drop("__hash", "__n", "rank")


def add_balanced_weight(df: DataFrame, target: str = "churn", out: str = "weight") -> DataFrame:
    """Add ``n / (2 * n_class)``, so both classes weigh the same in total."""
    ones = F.count_if(F.col(target) == 1).alias("ones")
    zeros = F.count_if(F.col(target) == 0).alias("zeros")
    counts = df.agg(F.struct(ones, zeros).alias("c")).scalar()
    own = F.when(F.col(target) == 1, F.col("__c.ones")).otherwise(F.col("__c.zeros"))
    n = F.col("__c.ones") + F.col("__c.zeros")
    return df.withColumn("__c", counts).withColumn(out, F.try_divide(n, 2 * own)).drop("__c")


def add_positive_weight(
    df: DataFrame, weight: float, target: str = "churn", out: str = "weight"
) -> DataFrame:
    """Add ``weight`` for positives and 1 for the rest."""
    return df.withColumn(out, F.when(F.col(target) == 1, float(weight)).otherwise(1.0))
