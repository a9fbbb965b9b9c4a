import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import explore, sketches


@pytest.fixture(scope="module")
def rows(spark):
    value = F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 51 == 0, float("nan")).otherwise(F.pow(F.col("id") * 7919 % 20011, F.lit(2)) + 1e9)
    return spark.range(20_000).select((F.col("id") % 9).alias("day"), value.alias("v")).cache()


def numbers(rows):
    found = np.array([r["v"] for r in rows.where("v is not null").collect()])
    return found[~np.isnan(found)]


def test_quantiles_from_merged_sketches_are_exact(spark, rows):
    stored = sketches.summarize(rows, "v", ["day"])
    shares = [0.0, 0.01, 0.25, 0.5, 0.500001, 0.99, 1.0]
    found = sketches.quantiles(rows, "v", stored, shares).first()
    assert list(found) == pytest.approx(list(np.quantile(numbers(rows), shares)), rel=1e-12)


def test_describe_agrees_with_the_plain_way(spark, rows):
    stored = sketches.summarize(rows, "v", ["day"])
    found = sketches.describe(rows, "v", stored).first()
    plain = explore.describe(rows.where(~F.isnan("v")), "v").first()
    assert found.asDict() == pytest.approx(plain.asDict(), rel=1e-9)


def test_new_groups_only_add_a_summary(spark, rows):
    old, new = rows.where("day < 7"), rows.where("day >= 7")
    parts = sketches.summarize(old, "v", ["day"]).unionByName(sketches.summarize(new, "v", ["day"]))
    merged = sketches.merge(parts).first()
    values = numbers(rows)
    assert (merged["n"], merged["missing"]) == (len(values), 20_000 - len(values))
    assert merged["mean"] == pytest.approx(values.mean()) and merged["m2"] == pytest.approx(values.var() * len(values))
    by_parity = sketches.merge(parts.withColumn("odd", F.col("day") % 2), ["odd"])
    assert by_parity.count() == 2 and by_parity.agg(F.sum("n")).first()[0] == len(values)


def test_sketched_ranks_are_near(spark, rows):
    found = sketches.approximate_quantiles(sketches.summarize(rows, "v", ["day"]), [0.1, 0.5, 0.9]).first()
    values = np.sort(numbers(rows))
    for share, value in zip([0.1, 0.5, 0.9], found, strict=True):
        assert abs(np.searchsorted(values, value) / len(values) - share) <= sketches.rank_error(sketches.SKETCH_SIZE)


def test_summaries_of_other_rows_do_no_harm(spark, rows):
    stale = sketches.summarize(rows.where("day = 0"), "v")
    found = sketches.quantiles(rows, "v", stale, [0.25, 0.75]).first()
    assert list(found) == pytest.approx(list(np.quantile(numbers(rows), [0.25, 0.75])), rel=1e-12)
    shifted = rows.withColumn("v", F.col("v") * -1)
    other = sketches.quantiles(shifted, "v", sketches.summarize(rows, "v"), [0.25]).first()
    assert other[0] == pytest.approx(np.quantile(-numbers(rows), 0.25), rel=1e-12)


def test_without_values(spark):
    empty = spark.createDataFrame([(1, None), (2, float("nan"))], "day int, v double")
    for df in (empty, empty.where("false")):
        stored = sketches.summarize(df, "v", ["day"])
        assert sketches.quantiles(df, "v", stored, [0.5]).first()[0] is None
        row = sketches.describe(df, "v", stored).first()
        assert row["count"] == 0 and row["mean"] is None and row["p50"] is None
