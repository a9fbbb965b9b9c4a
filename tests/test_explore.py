import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from larkspur.operators import explore, features, ordered, pairing


def numbers(spark, items, name="x", kind="double"):
    return spark.createDataFrame([(v,) for v in items], f"{name} {kind}")


def test_describe_small(spark):
    found = explore.describe(numbers(spark, [1.0, 2.0, 4.0, 10.0, None]), "x").first()
    assert (found["count"], found["mean"]) == (4, 4.25)
    assert found["std"] == pytest.approx(4.031129, abs=1e-6)
    assert [found[c] for c in ("min", "p25", "p50", "p75", "max")] == [1.0, 1.75, 3.0, 5.5, 10.0]


def test_describe_approximate_has_the_same_shape(spark):
    df = numbers(spark, [float(i) for i in range(1001)])
    exact, rough = explore.describe(df, "x").first(), explore.describe(df, "x", approximate=True).first()
    assert exact.asDict().keys() == rough.asDict().keys()
    assert abs(exact["p50"] - rough["p50"]) <= 1


def test_quantiles_with_one_value_holding_most_rows(spark):
    items = [7.0] * 700 + [float(i) for i in range(300)]
    found = ordered.exact_quantiles(numbers(spark, items), "x", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).first()
    expected = pd.Series(items).quantile([0.0, 0.1, 0.25, 0.5, 0.9, 1.0])
    assert list(found) == pytest.approx(list(expected))


@pytest.mark.parametrize("limit", [10, 1000, 100_000])
def test_quantiles_narrow_down_to_few_values(spark, limit, monkeypatch):
    monkeypatch.setattr(ordered, "FINE_ERROR", 0.01)
    items = [5.0] * 9000 + [float(i * i % 9973) / 7 for i in range(15000)] + [-3.5, 1e9]
    shares = [0.0, 0.001, 0.2, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = ordered.exact_quantiles(numbers(spark, items), "x", shares, limit=limit).first()
    assert list(found) == pytest.approx(list(pd.Series(items).quantile(shares)))


def test_quantiles_of_nothing_and_of_one(spark):
    assert list(ordered.exact_quantiles(numbers(spark, [None]), "x", [0.5]).first()) == [None]
    assert list(ordered.exact_quantiles(numbers(spark, [3.0]), "x", [0.25, 0.75]).first()) == [3.0, 3.0]


def test_running_totals_equal_a_plain_window(spark):
    df = spark.range(500).select((F.col("id") * 7 % 501).cast("double").alias("k"), (F.col("id") % 9).alias("n"))
    for descending in (False, True):
        ranged = ordered.with_ranges(df, "k")
        found = ordered.running_totals(ranged, ["k"], ["n"], descending=descending).toPandas()
        plain = df.toPandas().sort_values("k", ascending=not descending)
        plain["cum"] = plain["n"].cumsum()
        both = found.merge(plain, on="k")
        assert len(both) == 500 and (both["cum_n"] == both["cum"]).all()


def test_null_counts_count_nan(spark):
    df = spark.createDataFrame([(1, math.nan, "a"), (None, 1.0, None)], "a int, b double, c string")
    assert dict(map(tuple, explore.null_counts(df).collect())) == {"a": 1, "b": 1, "c": 1}


def test_histogram_keeps_empty_bins_and_drops_outside(spark):
    found = explore.histogram(numbers(spark, [5.0, 10.0, 19.9, 90.0, 95.0]), "x", list(range(10, 100, 10)))
    assert [r["n"] for r in found.orderBy("bin").collect()] == [2, 0, 0, 0, 0, 0, 0, 1]


def test_equal_width_histogram_of_a_constant(spark):
    found = explore.equal_width_histogram(numbers(spark, [2.0, 2.0, None]), "x", 4).collect()
    assert len(found) == 4 and sorted(r["n"] for r in found) == [0, 0, 0, 2]


def test_interval_counts_and_percent(spark):
    df = numbers(spark, [0, 1, 1, 3, 10], "tenure", "int")
    counts = explore.interval_counts(df, "tenure", features.TENURE_CUTS, features.TENURE_LABELS)
    assert [r["n"] for r in counts.collect()] == [2, 0, 1, 0, 0, 0, 0, 0, 0, 1]
    shares = explore.with_percent(counts).orderBy("bin").collect()
    assert [r["percent"] for r in shares][:3] == [50.0, 0.0, 25.0]


def test_box_figures(spark):
    found = explore.box_figures(numbers(spark, [1.0, 2.0, 3.0, 4.0, 100.0]), "x").first()
    assert tuple(found) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)


def test_cross_count_fills_zero(spark, collect):
    df = spark.createDataFrame([("m", 0), ("m", 0), ("f", 1)], "g string, churn int")
    assert collect(explore.cross_count(df, "g", "churn", [0, 1])) == [("f", 0, 1), ("m", 2, 0)]


def test_blank_repeats_marks_all_repeats(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "a"), (4, None)], "p int, v string")
    found = pairing.blank_repeats(df, "v", "p").orderBy("p").collect()
    assert [r["shown"] for r in found] == ["a", "", "b", "", None]


def test_pairing_reports_and_checks(spark):
    left = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "k int")
    assert tuple(pairing.pairing_report(left, right, "k").first()) == (3, 2, 1, 1, 1, 1)
    with pytest.raises(ValueError):
        pairing.check_pairing(left, right, "k")
    pairing.check_pairing(right, right, "k")


def test_target_split_and_cohorts(spark):
    df = spark.createDataFrame([(1, 0, 3), (2, 1, 4)], "customer_id long, churn int, age int")
    rest, target = features.split_target(df)
    assert rest.columns == ["age"] and target.columns == ["churn"]
    assert features.cohort(df, 1).count() == 1
