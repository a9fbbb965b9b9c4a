import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from larkspur.operators import encoding, sampling


def sizes(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def test_split_is_complete_and_stable(spark):
    df = sampling.assign_split(spark.range(3200), "id")
    found = sizes(df, "split")
    assert sum(found.values()) == 3200 and set(found) == {"train", "valid", "test"}
    again = sampling.assign_split(spark.range(3200).repartition(7), "id")
    assert df.exceptAll(again).count() == 0


def test_exact_split_sizes(spark):
    assert sizes(sampling.assign_exact_split(spark.range(10000), "id"), "split") == {
        "test": 2500, "valid": 1875, "train": 5625,
    }


def test_exact_fold_sizes(spark):
    assert sizes(sampling.assign_exact_fold(spark.range(13), "id"), "fold") == {0: 3, 1: 3, 2: 3, 3: 2, 4: 2}
    assert set(sizes(sampling.assign_fold(spark.range(500), "id"), "fold")) == set(range(5))


def test_balanced_weights_give_equal_totals(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "churn int")
    weighted = sampling.add_balanced_weight(df)
    totals = {r[0]: r[1] for r in weighted.groupBy("churn").agg(F.sum("weight")).collect()}
    assert totals == {0: pytest.approx(2.0), 1: pytest.approx(2.0)}
    assert {r["weight"] for r in sampling.add_positive_weight(df, 5).collect()} == {1.0, 5.0}


def test_unseen_and_missing_levels_are_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "country string")
    later = spark.createDataFrame([(0, "b"), (1, "z"), (2, None)], "i int, country string")
    fitted = encoding.feature_pipeline([], {"country": "onehot"}, {}).fit(train)
    encoded = fitted.transform(later).orderBy("i")
    found = [list(r[0]) for r in encoded.select(vector_to_array("features")).collect()]
    assert found == [[0, 1, 0], [0, 0, 0], [0, 0, 0]]
    assert encoding.feature_names(fitted, encoded) == [f"onehot__country_{x}" for x in "abc"]
    assert encoding.fit_levels(train, "country") == ["a", "b", "c"]
    plain = encoding.one_hot(later, "country", ["a", "b", "c"], "c").orderBy("i").collect()
    assert [tuple(r)[2:] for r in plain] == [(0, 1, 0), (0, 0, 0), (0, 0, 0)]


def test_level_table_numbers_any_number_of_levels(spark):
    words = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("w"))
    twice = words.unionByName(words).unionByName(spark.createDataFrame([(None,)], "w string"))
    found = encoding.level_table(twice, "w")
    rows = found.orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(60_000))
    assert [r["level"] for r in rows] == sorted(r["level"] for r in rows)
    assert encoding.level_table(twice.where("w is null"), "w").count() == 0


@pytest.mark.parametrize("room", [0, 10**6])
def test_sparse_levels_feed_an_assembler(spark, monkeypatch, room):
    monkeypatch.setattr(encoding, "BROADCAST_BYTES", room)
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "country string")
    later = spark.createDataFrame([(0, "b", "x"), (1, "z", "y"), (2, None, None), (3, "b", "x")], "i int, country string, level string")
    encoded = encoding.one_hot_sparse(later, "country", encoding.level_table(train, "country"), "hot")
    assert encoded.columns == ["i", "country", "level", "hot"]
    assembled = VectorAssembler(inputCols=["hot", "i"], outputCol="all").transform(encoded)
    rows = {r["i"]: (r["hot"], list(r["all"].toArray())) for r in assembled.collect()}
    assert {i: v for i, (_, v) in rows.items()} == {0: [0, 1, 0, 0], 1: [0, 0, 0, 1], 2: [0, 0, 0, 2], 3: [0, 1, 0, 3]}
    assert rows[0][0] == SparseVector(3, [1], [1.0]) and rows[1][0] == SparseVector(3, [], [])
    nothing = encoding.one_hot_sparse(later, "country", encoding.level_table(train.where("false"), "country"), "hot")
    assert {r["hot"].size for r in nothing.collect()} == {0}


def test_ordinal_order_and_unknown(spark):
    df = spark.createDataFrame([(0, "Male"), (1, "Female"), (2, "other")], "i int, gender string")
    loose = encoding.ordinal(F.col("gender"), encoding.GENDERS, strict=False)
    assert [r[0] for r in df.orderBy("i").select(loose).collect()] == [0, 1, None]
    strict = encoding.ordinal(F.col("gender"), encoding.GENDERS)
    with pytest.raises(Exception, match="unknown category: other"):
        df.select(strict).collect()


def test_pipeline_rejects_unknown_ordinal(spark):
    train = spark.createDataFrame([("Male", 1.0)], "gender string, x double")
    fitted = encoding.feature_pipeline(["x"], {}).fit(train)
    with pytest.raises(Exception, match="unknown gender"):
        fitted.transform(spark.createDataFrame([("other", 1.0)], "gender string, x double")).collect()


@pytest.mark.parametrize("scaler", ["standard", "robust"])
def test_scalers_center(spark, scaler):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    fitted = encoding.feature_pipeline(["x"], {}, {}, scaler).fit(df)
    found = sorted(r[0][0] for r in fitted.transform(df).select(vector_to_array("features")).collect())
    assert found[1] == pytest.approx(0.0) and found[0] == pytest.approx(-found[2])


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    found = encoding.standardize(df, ["a", "b"]).orderBy("b").collect()
    assert [r["a_scaled"] for r in found] == [0.0, 0.0]
    assert [r["b_scaled"] for r in found] == [-1.0, 1.0]
