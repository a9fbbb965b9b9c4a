import pytest
from pyspark.sql import functions as F

from larkspur.sources import snapshots, store

SCHEMA = "title string, contents array<string>, url string"


def make(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def found(df):
    return sorted(((r["title"], r["url"]) for r in df.collect()), key=repr)


def test_keys_are_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "s")
    store.upsert(make(spark, ("a", ["x"], "u1"), ("b", [], "u2"), (None, None, "u3")), path, "title", buckets=3)
    version = store.upsert(make(spark, ("b", ["z"], "u4"), ("b", ["y"], "u5"), ("c", None, "u6"), (None, [], "u7")), path, "title")
    assert version == 1
    assert found(store.read(spark, path)) == sorted([("a", "u1"), ("b", "u4"), ("b", "u5"), ("c", "u6"), (None, "u3"), (None, "u7")], key=repr)
    store.upsert(make(spark, ("b", [], "u8")).withColumn("more", F.lit(1)), path, "title")
    assert ("b", "u8") in found(store.read(spark, path)) and store.read(spark, path).columns == ["title", "contents", "url"]
    with pytest.raises(ValueError):
        store.upsert(make(spark, ("b", [], "u8")), path, "url")


def test_a_write_that_dies_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    store.upsert(make(spark, ("a", ["x"], "u1"), ("b", [], "u2")), path, "title")
    before = found(store.read(spark, path))
    broken = make(spark, ("a", [], "u9"), ("q", [], "u9")).withColumn("url", F.when(F.col("title") == "q", F.raise_error("dies")).otherwise(F.col("url")))
    with pytest.raises(Exception, match="dies"):
        store.upsert(broken, path, "title")
    assert found(store.read(spark, path)) == before

    def dies(*_):
        raise OSError("killed before the commit")

    monkeypatch.setattr(store, "commit", dies)
    with pytest.raises(OSError):
        store.upsert(make(spark, ("a", [], "u9")), path, "title")
    assert found(store.read(spark, path)) == before
    assert store.remove_old(spark, path) == 1
    assert found(store.read(spark, path)) == before


def test_only_buckets_of_the_keys_are_read_and_written(spark, tmp_path):
    path = str(tmp_path / "s")
    many = spark.range(200).select(F.concat(F.lit("t"), "id").alias("title"), F.array().cast("array<string>").alias("contents"), F.lit("u").alias("url"))
    store.upsert(many, path, "title", buckets=16)
    first = snapshots.open_snapshot(spark, path).facts["folders"]
    store.upsert(make(spark, ("t7", [], "new")), path, "title")
    second = snapshots.open_snapshot(spark, path).facts["folders"]
    assert len(first) == 16 and sum(first[b] != second[b] for b in first) == 1
    asked = store.lookup(make(spark, ("t7", [], ""), ("t7", [], ""), ("none", [], ""), (None, [], "")).select("title"), path)
    assert found(asked) == [("t7", "new")] and len({f.rsplit("/", 2)[1] for f in asked.inputFiles()}) <= 2
    store.upsert(make(spark, ("t8", [], "new")), path, "title", buckets=5)
    assert len(snapshots.open_snapshot(spark, path).facts["folders"]) == 5
    assert store.read(spark, path).count() == 200 and store.read(spark, path).where("url = 'new'").count() == 2
    assert store.remove_old(spark, path) == 2 and store.read(spark, path).count() == 200


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        store.read(spark, path)
    store.upsert(make(spark, ("a", [], "u")).where("false"), path, "title")
    assert store.read(spark, path).count() == 0
    store.upsert(make(spark, ("a", [], "u")), path, "title")
    store.upsert(make(spark, ("a", [], "u")).where("false"), path, "title")
    assert found(store.read(spark, path)) == [("a", "u")]
