"""A keyed table that is written a part at a time: rows of the given keys are replaced, others stay.

Rows lie in buckets by a hash of their key. A write puts the buckets that it touches into a new folder and then
commits one row that names the folder of every bucket, so readers see all of a write or nothing of it, and a
write that dies leaves only a folder that no commit names. How many buckets there are, and of which key, is
recorded with the data. One writer at a time: of two at once the later commit wins.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larkspur.session import shared_folder, shuffle_width
from larkspur.sources.snapshots import Snapshot, commit, commits, current, open_snapshot

BUCKET = "__bucket"


def _bucket(rows: DataFrame, key: str, buckets: int) -> Column:
    """Rows without a key are nobody's: they are spread by all that can be hashed of them."""
    spread = F.xxhash64(F.to_json(F.struct("*")))
    return F.pmod(F.when(F.col(key).isNull(), spread).otherwise(F.xxhash64(F.col(key))), F.lit(buckets)).cast("int")


def _rows(snapshot: Snapshot, path: str, buckets: list[str]) -> DataFrame:
    schema = StructType.fromJson(snapshot.schemas["rows"])
    folders = snapshot.facts["folders"]
    paths = [f"{path}/data/{folders[b]}/{BUCKET}={b}" for b in buckets if b in folders]
    return snapshot.spark.read.schema(schema).parquet(*paths) if paths else snapshot.spark.createDataFrame([], schema)


def _buckets_of(rows: DataFrame) -> list[str]:
    """Numbers of the buckets that have rows; there are never more than the store has buckets."""
    return [str(r[BUCKET]) for r in rows.select(BUCKET).distinct().collect()]


def upsert(rows: DataFrame, path: str, key: str, buckets: int | None = None) -> int:
    """Replace the rows of every key in ``rows`` and return the number of the new state.

    Rows that share a key are replaced together; rows without a key are added. Later writes need the columns of
    the first. ``buckets`` is as many as the session shuffles into unless given; another number than the recorded one
    deals the whole table anew, which is how a table that has grown gets more of them.
    """
    spark = rows.sparkSession
    before = current(spark, path)
    if before and before.facts["key"] != key:
        raise ValueError(f"{path} is keyed by {before.facts['key']}")
    held = before.facts["buckets"] if before else None
    wanted = buckets or held or shuffle_width(spark)
    schema = StructType.fromJson(before.schemas["rows"]) if before else rows.schema
    shared_folder(spark)
    fresh = rows.select(*schema.names)
    fresh = fresh.withColumn(BUCKET, _bucket(fresh, key, wanted)).checkpoint()
    touched = _buckets_of(fresh)
    folders: dict[str, str] = {}
    if before:
        same = wanted == held
        folders = dict(before.facts["folders"]) if same else {}
        old = _rows(before, path, touched if same else list(before.facts["folders"]))
        kept = old.join(fresh.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti").select(*schema.names)
        kept = kept.withColumn(BUCKET, _bucket(kept, key, wanted))
        if not same:
            touched = sorted({*touched, *_buckets_of(kept)})
        fresh = fresh.unionByName(kept)
    name = uuid.uuid4().hex
    # Buckets that are too large for one task are written by several.
    fresh.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/data/{name}")
    folders |= {b: name for b in touched}
    facts = {"key": key, "buckets": wanted, "folders": folders}
    return commit(spark, path, f"data/{name}", facts, {"rows": schema.jsonValue()}).version


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the newest state."""
    snapshot = open_snapshot(spark, path)
    return _rows(snapshot, path, list(snapshot.facts["folders"]))


def lookup(keys: DataFrame, path: str) -> DataFrame:
    """Rows whose key is among those of ``keys``, a table of that one column; reads only the buckets they lie in."""
    snapshot = open_snapshot(keys.sparkSession, path)
    key = snapshot.facts["key"]
    asked = keys.select(key).where(F.col(key).isNotNull()).distinct()
    buckets = _buckets_of(asked.select(_bucket(asked, key, snapshot.facts["buckets"]).alias(BUCKET)))
    found = _rows(snapshot, path, buckets)
    return found.join(asked, key, "left_semi").select(*found.columns)


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete folders that none of the last ``keep`` states names; only call this while nobody writes."""
    named = {f for _, _, facts, _ in commits(spark, path)[-keep:] for f in json.loads(facts)["folders"].values()}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in files.listStatus(root) if s.getPath().getName() not in named] if files.exists(root) else []
    for folder in old:
        files.delete(folder, True)
    return len(old)
