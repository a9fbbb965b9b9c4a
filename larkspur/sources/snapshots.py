"""Tables that are replaced as a whole: readers see the state before a write or after it, never between.

A write puts its tables into a folder of its own and then appends one row to ``commits``, which Spark's
committer moves into place in one step. Readers follow the newest row. A write that dies half-way leaves a
folder that no row names; ``remove_old`` deletes such folders and those of earlier states.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMMITS = "version long, folder string, facts string, schemas string"


@dataclass(frozen=True)
class Snapshot:
    """One state: where its tables lie, and what was recorded with them."""

    spark: SparkSession
    version: int
    folder: str
    facts: dict
    schemas: dict

    def table(self, name: str) -> DataFrame:
        """One table, with the schema it was written with, as an empty one may have no files."""
        return self.spark.read.schema(StructType.fromJson(self.schemas[name])).parquet(f"{self.folder}/{name}")


def commits(spark: SparkSession, path: str) -> list[tuple[int, str, str, str]]:
    """All commits, oldest first; of two with one number the one of the later name counts as later."""
    try:
        rows = spark.read.schema(COMMITS).parquet(f"{path}/commits").collect()
    except AnalysisException:  # nothing was committed yet
        return []
    return sorted(tuple(r) for r in rows)


def current(spark: SparkSession, path: str) -> Snapshot | None:
    found = commits(spark, path)
    if not found:
        return None
    version, folder, facts, schemas = found[-1]
    return Snapshot(spark, version, f"{path}/{folder}", json.loads(facts), json.loads(schemas))


def open_snapshot(spark: SparkSession, path: str) -> Snapshot:
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"nothing is stored under {path}")
    return found


def write_snapshot(
    spark: SparkSession,
    path: str,
    tables: Mapping[str, DataFrame | Callable[[Snapshot], DataFrame]],
    by: Mapping[str, str] | None = None,
    facts: Mapping | None = None,
) -> Snapshot:
    """Store ``tables`` as the new state; ``by`` names the column that a table is partitioned by.

    A table may be a function of the tables before it, which it gets as they were written.
    """
    folder, schemas = f"data/{uuid.uuid4().hex}", {}
    for name, made in tables.items():
        rows = made if isinstance(made, DataFrame) else made(Snapshot(spark, -1, f"{path}/{folder}", {}, schemas))
        writer = rows.write.partitionBy(by[name]) if by and name in by else rows.write
        writer.parquet(f"{path}/{folder}/{name}")
        schemas[name] = rows.schema.jsonValue()
    return commit(spark, path, folder, dict(facts or {}), schemas)


def commit(spark: SparkSession, path: str, folder: str, facts: Mapping, schemas: Mapping) -> Snapshot:
    """Make what was written to ``folder`` the newest state."""
    before = current(spark, path)
    row = (before.version + 1 if before else 0, folder, json.dumps(facts), json.dumps(schemas))
    spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return open_snapshot(spark, path)


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all folders but those of the last ``keep`` states; the number of folders that went.

    Only call this while nobody writes, as the folder of an unfinished write looks like one of a dead write.
    """
    wanted = {folder for _, folder, _, _ in commits(spark, path)[-keep:]}
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return 0
    old = [s.getPath() for s in files.listStatus(root) if f"data/{s.getPath().getName()}" not in wanted]
    for folder in old:
        files.delete(folder, True)
    return len(old)
