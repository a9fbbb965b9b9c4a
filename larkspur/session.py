"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(app: str = "larkspur", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and the local benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, wherever the driver was started from.

    Spark hands the archive to every executor, as it does with ``--py-files``.
    """
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="larkspur-"), "larkspur.zip")
        with zipfile.ZipFile(archive, "w") as target:
            for folder, _, files in os.walk(package):
                for name in sorted(files):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        target.write(path, os.path.relpath(path, os.path.dirname(package)))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(application)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests, a laptop) gets a local folder; on a cluster its
    absence is an error, as executors would write to their own disks.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="larkspur-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread rows over the cores where there are fewer input files than cores.

    A lone file is often one row group and then one task, which heavy work per row should not wait
    for. With as many files as cores nothing is moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if 0 < len(df.inputFiles()) < cores else df
