"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import fresh_folder, shared_folder

#: White space between words, as a translate() set: space and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch where a row holds a text or a set. Spark's default of 10,000 such rows is held outside the
#: heap by the JVM, in buffers that double as they grow, and once more by Python; each task does so.
TEXT_ROWS = 512
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: the lineage ends, lost executors don't
    matter, and the rows are computed once however often they are read."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextlib.contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """What is run inside sends Python at most ``TEXT_ROWS`` rows at once."""
    before = spark.conf.get(BATCH_SETTING)
    if not 0 < int(before) <= TEXT_ROWS:
        spark.conf.set(BATCH_SETTING, TEXT_ROWS)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def stored_texts(df: DataFrame, name: str) -> DataFrame:
    """As ``stored`` for what Python makes of texts or sets, in small batches."""
    with text_batches(df.sparkSession):
        return stored(df, name)


def checkpointed(df: DataFrame) -> DataFrame:
    """As ``stored`` for small tables; Spark removes the files once nothing refers to them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def join_counted(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: str, share: float, least: int) -> DataFrame:
    """Join on keys that are unique in ``right``, whose column ``rows`` counts the rows of ``left``.

    Keys with more than a share of all rows, and more than ``least``, are at most ``1 / share``; they are
    broadcast, so that none of them is gathered in one task. Both sides should be stored, as both are read twice.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    limit = max(least, int(total * share))
    names = list(keys)
    large = F.broadcast(right.where(F.col(rows) > limit))
    small = left.join(large.select(*names), names, "left_anti").join(right.where(F.col(rows) <= limit), names)
    return small.unionByName(left.join(large, names))


def unit_hash(*columns: Column | str, seed: int = 0) -> Column:
    """A number in (0, 1) decided by the columns' text: 52 bits of an MD5, which every SQL engine has."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("\x00")) for c in columns]
    digest = F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the strings of ``column`` have about ``limit`` bytes in each slice.

    A single longer value stays whole, in a slice of its own.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(batch.schema.names.index(column))
        if values.nbytes <= limit:
            yield batch
            continue
        start = held = 0
        for i, size in enumerate(lengths(values)):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def release() -> None:
    """Give back memory that a worker's task has freed, as workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lengths(values: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_pylist()


def letters(value: Column) -> Column:
    """Empty text for NULL."""
    return F.coalesce(value, F.lit(""))
