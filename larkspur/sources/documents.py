"""JSON law documents: scan, strict validation, title-keyed sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import shared_folder
from larkspur.sources import schemas

# Fixed JSON types a law document must have.
LAW_FIELDS = {"title": "STRING", "contents": "ARRAY<STRING>", "url": "STRING"}


def json_type(text: Column, field: str) -> Column:
    """Type of a top-level JSON field; NULL if the text is broken or the field is missing.

    A variant keeps the type that was written, where a schema read would turn 1 into '1'.
    """
    parsed = F.try_parse_json(text)
    return F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else.

    Parsing stops after the first value, so the text is parsed inside a list, where a second value shows,
    and inside an object, where a closing bracket of the list would not do.
    """
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.coalesce(F.size(listed) == 1, F.lit(False)) & named.isNotNull()


def rejected_reason(text: Column, fields: Mapping[str, str]) -> Column:
    """NULL for a valid document, else why it is rejected.

    An empty list has no element type (``ARRAY<VOID>``) and passes for any list field.
    """
    reason = F.when(~is_json(text), F.lit("broken"))
    for field, wanted in fields.items():
        found = json_type(text, field)
        accepted = [wanted, "ARRAY<VOID>"] if wanted.startswith("ARRAY") else [wanted]
        reason = reason.when(found.isNull(), F.lit(f"{field} missing"))
        reason = reason.when(~found.isin(accepted), F.lit(f"{field} wrong type"))
    return reason


def validate(raw: DataFrame, text: str, fields: Mapping[str, str]) -> DataFrame:
    """Add ``reject_reason`` (NULL if valid) to rows that hold a JSON text."""
    return raw.withColumn("reject_reason", rejected_reason(F.col(text), fields))


def scan_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in the ``*.json`` files below a folder: ``file_name`` (the stem), text and ``reject_reason``.

    A file is one JSON value, or, as the sink writes it, one on each line.
    """
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"(.+)\.json$", 1)
    decoded = F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))
    lines = F.filter(F.split("value", "\n"), lambda line: F.trim(line) != "")
    by_line = (F.size(lines) > 1) & is_json(F.get(lines, F.lit(0)))
    each = F.explode(F.when(by_line, lines).otherwise(F.array("value")))
    named = raw.select(decoded.alias("file_name"), each.alias("json"))
    return validate(named, "json", LAW_FIELDS)


def read_documents(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    """Law documents of a folder as ``file_name, title, contents, url``.

    ``strict`` aborts on the first invalid file; otherwise invalid files are left out and can be
    listed with :func:`rejected_documents`.
    """
    scanned = scan_documents(spark, folder)
    if strict:
        message = F.concat(F.col("file_name"), F.lit(": "), F.col("reject_reason"))
        checked = F.when(F.col("reject_reason").isNull(), F.col("json")).otherwise(
            F.raise_error(message)
        )
        good = scanned.select("file_name", checked.alias("json"))
    else:
        good = scanned.where(F.col("reject_reason").isNull())
    parsed = F.from_json("json", schemas.LAW_DOCUMENT).alias("document")
    return good.select("file_name", parsed).select("file_name", "document.*")


def rejected_documents(spark: SparkSession, folder: str) -> DataFrame:
    scanned = scan_documents(spark, folder)
    return scanned.where(F.col("reject_reason").isNotNull()).select("file_name", "reject_reason")


def latest_per_key(rows: DataFrame, key: str, version: str) -> DataFrame:
    """Keep the row with the highest ``version`` per ``key``; ``version`` is unique per row.

    The winners are found by a partial maximum and come back by a semi join on the unique
    version, so a key with very many versions is never gathered in one task. Rows without a key are
    nobody's versions and all stay.
    """
    winners = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(version).alias(version)).select(version)
    return rows.join(winners, version, "left_semi").unionByName(rows.where(F.col(key).isNull()))


#: Folders that the sink spreads titles over.
BUCKETS = 64


def write_documents(documents: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """JSON sink below ``path``: a title that is there already is replaced, others stay.

    ``documents`` has a title once. Titles lie in folders by their hash, and only folders that get a title
    are written again. Documents without a title are added. :func:`read_documents` reads the result;
    ``buckets`` has to stay the same for a path.
    """
    spark = documents.sparkSession
    bucket = F.pmod(F.xxhash64(F.coalesce("title", F.lit(""))), F.lit(buckets)).cast("int")
    fresh = documents.select("title", "contents", "url", bucket.alias("bucket"))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        shared_folder(spark)
        fresh = fresh.checkpoint()
        stored = spark.read.schema("title string, contents array<string>, url string, bucket int").json(path)
        touched = stored.join(fresh.select("bucket").distinct(), "bucket", "left_semi")
        kept = touched.join(fresh.select("title"), "title", "left_anti").select("title", "contents", "url", "bucket")
        fresh = fresh.unionByName(kept).checkpoint()
    writer = fresh.repartition("bucket").write.option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
    writer.partitionBy("bucket").mode("overwrite").json(path)
