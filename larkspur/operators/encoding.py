"""Category and number encoding, as spark.ml stages and as plain columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    RobustScaler,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from larkspur.session import shared_folder, shuffle_width

# Fixed order of the two-valued category, and the prefixes of the encoded columns' names.
GENDERS = ("Male", "Female")
ONE_HOT = {"country": "onehot", "risk_age_rank": "onehot_age_rank"}
ORDINAL = {"gender": ("ordinal_gender", GENDERS)}
REMAINDER = "remainder"

# Levels that become columns travel through the driver; beyond this, ``one_hot_sparse`` needs neither.
MAX_LEVELS = 10_000

# Tables of levels up to this size are sent to every executor.
BROADCAST_BYTES = 8_000_000


def fit_levels(df: DataFrame, column: str) -> list[str]:
    """Distinct non-missing values in code-point order."""
    found = df.where(F.col(column).isNotNull()).select(column).distinct().limit(MAX_LEVELS + 1)
    levels = sorted(row[0] for row in found.collect())
    if len(levels) > MAX_LEVELS:
        raise ValueError(f"{column} has more than {MAX_LEVELS} levels; use level_table and one_hot_sparse")
    return levels


def level_table(df: DataFrame, column: str) -> DataFrame:
    """``level, index``: distinct non-missing values, numbered from 0 in their order (code points for text).

    However many there are, none passes through the driver: values are cut into ranges, and a range's numbers
    begin after the values of the ranges before it. The ranges are drawn from a sample, so they are fixed by a
    checkpoint before anything is counted.
    """
    spark = df.sparkSession
    shared_folder(spark)
    found = df.where(F.col(column).isNotNull()).select(F.col(column).alias("level")).distinct()
    placed = found.repartitionByRange(shuffle_width(spark), "level").withColumn("part", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("level")) - 1
    numbered = placed.withColumn("place", place).join(F.broadcast(offsets), "part")
    return numbered.select("level", (F.col("offset") + F.col("place")).alias("index")).checkpoint()


def one_hot_sparse(df: DataFrame, column: str, levels: DataFrame, out: str) -> DataFrame:
    """Add ``out``: the one-hot vector of ``column`` as a sparse ``spark.ml`` vector.

    ``levels`` is a :func:`level_table`; unseen and missing values get zeros throughout. The vector has as many
    slots as there are levels but holds one at most, and carries its length as an assembler expects it. Small
    tables of levels are broadcast; for others rows move by their level, and missing ones stay where they are.
    """
    size = F.sum(F.length(F.col("level").cast("string")) + 24)
    row = levels.agg(F.count(F.lit(1)).alias("n"), F.coalesce(size, F.lit(0)).alias("bytes")).first()
    slots, small = row["n"], row["bytes"] <= BROADCAST_BYTES
    renamed = levels.select(F.col("level").alias("__level"), F.col("index").cast("int").alias("__index"))
    joined = df.join(F.broadcast(renamed) if small else renamed, F.col(column) == F.col("__level"), "left")
    held = F.col("__index").isNotNull()
    no_slots, no_values = F.array().cast("array<int>"), F.array().cast("array<double>")
    sparse = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(slots).cast("int").alias("size"),
        F.when(held, F.array("__index")).otherwise(no_slots).alias("indices"),
        F.when(held, F.array(F.lit(1.0))).otherwise(no_values).alias("values"),
    )
    # The only way without Python from the fields of a vector to the type itself.
    vector = F.from_json(F.to_json(F.struct(sparse.alias("v"))), StructType([StructField("v", VectorUDT())]))["v"]
    described = vector.alias(out, metadata={"ml_attr": {"num_attrs": slots}})
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], described)


def one_hot(df: DataFrame, column: str, levels: Sequence[str], prefix: str) -> DataFrame:
    """One 0/1 column per level; unseen and missing values get zeros throughout."""
    hot = {
        f"{prefix}_{level}": F.coalesce((F.col(column) == level).cast("int"), F.lit(0))
        for level in levels
    }
    return df.withColumns(hot)


def ordinal(column: Column, categories: Sequence[str], strict: bool = True) -> Column:
    """Position of a value in ``categories``; an unknown one fails, or is NULL if not strict."""
    listed = F.array(*[F.lit(c) for c in categories])
    found = F.array_position(listed, column) - 1
    unknown = (
        F.raise_error(F.concat(F.lit("unknown category: "), F.coalesce(column, F.lit("NULL"))))
        if strict
        else F.lit(None)
    )
    return F.when(found >= 0, found.cast("int")).otherwise(unknown.cast("int"))


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_scaled = (x - mean) / population deviation``; 0 where all values agree."""
    fitted = df.agg(
        F.struct(
            *[
                F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("dev")).alias(c)
                for c in columns
            ]
        ).alias("fit")
    ).scalar()
    scaled = df.withColumn("__fit", fitted)
    for c in columns:
        mean, dev = F.col(f"__fit.{c}.mean"), F.col(f"__fit.{c}.dev")
        spread = F.when(dev == 0, F.lit(1.0)).otherwise(dev)
        scaled = scaled.withColumn(f"{c}_scaled", (F.col(c) - mean) / spread)
    return scaled.drop("__fit")


def feature_pipeline(
    passthrough: Sequence[str],
    one_hot_columns: Mapping[str, str] = ONE_HOT,
    ordinal_columns: Mapping[str, tuple[str, Sequence[str]]] = ORDINAL,
    scaler: str | None = None,
) -> Pipeline:
    """Unfitted encoder into ``features``: one-hot, ordinal, then the remaining columns.

    The indexer keeps one extra slot for unseen and missing values and the encoder drops exactly
    that slot, so such rows become all zeros. The mappings give each encoded column the prefix of
    its feature names, and the ordered categories of the ordinal ones. ``scaler`` is ``"standard"``, ``"robust"`` or None.
    """
    stages = []
    inputs = []
    for column, prefix in one_hot_columns.items():
        index, vector = f"{column}__index", f"{prefix}__{column}"
        stages.append(
            StringIndexer(
                inputCol=column,
                outputCol=index,
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
        stages.append(OneHotEncoder(inputCol=index, outputCol=vector, dropLast=True))
        inputs.append(vector)
    for column, (prefix, categories) in ordinal_columns.items():
        cases = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(categories))
        statement = (
            f"SELECT *, CASE {column} {cases} "
            f"ELSE raise_error(concat('unknown {column}: ', coalesce({column}, 'NULL'))) END "
            f"AS {prefix}__{column} FROM __THIS__"
        )
        stages.append(SQLTransformer(statement=statement))
        inputs.append(f"{prefix}__{column}")
    inputs += passthrough
    raw = "features" if scaler is None else "features__raw"
    stages.append(VectorAssembler(inputCols=inputs, outputCol=raw, handleInvalid="keep"))
    if scaler == "standard":
        stages.append(
            StandardScaler(inputCol=raw, outputCol="features", withMean=True, withStd=True)
        )
    elif scaler == "robust":
        stages.append(RobustScaler(inputCol=raw, outputCol="features", withCentering=True))
    elif scaler is not None:
        raise ValueError(f"unknown scaler: {scaler}")
    return Pipeline(stages=stages)


def feature_names(encoder: PipelineModel, encoded: DataFrame) -> list[str]:
    """Names of the feature slots in vector order: ``prefix__column_level`` for one-hot slots,
    ``prefix__column`` for the others."""
    assembler = next(s for s in encoder.stages if isinstance(s, VectorAssembler))
    metadata = encoded.schema[assembler.getOutputCol()].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in metadata.values() for a in kind)
    return [name if "__" in name else f"{REMAINDER}__{name}" for _, name in slots]


def feature_count(encoded: DataFrame, column: str = "features") -> int:
    """Length of a feature vector, from its metadata or, failing that, from one row."""
    described = encoded.schema[column].metadata.get("ml_attr", {})
    if "num_attrs" in described:
        return described["num_attrs"]
    if "attrs" in described:
        return sum(len(kind) for kind in described["attrs"].values())
    return len(encoded.select(column).first()[0])
