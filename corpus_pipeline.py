"""A training corpus from documents: language, near copies, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as
the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import jaccard, language, mixing, packing, private
from larkspur.llm.common import stored
from larkspur.llm.queries import vocabulary_path
from larkspur.session import ship_package

#: Near copies: word shingles and the similarity from which documents link.
SHINGLE_WORDS = 5
SIMILARITY = (80, 100)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin. Labels are those of ``docs`` itself.

    Texts that are NULL or have no letter, and ties between languages, go; so do all documents where no
    row has a label to learn from. Documents keep their ``lang``. Rows are judged by their text, so rows
    without an id or with a repeated one are no different.
    """
    ship_package(spark)
    learned = language.learn_dictionaries(docs.where(~language.held_out()))
    return language.keep_accepted(docs, learned)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies; of rows with one id and text, one.

    Documents without words are nobody's copies: all stay, as do rows without an id whose text is unique.
    """
    ship_package(spark)
    return jaccard.keep_one_of_each(docs, width=SHINGLE_WORDS, threshold=SIMILARITY)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets and n_chars counted anew."""
    ship_package(spark)
    return private.redact(docs, private.learn(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources have equal weight, in random order; as many as before, expected."""
    ship_package(spark)
    return mixing.mix_sources(docs).drop("copy")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 2048, as in ``op2_pack_sequences``, with their ids."""
    ship_package(spark)
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("language", keep_identified),
    ("near_copies", one_of_each_group),
    ("private", mask_private),
    ("mixture", mix_sources),
    ("packing", pack),
]

#: Compression, expectation-maximisation and tokenizers are beyond SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the corpus in ``sf_dir``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
