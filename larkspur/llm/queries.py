"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import alignment, chat, debruijn, jaccard, language, merkle, mixing, nearest, packing, pages, private, quality, repeats
from larkspur.llm.common import stored, table
from larkspur.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, folder: function(ship_package(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_extract_pages")
def extract_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(table(spark, folder, "pages"))


def _piece_digests(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The columns of ``op2_pack_sequences``: each piece's CRC in place of its ids."""
    ids = batch.column(3)
    bounds = ids.offsets.to_numpy()
    content = ids.values.to_numpy().astype("<u4")
    crc = [zlib.crc32(content[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    columns = [*(batch.column(i) for i in (0, 1, 2)), pa.array(np.array(crc, np.int64)), *(batch.column(i) for i in (4, 5, 6))]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays(columns, names=names)


@query("op2_pack_sequences")
def pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary_path(), finish=_piece_digests, schema=schema)


@query(
    "op4_mix_sources",
    """WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    rates AS (SELECT source, (1.0 / (SELECT count(*) FROM counts)) * (SELECT sum(n) FROM counts) / n AS rate FROM counts),
    steps AS (
      SELECT source, list(p ORDER BY j) AS steps FROM (
        SELECT source, j, sum(exp(-rate + j * ln(rate) - lgamma(j + 1))) OVER (PARTITION BY source ORDER BY j) AS p
        FROM rates, (SELECT unnest(generate_series(0, 150)) AS j))
      GROUP BY source),
    drawn AS (
      SELECT d.*, steps, (('0x' || substr(md5('42' || chr(31) || CAST(doc_id AS VARCHAR)), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
      FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source),
    counted AS (SELECT *, len(list_filter(steps, lambda p: p <= u)) AS n FROM drawn)
    SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy
    FROM counted, LATERAL (SELECT unnest(generate_series(1, n)) AS copy)""",
)
def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


@query(
    "op5_format_chat",
    r"""WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(i)),
    escaped AS (
      SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + length(role) + 24 AS chars
      FROM turns)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id""",
)
def format_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return chat.read_back(chat.format_chat(turns.unionByName(extra)))


@query("op6_jaccard_join")
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, folder, "documents"), width=3, threshold=(90, 100))


@query("op7_language")
def identify_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    learned = language.learn_dictionaries(docs.where(~language.held_out()))
    found = language.identify(docs, learned)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "margin", "accepted")


@query("op3_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    statistics = stored(quality.word_statistics(table(spark, folder, "documents")), "statistics")
    rules = quality.learn_rules(statistics, table(spark, folder, "labels"))
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judge(statistics, rules).select(*counts, "base_failed", "kept", "rule")


@query("op8_private_data")
def private_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return private.digests(private.find_private(docs, private.learn(docs)))


@query(
    "op9_nearest",
    """WITH points AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, p.vec_id, CAST(list_dot_product(q.v, p.v) AS BIGINT) AS score
      FROM points q JOIN points p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5""",
)
def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query("op10_repeated_strings")
def repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_repeated_windows")
def repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    found = debruijn.remove_repeats(table(spark, folder, "documents"), texts=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", "n_spans")


@query("op12_merkle_manifest", merkle.manifest_sql())
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents")).drop("proof")


@query("op13_align_tokenizers")
def align_tokenizers(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return alignment.align_documents(docs, vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))
