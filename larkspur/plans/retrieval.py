"""Chunking and retrieval queries over ``documents``, ``embeddings`` and ``benchmark``."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.text import sentences
from larkspur.functions.vectors import as_double, mean_vector
from larkspur.operators import answering, corpus, inverted, retrieval, vectorindex
from larkspur.plans.registry import query
from larkspur.session import fresh_folder
from larkspur.sources.tables import table

VECTOR_SIZE = 64


def tokens_sql(text: str) -> str:
    split = rf"regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+')"
    return f"list_filter({split}, lambda t: t <> '')"


def sentences_sql(text: str) -> str:
    split = f"regexp_split_to_array({text}, '[.!?\\n]+')"
    stripped = f"list_transform({split}, lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g'))"
    return f"list_filter({stripped}, lambda s: s <> '')"


# --- documents and chunks ---------------------------------------------------------------------


def law_documents(spark, folder):
    """Documents in the shape of the law files; lines stand for the articles."""
    docs = table(spark, folder, "documents")
    lines = F.array_remove(F.split("text", "\n"), "")
    return docs.select(
        "doc_id",
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("file_name"),
        F.concat_ws("/", "lang", "source", "doc_id").alias("url"),
        F.get(lines, F.lit(0)).alias("title"),
        lines.alias("contents"),
    )


CHUNKS_SQL = """
WITH docs AS (
    SELECT doc_id, concat('doc-', doc_id) AS file_name, concat_ws('/', lang, source, doc_id) AS url,
           list_filter(string_split(text, chr(10)), lambda t: t <> '') AS contents FROM documents
), chunks AS (
    SELECT doc_id, file_name, url, contents[1] AS title,
           CAST(unnest(range(len(contents))) AS INTEGER) AS seq,
           contents[1] || chr(10) || unnest(contents) AS content FROM docs
)
"""


def chunks(spark, folder):
    return corpus.chunk_documents(law_documents(spark, folder), "doc_id")


@query("document_chunks", CHUNKS_SQL + "SELECT file_name, seq, title, content FROM chunks")
def document_chunks(spark, folder):
    return chunks(spark, folder).select("file_name", "seq", "title", "content")


@query(
    "chunk_metadata",
    CHUNKS_SQL + "SELECT content, file_name, url, title, seq FROM chunks",
)
def chunk_metadata(spark, folder):
    return corpus.with_metadata(chunks(spark, folder)).select("content", "metadata.*")


@query(
    "chunks_by_title_token",
    CHUNKS_SQL
    + f"SELECT file_name, seq, title FROM chunks WHERE list_contains({tokens_sql('title')}, 'the')",
)
def chunks_by_title_token(spark, folder):
    found = corpus.title_has_token(chunks(spark, folder), "the")
    return found.select("file_name", "seq", "title")


@query(
    "chunks_by_seq",
    CHUNKS_SQL + "SELECT file_name, seq, content FROM chunks WHERE seq BETWEEN 1 AND 2",
)
def chunks_by_seq(spark, folder):
    return corpus.seq_between(chunks(spark, folder), 1, 2).select("file_name", "seq", "content")


@query(
    "sparse_vectors",
    f"""WITH t AS (SELECT doc_id, {tokens_sql('text')} AS words FROM documents),
    e AS (SELECT doc_id, len(words) AS dl, unnest(words) AS term FROM t)
    SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM e GROUP BY doc_id, term""",
)
def sparse_vectors(spark, folder):
    return corpus.sparse_vectors(table(spark, folder, "documents"), "doc_id")


# --- dense ------------------------------------------------------------------------------------

HITS_SQL = """, ranked AS (
    SELECT query_id, {item}, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {item}) AS INTEGER) AS rank
    FROM scored
)"""

COSINE_SQL = """
scored AS (
    SELECT q.query_id, c.vec_id,
           round(list_cosine_similarity(q.v, c.embedding::DOUBLE[]), 6) AS score
    FROM q, embeddings c
)""" + HITS_SQL.format(item="vec_id")


def _item_vectors(spark, folder):
    """Benchmark questions with the stored vector of the same id."""
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"))
    stored = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("query_id"), as_double(F.col("embedding")).alias("embedding")
    )
    return items.join(stored, "query_id")


def _stored_vectors(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id", as_double(F.col("embedding")).alias("embedding")
    )


@query(
    "cosine_topk",
    "WITH q AS (SELECT item_id AS query_id, embedding::DOUBLE[] AS v FROM benchmark "
    "JOIN embeddings ON vec_id = item_id)," + COSINE_SQL + "SELECT * FROM ranked WHERE rank <= 3",
)
def cosine_topk(spark, folder):
    return retrieval.cosine_topk(
        _item_vectors(spark, folder), _stored_vectors(spark, folder), item_id="vec_id"
    )


@query(
    "cosine_topk_label_means",
    "WITH q AS (SELECT CAST(label AS BIGINT) AS query_id, ["
    + ", ".join(f"avg(embedding[{i + 1}]::DOUBLE)" for i in range(VECTOR_SIZE))
    + "] AS v FROM embeddings GROUP BY label),"
    + COSINE_SQL
    + "SELECT * FROM ranked WHERE rank <= 3",
)
def cosine_topk_label_means(spark, folder):
    vectors = table(spark, folder, "embeddings").withColumn(
        "embedding", as_double(F.col("embedding"))
    )
    means = vectors.groupBy(F.col("label").cast("long").alias("query_id")).agg(
        *mean_vector(F.col("embedding"), VECTOR_SIZE)
    )
    queries = means.select(
        "query_id", F.array(*[F.col(f"m{i}") for i in range(VECTOR_SIZE)]).alias("embedding")
    )
    return retrieval.cosine_topk(queries, _stored_vectors(spark, folder), item_id="vec_id")


# --- sparse -----------------------------------------------------------------------------------


def bm25_sql(queries: str, texts: str, item: str, idf: bool = True) -> str:
    """CTEs from ``queries(query_id, text)`` and ``texts(item, text)`` to ``scored``."""
    rarity = "ln(1 + ((SELECT count(*) FROM lens) - df + 0.5) / (df + 0.5))" if idf else "1.0::DOUBLE"
    return f"""
    words AS (SELECT {item}, {tokens_sql('text')} AS w FROM ({texts})),
    lens AS (SELECT {item}, len(w) AS dl FROM words),
    postings AS (SELECT {item}, term, count(*) AS tf
                 FROM (SELECT {item}, unnest(w) AS term FROM words) GROUP BY ALL),
    dfs AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
    qterms AS (SELECT DISTINCT query_id, unnest({tokens_sql('text')}) AS term FROM ({queries})),
    scored AS (
        SELECT query_id, {item}, round(sum({rarity} * tf * 2.2 /
            (tf + 1.2 * (1 - 0.75 + 0.75 * dl / (SELECT avg(dl) FROM lens)))), 6) AS score
        FROM qterms JOIN postings USING (term) JOIN dfs USING (term) JOIN lens USING ({item})
        GROUP BY query_id, {item}
    )""" + HITS_SQL.format(item=item)


ITEM_SQL = "SELECT item_id AS query_id, text FROM benchmark"
TEXT_SQL = "SELECT doc_id, text FROM documents"


def _items(spark, folder):
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query(
    "bm25_topk",
    "WITH" + bm25_sql(ITEM_SQL, TEXT_SQL, "doc_id") + "SELECT * FROM ranked WHERE rank <= 3",
)
def bm25_topk(spark, folder):
    return retrieval.bm25_topk(_items(spark, folder), table(spark, folder, "documents"))


@query(
    "bm25_topk_without_idf",
    "WITH" + bm25_sql(ITEM_SQL, TEXT_SQL, "doc_id", False) + "SELECT * FROM ranked WHERE rank <= 3",
)
def bm25_topk_without_idf(spark, folder):
    docs = table(spark, folder, "documents")
    return retrieval.bm25_topk(_items(spark, folder), docs, idf=False)


@query(
    "bm25_topk_chunks",
    CHUNKS_SQL
    + ","
    + bm25_sql(ITEM_SQL, "SELECT doc_id * 1000000 + seq AS chunk_id, content AS text FROM chunks", "chunk_id")
    + "SELECT * FROM ranked WHERE rank <= 3",
)
def bm25_topk_chunks(spark, folder):
    pieces = chunks(spark, folder).select(
        corpus.chunk_id(F.col("doc_id"), F.col("seq")).alias("chunk_id"),
        F.col("content").alias("text"),
    )
    return retrieval.bm25_topk(_items(spark, folder), pieces, item_id="chunk_id")


@query(
    "bm25_topk_indexed",
    "WITH" + bm25_sql(ITEM_SQL, TEXT_SQL, "doc_id") + "SELECT * FROM ranked WHERE rank <= 3",
)
def bm25_topk_indexed(spark, folder):
    """The index is stored, and searched block by block."""
    path = fresh_folder(spark, "inverted")
    inverted.build_index(table(spark, folder, "documents"), path, block_texts=256)
    return inverted.search(_items(spark, folder), inverted.open_index(spark, path))


@query(
    "vector_index_all_lists",
    "WITH q AS (SELECT item_id AS query_id, embedding::DOUBLE[] AS v FROM benchmark "
    "JOIN embeddings ON vec_id = item_id)," + COSINE_SQL + "SELECT * FROM ranked WHERE rank <= 3",
)
def vector_index_all_lists(spark, folder):
    """Every list is visited, so the result is that of the exact search."""
    index = vectorindex.build_index(_stored_vectors(spark, folder), fresh_folder(spark, "vectors"))
    return vectorindex.search(_item_vectors(spark, folder), index, probes=len(index.facts["centres"]))


@query(
    "vector_index_recall",
    "SELECT count(*) AS queries, (SELECT count(*) FROM embeddings) AS indexed, true AS recalled FROM benchmark JOIN embeddings ON vec_id = item_id",
)
def vector_index_recall(spark, folder):
    """How many of the exact three nearest a search of the fitted number of lists finds: at least nine in ten."""
    index = vectorindex.build_index(_stored_vectors(spark, folder), fresh_folder(spark, "vectors"))
    queries = _item_vectors(spark, folder)
    found = vectorindex.search(queries, index).select("query_id", "vec_id", F.lit(1).alias("hit"))
    exact = cosine_topk(spark, folder).select("query_id", "vec_id")
    share = F.coalesce(F.sum("hit"), F.lit(0)) / F.count(F.lit(1))
    return exact.join(found, ["query_id", "vec_id"], "left").agg(
        F.count_distinct("query_id").alias("queries"), F.lit(index.facts["vectors"]).cast("long").alias("indexed"), (share >= 0.9).alias("recalled")
    )


# --- hybrid -----------------------------------------------------------------------------------

HYBRID_SQL = (
    "WITH q AS (SELECT item_id AS query_id, embedding::DOUBLE[] AS v FROM benchmark "
    "JOIN embeddings ON vec_id = item_id),"
    + COSINE_SQL.replace("scored", "dense_scored")
    .replace("ranked", "dense_ranked")
    .replace("embeddings c", "(SELECT * FROM embeddings SEMI JOIN documents ON vec_id = doc_id) c")
    + ","
    + bm25_sql(ITEM_SQL, TEXT_SQL, "doc_id")
    + """, fused AS (
        SELECT coalesce(d.query_id, s.query_id) AS query_id, coalesce(vec_id, doc_id) AS doc_id,
               CAST(d.rank AS INTEGER) AS left_rank, CAST(s.rank AS INTEGER) AS right_rank,
               round(coalesce(1.0 / (60 + d.rank), 0) + coalesce(1.0 / (60 + s.rank), 0), 6) AS score
        FROM dense_ranked d
        FULL OUTER JOIN ranked s
        ON d.query_id = s.query_id AND vec_id = doc_id
    ), numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)
        AS INTEGER) AS rank FROM fused)
    SELECT query_id, doc_id, left_rank, right_rank, score, rank FROM numbered WHERE rank <= 3"""
)


@query("hybrid_topk", HYBRID_SQL)
def hybrid_topk(spark, folder):
    stored = _stored_vectors(spark, folder).withColumnRenamed("vec_id", "doc_id")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    queries = _items(spark, folder).join(_item_vectors(spark, folder), "query_id", "left")
    return retrieval.hybrid_topk(queries, docs.join(stored, "doc_id", "left"))


# --- context, prompt, answer ------------------------------------------------------------------

MINIMUM_SCORE = 60.0

ANSWER_SQL = (
    "WITH"
    + bm25_sql(ITEM_SQL, TEXT_SQL, "doc_id")
    + """, hits AS (SELECT ranked.*, text FROM ranked JOIN documents USING (doc_id) WHERE rank <= 3),
    contexts AS (SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS context,
        string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS sources, count(*) AS n
        FROM hits GROUP BY query_id)"""
)


def hits(spark, folder):
    """Ranked hits of the benchmark questions with their texts."""
    docs = table(spark, folder, "documents")
    return answering.with_texts(retrieval.bm25_topk(_items(spark, folder), docs), docs)


@query("context_text", ANSWER_SQL + "SELECT query_id, context FROM contexts")
def context_text(spark, folder):
    return answering.contexts(hits(spark, folder)).select("query_id", "context")


@query(
    "context_list",
    ANSWER_SQL
    + """SELECT query_id, doc_id AS source, CAST(rank - 1 AS INTEGER) AS position, text FROM hits""",
)
def context_list(spark, folder):
    found = answering.contexts(hits(spark, folder))
    pairs = F.posexplode(F.arrays_zip("sources", "contexts")).alias("position", "entry")
    return found.select("query_id", pairs).select(
        "query_id", "position", F.col("entry.sources").alias("source"), F.col("entry.contexts").alias("text")
    )


def _questions(spark, folder):
    return _items(spark, folder).withColumnRenamed("text", "question")


def prompt_sql(context: str, question: str) -> str:
    pieces = answering.PROMPT.replace("'", "''").split("{context}")
    joined = f"' || {context} || '".join(pieces)
    return "'" + joined.replace("{question}", f"' || {question} || '") + "'"


PROMPTS_SQL = (
    ANSWER_SQL
    + f""", prompts AS (SELECT b.item_id AS query_id,
        {prompt_sql("coalesce(context, '')", "b.text")} AS prompt
        FROM benchmark b LEFT JOIN contexts ON b.item_id = query_id)"""
)


@query("prompts", PROMPTS_SQL + "SELECT * FROM prompts")
def prompts(spark, folder):
    found = answering.contexts(hits(spark, folder))
    asked = answering.attach_contexts(_questions(spark, folder), found)
    return answering.add_prompt(asked).select("query_id", "prompt")


@query(
    "answers_with_sources",
    ANSWER_SQL.replace("rank <= 3)", f"rank <= 3 AND score >= {MINIMUM_SCORE})")
    + f""", pieces AS (SELECT query_id, rank, {sentences_sql('text')} AS s FROM hits),
    listed AS (SELECT query_id, rank, unnest(s) AS sentence, unnest(range(len(s))) AS place FROM pieces),
    shares AS (SELECT l.query_id, sentence, rank, place,
        len(list_intersect(list_distinct({tokens_sql('b.text')}), {tokens_sql('sentence')}))
        / len(list_distinct({tokens_sql('b.text')})) AS share
        FROM listed l JOIN benchmark b ON l.query_id = b.item_id),
    best AS (SELECT query_id, sentence FROM shares
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY share DESC, rank, place) = 1)
    SELECT b.item_id AS query_id, coalesce(sources, '') AS sources,
        coalesce(sentence, '{answering.NOTHING_FOUND}') AS response
    FROM benchmark b LEFT JOIN contexts c ON b.item_id = c.query_id
    LEFT JOIN best ON b.item_id = best.query_id""",
)
def answers_with_sources(spark, folder):
    strong = answering.drop_weak_hits(hits(spark, folder), MINIMUM_SCORE)
    asked = answering.attach_contexts(_questions(spark, folder), answering.contexts(strong))
    answered = answering.add_extractive_answer(asked)
    sources = F.coalesce(F.array_join("sources", ","), F.lit(""))
    return answered.select("query_id", sources.alias("sources"), "response")


@query(
    "answers_through_function",
    PROMPTS_SQL + "SELECT query_id, length(prompt) || ' characters read' AS response FROM prompts",
)
def answers_through_function(spark, folder):
    """The answer hook with a batch function in place of a hosted model."""
    found = answering.contexts(hits(spark, folder))
    asked = answering.add_prompt(answering.attach_contexts(_questions(spark, folder), found))
    prompts_only = asked.select("query_id", "question", "prompt")
    return answering.answer_with(
        prompts_only, lambda batch: batch["prompt"].str.len().astype(str) + " characters read"
    ).select("query_id", "response")


@query(
    "benchmark_sentences",
    f"SELECT item_id, unnest({sentences_sql('text')}) AS sentence FROM benchmark",
)
def benchmark_sentences(spark, folder):
    items = table(spark, folder, "benchmark")
    return items.select("item_id", F.explode(sentences(F.col("text"))).alias("sentence"))
