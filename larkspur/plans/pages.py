"""Page, document and round-trip queries over ``pages``, ``events`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import markup, selectors
from larkspur.operators import corpus
from larkspur.plans import retrieval, scoring
from larkspur.plans.churn import CHURN_SQL, churn_view
from larkspur.plans.registry import query
from larkspur.session import fresh_folder, spread
from larkspur.sources import collections, documents, schemas, store, tables
from larkspur.sources.tables import table

ARTICLE_SQL = "nullif(regexp_extract(html, '<article>.*?</article>', 0, 's'), '')"
TEXT_OF = "regexp_replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g')"
TITLE_SQL = "nullif(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), '')"


def _article(html="html"):
    return markup.region_between(F.col(html), "<article>", "</article>")


def _title(html="html"):
    return markup.empty_to_null(F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1))


@query("page_scan", "SELECT page_id, url, length(html) AS chars FROM pages")
def page_scan(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", "url", F.char_length("html").cast("long").alias("chars")
    )


@query("article_region", f"SELECT page_id, {ARTICLE_SQL} AS region FROM pages")
def article_region(spark, folder):
    return table(spark, folder, "pages").select("page_id", _article().alias("region"))


COMMENT_SQL = "regexp_extract(html, '<!--\\s*ad \\d+\\s*-->.*?</div>', 0, 's')"


@query("marked_region", f"SELECT page_id, nullif({COMMENT_SQL}, '') AS region FROM pages")
def marked_region(spark, folder):
    region = markup.region_between(F.col("html"), r"<!--\s*ad \d+\s*-->", "</div>")
    return table(spark, folder, "pages").select("page_id", region.alias("region"))


@query(
    "article_paragraphs",
    f"""WITH p AS (SELECT page_id, regexp_extract_all({ARTICLE_SQL}, '<p(?:\\s[^>]*)?>(.*?)</p>', 1, 's')
        AS blocks FROM pages)
    SELECT page_id, CAST(unnest(range(len(blocks))) AS INTEGER) AS seq,
           unnest(list_transform(blocks, lambda b: {TEXT_OF.format('b')})) AS paragraph FROM p""",
)
def article_paragraphs(spark, folder):
    each = F.posexplode_outer(markup.flat_blocks(_article(), "p")).alias("seq", "block")
    blocks = table(spark, folder, "pages").select("page_id", each)
    return blocks.where(F.col("seq").isNotNull()).select("page_id", "seq", markup.inner_text(F.col("block")).alias("paragraph"))


@query(
    "class_blocks",
    """WITH b AS (SELECT page_id, regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1) AS blocks
        FROM pages)
    SELECT page_id, CAST(unnest(range(len(blocks))) AS INTEGER) AS seq,
        unnest(list_transform(blocks, lambda t: trim(replace(replace(replace(replace(replace(t,
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&')))) AS block FROM b""",
)
def class_blocks(spark, folder):
    blocks = markup.class_blocks(F.col("html"), "ad", None)
    pages = spread(table(spark, folder, "pages").select("page_id", "html"), "page_id")
    each = pages.select("page_id", F.posexplode_outer(blocks).alias("seq", "block"))
    return each.where(F.col("seq").isNotNull())


HEAD_SQL = "regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)"


@query(
    "class_blocks_with_child",
    f"""SELECT page_id, trim(replace(replace(replace(replace(replace({HEAD_SQL},
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&')) || '-' AS block
    FROM pages WHERE regexp_matches(html, '<h1[^>]*>[^<]*</h1>')""",
)
def class_blocks_with_child(spark, folder):
    """Each page's headline once in a block that holds the child class and once in one that doesn't."""
    cards = '<div class="card x">\n<div class="words"> $1 </div> - </div><div class="card">$1</div>'
    framed = F.regexp_replace("html", r"<h1[^>]*>([^<]*)</h1>", cards)
    pages = spread(table(spark, folder, "pages").select("page_id", "html"), "page_id")
    blocks = markup.class_blocks(framed, "card", "words")
    return pages.select("page_id", F.explode_outer(blocks).alias("block")).where(F.col("block").isNotNull())


NAV_LINKS = "regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a href=\"([^\"]*)\">', 1)"


@query("navigation_links", f"SELECT page_id, unnest({NAV_LINKS}) AS link FROM pages")
def navigation_links(spark, folder):
    """Addresses in the menus of the pages, and of no other links: child and descendant steps."""
    pages = spread(table(spark, folder, "pages").select("page_id", "html"), "page_id")
    links = selectors.select_attribute(F.col("html"), "body > nav li > a[href]", "href")
    return pages.select("page_id", F.explode_outer(links).alias("link")).where(F.col("link").isNotNull())


@query("thumbnail_pictures", "SELECT page_id, url AS picture FROM pages")
def thumbnail_pictures(spark, folder):
    """Each page with images of the thumbnail class before, inside and after the button: only the one inside is its picture."""
    image = F.format_string('<img class="x img_thumb" src="%s">', "url")
    other = F.lit('<div><img class="img_thumb" src="/other.png"></div><button class="btn"><img class="img_thumb" src="/no.png"></button>')
    button = F.concat(F.lit('<button class="big btn_thumb"><span><b>'), image, F.lit("</b></span></button>"))
    framed = F.concat(other, F.col("html"), button, other)
    pages = spread(table(spark, folder, "pages").select("page_id", "url", "html"), "page_id")
    return pages.select("page_id", selectors.first_selected(framed, "button.btn_thumb .img_thumb", "src").alias("picture"))


@query("background_urls", "SELECT page_id, url AS picture FROM pages")
def background_urls(spark, folder):
    """The address of each page as a CSS background, in the three ways of quoting."""
    quote = F.get(F.array(F.lit(""), F.lit("'"), F.lit('"')), (F.col("page_id") % 3).cast("int"))
    style = F.concat(F.lit("color: red; background-image: url("), quote, F.col("url"), quote, F.lit("); margin: 0"))
    return table(spark, folder, "pages").select("page_id", markup.background_url(style).alias("picture"))


FIRST_LINK_SQL = "nullif(regexp_extract(html, '<a\\b[^>]*\\shref=\"([^\"]*)\"', 1), '')"
IMAGE_SQL = "nullif(regexp_extract(html, '<img\\b[^>]*\\ssrc=\"([^\"]*)\"', 1), '')"


@query(
    "page_status",
    f"""SELECT page_id, {FIRST_LINK_SQL} AS link, {IMAGE_SQL} AS picture,
    CASE WHEN html IS NULL THEN 'failed' WHEN {IMAGE_SQL} IS NULL THEN 'no picture' ELSE 'ok' END
    AS status FROM pages""",
)
def page_status(spark, folder):
    html = F.col("html")
    picture = markup.first_attribute(html, "img", "src")
    status = F.when(html.isNull(), "failed").when(picture.isNull(), "no picture").otherwise("ok")
    return table(spark, folder, "pages").select(
        "page_id",
        markup.first_attribute(html, "a", "href").alias("link"),
        picture.alias("picture"),
        status.alias("status"),
    )


def titled_pages(spark, folder):
    return table(spark, folder, "pages").select("page_id", "url", _title().alias("title"), "html")


@query(
    "latest_page_per_title",
    f"""SELECT page_id, url, title FROM (SELECT page_id, url, {TITLE_SQL} AS title FROM pages)
    QUALIFY row_number() OVER (PARTITION BY title ORDER BY page_id DESC) = 1""",
)
def latest_page_per_title(spark, folder):
    pages = titled_pages(spark, folder).select("page_id", "url", "title")
    return documents.latest_per_key(pages, "title", "page_id")


@query(
    "page_documents",
    f"""WITH latest AS (SELECT * FROM (SELECT page_id, url, {TITLE_SQL} AS title, html FROM pages)
        QUALIFY row_number() OVER (PARTITION BY title ORDER BY page_id DESC) = 1),
    p AS (SELECT title, url, list_transform(
            regexp_extract_all({ARTICLE_SQL}, '<p(?:\\s[^>]*)?>(.*?)</p>', 1, 's'),
            lambda b: {TEXT_OF.format('b')}) AS contents FROM latest)
    SELECT title, url, CAST(len(contents) AS INTEGER) AS n_contents,
           array_to_string(contents, chr(10)) AS body FROM p""",
)
def page_documents(spark, folder):
    """Pages to law documents, through the JSON sink and back."""
    latest = documents.latest_per_key(titled_pages(spark, folder), "title", "page_id")
    contents = F.transform(markup.flat_blocks(_article(), "p"), markup.inner_text)
    path = fresh_folder(spark, "documents")
    documents.write_documents(latest.select("title", contents.alias("contents"), "url"), path)
    stored = spark.read.schema(schemas.LAW_DOCUMENT).json(path)
    return stored.select(
        "title",
        "url",
        F.size("contents").alias("n_contents"),
        F.array_join("contents", "\n").alias("body"),
    )


@query(
    "validated_events",
    """SELECT event_id, CASE WHEN NOT json_valid(props) THEN 'broken'
        WHEN json_type(props, '$.k') IS NULL THEN 'k missing'
        WHEN json_type(props, '$.k') NOT IN ('UBIGINT', 'BIGINT') THEN 'k wrong type' END AS as_number,
    CASE WHEN NOT json_valid(props) THEN 'broken' WHEN json_type(props, '$.k') IS NULL THEN 'k missing'
        WHEN json_type(props, '$.k') <> 'VARCHAR' THEN 'k wrong type' END AS as_text,
    CASE WHEN NOT json_valid(props) THEN 'broken' WHEN json_type(props, '$.z') IS NULL THEN 'z missing' END
        AS other_field FROM events""",
)
def validated_events(spark, folder):
    props = F.col("props")
    return table(spark, folder, "events").select(
        "event_id",
        documents.rejected_reason(props, {"k": "BIGINT"}).alias("as_number"),
        documents.rejected_reason(props, {"k": "STRING"}).alias("as_text"),
        documents.rejected_reason(props, {"z": "STRING"}).alias("other_field"),
    )


@query(
    "conversation_questions",
    """SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer FROM conversations q
    JOIN conversations a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
    WHERE q.role = 'user' AND a.role = 'assistant'""",
)
def conversation_questions(spark, folder):
    return tables.conversation_questions(table(spark, folder, "conversations"))


@query(
    "question_list",
    """SELECT q.text AS question FROM conversations q
    JOIN conversations a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
    WHERE q.role = 'user' AND a.role = 'assistant'""",
)
def question_list(spark, folder):
    return tables.questions_of(conversation_questions(spark, folder))


@query(
    "scores_through_csv",
    scoring.SCORES_SQL + "SELECT row_id, round(score, 6) AS score FROM scores",
)
def scores_through_csv(spark, folder):
    """Score column through the CSV sink and back, kept with its row key."""
    path = fresh_folder(spark, "scores")
    tables.write_scores(scoring.label_scores(spark, folder), path)
    return tables.read_scores(spark, path).withColumn("score", F.round("score", 6))


@query(
    "stored_collection",
    retrieval.CHUNKS_SQL
    + f""", words AS (SELECT doc_id * 1000000 + seq AS chunk_id,
        unnest({retrieval.tokens_sql('content')}) AS term FROM chunks),
    sparse AS (SELECT chunk_id, count(DISTINCT term) AS n_terms, count(*) AS n_tokens
        FROM words GROUP BY chunk_id)
    SELECT file_name, seq, n_terms, n_tokens FROM chunks JOIN sparse
    ON chunk_id = doc_id * 1000000 + seq WHERE seq BETWEEN 0 AND 1""",
)
def stored_collection(spark, folder):
    """Create a collection of chunks and sparse vectors, attach to it and read by position."""
    path = fresh_folder(spark, "collection")
    key = corpus.chunk_id(F.col("doc_id"), F.col("seq"))
    pieces = retrieval.chunks(spark, folder).withColumn("chunk_id", key)
    collections.create_collection(path, pieces, sparse=lambda stored: corpus.sparse_vectors(stored, "chunk_id", "content"))
    picked = corpus.seq_between(collections.open_collection(spark, path), 0, 1)
    vectors = collections.open_collection(spark, path, "sparse")
    sizes = vectors.groupBy("chunk_id").agg(
        F.count("*").alias("n_terms"), F.sum("tf").alias("n_tokens")
    )
    return picked.join(sizes, "chunk_id").select("file_name", "seq", "n_terms", "n_tokens")


@query("customers_through_csv", CHURN_SQL + "SELECT * FROM churn_view")
def customers_through_csv(spark, folder):
    """The stand-in customers written as CSV with a header and scanned with the strict schema."""
    path = fresh_folder(spark, "customers")
    churn_view(spark, folder).select(*schemas.CUSTOMERS.fieldNames()).write.option("header", True).csv(path)
    return tables.read_customers(spark, path)


UPSERTED_SQL = f"""WITH t AS (SELECT page_id, url, {TITLE_SQL} AS title FROM pages),
    e AS (SELECT title, min(page_id) AS a, max(page_id) AS b FROM t WHERE title IS NOT NULL GROUP BY title)
    SELECT e.title, url, CAST(2 AS INTEGER) AS n_contents FROM e
    JOIN t ON page_id = CASE WHEN b % 2 = 1 THEN b ELSE a END"""


def _versions(spark, folder):
    """The first version of every title, and the last of some."""
    pages = table(spark, folder, "pages").select("page_id", "url", _title().alias("title")).where("title IS NOT NULL")
    ends = pages.groupBy("title").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b"))
    contents = F.array("title", F.lit("a \"quoted\"\nline")).alias("contents")

    def version(place):
        return pages.join(ends.select(F.col(place).alias("page_id")), "page_id", "left_semi").select("title", contents, "url", "page_id")

    return version("a"), version("b").where("page_id % 2 = 1")


@query("documents_upserted", UPSERTED_SQL)
def documents_upserted(spark, folder):
    """First versions of titles written, some replaced by their last, all scanned and validated again."""
    path = fresh_folder(spark, "documents")
    for rows in _versions(spark, folder):
        documents.write_documents(rows, path)
    found = documents.read_documents(spark, path)
    return found.select("title", "url", F.size("contents").alias("n_contents"))


@query("documents_in_store", UPSERTED_SQL)
def documents_in_store(spark, folder):
    """The same through the versioned store; the titles are looked up by their key."""
    path = fresh_folder(spark, "store")
    first, later = _versions(spark, folder)
    store.upsert(first, path, "title")
    store.upsert(later, path, "title")
    found = store.lookup(first.select("title"), path)
    return found.select("title", "url", F.size("contents").alias("n_contents"))
