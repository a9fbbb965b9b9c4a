"""Message routing over ``conversations``, with replies derived from ``conversations`` and ``pages``.

System turns serve as commands. The page of the same number gives a reply its text and attachments.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import markup
from larkspur.plans.pages import FIRST_LINK_SQL, TITLE_SQL
from larkspur.plans.registry import query
from larkspur.session import fresh_folder
from larkspur.sources import schemas
from larkspur.sources.tables import table
from larkspur.streaming import routing


def as_messages(conversations):
    return conversations.select(
        "conv_id", "turn", F.col("text").alias("content"), (F.col("role") == "assistant").alias("is_bot")
    )


def reply_table(spark, folder):
    """``command, reply, attachments``: page URL and first link as two attachments."""
    commands = table(spark, folder, "conversations").where(F.col("role") == "system").select(
        F.col("conv_id").alias("page_id"), F.col("text").alias("command")
    )
    html = F.col("html")
    title = markup.empty_to_null(F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1))
    pages = table(spark, folder, "pages").select(
        "page_id",
        title.alias("reply"),
        F.array("url", markup.first_attribute(html, "a", "href")).alias("attachments"),
    )
    return commands.join(pages, "page_id", "left").drop("page_id")


REPLY_SQL = f"""WITH replies AS (
    SELECT text AS command, {TITLE_SQL} AS reply, unnest([url, {FIRST_LINK_SQL}]) AS attachment
    FROM conversations JOIN pages ON page_id = conv_id WHERE role = 'system'
    UNION ALL SELECT text, NULL, NULL FROM conversations
    WHERE role = 'system' AND conv_id NOT IN (SELECT page_id FROM pages))
SELECT m.conv_id, m.turn, command, reply, attachment
FROM conversations m JOIN replies ON m.text = command WHERE m.role <> 'assistant'"""


@query(
    "human_messages",
    "SELECT conv_id, turn, text AS content FROM conversations WHERE role <> 'assistant'",
)
def human_messages(spark, folder):
    messages = as_messages(table(spark, folder, "conversations"))
    return routing.human_messages(messages).select("conv_id", "turn", "content")


@query("routed_messages", REPLY_SQL)
def routed_messages(spark, folder):
    messages = as_messages(table(spark, folder, "conversations"))
    return routing.route(messages, reply_table(spark, folder), "conv_id", "turn")


def _message_stream(spark, folder):
    path = f"{folder}/conversations*.parquet"
    return as_messages(routing.read_message_stream(spark, path, schemas.CONVERSATIONS))


@query("routed_stream", REPLY_SQL)
def routed_stream(spark, folder):
    replies = routing.route(
        _message_stream(spark, folder), reply_table(spark, folder), "conv_id", "turn"
    )
    sink = fresh_folder(spark, "replies")
    routing.send_available(replies, sink, fresh_folder(spark, "replies-state"))
    return spark.read.schema(replies.schema).parquet(sink)


@query("routed_stream_fresh_replies", REPLY_SQL)
def routed_stream_fresh_replies(spark, folder):
    """As above, but the pages are looked up again for every batch of messages."""
    sink = fresh_folder(spark, "replies")
    routing.send_with_fresh_replies(
        _message_stream(spark, folder),
        lambda session: reply_table(session, folder),
        sink,
        fresh_folder(spark, "replies-state"),
        "conv_id",
        "turn",
    )
    return spark.read.parquet(sink).drop("batch")
