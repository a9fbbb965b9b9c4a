"""Messages in, replies out: drop automated senders, match the command, one row per attachment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.markup import background_url, first_attribute
from larkspur.functions.selectors import first_selected

# The commands, their reply texts, which menus each reply carries, and the element
# classes that hold a menu's picture.
REPLIES = [
    ("!17차메뉴", "🍽️ 오늘의 17차 메뉴", ["17"]),
    ("!18차메뉴", "🍽️ 오늘의 18차 메뉴", ["18"]),
    ("!점심", "🍽️ 오늘의 점심 메뉴", ["17", "18"]),
    (
        "!도움말",
        "사용 가능한 명령어:\n"
        "      !17차메뉴 - 17차 메뉴 이미지 제공\n"
        "      !18차메뉴 - 18차 메뉴 이미지 제공\n"
        "      !점심 - 17차 및 18차 메뉴 이미지 제공\n"
        "      !도움말 - 사용 가능한 명령어 목록 표시",
        [],
    ),
]
THUMBNAIL = "button.btn_thumb .img_thumb"
BACKGROUND_CLASS = "wrap_fit_thumb"


def menu_picture(html: Column) -> Column:
    """URL of a menu page's picture: the image inside a thumbnail button, else a background image; NULL if none."""
    style = first_attribute(html, "div", "style", BACKGROUND_CLASS)
    return F.coalesce(first_selected(html, THUMBNAIL, "src"), background_url(style))


def menu_replies(pages: DataFrame) -> DataFrame:
    """The reply table ``command, reply, attachments`` over menu pages ``menu, html``.

    A page that failed to load, or holds no picture, leaves its place in the list NULL.
    """
    spark = pages.sparkSession
    schema = "command string, reply string, menus array<string>"
    known = spark.createDataFrame(REPLIES, schema)
    wanted = known.select("command", "reply", F.posexplode_outer("menus").alias("place", "menu"))
    pictures = pages.select("menu", menu_picture(F.col("html")).alias("picture"))
    entry = F.when(F.col("place").isNotNull(), F.struct("place", "picture"))
    return (
        wanted.join(pictures, "menu", "left")
        .groupBy("command", "reply")
        .agg(F.sort_array(F.collect_list(entry)).alias("e"))
        .select("command", "reply", F.col("e.picture").alias("attachments"))
    )


def human_messages(messages: DataFrame) -> DataFrame:
    return messages.where(~F.col("is_bot"))


def route(messages: DataFrame, replies: DataFrame, *keep: str) -> DataFrame:
    """Replies to ``messages`` (a stream or a table): ``keep, command, reply, attachment``.

    Unknown content finds no reply and vanishes. A reply without attachments is one row. Spark
    broadcasts the reply table by its measured size, and shuffles both sides if it is large.
    """
    matched = human_messages(messages).join(replies, F.col("content") == F.col("command"))
    return matched.select(*keep, "command", "reply", F.explode_outer("attachments").alias("attachment"))


def read_message_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Files as a message stream, with a fixed schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def send_available(replies: DataFrame, sink: str, checkpoint: str) -> None:
    """Write the replies to all messages there are, as parquet, each exactly once."""
    query = (
        replies.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()


def send_with_fresh_replies(
    messages: DataFrame,
    load_replies: Callable[[SparkSession], DataFrame],
    sink: str,
    checkpoint: str,
    *keep: str,
) -> None:
    """Look the replies up anew for every batch of messages, then write that batch.

    Each batch owns one folder that a repeated attempt overwrites, so no reply is sent twice.
    """

    def send(batch: DataFrame, batch_id: int) -> None:
        replies = route(batch, load_replies(batch.sparkSession), *keep)
        replies.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    query = (
        messages.writeStream.foreachBatch(send)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
