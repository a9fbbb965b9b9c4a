import pytest

from larkspur.streaming import routing

MESSAGES = "id long, content string, is_bot boolean"
SENT = [(1, "!점심", True), (2, "!없음", False), (3, "!17차메뉴", False), (4, "!점심", False), (5, "!도움말", False)]

THUMB = '<button class="btn_thumb"><img src="/17.png" class="img_thumb"></button>'
STYLE = "<div class=\"wrap_fit_thumb\" style=\"background-image: url('/18.png')\"></div>"


@pytest.fixture
def replies(spark):
    pages = spark.createDataFrame([("17", THUMB), ("18", STYLE)], "menu string, html string")
    return routing.menu_replies(pages)


def expected():
    return [
        (3, "!17차메뉴", "/17.png"),
        (4, "!점심", "/17.png"),
        (4, "!점심", "/18.png"),
        (5, "!도움말", None),
    ]


def test_table_routing(spark, replies, collect):
    messages = spark.createDataFrame(SENT, MESSAGES)
    found = routing.route(messages, replies, "id").select("id", "command", "attachment")
    assert collect(found) == expected()


def test_attachment_order_and_help_text(spark, replies):
    by_command = {r["command"]: r for r in replies.collect()}
    assert by_command["!점심"]["attachments"] == ["/17.png", "/18.png"]
    assert by_command["!도움말"]["attachments"] == []
    assert len(by_command["!도움말"]["reply"].splitlines()) == 5


def test_failed_page_leaves_an_empty_place(spark):
    pages = spark.createDataFrame([("17", None), ("18", STYLE)], "menu string, html string")
    by_command = {r["command"]: r["attachments"] for r in routing.menu_replies(pages).collect()}
    assert by_command["!점심"] == [None, "/18.png"] and by_command["!17차메뉴"] == [None]


def write_messages(spark, folder, rows):
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_sends_each_reply_once_over_restarts(spark, tmp_path, replies, collect):
    schema = spark.createDataFrame([], MESSAGES).schema
    folder, sink, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = routing.read_message_stream(spark, str(folder), schema, files_per_batch=1)
        routed = routing.route(stream, replies, "id").select("id", "command", "attachment")
        routing.send_available(routed, sink, state)

    write_messages(spark, folder, SENT[:3])
    run()
    write_messages(spark, folder, SENT[3:])
    run()
    run()
    assert collect(spark.read.parquet(sink)) == expected()


def test_replies_are_looked_up_for_every_batch(spark, tmp_path, collect):
    schema = spark.createDataFrame([], MESSAGES).schema
    folder, sink, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    menu = {"page": THUMB}

    def load(session):
        return routing.menu_replies(session.createDataFrame([("17", menu["page"])], "menu string, html string"))

    def run():
        stream = routing.read_message_stream(spark, str(folder), schema)
        routing.send_with_fresh_replies(stream, load, sink, state, "id")

    write_messages(spark, folder, [(1, "!17차메뉴", False)])
    run()
    menu["page"] = THUMB.replace("/17", "/new")
    write_messages(spark, folder, [(2, "!17차메뉴", False)])
    run()
    found = spark.read.parquet(sink).select("id", "attachment")
    assert collect(found) == [(1, "/17.png"), (2, "/new.png")]
