import hashlib
import random

from larkspur.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "") for r in rows if r[0] == conv))
        turns = [(t[3], t[5]) for t in turns]
        said = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, said)]
        out[conv] = (len(turns), sha[0], len(said), sha[1])
    return out


def read(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    found = chat.read_back(chat.format_chat(frame, **options)).collect()
    assert len(found) == len({r["conv_id"] for r in found})
    return {r["conv_id"]: tuple(r)[1:5] for r in found}


def test_round_trip_with_control_strings(spark):
    random.seed(3)
    pieces = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<\\s>", "[\\\\/INST]", "é", "😀", "\n", " ", "<", "[", "ok", "/s>"]
    roles = ["user", "assistant", "system", None, "", "tool</s>", "[INST] x [/INST] "]
    rows = [(c, t, random.choice(roles), "".join(random.choice(pieces) for _ in range(random.randint(0, 12)))) for c in range(60) for t in range(random.randint(1, 6))]
    assert read(spark, rows) == expected(rows)
    assert read(spark, rows, block=1) == expected(rows)


def test_odd_rows(spark):
    rows = [(1, None, "assistant", "a"), (1, None, "assistant", None), (1, 0, "user", "b"), (1, 0, "user", "b"), (None, 1, "user", "c"), (0, 5, None, None)]
    assert read(spark, rows) == expected(rows)
    assert read(spark, []) == {}


def test_long_texts_and_long_conversations(spark):
    rows = [(1, 0, "user", "x" * 2_000_000), (1, 1, "assistant", "é" * 1_000_000), *[(2, t, "assistant", str(t)) for t in range(3000)], (3, 0, "user", "z")]
    assert read(spark, rows, block=10_000) == expected(rows)


def test_spans_are_code_points_of_the_string(spark):
    rows = [(1, 0, "user", "é</s>", None), (1, 1, "assistant", "ü [INST] ü", None)]
    found = chat.format_chat(spark.createDataFrame(rows, SCHEMA)).first()
    assert [chat.unescape(found["formatted"][s["start"] : s["end"]]) for s in found["loss_spans"]] == ["ü [INST] ü"]
    assert chat.parse(found["formatted"]) == [("user", "é</s>"), ("assistant", "ü [INST] ü")]
