import random

import numpy as np
import pytest

from larkspur.llm import private
from tests.llm.brute import base_spans

PIECES = ["a", "b.", "@", "1", "23", "4.", "5 ", "-", "+", " ", "(", ")", "x@y.z", "1.2.3.4", "é", "\n", "4539578763621486", "+1 234 567 890", "256"]


@pytest.fixture(scope="module")
def weights(spark):
    return private.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_strict_spans_equal_brute_force():
    random.seed(5)
    for _ in range(20_000):
        text = "".join(random.choice(PIECES) for _ in range(random.randint(0, 16)))
        found = sorted((k, a, b) for k, a, b, good in private.strict_spans(text) if good)
        assert found == sorted(base_spans(text)), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@a" * 50_000, "+1" + " " * 200_000, "1.2." * 50_000):
        found = sorted((k, a, b) for k, a, b, good in private.strict_spans(text) if good)
        if len(text) < 120_000:
            assert found == sorted(base_spans(text))


def test_numbers_after_each_other_are_told_apart(weights):
    text = "call +1 (269) 555-3296 4539578763621486 or 4539578763621486 27.65.93.188"
    found = {(private.KINDS[k], text[a:b]) for k, a, b, _ in private.spans_of(text, np.array(weights))}
    assert found == {("phone", "+1 (269) 555-3296"), ("card", "4539578763621486"), ("ip", "27.65.93.188")}


def test_hidden_addresses_are_added_and_plain_numbers_are_not(weights):
    w = np.array(weights)
    text = "mail john.doe [at] mail [dot] com please"
    assert [text[a:b] for _, a, b, _ in private.spans_of(text, w)] == ["john.doe [at] mail [dot] com"]
    clean = "On 2024-01-02 order 123-456-7890 came, version 1.2.3, page 55, 4539578763621487 is no card, look at this"
    assert private.spans_of(clean, w) == []


def test_all_hidden_addresses_of_a_line_are_found_whole():
    long = "a" * 100 + " [at] " + "b" * 100 + ".com"
    cases = {
        "write to john [at] acme [dot] com or jane [at] acme [dot] com": ["john [at] acme [dot] com", "jane [at] acme [dot] com"],
        "a(at)b.de, c.d (at) e dot org; f [At] g [Dot] net": ["a(at)b.de", "c.d (at) e dot org", "f [At] g [Dot] net"],
        "x {AT} y {DOT} com and look at acme.com": ["x {AT} y {DOT} com"],
        "to " + long + " now": [long],
    }
    for text, expected in cases.items():
        for line in (text, "é\n" + text + "\nend"):
            assert [line[a:b] for k, a, b in private.loose_spans(line) if k == 0] == expected
    marks = "a [at] " * 30_000 + "a" * 200_000 + " dot a" * 30_000
    assert [marks[a : a + 8] for _, a, _ in private.loose_spans(marks)] == ["a [at] a"]


def test_reliabilities_order_good_and_bad_labelers():
    patterns = np.array([[0, 0, 0, 1, 1, 1, 1], [0, 2, 0, -1, -1, 1, -1], [0, 2, 0, 1, 1, -1, 1], [0, 2, 0, -1, -1, -1, -1]])
    posterior, tables = private.reliabilities(patterns, np.array([50.0, 50.0, 50.0, 50.0]))
    assert (posterior > 0.5).tolist() == [True, False, True, False]
    assert tables[0, 1, 2] > 0.9 > 0.7 > tables[2, 1, 2]


def test_rows(documents, weights, spark):
    texts = [None, "", "me@x.org", "me@x.org", "é +49 30 1234567 b@c.de", "clean " * 200_000]
    docs = documents(texts, ids=[0, 1, 2, 2, None, 5]).withColumnRenamed("lang", "spans")
    rows = sorted(map(tuple, private.digests(private.find_private(docs, weights)).collect()), key=repr)
    assert [(r[0], r[1], r[4], r[6]) for r in rows] == [
        (0, 0, 0, ""), (1, 0, 0, ""), (2, 1, 0, "email:0:8"), (2, 1, 0, "email:0:8"), (5, 0, 0, ""), (None, 1, 1, "email:17:23,phone:2:16"),
    ]
    masked = {r["doc_id"]: (r["text"], r["n_chars"], r["spans"]) for r in private.redact(docs, weights).collect()}
    assert masked[None] == ("é [PHONE] [EMAIL]", 17, None) and masked[0] == (None, None, None) and masked[5][0] == texts[5]
    assert private.redact(documents([]), weights).count() == 0
    assert private.find_private(documents([]), weights).count() == 0


def test_nothing_learned_adds_nothing(documents):
    weights = private.learn(documents(["no data here", None]))
    assert set(weights) == {0.0}
    assert [s[3] for s in private.spans_of("a@b.co jane [at] x [dot] org", np.array(weights))] == [True]


def test_dense_long_texts_take_linear_time():
    import time

    line = "write to a.b{0}@example.org or jane{0} [at] acme [dot] com, call 0171 555 {0} or +49 171 5550{0}, from 10.0.0.1\n"
    text = "".join(line.format(1000 + i) for i in range(9_000))  # about a megabyte
    start = time.perf_counter()
    found = private.candidates(text)
    spans = private.spans_of(text, np.zeros(len(private._features(np.zeros((1, 3 + private.LABELERS), int))[0])))
    assert time.perf_counter() - start < 30
    assert len(found) > 30_000 and len(spans) >= 27_000


def test_taken_spans():
    taken = private.Taken([(5, 9), (1, 3), (8, 12), (20, 21)])
    met = {(a, b) for a in range(24) for b in range(a + 1, 25) if taken.meets(a, b)}
    assert met == {(a, b) for a in range(24) for b in range(a + 1, 25) if any(a < y and x < b for x, y in [(5, 9), (1, 3), (8, 12), (20, 21)])}
    taken.add(14, 16)
    assert taken.meets(15, 18) and not taken.meets(12, 14)


def test_calling_codes():
    assert [private._gazetteer(3, f"+{code} 555 0100 22") for code in ("52", "60", "95", "234", "1", "380", "28", "89", "0")] == [1] * 6 + [-1] * 3
