import random

import pytest

from larkspur.llm import debruijn
from tests.llm import brute

COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def cleaned(df, **options):
    return sorted((tuple(r) for r in debruijn.remove_repeats(df, **options).select(*COLUMNS).collect()), key=repr)


def test_query_equals_brute_force(spark):
    from larkspur.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_repeated_windows"](spark, folder).collect())
    assert found == sorted(brute.kept_words(docs, 20))
    assert sum(r[2] for r in found) > 0


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize(("length", "gram"), [(4, 2), (3, 3), (5, 1)])
def test_few_words_nulls_and_repeated_ids(spark, monkeypatch, length, gram, large):
    if large:  # every anchor and path goes the way of large ones
        monkeypatch.setattr(debruijn, "LARGE", 1)
        monkeypatch.setattr(debruijn, "SHARE", 0.0)
        monkeypatch.setattr(debruijn, "LOOK", 1)
    draw = random.Random(length)
    texts = [None, "", " \t", "a", *[" ".join(draw.choice("abcd") for _ in range(draw.randint(1, 60))) for _ in range(60)]]
    docs = [(draw.choice([None, 1, 2, 3, i]), t) for i, t in enumerate(texts)]
    docs += docs[:9]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, path string, start int")
    assert cleaned(df, length=length, gram=gram) == sorted(brute.kept_words(docs, length), key=repr)


def test_blanks_other_letters_and_one_long_text(documents):
    passage = " ".join(f"wört{i}" for i in range(40))
    texts = [passage, f"x\n{passage}\ty", f"vor\xa0ne {passage.replace(' ', chr(12))} 😀", "na " * 30_000, "z " + "na " * 25]
    docs = documents(texts)
    rows = sorted(map(tuple, debruijn.remove_repeats(docs).select(*COLUMNS).collect()))
    assert rows == brute.kept_words(list(enumerate(texts)), 20)
    assert rows[3][2] == 29_999  # a repetition of itself; its first word is covered by the first window only


def test_spans_name_their_sources(documents):
    passage = " ".join(f"p{i}" for i in range(90))
    texts = ["a b c " + passage, "q " + passage + " r", "s t " + " ".join(passage.split()[20:70]) + " u v"]
    rows = {r["doc_id"]: r for r in debruijn.remove_repeats(documents(texts)).collect()}
    assert rows[0]["spans"] == [] and rows[0]["kept_text"] == texts[0]
    assert [tuple(s) for s in rows[1]["spans"]] == [(1, 91, 0, 3)]
    assert [tuple(s) for s in rows[2]["spans"]] == [(2, 52, 0, 23)]
    assert rows[2]["kept_text"] == "s t u v"


def test_empty_table_and_bounds(documents):
    assert debruijn.remove_repeats(documents([])).count() == 0
    with pytest.raises(ValueError):
        debruijn.remove_repeats(documents([]), length=3, gram=4)
