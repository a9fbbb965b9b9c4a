import random
from collections import defaultdict

import pytest

from larkspur.llm import packing
from larkspur.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def slow():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary_path())
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def test_differencing_is_near_equal_and_whole():
    random.seed(1)
    for _ in range(50):
        sizes = [random.randint(1, 256) for _ in range(random.randint(1, 300))]
        dealt = packing.windows_of(sizes, 2048)
        assert sorted(i for w in dealt for i in w) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in w) for w in dealt]
        assert max(sums) <= 2048
        if len(sizes) > 8 * len(dealt):
            assert max(sums) - min(sums) < 256


def test_windows_rise_where_pieces_do_not_fit():
    assert len(packing.windows_of([1500] * 4, 2048)) == 4
    assert packing.windows_of([2048], 2048) == [[0]]


def test_encoder_equals_the_library(slow):
    texts = ["", " a  b\n\n c", "Ünïcode 😀 naïve", "<|endoftext|> x", "!!!  ???", "a" * 5000, " " * 3000, "don't we'll 123 456"]
    encode = packing.encoder(vocabulary_path(), special=True)
    assert [encode(t) for t in texts] == [slow(t) for t in texts]
    assert encode("a <|endoftext|> b") == [64, 220, 50256, 275]
    assert 50256 not in packing.encoder(vocabulary_path())("a <|endoftext|> b")


def test_every_id_lies_in_one_piece(documents, slow):
    texts = [None, "", "one <|endoftext|>two", "two words", "same", "same", "long text here " * 3000, *[f"some words {i} " * (i % 40) for i in range(120)]]
    docs = documents(texts, ids=[*range(5), 4, *range(6, len(texts))]).withColumnRenamed("lang", "length")
    rows = packing.pack_documents(docs, vocabulary_path(), group=32).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) > 0
        by_doc[r["doc_id"]].append((r["start"], r["ids"], r["doc_tokens"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids = [*slow(text), 1]
        if i in (4, 5):  # one id, two rows
            assert sorted(p[1] for p in by_doc[4]) == [ids, ids]
            continue
        parts = sorted(by_doc[i])
        assert [x for _, part, _ in parts for x in part] == ids
        assert all(n == len(ids) for *_, n in parts)
        assert [s for s, *_ in parts] == [sum(len(p[1]) for p in parts[:k]) for k in range(len(parts))]
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(documents([]), vocabulary_path()).count() == 0


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack_documents(docs.coalesce(1), vocabulary_path()).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in rows) > 0.96 * 2048 * len(rows)
