import random

import numpy as np
import pytest

from larkspur.llm import repeats
from larkspur.llm.suffixes import common_prefixes, suffix_array
from tests.llm.brute import kept_bytes


def test_suffix_arrays_and_common_prefixes():
    random.seed(7)
    for _ in range(600):
        letters = random.choice([1, 2, 3, 10])
        text = [random.randint(1, letters) for _ in range(random.choice([0, 1, 2, 3, 10, 40, 200]))]
        text *= random.choice([1, 1, 3])
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert suffix_array(np.array(text, int)).tolist() == order
        if text:
            shared = common_prefixes(np.array(text, np.uint8), np.array(order), 20)
            for a, b in zip(order, order[1:], strict=False):
                size = 0
                while max(a, b) + size < len(text) and text[a + size] == text[b + size] and size < 20:
                    size += 1
                assert min(int(shared[b]), 20) == size


def passages(seed, count=40):
    random.seed(seed)
    words = [f"w{k}" for k in range(300)] + ["é", "ü😀"]
    make = lambda n: " ".join(random.choice(words) for _ in range(n))
    shared = [make(random.randint(5, 60)) for _ in range(5)]
    texts = ["".join([make(random.randint(0, 40)), random.choice(shared), make(random.randint(0, 10))]) for _ in range(count)]
    return [*texts, texts[0], "", None, "short", "ab" * 400, "ab" * 150 + "c", "x" * 500, shared[0]]


@pytest.mark.parametrize(("length", "gram", "shard"), [(200, 50, 1_000_000), (60, 20, 500), (40, 12, 1)])
def test_equal_to_brute_force(documents, length, gram, shard):
    texts = passages(length)
    docs = documents(texts).withColumnRenamed("lang", "key").withColumnRenamed("source", "spans")
    found = repeats.remove_repeats(docs, length=length, gram=gram, shard_bytes=shard).collect()
    assert {r["doc_id"]: tuple(r)[1:5] for r in found} == kept_bytes(enumerate(texts), length)


@pytest.mark.parametrize(("length", "gram", "shard"), [(60, 20, 1_000_000), (40, 12, 1)])
def test_all_anchors_counted_as_large_ones(documents, monkeypatch, length, gram, shard):
    for name, value in (("LOOK", 1), ("SHARE", 0.0), ("LARGE", 1)):
        monkeypatch.setattr(repeats, name, value)
    texts = passages(length + 1) + ["0123456789" * 30 + f" {i}" for i in range(8)]
    found = repeats.remove_repeats(documents(texts), length=length, gram=gram, shard_bytes=shard).collect()
    assert {r["doc_id"]: tuple(r)[1:5] for r in found} == kept_bytes(enumerate(texts), length)


def test_texts_joined_by_shuffling(documents, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_KEYS", 1)
    texts = passages(9)
    found = repeats.remove_repeats(documents(texts), length=60, gram=20).collect()
    assert {r["doc_id"]: tuple(r)[1:5] for r in found} == kept_bytes(enumerate(texts), 60)


def test_odd_rows(documents):
    long = "one two three " * 30
    rows = repeats.remove_repeats(documents([long, long, None, "a"], ids=[3, 3, None, None])).collect()
    n = len(long)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in rows), key=repr) == sorted([(3, n, n, 1), (3, n, n, 1), (None, 0, 0, 0), (None, 1, 0, 0)], key=repr)
    assert repeats.remove_repeats(documents([])).count() == 0


def test_a_very_long_text(documents):
    random.seed(8)
    base = "".join(random.choice("abcdefgh ") for _ in range(300_000))
    texts = [base + base[1000:1500], "q" + base[5000:5400] + "z"]
    found = {r[0]: (r["n_removed"], [tuple(s) for s in r["spans"]]) for r in repeats.remove_repeats(documents(texts)).collect()}
    n = len(base)
    assert found == {0: (1400, [(1000, 1500), (5000, 5400), (n, n + 500)]), 1: (400, [(1, 401)])}
