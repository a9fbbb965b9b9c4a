import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from larkspur.llm import jaccard
from larkspur.llm.common import BATCH_SETTING, TEXT_ROWS, stored_texts
from larkspur.llm.components import components
from tests.llm.brute import jaccard_components

SETTINGS = [(3, (90, 100)), (5, (80, 100)), (1, (50, 100))]


def variants(seed, groups=8, most=20):
    random.seed(seed)
    texts = []
    for _ in range(groups):
        words = [f"w{k}" for k in range(random.choice([8, 400]))]
        base = [random.choice(words) for _ in range(random.choice([1, 2, 4, 11, 30, 150]))]
        for _ in range(random.randint(1, most)):
            x = list(base)
            for _ in range(random.randint(0, max(1, len(x) // 12))):
                x[random.randrange(len(x))] = random.choice(words)
            texts.append(" ".join(x))
    return [None, "", " \t", "A b", "a B", "a", *texts, texts[0], texts[0].upper()]


def test_linked_sets_share_a_signature():
    for width, threshold in SETTINGS[:2]:
        sizes = jaccard.Sizes(*threshold)
        sets = jaccard.shingle_sets(pa.array(variants(1)), width)
        signed = [{c: (need, set(found.tolist())) for c, need, found in jaccard.signatures(s, sizes)} for s in sets]
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(np.intersect1d(a, b))
                linked = both and threshold[1] * both >= threshold[0] * (len(a) + len(b) - both)
                if linked and jaccard.digest(a) != jaccard.digest(b):
                    both = [len(signed[i][c][1] & signed[j][c][1]) - max(signed[i][c][0], signed[j][c][0], 1) for c in signed[i].keys() & signed[j].keys()]
                    assert max(both) >= 0


def test_unrelated_sets_share_no_signature():
    rng = np.random.default_rng(6)
    for threshold in ((90, 100), (80, 100), (50, 100)):
        sizes = jaccard.Sizes(*threshold)
        for n in (*range(1, 60), *range(60, 600, 9)):
            one, two = (np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for _ in range(2))
            first, second = ({(c, x) for c, _, found in jaccard.signatures(s, sizes) for x in found.tolist()} for s in (one, two))
            assert not first & second, (threshold, n)


def test_every_linked_set_has_the_common_signatures_it_asks_for():
    rng = np.random.default_rng(7)
    for part, whole in ((90, 100), (80, 100), (50, 100)):
        sizes = jaccard.Sizes(part, whole)
        for n in (*range(1, 80), *range(80, 600, 23)):
            shingles = rng.integers(0, 2**64, 2 * n + 2, dtype=np.uint64)
            for m in {n, n * whole // part, (n + n * whole // part) // 2}:
                both = int(sizes.overlap(n, m))
                if both > n:
                    continue
                one, two = np.unique(shingles[:n]), np.unique(shingles[n - both : n - both + m])
                a, b = ({c: (need, set(x.tolist())) for c, need, x in jaccard.signatures(s, sizes)} for s in (one, two))
                c = sizes.class_of(m)
                if sizes.difference(c) and not np.array_equal(one, two):
                    assert len(a[c][1] & b[c][1]) >= max(a[c][0], b[c][0], 1), (part, n, m)


@pytest.mark.parametrize(("width", "threshold"), SETTINGS)
def test_classes_equal_brute_force(documents, width, threshold):
    texts = variants(2)
    expected = jaccard_components(list(enumerate(texts)), width, *threshold)
    for options in ({}, {"cell_sets": 2, "cell_shingles": 200}):
        docs = documents(texts).withColumnRenamed("lang", "digest").withColumnRenamed("source", "family")
        found = jaccard.jaccard_classes(docs, width=width, threshold=threshold, **options).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected


def test_texts_joined_by_shuffling(documents, monkeypatch):
    texts = variants(3, groups=3)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 1)
    found = jaccard.jaccard_classes(documents(texts)).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == jaccard_components(list(enumerate(texts)), 3, 90, 100)
    kept = jaccard.keep_one_of_each(documents(texts), width=3, threshold=(90, 100))
    expected = jaccard_components(list(enumerate(texts)), 3, 90, 100)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (n, c) in expected.items() if i == c or n == 0}


def test_size_classes_do_not_grow_with_the_sets_that_are_read():
    sizes = jaccard.Sizes(80, 100)
    one = np.unique(np.random.default_rng(1).integers(0, 2**64, 300, dtype=np.uint64))
    jaccard.signatures(one, sizes)
    listed = list(sizes.lows)
    for _ in range(200):
        jaccard.signatures(one, sizes)
    assert sizes.lows == listed and len(listed) < 30


def test_a_cell_takes_few_bytes_for_a_shingle():
    rng = np.random.default_rng(2)
    apart = [np.unique(rng.integers(0, 1 << jaccard.BITS, 500, dtype=np.uint64)) for _ in range(300)]
    for most in (2, 200):  # few different shingles, and many
        tracemalloc.start()
        sets = [s.copy() for s in apart[:most] * (300 // most)]
        shingles = sum(map(len, sets))
        links = jaccard.linked_classes(sets, jaccard.Sizes(90, 100))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(links) == most * (300 // most) - most
        assert peak / shingles < 36
    assert 2 * 36 * jaccard.CELL_SHINGLES < 200_000_000  # a chunk with its probes


def test_numbers_of_shingles_in_one_word_and_by_places(monkeypatch):
    values = np.random.default_rng(3).integers(0, 500, 4000, dtype=np.uint64) << np.uint64(3)
    _, inverse, seen = np.unique(values, return_inverse=True, return_counts=True)
    found = jaccard.rare_first(values.copy())
    monkeypatch.setattr(jaccard, "BITS", 60)
    for tokens, counts in (found, jaccard.rare_first(values.copy())):
        assert np.array_equal(counts, np.sort(seen)) and np.array_equal(counts[tokens], seen[inverse])
        assert len(set(zip(tokens.tolist(), values.tolist(), strict=True))) == len(seen)


def test_python_gets_few_texts_at_once(spark, documents):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(BATCH_SETTING)
    found = stored_texts(documents(["a b c"] * 1500).coalesce(1).mapInArrow(sizes, "n long"), "sizes").collect()
    assert sum(r["n"] for r in found) == 1500 and max(r["n"] for r in found) <= TEXT_ROWS
    assert spark.conf.get(BATCH_SETTING) == before


def test_odd_rows(documents):
    long = "word " * 300_000
    docs = documents(["a b c d", "a b c d", "a b c d", long, None, "x"], ids=[7, 7, None, 1, None, None])
    found = sorted(map(tuple, jaccard.jaccard_classes(docs).collect()), key=repr)
    assert found == sorted([(7, 2, 7), (7, 2, 7), (None, 2, 7), (1, 1, 1), (None, 0, None), (None, 1, None)], key=repr)
    kept = sorted((tuple(r)[:2] for r in jaccard.keep_one_of_each(docs, width=3).collect()), key=repr)
    assert kept == sorted([(7, "a b c d"), (1, long), (None, None), (None, "x")], key=repr)
    assert jaccard.jaccard_classes(documents([])).count() == 0
    assert jaccard.keep_one_of_each(documents([])).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(5, 5), (None, 3)]
    random.shuffle(edges)
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for low, high in ((0, 41), (100, 150), (200, 209)):
        assert len({found[i] for i in range(low, high)}) == 1
    assert len(set(found.values())) == 3
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
