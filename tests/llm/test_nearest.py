import random

import numpy as np
import pyarrow as pa
import pytest

from larkspur.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, score string"


def expected(rows, k):
    good = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, a in {(q, tuple(a)) for q, a in good if q % 50 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q and len(b) == len(a))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return {q: v for q, v in out.items() if v}


def read(spark, rows, k=5, **options):
    data = spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA)
    out = {}
    for r in sorted(nearest.top_k(data, data.where("vec_id % 50 = 0"), k, **options).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("options", [{}, {"pivots": 3, "block": 7, "chunk": 2}, {"pivots": 1000, "block": 1}])
def test_equal_to_brute_force(spark, options):
    random.seed(6)
    centres = [[random.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [x + random.gauss(0, 0.2) for x in random.choice(centres)]) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 520)]  # a large group of copies, and ties
    assert read(spark, rows, **options) == expected(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [1.0]), (50, [0.5]), (7, [-1.0, -2.0]), (7, [-1.0, -2.0]), (None, [1.0, 1.0]), (100, []), (8, [])]
    assert read(spark, rows) == expected(rows, 5)
    assert read(spark, []) == {}
    assert read(spark, [(1, [1.0])]) == {}
    assert read(spark, [(0, [1.0])]) == {}


def test_copies_of_one_vector_beyond_a_block(spark):
    rows = [(i, [1.0, 0.5]) for i in range(300)] + [(0, [1.0, 0.5])] * 40 + [(1, [1.0, 0.5])] * 40
    rows += [(1000 + i, [0.1 * i, 1.0]) for i in range(60)]
    assert read(spark, rows, block=16) == expected(rows, 5)
    data = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, v array<double>")
    left = nearest.without_needless_copies(data, 5, 16)
    assert left.where("vec_id < 1000").count() == 5 + 5 + 4 and left.where("vec_id >= 1000").count() == 60


def test_queries_of_one_id_are_ranked_apart(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 2.0])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = nearest.top_k(data, data.where("vec_id = 0"), 1).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 1, 3 * 65536), (0, 1, 2, 2 * 65536)]


def test_blocks_are_copied_as_often_as_they_are_asked_for(monkeypatch, spark):
    monkeypatch.setattr(nearest, "CELLS", 50)
    monkeypatch.setattr(nearest, "SENT_ROWS", 3)
    random.seed(2)
    rows = [(i, [random.gauss(0, 1) for _ in range(4)]) for i in range(500)]
    assert read(spark, rows, pivots=9, block=20, chunk=3) == expected(rows, 5)
    batch = pa.RecordBatch.from_pylist([{"vec_id": i, "v": v, "vkey": 0, "least": -1e18} for i, v in rows[:7]])
    groups = {0: (1000, 1.0), 1: (3, 1.0)}
    runs = [len(r) for _, r, _, _ in nearest._meetings([rows[0][1], rows[1][1]], groups, False, [batch])]
    assert max(runs) <= 50 and sum(runs) == 7 * 1002


def test_large_components_stay_exact():
    a = np.array([[3e7, 1.0], [2.0**40, 5.0]])
    assert nearest.products(a[:1], a[:1]).tolist() == [[9 * 10**14 + 1]]
    with pytest.raises(OverflowError):
        nearest.products(a[1:], a[1:])
