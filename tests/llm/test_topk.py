import numpy as np
import pytest
from pyspark.sql import functions as F

from shardsync.llm.topk import search, top_k

KIND = "vec_id long, embedding array<float>, label int, v int, size int, `group` int"


def table(spark, rows):
    return spark.createDataFrame([(i, e, 0, 0, 0, 0) for i, e in rows], KIND)


def brute(rows, k, query):
    good = {
        i: [int(np.floor(1024 * np.float64(np.float32(x)))) for x in e]
        for i, e in rows
        if i is not None and e and all(x is not None and np.isfinite(x) for x in e)
    }
    out = []
    for q in filter(query, good):
        scores = sorted(
            (-sum(a * b for a, b in zip(good[q], e, strict=True)), i)
            for i, e in good.items() if i != q and len(e) == len(good[q])
        )
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(8192, 65536), (40, 3)])
def test_agrees_with_all_pairs(spark, sizes):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=20).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(30)]  # ties
    found = top_k(table(spark, rows), F.col("vec_id") % 100 == 0, 10, 1024, *sizes)
    assert sorted(map(tuple, found.collect())) == brute(rows, 10, lambda i: i % 100 == 0)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -0.5]), (100, None), (200, [None, 1.0]), (300, [nan, 1.0]), (1, [inf, 0.0]), (2, []),
        (None, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [-2.0, 3.0]), (4, [-2.0, 3.0]), (500, [1.0]), (5, [2.0]),
    ]
    found = top_k(table(spark, rows), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows, 10, lambda i: i % 100 == 0)
    assert top_k(table(spark, rows).limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert top_k(table(spark, rows), F.col("vec_id") < 0).count() == 0


def test_components_beyond_exact_doubles(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 0.0]), (3, [0.0, 5.0])]
    found = top_k(table(spark, rows), F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [
        (1, 2**63 - 1), (3, 5120 * 1024), (2, -(2**63)),
    ]


def test_pruned_candidates_never_count():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(3000, 64)) * 100)
    ids = np.arange(3000)
    found = search(ids[:5], vectors[:5], ids, vectors, 7)
    scores = vectors[:5] @ vectors.T
    for q in range(5):
        scores[q, q] = -np.inf
        best = np.lexsort((ids, -scores[q]))[:7]
        assert [i for a, i, _ in found if a == q] == best.tolist()
