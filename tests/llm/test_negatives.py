import numpy as np
import pytest
from pyspark.sql import functions as F

from shardsync.llm import negatives
from shardsync.llm.negatives import Rows, hard_negatives, measured, score_bounds

KIND = "vec_id long, label int, embedding array<float>, norm string, v int, `group` int, score int"
MOST = (1 << 63) - 1


def table(spark, rows):
    return spark.createDataFrame([(i, lab, e, "x", 1, 2, 3) for i, lab, e in rows], KIND)


def brute(rows, anchor=lambda i: i % 100 == 0):
    good = {}
    for i, lab, e in rows:
        if i is not None and lab is not None and e and all(x is not None and np.isfinite(x) for x in e):
            v = tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in e)
            good[i] = max(good.get(i, ((), lab)), (tuple(max(-MOST - 1, min(MOST, x)) for x in v), lab))
    out = []
    for a in filter(anchor, good):
        v, label = good[a]
        scores = sorted(
            (-max(-MOST - 1, min(MOST, sum(x * y for x, y in zip(v, w, strict=True)))), i, lab)
            for i, (w, lab) in good.items() if i != a and len(w) == len(v)
        )
        for s, p, _ in [x for x in scores if x[2] == label][:5]:
            window = [x for x in scores if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(window, 1)]
    return sorted(out)


def check(spark, rows, *sizes):
    names = ("group_rows", "anchor_rows")
    found = hard_negatives(table(spark, rows), F.col("vec_id") % 100 == 0, **dict(zip(names, sizes, strict=False)))
    assert sorted(map(tuple, found.collect())) == brute(rows)


@pytest.mark.parametrize("sizes", [(), (150, 2)])
def test_agrees_with_all_pairs(spark, sizes, monkeypatch):
    monkeypatch.setattr(negatives, "SEEDS", 40)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=12)
    rows = [(i, int(rng.integers(3)), rng.normal(size=12).astype(np.float32).tolist()) for i in range(500)]
    near = centre + rng.normal(size=(200, 12)) * 0.05
    rows += [(1000 + i, i % 2, e.astype(np.float32).tolist()) for i, e in enumerate(near)]  # a hot direction
    rows += [(2000 + i, i % 4, rows[0][2]) for i in range(30)]  # ties
    check(spark, rows, *sizes)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, -0.5]), (100, 1, None), (200, 1, [None, 1.0]), (300, None, [1.0, 1.0]), (1, 2, [inf, 0.0]),
        (2, 1, []), (None, 1, [1.0, 1.0]), (3, 2, [0.0, 0.0]), (400, 2, [0.0, 0.0]), (4, 1, [1.0, 0.25]),
        (4, 1, [1.0, 0.25]), (5, 2, [0.5, 0.0]), (6, 2, [0.5, 0.0]), (7, 2, [nan, 0.0]), (500, 3, [1.0]),
        (501, 3, [2.0]), (502, 4, [1.0]), (8, 2, [-1.0, 0.0]), (600, 5, [1.0, 1.0]),
    ]
    check(spark, rows)
    assert hard_negatives(table(spark, rows).limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives(table(spark, rows), F.col("vec_id") < -5).count() == 0


def test_vectors_beyond_exact_doubles(spark):
    rows = [(0, 1, [1e8, 3.0]), (1, 1, [1e8, -7.0]), (2, 2, [0.5e8, 1.0]), (3, 2, [0.9e8, 11.0]), (4, 2, [1e3, 1.0]),
            (100, 2, [40.0, 1.0]), (5, 2, [30.0, 2.0]), (6, 1, [20.0, 0.0]), (7, 1, [1e30, 0.0])]
    check(spark, rows)


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16) * 40
    v = np.floor(np.concatenate([rng.normal(size=(600, 16)) * 40, centre + rng.normal(size=(300, 16)), np.zeros((1, 16))]))
    directions = v[[0, 1, 2, 700]] / np.linalg.norm(v[[0, 1, 2, 700]], axis=1)[:, None]
    rows = Rows(np.arange(len(v)), np.zeros(len(v), int), v, *measured(v, directions))
    ruled_out = 0
    for window in rows.windows():
        bottom, top = score_bounds(rows, window)
        scores = v @ window.v.T
        assert (scores.max(axis=1) <= top).all() and (scores.min(axis=1) >= bottom).all()
        ruled_out += (top < 0.9 * rows.norms**2).sum()
    assert ruled_out > 300


def test_a_seed_never_hides_a_result(spark, monkeypatch):
    """All rows are seeds, with many ties at the last place."""
    rows = [(i, i % 2, [1.0, float(i % 3)]) for i in range(120)]
    check(spark, rows)
