import random
import time
import zlib

import numpy as np
import pytest

from helpers_llm import AWKWARD, documents
from shardsync.llm.toxicity import (
    FEATURES,
    Lexicon,
    Reader,
    canonical,
    fit,
    grow_trees,
    isotonic,
    score_toxicity,
    training_rows,
    words_of,
)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(0)
    calm = [f"w{k}" for k in range(200)]
    rows, marks = [], []
    for i in range(600):
        text = [rng.choice(calm) for _ in range(40)]
        toxic = int(i % 6 == 0)
        for _ in range(4 * toxic):
            text[rng.randrange(40)] = rng.choice(["blort", "Fnarg", "you zug"])
        rows.append((i, " ".join(text)))
        marks.append((i, 1, toxic))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return documents(spark, rows), labels, {i: t for i, _, t in marks}


@pytest.fixture(scope="module")
def scorer(corpus):
    return fit(*corpus[:2])


def test_held_out_rows(corpus, scorer):
    docs, _, toxic = corpus
    rows = score_toxicity(docs, scorer).collect()
    assert len(rows) == len(toxic)
    out = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.predicted == toxic[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_awkward_rows(spark, scorer):
    docs = documents(spark, AWKWARD, extra=True)
    rows = score_toxicity(docs, scorer).collect()
    assert len(rows) == len(AWKWARD)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert score_toxicity(docs.limit(0), scorer).count() == 0


def test_nothing_to_learn(spark, corpus):
    docs, labels, _ = corpus
    for marks in (labels.limit(0), labels.where("toxic = 0")):
        assert fit(docs, marks) is None
    assert {r.score for r in score_toxicity(docs, None).collect()} == {0.0}


def test_contradicting_and_held_out_labels_do_not_teach(spark):
    docs = documents(spark, [(i, f"t{i}") for i in range(30)])
    marks = [(i, 0, i % 2) for i in range(30)] + [(3, 0, 0), (None, 0, 1), (5, 0, None), (6, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    taught = {r.text for r in training_rows(docs, labels).collect()}
    assert taught == {f"t{i}" for i in range(30) if i != 3 and zlib.crc32(str(i).encode()) % 3 != 1}


def test_features():
    reader = Reader(Lexicon({"idiot": 4.0, "idio+": 2.0}))
    x = dict(zip(FEATURES, reader.read("YOU are an 1d10t!! and again"), strict=True))
    assert x["hit_density"] == pytest.approx(1 / 6) and x["addressed"] == pytest.approx(1 / 6)
    assert x["masked"] > 0 and x["shouting"] == pytest.approx(1 / 6) and x["bangs"] == pytest.approx(2 / 6)
    assert reader.read(None) == reader.read("  ") == [0.0] * len(FEATURES)
    assert canonical("S***tup1d,") == "stupid"


def test_a_stump_is_the_best_of_all_cuts():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, size=(90, 3)).astype(float)
    y = ((x[:, 1] > 6) ^ (rng.random(90) < 0.15)).astype(float)
    made = grow_trees(x, y, trees=1, depth=1, step=1.0, smallest=5)
    p = y.mean()
    slope, bend = y - p, p * (1 - p) * np.ones(90)

    def gain(feature, cut):
        left = x[:, feature] <= cut
        if min(left.sum(), (~left).sum()) < 5:
            return -1.0
        part = [slope[s].sum() ** 2 / (bend[s].sum() + 1) for s in (left, ~left, left | ~left)]
        return part[0] + part[1] - part[2]

    best = max(gain(f, c) for f in range(3) for c in np.unique(x[:, f]))
    assert gain(made.features[0][0], made.cuts[0][0]) == pytest.approx(best)
    left = x[:, made.features[0][0]] <= made.cuts[0][0]
    for leaf, part in zip(made.leaves[0], (left, ~left), strict=True):
        assert leaf == pytest.approx(slope[part].sum() / (bend[part].sum() + 1))
    margin = made.margin(x)
    assert margin == pytest.approx(made.start + np.where(left, *made.leaves[0]))


def test_more_trees_fit_better():
    rng = np.random.default_rng(5)
    x = rng.random((400, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] > 0.3)).astype(float)
    losses = []
    for trees in (1, 5, 30):
        p = 1 / (1 + np.exp(-grow_trees(x, y, trees).margin(x)))
        losses.append(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.1


def test_isotonic_steps_against_min_max():
    rng = np.random.default_rng(6)
    for _ in range(20):
        raw = rng.integers(0, 9, 40).astype(float)
        y = (rng.random(40) < raw / 9).astype(float)
        ends, heights = isotonic(raw, y)
        assert (np.diff(heights) >= 0).all()
        at = np.unique(raw)
        mean = lambda a, b: y[(raw >= a) & (raw <= b)].mean()
        for v in at:  # the best rising fit, by the min-max formula
            best = max(min(mean(a, b) for b in at if b >= v) for a in at if a <= v)
            assert np.interp(v, ends, heights) == pytest.approx(best)


def test_a_text_without_blanks_is_read_whole():
    lexicon = Lexicon({"idiot": 4.0})
    reader, n = Reader(lexicon), 50_000
    x = dict(zip(FEATURES, reader.read("A" * 256 + "b" * (n - 256)), strict=True))
    assert x["capitals"] == pytest.approx(256 / n)
    x = dict(zip(FEATURES, reader.read("x" * n + "!" * 100), strict=True))
    assert x["bangs"] == 100 and x["marks"] == pytest.approx(100 / (n + 100))
    for text in ("what,idiot,says", "good/idiot-really", "so_idiot", "w" * n + ",idiot"):
        assert dict(zip(FEATURES, reader.read(text), strict=True))["hits"] > 0
    assert words_of("i-d-i-o-t") == ["i-d-i-o-t"] and words_of("don't") == ["don't"]


def test_known_tokens_are_not_walked(monkeypatch):
    """Reading a short text doesn't take longer the more tokens are known."""
    reader = Reader(Lexicon({}))
    reader.read(" ".join(f"t{k}" for k in range(150_000)))
    start = time.perf_counter()
    for _ in range(200):
        reader.read("t1 t2 t3 new words in a short text")
    assert time.perf_counter() - start < 0.5


def test_the_fast_way_gives_the_same_facts():
    lexicon = Lexicon({"idiot": 4.0, "idio+": 2.0, "vous": 1.5})
    tokens = ["idiot", "Idiot", "idiot!", "Idiots,", "vous", "You.", "A", "a", "a.", "IDIOT", "İx", "İi", "ß", "straße;",
              "!", "..", "x!!", "idiot.?", "数据", "É", "Élan", "ab1", "1", "don't", "idiot|", "aB", "aa" * 200, "Ab:"]
    for token in tokens:
        assert lexicon.facts(token) == pytest.approx(lexicon._any_facts(token)), token
