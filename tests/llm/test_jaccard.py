import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from helpers_llm import AWKWARD, documents, read, words
from shardsync.llm import joins
from shardsync.llm.jaccard import (
    BandedTile,
    bits_for, folded, jaccard_classes, set_keys, signature, size_bands,
)
from shardsync.llm.joins import set_id
from shardsync.llm.words import BLANKS, words as scan

BLANK = "\x20\x09-\x0d"


def shingle_set(text, size=5):
    found = words(text, BLANK)
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[k : k + size]) for k in range(len(found) - size + 1))


def brute(docs, percent=80):
    """Row by row: (id, set size, component), from all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    known = defaultdict(set)
    for i, found in enumerate(sets):
        for j in {j for g in found for j in known[g]}:
            both = len(found & sets[j])
            if 100 * both >= percent * (len(found) + len(sets[j]) - both):
                parent[root(i)] = root(j)
        for g in found:
            known[g].add(i)
    names = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            names[root(i)].append(d)
    least = {r: min(d) for r, d in names.items()}
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(docs)), key=str)


def check(df, docs):
    found = jaccard_classes(df)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs)


def test_agrees_with_all_pairs(spark, sf_dir):
    docs = read(sf_dir, "documents", "doc_id", "text")
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), docs)


def family(rng, edits, copies, words_=60):
    base = [rng.choice("abcdefgh") * 3 + str(k) for k in range(words_)]
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        yield " ".join(text)


@pytest.mark.parametrize(("tile", "levels"), [(512, 3), (24, 3), (10, 0)])
def test_families_and_a_shared_passage(spark, monkeypatch, tile, levels):
    """Copies that are close to one text but often not to each other, and documents
    that share a passage and nothing else; in tiles that hold few of them."""
    monkeypatch.setattr(joins, "TILE", tile)
    monkeypatch.setattr(joins, "LEVELS", levels)
    rng = random.Random(tile)
    texts = [*family(rng, 2, 60), *family(rng, 5, 60)]
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [f"{passage} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(25)) for _ in range(60)]
    texts += [f"{t} {t}" for t in family(rng, 1, 6)] + ["one two", "One  TWO", "one two three"]
    docs = list(enumerate(texts, 7))
    check(documents(spark, docs), docs)


def test_awkward_rows(spark):
    rng = random.Random(0)
    copies = list(family(rng, 1, 3))
    rows = [
        *AWKWARD, (20, copies[0]), (20, copies[1]), (None, copies[2]), (20, "another text under the same id, alike to none"),
        *[(30, "the same text again and again " * 3)] * 100, *[(31, "the same text again and again " * 3)] * 100,
        (40, "x" * 5000 + " b c d e"), (41, "x" * 5001 + " b c d e"),
    ]
    df = documents(spark, rows, extra=True)
    check(df, [(r[0], r[1]) for r in rows])
    assert jaccard_classes(df.limit(0)).count() == 0


def test_a_set_without_id_joins_its_neighbours(spark):
    w = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(w)), (None, " ".join(w[3:] + ["a", "b"])), (2, " ".join(w[6:] + list("abcd")))]
    check(documents(spark, rows), rows)


def test_bands_leave_no_pair_out():
    bounds = size_bands(3000, 80)
    band = np.searchsorted(bounds, np.arange(3001), "right") - 1
    for n in range(1, 3001):
        assert band[-(-80 * n // 100)] >= band[n] - 1


def test_signatures_bound_the_overlap():
    rng = np.random.default_rng(0)
    for n, share in ((5, 0.8), (300, 0.5), (4000, 0.8), (40_000, 0.9)):
        a = np.unique(rng.integers(0, 2**63, n, np.uint64))
        b = np.unique(np.concatenate([a[: int(share * n)], rng.integers(0, 2**63, n // 4 + 1, np.uint64)]))
        both = len(np.intersect1d(a, b))
        wide = [signature(x, 2 * bits_for(n))[None] for x in (a, b)]
        narrow = folded(wide[0], wide[0].shape[1] // 2)
        assert (narrow[0] == signature(a, bits_for(n))).all()
        apart = int(np.bitwise_count(wide[0] ^ wide[1]).sum())
        assert both <= (len(a) + len(b) - apart) // 2
        if n < 5000:
            assert (len(a) + len(b) - apart) // 2 <= both + 0.25 * n


def test_sets_at_the_limit_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 2**63, 450, np.uint64)
        b = np.concatenate([a[:400], rng.integers(0, 2**63, 50, np.uint64)])
        assert (set_keys(a) == set_keys(b)).any()


def test_long_words_have_hashes_of_their_own():
    thue = "a"
    for _ in range(11):
        thue += thue.translate({97: 98, 98: 97})
    texts = [thue, thue.translate({97: 98, 98: 97}), "A" * 100, "a" * 100]
    raw = "".join(texts).encode()
    hashes = scan(np.frombuffer(raw, np.uint8), np.cumsum([0, *map(len, texts)]), BLANKS)[2]
    assert hashes[0] != hashes[1] and hashes[2] == hashes[3]


@pytest.mark.parametrize("percent", [75, 80])
def test_many_pairs_are_intersected_as_one(percent):
    """By products of tables or pair by pair, the same sets are alike."""
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 2**63, 300, np.uint64)
    sets = []
    for _ in range(120):
        keep = rng.random(300) > rng.random() * 0.25
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 2**63, 5, np.uint64)])))
    tile = BandedTile(
        pa.table({
            "node": [set_id(x) for x in sets], "comp": [set_id(x) for x in sets], "minor": [True] * 120,
            "n": [len(x) for x in sets], "bits": [signature(x, 1024).tobytes() for x in sets],
            "found": pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
        }),
        percent,
    )
    every = np.triu(np.ones((120, 120), bool), 1)
    found = tile._alike_of_many(every)
    right = np.array([[i != j and tile.alike(i, j) for j in range(120)] for i in range(120)])
    assert found is not None and (found[every] == right[every]).all() and 0 < right.sum() < right.size - 120
    assert tile._alike_of_many(np.triu(np.ones((120, 120), bool), 119)) is None  # too few pairs
