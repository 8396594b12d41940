import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers_llm import AWKWARD, documents, read, words
from shardsync.llm import joins, neardup
from shardsync.llm.graph import components
from shardsync.llm.words import BLANKS, words as scan

BLANK = "\x20\x09-\x0d"


def shingle_set(text, size=5):
    found = words(text, BLANK)
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[k : k + size]) for k in range(len(found) - size + 1))


def brute(docs, percent=75):
    """Set size and component of each id, from all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    known = defaultdict(set)
    for i in sorted(sets):
        for j in {j for g in sets[i] for j in known[g]}:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for g in sets[i]:
            known[g].add(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def check(df, docs):
    rows = df.collect()
    expected = brute(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_agrees_with_all_pairs(spark, sf_dir):
    docs = read(sf_dir, "documents", "doc_id", "text")
    check(neardup.near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")), docs)


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_family_of_edited_copies(spark, edits):
    """Copies that are close to one text but often not to each other."""
    rng = random.Random(edits)
    base = [rng.choice("abcdefgh") * 3 + str(k) for k in range(70)]
    docs = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(text)))
    docs += [(200, " ".join(base)), (201, "nothing like the others at all in any way")]
    check(neardup.near_dedup(documents(spark, docs)), docs)


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD, extra=True)
    rows = neardup.near_dedup(docs).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r.doc_id: r for r in rows}
    for i in (1, 2, 3):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[4].n_shingles == 1
    assert by_id[8].n_shingles == 8
    assert by_id[None].component_id is None and by_id[None].kept
    assert neardup.near_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("tile", "levels"), [(20, 3), (10, 0)])
def test_a_bucket_of_many_tiles(spark, monkeypatch, tile, levels):
    """A family around one text, and texts that share a passage and nothing else."""
    monkeypatch.setattr(joins, "TILE", tile)
    monkeypatch.setattr(joins, "LEVELS", levels)
    rng = random.Random(tile)
    base = [f"b{k}" for k in range(60)]
    docs = []
    for i in range(120):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(text)))
    passage = " ".join(f"p{k}" for k in range(40))
    docs += [(i, f"{passage} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(20))) for i in range(200, 260)]
    check(neardup.near_dedup(documents(spark, docs)), docs)


def test_alike_sets_without_a_common_key(spark, monkeypatch):
    """Texts that no band brings together, and a sketch that turns all pairs away."""
    rng = random.Random(11)
    docs = []
    for i in range(0, 80, 2):
        base = [f"{i}w{k}" for k in range(rng.randrange(30, 90))]
        other = [*base, *(f"{i}y{k}" for k in range(rng.randrange(20)))]
        docs += [(i, " ".join(base)), (i + 1, " ".join(other))]
    passage = " ".join(f"p{k}" for k in range(40))
    docs += [(i, f"{passage} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(20))) for i in range(100, 160)]
    real = neardup.bands
    monkeypatch.setattr(neardup, "bands", lambda least: real(least + np.uint64(hash(least.tobytes()) & 0xFFFFFFFF)))
    check(neardup.near_dedup(documents(spark, docs)), docs)
    monkeypatch.setattr(neardup, "bands", real)

    class Blind(neardup.SketchTile):
        def may_be_alike(self):
            return np.zeros((len(self.n), len(self.n)), bool)

    monkeypatch.setattr(neardup, "SketchTile", Blind)
    check(neardup.near_dedup(documents(spark, docs)), docs)


def test_a_split_bucket_loses_no_link(spark, monkeypatch):
    """Pairs that meet in one large bucket alone and differ in all further keys."""
    monkeypatch.setattr(joins, "TILE", 4)
    docs = []
    for i in range(0, 60, 2):
        base = [f"{i}w{k}" for k in range(60)]
        docs += [(i, " ".join(base)), (i + 1, " ".join([*base[3:], *(f"{i}y{k}" for k in range(4))]))]
    real = neardup.bands

    def one_common(least):
        out = real(least + np.uint64(hash(least.tobytes()) & 0xFFFFFFFF))
        out[0] = 1
        return out

    monkeypatch.setattr(neardup, "bands", one_common)
    check(neardup.near_dedup(documents(spark, docs)), docs)


def test_the_rarest_shingles_meet():
    """Alike sets share one of the rarest, whatever counts as frequent."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 200), np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, rng.integers(0, 20), np.uint64)]))
        both, frequent = len(np.intersect1d(a, b)), np.sort(rng.permutation(a)[: rng.integers(0, len(a) + 1)])
        apart = joins.bits_apart(*(joins.signature(x, joins.bits_for(len(x))).tobytes() for x in (a, b)))
        assert apart <= len(a) + len(b) - 2 * both
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert np.isin(joins.rarest(a, frequent, 75), joins.rarest(b, frequent, 75)).any()


def test_pairs_with_a_passage_hardly_meet(spark, monkeypatch):
    """Texts that share a passage, none alike by it, and some that are: a pair comes once or
    twice, however many shingles it shares, and no link is lost."""
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(60)]
    docs = [(i, " ".join([*passage, *(f"{i}u{k}" for k in range(rng.randrange(4, 25)))])) for i in range(80)]
    met = []
    real = joins._meeting

    def meeting(members, percent):
        out = real(members, percent)
        plain = members.alias("x").join(members.alias("y"), "s").where("x.comp <> y.comp AND x.node < y.node")
        met.append((out.count(), out.distinct().count(), plain.count()))
        return out

    class Blind(neardup.SketchTile):
        def may_be_alike(self):
            return np.zeros((len(self.n), len(self.n)), bool)

    monkeypatch.setattr(joins, "_meeting", meeting)
    monkeypatch.setattr(joins._Join, "_frequent", lambda self: np.empty(0, np.uint64))
    monkeypatch.setattr(neardup, "SketchTile", Blind)
    check(neardup.near_dedup(documents(spark, docs)), docs)
    (rows, pairs, plain), = met
    assert pairs <= rows <= 2 * pairs and 4 * rows <= plain


def test_rows_that_repeat_an_id(spark):
    a = " ".join(f"a{k}" for k in range(50))
    near = a.replace("a49", "z")
    rows = [(5, a), (5, "a text of its own under the same id, alike to no other"), (3, near)]
    rows += [(7, "one text a hundred times over and over"), (8, "one text a hundred times  over and over")] * 100
    docs = documents(spark, rows, extra=True)
    found = Counter(map(tuple, neardup.near_dedup(docs).collect()))
    assert found[(5, 46, 3, False)] == 1 and found[(3, 46, 3, True)] == 1
    assert found[(5, 9, 5, True)] == 1
    assert found[(7, 4, 7, True)] == 100 and found[(8, 4, 7, False)] == 100
    left = neardup.without_near_copies(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == {5: 1, 3: 1, 7: 1}


def test_word_hashes_follow_the_words():
    texts = ["A b  c", "", "B", "a\tb é ", "É"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    starts, ends, hashes = scan(np.frombuffer(b"".join(raw), np.uint8), offsets, BLANKS)
    flat = [w for t in texts for w in words(t, BLANK)]
    assert len(starts) == len(flat)
    assert len(set(zip(hashes.tolist(), flat))) == len(set(flat)) == len(set(hashes.tolist()))


def test_sketches_estimate_high_similarity():
    rng = np.random.default_rng(0)
    for share in (0.75, 0.9, 1.0):
        n = 4000
        a = rng.integers(0, 2**63, n, np.uint64)
        keep = int(round(n * 2 * share / (1 + share)))
        b = np.concatenate([a[:keep], rng.integers(0, 2**63, n - keep, np.uint64)])
        x, y = (np.frombuffer(neardup.odd_sketch(neardup.minhash(s)), np.uint8) for s in (a, b))
        different = int(np.bitwise_count(x ^ y).sum())
        assert different <= neardup.MOST_DIFFERENT
        assert neardup.estimate(different) == pytest.approx(share, abs=0.12)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(40, 0, -1)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    found = components(spark.createDataFrame(chain + star + star, "a long, b long"))
    assert {r.node: r.comp for r in found.collect()} == {
        **{k: 1 for k in range(1, 42)}, **{k: 1000 for k in range(1000, 1200)}
    }
