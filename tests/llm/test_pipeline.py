import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from helpers_llm import AWKWARD, documents, fold, read
from shardsync.llm.common import written
from test_neardup import brute


def test_stages_against_brute_force(spark, sf_dir):
    """Each stage over what the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = dict(read(sf_dir, "documents", "doc_id", "text"))
    source = dict(read(sf_dir, "documents", "doc_id", "source"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        kept[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
        if name != "pack":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert set(kept["language_id"]) == {i for i, t in text.items() if any(map(str.isalpha, t or ""))}
    groups = defaultdict(list)
    for i in kept["language_id"]:
        groups[fold(text[i])].append(i)
    assert kept["exact_copies"] == Counter(max(g) for g in groups.values())
    found = brute([(i, text[i]) for i in kept["exact_copies"]])
    assert kept["near_copies"] == Counter({c for _, c in found.values()})
    mixed = kept["source_mix"]
    assert set(mixed) == set(kept["near_copies"]) and max(mixed.values()) == 2
    n_words = {i: len(text[i].split()) for i in mixed}
    sizes = Counter()
    for i in kept["near_copies"]:
        sizes[source[i]] += n_words[i]
    took = Counter()
    for i, n in mixed.items():
        took[source[i]] += n * n_words[i]
    largest = max(sizes, key=sizes.get)
    assert took[largest] == sizes[largest]
    assert all(sizes[s] <= took[s] <= 2 * sizes[s] + 1 for s in sizes)
    pieces = docs.collect()
    first = Counter(r.doc_id for r in pieces if r.piece == 0)
    assert first == mixed
    assert sum(r.length for r in pieces) > 0.9 * 2048 * (len({r.sequence_id for r in pieces}) - 1)


WORDS = {"en": "the quick brown fox and the lazy dog went over there with that", "fr": "le renard brun et la paresse du chien qui dort dans une maison"}


def labelled(rng, n):
    """Texts of two languages, of 60 words, none alike."""
    for i in range(n):
        lang = ("en", "fr")[i % 2]
        yield (1000 + i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(60)), lang, f"s{i % 3}")


def test_awkward_rows_reach_all_stages(spark):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(n))
    en, fr = (" ".join(rng.choice(WORDS[k].split()) for _ in range(80)) for k in ("en", "fr"))
    rows = [
        *AWKWARD, *labelled(rng, 240),
        (20, en, None, None), (20, fr, None, "s1"), (None, en.upper(), None, None), (None, fr + " the end", None, "s1"),
        (21, " ".join(letters(6) for _ in range(90)), None, "s0"), (22, en + " dog", "xx", "s0"),
    ]
    docs = documents(spark, rows, extra=True)
    for name in ("bits_per_byte", "lang_pred", "k", "row", "c0", "epoch", "a`b"):
        docs = docs.withColumn(name, F.lit("y"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, ""), name)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and "a`b" in docs.columns
        kept[name] = Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
        assert docs.where("lang IS NULL").isEmpty()
    first = kept["language_id"]
    gone = {(i, t) for i, t, *_ in rows} - set(first)
    # no letter, random letters; the long text's words are in no language that was learned
    assert {i for i, _ in gone} == {1, 2, 3, 8, 21}
    assert first[(6, AWKWARD[5][1])] == 2
    exact = kept["exact_copies"]
    assert set(exact.values()) == {1} and (20, en) in exact and (None, en.upper()) not in exact
    assert (5, AWKWARD[4][1]) not in exact and (6, AWKWARD[5][1]) in exact  # equal in lower case
    near = kept["near_copies"]
    assert (20, en) in near and (20, fr) in near  # one id, two texts
    assert (22, en + " dog") not in near and (None, fr + " the end") not in near
    mixed = kept["source_mix"]
    assert set(mixed) == set(near) and max(mixed.values()) <= 2
    pieces = corpus_pipeline.pack(spark, docs, "").collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(
        {i: sum(n for (j, _), n in mixed.items() if j == i) for i, _ in mixed}
    )
    assert "lang" in docs.columns and docs.where("doc_id = 22").isEmpty()


def test_nothing_learned_and_empty_tables(spark):
    docs = documents(spark, [(1, "words without any label"), (2, "1 2 3"), (3, None)], extra=True)
    assert [r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()] == [1]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name


def test_known_labels_stay(spark):
    rows = [*labelled(random.Random(1), 60), (1, "le renard et la maison", "en", None), (2, "the dog", None, None)]
    found = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, documents(spark, rows), "").collect()}
    assert found[1] == "en" and found[2] == "en"
