import zlib
from collections import Counter

import numpy as np
import pytest

from helpers_llm import AWKWARD, documents, read
from shardsync.llm.language import fit, identify, predict_language, training_sample, usual_bits

SMALL = [("xx", "abab abba abab"), ("yy", "cdcd dccd cdcd ab"), ("xx", "ab")]


def brute_bits(model_texts, order, text):
    """Method C with exclusion, one byte at a time."""
    counts = {}
    for t in model_texts:
        data = b"\n" * order + t.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts.setdefault(data[i - k : i], {}).setdefault(data[i], 0)
                counts[data[i - k : i]][data[i]] += 1
    data, bits = b"\n" * order + text.encode(), 0.0
    for i in range(order, len(data)):
        out = set()
        for k in range(order, -1, -1):
            seen = counts.get(data[i - k : i])
            if seen is None:
                continue
            left = {s: n for s, n in seen.items() if s not in out}
            whole = sum(left.values()) + len(seen)
            if data[i] in left:
                bits -= np.log2(left[data[i]] / whole)
                break
            bits -= np.log2(len(seen) / whole)
            out |= seen.keys()
        else:
            bits += np.log2(256 - len(out))
    return bits


@pytest.mark.parametrize("text", ["abab", "cd ab", "zzz", "ba\n", "é"])
@pytest.mark.parametrize("order", [0, 1, 3])
def test_code_lengths_are_exact(text, order):
    model = fit(SMALL, order)
    data = np.frombuffer(text.encode(), np.uint8)
    bits = model.bits(data, np.array([0, len(data)]))[0]
    for k, name in enumerate(model.names):
        own = [t for lang, t in SMALL if lang == name]
        assert bits[k] == pytest.approx(brute_bits(own, order, text), abs=1e-3)


def test_probabilities_add_up_to_one():
    model = fit(SMALL, 3)
    for context in (b"aba", b"qqq", b"\n\n\n"):
        before = model.bits(np.frombuffer(context, np.uint8), np.array([0, 3]))[0]
        after = [
            model.bits(np.frombuffer(context + bytes([x]), np.uint8), np.array([0, 4]))[0]
            for x in range(256)
        ]
        assert np.exp2(before - np.array(after)).sum(axis=0) == pytest.approx(1, abs=1e-4)


def test_held_out_accuracy(spark, sf_dir):
    lang = dict(read(sf_dir, "documents", "doc_id", "lang"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = identify(docs, keep=("doc_id",)).collect()
    assert len(rows) == len(lang)
    out = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_rows_that_are_not_held_out_teach(spark):
    rows = [(i, f"text {i}", "xx", "s") for i in range(60)] + [(70, "t", None, None), (None, "n", "xx", None)]
    taught = {t for _, t in training_sample(documents(spark, rows))}
    assert {"n", *(f"text {i}" for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1)} == taught


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD, extra=True)
    model = fit(SMALL)
    rows = predict_language(docs, model).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert predict_language(docs.limit(0), model).count() == 0
    assert {r.lang_pred for r in identify(docs).collect()} == {"und"}


def test_the_sample_is_spread_over_languages_and_texts(spark):
    rows = [(None, f"aa {k % 7} null ids flood", "xx") for k in range(3000)]
    rows += [(7, "one id many times", "zz")] * 500 + [(k, f"text of its own {k}", "yy") for k in range(300)]
    rows += [(9000 + k, f"start {k} " + "middle " * 9000 + f"end {k}", "long") for k in range(6)]
    taken = training_sample(documents(spark, rows), rows=200)
    by_lang = Counter(lang for lang, _ in taken)
    assert by_lang["xx"] == 7 and by_lang["zz"] == (zlib.crc32(b"7") % 3 != 1) and by_lang["yy"] == 50
    long = [t for lang, t in taken if lang == "long"]
    assert long and all(len(t) <= 16_384 and "start" in t and "end" in t for t in long)


def test_very_many_languages(spark):
    rows = [(3 * k, f"text {k}", f"l{k % 1200:04}") for k in range(2400)]
    taken = training_sample(documents(spark, rows), rows=100, languages=50)
    assert len({lang for lang, _ in taken}) <= 50 and len(taken) <= 100


def test_usual_bits_come_from_all_held_out_texts(spark):
    """More texts than a sample would have taken, each with a code length of its own."""
    rng, letters = np.random.default_rng(7), np.array(list("abcd "))
    rows = [(i, "".join(rng.choice(letters, 200, p=[0.5 - i / 20000, i / 20000, 0.2, 0.1, 0.2])), "xx") for i in range(9000)]
    model = fit(SMALL, 1)
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert len(out) > 2500
    bits = sorted(r.bits_per_byte for r in predict_language(documents(spark, out), model).collect())
    assert usual_bits(documents(spark, rows), model) == bits[-(-99 * len(bits) // 100) - 1]


def test_windows_do_not_change_code_lengths():
    model = fit([("a", "the cat sat on the mat " * 9), ("b", "le chat est sur le lit " * 9)])
    raw = ["the cat and le chat " * 40, "", "x", "sur the lit " * 25]
    data = np.frombuffer("".join(raw).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    whole = model.bits(data, offsets)
    for window in (1, 7, 64, 1000):
        assert model.bits(data, offsets, window) == pytest.approx(whole)
