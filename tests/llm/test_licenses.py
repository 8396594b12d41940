from helpers_llm import AWKWARD, documents, read, words
from shardsync.llm.licenses import NOTICES, scan_licenses

SEPARATORS = "\x00-\x2f\x3a-\x60\x7b-\x7f"
PHRASES = {
    ("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl",
}


def brute(text):
    found = words(text, SEPARATORS)
    places = [
        (k, label) for p, label in PHRASES.items() for k in range(len(found))
        if tuple(found[k : k + len(p)]) == p
    ]
    starts = [k for k, _ in places]
    return (
        len(found), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def check(df, docs):
    rows = df.collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = next(t for i, t in docs if i == r.doc_id)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    return {r.doc_id: r for r in rows}


def test_whole_table(spark, sf_dir):
    docs = read(sf_dir, "documents", "doc_id", "text")
    check(scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")), docs)


def test_awkward_rows(spark):
    check(scan_licenses(documents(spark, AWKWARD, extra=True)), AWKWARD)
    assert scan_licenses(documents(spark, AWKWARD).limit(0)).count() == 0


def test_phrases_next_to_each_other(spark):
    docs = [
        (1, "MIT license license mit MIT, LICENSE"), (2, "general public general public license"),
        (3, "mit license mitlicense m it license"), (4, "apache license mit license" * 3),
        (5, "general license public license"),
    ]
    check(scan_licenses(documents(spark, docs)), docs)


def test_notices_survive_edits_and_need_enough_words(spark):
    grant = next(x for x in NOTICES if x.label == "mit-text")
    plain = grant.text
    edited = plain.replace("free of charge", "wholly free of any charge").replace("copy", "Copie")
    other = " ".join(plain.split()[:8])
    docs = [(1, f"intro {plain} end"), (2, f"a b c {edited} d"), (3, other), (4, f"{plain} {plain}")]
    found = {r.doc_id: r for r in scan_licenses(documents(spark, docs)).collect()}
    assert [found[i].labels for i in (1, 2, 3, 4)] == ["mit-text", "mit-text", "", "mit-text"]
    assert found[1].score == 1 and 0.6 <= found[2].score < 1 and found[3].score == 0
