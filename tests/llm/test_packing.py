import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers_llm import AWKWARD, documents, read
from shardsync.llm.packing import OpenBins, cut_pieces, pack_documents
from shardsync.llm.token_files import (
    END_ID,
    count_tokens,
    file_sizes,
    scan_separators,
)
from shardsync.llm.tokens import TOKENIZER, Encoder


@pytest.fixture(scope="module")
def tokenizer():
    """As it comes: names of special tokens get their ids."""
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def plain_tokenizer():
    """Token files keep the separator for themselves: its name is plain text there."""
    made = Tokenizer.from_file(TOKENIZER)
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def check_packing(tokenizer, docs, rows, size):
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append(r)
    for doc_id, text in docs:
        ids = np.array([*ids_of(tokenizer, text), 0], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.length for r in pieces[1:]] == [size] * (len(pieces) - 1)
        at = 0
        for r in pieces:
            assert r.start == at
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    for found in by_bin.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_bin)


def test_special_tokens(tokenizer):
    text = "a <|endoftext|> b<|endoftext|>c  <|endoftext|>\n<|endoftext|>"
    assert ids_of(tokenizer, "a <|endoftext|> b") == [64, 220, 50256, 275]
    for special in (True, False):
        made = Tokenizer.from_file(TOKENIZER)
        made.encode_special_tokens = not special
        ids = np.frombuffer(Encoder(TOKENIZER, special).encode([text])[0], "<u4").tolist()
        assert ids == ids_of(made, text)


def test_encoder_remembers_two_generations(tokenizer, monkeypatch):
    from shardsync.llm import tokens

    monkeypatch.setattr(tokens, "_CACHE_SIZE", 40)
    monkeypatch.setattr(tokens, "_TOGETHER", 7)
    made = Encoder(TOKENIZER)
    for k in range(30):
        texts = [" ".join(f"w{(k * j) % 97}é'{j}" for j in range(20)), f"only{k} \u3000x it's \u0301y 12,5 {'z' * 90}"]
        for text, ids in zip(texts, made.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)


def test_signs_line_ends_and_odd_cuts(tokenizer, monkeypatch):
    """Pieces with a sign or a line end, and texts that blanks alone don't cut right."""
    from shardsync.llm import tokens

    monkeypatch.setattr(tokens, "_TOGETHER", 5)
    parts = ["ab", "Zz", "é", "1", "\u3000", "\u0301", " ", "  ", " ", "\n", "\t", "\x1c", ".", ",", "!", ")", '"', "'s", "'"]
    rng, made = np.random.default_rng(4), Encoder(TOKENIZER)
    for _ in range(60):
        texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(20)]
        for text, ids in zip(texts, made.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)


def test_words_around_a_line_end(tokenizer):
    """They have the ids of both words, wherever these are met again."""
    made = Encoder(TOKENIZER)
    assert made._words is not None
    texts = ["x one.\ntwo three\nfour", "x one \ntwo \nfour two.\nÉtat, a\n\nb", "\ntwo\nfour four two\none: \none", "x Ünß\nÀÿɏ. × a×b"]
    for text in texts:
        assert np.frombuffer(made.encode([text])[0], "<u4").tolist() == ids_of(tokenizer, text)


def test_words_of_letters_skip_the_rule(monkeypatch):
    made = Encoder(TOKENIZER)
    seen = []
    real = made._ids
    monkeypatch.setattr(made, "_ids", lambda texts: seen.extend(texts) or real(texts))
    made.encode(["x word, other other.\nline été it's"])
    assert sorted(seen) == [" it's", ",", ".", "x"]


def test_pieces_with_a_sign_cost_no_encoding(monkeypatch):
    made = Encoder(TOKENIZER)
    made.encode(["x word other"])
    seen = []
    real = made._together
    monkeypatch.setattr(made, "_together", lambda pieces: seen.extend(pieces) or real(pieces))
    made.encode(["x word, other. word! new.\nline"])
    assert seen == ["new.\nline"]


def test_other_work_frees_the_encoders():
    from shardsync.llm import common, tokens

    tokens.encoder(TOKENIZER).encode(["some words"])
    common.encoders_freed()
    assert tokens.encoder.cache_info().currsize == 0


def test_encoder_cuts_where_the_tokenizer_does(tokenizer):
    texts = [t or "" for _, t in AWKWARD] + ["a  b", "a \n b", " x", "x 　y", "\n\n  a\t b", " "]
    encoder = Encoder(TOKENIZER)
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)


@pytest.mark.parametrize("size", [16, 2048])
def test_pieces_are_whole_and_sequences_gapless(spark, tokenizer, size):
    docs = [r for r in AWKWARD if r[0] not in (6,)] + [(20, "a " * (size - 1)), (21, "a " * size)]
    rows = pack_documents(documents(spark, docs, extra=True), size=size).collect()
    check_packing(tokenizer, docs, rows, size)


def test_repeats_and_empty_tables(spark):
    docs = documents(spark, AWKWARD)
    assert pack_documents(docs).where("doc_id = 6").count() == 2
    assert pack_documents(docs.limit(0)).count() == 0


def test_few_sequences(spark, sf_dir, tokenizer):
    docs = read(sf_dir, "documents", "doc_id", "text")
    rows = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    used = check_packing(tokenizer, docs, rows, 2048)
    assert used <= 1.03 * sum(r.length for r in rows) / 2048 + 1


def test_ids_come_along(spark):
    rows = cut_pieces(documents(spark, [(1, "one two three")]), size=2, with_ids=True).collect()
    assert sum((r.ids for r in sorted(rows, key=lambda r: r.piece)), [])[-1] == 0


def test_the_fullest_bin_closes_first():
    bins = OpenBins(10, 2)
    assert bins.place(4) == (0, 0)
    assert bins.place(7) == (1, 0)
    assert bins.place(8) == (2, 0)  # a third: bin 1, with 3 left, closes
    assert bins.place(3) == (0, 4)
    assert bins.place(2) == (2, 8)
    assert bins.place(10) == (3, 0)


def test_token_counts(spark, plain_tokenizer):
    docs = [r for r in AWKWARD if r[0] != 6]
    found = {r.doc_id: r.n_tokens for r in count_tokens(documents(spark, docs, extra=True)).collect()}
    assert found == {i: len(ids_of(plain_tokenizer, t)) for i, t in docs}
    assert count_tokens(documents(spark, AWKWARD)).where("doc_id = 6").count() == 2
    assert count_tokens(documents(spark, AWKWARD).limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_documents_span_blocks(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    expected, names = [], []
    for k, n in enumerate((0, 1, 2, 60)):
        ids = np.where(rng.random(n) < 0.2, END_ID, 7).astype("<u2")
        path = tmp_path / f"{k}.bin"
        path.write_bytes(ids.tobytes() + b"\x01" * (k % 2))
        names.append((str(path),))
        start = 0
        for ordinal, end in enumerate([*np.flatnonzero(ids == END_ID), n]):
            if end < n or start < n:
                expected.append((str(path), ordinal, start, int(end) - start, bool(end < n)))
            start = int(end) + 1
    files = file_sizes(spark, spark.createDataFrame(names, "file string"))
    assert sorted(map(tuple, scan_separators(files, block_tokens=block).collect())) == sorted(expected)
