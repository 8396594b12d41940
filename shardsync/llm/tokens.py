"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: A byte-level vocabulary starts a new piece at every blank before a non-blank.
_CUT = re.compile(r" (?=\S)")
#: Blanks inside a piece: such a piece is encoded by itself. Line ends between other signs
#: are no matter, as the ids around them don't begin with a blank.
_ODD = re.compile(r"[^\S\n]|\n\Z")
#: A letter and one sign at the end of a piece: the vocabulary always cuts between them.
_SIGNED = re.compile(r"[A-Za-z][.,;:!?)\"]\Z")
#: Letters that no rule of a byte-level vocabulary takes apart, and words around a line end.
_LETTERS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
_LINE = re.compile(rf"({_LETTERS.pattern})([.,;:!?)\"]?)\n({_LETTERS.pattern}[.,;:!?)\"]?)")
_CACHED_LENGTH = 64
#: Pieces in each of the two generations that are remembered.
_CACHE_SIZE = 300_000
#: New pieces that are encoded as one text.
_TOGETHER = 8_192


#: The sign for each byte of a letter in a byte-level vocabulary's tokens, and for a blank; a
#: carriage return, which no word has, gives the sign for the line end.
_UNSEEN = [*range(33), *range(127, 161), 173]
_SIGNS = {b: chr(256 + k) for k, b in enumerate(_UNSEEN) if b not in (10, 13)} | {13: "\u010a"}


class Encoder:
    """Ids of whole texts. Texts are cut where the vocabulary's own rule always
    cuts, and the ids of pieces met before are looked up. Without ``special``, the
    names of special tokens are plain text; with it, they get their ids, as the
    tokenizer does by itself.

    New pieces are encoded many at a time as one text, and its ids are cut where one
    begins with the blank. One with a sign at its end has the ids of the piece before it, and
    those of the sign; two words around a line end have the ids of both. When a generation of known pieces is full it becomes the old
    one, and pieces that are met again move to the new one."""

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self._begins[number] = token.startswith("\u0120")
        self._line_end = np.zeros(len(self._begins), bool)
        self._line_end[vocabulary.get("\u010a", [])] = True
        self._words = self._for_letters(vocabulary)
        self._known: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._signs: dict[str, bytes] = {}

    def _for_letters(self, vocabulary: dict[str, int]) -> Tokenizer | None:
        """The same vocabulary for words of letters, which its rule never cuts, without the time
        that the rule takes; None if its rule may be another."""
        from tokenizers import models, pre_tokenizers

        by, model = self._tokenizer.pre_tokenizer, self._tokenizer.model
        named = [x.content for x in self._tokenizer.get_added_tokens_decoder().values()]
        if (
            not isinstance(by, pre_tokenizers.ByteLevel) or not by.use_regex or self._tokenizer.normalizer
            or not isinstance(model, models.BPE) or not {"\u0120", "\u010a"} <= vocabulary.keys()
            or any(_LETTERS.fullmatch(x) for x in named)
        ):
            return None
        made = Tokenizer(model)
        made.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self._known) > _CACHE_SIZE:
            self._old, self._known = self._known, {}
        parts = [t.split(" ") for t in texts]
        first = [p.pop(0) for p in parts]
        known, old = self._known, self._old
        found, new = self._find(parts)
        # known pieces begin with a non-blank, so texts with other cuts have new pieces
        wrong = {w for w in new if not w or w[0].isspace()}
        if wrong:
            for k, p in enumerate(parts):
                if not wrong.isdisjoint(p):
                    first[k], *parts[k] = _CUT.split(texts[k])
            found, new = self._find(parts)
        first = self._ids(first)
        fresh = {w: old[w] for w in new if w in old}
        new.difference_update(fresh)
        # a met word, a line end and a word have the ids of both, and hardly ever come again; a
        # blank, with which no piece begins, marks the second
        lines = {
            w: (m[1] + m[2], " " + m[3]) for w in new
            if "\n" in w and (m := _LINE.fullmatch(w)) and (m[1] in known or m[1] in old or m[1] in new)
        } if self._words else {}
        new.difference_update(lines)
        for pair in lines.values():
            new.update(pair)
        signed = [w for w in new if _SIGNED.search(w)]
        new.difference_update(signed)
        new.update([w[:-1] for w in signed])
        for w in list(new):
            if ids := known.get(w) or old.get(w):
                fresh[w] = ids
                new.discard(w)
        fresh.update(self._new(new))
        for w in signed:
            fresh[w] = fresh[w[:-1]] + self._sign(w[-1])
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= _CACHED_LENGTH)
        for w, (a, b) in lines.items():
            fresh[w] = fresh[a] + fresh[b]
        out = []
        for f, p, ids in zip(first, parts, found, strict=True):
            if None in ids:
                ids = [i or fresh[w] for w, i in zip(p, ids, strict=True)]
            out.append(f + b"".join(ids))
        return out

    def _find(self, parts: list[list[str]]) -> tuple[list[list[bytes | None]], set[str]]:
        """The ids of each piece that is known, and the pieces that are not."""
        found = [list(map(self._known.get, p)) for p in parts]
        return found, {
            w for p, ids in zip(parts, found, strict=True) if None in ids
            for w, i in zip(p, ids, strict=True) if i is None
        }

    def _sign(self, sign: str) -> bytes:
        if sign not in self._signs:
            self._signs[sign] = self._ids([sign])[0]
        return self._signs[sign]

    def _new(self, pieces: set[str]) -> Iterator[tuple[str, bytes]]:
        if self._words:
            # those of ASCII first, as they need no table of signs
            plain = sorted(filter(_LETTERS.fullmatch, pieces), key=str.isascii, reverse=True)
            begun = [w for w in pieces if w[0] == " "]
            pieces = pieces.difference(plain, begun)
            for at in range(0, len(plain), _TOGETHER):
                some = plain[at : at + _TOGETHER]
                yield from zip(some, self._of_letters("\n ".join(["", *some])[1:], self._begins), strict=True)
            for at in range(0, len(begun), _TOGETHER):
                some = begun[at : at + _TOGETHER]
                # the line end is a word of its own, by the sign that stands for it
                text = "".join(some).replace(" ", "\n\r\n")[1:]
                yield from zip(some, self._of_letters(text, self._line_end), strict=True)
        odd = list(filter(_ODD.search, pieces))
        plain = list(pieces.difference(odd))
        for at in range(0, len(plain), _TOGETHER):
            some = plain[at : at + _TOGETHER]
            yield from zip(some, self._together(some), strict=True)
        yield from zip(odd, self._ids([" " + w for w in odd]), strict=True)

    def _of_letters(self, text: str, begins: np.ndarray) -> list[bytes]:
        """The ids of words of letters in lines, each cut from the next where one ``begins``."""
        if text.isascii():
            signs = text.replace(" ", "\u0120").replace("\r", "\u010a")
        else:
            signs = text.encode().decode("latin-1").translate(_SIGNS)
        ids = np.array(self._words.encode_batch_fast([signs], add_special_tokens=False)[0].ids, "<u4")
        data, starts = ids.tobytes(), (4 * np.flatnonzero(begins[ids])).tolist()
        return [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]

    def _together(self, pieces: list[str]) -> list[bytes]:
        ids = np.frombuffer(self._ids([" " + " ".join(pieces)])[0], "<u4")
        starts = np.flatnonzero(self._begins[ids])
        if len(starts) != len(pieces):  # a vocabulary without that mark
            return self._ids([" " + w for w in pieces])
        data, ends = ids.tobytes(), [*(4 * starts[1:]).tolist(), 4 * len(ids)]
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = True) -> Encoder:
    """One encoder for each Python worker, file and setting."""
    return Encoder(path, special)
