"""Counting and listing tokens with the public tokenizer files; their folder is a parameter."""

from __future__ import annotations

import os
import re
import string
import sys
import unicodedata
from array import array
from functools import lru_cache

#: Words whose ids a Python worker remembers; beyond that it starts afresh, so memory stays bounded.
MAX_REMEMBERED = 1_200_000
PUNCTUATION = string.punctuation.encode()

_UNITS = re.compile(rb" ?[^\s]+|\s+(?!\S)|\s+")
_WIDE_BLANK = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def tokenizer_path(name: str, folder: str | None = None) -> str:
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(name: str, folder: str | None = None):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name, folder))
    t.no_truncation()
    t.no_padding()
    return t


class Remembered:
    """Results of the tokenizer by piece of text, for pieces that it treats alike wherever they stand.

    Letters and ASCII punctuation after them are never one pre-token, so such a piece is put together from both if all its
    letters are letters still once they are composed and lowered (a dotted capital I leaves a mark, which joins what
    follows); a piece that is one pre-token (``as_pretoken`` says how the model sees it) goes to the model at once.
    """

    def __init__(self, name: str, folder: str | None, as_pretoken, of_ids):
        self.tokenizer, self.as_pretoken, self.of, self.known = tokenizer(name, folder), as_pretoken, of_ids, {}

    def fill(self, texts: list[list[bytes]]) -> dict:
        known, model = self.known, self.tokenizer.model
        if len(known) > MAX_REMEMBERED:
            known.clear()
        made, plain = [], set()
        for piece in set().union(*texts).difference(known):
            core = piece.rstrip(PUNCTUATION)
            if core and len(core) < len(piece) and _stays_letters(core.lstrip(b" ")):
                made.append((piece, core, piece[len(core) :]))
                plain.update(made[-1][1:])
            else:
                plain.add(piece)
        whole = []
        for piece in plain.difference(known):
            seen = self.as_pretoken(piece)
            if seen is None:
                whole.append(piece)
            else:
                known[piece] = self.of([t.id for t in model.tokenize(seen)])
        if whole:
            encoded = self.tokenizer.encode_batch_fast([x.decode("utf-8") for x in whole], add_special_tokens=False)
            known.update((x, self.of(e.ids)) for x, e in zip(whole, encoded))
        for piece, core, tail in made:
            known[piece] = known[core] + known[tail]
        return known


def _stays_letters(core: bytes) -> bool:
    return core.isalpha() or unicodedata.normalize("NFC", core.decode("utf-8")).lower().isalpha()


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


@lru_cache(maxsize=1)
def _byte_signs() -> dict[int, int]:
    """The printable character that byte-level vocabularies use for each byte: itself, or the next unused one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(rest)}


def _spaced_letters(piece: bytes) -> str | None:
    return piece.decode("latin-1").translate(_byte_signs()) if piece.removeprefix(b" ").decode("utf-8").isalpha() else None


def _small_letters(piece: bytes) -> str | None:
    return piece.decode("ascii") if piece.isalpha() and piece.islower() else None  # bytes: ASCII letters only


@lru_cache(maxsize=4)
def _ids_by_word(name: str, folder: str | None) -> Remembered:
    return Remembered(name, folder, _small_letters, _packed)


@lru_cache(maxsize=4)
def _counts_by_unit(name: str, folder: str | None) -> Remembered:
    return Remembered(name, folder, _spaced_letters, len)


def _small_words(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8")
    return (raw if b"<|" in raw else raw.lower()).split()  # special strings are looked for before a text is lowered


def word_ids(texts: list[str | None], name: str, folder: str | None = None) -> list[bytes]:
    """Ids (little-endian unsigned 32-bit) of each text under a vocabulary that lowers letters and drops white space before
    it looks for words, so that each run between ASCII blanks has the ids that it has alone."""
    words = [_small_words(t) for t in texts]
    known = _ids_by_word(name, folder).fill(words)
    return [b"".join(map(known.__getitem__, w)) for w in words]


def byte_counts(texts: list[str | None], name: str, folder: str | None = None) -> list[int]:
    """Number of tokens of each text under a byte-level vocabulary that attaches one blank to the word after it.

    A word with the blank before it, and a run of other blanks, are split alike wherever they stand, unless the text has
    blanks beyond ASCII or a special string: such a text goes to the tokenizer whole.
    """
    t = tokenizer(name, folder)
    special = [s.content for s in t.get_added_tokens_decoder().values()]
    whole = [bool(x) and ((not x.isascii() and bool(_WIDE_BLANK.search(x))) or any(s in x for s in special)) for x in texts]
    units = [[] if w or not x else _UNITS.findall(x.encode("utf-8")) for x, w in zip(texts, whole)]
    known = _counts_by_unit(name, folder).fill(units)
    return [len(t.encode(x, add_special_tokens=False)) if w else sum(map(known.__getitem__, u)) for x, w, u in zip(texts, whole, units)]
