"""Token ids of whole texts by a public tokenizer, with a bounded cache of encoded pieces."""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers

#: Vocabulary of the token operators, and the id that ends a document.
VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: Pieces and runs that a worker keeps, some 300 MB of them; beyond that it starts anew, with pieces when these are two thirds.
CACHE = 1_500_000
#: Places where the vocabulary's own splitting always ends a piece: before a single space or line end
#: between two visible characters, after such a line end, and between a Latin letter and ASCII punctuation. Texts cut
#: there give the ids of the whole text. None lies within the string of the special token.
CUTS = re.compile(r"(?<=[!-~\w])(?=[ \n][!-~\w])|(?<=[!-~\w]\n)(?=[!-~\w])|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[!-&(-/:-@[-`{}~])")
#: A run between spaces at whose ends a text may be cut.
RUN = re.compile(r"[!-~\w](?:.*[!-~\w])?", re.DOTALL)
#: What the vocabulary takes for one word, as it is and after a space.
WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as little-endian unsigned 32-bit integers")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def size(path: str) -> int:
    return _tokenizer(path).get_vocab_size()


#: Characters by which the vocabulary stands for bytes: visible ones of Latin-1 for themselves, the others from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}


@lru_cache(maxsize=2)
def _words(path: str):
    """Splits a word in the vocabulary's spelling into tokens, without the tokenizer's search for words."""
    return _tokenizer(path).model.tokenize


class _Pieces(dict):
    """Ids of pieces; a new piece is encoded when it is first asked for."""

    path = None

    def __missing__(self, piece: str) -> bytes:
        word = piece.removeprefix(" ")
        if (plain := word.isascii() and word.isalpha()) or WORD.fullmatch(word):
            spelled = piece.replace(" ", _BYTES[32]) if plain else piece.encode().decode("latin-1").translate(_BYTES)
            ids = [x.id for x in _words(self.path)(spelled)]
        else:
            ids = _tokenizer(self.path).encode_batch_fast([piece], add_special_tokens=False)[0].ids
        self[piece] = found = array("I", ids).tobytes()
        return found


class _Uncut(Exception):
    """A text holds a run at whose ends it can't be cut."""


class _Runs(dict):
    """Ids of runs that follow a space; a new run is put together from its pieces."""

    def __missing__(self, run: str) -> bytes:
        spaced = " " + run
        if run.isascii() and run.isalpha() or WORD.fullmatch(run):
            found = _cache[spaced]
        elif RUN.fullmatch(run):
            found = b"".join(map(_cache.__getitem__, CUTS.split(spaced)))
        else:
            raise _Uncut
        self[run] = found
        return found


_cache, _spaced = _Pieces(), _Runs()


def encode(texts: list[str | None], path: str | None = None) -> Iterator[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers, with the end id; a null is empty.

    A text is looked up by the runs between its spaces; unknown runs are cut into pieces, of which unknown ones are
    encoded. A text with a run at whose ends it can't be cut goes by pieces as a whole.
    """
    path, end = path or vocabulary_path(), END_ID.to_bytes(4, "little")
    for text in texts:
        if _cache.path != path or len(_cache) + len(_spaced) > CACHE:
            _spaced.clear()
            if _cache.path != path or len(_cache) > 2 * CACHE // 3:
                _cache.clear()
            _cache.path = path
        first, *runs = (text or "").split(" ")
        try:
            if runs and not RUN.fullmatch(first):
                raise _Uncut
            head = map(_cache.__getitem__, CUTS.split(first) if first else [])
            yield b"".join([*head, *map(_spaced.__getitem__, runs), end])
        except _Uncut:
            yield b"".join([*map(_cache.__getitem__, CUTS.split(text)), end])
