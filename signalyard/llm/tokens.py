"""Token ids for whole texts, used by the packing and token-file operators.

``word_bpe`` vocabularies drop white space and never join characters across
it, so a text's ids are the ids of its white-space separated words, one after
the other.  Natural text repeats its words, so a task encodes a word
once with the tokenizers library and remembers the ids (bounded memory).  A text
that may hold the string of an added token goes the tokenizer's whole way."""

from __future__ import annotations

import re
from array import array
from operator import attrgetter

import numpy as np
from tokenizers import Tokenizer

#: str.split() also splits at these; the tokenizer's \s does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
#: Latin letters that are letters in any form, and ASCII punctuation after them.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")

def byte_symbols() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes as: printable
    Latin-1 characters stand for themselves, the other bytes, in order, for
    the characters from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SYMBOLS = byte_symbols()
_ID = attrgetter("id")
_TOKENIZERS: dict[str, Tokenizer] = {}


class _Remembered(dict):
    """What ``make`` gives for each key, of the keys asked for lately: once those
    hold ``max_chars`` characters they become the old ones, and what is asked for
    again of these is taken over."""

    def __init__(self, make, max_chars: int):
        super().__init__()
        self._make, self._max_chars = make, max_chars
        self._old: dict[str, bytes] = {}
        self._chars = 0

    def __missing__(self, key: str) -> bytes:
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if self._chars > self._max_chars:
            self._old, self._chars = dict(self), 0
            self.clear()
        self._chars += len(key)
        self[key] = value
        return value


class WordEncoder:
    """Encodes texts to little-endian uint32 id bytes, as the tokenizer does
    without special tokens added.

    ``max_chars`` bounds what is remembered: at most twice as many characters of
    words, and of their pieces.  Make one for each task, so that a worker that goes
    on to other work does not hold them."""

    def __init__(self, path: str, max_chars: int = 3_500_000):
        if path not in _TOKENIZERS:  # read once a worker
            _TOKENIZERS[path] = Tokenizer.from_file(path)
        self._tok = _TOKENIZERS[path]
        self.vocabulary_size = max(self._tok.get_vocab(with_added_tokens=True).values()) + 1
        added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        # case and the rest of an added token's string are the tokenizer's to judge
        self._special = re.compile("|".join(re.escape(c[:2]) for c in added), re.IGNORECASE).search if added else lambda t: None
        tokenize, whole = self._tok.model.tokenize, self._tok.encode_batch_fast

        # what is remembered refers to these alone, and goes when the encoder goes
        def ids(text: str) -> bytes:
            return np.array(whole([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

        def piece(letters: str) -> bytes:
            symbols = letters if letters.isascii() else "".join(map(_SYMBOLS.__getitem__, letters.encode()))
            return array("I", map(_ID, tokenize(symbols))).tobytes()

        def word(w: str) -> bytes:
            """Letters with punctuation after them are two pieces, and their case is
            dropped: such words go straight to the vocabulary's model, one piece at
            a time.  All others take the tokenizer's whole way."""
            m = simple(w)
            if m is None:
                return ids(w)
            letters, marks = m.groups()
            return pieces[letters.lower()] + pieces[marks] if marks else pieces[letters.lower()]

        # The short way must agree with the tokenizer, or it is not taken.
        probes = ["Word", "ÜBER,", "étéß!?", "it's", "don't", "El-Niño", "a...", "x'"]
        agree = all(piece(m[1].lower()) + (piece(m[2]) if m[2] else b"") == ids(w) for w in probes if (m := _SIMPLE.fullmatch(w)))
        simple = _SIMPLE.fullmatch if agree else lambda w: None
        pieces = _Remembered(piece, max_chars)
        self._ids, self._pieces, self._known = ids, pieces, _Remembered(word, max_chars)

    def encode(self, texts: list[str]) -> list[bytes]:
        of = self._known.__getitem__
        return [self._ids(t) if _NOT_SPACE.search(t) or self._special(t) else b"".join(map(of, t.split())) for t in texts]


def slices(texts: list[str], max_chars: int = 4_000_000):
    """Index ranges of ``texts`` of at most ``max_chars`` characters (or one text)."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if i > start and chars + len(t) > max_chars:
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)
