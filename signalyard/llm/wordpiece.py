"""Greedy word-piece counts by a linear longest-match automaton.

A word's greedy pieces are found by taking the longest vocabulary piece that
the rest of the word begins with, again and again.  The automaton is a trie of
the vocabulary with failure links: where no child continues a match, the link
of the node leads to the node for what is left after popping the pieces that
the match begins with, and the node knows how many those are.  A word is read
once, and no piece is ever built."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from signalyard.llm.common import text_or_empty
from signalyard.llm.tokens import byte_symbols, slices

_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "n_words", "n_pieces")])
_AUTOMATA: dict[str, "Automaton"] = {}


class Automaton:
    """``pieces``: the vocabulary, as byte strings; a piece that begins a word
    begins with a space.  Every single byte must be a piece, so that each word
    has pieces."""

    def __init__(self, pieces: set[bytes], max_chars: int = 8_000_000):
        if missing := [b for b in range(256) if bytes([b]) not in pieces]:
            raise ValueError(f"{len(missing)} single bytes are not pieces")
        self._next: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for b in piece:
                if b not in self._next[node]:
                    self._next[node][b] = len(self._next)
                    self._next.append({})
                    whole.append(False)
                node = self._next[node][b]
            whole[node] = True
        # fail[v], popped[v]: the node of what is left of v's string once the
        # pieces it greedily begins with are popped, and how many those are.
        n = len(self._next)
        self._fail, self._popped = [-1] * n, [0] * n
        level = [0]
        while level:
            below = []
            for u in level:
                for b, v in self._next[u].items():
                    below.append(v)
                    if whole[v]:
                        self._fail[v], self._popped[v] = 0, 1
                        continue
                    z, count = self._fail[u], self._popped[u]
                    while z != -1 and b not in self._next[z]:
                        count += self._popped[z]
                        z = self._fail[z]
                    if z != -1:
                        self._fail[v], self._popped[v] = self._next[z][b], count
            level = below
        self._max_chars, self._known, self._chars = max_chars, {}, 0

    def count(self, word: bytes) -> int:
        """How many greedy pieces ``word`` has."""
        succ, fail, popped = self._next, self._fail, self._popped
        node = pieces = 0
        for b in word:
            while b not in succ[node]:
                pieces += popped[node]
                node = fail[node]
            node = succ[node][b]
        while node:
            pieces += popped[node]
            node = fail[node]
        return pieces

    def count_texts(self, texts: list[str]) -> list[tuple[int, int]]:
        """(words, pieces) of each text; each word counts with a space before
        it.  Words already met are remembered (``max_chars`` bounds that)."""
        known, out = self._known, []
        for text in texts:
            words = text.split()
            counts = list(map(known.get, words))
            if None in counts:
                for i, c in enumerate(counts):
                    if c is None:
                        w = words[i]
                        counts[i] = c = self.count(b" " + w.encode())
                        if self._chars < self._max_chars:
                            known[w] = c
                            self._chars += len(w)
            out.append((len(words), sum(counts)))
        return out


def read_vocabulary(path: str) -> set[bytes]:
    """The pieces of a byte-level ``tokenizer.json``, without special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    back = {c: b for b, c in byte_symbols().items()}
    return {bytes(back[c] for c in piece) for piece in spec["model"]["vocab"] if piece not in special}


def automaton(path: str) -> Automaton:
    """This worker's automaton for the vocabulary file ``path``."""
    if path not in _AUTOMATA:
        _AUTOMATA[path] = Automaton(read_vocabulary(path))
    return _AUTOMATA[path]


def count_pieces(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words, n_pieces of every row of ``docs``.

    Words are what white space separates.  A null, empty or blank text has
    neither words nor pieces; a null doc_id stays null; repeated rows each give
    a row; an empty table gives none; other columns are not read.  Rows are
    counted where they are read, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in slices(texts):
                words, pieces = zip(*machine.count_texts(texts[lo:hi]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(words, pa.int64()), pa.array(pieces, pa.int64())],
                    names=_SCHEMA.names)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, _SCHEMA)
