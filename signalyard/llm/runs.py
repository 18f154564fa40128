"""Maximal runs of repeated words, by a suffix automaton with link-cut access.

The automaton of a word sequence has a state for each set of substrings that end
at the same places; its suffix links form a tree in which the prefix ending at i
and all its suffixes lie on one path to the root.  Going through the prefixes in
order, every state on the path of prefix i is recoloured with i, the last place
where its strings end.  Before that, the path consists of a few segments of one
colour j each.  A segment whose longest string has at least i - j words says that
the last i - j words before i equal the i - j words before them: a square that
ends at i, whose root is primitive (a shorter period would make j larger), and
every square with a primitive root is found so.  Squares of one period that end
at consecutive places are one run: it starts two periods before the first end.

The preferred paths of that access are kept on the heavy chains of the link tree,
as one stack of (length, colour) segments a chain: the tree of a whole sequence
is fixed once it is built, so the paths need no balancing, and an access pops what
it recolours (O(log n) segments each, amortised).

Runs of exponent ``min_exponent`` (4) or more are wanted.  Inside such a run of
period q, after its first period, every three words in a row have occurred at
most q places before, and that for 3q - 2 places on end.  ``zones`` are the
stretches where that can be so for some q, with a period before them; a run lies
in one zone as a whole, and the automaton is built of each zone."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signalyard.llm.tokens import slices

MIN_EXPONENT, MIN_WORDS = 4, 6
_GRAM = 3
#: Stopping early leaves zones larger than need be.
_ROUNDS = 50

SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def automaton(word_ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """length and suffix link of each state (the root is 0), and the state of
    each prefix."""
    length, link, following, ends = [0], [-1], [{}], []
    last = 0
    for i, word in enumerate(word_ids):
        state = len(length)
        length.append(i + 1)
        following.append({})
        link.append(0)
        ends.append(state)
        p = last
        while p >= 0 and word not in following[p]:
            following[p][word] = state
            p = link[p]
        if p >= 0:
            q = following[p][word]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                following.append(following[q].copy())
                link.append(link[q])
                link[q] = link[state] = clone
                while p >= 0 and following[p].get(word) == q:
                    following[p][word] = clone
                    p = link[p]
        last = state
    return length, link, ends


def heavy_chains(length: list[int], link: list[int]) -> list[int]:
    """The top of each state's heavy chain in the link tree."""
    order = np.argsort(np.array(length), kind="stable").tolist()
    size = [1] * len(length)
    heavy = [-1] * len(length)
    for v in reversed(order):
        p = link[v]
        if p >= 0:
            size[p] += size[v]
            if heavy[p] < 0 or size[v] > size[heavy[p]]:
                heavy[p] = v
    top = list(range(len(length)))
    for v in order:
        if heavy[v] >= 0:
            top[heavy[v]] = top[v]
    return top


def square_ends(word_ids: list[int]):
    """(end, period) of all squares with a primitive root, by end: the words
    before ``end`` end in the same ``period`` words twice."""
    length, link, ends = automaton(word_ids)
    top = heavy_chains(length, link)
    # Of each chain: the recoloured segments, deepest last; (longest string, colour).
    # A segment reaches up to the next deeper one's place, the top one to the chain's top.
    chains: dict[int, list[tuple[int, int]]] = {}
    for i, state in enumerate(ends, 1):
        v = state
        while v > 0:
            t, depth = top[v], length[v]
            chain = chains.get(t)
            if chain is None:
                chains[t] = [(depth, i)]
            else:
                # chain[-1] is the segment nearest the chain's top
                while chain:
                    deep, colour = chain[-1]
                    if (deep if deep < depth else depth) >= i - colour:
                        yield i, i - colour
                    if deep <= depth:
                        chain.pop()
                    if deep >= depth:
                        break
                chain.append((depth, i))
            v = link[t]


def runs(word_ids: list[int], min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``min_words`` words and
    ``min_exponent`` (2 or more) smallest periods, by start, then period."""
    open_: dict[int, tuple[int, int]] = {}  # period: first and last end of the run going on
    found = []

    def close(period: int) -> None:
        first, last = open_.pop(period)
        start = first - 2 * period
        if last - start >= max(min_words, min_exponent * period):
            found.append((start, last - start, period))

    for end, period in square_ends(word_ids):
        at = open_.get(period)
        if at is not None and at[1] >= end - 1:
            open_[period] = (at[0], end)
        else:
            if at is not None:
                close(period)
            open_[period] = (end, end)
    for period in list(open_):
        close(period)
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def zones(word_ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """Places [from, to) of ``word_ids`` - the words of documents one after the
    other, ``doc`` numbers each word's - outside which no run of MIN_EXPONENT
    periods and MIN_WORDS words lies; a run lies in one zone as a whole."""
    n = len(word_ids) - _GRAM + 1
    if n < 1:
        return []
    whole = doc[:n] == doc[_GRAM - 1:]
    # numbers of equal groups of words in one document, without collisions
    base = int(word_ids.max()) + 1
    keys, most = doc[:n], int(doc[-1]) + 1
    for k in range(_GRAM):
        if most * base >= 1 << 62:
            keys, most = np.unique(keys, return_inverse=True)[1], n
        keys, most = keys * base + word_ids[k:k + n], most * base
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    back = np.full(n, np.iinfo(np.int64).max)
    back[order[1:][same]] = order[1:][same] - order[:-1][same]
    back[~whole] = np.iinfo(np.int64).max
    possible = back < np.iinfo(np.int64).max
    for _ in range(_ROUNDS):  # each leaves every run's places in one stretch
        edge = np.flatnonzero(np.diff(np.concatenate(([0], possible.view(np.int8), [0]))))
        first, last = edge[::2], edge[1::2]
        if not len(first):
            return []
        most = (last - first + _GRAM - 1) // (MIN_EXPONENT - 1)  # 3q - 2 places need q of at most this
        enough = last - first >= MIN_WORDS - _GRAM
        keep = np.repeat(np.where(enough, most, 0), last - first)
        at = np.flatnonzero(possible)
        out = at[back[at] > keep]
        if not len(out):
            break
        possible[out] = False
    out = []
    starts = np.maximum(first - most, np.searchsorted(doc, doc[first]))
    for lo, hi in zip(starts.tolist(), (last + _GRAM - 1).tolist()):
        while out and lo <= out[-1][1] and doc[lo] == doc[out[-1][0]]:
            lo = min(lo, out.pop()[0])
        out.append((lo, hi))
    return out


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of the documents (by the checksum of their id), which of its n
    words stands at each place once its tail is made periodic; None for others."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def _row(doc_id: int | None, words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    best = None
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = words
    if found:
        kept = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    start, length, period = best or (None, None, None)
    return (doc_id, len(words), len(found), start, length, period, length and 1000 * length // period,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def described(doc_ids: list[int | None], texts: list[bytes]) -> list[tuple]:
    """A row of SCHEMA for each text (UTF-8)."""
    number = defaultdict(count().__next__)
    words, ids = [], []
    for doc_id, text in zip(doc_ids, texts, strict=True):
        own = text.split()  # at the six ASCII white-space bytes
        own_ids = np.fromiter(map(number.__getitem__, own), dtype=np.int64, count=len(own))
        at = periodic_tail(doc_id, len(own))
        if at is not None:
            own, own_ids = [own[i] for i in at.tolist()], own_ids[at]
        words.append(own)
        ids.append(own_ids)
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    found: list[list] = [[] for _ in words]
    if sizes.sum():
        flat = np.concatenate(ids)
        doc = np.repeat(np.arange(len(ids)), sizes)
        for lo, hi in zones(flat, doc):
            d = int(doc[lo])
            base = lo - int(begins[d])
            found[d] += [(start + base, length, period) for start, length, period in runs(flat[lo:hi].tolist())]
    return [_row(doc_id, own, own_runs) for doc_id, own, own_runs in zip(doc_ids, words, found, strict=True)]


def word_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_runs, the run of greatest exponent
    (start, length, period, exponent_milli; null without a run), and digests of
    all runs and of the words that are left when each run keeps its first period.

    Words are separated by ASCII white space; a document whose id's checksum says
    so is given a periodic tail first (``periodic_tail``; a null id never is).  A null
    or empty text has no words and no run; of runs of equal exponent the one that
    starts first, then of the smallest period, is named; repeated rows give equal
    rows; an empty table gives no rows; other columns are not read.  Rows are
    independent: no shuffle, and a lost task is run again alone."""
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                rows = described(ids[lo:hi], texts[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return narrow.mapInArrow(run, SCHEMA)
