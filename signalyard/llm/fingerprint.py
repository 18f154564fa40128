"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch keeps the k smallest distinct hashes of a text's shingles (runs of
characters).  Sketches of parts merge into the sketch of the whole, and two
sketches estimate resemblance, containment and distinct shingle counts."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from signalyard.llm.common import parts_for, text_or_empty

#: Hashes in a sketch, code points in a shingle, bits of a hash.
K = 128
SHINGLE_CHARS = 8
HASH_BITS = 48

#: Text characters sketched at a time, and text bytes a partition.
_PART_CHARS = 1 << 20
PARTITION_BYTES = 32 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()), T.StructField("n_shingles", T.DoubleType()),
    T.StructField("contained_in_edited", T.DoubleType())])


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def shingle_hashes(chars: np.ndarray, shingle: int = SHINGLE_CHARS) -> np.ndarray:
    """Hashes of all shingles of code points ``chars``; a shorter text is one
    shingle, an empty one has none."""
    if not len(chars):
        return np.empty(0, np.uint64)
    shingle = min(shingle, len(chars))
    # A polynomial of the window's characters, doubling the window while it fits.
    h, width = chars.astype(np.uint64) + np.uint64(1), 1
    while 2 * width <= shingle:
        h = h[:-width] * _power(width) + h[width:]
        width *= 2
    for more in range(width, shingle):
        h = h[:-1] * _BASE + (chars[more:].astype(np.uint64) + np.uint64(1))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(64 - HASH_BITS)


def _smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values, sorted."""
    n = len(hashes)
    ask = 4 * k
    while n > 2 * ask:
        # about ``ask`` values are below this; take more if too few are distinct
        few = np.unique(hashes[hashes < np.uint64((ask << HASH_BITS) // n)])
        if len(few) >= k:
            return few[:k]
        ask *= 8
    return np.unique(hashes)[:k]


def sketch(text: str, k: int = K, shingle: int = SHINGLE_CHARS) -> np.ndarray:
    """The sketch of a whole text; long texts are sketched in parts and merged."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = None
    for at in range(0, max(1, len(chars) - shingle + 1), _PART_CHARS):
        part = _smallest(shingle_hashes(chars[at:at + _PART_CHARS + shingle - 1], shingle), k)
        out = part if out is None else merge(out, part, k)
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of what two sketches are of, together."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of distinct shingles that both have: of the k smallest of
    either, those in both.  Two empty sketches are alike."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1]) / len(union))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles: exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << HASH_BITS) / float(a[k - 1])


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's distinct shingles that b has."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    return min(1.0, r * distinct(merge(a, b, k), k) / distinct(a, k))


def write_sketch(a: np.ndarray) -> str:
    """Base64 of the hashes, six little-endian bytes each."""
    return base64.b64encode(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BITS // 8].tobytes()).decode()


def read_sketch(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, HASH_BITS // 8)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :HASH_BITS // 8] = raw
    return out.view("<u8").ravel().astype(np.uint64)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def in_chains(docs: DataFrame, partition_bytes: int = PARTITION_BYTES) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) dealt by descending doc_id into ranges of about
    equal size: chain, extra, doc_id, text, each partition in chain order.

    A chain holds the documents of a range and, as its last row (extra), the
    first document of the next range, so that each document's follower is at
    hand; after the last range comes the first.  Texts are shuffled once.
    Documents of one doc_id share a range, in text order; a null doc_id is last."""
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("key", key)
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = parts_for(n_bytes, partition_bytes)
    # Bounds of the ranges, and the first document of each: one number a range.
    at = [i / n for i in range(1, n)]
    bounds = docs.agg(F.percentile_approx("key", at, 10_000)).first()[0] if at else []
    bounds = np.array(sorted(set(bounds or [])), "int64")

    def chain_of(keys: np.ndarray) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, keys, "right")

    def first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.sort(batch.column("key").to_numpy())
            chains, last = np.unique(chain_of(keys)[::-1], return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(chains, pa.int64()), pa.array(keys[::-1][last])], names=["chain", "key"])

    firsts = dict(docs.select("key").mapInArrow(first_keys, "chain long, key long").groupBy("chain").agg(F.max("key")).collect())
    chains = sorted(firsts)
    keys = np.array([firsts[c] for c in chains][::-1], "int64")  # ascending
    before = np.array([chains[i - 1] for i in range(len(chains))][::-1], "int64")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            extra = np.flatnonzero(keys[spot] == key)
            for rows, chain, is_extra in ((batch, chain_of(key), False), (batch.take(pa.array(extra)), before[spot[extra]], True)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chain, pa.int64()), pa.array(np.full(len(chain), is_extra)), *rows.columns],
                    names=["chain", "extra", *rows.schema.names])

    dealt = docs.mapInArrow(place, "chain long, extra boolean, doc_id long, text string, key long")
    n_chains = len(bounds) + 1
    return (dealt.repartitionById(n_chains, F.col("chain").cast("int"))
            .sortWithinPartitions("chain", "extra", F.col("key").desc(), "text").drop("key"), n_chains)


def edited_neighbours(docs: DataFrame, k: int = K, shingle: int = SHINGLE_CHARS,
                      partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_shingles (estimate) and
    contained_in_edited.

    The edited text is the text with its last third replaced by the beginning of
    the next document, in descending doc_id order (after the last: the first).
    near_edited and near_next are the estimated resemblance of the text's
    fingerprint to the edited text's and the next document's.  A null text is
    empty; repeated rows follow each other in text order; a null doc_id is last;
    a single document follows itself; an empty table gives no rows; other
    columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last, done = [], None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("chain", "extra", "doc_id", "text")]
            for chain, extra, doc_id, text in zip(*columns):
                if chain == done:  # repeats of the first document of the next range
                    continue
                own = sketch(text, k, shingle)
                if last is not None:
                    rows.append(_compared(*last, text, own, k, shingle))
                last = None if extra else (doc_id, text, own)
                if extra:
                    done = chain
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                rows = []

    arrow = pa.schema([pa.field(f.name, {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}[f.dataType.simpleString()])
                       for f in _SCHEMA.fields])
    return in_chains(docs, partition_bytes)[0].mapInArrow(run, _SCHEMA)


def _compared(doc_id, text: str, own: np.ndarray, following: str, theirs: np.ndarray, k: int, shingle: int) -> dict:
    changed = edited(text, following)
    new = sketch(changed, k, shingle)
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
            "fingerprint": write_sketch(own), "edited_fingerprint": write_sketch(new),
            "near_edited": resemblance(own, new, k), "near_next": resemblance(own, theirs, k),
            "n_shingles": distinct(own, k), "contained_in_edited": containment(own, new, k)}
