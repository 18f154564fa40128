"""Token-id shards with a minimal perfect hash index.

A store is a folder of

* ``shard-NNNNN.ids``: raw little-endian ids, documents one after the other in
  ascending doc_id order across all shards, two bytes an id if the vocabulary
  allows, else four;
* ``index-NNNNN.mph``: for the keys of one hash range, a minimal perfect hash
  (levels of bit arrays with ranks) and, by its value, one record: key
  fingerprint, shard, offset in the shard, start in the whole, length.

A lookup hashes the key, reads a few words of one index file and one record,
compares the fingerprint, and then reads the document's ids alone."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from signalyard.llm.common import cut, parts_for, text_or_empty
from signalyard.llm.files import WholeFile, open_store, uri
from signalyard.llm.tokens import WordEncoder, slices

#: Text bytes a shard is made from, and keys in an index part.
SHARD_BYTES = 32 << 20
INDEX_KEYS = 200_000

_MAGIC = 0x3130494B4F54  # "TOKI01"
_RECORD = np.dtype([("print", "<u8"), ("shard", "<i8"), ("offset", "<i8"), ("start", "<i8"), ("length", "<i8")])
_NULL_KEY = np.uint64(0x9E3779B97F4A7C15)

_ENTRY = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "nth", "shard", "offset", "length")])
_PLACE = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "nth", "shard", "offset", "start", "length")])
_READ = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])


# -- minimal perfect hash ----------------------------------------------------

def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_id: np.ndarray, null: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """64 bits of a key: a doc_id (or null) and which of its repeats.  One to
    one on first occurrences, so only repeats can meet (they then share a hash
    and build() says so)."""
    h = _mix(np.where(null, _NULL_KEY, doc_id.astype("<u8")), 1)
    h = np.where(null, _mix(h, 2), h)
    return np.where(nth == 0, h, _mix(h + nth.astype("<u8"), 3))


def build(hashes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(levels of bits, value of each hash).  A level has a bit a key; keys
    alone at their bit stay, the others go on to the next level.  The value is
    the rank of the key's bit over all levels: 0..n-1, each once."""
    if len(np.unique(hashes)) != len(hashes):
        raise ValueError("two keys have one hash")
    levels, rest = [], np.arange(len(hashes))
    values, base = np.empty(len(hashes), "<i8"), 0
    while len(rest):
        size = max(64, -(-2 * len(rest) // 64) * 64)
        pos = (_mix(hashes[rest], 100 + len(levels)) % np.uint64(size)).astype("<i8")
        bits = np.bincount(pos, minlength=size) == 1
        alone = bits[pos]
        rank = np.cumsum(bits) - 1
        values[rest[alone]] = base + rank[pos[alone]]
        base += int(bits.sum())
        levels.append(bits)
        rest = rest[~alone]
    return levels, values


def write_index(path: str, hashes: np.ndarray, records: np.ndarray) -> None:
    """Header, level sizes, then per level its bit words and their ranks, then
    the records by value."""
    levels, values = build(hashes)
    out = WholeFile(path)
    out.write(np.array([_MAGIC, len(hashes), len(levels), *map(len, levels)], "<u8").tobytes())
    base = 0
    for bits in levels:
        words = np.packbits(bits, bitorder="little").view("<u8")
        ranks = base + np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(axis=1))[:-1]])
        out.write(np.stack([words, ranks.astype("<u8")], axis=1).tobytes())
        base += int(bits.sum())
    placed = np.empty(len(hashes), _RECORD)
    placed[values] = records
    out.write(placed.tobytes())
    out.close()


class Index:
    """One index file.  find() reads a few words of it per key."""

    def __init__(self, path: str):
        fs, path = open_store(path)
        self._file = fs.open_input_file(path)
        magic, self._n, n_levels = np.frombuffer(self._file.read_at(24, 0), "<u8").tolist()
        if magic != _MAGIC:
            raise ValueError(f"{path} is not an index")
        self._sizes = np.frombuffer(self._file.read_at(8 * n_levels, 24), "<u8").astype("<i8").tolist()
        self._body = 24 + 8 * n_levels
        self._records = self._body + sum(self._sizes) // 64 * 16
        self._loaded: tuple[np.ndarray, np.ndarray] | None = None

    def find(self, hashed: int) -> np.void | None:
        """The record of a key's hash, or None: constant time."""
        one = np.array([hashed], "<u8")
        at = self._body
        for level, size in enumerate(self._sizes):
            pos = int(_mix(one, 100 + level)[0] % np.uint64(size))
            word, rank = np.frombuffer(self._file.read_at(16, at + pos // 64 * 16), "<u8").tolist()
            if word >> (pos % 64) & 1:
                value = rank + (word & ((1 << (pos % 64)) - 1)).bit_count()
                record = np.frombuffer(self._file.read_at(_RECORD.itemsize, self._records + value * _RECORD.itemsize), _RECORD)[0]
                return record if int(record["print"]) == _print(one)[0] else None
            at += size // 64 * 16
        return None

    def find_all(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, records) of many keys, by one read of the file."""
        if self._loaded is None:
            self._loaded = (
                np.frombuffer(self._file.read_at(self._records - self._body, self._body), "<u8").reshape(-1, 2),
                np.frombuffer(self._file.read_at(_RECORD.itemsize * self._n, self._records), _RECORD))
        tables, records = self._loaded
        values = np.full(len(hashes), -1, "<i8")
        rest, at = np.arange(len(hashes)), 0
        for level, size in enumerate(self._sizes):
            pos = (_mix(hashes[rest], 100 + level) % np.uint64(size)).astype("<i8")
            word, rank = tables[at + pos // 64].T
            bit = (pos % 64).astype("<u8")
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            values[rest[hit]] = (rank + below)[hit].astype("<i8")
            rest, at = rest[~hit], at + size // 64
        found = values >= 0
        out = np.zeros(len(hashes), _RECORD)
        out[found] = records[values[found]]
        found &= out["print"] == _print(hashes)
        return found, out


def _print(hashes: np.ndarray) -> np.ndarray:
    return _mix(hashes, 7)


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (_mix(hashes, 11) % np.uint64(parts)).astype("<i8")


def _hash_frame(frame: pd.DataFrame) -> np.ndarray:
    null = frame["doc_id"].isna().to_numpy()
    return key_hash(frame["doc_id"].fillna(0).to_numpy("int64"), null, frame["nth"].to_numpy("int64"))


# -- writing -----------------------------------------------------------------

class Store:
    """A written store: its folder, width of an id in bytes, and counts of
    shards and index parts."""

    def __init__(self, path: str, width: int, shards: int, parts: int):
        self.path, self.width, self.shards, self.parts = uri(path), width, shards, parts

    def shard(self, k: int) -> str:
        return f"{self.path}/shard-{k:05d}.ids"

    def index(self, k: int) -> str:
        return f"{self.path}/index-{k:05d}.mph"


def write_store(docs: DataFrame, path: str, vocabulary: str, end_id: int, shard_bytes: int = SHARD_BYTES,
                index_keys: int = INDEX_KEYS) -> Store:
    """Write ``docs`` (doc_id, text) as a store at ``path``, a folder that the
    executors share.

    A null text is empty, so it is the end id alone.  A null doc_id comes
    first.  Repeated doc_ids are kept, in text order, and told apart by their
    place among them; they share a shard.  Texts are sorted by doc_id in one
    range shuffle and encoded as they are written; no task holds a shard."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    shards = parts_for(n_bytes, shard_bytes)
    # Two bytes hold an id below 65,536; the vocabulary says which.
    width = 2 if max(WordEncoder(vocabulary).vocabulary_size, end_id + 1) <= 1 << 16 else 4
    store = Store(path, width, 0, 0)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        out, enc = WholeFile(store.shard(shard)), WordEncoder(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        at, last, nth = 0, (), 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo, hi in slices(texts):
                rows = []
                for doc_id, raw in zip(ids[lo:hi], enc.encode(texts[lo:hi]), strict=True):
                    raw += end
                    nth = nth + 1 if last == (doc_id,) else 0
                    last = (doc_id,)
                    rows.append((doc_id, nth, shard, at, len(raw) // 4))
                    out.write(np.frombuffer(raw, "<u4").astype(f"<u{width}").tobytes())
                    at += len(raw) // 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=_ENTRY.names)
        out.close()

    dealt = docs.repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
    entries = cut(dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(write, _ENTRY))

    # One row a shard: where its ids begin among all.
    sizes = dict(entries.groupBy("shard").agg(F.sum("length")).collect())
    store.shards = max(sizes, default=0) + 1
    starts, total = [], 0
    for k in range(store.shards):
        starts.append(total)
        total += sizes.get(k, 0)
    store.parts = parts_for(entries.count(), index_keys)

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            frame["part"] = _part_of(_hash_frame(frame), store.parts)
            yield frame

    def index(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        records = np.empty(len(rows), _RECORD)
        hashes = _hash_frame(rows)
        records["print"] = _print(hashes)
        for name in ("shard", "offset", "length"):
            records[name] = rows[name].to_numpy("int64")
        records["start"] = records["offset"] + np.array(starts, "int64")[records["shard"]]
        write_index(store.index(int(key[0])), hashes, records)
        return pd.DataFrame({"part": [int(key[0])], "keys": [len(rows)]})

    keyed = entries.mapInPandas(parts, T.StructType([*_ENTRY.fields, T.StructField("part", T.LongType())]))
    written = (keyed.repartitionById(store.parts, F.col("part").cast("int")).groupBy("part")
               .applyInPandas(index, "part long, keys long"))
    written.agg(F.sum("keys")).collect()
    return store


# -- reading -----------------------------------------------------------------

def locate(keys: DataFrame, store: Store) -> DataFrame:
    """doc_id, nth, shard, offset, start, length of the keys (doc_id, nth) that
    the store holds, from its index."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            frame["part"] = _part_of(_hash_frame(frame), store.parts)
            yield frame

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, index = None, None
        for frame in batches:
            for part, rows in frame.groupby("part"):
                if part != opened:
                    opened, index = part, Index(store.index(int(part)))
                found, records = index.find_all(_hash_frame(rows))
                yield rows.loc[found, ["doc_id", "nth"]].assign(
                    **{n: records[n][found] for n in ("shard", "offset", "start", "length")})

    keys = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("nth").cast("long").alias("nth"))
    keyed = keys.mapInPandas(parts, "doc_id long, nth long, part long")
    return keyed.repartitionById(store.parts, F.col("part").cast("int")).mapInPandas(find, _PLACE)


def read_documents(places: DataFrame, store: Store) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as unsigned 32-bit) of
    located documents, from the shards' bytes."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, file = None, None
        for frame in batches:
            crcs = []
            for k, offset, length in frame[["shard", "offset", "length"]].itertuples(index=False):
                if k != shard:
                    fs, path = open_store(store.shard(int(k)))
                    shard, file = k, fs.open_input_file(path)
                raw = file.read_at(int(length) * store.width, int(offset) * store.width)
                crcs.append(zlib.crc32(np.frombuffer(raw, f"<u{store.width}").astype("<u4").tobytes()))
            yield frame[["doc_id", "start"]].assign(n_tokens=frame["length"], ids_crc32=np.array(crcs, "int64"))

    return (places.repartitionById(store.shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "offset")
            .mapInPandas(read, _READ))


def lookup(store: Store, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
    """The ids of one document, or None: one index record and one payload read."""
    one = key_hash(np.array([doc_id or 0], "int64"), np.array([doc_id is None]), np.array([nth], "int64"))
    record = Index(store.index(int(_part_of(one, store.parts)[0]))).find(int(one[0]))
    if record is None:
        return None
    fs, path = open_store(store.shard(int(record["shard"])))
    raw = fs.open_input_file(path).read_at(int(record["length"]) * store.width, int(record["offset"]) * store.width)
    return np.frombuffer(raw, f"<u{store.width}").astype("<u4")


def round_trip(spark: SparkSession, docs: DataFrame, path: str, vocabulary: str, end_id: int) -> DataFrame:
    """Write ``docs`` as a store, then read every document back by its key:
    doc_id, start (ids of all documents before it), n_tokens, ids_crc32.  An
    empty table gives no rows; other columns of ``docs`` are not read."""
    store = write_store(docs, path, vocabulary, end_id)
    keys = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().select(
        "doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("nth"))
    return read_documents(locate(keys, store), store)
