"""Near-duplicates by weighted minwise hashing of word-shingle multisets.

A document is a bag: its five-word shingles with their multiplicities.  Each
shingle's weight axis is cut into dyadic strips, and each strip is a Poisson
process of its own, whose points come in ascending time, have a height in the
strip and fall on one signature component.  A point counts if its height is
below the document's weight; a component keeps its earliest point.  Points
depend on shingle and strip alone, so two documents agree in a component with
probability equal to their weighted Jaccard similarity, and a heavy shingle
costs a strip per doubling, not a process per repeat.

Signatures are banded; documents that share a band are compared by their
whole bags; linked documents form classes.  Within a band's bucket not all
pairs are compared: members are first compared with one pivot, and what is
then still not in one class is settled by comparing the members outside the
bucket's main class with all others, so that classes are those of all pairs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from signalyard.llm.common import numbered, text_or_empty
from signalyard.session import materialise

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Bands and components in a band: a pair at 0.8 shares no band with probability 3e-5.
BANDS, ROWS = 26, 5

#: Pairs compared in one group, and the members outside the main class of a
#: bucket that are compared with all of it (four times as many each round).
_GROUP_PAIRS = 256
_FEW = 32
#: Cells that a bag's shingles are counted in, to bound how many two bags share.
_CELLS = 128
#: Bytes of a shingle's hash: two unlike shingles of two bags of a thousand words
#: share one with probability 4e-9.
_HASH_BYTES = 6
#: Partitions of a shuffle whose few rows one task writes, one after the other: a
#: task that writes files takes ten times as long to start as one that doesn't.
_WRITTEN_TOGETHER = 8
#: Words whose signatures are made at a time.
_BATCH_WORDS = 1_000_000

_MULT = np.uint64(0x9E3779B97F4A7C15)
_SIGNED = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
                        T.StructField("words_sha", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bag(words: list[str], shingle: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of 48 bits, multiplicities).  Fewer words
    than a shingle are one shingle; no words are an empty bag."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - shingle + 1)
    width = min(shingle, len(h))
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = _mix(out * _MULT + h[i:i + n])
    return np.unique(out >> np.uint64(64 - 8 * _HASH_BYTES), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two bags; of two empty ones, 1."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """Earliest point times, (documents, m); rows of empty bags are infinite."""
    times = np.full((len(bags), m), np.inf)
    sizes = [len(b[0]) for b in bags]
    if not sum(sizes):
        return times
    doc = np.repeat(np.arange(len(bags)), sizes)
    element = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags])
    # Strip 0 is [0, 1); strip k is [2^(k-1), 2^k).  A weight reaches the strips that begin below it.
    strips = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    doc, weight = np.repeat(doc, strips), np.repeat(weight, strips)
    strip = np.arange(len(doc)) - np.repeat(np.cumsum(strips) - strips, strips)
    low = np.where(strip == 0, 0, 1 << np.maximum(strip - 1, 0))
    width = np.maximum(low, 1).astype(np.float64)
    share = np.minimum(1.0, (weight - low) / width)  # of the strip that lies below the weight
    seed = _mix(np.repeat(element, strips) + strip.astype(np.uint64) * _MULT)
    time, step = np.zeros(len(doc)), np.uint64(0)
    flat = times.reshape(-1)
    while len(doc):
        # the next points of every process; several at once when few are left
        burst = int(min(64, max(1, 50_000 // len(doc))))
        at = (np.arange(1, burst + 1, dtype=np.uint64) + step) * _MULT
        a = _mix(seed[:, None] + at)
        wait = -np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width[:, None]
        # added one by one from the last time, so that bursts don't change the sums
        points = np.cumsum(np.concatenate([time[:, None], wait], axis=1), axis=1)[:, 1:]
        b = _mix(a + _MULT)
        component = ((b >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        below = (b & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32 < share[:, None]
        place = doc[:, None] * m + component.astype(np.int64)
        np.minimum.at(flat, place[below], points[below])
        step += np.uint64(burst)
        time = points[:, -1]
        going = time < times.max(axis=1)[doc]
        doc, seed, width, share, time = doc[going], seed[going], width[going], share[going], time[going]
    return times


def band_keys(times: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per document and band, of the band's number and components."""
    raw = times.view(np.uint64).reshape(len(times), -1)[:, :bands * rows].reshape(len(times), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(times), bands))
    for r in range(rows):
        key = _mix(key * _MULT + raw[:, :, r])
    return key.view(np.int64)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df``, of numbers mostly, materialised by fewer tasks than a shuffle has
    partitions, though by two a core at least.  There are dozens of such tables, so
    that a task and a file for each partition would be most of the time; and with
    fewer footers more of them are small enough to be broadcast."""
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // _WRITTEN_TOGETHER)
    return materialise(df.coalesce(tasks), name)


def _with_rows(docs: DataFrame) -> DataFrame:
    return docs.select("row", F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty().alias("text"))


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """row, doc_id, words_sha (of the words, so of texts with equal bags) and
    bands (null for a text without words) of a table from common.numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, start = batch.column("text").to_pylist(), 0
            while start < len(texts):
                bags, shas, n = [], [], 0
                for text in texts[start:]:
                    words = text.split()
                    bags.append(bag(words))
                    shas.append(hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).digest())
                    n += len(words)
                    if n >= _BATCH_WORDS:
                        break
                keys = band_keys(signatures(bags, bands * rows), bands, rows).tolist()
                end = start + len(bags)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, len(bags)), batch.column("doc_id").slice(start, len(bags)), pa.array(shas, pa.binary()),
                     pa.array([k if len(b[0]) else None for k, b in zip(keys, bags)], pa.list_(pa.int64()))],
                    names=_SIGNED.names)
                start = end

    return _with_rows(docs).mapInArrow(run, _SIGNED)


def _only(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose numbers ``wanted`` has, by a bitmap: rows are
    numbered without gaps within a partition, so it takes little more than a bit
    a document, and Spark broadcasts it where the numbers themselves would have
    the rows of ``docs`` (whole texts, bands or bags) shuffled.  The numbers of a
    bucket meet before its bitmap is made: a bitmap of every bucket from every
    task would grow with the square of the tasks."""
    placed = wanted.select(F.bitmap_bucket_number("row").alias("bucket"), F.bitmap_bit_position("row").alias("bit")).repartition("bucket")
    bits = _written(placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "near-wanted")
    at = F.bitmap_bit_position("row").cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (docs.withColumn("bucket", F.bitmap_bucket_number("row")).join(bits, "bucket")
            .filter(F.getbit(byte, at % 8) == 1).select(*docs.columns))


def _bags(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """row, size (shingles, repeats counted), cells (shingles by hash cell), hashes,
    counts (as bytes; no counts if all are 1) of the rows ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [bag(t.split()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                 pa.array([_write_cells(np.bincount((h % np.uint64(_CELLS)).astype(np.int64), c, _CELLS)) for h, c in bags], pa.binary()),
                 pa.array([_write_hashes(h) for h, _ in bags], pa.binary()),
                 pa.array([c.astype("<u4").tobytes() if len(c) and c.max() > 1 else b"" for _, c in bags], pa.binary())],
                names=["row", "size", "cells", "hashes", "counts"])

    return (_only(_with_rows(docs).select("row", "text"), wanted)
            .mapInArrow(run, "row long, size long, cells binary, hashes binary, counts binary"))


def _own_shingles(bags: DataFrame) -> DataFrame:
    """row, own: how many of its shingles (repeats counted) no other row of
    ``bags`` has, for rows that have such."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, counts in zip(*(batch.column(c).to_pylist() for c in ("row", "hashes", "counts"))):
                h, c = _read_bag(hashes, counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), row), pa.int64()), pa.array(h.view(np.int64)), pa.array(c)],
                                                 names=["row", "shingle", "weight"])

    held = bags.mapInArrow(run, "row long, shingle long, weight long")
    return (held.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("row"), F.sum("weight").alias("weight"))
            .filter("rows = 1").groupBy("row").agg(F.sum("weight").alias("own")))


def _write_hashes(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES].tobytes()


def _read_bag(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.zeros((len(hashes) // _HASH_BYTES, 8), np.uint8)
    raw[:, :_HASH_BYTES] = np.frombuffer(hashes, np.uint8).reshape(-1, _HASH_BYTES)
    h = raw.view("<u8").ravel()
    return h, np.frombuffer(counts, "<u4").astype(np.int64) if counts else np.ones(len(h), np.int64)


def _write_cells(cells: np.ndarray) -> bytes:
    """Counts in the narrowest of 4, 8, 16 and 32 bits that holds them all; the length tells which."""
    most = cells.max(initial=0)
    if most < 16:
        c = cells.astype(np.uint8)
        return (c[::2] | c[1::2] << 4).tobytes()
    return cells.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def _read_cells(raw: bytes) -> np.ndarray:
    if 2 * len(raw) == _CELLS:
        c = np.frombuffer(raw, np.uint8)
        return np.stack([c & 15, c >> 4], axis=1).ravel().astype(np.uint32)
    return np.frombuffer(raw, f"<u{len(raw) // _CELLS}").astype(np.uint32)


def _compared(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (pivot, member) with the similarity of their bags.

    Pairs are dealt by pivot in groups of a bounded size; a group has the pivot's
    bag first and then its members' bags, which are read one after the other."""
    per_pivot = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / _GROUP_PAIRS).cast("long").alias("groups"))
    dealt = pairs.join(per_pivot, "pivot").withColumn("deal", F.pmod(F.xxhash64("member"), F.col("groups"))).drop("groups")
    dealt = _written(dealt, "near-pairs")
    members = dealt.join(bags, F.col("member") == F.col("row")).select("pivot", "deal", F.col("member"), "hashes", "counts")
    pivots = (dealt.select("pivot", "deal").distinct().join(bags, F.col("pivot") == F.col("row"))
              .select("pivot", "deal", F.lit(None).cast("long").alias("member"), "hashes", "counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, None
        for batch in batches:
            out: list[tuple[int, int, float]] = []
            for pivot, deal, member, hashes, counts in zip(*(c.to_pylist() for c in batch.columns)):
                this = _read_bag(hashes, counts)
                if member is None:
                    group, own = (pivot, deal), this
                elif (pivot, deal) != group:
                    raise ValueError("a group without its pivot")
                else:
                    out.append((pivot, member, similarity(own, this)))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                              pa.array(columns[2], pa.float64())], names=["pivot", "member", "similarity"])

    return (members.unionByName(pivots).repartition("pivot", "deal").sortWithinPartitions("pivot", "deal", F.col("member").asc_nulls_first())
            .mapInArrow(run, "pivot long, member long, similarity double"))


_ABOUT = ["from", "far", "size", "shared", "cells"]


def _possible_pairs(told: DataFrame, chosen: DataFrame, about: DataFrame, threshold: float) -> DataFrame:
    """(pivot, member), each pair once: of each bucket the ``chosen`` rows with the
    rows of other classes that they can be linked to.  A pair that meets in several
    buckets is told in the smallest of them alone: a chosen row carries the buckets
    that it is chosen in, any other the buckets that it is in.  ``told`` and
    ``chosen`` have key, row and label alone, and ``about`` what the bounds need, once
    a row: it joins last, as a row is in many buckets.

    A bucket's rows are dealt in groups of a bounded size, and each group gets the
    bucket's chosen rows, which are few, first.  A pair is left out if an exact
    bound says that its similarity is below the threshold: by the distances from a
    common pivot, by the shingles that other rows have too, or by the shingles per
    cell, of which two bags share at most the smaller number."""
    groups = told.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / _GROUP_PAIRS).cast("long").alias("groups"))
    keyed = lambda of: about.select("row", *_ABOUT).join(of.groupBy("row").agg(
        F.sort_array(F.collect_set("key")).alias("keys")), "row")  # at most a key a band
    members = (told.select("key", "row", "label").join(groups, "key").join(keyed(told), "row")
               .withColumn("deal", F.pmod(F.xxhash64("row"), F.col("groups"))).withColumn("member", F.lit(True)))
    pivots = (chosen.select("key", "row", "label").join(groups, "key").join(keyed(chosen), "row")
              .withColumn("deal", F.explode(F.expr("sequence(0, groups - 1)"))).withColumn("member", F.lit(False)))
    least, reach = threshold - 1e-9, 1 - threshold + 1e-9
    columns = ["key", "deal", "member", "row", "label", *_ABOUT, "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, arrays = None, [], None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for key, deal, member, *row_about in zip(*(batch.column(c).to_pylist() for c in columns)):
                if (key, deal) != group:
                    group, held, arrays = (key, deal), [], None
                if not member:
                    held.append(row_about)
                    continue
                if arrays is None:
                    rows, labels, origins, fars, sizes, shared, cells, chosen_in = zip(*held)
                    buckets = np.full((len(rows), max(map(len, chosen_in))), np.iinfo(np.int64).max)
                    for i, some in enumerate(chosen_in):
                        buckets[i, :len(some)] = some
                    arrays = (np.array(rows), np.array(labels), np.array(origins), np.array(fars), np.array(sizes), np.array(shared),
                              np.stack([_read_cells(c) for c in cells]), buckets)
                rows, labels, origins, fars, sizes, shared, cells, buckets = arrays
                row, label, origin, far, size, common, own, lies_in = row_about
                both = np.minimum(np.minimum(shared, common), np.minimum(cells, _read_cells(own)).sum(axis=1))
                can = ((labels != label) & ((origins != origin) | (np.abs(fars - far) <= reach))
                       & (both >= least * (sizes + size - both)))
                can = np.flatnonzero(can)
                if len(can):  # where the smallest common bucket is this one
                    common_ones = np.isin(buckets[can], lies_in)
                    can = can[buckets[can, common_ones.argmax(axis=1)] == key]
                out += [(min(row, p), max(row, p)) for p in rows[can].tolist()]
            lists = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in lists], names=["pivot", "member"])

    dealt = members.unionByName(pivots).select(*columns).repartition("key", "deal").sortWithinPartitions("key", "deal", "member")
    return dealt.mapInArrow(run, "pivot long, member long").distinct()


def components(links: DataFrame) -> DataFrame:
    """row, label of every row in ``links`` (pivot, member): the smallest row
    that it is connected to.  Labels spread to neighbours and then jump to their
    label's label, until none changes."""
    both = _written(links.select(F.col("pivot").alias("row"), F.col("member").alias("to"))
                       .unionByName(links.select(F.col("member").alias("row"), F.col("pivot").alias("to"))).distinct(), "near-edges")
    labels = _written(both.groupBy("row").agg(F.least(F.col("row"), F.min("to")).alias("label")), "near-labels")
    while True:
        around = both.join(labels.withColumnsRenamed({"row": "to", "label": "near"}), "to").groupBy("row").agg(F.min("near").alias("near"))
        spread = _written(labels.join(around, "row").select(
            "row", F.least("label", "near").alias("label"), F.col("label").alias("old")), "near-spread")
        roots = spread.select(F.col("row").alias("label"), F.col("label").alias("root"))
        jumped = _written(spread.join(roots, "label").select("row", F.least("label", "root").alias("label"), "old"), "near-labels")
        labels = jumped.select("row", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels


def _relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (row, label) with the links ``found`` (pivot, member) taken in:
    only links between different labels are followed."""
    ends = found
    for end in ("pivot", "member"):
        ends = ends.join(labels.select(F.col("row").alias(end), F.col("label").alias(f"{end}_label")), end, "left").withColumn(
            f"{end}_label", F.coalesce(f"{end}_label", end))
    ends = _written(ends, "near-ends")
    between = _written(ends.filter("pivot_label <> member_label").select(
        F.least("pivot_label", "member_label").alias("pivot"), F.greatest("pivot_label", "member_label").alias("member")).distinct(), "near-between")
    if between.isEmpty():
        return labels
    joined = components(between).select(F.col("row").alias("label"), F.col("label").alias("new"))
    linked = ends.select(F.col("pivot").alias("row")).unionByName(ends.select(F.col("member").alias("row"))).distinct()
    rows = labels.unionByName(linked.join(labels, "row", "left_anti").select("row", F.col("row").alias("label")))
    return _written(rows.join(joined, "label", "left").select("row", F.coalesce("new", "label").alias("label")), "near-labels")


def _settle(docs: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """row, label of the rows that are linked to another within a bucket of
    ``members`` (key, row, pivot: the bucket's smallest row), as if all pairs of
    each bucket had been compared.

    First each row is compared with one pivot, the smallest of its buckets'.
    Buckets that then hold several classes remain, and two exact bounds tell
    which of their rows cannot be linked and need no comparison.  The distance
    (1 - similarity) is a metric, so the distances of linked rows from one pivot
    differ by at most 1 - threshold.  And shingles that a row shares with no
    other remaining row count in every union and in no intersection (see
    _possible_pairs for one more).  Then, while a bucket holds several classes, either its few members outside
    its largest class are compared with all members of other classes, after which
    all their links are known and they leave the bucket, or, if they are many,
    they are compared with some members of the largest class, which then leave."""
    spark = docs.sparkSession
    bags = materialise(_bags(docs, members), "near-bags")
    star = members.groupBy("row").agg(F.min("pivot").alias("pivot")).filter("row <> pivot")
    first = materialise(_compared(star.select("pivot", F.col("row").alias("member")), bags), "near-star")
    links = first.filter(F.col("similarity") >= threshold).select("pivot", "member")
    labels = components(links) if not links.isEmpty() else spark.createDataFrame([], "row long, label long")
    split = (members.select("key", "row").join(labels, "row", "left").groupBy("key")
             .agg(F.min(F.coalesce("label", "row")).alias("lo"), F.max(F.coalesce("label", "row")).alias("hi"))
             .filter("lo <> hi").select("key"))
    left = _written(members.select("key", "row").join(split, "key"), "near-left")
    left_bags = materialise(_only(bags, left), "near-left-bags")
    far = first.select(F.col("member").alias("row"), F.col("pivot").alias("from"), (1 - F.col("similarity")).alias("far"))
    # What the bounds need of a row, once: buckets have its number alone.  A row
    # that is its own smallest pivot lies at distance 0 from it.
    about = _written(
        left_bags.select("row", "size", "cells").join(far, "row", "left").join(_own_shingles(left_bags), "row", "left").select(
            "row", F.coalesce("from", "row").alias("from"), F.coalesce("far", F.lit(0.0)).alias("far"), "size",
            (F.col("size") - F.coalesce("own", F.lit(0))).alias("shared"), "cells")
        .filter(F.col("shared") >= (threshold - 1e-9) * F.col("size")), "near-about")
    open_ = _written(left.join(about.select("row"), "row", "left_semi"), "near-open")
    few = _FEW
    while True:
        labelled = open_.join(labels, "row", "left").withColumn("label", F.coalesce("label", "row"))
        # Of each bucket with several classes: its largest class, and how many are outside it.
        main = _written(
            labelled.groupBy("key", "label").count().groupBy("key")
            .agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("all"), F.min("label").alias("lo"), F.max("label").alias("hi"))
            .filter("lo <> hi").select("key", F.col("top.label").alias("main"), (F.col("all") - F.col("top.count") <= few).alias("few")), "near-main")
        if main.isEmpty():
            return labels
        told = _written(labelled.join(main, "key").withColumn("out", F.col("label") != F.col("main"))
                           .select("key", "row", "label", "few", "out"), "near-told")
        score = F.xxhash64("row", F.lit(few))
        chosen = _written(told.filter("few and out").select("key", "row", "label").unionByName(
            told.filter("not few and not out").groupBy("key", F.pmod(F.hash("row"), F.lit(few // 4)).alias("slot"))
            .agg(F.min(F.struct(score.alias("score"), "row", "label")).alias("best")).select("key", "best.row", "best.label")), "near-chosen")
        found = _compared(_written(_possible_pairs(told, chosen, about, threshold), "near-possible"), left_bags).filter(F.col("similarity") >= threshold).select("pivot", "member")
        labels = _relabelled(labels, found)
        open_ = _written(told.select("key", "row").join(chosen.select("key", "row"), ["key", "row"], "left_anti"), "near-open")
        few *= 4


def near_classes(docs: DataFrame, threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id, class_size, kept of every row of ``docs`` (and row, its
    number in the written copy that is read); the first row of a class is kept.

    Rows whose bags are alike, directly or over others, have one class; its id is
    the smallest doc_id of it.  Texts of the same words are one class without a
    comparison, all texts without words among them; a null text is empty; a null
    doc_id takes part (a class of such rows alone has a null id); repeated rows
    are copies; an empty table gives no rows; other columns are not read.
    ``docs`` is read once."""
    return numbered_classes(numbered(docs, ("doc_id", "text")), threshold, bands, rows)


def numbered_classes(docs: DataFrame, threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """near_classes of a table that common.numbered wrote, with its rows."""
    table = materialise(signed(docs, bands, rows), "near-signed")
    copies = _written(table.groupBy("words_sha").agg(F.min("row").alias("first")), "near-copies")
    firsts = materialise(_only(table.select("row", "bands").filter("bands is not null"),
                               copies.select(F.col("first").alias("row"))), "near-firsts")
    keyed = firsts.select(F.explode("bands").alias("key"), "row")
    # Most keys are of one row: only the others' rows are looked at for a pivot.
    shared = _written(keyed.groupBy("key").count().filter("count > 1").select("key"), "near-buckets")
    members = _written(keyed.join(shared, "key"), "near-shared")
    pivots = _written(members.groupBy("key").agg(F.min("row").alias("pivot")), "near-pivots")
    labels = _settle(docs, _written(members.join(pivots, "key"), "near-members"), threshold)
    named = copies.join(labels.withColumnRenamed("row", "first"), "first", "left").select(
        "words_sha", F.coalesce("label", "first").alias("label"))
    told = _written(table.select("row", "doc_id", "words_sha").join(_written(named, "near-named"), "words_sha")
                       .drop("words_sha"), "near-told")
    classes = _written(told.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "near-classes")
    return told.join(classes, "label").select(
        "doc_id", "class_id", "class_size", (F.col("row") == F.col("label")).alias("kept"), "row")
