"""Best-fit packing of documents into fixed-length training sequences.

Documents become token ids in the scan's own tasks (nothing is shuffled but
one small row per document), are dealt into groups of bounded size, and each
group is packed by best fit followed by a swap-based local search."""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from signalyard.llm.common import cut, parts_for, text_or_empty
from signalyard.llm.tokens import WordEncoder, slices

SEQUENCE_TOKENS = 2048
#: Documents packed together by one task.
GROUP_DOCS = 5_000

_TOKENS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("crcs", T.ArrayType(T.LongType()))])
_PACKED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
                        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                        T.StructField("ids_crc32", T.LongType()), T.StructField("bin", T.LongType()),
                        T.StructField("offset", T.LongType())])


def token_lengths(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """doc_id, n_tokens (with the end id) and the crc32 of each piece of
    ``capacity`` ids.  A null text is empty: it has the end id alone."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, step = WordEncoder(vocabulary), 4 * capacity
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in slices(texts):
                n, crcs = [], []
                for ids in enc.encode(texts[lo:hi]):
                    ids += end
                    n.append(len(ids) // 4)
                    crcs.append([zlib.crc32(ids[i:i + step]) for i in range(0, len(ids), step)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.array(crcs, pa.list_(pa.int64()))], names=_TOKENS.names)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, _TOKENS)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Each item, in the order given, into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = {}
    frees: list[int] = []  # the free spaces that occur, ascending
    for item, n in enumerate(lengths):
        at = bisect_left(frees, n)
        if at == len(frees):
            free, b = capacity, len(bins)
            bins.append([])
        else:
            free = frees[at]
            b = by_free[free].pop()
            if not by_free[free]:
                del by_free[free]
                frees.pop(at)
        bins[b].append(item)
        if left := free - n:
            if left not in by_free:
                by_free[left] = []
                insort(frees, left)
            by_free[left].append(b)
    return bins


def _exchange(donor: list[int], taker: list[int], lengths: list[int], free: int, lead: int):
    """The best change between two bins as (gain in tokens for the taker,
    items the donor gives, items the taker gives back), or None.

    ``lead`` is the taker's fill less the donor's; with a gain g the squared
    fill changes by 2g(lead + g), so any gain above -lead is an improvement."""
    best, give, back = max(0, -lead), None, None
    n = len(donor)
    for i in range(n):
        x = lengths[donor[i]]
        if best < x <= free:  # move
            best, give, back = x, (donor[i],), ()
        for y in taker:  # one for one
            g = x - lengths[y]
            if best < g <= free:
                best, give, back = g, (donor[i],), (y,)
        if best == free:
            break
        for j in range(i + 1, n):  # two for one
            xx = x + lengths[donor[j]]
            if best < xx <= free:
                best, give, back = xx, (donor[i], donor[j]), ()
            elif xx > free:
                for y in taker:
                    g = xx - lengths[y]
                    if best < g <= free:
                        best, give, back = g, (donor[i], donor[j]), (y,)
    return None if give is None else (best, give, back)


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Moves, one-for-one and two-for-one exchanges between underfull bins.

    The least filled bin is the donor; each change raises the sum of squared
    fills, so the search ends.  A donor that comes to hold nothing is dropped;
    one that no change helps is set aside.  Stops at the fewest bins possible."""
    least = -(-sum(lengths) // capacity)
    fill = {b: sum(lengths[i] for i in items) for b, items in enumerate(bins)}
    done = [items for b, items in enumerate(bins) if fill[b] == capacity]
    fill = {b: n for b, n in fill.items() if n < capacity}
    donors = [(n, b) for b, n in fill.items()]
    heapq.heapify(donors)
    takers = sorted((capacity - n, b) for b, n in fill.items())  # by free space
    n_bins = len(bins)
    while donors and n_bins > least:
        level, d = heapq.heappop(donors)
        if fill.get(d) != level:
            continue
        takers.remove((capacity - level, d))
        changed = True
        while changed and bins[d]:
            changed = False
            for k in range(len(takers)):
                free, t = takers[k]
                found = _exchange(bins[d], bins[t], lengths, free, fill[t] - fill[d])
                if not found:
                    continue
                gain, give, back = found
                bins[d] = [i for i in bins[d] if i not in give] + list(back)
                bins[t] = [i for i in bins[t] if i not in back] + list(give)
                fill[d] -= gain
                fill[t] += gain
                takers.pop(k)
                changed = True
                if free == gain:
                    done.append(bins[t])
                    del fill[t]
                else:
                    insort(takers, (free - gain, t))
                    heapq.heappush(donors, (fill[t], t))
                break
        if bins[d]:
            done.append(bins[d])
        else:
            n_bins -= 1
        del fill[d]
    return done + [bins[b] for b in fill]


def pack_group(rows: pd.DataFrame, capacity: int = SEQUENCE_TOKENS) -> pd.DataFrame:
    """One group's documents as placed pieces.  Whole-length pieces fill a bin
    each; the rest are packed.  Rows are put in a fixed order first, so the
    same documents always give the same bins."""
    rows = rows.assign(key=[tuple(c) for c in rows["crcs"]]).sort_values(["doc_id", "n_tokens", "key"], kind="stable")
    ids, totals, crcs = rows["doc_id"].tolist(), rows["n_tokens"].tolist(), rows["crcs"].tolist()
    ids = [None if pd.isna(i) else int(i) for i in ids]
    out: list[tuple] = []
    tails: list[tuple[int, int]] = []
    bin_id = 0
    for k, total in enumerate(totals):
        for piece in range(len(crcs[k])):
            start = piece * capacity
            if total - start >= capacity:
                out.append((ids[k], piece, start, capacity, int(crcs[k][piece]), bin_id, 0))
                bin_id += 1
            else:
                tails.append((k, piece))
    lengths = [totals[k] - piece * capacity for k, piece in tails]
    longest_first = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins = [[longest_first[i] for i in b] for b in best_fit([lengths[i] for i in longest_first], capacity)]
    for items in local_search(bins, lengths, capacity):
        offset = 0
        for i in items:
            k, piece = tails[i]
            out.append((ids[k], piece, piece * capacity, lengths[i], int(crcs[k][piece]), bin_id, offset))
            offset += lengths[i]
        bin_id += 1
    frame = pd.DataFrame(out, columns=_PACKED.names)
    return frame.astype({"doc_id": "Int64", "piece": "int32"} | {c: "int64" for c in ("start", "length", "ids_crc32", "bin", "offset")})


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = SEQUENCE_TOKENS,
         group_docs: int = GROUP_DOCS) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.  Only documents longer than ``capacity`` are cut.

    Null or empty texts are one end id; a null doc_id stays null; repeated
    rows are packed once each; an empty table gives no rows; other columns of
    ``docs`` are not read.  Token counts are written to the shared folder
    before grouping, so a row's group (its position there) never changes when
    a task is run again, and no copy or source can fill a group."""
    lengths = cut(token_lengths(docs, vocabulary, end_id, capacity))
    groups = parts_for(lengths.count(), group_docs)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        packed = pack_group(rows, capacity)
        packed["bin"] += key[0] << 32
        return packed

    dealt = lengths.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return (dealt.repartitionById(groups, F.col("group").cast("int")).groupBy("group").applyInPandas(run, _PACKED)
            .withColumnRenamed("bin", "sequence_id"))
