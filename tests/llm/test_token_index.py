import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from signalyard.llm import token_index as ti
from signalyard.llm.common import shared_path
from tests.llm.test_packing import plain_ids
from tests.llm.util import awkward, docs, words

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    out, start = [], 0
    for doc_id, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = plain_ids(text, 1)
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_hold_all_documents_in_order(spark):
    rng = random.Random(1)
    rows = awkward() + [(-5, "negative"), (2**62, "large")] + [(1000 + 7 * i, words(rng, rng.randrange(30))) for i in range(300)]
    rng.shuffle(rows)
    store = ti.write_store(docs(spark, rows, nth=4, shard="clash"), shared_path(spark, "store"), PATH, 1, shard_bytes=50_000, index_keys=50)
    assert store.width == 2 and store.shards > 3 and store.parts > 3
    from pyspark.sql import functions as F
    keys = docs(spark, rows).groupBy("doc_id").count().select("doc_id", F.explode(F.sequence(F.lit(0), F.col("count").cast("int") - 1)).alias("nth"))
    got = [tuple(r) for r in ti.read_documents(ti.locate(keys, store), store).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)
    # keyed access to single documents, and to keys that are not there
    assert ti.lookup(store, 4).tolist() == plain_ids("one", 1).tolist()
    assert ti.lookup(store, None).tolist() == plain_ids("no id", 1).tolist()
    assert ti.lookup(store, 8, 1).tolist() == plain_ids("same text here twice over", 1).tolist()
    assert [ti.lookup(store, k) for k in (99, -1, 2**40)] == [None] * 3
    missing = spark.range(5000, 9000).selectExpr("id * 7 + 1 as doc_id", "0 as nth")
    assert ti.locate(missing, store).count() == 0


def test_round_trip_and_empty_table(spark):
    rows = awkward()
    got = ti.round_trip(spark, docs(spark, rows), shared_path(spark, "store"), PATH, 1).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected(rows)
    assert ti.round_trip(spark, docs(spark, []), shared_path(spark, "store"), PATH, 1).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 10_000])
def test_perfect_hash_is_minimal(n):
    hashes = ti._mix(np.arange(n, dtype="<u8"), 5)
    levels, values = ti.build(hashes)
    assert sorted(values.tolist()) == list(range(n))
    assert sum(int(b.sum()) for b in levels) == n


def test_equal_hashes_are_refused():
    with pytest.raises(ValueError):
        ti.build(np.array([1, 2, 1], "<u8"))
