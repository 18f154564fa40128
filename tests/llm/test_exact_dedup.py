import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from signalyard.llm.exact_dedup import exact_groups
from tests.llm.util import awkward, docs


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        stays = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not stays, sha))
            stays |= i == keep
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [4, 7, 4096])
def test_groups_equal_brute_force(spark, block):
    rng = random.Random(block)
    rows = awkward()[:4] + awkward()[5:] + [(1000 + i, "".join(rng.choice("ab🎉") for _ in range(rng.randrange(12)))) for i in range(200)]
    rows += [(2000 + i, "a copied text over several blocks " * 3) for i in range(50)]
    rows += [(3000 + i, "x" * i) for i in range(30)]
    assert got(exact_groups(docs(spark, rows, row=1, name="clash", kept=2), block)) == brute(rows)


def test_blocks_that_share_an_alias_stay_apart(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abc") for _ in range(rng.randrange(20)))) for i in range(200)]
    weak = lambda b: F.xxhash64(b) % 3
    assert got(exact_groups(docs(spark, rows), 3, weak)) == brute(rows)


def test_empty_table(spark):
    df = exact_groups(docs(spark, []))
    assert df.count() == 0
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "row"]
