import hashlib
import random
import re

from pyspark.sql import functions as F

from signalyard.llm.common import shared_path
from signalyard.llm.secret_scan import BASE, MORE, read_ledger, report, scan
from tests.llm.util import awkward, docs

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def rows(rng):
    bits = ["token", "Secret", "API_KEY", "apikey", "passwd", "password", " ", " = ", ":", "=", '"', "'", "AKIA", "AKIAIOSF",
            "ABCDEFGH12345678", "0123456789abcdef", "deadbeefdeadbeef", "é", "🎉", "short", "abcdefghijklm", "\n", "x", "==",
            "ſecret", "ghp_" + "a1" * 20]
    out = awkward() + [(500 + i, "".join(rng.choice(bits) for _ in range(rng.randrange(25)))) for i in range(400)]
    out += [(2000 + i, 'copied token = "f33e61083db5dbdf4bd2369d2f80176e"') for i in range(40)]
    return out + [(3000, "token: secret: abcdefghijklmnop"), (3001, "token=password=abcdefghijklmnop")]


def test_report_equals_regular_expressions(spark):
    data = rows(random.Random(2))
    got = report(docs(spark, data, blob="clash", found=1), shared_path(spark, "ledger")).collect()
    want = []
    for r in data:
        found = base(r[1] or "")
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        n = [sum(f[3] == k for f in found) for k in ("assign", "access", "hex")]
        want.append((r[0], *n, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    texts = {r[0]: r[1] or "" for r in data}
    for r in got:
        if r.doc_id is None or r.doc_id == 8:
            continue
        parts = [p.split(":") for p in r.spans.split(",") if p]
        assert [p for p in parts if p[0] in ("assign", "access", "hex")] == [[k, str(a), str(b)] for a, _, b, k in base(texts[r.doc_id])]
        for kind, a, b in parts:
            if kind == "github":
                assert texts[r.doc_id][int(a):int(b)].startswith("ghp_")


def test_only_unseen_pairs_are_scanned(spark):
    path = shared_path(spark, "ledger")
    first = docs(spark, [(1, "token = abcdefghijklmnop"), (2, "token = abcdefghijklmnop"), (3, "clean")])
    scan(first, path, BASE).count()
    assert read_ledger(spark, path).count() == 2
    more = docs(spark, [(1, "token = abcdefghijklmnop"), (4, "ghp_" + "z9" * 20), (5, None)])
    scan(more, path, BASE).count()
    assert read_ledger(spark, path).count() == 4  # two new blobs
    out = {r.doc_id: [f.rule for f in r.found] for r in scan(more, path, BASE + MORE).collect()}
    assert out == {1: ["assign@1"], 4: ["github@2"], 5: []}
    pairs = read_ledger(spark, path).select("blob", F.explode("rules").alias("rule"))
    assert pairs.count() == pairs.distinct().count()
    # the rows of the third scan hold the new rule version alone
    assert pairs.filter("rule like '%@2'").select("blob").distinct().count() == 3


def test_empty_table(spark):
    assert report(docs(spark, []), shared_path(spark, "ledger")).count() == 0
