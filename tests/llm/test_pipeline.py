import random
from collections import Counter, defaultdict

import corpus_pipeline as cp
from signalyard.llm import toxicity
from signalyard.llm.common import COLUMNS, shared_path
from tests.llm.test_bagminhash import brute, edit
from tests.llm.test_mixing import targets
from tests.llm.test_packing import plain_ids
from tests.llm.test_toxicity import corpus
from tests.llm.util import awkward, docs


def make(spark):
    rng = random.Random(12)
    rows, labels = corpus(rng, 400)
    rows = [(i + 10_000, t, rng.choice(["a", "b", "hot", "hot", "hot"])) for i, t in rows]
    labels = [(i + 10_000, t) for i, t in labels]
    rows += [(20_000 + i, rows[i][1], "b") for i in range(0, 40)]
    rows += [(30_000 + i, edit(rng, rows[i][1], 1), None) for i in range(40, 80)]
    rows += [r if len(r) > 2 else (*r, "s") for r in awkward() if not r[1] or len(r[1]) < 50_000]
    folder = shared_path(spark, "sf")
    docs(spark, rows, row=3, kept="clash").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def stage(spark, k, table, folder):
    out = shared_path(spark, "stage")
    cp.STAGES[k][1](spark, table, folder).write.parquet(out)
    return spark.read.parquet(out)


def triples(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_each_stage_against_brute_force(spark):
    folder = make(spark)
    table = spark.read.parquet(f"{folder}/documents.parquet")

    clean = stage(spark, 0, table, folder)
    assert clean.columns == list(COLUMNS)
    scored = toxicity.report(table, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    rejected = {r.doc_id for r in scored if r.predicted}
    assert rejected and Counter(triples(clean)) == Counter(t for t in triples(table) if t[0] not in rejected)

    once = stage(spark, 1, clean, folder)
    largest = {}
    for doc_id, text, _ in triples(clean):
        key = text or ""
        largest[key] = max(largest.get(key, (-1, None)), (-1 if doc_id is None else doc_id, text), key=lambda x: x[0])
    assert sorted(((-1 if d is None else d, t or "") for d, t, _ in triples(once))) == sorted((d, k) for k, (d, _) in largest.items())

    apart = stage(spark, 2, once, folder)
    before, after = triples(once), triples(apart)
    groups = brute(before)
    left = Counter(str(d) for d, _, _ in after)
    assert len(after) == len(groups) and all(sum(left[d] for d in g) == 1 for g in groups)
    assert set(after) <= set(before)

    mixed = stage(spark, 3, apart, folder)
    assert mixed.columns == list(COLUMNS)
    sizes, longest, got = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in after:
        n = len((text or "").split())
        sizes[source] += n
        longest[source] = max(longest[source], n)
    copies = Counter(triples(mixed))
    assert set(copies) <= set(after) and max(copies.values()) <= 3
    for (_, text, source), n in copies.items():
        got[source] += n * len(text.split())
    for source, goal in targets(sizes).items():
        assert abs(got[source] - goal) <= longest[source]

    packed = stage(spark, 4, mixed, folder)
    tokens = Counter()
    for r in packed.collect():
        tokens[r.doc_id] += r.length
    want = Counter()
    for doc_id, text, _ in triples(mixed):
        want[doc_id] += len(plain_ids(text, 0))
    assert tokens == want


def test_run_and_empty_tables(spark):
    folder = shared_path(spark, "sf")
    docs(spark, []).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert cp.run(spark, folder).count() == 0
    assert {"sequence_id", "offset"} <= set(cp.run(spark, make(spark)).columns)
