import random
import zlib

from signalyard.llm import toxicity as tx
from tests.llm.util import awkward, docs, words

LEX = {"idiot$": 4.0, "vequ": 3.0}


def features(text):
    return tx.Grammar(LEX).features(text)


def test_contexts_of_matches():
    at = lambda text: int(features(text)[:4].argmax())
    assert at("What an IDIOT!!") == 0
    assert at("you are an idiot") == 1
    assert at("he is not an idiot") == 2
    assert at("she said that idiot came") == 3
    assert at("they said so. idiot") == 0  # another clause
    assert at("not so, idiot") == 0
    assert features("veqution here")[0] > 0 and features("vequ here") is None  # a stem needs more after it
    assert features("I will kill you")[5] > 0 and features("not kill")[6] > 0
    assert features("") is None and features("you said not") is None


def test_weights_by_context_are_learned_where_rows_speak_and_else_the_prior():
    import numpy as np
    rng = np.random.default_rng(0)
    x = np.zeros((400, tx.N_FEATURES))
    y = rng.random(400) < 0.5
    x[:, 0] = np.where(y, 1.0, 0.0) * (rng.random(400) < 0.9)  # plain insults tell
    x[:, 2] = np.where(y, 0.0, 1.0) * (rng.random(400) < 0.9)  # negated ones tell the opposite
    coef, _ = tx.fit(x, y.astype(float), prior=tx.PRIOR)
    assert coef[0] > 2 and coef[2] < -2
    assert coef[1] == tx.PRIOR[1] and coef[3] == tx.PRIOR[3] and coef[4:8] == tx.PRIOR[4:8] and all(c > 0 for c in coef[4:8])


def test_a_text_scores_by_context():
    g = tx.Grammar(LEX, coef=tx.PRIOR, bias=-3.0)
    s = {k: g.score(t) for k, t in {"aimed": "you idiot", "plain": "idiot here", "negated": "not idiot", "reported": "said idiot", "threat": "I kill you",
                                    "bare": "kill time", "none": "a b c"}.items()}
    assert s["aimed"] > s["plain"] > s["negated"] > s["reported"] > s["none"] and s["threat"] > s["bare"] > s["none"]


def test_tokens_beyond_the_memory_bound_are_read_anew():
    g = tx.Grammar(LEX, max_known=1)
    assert g.features("a b idiot c idiot").tolist() == features("a b idiot c idiot").tolist()


def corpus(rng, n):
    bad = ["scumbag", "worthless", "vile"]
    rows, labels = [], []
    for i in range(n):
        text = words(rng, rng.randrange(5, 40))
        toxic = int(rng.random() < 0.2)
        if toxic:
            parts = text.split()
            for _ in range(3):
                parts.insert(rng.randrange(len(parts)), rng.choice(bad))
            text = " ".join(parts)
        rows.append((i, text))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_accuracy_and_awkward_rows(spark):
    rows, labels = corpus(random.Random(8), 1500)
    rows = awkward()[:3] + [r for r in awkward() if r[0] is None] + [(r[0] + 10_000, r[1]) for r in rows]
    table = spark.createDataFrame([(i + 10_000, t) for i, t in labels] + [(None, 1), (10_001, None), (99, 1)], "doc_id long, toxic int")
    df = docs(spark, rows, toxicity="clash", toxic=1, score=2)
    got = tx.report(df, table).collect()
    assert len(got) == len(rows)
    truth = {i + 10_000: t for i, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    for r in got:
        assert r.held_out == (zlib.crc32((str(r.doc_id) if r.doc_id is not None else "").encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.doc_id not in truth:
            assert r.predicted == 0


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    rows, labels = corpus(random.Random(9), 300)
    flipped = [(i, t if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - t) for i, t in labels]
    make = lambda ls: sorted(map(tuple, tx.report(docs(spark, rows), spark.createDataFrame(ls, "doc_id long, toxic int")).collect()))
    assert make(labels) == make(flipped)


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in tx.report(docs(spark, awkward()), none).collect()] == [0] * len(awkward())
    assert tx.report(docs(spark, []), none).count() == 0
