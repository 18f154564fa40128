import hashlib
import random

import numpy as np
import pytest

from signalyard.llm import fingerprint as fp
from tests.llm.util import awkward, docs, words


def shingles(text, n=8):
    return {text[i:i + n] for i in range(max(1, len(text) - n + 1))} if text else set()


@pytest.mark.parametrize("bytes_", [2_000, 1 << 25])
def test_rows_equal_brute_force(spark, bytes_):
    rng = random.Random(3)
    rows = awkward() + [(10_000 - 3 * i, words(rng, rng.randrange(80))) for i in range(200)]
    got = fp.edited_neighbours(docs(spark, rows, chain="clash", extra=1, key=2), partition_bytes=bytes_).collect()
    assert len(got) == len(rows)
    ordered = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for i, (doc_id, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        third = len(text) // 3
        changed = text[:len(text) - third] + following[:third]
        a, b, c = (fp.sketch(t) for t in (text, changed, following))
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), fp.write_sketch(a), fp.write_sketch(b),
                     fp.resemblance(a, b), fp.resemblance(a, c)))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)


def test_sketches_estimate_sets():
    rng = random.Random(9)
    for _ in range(20):
        a = words(rng, 400)
        b = fp.edited(a, words(rng, 300))
        sa, sb = shingles(a), shingles(b)
        x, y = fp.sketch(a), fp.sketch(b)
        assert abs(fp.resemblance(x, y) - len(sa & sb) / len(sa | sb)) < 0.2
        assert abs(fp.containment(x, y) - len(sa & sb) / len(sa)) < 0.35
        assert abs(fp.distinct(x) / len(sa) - 1) < 0.35
    near = [fp.resemblance(fp.sketch(a), fp.sketch(fp.edited(a, words(rng, 300)))) for a in (words(rng, 300) for _ in range(30))]
    assert 0.4 < np.mean(near) < 0.6
    small, more = "abcdefghijkl", "abcdefghijklmnop"
    assert fp.resemblance(fp.sketch(small), fp.sketch(more)) == 5 / 9
    assert fp.containment(fp.sketch(small), fp.sketch(more)) == 1.0 and fp.distinct(fp.sketch(small)) == 5


def test_parts_merge_to_the_whole(monkeypatch):
    text = words(random.Random(2), 3000)
    whole = fp.sketch(text)
    monkeypatch.setattr(fp, "_PART_CHARS", 100)
    assert fp.sketch(text).tolist() == whole.tolist()
    h = fp.shingle_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"))
    assert whole.tolist() == sorted(set(h.tolist()))[:fp.K]
    assert fp.merge(fp.sketch("aaaa"), fp.sketch("")).tolist() == fp.sketch("aaaa").tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 8, 9])
def test_hashes_are_of_whole_shingles(n):
    rng = random.Random(n)
    text = "".join(rng.choice("ab🎉") for _ in range(500))
    h = fp.shingle_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"), n).tolist()
    pairs = {(text[i:i + n], x) for i, x in enumerate(h)}
    assert len(h) == len(text) - n + 1 and len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


def test_written_sketches_and_small_tables(spark):
    for text in ("", "a", words(random.Random(1), 500)):
        assert fp.read_sketch(fp.write_sketch(fp.sketch(text))).tolist() == fp.sketch(text).tolist()
    assert fp.edited_neighbours(docs(spark, [])).count() == 0
    one = fp.edited_neighbours(docs(spark, [(5, "only one text")])).collect()[0]
    assert one.near_next == 1.0 and one.n_chars == 13
    blank = fp.edited_neighbours(docs(spark, [(5, None), (6, "")])).collect()
    assert [r.near_edited for r in blank] == [1.0, 1.0]
