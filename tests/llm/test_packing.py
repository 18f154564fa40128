import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from signalyard.llm.packing import best_fit, local_search, pack
from signalyard.llm.tokens import WordEncoder
from tests.llm.util import awkward, docs

PATH = public_tokenizers.path("word_bpe_49k.json")


TOK = Tokenizer.from_file(PATH)  # as it comes


def plain_ids(text, end):
    return np.array(TOK.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def test_word_encoder_equals_whole_text_encoding():
    rng = random.Random(5)
    bits = ["́", " ", "\n", " ", " ", "\x1d", "\x00", "'s", "'LL", "A", "é", "Σ", "İ", "1", "!", "<|", "|>",
            "<|endoftext|>", "ß", "‍", "　", "word ", "Word, "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(2000)]
    enc = WordEncoder(PATH, max_chars=500)
    for i in range(0, len(texts), 100):
        for t, got in zip(texts[i:i + 100], enc.encode(texts[i:i + 100])):
            assert got == plain_ids(t, 0)[:-1].tobytes(), repr(t)
    for held in (enc._known, enc._pieces):
        assert sum(map(len, held)) < 600 + 40 and sum(map(len, held._old)) < 600 + 40


def test_the_strings_of_added_tokens_are_those_tokens():
    enc = WordEncoder(PATH)
    for text in ("a <|endoftext|> b", "x<|startoftext|>y <|endoftext|>", "<|ENDOFTEXT|>", "<| endoftext|>", "<|endoftext", "end<|"):
        assert enc.encode([text])[0] == plain_ids(text, 0)[:-1].tobytes()
    assert np.frombuffer(enc.encode(["a <|endoftext|> b"])[0], "<u4").tolist() == [320, 49407, 321]


def test_words_asked_for_again_outlast_the_bound():
    enc = WordEncoder(PATH, max_chars=60)
    made = []
    real = enc._known._make
    enc._known._make = lambda w: made.append(w) or real(w)
    for i in range(200):
        enc.encode([f"often word{i}"])
    assert made.count("often") == 1 and len(enc._known) + len(enc._known._old) < 40


def test_pieces_cover_documents_and_bins_are_gapless(spark):
    rows = awkward()
    out = pack(docs(spark, rows, sequence_id="clash", group="clash"), PATH, group_docs=20).collect()
    want = sorted(((d, p, p * 2048, len(x), zlib.crc32(x.tobytes()))
                   for d, t in ((r[0], r[1]) for r in rows) for ids in [plain_ids(t, 0)]
                   for p, x in enumerate(ids[i:i + 2048] for i in range(0, len(ids), 2048))), key=str)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=str) == want
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing_is_close_to_the_fewest_bins_and_empty_table(spark):
    rows = [(i, "alpha beta " * (1 + i * 37 % 900)) for i in range(400)]
    out = pack(docs(spark, rows), PATH, group_docs=400).toPandas()
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 2048) + 1
    assert pack(docs(spark, []), PATH).count() == 0


def test_local_search_improves_and_keeps_items():
    rng = random.Random(1)
    better = 0
    for _ in range(30):
        lengths = [rng.randrange(1, 60) for _ in range(200)]
        start = best_fit(lengths, 100)
        end = local_search([list(b) for b in start], lengths, 100)
        assert sorted(i for b in end for i in b) == list(range(200))
        assert all(0 < sum(lengths[i] for i in b) <= 100 for b in end)
        assert len(end) <= len(start)
        better += len(end) < len(start)
    assert better >= 15


def test_local_search_uses_each_kind_of_change():
    # 60+40 | 70+30 can be made only by exchanging one for one
    assert len(local_search([[0, 3], [1], [2]], [60, 70, 40, 30], 100)) == 2
    # move
    assert len(local_search([[0], [1]], [60, 40], 100)) == 1
    # two for one: 30+30 against 40 fills the second bin
    assert len(local_search([[0, 1], [2, 3], [4]], [30, 30, 40, 40, 60], 100)) == 2
