import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

from leadloom.llm import packing, sentence_pieces, token_count, tokens
from tests.llm.conftest import ODD

HARD = [
    "a" * 30_000,
    "x  <|endoftext|>  y " * 900,
    "é ü 　 ab " * 1500,
    "\n\n  \t foo's 123 " * 1200,
    "word " * 4000,
    "",
    None,
    " " * 9000 + "z",
    "<|endoftext|>" * 700,
    "I'm   they'll 12\x1c34 \x85",
]


def test_token_counts_equal_the_library(spark, odd, none):
    t = tokens.tokenizer(token_count.VOCABULARY)
    want = lambda x: len(t.encode(x or "", add_special_tokens=False))
    df = spark.createDataFrame([(i, x, 5) for i, x in enumerate(HARD)] + [(0, HARD[0], 5)], "doc_id long, text string, n_tokens int")
    expected = Counter((i, len((x or "").encode()), want(x)) for i, x in enumerate(HARD)) + Counter([(0, 30_000, want(HARD[0]))])
    for kw in ({}, {"chunk_chars": 777, "overlap_chars": 24}):
        assert Counter(tuple(r) for r in token_count.token_counts(df, **kw).collect()) == expected
    assert token_count.token_counts(odd).count() == len(ODD) and token_count.token_counts(none).collect() == []


def test_word_ids_equal_the_library():
    t = tokens.tokenizer(packing.VOCABULARY)
    for x in HARD + [x for _, x, _ in ODD] + ["Straße ΣΑΣ café it's"]:
        want = np.array(t.encode(x or "", add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert tokens.word_ids([x], packing.VOCABULARY) == [want]


ASSIGNED = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cs", "Cn", "Co")]


@pytest.mark.parametrize("shape", ["ab%s,", "%s.", "x%sy!?", ",%s", "%s\u0301;"])
def test_every_character_beside_punctuation(shape):
    texts = [shape % c for c in ASSIGNED]
    t = tokens.tokenizer(packing.VOCABULARY)
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x for x, w, g in zip(texts, want, tokens.word_ids(texts, packing.VOCABULARY)) if w != g] == []
    t = tokens.tokenizer(token_count.VOCABULARY)
    want = [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x for x, w, g in zip(texts, want, tokens.byte_counts(texts, token_count.VOCABULARY)) if w != g] == []


def test_random_strings_of_odd_characters():
    rng = random.Random(11)
    odd = ["İ", "ß", "Σ", "ς", "\u0958", "\u0301", "e\u0301", "ﬁ", "ʼ", "'", "’s", "'S", ",", ".", "!", "<|", "|>", "1", "Ⅷ", "日", "\u200d", "\x85", "\xa0", " ", "\x1c", "a", "B", "<|endoftext|>"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    t = tokens.tokenizer(packing.VOCABULARY)
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x for x, w, g in zip(texts, want, tokens.word_ids(texts, packing.VOCABULARY)) if w != g] == []
    t = tokens.tokenizer(token_count.VOCABULARY)
    want = [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x for x, w, g in zip(texts, want, tokens.byte_counts(texts, token_count.VOCABULARY)) if w != g] == []


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(3)
    for window in (1, 7, 64, 100):
        lengths = sorted((rng.randint(1, window) for _ in range(300)), reverse=True)
        rooms, want = [], []
        for n in lengths:
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            want.append(min(fits, default=window))
            rooms.append(min(fits, default=window) - n)
        got = packing.best_fit_decreasing(lengths, window)
        assert [window - offset for _, offset in got] == want
        total = Counter()
        for (s, offset), n in zip(got, lengths):
            assert total[s] == offset
            total[s] += n
        assert max(total.values()) <= window


def test_packing(spark, odd, none):
    t = tokens.tokenizer(packing.VOCABULARY)
    rows = packing.packed_digest(odd).collect()
    want = Counter()
    for i, x, _ in ODD:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, packing.END_ID], dtype="<u4")
        for at in range(0, len(ids), packing.WINDOW):
            part = ids[at : at + packing.WINDOW]
            want[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= packing.WINDOW
    assert packing.packed_digest(none).collect() == []


def test_packing_groups_keep_their_sequences_apart(spark):
    cut = spark.createDataFrame([(i, 0, 1 + i % 40) for i in range(500)], "doc_id long, start long, length long")
    rows = packing.assign_sequences(cut, window=50, group_pieces=60).collect()
    total = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == total[r.sequence_id]
        total[r.sequence_id] += r.length
    assert len(rows) == 500 and max(total.values()) <= 50


@pytest.mark.parametrize("kind", range(4))
def test_piece_scan_equals_the_library(kind):
    m, rng = sentence_pieces.model(sentence_pieces.VOCABULARY), random.Random(kind)
    words = ["hello", "internationalization", "é", "aaaaaaaa", "xyz123", "\n", "日本語", "𝔘", "  ", "     ", "\t"]
    for _ in range(40):
        text = {
            0: lambda: " ".join(rng.choice(words) for _ in range(60)),
            1: lambda: "".join(rng.choice("abcdefgh etin  ") for _ in range(300)),
            2: lambda: "".join(rng.choice("abcdetinrs") for _ in range(300)),
            3: lambda: " " * rng.randint(0, 5) + "".join(rng.choice(["  ", "   ", "x", "\n", " "]) for _ in range(150)),
        }[kind]()
        s, chunk, context = sentence_pieces.normalised(text), rng.choice([40, 64, 100]), 2 * m.longest
        of = max(1, len(s) // chunk)
        parts = []
        for k in range(of):
            lo, hi = k * chunk, len(s) if k == of - 1 else k * chunk + chunk
            origin = max(0, lo - context)
            parts.append(sentence_pieces.Chunk(m, s[origin : hi + context], origin, lo, hi, k == of - 1))
        states = sentence_pieces.scan([{e: 0.0 for e in c.transfer()} for c in parts])
        assert [i for c, (a, b) in zip(parts, states) for i in c.encode(a, b)] == m.library.encode(text)


def test_max_plus_product_is_associative():
    a, b, c = {("s", 1): 0.0, ("s", 2): -1.0}, {(1, 3): -5.0, (2, 3): 0.0, (2, 4): 0.0}, {(3, "e"): 0.0, (4, "e"): -3.0}
    left = sentence_pieces.combine(sentence_pieces.combine(a, b), c)
    assert left == sentence_pieces.combine(a, sentence_pieces.combine(b, c)) == {("s", "e"): -1.0}


def test_pieces_of_documents(spark, odd, none):
    m = sentence_pieces.model(sentence_pieces.VOCABULARY)
    for chunk in (sentence_pieces.CHUNK_CHARS, 500):
        rows = sentence_pieces.encode_documents(odd, chunk=chunk).collect()
        got = Counter((r.doc_id, bytes(r.ids), r.decoded) for r in rows)
        want = Counter((i, np.array(m.library.encode(x or ""), dtype="<u4").tobytes(), x or "") for i, x, _ in ODD)
        assert got == want
    assert sentence_pieces.encode_documents(none).collect() == []
    assert sentence_pieces.decode(sentence_pieces.encode("a  b\né")) == "a  b\né"
