"""Operators on pairs: n-gram Jaccard join, spelling variants, hard negatives; all against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from leadloom.llm import hard_negatives as H
from leadloom.llm import ngram_join as J
from leadloom.llm import spelling as S
from leadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# n-gram join ---------------------------------------------------------------------------------


def gram_set(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(found[k : k + words]) for k in range(max(1, len(found) - words + 1))} if found else set()


def joined(rows):
    """(doc_id, set size, component) of each row, by all pairs."""
    sets = [gram_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                up[top(a)] = top(b)
    smallest = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        smallest[top(k)].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in smallest.items()}
    return sorted(((i, len(sets[k]), least[top(k)]) for k, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.random()}"
    return " ".join(words)


def test_ngram_join_links_edited_copies_as_all_pairs_do(spark, docs_of):
    rng = random.Random(3)
    vocabulary = [f"word{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, i = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 12, 40, 200]))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((i, edited(base, rng, rng.choice([0, 1, 2, 3, 5])), None))
            i += 1
    assert got(J.ngram_join(docs_of(rows))) == joined([r[:2] for r in rows])


def test_ngram_join_of_a_large_group_of_near_copies(spark, docs_of, monkeypatch):
    """Most of a group link by its stars; the others are found in tiles of small blocks."""
    monkeypatch.setattr(J, "BLOCK_GRAMS", 2000)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, edited(base, rng, rng.choice([1, 2, 3, 4])), None) for k in range(150)]
    want = joined([r[:2] for r in rows])
    assert got(J.ngram_join(docs_of(rows))) == want and len({c for _, _, c in want}) > 1


def test_ngram_join_on_odd_rows(spark, odd, none, docs_of):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(J.ngram_join(odd)) == joined(rows) and got(J.ngram_join(none)) == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "A B c\td e f"), (7, "A B c\td e f"), (9, "İ é ß"), (8, "İ É ß"), (3, "x" * 100_000)]
    assert got(J.ngram_join(docs_of([(*r, None) for r in rows]))) == joined(rows)


def test_sketch_tells_rare_ngrams_from_common_ones(spark):
    texts = [" ".join(f"w{k}x{i}" for i in range(20_000)) + " a b c d e" * 2 for k in range(20)]
    levels = J.sketch(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), 5)
    keys = np.concatenate([J.ordered(J.shingles(t), levels.value) for t in texts])
    level = {h: int(x) for h, x in zip((keys & np.uint64((1 << J.HASH_BITS) - 1)).tolist(), keys >> np.uint64(J.HASH_BITS))}
    assert np.mean(np.array(list(level.values())) > 0) < 0.02, "400,000 n-grams do not fill the counters"
    common = J.shingles("a b c d e a b c d") & np.uint64((1 << J.HASH_BITS) - 1)
    assert {level[h] for h in common.tolist()} == {4}, "in 20 texts"


def test_only_ngrams_of_two_prefixes_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_CELLS", 500)
    rng = random.Random(9)
    keys = [np.array(sorted(rng.getrandbits(J.HASH_BITS + 2) for _ in range(400)), np.uint64) for _ in range(30)]
    both = keys[3][::20]
    keys[7] = np.sort(np.concatenate([keys[7], both]))
    for k in range(30):
        keys[k] = np.concatenate([keys[k], np.array([5], np.uint64)])
    bits = J.met(spark.createDataFrame([(bytearray(k.tobytes()),) for k in keys], "prefix binary").repartition(3))
    assert J.may_meet(both, bits.value).all() and J.may_meet(keys[0][-1:], bits.value).all()
    assert sum(J.may_meet(k, bits.value).sum() for k in keys) <= 2 * len(both) + 30 + 5


def test_shingle_slices_give_the_same_set(monkeypatch):
    words = [f"w{k % 700}" for k in range(5000)]
    whole = J.shingles(" ".join(words))
    monkeypatch.setattr(J, "_SLICE_WORDS", 64)
    assert len(whole) == len(gram_set(" ".join(words))) and (J.shingles(" ".join(words)) == whole).all()


@pytest.mark.parametrize("seed", range(20))
def test_tree_finds_what_all_pairs_find(seed):
    rng = random.Random(seed)
    sets = [np.array(sorted(rng.sample(range(30), rng.randint(1, 12)))) for _ in range(40)]
    sets += [np.array(sorted({*s.tolist()} ^ {rng.randrange(30)} or {1})) for s in sets]
    component = [rng.randrange(60) for _ in sets]
    tree = J.Tree(sets, component)
    for k, x in enumerate(sets):
        want = {i for i, y in enumerate(sets) if component[i] != component[k] and 180 * len({*x.tolist()} & {*y.tolist()}) >= 80 * (len(x) + len(y))}
        assert {i for i in tree.near(x, 30, component[k], 80) if component[i] != component[k]} == want


# Spelling variants ----------------------------------------------------------------------------


def variants(rows, min_count=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    close = {a: [b for b in n if near(a, b)] for a in n}
    form = {a: min(bs, key=lambda b: (-n[b], b)) if bs else None for a, bs in close.items()}
    form = {a: f if f and n[f] >= 5 * n[a] else None for a, f in form.items()}

    def root(a):
        return root(form[a]) if form[a] else a

    return sorted(((a, form[a], root(a), n[a], len(close[a]), n.get(form[a])) for a in n), key=str)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=str)


def test_spelling_variants_as_all_pairs_give_them(spark, docs_of):
    rng = random.Random(4)
    letters = "abÀé÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 6, 7, 8]))) for _ in range(150)] + ["colour", "color", "colours", "Colouur", "COLOUR"]
    weighted = [w for w in words for _ in range(rng.choice([1, 5, 6, 40, 300]))] + ["colour"] * 600 + ["colouur"] * 60 + ["colouuur"] * 5
    rng.shuffle(weighted)
    rows = [(k, "!".join(weighted[at : at + 97])) for k, at in enumerate(range(0, len(weighted), 97))]
    want = variants(rows)
    assert found(S.spelling_variants(docs_of([(*r, None) for r in rows]))) == want
    assert any(w[1] and w[2] != w[1] for w in want), "a chain of forms is among them"


def test_spelling_variants_of_the_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op12_spelling_variants"](spark, SF)) == variants(rows)


def test_spelling_variants_on_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(S.spelling_variants(odd, min_count=1)) == variants(rows, 1) and found(S.spelling_variants(none)) == []


def test_word_counts_do_not_depend_on_when_a_task_hands_on(spark, odd, monkeypatch):
    want = sorted(map(tuple, S.word_counts(odd).collect()))
    monkeypatch.setattr(S, "COUNTED_WORDS", 1)
    assert sorted(map(tuple, S.word_counts(odd).collect())) == want


# Hard negatives -------------------------------------------------------------------------------


def mined(rows, every=100, seventh=True):
    """The contract, row by row, in Python's integers."""
    kept = []
    for no, (i, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if seventh and i is not None and i % 7 == 0:
            label = (label + 1) % 10
        kept.append((no, i, label, [math.floor(256 * x) for x in vector]))
    out = []
    key = lambda s, i, no: (-s, i is None, i or 0, no)
    for no, i, label, v in kept:
        if i is None or i % every:
            continue
        score = {m: sum(a * b for a, b in zip(v, w)) for m, _, _, w in kept}
        near = sorted((r for r in kept if r[0] != no and r[2] == label), key=lambda r: key(score[r[0]], r[1], r[0]))[:5]
        for p in near:
            s = score[p[0]]
            far = sorted((r for r in kept if r[2] != label and 80 * s <= 100 * score[r[0]] <= 100 * s), key=lambda r: key(score[r[0]], r[1], r[0]))[:5]
            out += [(i, p[1], k + 1, r[1], s, score[r[0]]) for k, r in enumerate(far)]
    return sorted(out, key=str)


def mine(spark, rows, schema="vec_id long, embedding array<float>, label int, anchor string, norm string, _row string", **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    from pyspark.sql import functions as F

    df = df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    out = H.hard_negatives(df, F.col("vec_id") % 100 == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()), key=str)


def vectors(n, seed, size=6):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, size))
    return [(k, (centre[k % 4] + rng.normal(size=size) * 0.4).astype(np.float32).tolist(), int(rng.integers(0, 10))) for k in range(n)]


def test_hard_negatives_of_the_embeddings(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_hard_negatives"](spark, SF).collect()), key=str) == mined(rows)


def test_hard_negatives_with_ties_copies_nulls_and_small_groups(spark):
    rows = vectors(700, 1) + [(1000 + k, [1.0, 1.0, 0, 0, 0, 0], k % 2) for k in range(300)]
    rows += [(7, None, 1), (8, [1.0, float("nan"), 0, 0, 0, 0], 1), (9, [1.0, None, 0, 0, 0, 0], 1), (10, [float("inf")] * 6, 2), (11, [1.0] * 6, None), (None, [0.9] * 6, 3), (100, [0.9] * 6, 3), (200, [], 3), (300, [1.0, -1.0], 4), (400, [0.0] * 6, 5)]
    assert mine(spark, rows, group_cells=600) == mined(rows)
    assert mine(spark, []) == [] and mine(spark, [(1, [1.0], 2)]) == []


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(k * 25, (rng.normal(size=3) * 3e5 + 2e5).tolist(), int(k % 2)) for k in range(60)]
    assert mine(spark, rows, "vec_id long, embedding array<double>, label int, anchor string, norm string, _row string") == mined(rows)


def test_brackets_hold_every_score():
    rows = [(k, k, 0, np.floor(256 * np.array(v)).tobytes(), b"") for k, v, _ in vectors(500, 3)]
    full = H._matrix([r[3] for r in rows], 6)
    top = float((full**2).sum(1).max())
    pivots = H.chosen_pivots(full[:50], top)
    norm = (full**2).sum(1)
    as_row, as_anchor = H.distances(full, np.sqrt(np.maximum(top - norm, 0)), pivots), H.distances(full, np.zeros(len(norm)), pivots)
    group = H.Group([(*r[:4], d.tobytes()) for r, d in zip(rows, as_row)], 6, top)
    pruned = 0
    for at, best, near, far in group.brackets(as_anchor[:40], norm[:40]):
        exact = group.scores(full[:40], at)
        assert (far() <= exact).all() and (exact <= near()).all() and (exact <= best[:, None]).all()
        pruned += int((near() < exact.max(1)[:, None]).sum())
    assert pruned > 1000, "the pivots rule pairs out"
