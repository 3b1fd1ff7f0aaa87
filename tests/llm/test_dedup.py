import hashlib
import random
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from leadloom.llm.exact_dedup import DigestIndex, digests, drop_copies, exact_dedup
from leadloom.llm.ngram_join import shingles
from leadloom.llm.simhash import fingerprint, links, near_duplicates
from tests.llm.conftest import ODD


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_exact_against_plain_python(odd):
    """One row of each text is kept, also where rows repeat an id and text."""
    groups = defaultdict(list)
    for i, t, _ in ODD:
        groups[_norm(t)].append((-len(t or ""), i is None, i or 0, i))
    want = Counter()
    for t, rows in groups.items():
        rows.sort(key=lambda r: r[:3])
        for n, row in enumerate(rows):
            want[row[3], rows[0][3], len(rows), n == 0, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in exact_dedup(odd).collect()) == want


def test_exact_decides_on_rows(spark):
    docs = spark.createDataFrame([("b", "x y"), ("b", "x  y"), (None, "z"), (None, "z"), ("a", "w")], "doc_id string, text string")
    rows = exact_dedup(docs).collect()
    assert Counter((r.doc_id, r.kept) for r in rows) == {("b", True): 1, ("b", False): 1, (None, True): 1, (None, False): 1, ("a", True): 1}
    kept = drop_copies(docs)
    assert kept.columns == docs.columns and Counter(map(tuple, kept.collect())) == {("b", "x  y"): 1, (None, "z"): 1, ("a", "w"): 1}


def test_exact_empty_table(none):
    assert exact_dedup(none).collect() == []


def test_index_outlives_a_batch(spark, docs_of, tmp_path):
    path = str(tmp_path / "index")
    first = exact_dedup(docs_of([(1, "a b", None), (2, "c", None)]), DigestIndex(spark, path, 3)).collect()
    assert all(r.kept for r in first)
    reopened = DigestIndex(spark, path, 3)
    second = {r.doc_id: r for r in exact_dedup(docs_of([(0, "a  b  longer"[:4], None), (9, "new", None)]), reopened).collect()}
    assert (second[0].keep_id, second[0].kept) == (1, False) and second[9].kept
    assert reopened.read().count() == 3


def test_hot_digest(docs_of):
    rows = exact_dedup(docs_of([(i, "same" if i % 3 == 0 else f"t{i}", None) for i in range(600)])).collect()
    assert sum(r.kept for r in rows) == 401 and max(r.group_size for r in rows) == 200


def _plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_against_plain_python():
    for _, t, _ in ODD:
        if len(t or "") < 1000:
            assert fingerprint(t) == _plain_fingerprint(t)
    assert fingerprint("Éa B c d") == _plain_fingerprint("Éa B c d")


def test_links_and_components_against_brute_force(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)] + [0]
    fps = set(base)
    for b in base:
        x = b
        for _ in range(8):
            for bit in rng.sample(range(64), rng.choice([1, 2, 3])):
                x ^= 1 << bit
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = Counter((r.a, r.b) for r in links(df).collect())
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2}
    assert set(got) == want and max(got.values()) == 1


def test_near_duplicates(odd, none):
    rows = near_duplicates(odd)
    fps = {(i, fingerprint(t)) for i, t, _ in ODD}
    parent = {f: f for _, f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, a in fps:
        for _, b in fps:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    first = defaultdict(list)
    for i, f in fps:
        if i is not None:
            first[find(f)].append(i)
    want = Counter((i, min(first[find(fingerprint(t))], default=None)) for i, t, _ in ODD)
    assert Counter((r.doc_id, r.component_id) for r in rows.collect()) == want
    assert near_duplicates(none).collect() == []


def test_digests_read_two_columns_only(odd):
    assert digests(odd).columns == ["doc_id", "digest", "n_chars"] and digests(odd).where(F.col("doc_id") == 3).first().n_chars == 0


def test_similar_texts_are_linked_beyond_two_bits(docs_of, odd, none):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for g in range(12):
        base = [word() for _ in range(200)]
        rows.append((10 * g, " ".join(base), "en"))
        for k in range(1, 1 + g % 4):
            edited = list(base)
            for at in rng.sample(range(200), 3 * k):
                edited[at] = word()
            rows.append((10 * g + k, " ".join(edited), "en"))
    sets = {i: set(shingles(t).tolist()) for i, t, _ in rows}
    fps = {i: fingerprint(t) for i, t, _ in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    far = 0
    for a in sets:
        for b in sets:
            bits = (fps[a] ^ fps[b]).bit_count()
            alike = len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
            far += a < b and alike and bits > 2
            if alike or bits <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert far > 5
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows), similar=0.8).collect()}
    assert got == {i: find(i) for i in sets}
    assert near_duplicates(none, similar=0.8).collect() == [] and near_duplicates(odd, similar=0.8).count() == len(ODD)
