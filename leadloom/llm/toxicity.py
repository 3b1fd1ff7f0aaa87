"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton on folded text.

Folding lowers the text, maps homoglyphs and digit or sign substitutions to the letters they stand for and leaves words with one
blank before each. Lexicon terms are word beginnings whose weight is the log-odds of being in a toxic
document; they are learned from labelled rows, as is the logistic curve over the length-normalised sums.
"""

from __future__ import annotations

import math
import re
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table

# Characters drawn like a Latin letter, and signs used in place of one.
HOMOGLYPHS = str.maketrans("авеікмнорстухѕјԁɡαβειικνορτυχ", "abeikmhopctyxsjdgabeiikvoptux")
SUBSTITUTES = str.maketrans("0134578@$!", "oieastbasi")
# Phrases in which a lexicon term is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "scum line")

#: Bound on the labelled rows that are learned from, half for the lexicon and half for the curve.
MAX_TRAINING_ROWS = 12_000
#: Lexicon terms: word beginnings of these lengths, in so many toxic documents at least, this much likelier there.
TERM_CHARS, MIN_TOXIC_DOCS, MIN_LOG_ODDS, MAX_TERMS = range(4, 13), 5, 1.5, 5_000
#: A term goes if one longer term is in this share of its toxic documents.
STUMP_SHARE = 0.9

_SIGN = re.compile(r"[@$!](?=[^\W_])")
_DIGITS = re.compile(r"[0-9]+")
_ODD = re.compile("[а-яіѕјԁα-ωɡ]")
_WORD = re.compile(r"[^\W\d_]+")


def _letters_for(m: re.Match) -> str:
    """A run of digits with letters in place of those that stand for one: all before a letter, else the first after a letter; a lone 8 at the end stays."""
    run, around = m[0], m.string
    before, after = around[m.start() - 1 : m.start()] if m.start() else "", around[m.end() : m.end() + 1]
    if after.isalnum() and not after.isdecimal():
        return run.translate(SUBSTITUTES)
    if before.isalnum() and not before.isdecimal() and (run != "8" or after.isalnum()):
        return run[0].translate(SUBSTITUTES) + run[1:]
    return run


def fold(text: str | None) -> str:
    """The folded words of a text, each with one blank before it; in time linear in the text."""
    t = (text or "").lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t)
        if _ODD.search(t):
            t = t.translate(HOMOGLYPHS)
    t = _SIGN.sub(lambda m: m[0].translate(SUBSTITUTES), t)
    t = _DIGITS.sub(_letters_for, t)
    return " " + " ".join(_WORD.findall(t))


def _prefixes(folded: str) -> set[str]:
    return {w[:k] for w in set(folded.split()) for k in TERM_CHARS if len(w) >= k}


def _term_counts(batches):
    from collections import Counter

    import pyarrow as pa

    for batch in batches:
        by = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by[toxic].update(_prefixes(fold(text)))
        terms = list(by[0].keys() | by[1].keys())
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(terms, pa.string()), "clean": pa.array([by[0][t] for t in terms], pa.int64()), "toxic": pa.array([by[1][t] for t in terms], pa.int64())}
        )


@lru_cache(maxsize=4)
def _automaton(terms: tuple[tuple[str, float], ...]):
    import ahocorasick

    auto = ahocorasick.Automaton()
    for term, weight in terms:
        auto.add_word(" " + term, weight)
    for phrase in EXCEPTIONS:
        auto.add_word(" " + phrase, 0.0)  # the longest match wins: a phrase hides the term that begins it
    auto.make_automaton()
    return auto


def features(text: str | None, terms: tuple[tuple[str, float], ...]) -> tuple[float, float, float]:
    """Of the weights matched: the log of the sum, of the sum for each 100 words, and of the sum for each root of words."""
    folded = fold(text)
    total = sum(w for _, w in _automaton(terms).iter_long(folded)) if terms else 0.0
    words = max(1, folded.count(" "))
    return math.log1p(total), math.log1p(100 * total / words), math.log1p(total / math.sqrt(words))


def _logistic(x, y, ridge: float = 1e-2, rounds: int = 50):
    """Newton's method with a small ridge."""
    import numpy as np

    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> tuple[tuple, tuple]:
    """(terms with weights, coefficients) from ``max_rows`` labelled rows at most, chosen by a hash of doc_id.

    Rows whose crc32(doc_id as text) mod 5 is 0 are never read. Labels that are null are no labels; of several for one
    document the largest counts; of rows that repeat an id the first text in order is read. Ids may be of any type. Without both kinds of label there are no terms and every score is the base rate.
    """
    usable = labels.where("toxic is not null and doc_id is not null and crc32(cast(doc_id as string)) % 5 <> 0")
    picked = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    picked = materialize(picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "toxicity-sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # max_rows rows at most
    texts = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    texts = materialize(texts.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))), "toxicity-texts")
    first = texts.where("half = 0")
    size = {bool(r["toxic"]): r["count"] for r in first.groupBy("toxic").count().collect()}
    n_toxic, n_clean = size.get(True, 0), size.get(False, 0)
    terms: tuple = ()
    if n_toxic and n_clean:
        found = first.select("text", "toxic").mapInArrow(_term_counts, "term string, clean bigint, toxic bigint")
        found = found.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        odds = F.log((F.col("toxic") + 0.5) / n_toxic) - F.log((F.col("clean") + 0.5) / n_clean)
        best = found.where(F.col("toxic") >= MIN_TOXIC_DOCS).withColumn("weight", odds).where(F.col("weight") >= MIN_LOG_ODDS)
        ranked = best.orderBy(F.desc(F.col("toxic") * F.col("weight")), "term").limit(MAX_TERMS)
        terms = _without_stumps([tuple(r) for r in ranked.select("term", "weight", "toxic").collect()])
    return terms, _curve(texts.where("half = 1"), terms)


def _without_stumps(ranked: list[tuple[str, float, int]]) -> tuple[tuple[str, float], ...]:
    """Terms with their weights, less those that nearly always go on as one longer term: "path" where it is "pathetic"."""
    docs = {term: n for term, _, n in ranked}
    longer: dict[str, int] = {}
    for term, n in docs.items():
        longer[term[:-1]] = max(longer.get(term[:-1], 0), n)
    return tuple((term, weight) for term, weight, n in ranked if longer.get(term, 0) < STUMP_SHARE * n)


def _curve(texts: DataFrame, terms: tuple) -> tuple:
    import numpy as np

    def of_batches(batches):
        import pyarrow as pa

        for batch in batches:
            x = [features(t, terms) for t in batch.column(0).to_pylist()]
            cols = {n: pa.array([v[k] for v in x], pa.float64()) for k, n in enumerate("abc")}
            yield pa.RecordBatch.from_pydict(cols | {"y": batch.column(1)})

    rows = texts.select("text", "toxic").mapInArrow(of_batches, "a double, b double, c double, y int").collect()
    if not rows:
        return (-2.0, 0.0, 0.0, 0.0)
    return _logistic(np.array([[r.a, r.b, r.c] for r in rows]), np.array([r.y for r in rows], dtype=float))


def toxicity(docs: DataFrame, model: tuple[tuple, tuple], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row under ``model``; null and empty texts have no matches and get the curve's base."""
    terms, coefficients = model

    def of_batches(batches):
        import pyarrow as pa

        for batch in batches:
            scores = [_score(t, terms, coefficients) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(of_batches, f"doc_id {kind}, score double")


def _score(text: str | None, terms: tuple, coefficients: tuple) -> float:
    z = coefficients[0] + sum(c * v for c, v in zip(coefficients[1:], features(text, terms)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def drop_toxic(docs: DataFrame, model: tuple[tuple, tuple]) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5."""
    terms, coefficients = model

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(lambda t: _score(t, terms, coefficients))

    return docs.where(score(F.coalesce(F.col("text"), F.lit(""))) < 0.5)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; learned from labels of rows that are not held out; null and empty texts score as texts without a match."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.expr("coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
