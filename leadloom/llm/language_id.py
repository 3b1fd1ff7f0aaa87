"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A letter n-gram is the product of its letters' vectors, each
rotated by its place; a document is the sum of its n-gram vectors, a language the sum of its documents' unit
vectors. The language whose prototype has the largest cosine with the document is predicted.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table

DIMENSIONS = 512
#: Letters share this many random vectors by code point; 0 stands for the edge of a word.
LETTER_SLOTS = 1024
SEED = 20240229
#: Bounds on what prototypes are learned from: documents of a language, and languages (the most frequent).
MAX_ROWS_OF_LANGUAGE, MAX_LANGUAGES = 1_000, 1_000
#: Turns cosines into shares: the softmax of cosine / SHARPNESS.
SHARPNESS = 0.05
#: Letters taken at a time from a very long text.
BLOCK = 1 << 20
#: Rows of n-gram vectors that a worker remembers.
MAX_GRAMS = 40_000
#: N-grams whose vectors are gathered at a time.
SLICE = 8_192
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letter_vectors():
    import numpy as np

    base = np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(LETTER_SLOTS, DIMENSIONS))
    return tuple(np.ascontiguousarray(np.roll(base, r, axis=1)) for r in range(3))


@lru_cache(maxsize=1)
def _slot_of():
    """The slot of each code point, 0 for all that are no letters."""
    import numpy as np

    points = np.arange(0x110000, dtype=np.int64)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return np.where(letter, points % (LETTER_SLOTS - 1) + 1, 0).astype(np.int16)


def letter_codes(text: str | None):
    """Slots of the lower-case letters, each run of letters with one 0 on both sides; empty without letters."""
    import numpy as np

    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    slots = np.zeros(len(points) + 2, dtype=np.int32)
    slots[1:-1] = _slot_of()[points]
    edge = slots == 0
    if edge.all():
        return slots[:0]
    keep = np.ones(len(slots), dtype=bool)
    keep[1:] = ~(edge[1:] & edge[:-1])
    return slots[keep]


class GramTable:
    """Vectors of the n-grams met so far in a worker, as rows of one matrix; starts afresh beyond MAX_GRAMS rows."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.grams, self.rows = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.matrix, self.used = np.zeros((MAX_GRAMS, DIMENSIONS), dtype=np.float32), 0

    def of(self, grams):
        """One row of the matrix for each of ``grams`` (sorted, distinct, SLICE at most)."""
        import numpy as np

        at = np.minimum(np.searchsorted(self.grams, grams), max(len(self.grams) - 1, 0))
        new = grams if not len(self.grams) else grams[self.grams[at] != grams]
        if len(new):
            if self.used + len(new) > MAX_GRAMS:
                self.forget()
                return self.of(grams)
            self.matrix[self.used : self.used + len(new)] = _bound(new)
            all_grams = np.concatenate([self.grams, new])
            all_rows = np.concatenate([self.rows, np.arange(self.used, self.used + len(new))])
            order = np.argsort(all_grams, kind="stable")
            self.grams, self.rows, self.used = all_grams[order], all_rows[order], self.used + len(new)
            at = np.searchsorted(self.grams, grams)
        return self.matrix[self.rows[at]]


def _bound(grams):
    import numpy as np

    first, second, third = _letter_vectors()
    return (first[grams >> 20] * second[grams >> 10 & LETTER_SLOTS - 1] * third[grams & LETTER_SLOTS - 1]).astype(np.float32)


@lru_cache(maxsize=1)
def _table() -> GramTable:
    return GramTable()


def document_vector(text: str | None):
    """The bundled 3-gram vectors of a text as floats; None without letters."""
    import numpy as np

    codes = letter_codes(text)
    if not len(codes):
        return None
    total = np.zeros(DIMENSIONS, dtype=np.float32)
    for lo in range(0, len(codes) - 2, BLOCK):
        part = codes[lo : lo + BLOCK + 2]
        grams = part[:-2] << 20 | part[1:-1] << 10 | part[2:]
        grams, n = np.unique(grams[part[1:-1] != 0], return_counts=True)
        for k in range(0, len(grams), SLICE):
            total += n[k : k + SLICE].astype(np.float32) @ _table().of(grams[k : k + SLICE])
    return total


def _unit(v):
    import numpy as np

    return v / max(float(np.linalg.norm(v)), 1e-12)


def learn(docs: DataFrame, max_rows: int = MAX_ROWS_OF_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> dict[str, list[float]]:
    """Prototype of each non-null lang, from ``max_rows`` documents of it at most, chosen by a hash of doc_id among those whose
    crc32(doc_id as text) mod 4 is not 2, so that a rare language is learned like a frequent one.

    Of rows that repeat an id and lang the first text in order is read; ids may be of any type. A document without a letter
    teaches nothing; without usable documents there are no prototypes.
    """
    usable = docs.where("lang is not null and doc_id is not null and crc32(cast(doc_id as string)) % 4 <> 2")
    langs = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).select("lang")
    named = usable.select("lang", "doc_id").join(F.broadcast(langs), "lang")
    # The rank limit is applied on each side of the shuffle: max_rows rows of a language leave a task.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = materialize(named.distinct().withColumn("rank", rank).where(F.col("rank") <= max_rows).select("lang", "doc_id"), "language-sample")
    sample = usable.join(F.broadcast(ids), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text")).select("lang", "text")

    def bundle(batches):
        import numpy as np
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = document_vector(text)
                if v is not None:
                    sums[lang] = sums.get(lang, 0) + _unit(v)
        at = list(range(DIMENSIONS))
        for lang, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * DIMENSIONS, "at": pa.array(at, pa.int32()), "v": pa.array(v.astype("f8"))})

    parts = sample.mapInArrow(bundle, "lang string, at int, v double")
    rows = parts.groupBy("lang", "at").agg(F.sum("v").alias("v")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("v"))
    return {r["lang"]: [x["v"] for x in r["v"]] for r in rows.collect()}


def identify(docs: DataFrame, prototypes: dict[str, list[float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (share of the softmax over cosines, 0 to 1) of each row.

    A text that is null or has no letter is ``und`` with score 0, as is every text when nothing was learned. Equal cosines
    go to the language first in the alphabet. Texts of any length count whole; other columns are not read.
    """
    langs = sorted(prototypes)
    vectors = [prototypes[k] for k in langs]

    def of_batches(batches):
        import numpy as np
        import pyarrow as pa

        profile = np.array([_unit(np.array(v)) for v in vectors], dtype=np.float32)
        for batch in batches:
            best, score = [], []
            for text in batch.column(1).to_pylist():
                v = document_vector(text) if langs else None
                if v is None:
                    best.append(UNKNOWN)
                    score.append(0.0)
                    continue
                cosine = profile @ _unit(v)
                share = np.exp((cosine - cosine.max()) / SHARPNESS)
                k = int(cosine.argmax())
                best.append(langs[k])
                score.append(float(share[k] / share.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(of_batches, f"doc_id {kind}, lang_pred string, score double")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learned from documents that are not held out, as ``learn`` and ``identify`` define it."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs.select("doc_id", "text", "lang")))
    held = F.expr("coalesce(crc32(cast(doc_id as string)) % 4 = 2, false)")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
