"""SimHash near-duplicates by a positional byte index.

A fingerprint has eight positional bytes, and two fingerprints that differ in at most two bits differ in at most
two bytes, so six positional bytes at least are shared. The inverted index lists each fingerprint under
its 28 choices of six positional bytes; pairs meet in a posting, their shared bytes are tallied, pairs with
fewer than the guaranteed six go, and the rest is verified bit by bit. Copies of a fingerprint are collapsed
before, and postings hold fingerprints that differ in 16 bits only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.components import components
from leadloom.llm.scratch import materialize, table
from leadloom.llm.ngram_join import ngram_join

BITS, BYTES = 64, 8
SHINGLE_WORDS, MAX_BITS = 3, 2
SEED = 42
#: Positional bytes that a linked pair is sure to share: each differing bit spoils one byte at most.
GUARANTEED = BYTES - MAX_BITS


def fingerprint(text: str | None, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text; 0 without words. Shingles are counted in blocks, so memory is bounded by the text."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z are lowered, only ASCII blanks split
    if not words:
        return 0
    n = max(1, len(words) - words_in_shingle + 1)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += 1 + len(w)
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    last = ends[words_in_shingle - 1 :] if len(words) >= words_in_shingle else [len(joined)]
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[lo:hi], last[lo:hi])), dtype="<u8", count=hi - lo)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and ``fp`` (the 64 bits as a signed long) of every row."""

    def of_batches(batches):
        import pyarrow as pa

        for batch in batches:
            fps = [fingerprint(t, words_in_shingle) for t in batch.column(1).to_pylist()]
            signed = [x - (1 << 64) if x >> 63 else x for x in fps]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed, pa.int64())], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(of_batches, f"doc_id {kind}, fp bigint")


def _mask(positions: tuple[int, ...]) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >> 63 else m


def _shared_bytes(diff: Column) -> Column:
    same = [F.when(diff.bitwiseAND(F.lit(_mask((p,)))) == 0, 1).otherwise(0) for p in range(BYTES)]
    return sum(same[1:], same[0])


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints (column ``fp``) that differ in ``max_bits`` bits at most, 2 or fewer."""
    if not 0 < max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 1 to {MAX_BITS}")
    spoiled = list(combinations(range(BYTES), MAX_BITS))
    postings = fps.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(k).cast("tinyint").alias("choice"),
                        F.col("fp").bitwiseAND(F.lit(_mask(tuple(p for p in range(BYTES) if p not in pair)))).alias("key"),
                    )
                    for k, pair in enumerate(spoiled)
                ]
            )
        ).alias("posting"),
    ).select("fp", "posting.choice", "posting.key")
    a = postings.select(F.col("fp").alias("a"), "choice", "key")
    b = postings.select(F.col("fp").alias("b"), "choice", "key")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    # A pair that differs in one byte meets in seven postings: it counts in the first of them.
    low = F.element_at(F.array(*[F.lit(_mask((p,))) for p, _ in spoiled]), F.col("choice").cast("int") + 1)
    high = F.element_at(F.array(*[F.lit(_mask((q,))) for _, q in spoiled]), F.col("choice").cast("int") + 1)
    in_low, in_high = diff.bitwiseAND(low) != 0, diff.bitwiseAND(high) != 0
    first = (in_low & in_high) | (in_high & (F.col("choice") < BYTES - 1)) | (in_low & (F.col("choice") == 0))
    met = a.hint("merge").join(b, ["choice", "key"]).where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= max_bits))
    return met.where((_shared_bytes(diff) >= GUARANTEED) & first).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, similar: float | None = None
) -> DataFrame:
    """doc_id, fp and component_id of every row: the smallest doc_id that links of ``max_bits`` bits reach.

    Texts without words (null, empty, blank) share the fingerprint zero and link like any other. Rows with a null id
    take part but never name a component unless all ids in it are null. Repeated rows and ties fall in one
    component; an empty table gives no rows; other columns are not read. Texts of any length count whole.
    With ``similar``, texts whose five-word shingles have at least that Jaccard similarity are linked too, all of them; a
    row with a null id then has the links of its fingerprint only.
    """
    if similar is not None:
        alike = ngram_join(docs, id_col, text_col, percent=round(100 * similar))
        return _linked_also(near_duplicates(docs, id_col, text_col, words_in_shingle, max_bits), alike)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = materialize(fingerprints(docs, id_col, text_col, words_in_shingle), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    edges = materialize(links(classes.select("fp"), max_bits), "fingerprint-links")
    member = components(edges)
    grouped = classes.join(member, classes.fp == member.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first_id").cast(kind).alias("component_id"))
    of_class = materialize(grouped.join(smallest, "root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(of_class, "fp").select("doc_id", "fp", "component_id")


def _linked_also(groups: DataFrame, others: DataFrame) -> DataFrame:
    """``groups`` (doc_id, fp, component_id) with the components that they and ``others`` (doc_id, component_id) have together."""
    groups = materialize(groups, "fingerprint-groups")
    edges = groups.select("doc_id", "component_id").unionByName(others.select("doc_id", "component_id")).where("doc_id <> component_id").distinct()
    root = components(edges.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")))
    named = groups.withColumn("node", F.coalesce("doc_id", "component_id")).join(root, "node", "left")
    return named.select("doc_id", "fp", F.coalesce("root", "component_id").alias("component_id"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id of every document, as ``near_duplicates`` defines them."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
