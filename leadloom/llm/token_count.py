"""Token counts with overlap resynchronisation for huge documents.

A document longer than a chunk is encoded in overlapping chunks, each with offsets. Two neighbours are spliced
where both begin a pre-token at the same place: what follows is split from there on alike, since the
splitting looks ahead only. Places that the end of the left chunk could have changed, and the
first pre-token of the right one, do not count. Texts without such a place in some overlap are done again with wider overlaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table
from leadloom.llm.tokens import byte_counts, tokenizer

VOCABULARY = "byte_bpe_50k.json"
CHUNK_CHARS, OVERLAP_CHARS, WIDEN = 32_768, 512, 8
TOKEN_LIMIT = 1024
#: Short documents counted at a time.
BLOCK = 500

_EDGES = "array<struct<at:bigint,before:bigint>>"


def _edges(text: str, origin: int, overlap: int, first: bool, last: bool, name: str, folder: str | None):
    """(tokens, starts of pre-tokens in the left overlap, in the right overlap) of a chunk, each start with the tokens before it."""
    t = tokenizer(name, folder)
    enc = t.encode(text, add_special_tokens=False)
    words, offsets = enc.word_ids, enc.offsets
    reach = len(text) - max([1, *(len(s.content) for s in t.get_added_tokens_decoder().values())])
    starts = [k for k in range(1, len(words)) if words[k] != words[k - 1]]
    left, right = [], []
    for k in starts if not (first and last) else []:
        at = offsets[k][0]
        if not first and at < overlap:
            left.append({"at": origin + at, "before": k})
        if not last and len(text) - overlap <= at <= reach:
            right.append({"at": origin + at, "before": k})
    return len(words), left, right


def _by_chunks(texts: DataFrame, chunk: int, overlap: int, name: str, folder: str | None) -> DataFrame:
    """``key`` and n_tokens (null where some overlap has no common start) of each text."""
    n = F.length("text")
    chunks = F.greatest(F.ceil((n - overlap) / F.lit(float(chunk))), F.lit(1)).cast("int")
    cut = texts.select("key", "text", chunks.alias("of")).select(
        "key", "of", "text", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("k")
    )
    length = F.when(F.col("k") == F.col("of") - 1, F.length("text")).otherwise(F.lit(chunk + overlap))
    cut = cut.select("key", "of", "k", F.substring(F.col("text"), F.col("k") * chunk + 1, length).alias("part"))
    # The chunks of one document go to many tasks; the number is given, since few bytes here mean much work.
    cut = cut.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "k")

    def of_batches(batches):
        import pyarrow as pa

        for batch in batches:
            cols = batch.to_pydict()
            found = [
                _edges(part, k * chunk, overlap, k == 0, k == of - 1, name, folder) for part, k, of in zip(cols["part"], cols["k"], cols["of"])
            ]
            kind = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "of": batch.column("of"),
                    "k": batch.column("k"),
                    "n": pa.array([f[0] for f in found], pa.int64()),
                    "left": pa.array([f[1] for f in found], kind),
                    "right": pa.array([f[2] for f in found], kind),
                }
            )

    schema = f"key binary, of int, k int, n bigint, left {_EDGES}, right {_EDGES}"
    # Copies of a text have the same chunks.
    parts = materialize(cut.mapInArrow(of_batches, schema), "token-chunks").dropDuplicates(["key", "k"])
    nxt = parts.select(F.col("key").alias("key2"), (F.col("k") - 1).alias("k2"), F.col("left").alias("next_left"))
    joined = parts.join(nxt, (F.col("key") == F.col("key2")) & (F.col("k") == F.col("k2")), "left")
    ours, theirs = F.col("right"), F.col("next_left")
    common = F.array_min(F.array_intersect(F.transform(ours, lambda e: e["at"]), F.transform(theirs, lambda e: e["at"])))
    joined = joined.withColumn("splice", common)
    before = lambda edges: F.filter(edges, lambda e: e["at"] == F.col("splice"))[0]["before"]
    gain = F.when(F.col("k") == F.col("of") - 1, F.col("n")).otherwise(
        F.when(F.col("splice").isNotNull(), before(ours) - before(theirs))
    )
    return joined.withColumn("gain", gain).groupBy("key").agg(
        F.when(F.count("gain") == F.count(F.lit(1)), F.sum("gain")).alias("n_tokens")
    )


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    folder: str | None = None,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row, special strings taken as the tokenizer takes them by default.

    Null and empty texts have no tokens. Repeated rows give a row each; other columns are not read. Texts that no
    overlap can splice (one word of endless length) are finally encoded whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def of_batches(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(2)
            n = [c for lo in range(0, len(texts), BLOCK) for c in byte_counts(texts.slice(lo, BLOCK).to_pylist(), vocabulary, folder)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    size = F.octet_length("text").cast("bigint").alias("n_bytes")
    short = rows.where(F.length("text") <= chunk_chars).select("doc_id", size, "text")
    counted = short.mapInArrow(of_batches, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")

    huge = rows.where(F.length("text") > chunk_chars).withColumn("key", F.unhex(F.sha2("text", 256)))
    done, overlap, open_texts = None, overlap_chars, huge.select("key", "text")
    while True:
        found = materialize(_by_chunks(open_texts, chunk_chars, overlap, vocabulary, folder), "token-sums")
        done = found.where("n_tokens is not null") if done is None else done.unionByName(found.where("n_tokens is not null"))
        failed = found.where("n_tokens is null").select("key")
        if failed.isEmpty():
            break
        overlap *= WIDEN
        open_texts = open_texts.join(failed, "key", "left_semi")
    spliced = huge.select("doc_id", size, "key").join(done, "key").select("doc_id", "n_bytes", "n_tokens")
    return counted.unionByName(spliced)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
