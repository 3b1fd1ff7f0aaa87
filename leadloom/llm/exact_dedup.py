"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the normalised text.
A batch is reduced to one row for each digest, digests that the index knows already are removed by
a sort-merge anti-join whose index side needs no shuffle, and the rest is appended.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, scratch_path, table

#: The characters that do not count when two texts are compared.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: A digest is hot when its group holds more than one in HOT_SHARE of the batch's rows: fewer than HOT_SHARE digests can be.
HOT_SHARE = 1000

def normalised(text: Column) -> Column:
    """``text`` without blanks; a null text counts as the empty one."""
    return reduce(lambda acc, ch: F.replace(acc, F.lit(ch), F.lit("")), BLANKS, F.coalesce(text, F.lit("")))


def text_digest(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the normalised text in UTF-8."""
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """A digest table at ``path`` that outlives the session; opened again by its path, bucket count and type of id.

    Rows are bucketed by digest, and each appended file is sorted by it; a bucket has a file for each batch until
    ``compacted`` gives it one. What the bucketing saves is the shuffle of the index side. One writer at a time: a batch that
    failed may be appended again, as digests already there are left out, but two at once could add a digest twice.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, id_type: str = "bigint"):
        self.spark, self.id_type = spark, id_type
        self.path = path or scratch_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {id_type}, keep_row BIGINT, batch STRING, n_chars BIGINT, group_size BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, winners: DataFrame) -> None:
        """Add the rows of ``winners`` (one for each digest) whose digest is new."""
        known = self.read().select("digest")
        self._insert(winners.hint("merge").join(known, "digest", "left_anti"))

    def compacted(self, path: str) -> DigestIndex:
        """A copy at ``path`` with one sorted file in each bucket."""
        copy = DigestIndex(self.spark, path, self.buckets, self.id_type)
        copy._insert(self.read())
        return copy

    def close(self) -> None:
        """Take the table out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _insert(self, rows: DataFrame) -> None:
        rows = rows.select(*self.read().columns).repartition(self.buckets, "digest")
        rows.sortWithinPartitions("digest").write.insertInto(self.name)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, digest and n_chars of each row; with ``carry`` the whole input row under ``_row``."""
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.unhex(text_digest(text)).alias("digest"),
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if carry else []),
    )


def _winners(rows: DataFrame, batch: str) -> DataFrame:
    """The row that stays of each digest of ``rows`` (digests with their ``row_no``)."""
    order = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "row_no")
    best = rows.groupBy("digest").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return best.select(
        "digest", F.col("best.id").alias("keep_id"), F.col("best.row_no").alias("keep_row"), F.lit(batch).alias("batch"), (-F.col("best.shorter")).alias("n_chars"), "group_size"
    )


def _stored(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """Digests with a number for each row, which stays what it is because it is written with them."""
    return materialize(digests(docs, id_col, text_col, carry).withColumn("row_no", F.monotonically_increasing_id()), "digests")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the longest original (code points), then the smallest id stays, a null id after any other; of rows that
    are alike in all of it, one. So exactly one row of each text is kept, whatever ids repeat or are null. A text that the
    index held before this batch is dropped in favour of the row recorded there, and group_size is that recorded for it.
    Null texts equal empty ones; an empty table gives no rows; ids may be of any type; other columns are not read.
    """
    batch = uuid.uuid4().hex
    index = index or DigestIndex(docs.sparkSession, id_type=docs.schema[id_col].dataType.simpleString())
    rows = _stored(docs, id_col, text_col)
    winners = _winners(rows, batch)
    index.append(winners)
    total = rows.count()
    known = index.read().select("digest", "keep_id", "keep_row", "batch", "group_size")
    # Fewer than HOT_SHARE digests pass this filter whatever the input: the broadcast is bounded, and no hot group is shuffled to one task.
    hot_digests = winners.where(F.col("group_size") * HOT_SHARE > total).select("digest")
    hot = materialize(known.join(F.broadcast(hot_digests), "digest", "left_semi"), "hot-digests")
    of_hot = rows.join(F.broadcast(hot), "digest")
    of_rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").hint("merge").join(known, "digest")
    joined = of_hot.select(*rows.columns, *known.columns[1:]).unionByName(of_rest.select(*rows.columns, *known.columns[1:]))
    kept = (F.col("batch") == batch) & (F.col("row_no") == F.col("keep_row"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, all columns."""
    batch = uuid.uuid4().hex
    index = index or DigestIndex(docs.sparkSession, id_type=docs.schema[id_col].dataType.simpleString())
    rows = _stored(docs, id_col, text_col, carry=True)
    index.append(_winners(rows, batch))
    stays = index.read().where(F.col("batch") == batch).select(F.col("keep_row").alias("row_no"))
    return rows.select("row_no", "_row").join(stays, "row_no", "left_semi").select("_row.*")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document, as ``exact_dedup`` defines them, under a new index."""
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id)
"""
