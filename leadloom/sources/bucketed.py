"""A keyed table whose upserts rewrite only the buckets that a batch touches.

Rows lie in partitions ``slot`` (the hash of the key), and the table is bucketed by the key with the same hash and count: a slot is one
sorted file, and Spark reads the old rows of the touched slots already dealt by key. A batch is folded to a row for each key
(the only shuffle), merged with them by a sort-merge join, and the touched slots are replaced by dynamic overwrite in one commit;
files of other slots keep their names. Repeating a batch is safe with rules that give the same when applied twice, as those of companies do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.upsert import Rule, fold, upsert
from leadloom.sources.retention import _exists

SLOT = "slot"


class BucketedTable:
    """The table at ``path``; opened again by its path, schema, key and number of buckets. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.name = f"bucketed_{uuid.uuid4().hex}"
        # The partition column comes last.
        spark.sql(
            f"CREATE TABLE {self.name} ({schema}, {SLOT} INT) USING parquet OPTIONS (path '{path}', partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY ({SLOT}) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
        )
        if _exists(spark, path):
            spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def close(self) -> None:
        """Take the table out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(SLOT)

    def _slot(self):
        return F.pmod(F.hash(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _replace(self, rows: DataFrame) -> None:
        rows.withColumn(SLOT, self._slot()).select(*self.spark.table(self.name).columns).write.insertInto(self.name, overwrite=True)

    def load(self, rows: DataFrame) -> None:
        """Put in ``rows``, one of each key, in place of all rows of their slots."""
        self._replace(rows.select(*self.read().columns).repartition(self.buckets, self.key))

    def touched(self, batch: DataFrame) -> list[int]:
        return sorted(r[0] for r in batch.select(self._slot()).distinct().collect())  # as many as there are buckets

    def merged(self, folded: DataFrame, slots: list[int], rules: dict[str, Rule]) -> DataFrame:
        """The rows of ``slots`` after ``folded``."""
        old = self.spark.table(self.name).where(F.col(SLOT).isin(*slots)).drop(SLOT)
        return upsert(old, folded, [self.key], rules)

    def upsert(self, batch: DataFrame, order: str, rules: dict[str, Rule]) -> list[int]:
        """Apply ``batch`` in ``order``; the slots that it rewrote. Rows without a key go."""
        folded = fold(batch.where(F.col(self.key).isNotNull()), [self.key], order, rules)
        slots = self.touched(batch.where(F.col(self.key).isNotNull()))
        if slots:
            self._replace(self.merged(folded, slots, rules))
        return slots
