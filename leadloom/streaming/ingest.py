"""Structured Streaming in place of run-at-a-time polling: raw records without repeats, merged into the canonical table.

An extension: the batch operators define the results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadloom.operators.upsert import upsert_companies

RECORD_KEY = ["source", "source_id", "market", "query"]


def raw_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def without_repeats(stream: DataFrame, time_col: str = "captured_at", delay: str = "1 hour") -> DataFrame:
    """The first record of each key; state older than ``delay`` is forgotten."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(RECORD_KEY)


def merge_companies(stream: DataFrame, table: str, checkpoint: str, order: str) -> StreamingQuery:
    """Upsert each batch into the versions of a canonical table under ``table``; a batch that is tried again writes the same version."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(f"{table}/version={batch_id - 1}") if batch_id else spark.read.parquet(f"{table}/initial")
        upsert_companies(old, batch, order).write.mode("overwrite").parquet(f"{table}/version={batch_id}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def counts_by_source(stream: DataFrame, time_col: str = "captured_at", window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time_col, delay).groupBy(F.window(time_col, window), "source").agg(F.count(F.lit(1)).alias("records"))
