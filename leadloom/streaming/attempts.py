"""Fetch attempts as they arrive: a keyed state with an attempt limit, next to the batch join of ``runs.remaining_seeds``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def attempt_verdicts(attempts: DataFrame, max_attempts: int = 3) -> DataFrame:
    """A stream of verdicts (parcel_id, attempts, verdict: done, given_up or open) from a stream of attempts (parcel_id, status); in update mode, those of the
    parcels that a batch has attempts of. The state is a running count and flag for each parcel, so attempts are folded before the shuffle."""
    done = F.coalesce(F.col("status") == "ok", F.lit(False))
    state = attempts.groupBy("parcel_id").agg(F.count(F.lit(1)).alias("attempts"), F.max(done).alias("done"))
    verdict = F.when(F.col("done"), "done").when(F.col("attempts") >= max_attempts, "given_up").otherwise("open")
    return state.select("parcel_id", "attempts", verdict.alias("verdict"))


def follow(attempts: DataFrame, path: str, checkpoint: str, max_attempts: int = 3) -> None:
    """Work through the attempts that are there and append the verdicts to the table at ``path``, each with its batch: a batch that is
    repeated after a failure replaces its own rows."""

    def put(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    query = attempt_verdicts(attempts, max_attempts).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def seeds_left(seeds: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Seeds (parcel_id) still to fetch, with the attempts so far, from the verdicts that ``follow`` wrote."""
    last = verdicts.groupBy("parcel_id").agg(F.max_by(F.struct("attempts", "verdict"), "batch").alias("last"))
    out = seeds.join(last, "parcel_id", "left").withColumn("verdict", F.coalesce("last.verdict", F.lit("open")))
    return out.where("verdict = 'open'").select(*seeds.columns, F.coalesce("last.attempts", F.lit(0)).alias("attempts"))
