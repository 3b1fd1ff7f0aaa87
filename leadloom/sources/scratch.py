"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOT: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset and all runs in one process (tests, local runs)."""
    global _LOCAL_ROOT
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="leadloom-")
    return _LOCAL_ROOT


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/leadloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly over all cores, before work that is dear by the row: a file of one row group is one task's, however many rows it has."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def rows_of(df: DataFrame) -> DataFrame:
    """The whole input row under ``_row``, so that work columns cannot clash with the caller's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
