"""First-wins and last-wins by key, ordered distinct values, ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``; a partial aggregation, so copies of a hot key never meet in one task."""
    best = df.groupBy(*keys).agg(F.min_by(_row(df), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def last_wins(df: DataFrame, keys: list[str], order: list[str], place: str | None = None) -> DataFrame:
    """The last row of each key in ``order``; with ``place`` also where its first one stood."""
    aggs = [F.max_by(_row(df), F.struct(*order)).alias("_row")]
    if place:
        aggs.append(F.min(F.struct(*order)).alias("_first"))
    best = df.groupBy(*keys).agg(*aggs)
    return best.select("_row.*", *([F.col(f"_first.{order[0]}").alias(place)] if place else []))


def ordered_distinct(df: DataFrame, value: str, order: str, fold_case: bool = False) -> DataFrame:
    """Each value once, as first written, with the place of its first row."""
    key = F.lower(F.trim(F.col(value))) if fold_case else F.col(value)
    found = df.where(F.col(value).isNotNull()).groupBy(key.alias("_key")).agg(F.min_by(value, order).alias(value), F.min(order).alias(order))
    return found.drop("_key")


def rank_kept(df: DataFrame, group: list[str], order: list[str], keep: Column, cap: int | None = None, dense: bool = True) -> DataFrame:
    """Rows that pass ``keep`` with their rank in the group: counted over the kept rows, or (not ``dense``) over all."""
    window = Window.partitionBy(*group).orderBy(*order)
    if dense:
        ranked = df.where(keep).withColumn("rank", F.row_number().over(window))
    else:
        ranked = df.withColumn("rank", F.row_number().over(window)).where(keep)
    return ranked if cap is None else ranked.where(F.col("rank") <= cap)
