"""Readers and writers of landed files, and generated relations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.functions.text import slug, truthy
from leadloom.functions.urls import blank_to_null, strip

MARKET_FIELDS = "market_slug state city market population population_rank enabled default_pack source_profile region tier notes".split()
PARCEL_FIELDS = {
    "Owner": "owner_name", "Property Address": "property_address", "Control Map": "control_map", "Group": "group_code", "Parcel": "parcel", "Special Interest": "special_interest",
    "Parcel ID": "parcel_id", "Subdivision": "subdivision", "Lot": "lot", "Class": "property_class", "Sale Date": "sale_date",
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns as text; a byte-order mark is no part of the first name."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.toDF(*[c.removeprefix("﻿").strip() for c in df.columns])


def market_registry(rows: DataFrame) -> DataFrame:
    """Typed market rows: trimmed, defaults filled, the market's name and slug derived where missing, unusable rows dropped."""
    text = {c: blank_to_null(strip(F.col(c))) if c in rows.columns else F.lit(None).cast("string") for c in MARKET_FIELDS}
    state = F.upper(text["state"])
    market = F.coalesce(text["market"], F.concat_ws(", ", text["city"], state))
    number = lambda c: F.when(text[c].rlike(r"^[+-]?\d+$"), text[c].try_cast("int"))
    out = rows.select(
        F.coalesce(text["market_slug"], slug(text["city"], state)).alias("market_slug"),
        state.alias("state"),
        text["city"].alias("city"),
        market.alias("market"),
        number("population").alias("population"),
        number("population_rank").alias("population_rank"),
        truthy(text["enabled"], True).alias("enabled"),
        F.coalesce(text["default_pack"], F.lit("home_services")).alias("default_pack"),
        F.coalesce(text["source_profile"], F.lit("standard_city")).alias("source_profile"),
        *[text[c].alias(c) for c in ("region", "tier", "notes")],
    )
    return out.where("city is not null and state is not null and market is not null")


def parcels(rows: DataFrame, county: str, run_id: str) -> DataFrame:
    """Parcel rows of a county export under their own names, blanks as null, with the original row as a map."""
    named = [blank_to_null(strip(F.col(f"`{c}`"))).alias(n) if c in rows.columns else F.lit(None).cast("string").alias(n) for c, n in PARCEL_FIELDS.items()]
    original = F.map_from_arrays(F.array(*[F.lit(c) for c in rows.columns]), F.array(*[F.col(f"`{c}`").cast("string") for c in rows.columns]))
    return rows.select(F.lit(run_id).alias("run_id"), F.lit(county).alias("county"), *named, original.alias("raw_csv_row"))


KEY_VALUE = r"^([A-Za-z0-9_]+):\s*(.+?)\s*$"
INGESTED = r"(?i)INGESTION COMPLETE\s+[\x{2014}-]\s+(\d+)\s+raw records\s+\(run_id=([^)]+)\)"


def log_values(lines: DataFrame, group: list[str], order: str = "line_no", text: str = "line") -> DataFrame:
    """Key and value of "key: value" log lines: the last of each key, but the first run_id; with the line it came from."""
    found = lines.select(*group, F.col(order), F.regexp_extract(text, KEY_VALUE, 1).alias("key"), F.regexp_extract(text, KEY_VALUE, 2).alias("value")).where("key <> ''")
    best = found.groupBy(*group, "key").agg(F.max_by("value", order).alias("last"), F.min_by("value", order).alias("first"))
    return best.select(*group, "key", F.when(F.col("key") == "run_id", F.col("first")).otherwise(F.col("last")).alias("value"))


def ingested(line: Column) -> Column:
    """Struct of records and run_id of the line that ends an ingestion; null for other lines."""
    found = F.regexp_extract(line, INGESTED, 2)
    return F.when(found != "", F.struct(F.regexp_extract(line, INGESTED, 1).cast("bigint").alias("records"), found.alias("run_id")))


def geo_grid(centres: DataFrame, grid_size: int = 5, step_km: float = 3.0, earth_km: float = 6371.0) -> DataFrame:
    """Points around each centre (lat, lng and any other columns), row by row; an even size has one point more on each side."""
    half = grid_size // 2
    steps = F.sequence(F.lit(-half), F.lit(half))
    degrees = step_km / earth_km * (180 / math.pi)
    rows = centres.withColumn("grid_row", F.explode(steps)).withColumn("grid_col", F.explode(steps))
    lat = F.col("lat") + F.col("grid_row") * F.lit(degrees)
    lng = F.col("lng") + F.col("grid_col") * F.lit(degrees) / F.cos(F.col("lat") * F.lit(math.pi / 180))
    return rows.withColumns({"point_lat": lat, "point_lng": lng})


def append_run(rows: DataFrame, path: str) -> None:
    """Raw rows by run, so that reading, archiving or purging one run touches that run only."""
    rows.write.mode("append").partitionBy("run_id").parquet(path)


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Raw rows of one run."""
    if not run_id:
        raise ValueError("run_id is required")
    return spark.read.parquet(path).where(F.col("run_id") == run_id)


def flatten_extracted(docs: DataFrame, as_of: Column) -> DataFrame:
    """Raw records out of documents with an ``extracted`` struct; an unknown capture time is ``as_of``."""
    have = {f.name for f in docs.schema["extracted"].dataType.fields}
    names = ("source_id", "raw_company_name", "raw_address", "raw_phone", "raw_website", "lat", "lng", "google_reviews_rating", "google_reviews_count")
    kept = [F.col(f"extracted.{c}").alias(c) if c in have else F.lit(None).cast(T.StringType()).alias(c) for c in names]
    return docs.select("run_id", "source", *kept, F.coalesce(F.col("captured_at"), as_of).alias("scraped_at"), F.to_json("extracted").alias("raw_json"))


def write_sorted_csv(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.mode("overwrite").csv(path, header=True)


def archive_run(raw: DataFrame, run_id: str, path: str) -> DataFrame:
    """Write one run's rows as compressed JSON lines and return its manifest: rows matched and rows found in the archive."""
    mine = raw.where(F.col("run_id") == run_id)
    mine.write.mode("overwrite").option("compression", "gzip").json(path)
    written = raw.sparkSession.read.schema(mine.schema).json(path)
    counts = lambda df, n: df.agg(F.count(F.lit(1)).alias(n), F.lit(run_id).alias("run_id"))
    return counts(mine, "matched").join(counts(written, "written"), "run_id").withColumn("complete", F.col("matched") == F.col("written"))


def purge_run(raw: DataFrame, run_id: str) -> DataFrame:
    """All rows but those of a run; the caller writes them to a new place."""
    return raw.where(~F.col("run_id").eqNullSafe(F.lit(run_id)))


def line_numbers(lines: DataFrame, group: str, order: str) -> DataFrame:
    return lines.withColumn("line_no", F.row_number().over(Window.partitionBy(group).orderBy(order)))
