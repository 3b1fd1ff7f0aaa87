"""Places: results of nearby searches with the details that came for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.urls import blank_to_null


def _struct(values: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in values.items()])


def with_details(results: DataFrame, details: DataFrame) -> DataFrame:
    """A row for each place_id: the result that came last (``ord``), and the details of the place, null if none came.

    ``results``: place_id, ord, query and result (struct of name, vicinity, geometry.location.lat and lng); ``details``: place_id, ord and
    details (struct of website, formatted_address, formatted_phone_number, rating, user_ratings_total). Both sides go through one aggregation by place, with partial
    sums, so neither is joined and a place that came often is not gathered. Results without an id go, as do details of places that no search found.
    """
    last = ("result", "query")
    seen = results.where(F.coalesce("place_id", F.lit("")) != "").select("place_id", "ord", *last, F.lit(None).cast(details.schema["details"].dataType).alias("details"))
    told = details.select("place_id", "ord", *[F.lit(None).cast(results.schema[c].dataType).alias(c) for c in last], "details")
    of_result, of_details = F.when(F.col("result").isNotNull(), F.col("ord")), F.when(F.col("details").isNotNull(), F.col("ord"))
    both = seen.unionByName(told).groupBy("place_id").agg(
        F.max_by(F.struct(*last), of_result).alias("found"), F.max_by("details", of_details).alias("details"), F.count_if(F.col("result").isNotNull()).alias("times_found")
    )
    return both.where("found IS NOT NULL").select("place_id", "found.*", "details", "times_found")


def _extracted(result: Column, details: Column) -> dict[str, Column]:
    """Fields of a place: the details' address where there is one, else the vicinity."""
    location = result["geometry"]["location"]
    return {
        "raw_company_name": result["name"],
        "raw_address": F.coalesce(blank_to_null(details["formatted_address"]), result["vicinity"]),
        "raw_phone": details["formatted_phone_number"],
        "raw_website": details["website"],
        "lat": location["lat"],
        "lng": location["lng"],
        "google_reviews_rating": details["rating"],
        "google_reviews_count": details["user_ratings_total"],
    }


def place_records(results: DataFrame, details: DataFrame, run_id: str, market: str, captured_at: Column) -> DataFrame:
    """Raw documents of a search: one for each result with an id, in which the payloads stay whole beside the ``extracted`` fields."""
    newest = details.groupBy("place_id").agg(F.max_by("details", "ord").alias("details"))
    rows = results.where(F.coalesce("place_id", F.lit("")) != "").join(newest, "place_id", "left")
    fields = _struct(_extracted(F.col("result"), F.col("details")))
    raw = F.struct(F.col("result").alias("nearby_search"), "details")
    return rows.select(
        F.lit(run_id).alias("run_id"), F.lit("google_places").alias("source"), F.col("place_id").alias("source_id"), captured_at.alias("captured_at"), F.lit(market).alias("market"), "query", raw.alias("raw"), fields.alias("extracted"),
    )


def place_companies(results: DataFrame, details: DataFrame) -> DataFrame:
    """One row for each place: place_id, name, address, phone, website, lat, lng, rating and reviews; the last result of a place counts."""
    names = ("name", "address", "phone", "website", "lat", "lng", "rating", "reviews")
    fields = _extracted(F.col("result"), F.col("details"))
    return with_details(results, details).select("place_id", *[c.alias(n) for n, c in zip(names, fields.values())], "times_found")
