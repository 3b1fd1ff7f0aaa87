"""Distances and likeness of names and places, and the keys that identify a company."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.functions.binding import together
from leadloom.functions.text import name_canonical, name_resolver
from leadloom.functions.urls import blank_to_null, domain_resolver, strip

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a1, o1, a2, o2 = (F.radians(c.try_cast("double")) for c in (lat1, lng1, lat2, lng2))
    a = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(a))


def sorted_tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(c, r"\s+"), lambda t: t != "")), " ")


@lru_cache(maxsize=200_000)  # names come again, with the rows of one group close together
def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word of ``a`` at a time."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    all_ones = (1 << len(a)) - 1
    state = all_ones
    for ch in b:
        hit = state & places.get(ch, 0)
        state = (state + hit | state - hit) & all_ones
    return (all_ones & ~state).bit_count()


@lru_cache(maxsize=1)
def _common_lengths():
    @F.pandas_udf("int")
    def lengths(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([common_length(x, y) if x is not None and y is not None else 0 for x, y in zip(a, b)], dtype="int32")

    return lengths


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Likeness of two short names with their words in order, 0 to 100: twice the common subsequence over both lengths."""
    return ratio_of_sorted(sorted_tokens(a), sorted_tokens(b))


def ratio_of_sorted(x: Column, y: Column) -> Column:
    """As ``token_sort_ratio``, of names that are ``sorted_tokens`` already."""
    total = F.length(x) + F.length(y)
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * _common_lengths()(x, y) / total)


def overlap_words(name: Column) -> Column:
    """The distinct words of a name as ``token_overlap`` compares them."""
    return F.array_distinct(F.filter(F.split(name_canonical(name), " "), lambda t: t != ""))


def token_overlap(a: Column, b: Column) -> Column:
    """Shared words of two canonical names in per cent of the shorter one."""
    return words_overlap(overlap_words(a), b)


def words_overlap(words: Column, b: Column) -> Column:
    """As ``token_overlap``, the first name given by its ``overlap_words``."""
    said = {"x": words, "y": overlap_words(b)}
    counts = lambda s: {"shared": F.size(F.array_intersect(s["x"], s["y"])), "shorter": F.least(F.size(s["x"]), F.size(s["y"]))}
    ratio = lambda n: F.when(n["shared"] > 0, F.bround(100.0 * n["shared"] / n["shorter"], 0).cast("int")).otherwise(F.lit(0))
    return together(said, lambda s: together(counts(s), ratio))


def resolver_key(website: Column, domain: Column, name: Column, street: Column, zip_code: Column) -> Column:
    """Domain of the website, else a hash of the normalised name, street and zip."""
    parts = [F.coalesce(blank_to_null(name_resolver(name)), F.lit("unknown")), F.lower(F.coalesce(street, F.lit(""))), F.coalesce(zip_code, F.lit(""))]
    return F.coalesce(blank_to_null(domain_resolver(F.coalesce(blank_to_null(website), domain))), F.md5(F.concat_ws("|", *parts)))


def loader_key(domain: Column, website: Column, name: Column, street: Column, zip_code: Column) -> Column:
    """Domain or website as written, else a hash of the name (suffixes kept), street and zip."""
    given = F.lower(strip(F.coalesce(blank_to_null(domain), blank_to_null(website), F.lit(""))))
    tidy = lambda c, other="": F.lower(strip(F.coalesce(blank_to_null(c), F.lit(other))))
    return F.coalesce(blank_to_null(given), F.md5(F.concat_ws("|", tidy(name, "unknown"), tidy(street), strip(F.coalesce(zip_code, F.lit(""))))))
