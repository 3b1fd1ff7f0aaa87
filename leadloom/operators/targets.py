"""Acquisition targets: markets crossed with the industries of their packs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.urls import blank_to_null, strip

UNRANKED = 10**9
MARKET_ORDER = ("rank_missing", "rank_order", "market_order")


def market_order() -> list[Column]:
    """Ranked markets first by rank (0 counts as unranked), then by name."""
    rank = F.col("population_rank")
    return [rank.isNull(), F.when(F.coalesce(rank, F.lit(0)) == 0, F.lit(UNRANKED)).otherwise(rank), F.coalesce("market", F.lit(""))]


def filter_markets(
    markets: DataFrame,
    *,
    state: str | None = None,
    city: str | None = None,
    region: str | None = None,
    tier: str | None = None,
    market_slugs: list[str] | None = None,
    top_n: int | None = None,
    batch_index: int | None = None,
    batch_size: int | None = None,
    min_population_rank: int | None = None,
    max_population_rank: int | None = None,
    include_disabled: bool = False,
) -> DataFrame:
    """The markets that pass, in order; a missing rank fails either bound, and a page needs ``batch_size``."""
    out = markets if include_disabled else markets.where(F.coalesce("enabled", F.lit(True)))
    same = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    if (state or "").strip():
        out = out.where(F.col("state") == state.strip().upper())
    for column, wanted in (("city", city), ("region", region), ("tier", tier)):
        if (wanted or "").strip():
            out = out.where(same(F.col(column)) == wanted.strip().lower())
    slugs = [s.strip().lower() for s in market_slugs or [] if s.strip()]
    if slugs:
        out = out.where(F.lower("market_slug").isin(*slugs))
    if min_population_rank is not None:
        out = out.where(F.col("population_rank") >= min_population_rank)
    if max_population_rank is not None:
        out = out.where(F.col("population_rank") <= max_population_rank)
    out = out.orderBy(*market_order())
    if top_n is not None:
        out = out.limit(max(0, top_n))
    if batch_size is not None:
        out = out.offset((batch_index or 0) * batch_size).limit(batch_size)
    return out


def build_targets(markets: DataFrame, packs: DataFrame, profiles: DataFrame, pack: str | None = None, max_query_pairs: int | None = None) -> DataFrame:
    """One row for each market and enabled industry of its pack. ``packs`` (pack, query, ord, enabled) and ``profiles``
    (profile, enabled, headless, max_pages, max_scrolls) are small dimensions; an unknown pack or profile is an error."""
    chosen = F.lit(pack) if pack else F.coalesce(blank_to_null(F.col("default_pack")), F.lit("home_services"))
    profile = F.coalesce(blank_to_null(F.col("source_profile")), F.lit("standard_city"))
    m = markets.withColumns({"industry_pack": chosen, "_profile": profile})
    known = lambda key, df, c: m.join(df, m[key] == df[c], "left_anti").select(key).limit(1).collect()
    for key, df, c in (("industry_pack", packs, "pack"), ("_profile", profiles, "profile")):
        if missing := known(key, df, c):
            raise KeyError(f"unknown {c}: {missing[0][0]}")
    usable = packs.where(F.coalesce("enabled", F.lit(True)) & (strip(F.col("query")) != "")).select("pack", strip(F.col("query")).alias("industry"), "ord")
    settings = profiles.where(F.coalesce("enabled", F.lit(True))).select("profile", "headless", "max_pages", "max_scrolls")
    joined = m.join(usable, m.industry_pack == usable.pack).join(settings, F.col("_profile") == settings.profile)
    targets = joined.withColumn("target_order", F.struct(*[c.alias(n) for c, n in zip(market_order(), MARKET_ORDER)], F.col("market_slug"), F.col("ord")))
    columns = ("market_slug", "market", "city", "state", "region", "tier", "population_rank", "industry", "industry_pack", "headless", "max_pages", "max_scrolls")
    if max_query_pairs is not None:
        targets = targets.orderBy("target_order").limit(max(0, max_query_pairs))
    return targets.select(*columns)



def active_pairs(markets: DataFrame, packs: DataFrame, profiles: DataFrame, **kw) -> int:
    """Number of (market, industry) pairs that would be queried."""
    return build_targets(markets, packs, profiles, **kw).count()


def preset_targets(preset: dict | None, markets: DataFrame, packs: DataFrame, profiles: DataFrame, max_query_pairs: int | None = None) -> DataFrame:
    """Targets of a preset: the keyword arguments of filter_markets, and ``pack``; none means every enabled market."""
    chosen = dict(preset or {})
    pack = chosen.pop("pack", None)
    return build_targets(filter_markets(markets, **chosen), packs, profiles, pack=pack, max_query_pairs=max_query_pairs)
