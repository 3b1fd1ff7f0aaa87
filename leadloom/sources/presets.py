"""Packs of industries, profiles of sources and campaign presets, as small relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The industries of each pack, in their order.
PACKS = {
    "home_services": "Property Management, HOA Management, Commercial Real Estate, Insurance Agencies, Home Insurance, Self Storage, Moving Companies, Roofing, Plumbers, Electricians, Contractors, Pest Control",
    "home_services_light": "Property Management, Home Insurance, Self Storage, Moving Companies, Roofing, Plumbers, Electricians, Contractors, Pest Control, Tree Service",
    "tourism_services": "Property Management, Self Storage, Moving Companies, Carpet Cleaning, Pest Control, AC Repair, Garage Door Repair, Tree Service, Contractors",
    "real_estate_agents": "Real Estate Agents, Real Estate Buyer Brokers, Real Estate Consultants, Commercial Real Estate, Property Management, Home Insurance, Self Storage, Moving Companies, Real Estate Referral & Information Service",
    "car_dealerships": "New Car Dealers, Used Car Dealers, Automobile & Truck Brokers, Wholesale Used Car Dealers",
}
# Pages and scrolls of each profile.
PROFILES = {"metro_heavy": (2, 4), "standard_city": (1, 3), "light_city": (1, 2)}
# Searches of the review site and of places, by industry.
SEARCH_GROUPS = {
    "property_management": "Property Management, Property Manager",
    "commercial_real_estate": "Commercial Real Estate, Commercial Real Estate Brokers",
    "insurance_agents": "Insurance Agents, Insurance Agency, Business Insurance",
    "contractors": "Contractors, General Contractors",
    "plumbing": "Plumbers, Plumbing Services",
    "electrical": "Electricians, Electrical Contractors",
    "roofing": "Roofing, Roofers",
}
PLACE_QUERIES = {
    "property_management": "property management, property manager, apartment management, real estate management",
    "churches": "church, baptist church, methodist church, non-denominational church",
    "insurance_agents": "insurance agency, insurance agent, commercial insurance",
    "commercial_real_estate": "commercial real estate broker, commercial realtor, CRE broker",
}


def _listed(spark: SparkSession, lists: dict[str, str], key: str, extra: tuple = (), schema: str = "") -> DataFrame:
    rows = [(k, v, n, *extra) for k, names in lists.items() for n, v in enumerate(names.split(", "))]
    return spark.createDataFrame(rows, f"{key} string, query string, ord int{schema}")


def packs(spark: SparkSession) -> DataFrame:
    """pack, query, ord, enabled."""
    return _listed(spark, PACKS, "pack", (True,), ", enabled boolean")


def profiles(spark: SparkSession) -> DataFrame:
    """profile, enabled, headless, max_pages, max_scrolls."""
    return spark.createDataFrame([(k, True, True, *v) for k, v in PROFILES.items()], "profile string, enabled boolean, headless boolean, max_pages int, max_scrolls int")


def search_groups(spark: SparkSession) -> DataFrame:
    """industry, query, ord of the review site."""
    return _listed(spark, SEARCH_GROUPS, "industry")


def place_queries(spark: SparkSession) -> DataFrame:
    """industry, query, ord of places."""
    return _listed(spark, PLACE_QUERIES, "industry")


def scraper_versions(spark: SparkSession, known: dict[str, str | None]) -> DataFrame:
    """scraper and version of the three scrapers, "unknown" where none is told."""
    # The scrapers that tell their version.
    return spark.createDataFrame([(k, known.get(k) or "unknown") for k in ("yellowpages", "website_discovery", "website_fetch")], "scraper string, version string")
