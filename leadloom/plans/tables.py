"""Queries of record tables: places, loader tables, packs and presets, metrics documents, result lists, company expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators import html, parcels, places, runs, targets, websites
from leadloom.plans.catalog import _STAGES, ORACLES, C, companies, query, serp
from leadloom.sources import loaders, presets
from leadloom.sources.scratch import dealt, scratch_path


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Places ------------------------------------------------------------------------------------------------

_RESULTS = (
    "SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'p' || CAST(o_custkey % 200 AS STRING) END AS place_id, 'q' || CAST(o_orderkey % 3 AS STRING) AS query, "
    "'Place ' || CAST(o_orderkey AS STRING) AS name, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey AS STRING) || ' Near St' END AS vicinity, CASE WHEN o_orderkey % 5 > 0 THEN 35.0 + o_orderkey % 7 END AS lat FROM {orders}"
)
_DETAILS = (
    "SELECT s_suppkey AS ord, 'p' || CAST(s_suppkey % 120 AS STRING) AS place_id, CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE s_name || ' Far St' END AS address, '865555' || CAST(1000 + s_suppkey AS STRING) AS phone, "
    "CASE WHEN s_suppkey % 2 = 0 THEN 'site' || CAST(s_suppkey AS STRING) || '.com' END AS website, s_suppkey % 50 AS reviews FROM {supplier}"
)
_NEWEST = "d AS (SELECT place_id, arg_max(t, t.ord) AS t FROM (SELECT place_id, x AS t FROM x) GROUP BY 1)"


def _places(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r = spark.sql(_RESULTS, orders=_table(spark, sf, "orders"))
    d = spark.sql(_DETAILS, supplier=_table(spark, sf, "supplier"))
    where = F.struct(F.struct(F.col("lat").cast("double").alias("lat"), F.lit(-83.0).alias("lng")).alias("location")).alias("geometry")
    fields = [F.col("website"), F.col("address").alias("formatted_address"), F.col("phone").alias("formatted_phone_number"), F.lit(4.5).alias("rating"), F.col("reviews").alias("user_ratings_total")]
    return r.select("place_id", "ord", "query", F.struct("name", "vicinity", where).alias("result")), d.select("place_id", "ord", F.struct(*fields).alias("details"))


_OUT = "coalesce(nullif(d.t.address, ''), r.vicinity) AS address, d.t.phone AS phone, d.t.website AS website, CAST(r.lat AS DOUBLE) AS lat"
_WITH = f"WITH r AS ({_RESULTS.format(orders='orders')}), x AS ({_DETAILS.format(supplier='supplier')}), {_NEWEST}"


@query(
    "place_companies",
    f"{_WITH}, l AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY ord DESC) AS n, count(*) OVER (PARTITION BY place_id) AS times_found FROM r WHERE place_id <> '') "
    f"SELECT r.place_id, r.name, {_OUT}, CASE WHEN r.lat IS NOT NULL OR true THEN -83.0 END::DOUBLE AS lng, CASE WHEN d.place_id IS NOT NULL THEN 4.5 END::DOUBLE AS rating, d.t.reviews AS reviews, times_found FROM l r LEFT JOIN d ON d.place_id = r.place_id WHERE n = 1",
)
def place_companies(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each place, of the search result that came last, with details where there are any."""
    return places.place_companies(*_places(spark, sf))


@query(
    "place_records",
    f"{_WITH} SELECT r.place_id AS source_id, r.query, r.name AS found_name, {_OUT}, d.t.reviews AS reviews, 'google_places' AS source, 'Knoxville' AS market FROM r LEFT JOIN d ON d.place_id = r.place_id WHERE r.place_id <> ''",
)
def place_records(spark: SparkSession, sf: str) -> DataFrame:
    """One raw document for each result with an id."""
    out = places.place_records(*_places(spark, sf), "run", "Knoxville", F.lit("2026-01-01").cast("timestamp"))
    e = "extracted."
    return out.select(
        "source_id", "query", F.col("raw.nearby_search.name").alias("found_name"), F.col(e + "raw_address").alias("address"), F.col(e + "raw_phone").alias("phone"), F.col(e + "raw_website").alias("website"),
        F.col(e + "lat").alias("lat"), F.col("raw.details.user_ratings_total").alias("reviews"), "source", "market",
    )


# Loader tables -------------------------------------------------------------------------------------------

_KEY = "coalesce(nullif(lower(trim(coalesce(nullif(domain, ''), nullif(website, ''), ''))), ''), md5(lower(trim(coalesce(nullif(canonical_name, ''), 'unknown'))) || '|' || lower(trim(coalesce(mailing_street, ''))) || '|' || trim(coalesce(mailing_zip, ''))))"
_TEXT = {"mailing_street", "mailing_city", "mailing_state", "mailing_zip", "physical_address", "phone_primary", "email_primary", "website", "contact_form_url", "facebook_url", "canonical_name", "domain"}


def _null(column: str) -> str:
    kinds = {"array<string>": "VARCHAR[]", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "timestamp": "TIMESTAMP"}
    return f"NULL::{kinds[loaders.KINDS[column]] if column in loaders.KINDS else 'VARCHAR'} AS {column}"


def _sql_columns(names: list[str], known: dict[str, str]) -> str:
    return ", ".join(f"{known[n]} AS {n}" if n in known else _null(n) for n in names)


_KNOWN = {n: n for n in _TEXT} | {"lat": "lat::DOUBLE", "lng": "lng::DOUBLE", "google_reviews_rating": "google_reviews_rating", "google_reviews_count": "google_reviews_count"}
_OBJECTS = {n: "'{}'" for n in ("website_tech_stack", "behavioral_signals", "lead_quality", "industry_attributes")}


@query(
    "loader_company_rows",
    f"{C} SELECT " + _sql_columns(loaders.COMPANY_COLUMNS, _KNOWN | _OBJECTS | {"dedupe_key": _KEY, "website_status": "try_cast(website_status AS INTEGER)", "dataset_id": "CAST(dataset_id AS VARCHAR)", "alias_names": "[canonical_name]"}) + " FROM companies",
)
def loader_company_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All 39 columns of the canonical table, appended and read back."""
    return loaders.append_table(loaders.company_rows(companies(spark, sf).withColumn("alias_names", F.array("canonical_name"))), scratch_path(spark, "companies"))


@query(
    "loader_clean_rows",
    f"{C} SELECT " + _sql_columns(loaders.CLEAN_COLUMNS, _KNOWN | _OBJECTS | {"business_id": "CAST(id AS VARCHAR)", "alias_names": "'[\"' || canonical_name || '\"]'", "enrichment_sources": "'[]'", "website_status": "website_status"}).replace("NULL::INTEGER AS website_status", "website_status") + " FROM companies",
)
def loader_clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    given = companies(spark, sf).withColumns({"business_id": F.col("id"), "alias_names": F.array("canonical_name")})
    return loaders.append_table(loaders.clean_rows(given), scratch_path(spark, "clean"))


@query(
    "loader_raw_rows",
    "SELECT " + _sql_columns(loaders.RAW_COLUMNS, {"source": "'supplier'", "source_id": "CAST(s_suppkey AS VARCHAR)", "scraped_at": "TIMESTAMP '2026-01-01'", "raw_company_name": "s_name", "raw_address": "s_name", "raw_phone": "CAST(s_nationkey AS VARCHAR)", "raw_json": "CASE WHEN s_suppkey % 2 = 0 THEN '{\"n\":' || s_suppkey || '}' ELSE '{}' END"}) + " FROM supplier",
)
def loader_raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    s = _table(spark, sf, "supplier")
    raw = s.select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("raw_company_name"), F.col("s_name").alias("raw_address"), F.col("s_nationkey").alias("raw_phone"), F.when(F.col("s_suppkey") % 2 == 0, F.struct(F.col("s_suppkey").alias("n"))).alias("raw_json"))
    return loaders.append_table(loaders.raw_rows(raw, F.lit("2026-01-01")), scratch_path(spark, "raw"))


# Packs, profiles, presets ----------------------------------------------------------------------------------

_PACK_MARKETS = (
    "SELECT lower(replace(n_name, ' ', '-')) AS market_slug, 'TN' AS state, n_name AS city, n_name || ', TN' AS market, CAST(n_nationkey + 1 AS INT) AS population_rank, true AS enabled, "
    "CASE n_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'home_services_light' WHEN 2 THEN 'tourism_services' WHEN 3 THEN 'real_estate_agents' ELSE 'car_dealerships' END AS default_pack, "
    "CASE n_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'metro_heavy' ELSE 'light_city' END AS source_profile, CAST(NULL AS STRING) AS region, CAST(NULL AS STRING) AS tier FROM {nation}"
)


@query(
    "pack_targets",
    "WITH n AS (SELECT n_nationkey AS k, lower(replace(n_name, ' ', '-')) AS market_slug FROM nation) SELECT market_slug, CASE k % 5 WHEN 0 THEN 12 WHEN 1 THEN 10 WHEN 4 THEN 4 ELSE 9 END::BIGINT AS industries, "
    "CASE k % 3 WHEN 1 THEN 2 ELSE 1 END AS max_pages, CASE k % 3 WHEN 0 THEN 3 WHEN 1 THEN 4 ELSE 2 END AS max_scrolls, CASE k % 5 WHEN 0 THEN 'Commercial Real Estate' WHEN 1 THEN 'Contractors' WHEN 2 THEN 'AC Repair' WHEN 3 THEN 'Commercial Real Estate' ELSE 'Automobile & Truck Brokers' END AS first_industry FROM n",
)
def pack_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Markets crossed with the industries of the packs that stand in the library, under its profiles."""
    markets = spark.sql(_PACK_MARKETS, nation=_table(spark, sf, "nation"))
    found = targets.build_targets(markets, presets.packs(spark), presets.profiles(spark))
    return found.groupBy("market_slug", "max_pages", "max_scrolls").agg(F.count(F.lit(1)).alias("industries"), F.min("industry").alias("first_industry"))


# Metrics ----------------------------------------------------------------------------------------------------

_FIELDS = {n: "0::BIGINT" for n, _ in runs.METRIC_FIELDS} | {
    "companies_seeded": "coalesce(nullif(try_cast(seeded AS BIGINT), 0), run_no + 5)", "companies_enriched": "run_no % 7", "expansion_apply_applied": "run_no % 7", "leads_inserted": "coalesce(try_cast(inserted AS BIGINT), 9)", "companies_in_run": "run_no + 5",
}


@query(
    "metrics_documents",
    f"WITH s AS ({_STAGES.format(supplier='supplier')}) SELECT 'r' || run_no AS run_id, NULL::VARCHAR AS dataset_id, 'cron' AS trigger, 'completed' AS status, NULL::VARCHAR AS error_message, "
    + ", ".join(f"({v})::BIGINT AS {n}" for n, v in _FIELDS.items())
    + ", " + ", ".join(f"{'round(coalesce(try_cast(elapsed AS DOUBLE), 0), 2)' if n == 'etl' else '0.0'}::DOUBLE AS {n}_elapsed_seconds" for n in runs.ELAPSED)
    + " FROM s",
)
def metrics_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the run metrics, written as a JSON document a run, one half of the runs twice, and read back."""
    s = spark.sql(_STAGES, supplier=_table(spark, sf, "supplier"))
    m = lambda **kv: F.map_filter(F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), F.col(v))]), lambda k, v: v.isNotNull())
    nothing = F.create_map().cast("map<string,string>")
    results = s.select(
        F.concat(F.lit("r"), F.col("run_no")).alias("run_id"), F.lit(None).cast("string").alias("dataset_id"), F.lit("cron").alias("trigger"), F.lit("completed").alias("status"), F.lit(None).cast("string").alias("error_message"),
        nothing.alias("ingest"), m(canonical_companies_upserted_current_state="seeded", elapsed_seconds="elapsed").alias("etl"), nothing.alias("expansion"), m(applied="applied").alias("apply"),
        m(leads_inserted_this_execution="inserted", leads_inserted_reported="reported").alias("contacts"), m(companies_in_run="in_run").alias("validation"),
    )
    payload, path = runs.metrics_payload(results), scratch_path(spark, "metrics")
    loaders.write_metrics(payload.where("length(run_id) % 2 = 0").withColumn("status", F.lit("failed")), path)
    loaders.write_metrics(payload, path)
    return loaders.read_metrics(spark, path, payload.schema.simpleString())


# Result lists and expansion ------------------------------------------------------------------------------------


@query(
    "bing_results",
    "WITH s AS (SELECT s_nationkey AS page, s_suppkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier WHERE s_suppkey % 4 IN (0, 3)) "
    "SELECT page, 'bing_serp' AS source, CAST(n AS INTEGER) AS rank, CASE k % 4 WHEN 0 THEN 'Acme Roofing ' || k ELSE 'Some site' END AS title, 'https://site' || k || '.com/' || CASE k % 4 WHEN 0 THEN 'about' ELSE '' END AS url, CASE k % 4 WHEN 0 THEN 'said' ELSE '' END AS snippet FROM s WHERE n <= 30",
)
def bing_results(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of suppliers as results: businesses by a hint or a bare address; others, first on the page, take no rank."""
    k = F.col("s_suppkey").cast("string")
    item = lambda title, url, said: F.concat(F.lit('<li class="b_algo"><h2><a href="'), url, F.lit('">'), title, F.lit("</a></h2>"), said, F.lit("</li>"))
    site = F.concat(F.lit("https://site"), k, F.lit(".com/"))
    caption = F.lit('<div class="b_caption"><p>said</p></div>')
    of = F.when(F.col("s_suppkey") % 4 == 0, item(F.concat(F.lit("Acme Roofing "), k), F.concat(site, F.lit("about")), caption)).when(F.col("s_suppkey") % 4 == 3, item(F.lit("Some site"), site, F.lit("")))
    of = of.when(F.col("s_suppkey") % 4 == 1, item(F.lit("Acme Roofing"), F.lit("https://www.facebook.com/acme"), caption)).otherwise(item(F.lit("How to roof, a guide"), site, caption))
    rows = _table(spark, sf, "supplier").select(F.col("s_nationkey").alias("page"), F.struct((F.col("s_suppkey") % 4 == 3).alias("last"), "s_suppkey", of.alias("item")).alias("i"))
    items = F.array_sort(F.collect_list(F.struct(F.col("i.s_suppkey").alias("k"), F.col("i.item").alias("item"))))
    pages = rows.groupBy("page").agg(F.array_join(F.transform(items, lambda x: x["item"]), "").alias("html"))
    return html.search_results(pages, "bing")


@query(
    "company_expansion_full",
    f"WITH w AS ({ORACLES['website_pick']}), a AS (SELECT DISTINCT l_orderkey AS company_id FROM lineitem), k AS (SELECT s_suppkey, 'https://www.acme' || s_suppkey % 20 || '.com/about/us' AS site, s_name FROM supplier), "
    "p AS (SELECT site, arg_min(s_name, s_suppkey) AS phone FROM k GROUP BY 1) "
    "SELECT a.company_id, 'Acme Roofing ' || CASE WHEN a.company_id % 2 = 0 THEN 'Experts' ELSE 'Inc' END AS canonical_name, w.website, w.domain, coalesce(w.confidence, 0.0)::DOUBLE AS confidence, p.phone, CASE WHEN p.phone IS NOT NULL THEN 'a@b.c' END AS email, "
    "NULL::VARCHAR AS contact_form_url, ['bing_serp'] AS sources FROM a LEFT JOIN w ON w.company_id = a.company_id LEFT JOIN p ON p.site = w.website",
)
def company_expansion_full(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of every company's expansion; contacts are known for some of the sites."""
    found = serp(spark, sf)
    named = found.select("company_id", "canonical_name").distinct()
    site = F.concat(F.lit("https://www.acme"), (F.col("s_suppkey") % 20).cast("string"), F.lit(".com/about/us"))
    contacts = _table(spark, sf, "supplier").groupBy(site.alias("website")).agg(F.min_by("s_name", "s_suppkey").alias("phone"))
    contacts = contacts.withColumns({"email": F.lit("a@b.c"), "contact_form_url": F.lit(None).cast("string")})
    return websites.expand_companies(named, found.drop("canonical_name").withColumn("source", F.lit("bing_serp")), contacts)


# Parcel sections ------------------------------------------------------------------------------------------------

@query(
    "parcel_sections",
    "WITH c AS (SELECT c_custkey AS k, c_mktsegment AS segment FROM customer) SELECT k AS parcel, 'Parcel ' || k AS title, 2020 + k % 5 AS tax_year, CASE WHEN k % 2 = 0 THEN k % 95 END AS county_number, k * 1000 + 7 AS land_value, "
    "CASE WHEN k % 3 > 0 THEN k * 2 END AS improvement, 25::BIGINT AS percentage, segment AS subdivision, 'B' || k AS plat_book, CASE WHEN k % 4 > 0 THEN '01' END AS water_code, CASE WHEN k % 4 > 0 THEN 'PUBLIC - ' || segment ELSE 'NONE' END AS water, k % 7 AS acres, "
    "CASE WHEN k % 5 = 0 THEN 0 ELSE 1 END::INTEGER AS sheds, CASE WHEN k % 5 > 0 AND k % 10 < 9 THEN k END AS units, CASE WHEN k % 5 > 0 THEN CASE WHEN k % 10 = 9 THEN 'none' ELSE CAST(k AS VARCHAR) || ' SQFT' END END AS units_text FROM c",
)
def parcel_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Pages made from customers, read into typed sections."""
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    t = lambda c: c.cast("string")
    line = lambda label, value: F.concat(F.lit(f"<p class='detailsPage'>{label}: "), value, F.lit("</p>"))
    card = lambda header, *parts: F.concat(F.lit(f"<div class='card'><div class='card-header'>{header}</div><div class='card-body'>"), *parts, F.lit("</div></div>"))
    some = lambda when, c: F.when(when, c).otherwise("")
    money = F.concat(F.lit("$"), F.format_number(k * 1000 + 7, 0), F.lit(".00"))
    row = F.concat(F.lit("<tr><td>1</td><td>SHED</td><td>old</td><td>"), F.when(k % 10 == 9, "none").otherwise(F.concat(t(k), F.lit(" SQFT"))), F.lit("</td></tr>"))
    page = F.concat(
        F.lit("<html><head><title>Parcel "), t(k), F.lit("</title></head><body><div class='parcel-county-and-tax-year'>Knox - Tax Year "), t(2020 + k % 5), F.lit("</div>"),
        card("County Information", some(k % 2 == 0, line("County Number", t(k % 95)))),
        card("Value Information", line("Land Market Value", money), some(k % 3 > 0, line("Improvement Value", t(k * 2))), line("Assessment Percentage", F.lit("25%"))),
        card("Subdivision Data", line("Subdivision", seg), line("Plat Book", F.concat(F.lit("B"), t(k)))),
        card("General Information", line("Utilities - Water/Sewer", F.when(k % 4 > 0, F.concat(F.lit("01 - PUBLIC - "), seg)).otherwise("NONE"))),
        card("Land Information", line("Deed Acres", t(k % 7))),
        card("Outbuildings & Yard Items", F.lit("<table><tr><th>Card</th><th>Type</th><th>Description</th><th>Units</th></tr>"), some(k % 5 > 0, row), F.lit("</table>")), F.lit("</body></html>"),
    )
    out = parcels.parcel_sections(dealt(_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")).select(k.alias("parcel"), page.alias("html")))
    shed = F.get("outbuildings", F.lit(0))
    return out.select(
        "parcel", "title", F.col("tax_year").cast("bigint").alias("tax_year"), "county.county_number", F.col("values.land_market_value").alias("land_value"), F.col("values.improvement_value").alias("improvement"),
        F.col("values.assessment_percentage").alias("percentage"), "plat.subdivision", "plat.plat_book", F.col("utilities.water_sewer.code").alias("water_code"), F.col("utilities.water_sewer.desc").alias("water"),
        F.col("land.deed_acres").alias("acres"), F.size("outbuildings").alias("sheds"), shed["units"].alias("units"), shed["units_text"].alias("units_text"),
    )
