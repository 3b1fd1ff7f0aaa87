"""Queries of landed pages and raw tables: registries, bureaus, detail pages, result lists, sites, runs and seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.functions.binding import filled
from leadloom.operators import html, records, runs, targets, websites
from leadloom.plans.catalog import query
from leadloom.sources import presets, readers
from leadloom.sources.scratch import dealt, scratch_path


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _page(*parts: Column | str) -> Column:
    """Parts in a row; null ones are left out."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p for p in parts])


# Detail pages -----------------------------------------------------------------------------------------


@query(
    "registry_records",
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'detail_fields_missing' ELSE 'parsed' END AS source_status, CASE WHEN c_custkey % 4 > 0 THEN 'LLC' END AS entity_type, "
    "CASE WHEN c_custkey % 4 > 0 AND c_custkey % 3 > 0 THEN 'Active' END AS business_status, CASE WHEN c_custkey % 4 > 0 THEN '00' || c_custkey END AS control_number, CASE WHEN c_custkey % 2 = 0 THEN c_name || ', 1 Main St' END AS registered_agent FROM customer",
)
def registry_records(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    h4 = lambda label, value: _page(f"<h4>{label}: ", value, "</h4>")
    facts = F.when(k % 4 > 0, _page(h4("Entity Type", F.lit("LLC")), F.when(k % 3 > 0, h4("Status", F.lit("Active"))), h4("Control Number", _page("00", _text(k)))))
    agent = F.when(k % 2 == 0, _page("<div class='col-md-4'><h4>Registered Agent</h4><h4>", F.col("c_name"), "</h4><h4>1 Main St</h4></div>"))
    pages = dealt(_table(spark, sf, "customer").select("c_custkey", "c_name")).select(k.alias("id"), _page("<div id='business-details'>", facts, agent, "</div>").alias("html"))
    return html.registry_records(pages).select("id", "source_status", "entity_type", "business_status", "control_number", "registered_agent")


@query(
    "bureau_records",
    "SELECT c_custkey AS id, c_custkey % 2 = 0 AS accredited, CASE WHEN c_custkey % 3 > 0 THEN 'A+' END AS rating, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 40 END::INTEGER AS complaints FROM customer",
)
def bureau_records(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    said = [F.when(k % 2 == 0, "<span>BBB Accredited Business</span>"), F.when(k % 3 > 0, "<span class='dtm-LetterGrade'> A+ </span>"), F.when(k % 5 > 0, _page("<p>", _text(k % 40), " complaints closed</p>"))]
    return html.bureau_records(dealt(_table(spark, sf, "customer").select("c_custkey")).select(k.alias("id"), _page(*said).alias("html")))


@query(
    "detail_websites",
    "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN 'https://own' || s_suppkey || '.com/a' ELSE 'https://deep' || s_suppkey || '.com' END AS website, "
    "CASE s_suppkey % 3 WHEN 0 THEN 'none' ELSE 'yp_detail' END AS method, CASE s_suppkey % 3 WHEN 0 THEN 0.0 ELSE 0.7 END::DOUBLE AS confidence FROM supplier",
)
def detail_websites(spark: SparkSession, sf: str) -> DataFrame:
    """Listings without a usable card link, and their detail pages: a social link first, then their own, plain or behind a redirect, or none."""
    k = _text(F.col("s_suppkey"))
    link = lambda url: _page("<a class='website-link' href='", url, "'>Visit Website</a>")
    own = F.when(F.col("s_suppkey") % 3 == 1, link(_page("https://own", k, ".com/a"))).when(F.col("s_suppkey") % 3 == 2, link(_page("https://r.example.com/?url=https%3A%2F%2Fdeep", k, ".com")))
    pages = dealt(_table(spark, sf, "supplier").select("s_suppkey")).select("s_suppkey", _page(link(F.lit("https://www.facebook.com/x")), own).alias("html"))
    listings = _table(spark, sf, "supplier").select("s_suppkey", F.lit("https://www.yelp.com/biz/x").alias("raw_website"))
    found = listings.join(html.detail_websites(pages, "s_suppkey"), "s_suppkey", "left")
    return records.discovered_websites(found, detail_website="detail_website").select(F.col("s_suppkey").alias("id"), "website", "method", "confidence")


# Result lists of the other engines -------------------------------------------------------------------------


@query(
    "other_results",
    "WITH s AS (SELECT s_nationkey AS page, s_suppkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS place FROM supplier), t AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY k) AS kept FROM s WHERE k % 3 > 0) "
    "SELECT 'brave_serp' AS source, page, CAST(kept AS INTEGER) AS rank, 'T' || k AS title, 'https://s' || k || '.com' AS url FROM t WHERE kept <= 10 UNION ALL SELECT 'duckduckgo_serp', page, CAST(place AS INTEGER), 'T' || k, 'https://s' || k || '.com' FROM t WHERE place <= 10",
)
def other_results(spark: SparkSession, sf: str) -> DataFrame:
    """Every third result has no title: one engine ranks those kept, the other counts all."""
    k = F.col("s_suppkey")
    item = lambda cls: _page(f"<a class='{cls}' href='https://s", _text(k), ".com'>", F.when(k % 3 > 0, _page("T", _text(k))), "</a>")
    out = None
    for engine, cls in (("brave", "result-header"), ("ddg", "result-link")):
        items = F.array_sort(F.collect_list(F.struct(k.alias("k"), item(cls).alias("item"))))
        pages = _table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("page")).agg(F.array_join(F.transform(items, lambda x: x["item"]), "").alias("html"))
        found = html.search_results(pages, engine).select("source", "page", "rank", "title", "url")
        out = found if out is None else out.unionByName(found)
    return out


# Company sites -------------------------------------------------------------------------------------------------


@query(
    "site_contact_merge",
    "WITH p AS (SELECT c_nationkey AS site, c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 404 ELSE 200 END AS status, CASE WHEN c_custkey % 3 = 0 THEN 'info' || c_custkey || '@x.com' END AS email, "
    "CASE WHEN c_custkey % 4 = 1 THEN '865555' || (1000 + c_custkey % 9000) END AS phone, CASE WHEN c_custkey % 6 = 2 THEN 'https://site' || c_nationkey || '.com/form' || c_custkey END AS form, CASE WHEN c_custkey % 7 = 3 THEN 'Foot ' || c_custkey END AS footer FROM customer) "
    "SELECT site, arg_max(status, k) AS website_status, arg_min(email, k) FILTER (status = 200 AND email IS NOT NULL) AS email, arg_min(phone, k) FILTER (status = 200 AND phone IS NOT NULL) AS phone, arg_min(form, k) FILTER (status = 200 AND form IS NOT NULL) AS contact_form_url, "
    "arg_min(footer, k) FILTER (status = 200 AND footer IS NOT NULL) AS footer, count(*) FILTER (status = 200) AS pages_read FROM p GROUP BY site",
)
def site_contact_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of sites made from customers, merged to a row a site: the first hit of each fact over pages that were found."""
    k = F.col("c_custkey")
    url = _page("https://site", _text(F.col("c_nationkey")), ".com/form", _text(k))
    said = [F.when(k % 3 == 0, _page("<p>INFO", _text(k), "@x.com</p>")), F.when(k % 4 == 1, _page("<p>865-555-", _text(1000 + k % 9000), "</p>")), F.when(k % 6 == 2, "<form></form>"), F.when(k % 7 == 3, _page("<footer>Foot  ", _text(k), "</footer>"))]
    pages = dealt(_table(spark, sf, "customer").select("c_custkey", "c_nationkey")).select(F.col("c_nationkey").alias("site"), k.alias("place"), F.when(k % 5 == 0, 404).otherwise(200).alias("status"), url.alias("url"), _page("<html>", *said).alias("html"))
    return html.merge_site(html.site_pages(pages), "site", "place", "status")


@query(
    "name_gates",
    "SELECT p_partkey AS id, regexp_matches(lower(p_name), 'stack overflow|wikipedia|reddit|github|medium|tutorial|guide|what is|how to|documentation|docs|error|syntax|property|api|c#|typescript|python|php') AS noise, p_partkey % 5 NOT IN (1, 2, 3, 4) AS business FROM part",
)
def name_gates(spark: SparkSession, sf: str) -> DataFrame:
    """Names that are noise, and lines that may be names: digits, an address, a rating and a heading of the page are none."""
    k = F.col("p_partkey")
    line = F.when(k % 5 == 1, _text(k)).when(k % 5 == 2, _page(_text(k % 1000 + 1), " Main St")).when(k % 5 == 3, "4.5 (12 reviews)").when(k % 5 == 4, "Open now").otherwise(_page("Firm ", _text(k)))
    return dealt(_table(spark, sf, "part").select("p_partkey", "p_name")).select(k.alias("id"), websites.noise_name(F.col("p_name")).alias("noise"), html.extract(html.business_name, "boolean", line).alias("business"))


# Raw tables, seeds, counts ------------------------------------------------------------------------------------------


@query(
    "run_scan",
    "SELECT o_custkey AS source_id, count(*) AS n, max(o_orderdate) AS last FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
)
def run_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows appended run by run and in two batches; one run read back."""
    path = scratch_path(spark, "raw")
    o = _table(spark, sf, "orders").select(F.col("o_orderstatus").alias("run_id"), F.col("o_custkey").alias("source_id"), "o_orderdate", "o_orderkey")
    for half in (0, 1):
        readers.append_run(o.where(F.col("o_orderkey") % 2 == half), path)
    return readers.read_run(spark, path, "F").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last"))


@query(
    "seed_scan",
    "WITH t AS (SELECT * FROM part ORDER BY p_partkey LIMIT 150) SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'B' || p_partkey ELSE 'A' || p_partkey END AS parcel_id FROM t WHERE p_partkey % 5 > 0 OR p_partkey % 3 = 0",
)
def seed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The first 150 seeds, then without those whose id is blank in both of its columns."""
    k = F.col("p_partkey")
    rows = _table(spark, sf, "part").select("p_partkey", F.when(k % 3 == 0, " ").when(k % 5 == 0, "").otherwise(_page(" A", _text(k))).alias("parcel_id"), F.when(k % 3 == 0, _page("B", _text(k), " ")).alias("Parcel ID"))
    return runs.seed_targets(rows, "p_partkey", 150)


@query(
    "run_tallies",
    "SELECT o_orderstatus AS run_id, count(*) FILTER (o_orderkey % 3 = 0) AS inserted, count(*) FILTER (o_orderkey % 3 = 1) AS skipped, count(*) FILTER (o_orderkey % 3 = 2) AS failed, "
    "coalesce(max(CASE WHEN o_orderkey % 3 = 1 THEN round((o_custkey % 40) / 100.0, 4) END), 0.0)::DOUBLE AS worst_failure_rate, count(*) FILTER (o_orderkey % 7 < 4) AS with_website FROM orders GROUP BY 1",
)
def run_tallies(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes counted, the worst failure rate of a run's sources, and raw records with a website in any of four places."""
    k = F.col("o_orderkey")
    outcome = F.when(k % 3 == 0, "inserted").when(k % 3 == 1, "skipped").otherwise("failed")
    site = F.lit("a.com")
    rows = _table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("run_id"), outcome.alias("outcome"), F.when(k % 3 == 1, F.round((F.col("o_custkey") % 40) / F.lit(100.0), 4)).alias("source_failure_rate"),
        F.struct(F.when(k % 7 == 0, site).otherwise("").alias("raw_website")).alias("raw"), F.struct(F.when(k % 7 == 1, site).alias("raw_website")).alias("extracted"), F.when(k % 7 == 2, site).alias("raw_website"), F.when(k % 7 == 3, site).otherwise("  ").alias("website"),
    )
    return runs.tallies(rows.withColumn("has_website", runs.has_website(F.col("raw.raw_website"), F.col("extracted.raw_website"), F.col("raw_website"), F.col("website"))))


@query("active_pairs", "SELECT sum(CASE n_nationkey % 2 WHEN 0 THEN 12 ELSE 4 END)::BIGINT AS pairs FROM nation")
def active_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Number of pairs of a market and an industry that would be queried."""
    pack = F.when(F.col("n_nationkey") % 2 == 0, "home_services").otherwise("car_dealerships")
    markets = _table(spark, sf, "nation").select(F.col("n_name").alias("market_slug"), F.lit("TN").alias("state"), F.col("n_name").alias("city"), F.col("n_name").alias("market"), F.lit(1).alias("population_rank"), F.lit(True).alias("enabled"), pack.alias("default_pack"), *[F.lit(None).cast("string").alias(c) for c in ("source_profile", "region", "tier")])
    return targets.build_targets(markets, presets.packs(spark), presets.profiles(spark)).agg(F.count(F.lit(1)).alias("pairs"))


@query(
    "ingested_lines",
    "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_id * 3 END AS records, CASE WHEN event_id % 4 = 0 THEN 'run' || event_id END AS run_id FROM events",
)
def ingested_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that end an ingestion, among others."""
    k = F.col("event_id")
    line = F.when(k % 4 == 0, _page("INGESTION COMPLETE — ", _text(k * 3), " raw records (run_id=run", _text(k), ")")).when(k % 4 == 1, "INGESTION COMPLETE").otherwise("noise")
    return _table(spark, sf, "events").select("event_id", readers.ingested(line).alias("i")).select("event_id", "i.records", filled(F.col("i.run_id")).alias("run_id"))
