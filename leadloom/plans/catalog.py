"""Queries by name over the driver's tables, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.functions import nested, similarity, urls
from leadloom.functions import text as T
from leadloom.operators import dedupe, html, records, resolve, runs, scoring, targets, upsert, websites
from leadloom.plans import relations as R
from leadloom.sources import readers
from leadloom.sources.scratch import dealt, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def _rel(sql: str, *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: R.relation(spark, sf, sql, *tables)


companies, datasets, leads = _rel(R.COMPANIES, "customer"), _rel(R.DATASETS, "nation"), _rel(R.LEADS, "orders")
raw, serp, markets = _rel(R.RAW, "lineitem"), _rel(R.SERP, "lineitem"), _rel(R.MARKETS, "nation", "region")
page_urls, redirects, error_lines = _rel(R.URLS, "pages"), _rel(R.REDIRECTS, "pages"), _rel(R.ERRORS, "events")

C = "WITH companies AS (" + R.for_oracle(R.COMPANIES, "customer") + ")"
CD = C + ", datasets AS (" + R.for_oracle(R.DATASETS, "nation") + ")"
CDL = CD + ", leads AS (" + R.for_oracle(R.LEADS, "orders") + ")"
U = "WITH urls AS (" + R.for_oracle(R.URLS, "pages") + ")"
RAW = "WITH raw AS (" + R.for_oracle(R.RAW, "lineitem") + ")"
SERP = "WITH serp AS (" + R.for_oracle(R.SERP, "lineitem") + ")"
MARKETS = "WITH markets AS (" + R.for_oracle(R.MARKETS, "nation", "region") + ")"

# SQL fragments ---------------------------------------------------------------------------------


def sql_netloc(u: str) -> str:
    return f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"


def sql_host(u: str) -> str:
    return f"nullif(lower(regexp_extract({sql_netloc(u)}, '^(?:.*@)?([^:]*)', 1)), '')"


def sql_resolver_domain(u: str) -> str:
    full = f"(CASE WHEN {u} LIKE 'http%' THEN {u} ELSE 'https://' || {u} END)"
    return f"CASE WHEN {u} <> '' THEN replace({sql_host(full)}, 'www.', '') END"


def sql_expansion_domain(u: str) -> str:
    full = f"(CASE WHEN trim({u}) LIKE '%://%' THEN trim({u}) ELSE 'https://' || trim({u}) END)"
    return f"CASE WHEN trim({u}) <> '' THEN nullif(regexp_replace({sql_host(full)}, '^www\\.', ''), '') END"


def sql_discovery_domain(u: str) -> str:
    full = f"(CASE WHEN trim({u}) LIKE '%/%' THEN trim({u}) ELSE 'https://' || trim({u}) END)"
    return f"CASE WHEN trim({u}) <> '' THEN nullif(regexp_replace(trim(lower({sql_netloc(full)})), 'www\\.', ''), '') END"


def sql_resolver_name(n: str) -> str:
    out = f"lower({n})"
    for s in (" llc", " inc", " ltd", " co", " corporation", " company"):
        out = f"replace({out}, '{s}', '')"
    return f"CASE WHEN {n} <> '' THEN trim({out}) END"


def sql_canonical_name(n: str) -> str:
    words = "\\b(llc|inc|corp|corporation|co|company|ltd|lp|llp|pllc|trust)\\b"
    return f"coalesce(trim(regexp_replace(regexp_replace(regexp_replace(lower(trim({n})), '[^a-z0-9\\s]', ' ', 'g'), '{words}', ' ', 'g'), '\\s+', ' ', 'g')), '')"


def sql_lax_phone(p: str) -> str:
    return f"nullif(regexp_replace(regexp_extract({p}, '\\+?1?\\D*(\\d{{3}})\\D*(\\d{{3}})\\D*(\\d{{4}})', 0), '^\\+?1?\\D*(\\d{{3}})\\D*(\\d{{3}})\\D*(\\d{{4}})$', '\\1\\2\\3'), '')"


def sql_md5_key(name: str, street: str, zip_code: str) -> str:
    return f"md5({name} || '|' || {street} || '|' || {zip_code})"


# Domains and URLs -----------------------------------------------------------------------------


def _urls_query(name: str, f: Callable[[Column], Column], expression: str) -> None:
    query(name, f"{U} SELECT page_id, {expression} AS domain FROM urls")(lambda spark, sf: page_urls(spark, sf).select("page_id", f(F.col("url")).alias("domain")))


_urls_query("norm_domain_resolver", urls.domain_resolver, sql_resolver_domain("url"))
_urls_query("norm_domain_discovery", urls.domain_discovery, sql_discovery_domain("url"))
_urls_query("norm_domain_expansion", urls.domain_expansion, sql_expansion_domain("url"))
_urls_query("norm_domain_bing", urls.domain_bing, f"lower({sql_netloc('url')})")
_urls_query("norm_domain_brave", urls.domain_brave, sql_netloc("url"))
_urls_query("norm_domain_ddg", urls.domain_ddg, f"replace({sql_netloc('url')}, 'www.', '')")

_QUERY = "regexp_extract(u, '^[^?#]*\\?([^#]*)', 1)"
_DECODED = "coalesce(" + ", ".join(f"nullif(url_decode(replace(regexp_extract(q, '(?:^|&){k}=([^&]*)', 1), '+', ' ')), '')" for k in urls.REDIRECT_KEYS) + ")"


@query(
    "redirect_unwrap",
    "WITH r AS (" + R.for_oracle(R.REDIRECTS, "pages") + f"), s AS (SELECT page_id, trim(url) AS u FROM r), t AS (SELECT *, {_QUERY} AS q FROM s), "
    f"v AS (SELECT *, coalesce(url_decode({_DECODED}), u) AS unwrapped FROM t), w AS (SELECT *, regexp_replace(unwrapped, '#.*$', '') AS cut FROM v), "
    "x AS (SELECT *, CASE WHEN cut LIKE '//%' THEN 'https:' || cut ELSE cut END AS full_url FROM w) "
    "SELECT page_id, unwrapped, CASE WHEN u <> '' THEN CASE WHEN full_url NOT LIKE '%://%' AND full_url LIKE '%.%' AND full_url NOT LIKE '% %' THEN 'https://' || full_url ELSE full_url END END AS clean FROM x",
)
def redirect_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    unwrapped = redirects(spark, sf).select("page_id", urls.unwrap_redirect(F.col("url")).alias("unwrapped"))
    return unwrapped.withColumn("clean", urls.tidy_url(F.col("unwrapped")))


@query(
    "website_discovery",
    f"{C}, d AS (SELECT id, CASE WHEN trim(website) <> '' THEN CASE WHEN website LIKE '%://%' THEN website ELSE 'https://' || website END END AS url FROM companies), "
    f"e AS (SELECT id, url, {sql_discovery_domain('url')} AS domain FROM d) SELECT id, CASE WHEN domain IS NOT NULL THEN url END AS website, domain, "
    "CASE WHEN domain IS NOT NULL THEN 'yp_card' ELSE 'none' END AS method, CASE WHEN domain IS NOT NULL THEN 0.8 ELSE 0.0 END::DOUBLE AS confidence FROM e",
)
def website_discovery(spark: SparkSession, sf: str) -> DataFrame:
    listed = companies(spark, sf).select("id", F.col("website").alias("raw_website"))
    return records.discovered_websites(listed).select("id", "website", "domain", "method", "confidence")


# Names, phones, addresses ------------------------------------------------------------------------

_US = "'(\\+?1[\\s\\-\\.]?)?(\\(?\\d{3}\\)?)[\\s\\-\\.]?(\\d{3})[\\s\\-\\.]?(\\d{4})'"
_US_DIGITS = f"regexp_replace(regexp_extract(phone_primary, {_US}, 0), '\\D', '', 'g')"


@query(
    "norm_phones",
    f"{C}, d AS (SELECT id, phone_primary, regexp_replace(phone_primary, '\\D', '', 'g') AS digits, {_US_DIGITS} AS us FROM companies), "
    "e AS (SELECT *, CASE WHEN length(us) = 11 AND us LIKE '1%' THEN substr(us, 2) ELSE us END AS ten FROM d) "
    f"SELECT id, {sql_lax_phone('phone_primary')} AS lax, CASE WHEN length(digits) >= 10 THEN digits END AS resolver, CASE WHEN length(ten) = 10 THEN ten END AS expansion, nullif(ten, '') AS site FROM e",
)
def norm_phones(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("phone_primary")
    return companies(spark, sf).select(
        "id", T.phone_lax(p).alias("lax"), T.phone_resolver(p).alias("resolver"), T.phone_expansion(p).alias("expansion"), T.phone_site(p).alias("site")
    )


@query("emails_in_text", f"SELECT doc_id, regexp_extract_all(text, '{T.EMAIL}') AS emails, nullif(lower(regexp_extract(text, '{T.EMAIL}', 0)), '') AS first_email FROM documents")
def emails_in_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", T.emails(F.col("text")).alias("emails"), T.first_email(F.col("text")).alias("first_email"))


@query(
    "norm_names",
    f"{C} SELECT id, {sql_resolver_name('canonical_name')} AS resolver, {sql_canonical_name('canonical_name')} AS canonical, "
    "trim(regexp_replace(regexp_replace(lower(canonical_name), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS bbb, trim(regexp_replace(canonical_name, '\\s+', ' ', 'g')) AS squished FROM companies",
)
def norm_names(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("canonical_name")
    return companies(spark, sf).select(
        "id", T.name_resolver(n).alias("resolver"), T.name_canonical(n).alias("canonical"), T.name_bbb(n).alias("bbb"), T.squish(n).alias("squished")
    )


@query(
    "slugify",
    "SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(p_name || '-' || p_brand)), '[ _,]', '-', 'g'), '[^a-z0-9\\-]', '', 'g'), '-{2,}', '-', 'g'), '^-|-$', '', 'g') AS slug FROM part",
)
def slugify(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", T.slug(F.col("p_name"), F.col("p_brand")).alias("slug"))


_PARTS = "list_filter(list_transform(regexp_split_to_array(raw, ',|\\n'), lambda x: trim(x)), lambda x: x <> '')"


@query(
    "address_parse",
    f"{C}, d AS (SELECT id, trim(coalesce(raw_address, '')) AS raw FROM companies), e AS (SELECT *, {_PARTS} AS parts FROM d) "
    "SELECT id, nullif(raw, '') AS mailing_address, parts[1] AS mailing_street, parts[2] AS mailing_city, nullif(regexp_extract(upper(raw), '\\b([A-Z]{2})\\b', 1), '') AS mailing_state, "
    "nullif(regexp_extract(raw, '\\b(\\d{5})(?:-\\d{4})?\\b', 1), '') AS mailing_zip, coalesce(nullif(regexp_extract(coalesce(parts[3], ''), '\\b(\\d{5}(?:-\\d{4})?)\\b', 1), ''), "
    "nullif(regexp_extract(raw, '\\b(\\d{5}(?:-\\d{4})?)\\b', 1), '')) AS line_zip FROM e",
)
def address_parse(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("raw_address")
    return companies(spark, sf).select("id", T.address(a).alias("a"), T.address_lines(a).alias("l")).select("id", "a.*", F.col("l.zip").alias("line_zip"))


_KEY_NAME = f"coalesce(nullif({sql_resolver_name('canonical_name')}, ''), 'unknown')"
_RESOLVER_KEY = f"coalesce(nullif({sql_resolver_domain('site')}, ''), {sql_md5_key(_KEY_NAME, "lower(coalesce(mailing_street, ''))", "coalesce(mailing_zip, '')")})"
_LOADER_HASH = sql_md5_key("lower(trim(coalesce(nullif(canonical_name, ''), 'unknown')))", "lower(trim(coalesce(mailing_street, '')))", "trim(coalesce(mailing_zip, ''))")


@query(
    "dedupe_keys",
    f"{C}, d AS (SELECT *, coalesce(nullif(website, ''), domain) AS site FROM companies) SELECT id, {_RESOLVER_KEY} AS resolver_key, "
    f"coalesce(nullif(lower(trim(coalesce(nullif(domain, ''), nullif(website, ''), ''))), ''), {_LOADER_HASH}) AS loader_key FROM d",
)
def dedupe_keys(spark: SparkSession, sf: str) -> DataFrame:
    w, d, n, s, z = (F.col(c) for c in ("website", "domain", "canonical_name", "mailing_street", "mailing_zip"))
    return companies(spark, sf).select("id", similarity.resolver_key(w, d, n, s, z).alias("resolver_key"), similarity.loader_key(d, w, n, s, z).alias("loader_key"))


@query(
    "industry_class",
    f"{C} SELECT id, CASE WHEN lower(canonical_name) LIKE '%hoa%' OR lower(canonical_name) LIKE '%property%' OR lower(canonical_name) LIKE '%pm %' OR lower(canonical_name) LIKE '%pm, %' "
    "THEN 'property_management' ELSE 'unknown' END AS industry_type, CASE WHEN lower(canonical_name) LIKE '%hoa%' THEN 'hoa_management' END AS sub_industry FROM companies",
)
def industry_class(spark: SparkSession, sf: str) -> DataFrame:
    return companies(spark, sf).select("id", records.industry(F.col("canonical_name")).alias("i")).select("id", "i.*")


@query(
    "code_desc_split",
    "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS code, CASE WHEN p_partkey % 2 = 0 THEN p_type || ' - x' ELSE p_type END AS description, "
    "CASE WHEN p_partkey % 3 = 0 THEN 1234567 + p_size ELSE p_size END::BIGINT AS amount FROM part",
)
def code_desc_split(spark: SparkSession, sf: str) -> DataFrame:
    part = spark.read.parquet(f"{sf}/part.parquet")
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_brand", F.lit("  - "), "p_type", F.lit(" - x"))).otherwise(F.col("p_type"))
    amount = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("$ "), F.format_number(F.col("p_size") + 1234567, 0), F.lit(".00"))).otherwise(F.concat(F.lit("about "), F.col("p_size")))
    return part.select("p_partkey", T.code_desc(text).alias("c"), T.money(amount).alias("amount")).select("p_partkey", "c.code", F.col("c.desc").alias("description"), "amount")


# Likeness -------------------------------------------------------------------------------------

_LCS = (
    "list_last(list_reduce(list_prepend(list_transform(range(len(y) + 1), lambda i: 0), list_transform(range(1, len(x) + 1), lambda i: [ascii(x[i])])), "
    "lambda p, c: list_reduce(list_prepend([0], list_transform(range(1, len(y) + 1), lambda j: [CASE WHEN ascii(y[j]) = c[1] THEN p[j] + 1 ELSE -1 END, p[j + 1]])), "
    "lambda acc, v: list_append(acc, CASE WHEN v[1] >= 0 THEN v[1] ELSE greatest(v[2], list_last(acc)) END))))"
)
_SORTED = "array_to_string(list_sort(list_filter(regexp_split_to_array({}, '\\s+'), lambda t: t <> '')), ' ')"


@query(
    "token_sort_ratio",
    "WITH pairs AS (SELECT a.p_partkey, a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1), "
    f"s AS (SELECT p_partkey, {_SORTED.format('a')} AS x, {_SORTED.format('b')} AS y FROM pairs) SELECT p_partkey, 200.0 * {_LCS} / (length(x) + length(y)) AS ratio FROM s",
)
def token_sort_ratio(spark: SparkSession, sf: str) -> DataFrame:
    part = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_name")
    b = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("b"))
    return part.join(b, "p_partkey").select("p_partkey", similarity.token_sort_ratio(F.col("p_name"), F.col("b")).alias("ratio"))


_TOKENS = "list_distinct(list_filter(string_split({}, ' '), lambda t: t <> ''))"


@query(
    "token_overlap",
    f"{SERP}, s AS (SELECT company_id, ord, title, {_TOKENS.format(sql_canonical_name('title'))} AS x, {_TOKENS.format(sql_canonical_name('canonical_name'))} AS y FROM serp) "
    "SELECT company_id, ord, title, CASE WHEN len(list_intersect(x, y)) > 0 THEN round_even(100.0 * len(list_intersect(x, y)) / least(len(x), len(y)), 0)::INT ELSE 0 END AS overlap FROM s",
)
def token_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return serp(spark, sf).select("company_id", "ord", "title", similarity.token_overlap(F.col("canonical_name"), F.col("title")).alias("overlap"))


_HAVERSINE = "2 * 6371 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2)))"


@query("haversine", f"{C} SELECT a.id, round({_HAVERSINE}, 6) AS km FROM companies a JOIN companies b ON b.id = a.id + 1")
def haversine(spark: SparkSession, sf: str) -> DataFrame:
    a = companies(spark, sf).select("id", "lat", "lng")
    b = a.select((F.col("id") - 1).alias("id"), F.col("lat").alias("lat2"), F.col("lng").alias("lng2"))
    return a.join(b, "id").select("id", F.round(similarity.haversine_km(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2")), 6).alias("km"))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    c = companies(spark, sf)
    return c.select(
        F.col("id").alias("ord"), F.col("canonical_name").alias("raw_company_name"), F.col("phone_primary").alias("raw_phone"), F.col("website").alias("raw_website"),
        "mailing_street", "mailing_city", "mailing_state", "mailing_zip", F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng"),
    )


_PREPARED = (
    f"{C}, p AS (SELECT id AS ord, {sql_resolver_name('canonical_name')} AS name, CASE WHEN length(regexp_replace(phone_primary, '\\D', '', 'g')) >= 10 THEN regexp_replace(phone_primary, '\\D', '', 'g') END AS phone, "
    f"{sql_resolver_domain('website')} AS domain, mailing_zip, lat, lng FROM companies)"
)


@query(
    "entity_pairs",
    f"{_PREPARED}, q AS (SELECT a.ord AS a_ord, b.ord AS b_ord, a.name AS an, b.name AS bn, coalesce(a.domain = b.domain, false) AS same_domain, coalesce(a.phone = b.phone, false) AS same_phone, "
    f"coalesce(a.mailing_zip = b.mailing_zip, false) AS same_zip, {_HAVERSINE} AS km FROM p a JOIN p b ON a.ord < b.ord AND (a.domain = b.domain OR a.phone = b.phone)), "
    f"s AS (SELECT *, {_SORTED.format('an')} AS x, {_SORTED.format('bn')} AS y FROM q), r AS (SELECT *, 200.0 * {_LCS} / (length(x) + length(y)) AS ratio FROM s) "
    "SELECT a_ord, b_ord, round(ratio, 6) AS name_score, (same_domain AND ratio < 60) OR (same_phone AND km > 5) AS veto, "
    "(CASE WHEN ratio >= 85 THEN 30 ELSE 0 END + CASE WHEN same_domain THEN 35 ELSE 0 END + CASE WHEN same_phone THEN 30 ELSE 0 END + CASE WHEN same_zip THEN 10 ELSE 0 END)::INT AS score FROM r",
)
def entity_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.candidate_pairs(_records(spark, sf), digits=6, km=False)


@query("resolve_entities")
def resolve_entities(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve_entities(_records(spark, sf))


# Scores -----------------------------------------------------------------------------------------

_S1 = (
    "(CASE WHEN website <> '' THEN 15 ELSE 0 END + CASE WHEN contact_form_url <> '' THEN 20 ELSE 0 END + CASE WHEN try_cast(website_status AS INT) BETWEEN 200 AND 399 THEN 10 ELSE 0 END "
    "+ CASE WHEN google_reviews_count >= 50 THEN 20 WHEN google_reviews_count >= 10 THEN 10 WHEN google_reviews_count > 0 THEN 5 ELSE 0 END "
    "+ CASE WHEN google_reviews_rating >= 4.5 THEN 10 WHEN google_reviews_rating >= 4.0 THEN 6 ELSE 0 END + CASE WHEN facebook_url <> '' THEN 10 ELSE 0 END)::INT"
)


@query(
    "signals_v1",
    f"{C}, s AS (SELECT *, {_S1} AS score FROM companies) SELECT id, score, CASE WHEN score >= 80 THEN 'high' WHEN score >= 50 THEN 'medium' ELSE 'low' END AS tier, coalesce(website <> '', false) AS has_website, "
    "list_filter([CASE WHEN website <> '' THEN 'Website present' END, CASE WHEN contact_form_url <> '' THEN 'Website has a contact form' END, "
    "CASE WHEN try_cast(website_status AS INT) BETWEEN 200 AND 399 THEN 'Website responds successfully' END, CASE WHEN google_reviews_count >= 50 THEN 'Strong Google review volume (50+)' "
    "WHEN google_reviews_count >= 10 THEN 'Moderate Google review volume (10+)' WHEN google_reviews_count > 0 THEN 'Some Google reviews present' END, "
    "CASE WHEN google_reviews_rating >= 4.5 THEN 'Excellent Google rating (4.5+)' WHEN google_reviews_rating >= 4.0 THEN 'Good Google rating (4.0+)' END, "
    "CASE WHEN facebook_url <> '' THEN 'Active Facebook presence' END], lambda x: x IS NOT NULL) AS explanation FROM s",
)
def signals_v1(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.behavioral_signals(companies(spark, sf))
    return scored.select("id", "lead_quality.score", "lead_quality.tier", "behavioral_signals.website.has_website", "lead_quality.explanation")


SIGNALS = (
    "SELECT id, phone_primary, email_primary, CAST(NULL AS STRING) AS mailing_address, mailing_street, website, lat, CASE WHEN id % 13 = 0 THEN NULL ELSE lng END AS lng, website_status AS status_code, id % 3 = 0 AS has_form, "
    "CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(id % 200 AS STRING) END AS days, CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' ELSE CAST(id % 11 AS STRING) END AS velocity, "
    "CASE WHEN id % 6 = 0 THEN NULL ELSE (id % 11) / 10.0 END AS hours, facebook_url, CASE WHEN id % 5 = 0 THEN 'ig' END AS instagram_url, id % 7 = 0 AS posts, CASE WHEN id % 4 = 1 THEN NULL ELSE id % 14 END AS age FROM {companies}"
)


_UP = "coalesce(try_cast(status_code AS INT) BETWEEN 200 AND 399, false)"
_V = "try_cast(velocity AS INT)"
_D = "try_cast(days AS INT)"


@query(
    "lead_score_v2",
    f"{C}, s AS ({SIGNALS.format(companies='companies')}), f AS (SELECT id, CASE WHEN {_UP} AND has_form THEN 25 ELSE 0 END AS website, "
    f"CASE WHEN NOT {_UP} OR {_D} IS NULL THEN 0 WHEN {_D} <= 30 THEN 15 WHEN {_D} <= 90 THEN 10 WHEN {_D} <= 180 THEN 5 ELSE 0 END AS freshness, "
    "CASE WHEN age IS NULL THEN 0 WHEN age >= 10 THEN 10 WHEN age >= 5 THEN 7 WHEN age >= 2 THEN 4 ELSE 2 END AS domain_age, "
    f"CASE WHEN {_V} >= 8 THEN 20 WHEN {_V} >= 4 THEN 15 WHEN {_V} >= 1 THEN 8 ELSE 0 END AS velocity_points, CASE WHEN hours >= 0.9 THEN 10 WHEN hours >= 0.6 THEN 6 WHEN hours > 0 THEN 3 ELSE 0 END AS hours_points, "
    "CASE WHEN facebook_url <> '' THEN 4 ELSE 0 END + CASE WHEN instagram_url <> '' THEN 4 ELSE 0 END + CASE WHEN posts THEN 2 ELSE 0 END AS social, "
    "CASE WHEN phone_primary <> '' THEN 2 ELSE 0 END + CASE WHEN email_primary <> '' THEN 2 ELSE 0 END + CASE WHEN mailing_street <> '' THEN 2 ELSE 0 END + CASE WHEN website <> '' THEN 2 ELSE 0 END "
    f"+ CASE WHEN lat IS NOT NULL AND lng IS NOT NULL THEN 2 ELSE 0 END AS completeness, CASE WHEN status_code IS NOT NULL AND NOT {_UP} THEN 1 ELSE 0 END + CASE WHEN {_V} = 0 THEN 1 ELSE 0 END AS negatives FROM s), "
    "g AS (SELECT *, website + freshness + domain_age + velocity_points + hours_points + social + completeness AS score FROM f) SELECT id, score::INT AS score, "
    "CASE WHEN score >= 75 THEN 'high' WHEN score >= 50 THEN 'medium' ELSE 'low' END AS tier, completeness::INT AS completeness, (domain_age + velocity_points)::INT AS authority, "
    "(website + social + freshness)::INT AS engagement, negatives::INT AS negatives, CASE WHEN website > 0 OR freshness > 0 THEN CASE WHEN velocity_points > 0 THEN 'Derived from google_places + website' ELSE 'Derived from website' END "
    "WHEN velocity_points > 0 THEN 'Derived from google_places' END AS summary FROM g",
)
def lead_score_v2(spark: SparkSession, sf: str) -> DataFrame:
    s = spark.sql(SIGNALS, companies=companies(spark, sf))
    signals = F.struct(
        F.struct("status_code", F.col("has_form").alias("has_contact_form"), F.col("days").alias("last_modified_days")).alias("website"),
        F.struct(F.col("velocity").alias("review_velocity_90d")).alias("google"),
        F.struct(F.col("hours").alias("hours_completeness")).alias("profile"),
        F.struct("facebook_url", "instagram_url", F.col("posts").alias("gmb_posts_detected")).alias("social"),
        F.struct(F.col("age").alias("age_years")).alias("domain"),
    )
    scored = scoring.score_leads(s.withColumn("behavioral_signals", signals))
    return scored.select(
        "id", "lead_quality.score", "lead_quality.tier", F.col("data_completeness_score").alias("completeness"), F.col("authority_score").alias("authority"),
        F.col("engagement_score").alias("engagement"), F.size("lead_quality.breakdown.negative").alias("negatives"), "lead_quality.attribution.summary",
    )


@query(
    "scored_businesses",
    f"{C}, d AS (SELECT id, canonical_name, website AS site, mailing_street AS given_street, {sql_lax_phone('phone_primary')} AS lax, phone_primary, trim(coalesce(raw_address, '')) AS raw, lat, lng FROM companies), "
    f"e AS (SELECT *, {_PARTS} AS parts FROM d), f AS (SELECT *, parts[1] AS mailing_street, nullif(regexp_extract(raw, '\\b(\\d{{5}})(?:-\\d{{4}})?\\b', 1), '') AS mailing_zip, coalesce(lax, phone_primary) AS phone FROM e), "
    f"g AS (SELECT *, {_RESOLVER_KEY} AS dedupe_key FROM f), h AS (SELECT *, row_number() OVER (PARTITION BY dedupe_key ORDER BY id) AS n FROM g) SELECT dedupe_key, id, canonical_name, "
    "(CASE WHEN phone <> '' THEN 2 ELSE 0 END + CASE WHEN raw <> '' THEN 2 ELSE 0 END + CASE WHEN site <> '' THEN 2 ELSE 0 END + CASE WHEN lat IS NOT NULL THEN 2 ELSE 0 END)::INT AS score, 'low' AS tier FROM h WHERE n = 1",
)
def scored_businesses(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: raw records normalised, keyed, deduplicated and scored."""
    c = companies(spark, sf)
    rows = c.select("id", F.col("canonical_name").alias("raw_company_name"), F.col("website").alias("raw_website"), F.col("phone_primary").alias("raw_phone"), "raw_address", "lat", "lng")
    unique = dedupe.first_wins(records.keyed(records.normalize(rows)), ["dedupe_key"], ["id"])
    entities = unique.select(
        "dedupe_key", "id", F.col("raw_company_name").alias("canonical_name"), F.col("raw_phone").alias("phone_primary"), F.col("raw_website").alias("website"), "mailing_address", "mailing_street", "lat", "lng",
        F.struct(F.struct(F.lit(None).cast("string").alias("status_code")).alias("website")).alias("behavioral_signals"),
    )
    return scoring.score_leads(entities).select("dedupe_key", "id", "canonical_name", "lead_quality.score", "lead_quality.tier")


# Search results -----------------------------------------------------------------------------------

_T, _DOM, _SN = "lower(coalesce(title, ''))", f"lower(coalesce({sql_netloc('url')}, ''))", "lower(coalesce(snippet, ''))"


def _sql_any(hay: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({hay}, '{w}')" for w in words) + ")"


_PATH = "regexp_extract({}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_BUSINESS = (
    f"({_DOM} <> '' AND NOT {_sql_any(_DOM, websites.BLOCKED_DOMAINS)} AND NOT {_sql_any(_T, websites.BLOCKED_PHRASES)} AND ({_sql_any(f"({_T} || ' ' || {_SN} || ' ' || {_DOM})", websites.BUSINESS_HINTS)} "
    f"OR (contains({_DOM}, '.') AND trim({_PATH.format('url')}, '/') = '')))"
)


@query(
    "serp_rank",
    f"{SERP}, k AS (SELECT * FROM serp WHERE {_BUSINESS}), r AS (SELECT company_id, ord, url, title, row_number() OVER (PARTITION BY company_id ORDER BY ord, url, title NULLS FIRST) AS rank FROM k) SELECT company_id, ord, url, title, rank::INT AS rank FROM r WHERE rank <= 3",
)
def serp_rank(spark: SparkSession, sf: str) -> DataFrame:
    keep = websites.business_result(F.col("title"), F.col("url"), F.col("snippet"))
    return dedupe.rank_kept(serp(spark, sf), ["company_id"], ["ord", "url", "title"], keep, cap=3).select("company_id", "ord", "url", "title", "rank")


_ED = "ed"
_DSCORE = (
    "CASE WHEN ed IN ("
    + ", ".join(f"'{d}'" for d in websites.FREE_MAIL)
    + ") THEN -999 WHEN "
    + " OR ".join(f"ed LIKE '%{s}'" for s in websites.SOCIAL_SUFFIXES)
    + " THEN -50 WHEN len(string_split(ed, '.')) <= 2 THEN 30 WHEN len(string_split(ed, '.')) = 3 THEN 15 ELSE 5 END"
)
_OVERLAP = "CASE WHEN len(list_intersect(x, y)) > 0 THEN round_even(100.0 * len(list_intersect(x, y)) / least(len(x), len(y)), 0)::INT ELSE 0 END"
_FULL = "CASE WHEN url LIKE '%://%' THEN url ELSE 'https://' || url END"


@query(
    "website_pick",
    f"{SERP}, s AS (SELECT DISTINCT company_id, ord, url, title, {sql_expansion_domain('url')} AS ed, {_FULL} AS full_url, {_TOKENS.format(sql_canonical_name('title'))} AS x, {_TOKENS.format(sql_canonical_name('canonical_name'))} AS y FROM serp), "
    f"t AS (SELECT *, lower({_PATH.format('full_url')}) AS path, lower(coalesce(title, '')) AS t FROM s WHERE ed IS NOT NULL), "
    f"u AS (SELECT *, {_DSCORE} + CASE WHEN t <> '' THEN CASE WHEN {_sql_any('t', websites.TITLE_HINTS)} THEN -20 ELSE 0 END + ({_OVERLAP}) // 4 ELSE 0 END "
    "+ CASE WHEN path IN ('', '/') THEN 12 WHEN " + " OR ".join(f"path LIKE '{p}%'" for p in websites.PATH_HINTS) + " THEN 4 ELSE -3 END AS score FROM t), "
    "v AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY score DESC, ord) AS n FROM u WHERE score > -999) "
    "SELECT company_id, full_url AS website, ed AS domain, score::INT AS best_score, CASE WHEN score >= 55 THEN 0.9 WHEN score >= 40 THEN 0.8 WHEN score >= 25 THEN 0.65 ELSE 0.5 END::DOUBLE AS confidence FROM v WHERE n = 1",
)
def website_pick(spark: SparkSession, sf: str) -> DataFrame:
    return websites.pick_websites(serp(spark, sf))


# Dedupe and merge ---------------------------------------------------------------------------------

_ORDER = ", ".join(R.RAW_ORDER)


@query(
    "dedupe_first_wins",
    f"{RAW}, r AS (SELECT *, row_number() OVER (PARTITION BY source, source_id, market, query ORDER BY {_ORDER}) AS n FROM raw) SELECT source, source_id, market, query, l_orderkey, l_linenumber, l_extendedprice FROM r WHERE n = 1",
)
def dedupe_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    best = dedupe.first_wins(raw(spark, sf), ["source", "source_id", "market", "query"], R.RAW_ORDER)
    return best.select("source", "source_id", "market", "query", "l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "dedupe_last_wins",
    f"{RAW}, r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY {', '.join(c + ' DESC' for c in R.RAW_ORDER)}) AS n, min(l_shipdate) OVER (PARTITION BY source_id) AS place FROM raw) "
    "SELECT source_id, l_orderkey, l_linenumber, l_extendedprice, place FROM r WHERE n = 1",
)
def dedupe_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.last_wins(raw(spark, sf), ["source_id"], R.RAW_ORDER, place="place").select("source_id", "l_orderkey", "l_linenumber", "l_extendedprice", "place")


@query(
    "distinct_in_order",
    f"{C} SELECT arg_min(canonical_name, id) AS canonical_name, min(id) AS id FROM companies GROUP BY lower(trim(canonical_name))",
)
def distinct_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.ordered_distinct(companies(spark, sf), "canonical_name", "id", fold_case=True)


_BATCH = (
    "SELECT id, coalesce(domain, 'key' || CAST(id % 50 AS STRING)) AS dedupe_key, canonical_name, phone_primary, email_primary, CASE WHEN id % 3 = 0 THEN '{{}}' WHEN id % 3 = 1 THEN '{{\"a\": ' || CAST(id AS STRING) || '}}' END AS lead_quality, "
    "CASE WHEN id % 4 > 0 THEN id % 4000 END AS first_seen, CASE WHEN id % 7 = 0 THEN NULL ELSE dataset_id END AS dataset_id FROM {companies}"
)


def _folded(where: str) -> str:
    last = lambda c: f"arg_max({c}, id) FILTER ({c} IS NOT NULL) AS {c}"
    return (
        f"SELECT dedupe_key, {', '.join(map(last, ('canonical_name', 'phone_primary', 'email_primary', 'dataset_id')))}, arg_min(first_seen, id) FILTER (first_seen IS NOT NULL) AS first_seen, "
        "coalesce(arg_max(lead_quality, id) FILTER (lead_quality <> '{}'), arg_max(lead_quality, id) FILTER (lead_quality IS NOT NULL)) AS lead_quality, "
        f"list_sort(list_distinct(list(canonical_name) FILTER (canonical_name IS NOT NULL))) AS alias_names FROM batch WHERE {where} GROUP BY dedupe_key"
    )


@query(
    "upsert_companies",
    f"{C}, batch AS ({_BATCH.format(companies='companies')}), o AS ({_folded('id % 2 = 0')}), n AS ({_folded('id % 2 = 1')}) SELECT coalesce(n.dedupe_key, o.dedupe_key) AS dedupe_key, "
    + ", ".join(f"coalesce(n.{c}, o.{c}) AS {c}" for c in ("canonical_name", "phone_primary", "email_primary", "dataset_id"))
    + ", coalesce(o.first_seen, n.first_seen) AS first_seen, CASE WHEN n.lead_quality IS NULL OR (n.lead_quality = '{}' AND o.lead_quality IS NOT NULL) THEN o.lead_quality ELSE n.lead_quality END AS lead_quality, "
    "CASE WHEN n.alias_names IS NULL THEN o.alias_names WHEN o.alias_names IS NULL THEN n.alias_names ELSE list_sort(list_distinct(o.alias_names || n.alias_names)) END AS alias_names FROM n FULL JOIN o ON n.dedupe_key = o.dedupe_key",
)
def upsert_companies(spark: SparkSession, sf: str) -> DataFrame:
    batch = spark.sql(_BATCH, companies=companies(spark, sf)).withColumn("alias_names", F.array("canonical_name"))
    old = upsert.fold(batch.where("id % 2 = 0"), ["dedupe_key"], "id", upsert.COMPANY_RULES)
    return upsert.upsert_companies(old, batch.where("id % 2 = 1"), "id")


@query(
    "upsert_replace",
    "WITH o AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 1 AS created FROM customer WHERE c_custkey % 3 < 2), n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS name, c_acctbal * 2 AS balance, 2 AS created FROM customer WHERE c_custkey % 3 > 0) "
    "SELECT coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.name ELSE o.name END AS name, CASE WHEN n.id IS NOT NULL THEN n.balance ELSE o.balance END AS balance, coalesce(o.created, n.created) AS created FROM n FULL JOIN o ON n.id = o.id",
)
def upsert_replace(spark: SparkSession, sf: str) -> DataFrame:
    c = spark.read.parquet(f"{sf}/customer.parquet")
    old = c.where("c_custkey % 3 < 2").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "1 AS created")
    new = c.where("c_custkey % 3 > 0").selectExpr("c_custkey AS id", "CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS name", "c_acctbal * 2 AS balance", "2 AS created")
    return upsert.replace_by_key(old, new, ["id"], keep=("created",))


@query(
    "upsert_checkpoint",
    "WITH o AS (SELECT n_nationkey AS id, n_name FROM nation WHERE n_nationkey % 3 < 2), n AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'completed' ELSE 'started' END AS status FROM nation WHERE n_nationkey % 3 > 0) "
    "SELECT 'run' || coalesce(n.id, o.id) AS run_id, 'etl' AS stage_key, coalesce(n.status, 'started') AS status, CASE WHEN o.id IS NULL THEN 2 ELSE 1 END AS started_at, CASE WHEN n.status = 'completed' THEN 2 END AS completed_at, "
    "CASE WHEN n.id IS NOT NULL THEN 2 ELSE 1 END AS updated_at, CASE WHEN o.id IS NULL THEN 'b=new' WHEN n.id IS NULL THEN 'a=' || n_name || ';b=old' ELSE 'a=' || n_name || ';b=new' END AS meta FROM n FULL JOIN o ON n.id = o.id",
)
def upsert_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    old = nation.where("n_nationkey % 3 < 2").selectExpr(
        "concat('run', n_nationkey) AS run_id", "'etl' AS stage_key", "'started' AS status", "1 AS started_at", "CAST(NULL AS INT) AS completed_at", "map('a', n_name, 'b', 'old') AS meta", "1 AS updated_at"
    )
    new = nation.where("n_nationkey % 3 > 0").selectExpr(
        "concat('run', n_nationkey) AS run_id", "'etl' AS stage_key", "CASE WHEN n_nationkey % 2 = 0 THEN 'completed' ELSE 'started' END AS status", "map('b', 'new') AS meta"
    )
    done = upsert.set_checkpoints(old, new, F.lit(2))
    entries = F.array_sort(F.transform(F.map_entries("meta"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return done.withColumn("meta", F.array_join(entries, ";"))


# Targets ------------------------------------------------------------------------------------------

PACKS = [("home_services", "Roofing", 0, True), ("home_services", " Plumbers ", 1, True), ("home_services", "Off", 2, False), ("home_services", " ", 3, True), ("light", "Roofing", 0, True), ("light", "Tree Service", 1, True)]
PROFILES = [("standard_city", True, True, 1, 3), ("metro_heavy", True, False, 2, 4)]
_MARKET_ORDER = "population_rank IS NULL, CASE WHEN coalesce(population_rank, 0) = 0 THEN 1000000000 ELSE population_rank END, market"


@query("market_filter_page", f"{MARKETS} SELECT market_slug, market, population_rank FROM (SELECT * FROM markets WHERE enabled AND lower(tier) = 'metro' ORDER BY {_MARKET_ORDER} LIMIT 9) ORDER BY {_MARKET_ORDER} LIMIT 3 OFFSET 3")
def market_filter_page(spark: SparkSession, sf: str) -> DataFrame:
    page = targets.filter_markets(markets(spark, sf), tier=" Metro", top_n=9, batch_index=1, batch_size=3)
    return page.select("market_slug", "market", "population_rank")


@query(
    "build_targets",
    f"{MARKETS}, packs(pack, industry, ord) AS (VALUES ('home_services', 'Roofing', 0), ('home_services', 'Plumbers', 1), ('light', 'Roofing', 0), ('light', 'Tree Service', 1)), "
    "profiles(profile, headless, max_pages, max_scrolls) AS (VALUES ('standard_city', true, 1, 3), ('metro_heavy', false, 2, 4)) "
    "SELECT market_slug, market, city, state, region, tier, population_rank, industry, pack AS industry_pack, headless, max_pages, max_scrolls FROM markets JOIN packs ON pack = coalesce(default_pack, 'home_services') JOIN profiles ON profile = source_profile "
    f"WHERE enabled ORDER BY {_MARKET_ORDER}, market_slug, ord LIMIT 20",
)
def build_targets(spark: SparkSession, sf: str) -> DataFrame:
    packs = spark.createDataFrame(PACKS, "pack string, query string, ord int, enabled boolean")
    profiles = spark.createDataFrame(PROFILES, "profile string, enabled boolean, headless boolean, max_pages int, max_scrolls int")
    return targets.build_targets(targets.filter_markets(markets(spark, sf)), packs, profiles, max_query_pairs=20)


# Runs ---------------------------------------------------------------------------------------------

_PREMIUM = "l.full_name IS NOT NULL AND l.email IS NOT NULL AND l.phone IS NOT NULL AND (c.mailing_street IS NOT NULL OR c.physical_address IS NOT NULL OR (c.mailing_city IS NOT NULL AND c.mailing_state IS NOT NULL AND c.mailing_zip IS NOT NULL))"
_SELLABLE = "lead_stage <> 'prospect' AND email IS NOT NULL AND syntax_valid AND mx_valid"


@query(
    "run_validation_counts",
    f"{CDL}, rc AS (SELECT c.* FROM companies c JOIN datasets d ON d.id = c.dataset_id WHERE d.id = 3), rl AS (SELECT l.* FROM leads l JOIN rc ON rc.id = l.company_id) "
    "SELECT 3 AS dataset_id, 'run_3' AS run_id, (SELECT record_count FROM datasets WHERE id = 3) AS dataset_record_count, (SELECT count(*) FROM rc) AS companies_in_run, (SELECT count(website) FROM rc) AS companies_with_website, (SELECT count(domain) FROM rc) AS companies_with_domain, "
    "(SELECT count(phone_primary) FROM rc) AS companies_with_phone, (SELECT count(email_primary) FROM rc) AS companies_with_company_email, (SELECT count(contact_form_url) FROM rc) AS companies_with_contact_form, (SELECT count(*) FROM rl) AS leads_from_run_companies, "
    f"(SELECT count(*) FROM rl WHERE source = 'company_expansion') AS company_expansion_leads, (SELECT count(*) FROM rl WHERE {_SELLABLE}) AS sellable_leads_now, (SELECT count(*) FROM rl l JOIN rc c ON c.id = l.company_id WHERE {_PREMIUM}) AS premium_like_leads_now",
)
def run_validation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return runs.validation_counts(companies(spark, sf), datasets(spark, sf), leads(spark, sf), 3, "run_3")


@query("sellable_leads", f"{CDL} SELECT id, company_id, email FROM leads WHERE {_SELLABLE}")
def sellable_leads(spark: SparkSession, sf: str) -> DataFrame:
    return leads(spark, sf).where(runs.sellable(*(F.col(c) for c in ("lead_stage", "email", "syntax_valid", "mx_valid")))).select("id", "company_id", "email")


@query("premium_leads", f"{CDL} SELECT l.id, l.company_id FROM leads l JOIN companies c ON c.id = l.company_id WHERE {_PREMIUM}")
def premium_leads(spark: SparkSession, sf: str) -> DataFrame:
    place = [F.col(c).alias(f"c_{c}") for c in ("id", "mailing_street", "physical_address", "mailing_city", "mailing_state", "mailing_zip")]
    joined = leads(spark, sf).join(companies(spark, sf).select(*place), F.col("company_id") == F.col("c_id"))
    return joined.where(runs.premium("", "c_")).select("id", "company_id")


_MISSING = " OR ".join(f"{c} IS NULL" for c in runs.ENRICHED)


@query("company_candidates", f"{CD} SELECT c.id, canonical_name, domain, website, notes AS run_ref FROM companies c LEFT JOIN datasets d ON d.id = dataset_id WHERE notes ILIKE '%run_id=run_2%' AND ({_MISSING}) ORDER BY c.id LIMIT 50")
def company_candidates(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.company_candidates(companies(spark, sf), datasets(spark, sf).drop("run_id"), "run_2", limit=50)
    return found.select("id", "canonical_name", "domain", "website", "run_ref")


@query("lead_inspection", f"{CDL} SELECT l.id, company_id, full_name, canonical_name, c.domain, captured_at FROM leads l JOIN companies c ON c.id = company_id JOIN datasets d ON d.id = dataset_id WHERE d.id = 5 ORDER BY captured_at DESC NULLS LAST, l.id")
def lead_inspection(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.lead_inspection(leads(spark, sf), companies(spark, sf), datasets(spark, sf), 5)
    return found.select("id", "company_id", "full_name", "canonical_name", "domain", "captured_at")


_SRC = "lower(trim(coalesce(nullif(source, ''), 'unknown')))"
_QKEY = "CASE WHEN trim(coalesce(query, '')) <> '' AND trim(coalesce(market, '')) <> '' THEN trim(query) || '||' || trim(market) ELSE coalesce(nullif(trim(query), ''), nullif(trim(market), '')) END"


@query(
    "source_benchmarks",
    f"{RAW}, errs AS (" + R.for_oracle(R.ERRORS, "events") + f"), s AS (SELECT {_SRC} AS source, count(*) AS raw_records, count(*) FILTER (trim(coalesce(raw_website, '')) <> '') AS hits, count(DISTINCT {_QKEY}) AS good FROM raw GROUP BY 1), "
    "e AS (SELECT coalesce(nullif(lower(regexp_extract(trim(coalesce(error, '')), '^\\s*([A-Za-z0-9_]+)\\[', 1)), ''), 'unknown') AS source, count(*) AS bad FROM errs GROUP BY 1), "
    "n AS (SELECT source FROM s UNION SELECT source FROM e UNION SELECT 'bbb'), j AS (SELECT n.source, coalesce(raw_records, 0) AS raw_records, coalesce(hits, 0) AS hits, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM n LEFT JOIN s USING (source) LEFT JOIN e USING (source)) "
    "SELECT source, raw_records, good AS successful_query_pairs, bad AS failed_query_pairs, good + bad AS total_query_pairs, CASE WHEN good + bad <= 0 THEN 0 ELSE round(bad / (good + bad), 4) END::DOUBLE AS source_failure_rate, 'raw-ingestion-only' AS attribution_mode, "
    "round(round(raw_records / greatest(1, good + bad), 6) * 100, 2) AS companies_found_per_100_queries, round(hits / greatest(1, raw_records), 4) AS websites_discovered_rate, NULL::DOUBLE AS named_contact_rate, NULL::DOUBLE AS sellable_email_rate, NULL::DOUBLE AS premium_contact_rate FROM j",
)
def source_benchmarks(spark: SparkSession, sf: str) -> DataFrame:
    named = spark.createDataFrame([(" BBB",), ("",)], "source string")
    return runs.source_benchmarks(raw(spark, sf), error_lines(spark, sf), named)


_METRICS = (
    "SELECT n_nationkey AS id, CASE n_nationkey % 4 WHEN 0 THEN 'failed' WHEN 1 THEN NULL ELSE 'Completed' END AS status, n_nationkey % 5 AS companies_seeded, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey END AS leads_inserted, "
    "n_nationkey % 2 AS sellable_leads_inserted, CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE n_nationkey / 40.0 END AS max_source_failure_rate FROM {nation}"
)


@query(
    "alerts",
    f"WITH m AS ({_METRICS.format(nation='nation')}), a AS (SELECT id, coalesce(max_source_failure_rate, 0) AS r, list_filter([CASE WHEN lower(coalesce(status, '')) <> 'completed' THEN 'run_failed' END, CASE WHEN coalesce(companies_seeded, 0) <= 0 THEN 'zero_inserted_companies' END, "
    "CASE WHEN coalesce(leads_inserted, 0) <= 0 THEN 'zero_inserted_contacts' END, CASE WHEN coalesce(sellable_leads_inserted, 0) <= 0 THEN 'zero_sellable_leads' END, CASE WHEN coalesce(max_source_failure_rate, 0) > 0.25 THEN 'abnormal_source_failure_rate' END], lambda x: x IS NOT NULL) AS keys FROM m) "
    "SELECT id, keys, len(keys) > 0 AS alert_triggered, round(r, 4)::DOUBLE AS source_failure_rate FROM a",
)
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    m = spark.sql(_METRICS, nation=spark.read.parquet(f"{sf}/nation.parquet")).withColumn("max_source_failure_rate", F.col("max_source_failure_rate").cast("double"))
    return runs.alerts(m).select("id", F.transform("alerts", lambda a: a["key"]).alias("keys"), "alert_triggered", "source_failure_rate")


_ATTEMPTS = "SELECT l_partkey AS parcel_id, CASE WHEN l_linenumber = 1 AND l_quantity > 45 THEN 'ok' ELSE 'failed' END AS status FROM {lineitem} WHERE l_quantity > 40"


@query(
    "remaining_seeds",
    f"WITH a AS ({_ATTEMPTS.format(lineitem='lineitem')}), t AS (SELECT parcel_id, count(*) AS n, bool_or(status = 'ok') AS done FROM a GROUP BY 1) SELECT p_partkey AS parcel_id, coalesce(n, 0) AS attempts FROM part LEFT JOIN t ON parcel_id = p_partkey WHERE NOT coalesce(done, false) AND coalesce(n, 0) < 6",
)
def remaining_seeds(spark: SparkSession, sf: str) -> DataFrame:
    attempts = spark.sql(_ATTEMPTS, lineitem=spark.read.parquet(f"{sf}/lineitem.parquet"))
    return runs.remaining_seeds(spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("parcel_id")), attempts, 6)


@query(
    "compliance_gate",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'disabled' WHEN s_suppkey % 3 = 0 THEN 'automation_not_permitted' WHEN s_suppkey % 5 = 0 THEN 'terms_prohibit' ELSE 'ok' END AS verdict FROM supplier",
)
def compliance_gate(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    verdict = runs.compliance_verdict(F.when(k % 2 > 0, True), k % 3 > 0, F.when(k % 5 == 0, True), F.lit(True))
    return spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", verdict.alias("verdict"))


@query("run_document", f"{RAW} SELECT 'r1' AS run_id, 'completed' AS status, (SELECT count(*) FROM raw) AS total, (SELECT array_to_string(list_sort(list(source || '=' || n)), ';') FROM (SELECT source, count(*) AS n FROM raw GROUP BY 1)) AS by_source, (SELECT count(error) FROM (" + R.for_oracle(R.ERRORS, "events") + "))::INT AS errors")
def run_document(spark: SparkSession, sf: str) -> DataFrame:
    doc = runs.run_document(raw(spark, sf), error_lines(spark, sf), "r1", F.lit(None).cast("timestamp"))
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("by_source"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return doc.select("run_id", "status", "total", shown.alias("by_source"), F.size("errors").alias("errors"))


@query("payload_documents", "SELECT event_id, props AS document FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id, unnest([props, '{\"x\": 1}']) FROM events WHERE event_id % 3 = 1")
def payload_documents(spark: SparkSession, sf: str) -> DataFrame:
    props = F.col("props")
    payload = F.when(F.col("event_id") % 3 == 0, props).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), props, F.lit(', {"x": 1}, 5]'))).otherwise("{}")
    found = runs.flatten_payloads(spark.read.parquet(f"{sf}/events.parquet").select("event_id", payload.alias("payload")))
    return found.select("event_id", F.regexp_replace("document", r'":\s*', '": ').alias("document"))


# Sources ------------------------------------------------------------------------------------------


@query(
    "geo_grid",
    f"WITH c AS (SELECT n_nationkey AS id, 30.0 + n_nationkey AS lat, -80.0 - n_nationkey AS lng FROM nation), g AS (SELECT unnest(range(-2, 3)) AS k) SELECT id, r.k AS grid_row, q.k AS grid_col, round(lat + r.k * {3.0 / 6371.0 * 180} / pi(), 6) AS point_lat, "
    f"round(lng + q.k * {3.0 / 6371.0 * 180} / pi() / cos(lat * pi() / 180), 6) AS point_lng FROM c, g r, g q",
)
def geo_grid(spark: SparkSession, sf: str) -> DataFrame:
    centres = spark.read.parquet(f"{sf}/nation.parquet").selectExpr("n_nationkey AS id", "CAST(30 + n_nationkey AS DOUBLE) AS lat", "CAST(-80 - n_nationkey AS DOUBLE) AS lng")
    grid = readers.geo_grid(centres)
    return grid.select("id", "grid_row", "grid_col", F.round("point_lat", 6).alias("point_lat"), F.round("point_lng", 6).alias("point_lng"))


_LOG = "SELECT user_id, event_id, CASE event_id % 3 WHEN 0 THEN 'applied: ' || CAST(event_id AS STRING) WHEN 1 THEN 'run_id: r' || CAST(event_id AS STRING) || ' ' ELSE 'noise ' || event_type END AS line FROM {events}"


@query(
    "log_kv_parse",
    f"WITH l AS ({_LOG.format(events='events')}), k AS (SELECT user_id, event_id, regexp_extract(line, '^([A-Za-z0-9_]+):\\s*(.+?)\\s*$', 1) AS key, regexp_extract(line, '^([A-Za-z0-9_]+):\\s*(.+?)\\s*$', 2) AS value FROM l) "
    "SELECT user_id, key, CASE WHEN key = 'run_id' THEN arg_min(value, event_id) ELSE arg_max(value, event_id) END AS value FROM k WHERE key <> '' GROUP BY user_id, key",
)
def log_kv_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = spark.sql(_LOG, events=spark.read.parquet(f"{sf}/events.parquet"))
    return readers.log_values(lines, ["user_id"], order="event_id")


# Pages --------------------------------------------------------------------------------------------


@query(
    "site_pages",
    "SELECT page_id, trim(regexp_replace(regexp_extract(replace(replace(replace(replace(html, '&amp;', '&'), '&lt;', '<'), '&copy;', '©'), '&middot;', '·'), '(?s)<footer>(.*?)</footer>', 1), '\\s+', ' ', 'g')) AS footer FROM pages",
)
def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    return html.site_pages(dealt(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html"))).select("page_id", "page.footer")


@query("site_contacts")
def site_contacts(spark: SparkSession, sf: str) -> DataFrame:
    pages = dealt(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")).withColumns({"site": urls.hostname(F.col("url")), "status": F.lit(200)})
    return html.merge_site(html.site_pages(pages), "site", "page_id", "status")


@query(
    "directory_records",
    "SELECT s_nationkey AS page, 'yellowpages' AS source, s_name AS raw_company_name, '(865) 555-' || (1000 + s_suppkey) AS raw_phone, '/mip/' || s_suppkey AS source_id, 'https://www.yellowpages.com/mip/' || s_suppkey AS detail_url FROM supplier",
)
def directory_records(spark: SparkSession, sf: str) -> DataFrame:
    """Result pages are put together from suppliers and read back."""
    k = F.col("s_suppkey").cast("string")
    card = F.concat(
        F.lit('<div class="result"><a class="business-name" href="/mip/'), k, F.lit('?lid=1"><span>'), F.col("s_name"), F.lit('</span></a><div class="phones">(865) 555-'), (F.col("s_suppkey") + 1000).cast("string"), F.lit("</div></div>")
    )
    pages = spark.read.parquet(f"{sf}/supplier.parquet").groupBy(F.col("s_nationkey").alias("page")).agg(F.array_join(F.collect_list(card), "").alias("html"))
    return html.directory_records(pages).select("page", "source", "raw_company_name", "raw_phone", "source_id", "detail_url")


# More of runs and sources --------------------------------------------------------------------------

_STAGES = (
    "SELECT s_suppkey AS run_no, CAST(s_suppkey % 7 AS STRING) AS applied, CASE WHEN s_suppkey % 3 = 0 THEN '0' WHEN s_suppkey % 3 = 1 THEN CAST(s_suppkey AS STRING) ELSE NULL END AS seeded, CAST(s_suppkey + 5 AS STRING) AS in_run, "
    "CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_suppkey % 4 - 1 AS STRING) END AS inserted, '9' AS reported, CASE WHEN s_suppkey % 5 = 0 THEN 'x' ELSE CAST(s_suppkey / 8.0 AS STRING) END AS elapsed FROM {supplier}"
)


@query(
    "metrics_payload",
    f"WITH s AS ({_STAGES.format(supplier='supplier')}) SELECT 'r' || run_no AS run_id, coalesce(nullif(try_cast(seeded AS BIGINT), 0), run_no + 5) AS companies_seeded, run_no % 7 AS companies_enriched, "
    "coalesce(try_cast(inserted AS BIGINT), 9) AS leads_inserted, 0::BIGINT AS contacts_found, round(coalesce(try_cast(elapsed AS DOUBLE), 0), 2) AS etl_elapsed_seconds FROM s",
)
def metrics_payload(spark: SparkSession, sf: str) -> DataFrame:
    s = spark.sql(_STAGES, supplier=spark.read.parquet(f"{sf}/supplier.parquet"))
    m = lambda *kv: F.map_filter(F.create_map(*[F.lit(x) if i % 2 == 0 else F.col(x) for i, x in enumerate(kv)]), lambda k, v: v.isNotNull())
    nothing = F.create_map().cast("map<string,string>")
    results = s.select(
        F.concat(F.lit("r"), F.col("run_no")).alias("run_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("dataset_id", "trigger", "status", "error_message")],
        nothing.alias("ingest"),
        m("canonical_companies_upserted_current_state", "seeded", "elapsed_seconds", "elapsed").alias("etl"),
        nothing.alias("expansion"),
        m("applied", "applied").alias("apply"),
        m("leads_inserted_this_execution", "inserted", "leads_inserted_reported", "reported").alias("contacts"),
        m("companies_in_run", "in_run").alias("validation"),
    )
    return runs.metrics_payload(results).select("run_id", "companies_seeded", "companies_enriched", "leads_inserted", "contacts_found", "etl_elapsed_seconds")


@query("company_id_list", "SELECT n_nationkey, [n_nationkey::BIGINT, 7] AS ids FROM nation")
def company_id_list(spark: SparkSession, sf: str) -> DataFrame:
    given = F.concat(F.lit(" "), F.col("n_nationkey").cast("string"), F.lit(">,, x, 7"))
    return spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey", runs.company_id_list(given).alias("ids"))


@query("finalize_datasets", f"{CD} SELECT d.id, coalesce((SELECT count(*) FROM companies c WHERE c.dataset_id = d.id AND c.id % 2 = 0 HAVING count(*) > 0), record_count)::INT AS record_count FROM datasets d")
def finalize_datasets(spark: SparkSession, sf: str) -> DataFrame:
    return runs.set_record_counts(datasets(spark, sf), companies(spark, sf).where("id % 2 = 0")).select("id", "record_count")


@query("finalize_datasets_all", f"{CD} SELECT d.id, coalesce((SELECT count(*) FROM companies c WHERE c.dataset_id = d.id HAVING count(*) > 0), record_count)::INT AS record_count FROM datasets d")
def finalize_datasets_all(spark: SparkSession, sf: str) -> DataFrame:
    return runs.set_record_counts(datasets(spark, sf), companies(spark, sf)).select("id", "record_count")


@query(
    "backfill_update",
    f"{C} SELECT id, CASE WHEN domain IN ('company1.com', 'company2.com') AND id % 2 = 0 THEN 'new' ELSE facebook_url END AS facebook_url FROM companies",
)
def backfill_update(spark: SparkSession, sf: str) -> DataFrame:
    c = companies(spark, sf)
    updates = c.where("id % 2 = 0").select("id", F.lit("new").alias("facebook_url"))
    return runs.backfill(c, updates, ["facebook_url"], ["company1.com", "company2.com"]).select("id", "facebook_url")


@query("archive_manifest", f"{RAW} SELECT 'yelp' AS run_id, count(*) AS matched, count(*) AS written, true AS complete FROM raw WHERE source = 'yelp'")
def archive_manifest(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw(spark, sf).select(F.col("source").alias("run_id"), "source_id", "query", "market")
    return readers.archive_run(rows, "yelp", scratch_path(spark, "archive"))


@query("purge_run", f"{RAW} SELECT source, count(*) AS n FROM raw WHERE source <> 'yelp' GROUP BY source")
def purge_run(spark: SparkSession, sf: str) -> DataFrame:
    kept = readers.purge_run(raw(spark, sf).withColumn("run_id", F.col("source")), "yelp")
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "retention_gate",
    f"{CD} SELECT id, NOT (id % 4 = 0) AND id % 3 > 0 AND id % 5 > 0 AND id % 7 > 0 AS archive FROM datasets",
)
def retention_gate(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("id")
    mode, status = F.when(k % 4 == 0, "keep").otherwise("archive-only"), F.when(k % 3 > 0, "completed")
    gate = runs.should_archive(mode, F.when(k % 5 > 0, "r").otherwise(""), F.lit("d"), status, k % 7 == 0)
    return datasets(spark, sf).select("id", gate.alias("archive"))


@query(
    "market_registry_rows",
    "SELECT n_nationkey AS population, lower(regexp_replace(n_name, '[ _]', '-', 'g')) || '-xx' AS market_slug, n_name || ', XX' AS market, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey // 2 END AS population_rank, n_nationkey % 3 > 0 AS enabled, 'home_services' AS default_pack FROM nation",
)
def market_registry_rows(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    rows = spark.read.parquet(f"{sf}/nation.parquet").select(
        F.concat(F.lit(" "), F.col("n_name")).alias("city"), F.lit("xx").alias("state"), k.cast("string").alias("population"), (k / 2).cast("string").alias("population_rank"),
        F.when(k % 3 == 0, "No").otherwise("").alias("enabled"),
    )
    rows = rows.withColumn("population_rank", F.regexp_replace("population_rank", r"\.0$", ""))
    return readers.market_registry(rows).select("population", "market_slug", "market", "population_rank", "enabled", "default_pack")


@query("parcel_rows", "SELECT 'anderson' AS county, c_name AS owner_name, CASE WHEN c_custkey % 3 > 0 THEN c_custkey || ' OAK ST' END AS property_address, c_custkey::VARCHAR AS parcel_id, NULL::VARCHAR AS lot FROM customer")
def parcel_rows(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    address = F.when(F.col("c_custkey") % 3 > 0, F.concat(k, F.lit(" OAK ST "))).otherwise(" ")
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_name").alias("Owner"), address.alias("Property Address"), k.alias("Parcel ID"))
    return readers.parcels(rows, "anderson", "r1").select("county", "owner_name", "property_address", "parcel_id", "lot")


@query("best_email", f"{C} SELECT id, coalesce(email_primary, nullif(website, ''), 'none') AS email FROM companies")
def best_email(spark: SparkSession, sf: str) -> DataFrame:
    return companies(spark, sf).select("id", T.best_email(F.col("email_primary"), F.col("website"), fallback=F.lit("none")).alias("email"))


@query("run_keys", f"{RAW} SELECT {_SRC} AS source, {_QKEY} AS query_key, count(*) AS n FROM raw GROUP BY 1, 2")
def run_keys(spark: SparkSession, sf: str) -> DataFrame:
    keyed = raw(spark, sf).select(runs.source_name(F.col("source")).alias("source"), runs.query_key(F.col("query"), F.col("market")).alias("query_key"))
    return keyed.groupBy("source", "query_key").agg(F.count(F.lit(1)).alias("n"))


@query("website_summaries", "SELECT page_id, 200 AS status, strlen(html)::INT AS html_bytes, html <> '' AS html_present FROM pages")
def website_summaries(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return pages.select("page_id", records.website_summary(F.col("html"), F.lit(200)).alias("w")).select("page_id", "w.*")


@query("company_expansion", f"{SERP}, c AS (SELECT DISTINCT company_id, canonical_name FROM serp) SELECT count(*) AS companies, count(DISTINCT company_id) AS ids FROM c")
def company_expansion(spark: SparkSession, sf: str) -> DataFrame:
    found = serp(spark, sf).drop("canonical_name").withColumn("source", F.lit("bing_serp"))
    named = serp(spark, sf).select("company_id", "canonical_name").distinct()
    contacts = spark.createDataFrame([("https://acme1.com", "1", "a@b.c", None)], "website string, phone string, email string, contact_form_url string")
    out = websites.expand_companies(named, found, contacts)
    return out.agg(F.count(F.lit(1)).alias("companies"), F.countDistinct("company_id").alias("ids"))


@query("nested_values", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, -1::BIGINT AS missing FROM events")
def nested_values(spark: SparkSession, sf: str) -> DataFrame:
    props = F.col("props")
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", nested.nested(props, "k", "bigint").alias("k"), nested.nested(props, "none", "bigint", -1).alias("missing"))


@query(
    "raw_source_ids",
    f"{C} SELECT id, lower(trim(coalesce(nullif(canonical_name, ''), 'unknown'))) || '|' || lower(trim(coalesce(phone_primary, ''))) || '|' || lower(trim(coalesce(mailing_city, ''))) AS source_id FROM companies",
)
def raw_source_ids(spark: SparkSession, sf: str) -> DataFrame:
    return companies(spark, sf).select("id", records.raw_source_id(*(F.col(c) for c in ("canonical_name", "phone_primary", "mailing_city"))).alias("source_id"))
