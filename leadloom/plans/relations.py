"""Stand-ins for business relations on the driver's tables, as SQL that both Spark and DuckDB read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_S = "CAST({} AS STRING)"


def _s(x: str) -> str:
    return _S.format(x)


URLS = f"""
SELECT page_id, CASE page_id % 8
  WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN 'HTTPS://WWW.' || upper(regexp_extract(url, '//([^/]*)', 1)) || ':8080/A'
  WHEN 3 THEN 'www.www.site' || {_s('page_id')} || '.com' WHEN 4 THEN 'httpsite' || {_s('page_id')} || '.org'
  WHEN 5 THEN '  //cdn.example.com/x  ' WHEN 6 THEN '' ELSE 'http://user:pw@Host' || {_s('page_id')} || '.net:81?x=1' END AS url
FROM {{pages}}
"""

REDIRECTS = f"""
SELECT page_id, CASE page_id % 6
  WHEN 0 THEN 'https://r.example.com/go?x=1&u=https%3A%2F%2Fsite' || {_s('page_id')} || '.com%2Fa' WHEN 1 THEN 'https://r.example.com/?url=http%253A%252F%252Fdeep.com&u=no'
  WHEN 2 THEN '//cdn.example.com/a#frag' WHEN 3 THEN 'bare' || {_s('page_id')} || '.com' WHEN 4 THEN ' ' ELSE 'https://r.example.com/?redirect=a%2Bb.com' END AS url
FROM {{pages}}
"""

COMPANIES = f"""
SELECT c_custkey AS id, c_nationkey AS dataset_id,
  CASE c_custkey % 4 WHEN 0 THEN c_name || ' LLC' WHEN 1 THEN 'Acme  Company of ' || c_mktsegment || ', Inc.' WHEN 2 THEN 'Blue Collar HOA ' || {_s('c_custkey % 50')}
    ELSE 'Oak Property & Co #' || {_s('c_custkey % 30')} END AS canonical_name,
  CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'https://www.company' || {_s('c_custkey % 300')} || '.com/x' WHEN 2 THEN 'company' || {_s('c_custkey % 300')} || '.com'
    WHEN 3 THEN '' ELSE 'http://shop.company' || {_s('c_custkey')} || '.net:8080' END AS website,
  CASE WHEN c_custkey % 7 < 2 THEN NULL ELSE 'company' || {_s('c_custkey % 300')} || '.com' END AS domain,
  CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '+1 (865) 555-' || {_s('1000 + c_custkey % 500')} WHEN 2 THEN '865.555.' || {_s('1000 + c_custkey % 500')}
    WHEN 3 THEN '555-0101' WHEN 4 THEN '1865555' || {_s('1000 + c_custkey % 500')} ELSE 'call 865 555 ' || {_s('1000 + c_custkey % 500')} || ' now' END AS phone_primary,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'info' || {_s('c_custkey')} || '@company.com' END AS email_primary,
  CASE WHEN c_custkey % 9 = 0 THEN '/contact' END AS contact_form_url,
  CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN {_s('c_custkey')} || ' Main St, Knoxville, TN 37902' WHEN 2 THEN {_s('10000 + c_custkey')} || ' Pike Rd, Maryville , TN 37801-1234'
    WHEN 3 THEN ' Oak Ave ,, Nashville' ELSE '' END AS raw_address,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE {_s('c_custkey')} || ' Main St' END AS mailing_street,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'Knoxville' END AS mailing_city, 'TN' AS mailing_state,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE {_s('37000 + c_custkey % 40')} END AS mailing_zip,
  CASE WHEN c_custkey % 11 = 0 THEN 'somewhere' END AS physical_address,
  35.9 + (c_custkey % 100) / 1000.0 AS lat, -83.9 - (c_custkey % 77) / 1000.0 AS lng,
  CAST(c_custkey % 80 AS INT) AS google_reviews_count, CAST(3 + (c_custkey % 5) * 0.45 AS DOUBLE) AS google_reviews_rating,
  CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '404' WHEN 2 THEN 'failed' ELSE '200' END AS website_status,
  CASE WHEN c_custkey % 8 = 0 THEN 'fb.com/x' END AS facebook_url
FROM {{customer}}
"""

DATASETS = f"""
SELECT n_nationkey AS id, n_name AS name, 'run_' || {_s('n_nationkey % 7')} AS run_id, 'nightly run_id=run_' || {_s('n_nationkey % 7')} || ' ok' AS notes,
  CAST(n_nationkey * 10 AS INT) AS record_count FROM {{nation}}
"""

LEADS = f"""
SELECT o_orderkey AS id, o_custkey AS company_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Person ' || {_s('o_orderkey')} END AS full_name,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'p' || {_s('o_orderkey')} || '@mail.com' END AS email, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE '8655550100' END AS phone,
  CASE o_orderkey % 3 WHEN 0 THEN 'company_expansion' ELSE 'web' END AS source, CASE o_orderstatus WHEN 'P' THEN 'prospect' WHEN 'F' THEN 'contact' ELSE NULL END AS lead_stage,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 7 < 5 END AS syntax_valid, CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE o_orderkey % 5 < 4 END AS mx_valid,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS captured_at
FROM {{orders}}
"""

MARKETS = f"""
SELECT lower(replace(n_name, ' ', '-')) AS market_slug, upper(substr(r_name, 1, 2)) AS state, n_name AS city, n_name || ', ' || upper(substr(r_name, 1, 2)) AS market,
  CAST(CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE n_nationkey % 6 END AS INT) AS population_rank, n_nationkey % 9 <> 4 AS enabled,
  CASE n_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'light' ELSE 'home_services' END AS default_pack, CASE WHEN n_nationkey % 2 = 0 THEN 'standard_city' ELSE 'metro_heavy' END AS source_profile,
  r_name AS region, CASE n_nationkey % 2 WHEN 0 THEN 'metro' ELSE 'mid' END AS tier
FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey
"""

RAW = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax,
  CASE l_returnflag WHEN 'N' THEN 'YellowPages ' WHEN 'R' THEN 'yelp' ELSE '' END AS source, CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE 'roofing' || {_s('l_linenumber % 3')} END AS query,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 'Knoxville, TN ' || {_s('l_suppkey % 5')} END AS market, {_s('l_partkey % 50')} AS source_id,
  CASE WHEN l_partkey % 3 = 0 THEN ' ' WHEN l_partkey % 3 = 1 THEN NULL ELSE 'site.com' END AS raw_website
FROM {{lineitem}}
"""
#: A full order of RAW's rows: its key columns repeat.
RAW_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]

ERRORS = f"""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' YellowPages[knoxville]: timeout' WHEN 1 THEN 'enrichment[x]: 404' WHEN 2 THEN 'no source' ELSE NULL END AS error
FROM {{events}} WHERE event_type = 'error'
"""

SERP = f"""
SELECT l_orderkey AS company_id, 1000000 * l_linenumber + l_partkey AS ord,
  CASE l_partkey % 9 WHEN 0 THEN 'https://www.facebook.com/acme' WHEN 1 THEN 'acme' || {_s('l_suppkey % 20')} || '.com' WHEN 2 THEN 'https://www.acme' || {_s('l_suppkey % 20')} || '.com/about/us'
    WHEN 3 THEN 'https://shop.acme.co.uk/x' WHEN 4 THEN 'netflix.com/a' WHEN 5 THEN 'https://gmail.com' WHEN 6 THEN '' WHEN 7 THEN 'https://stackoverflow.com/q/1'
    ELSE 'http://a.b.c.acme.com/' END AS url,
  CASE l_suppkey % 6 WHEN 0 THEN 'Acme Roofing LLC' WHEN 1 THEN 'How to find roofing' WHEN 2 THEN NULL WHEN 3 THEN 'Acme | Yelp listing' WHEN 4 THEN 'Best widgets' ELSE 'ACME Plumbing & Roofing Company' END AS title,
  CASE WHEN l_linenumber % 2 = 0 THEN 'insurance group' ELSE '' END AS snippet, 'Acme Roofing ' || CASE WHEN l_orderkey % 2 = 0 THEN 'Experts' ELSE 'Inc' END AS canonical_name
FROM {{lineitem}} WHERE l_linenumber <= 7
"""


def relation(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def for_oracle(sql: str, *tables: str) -> str:
    return sql.format(**{t: t for t in tables})
