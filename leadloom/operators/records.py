"""Row-wise work on raw business records: normalising, classifying, building ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions import text as T
from leadloom.functions.binding import any_of, once, together
from leadloom.functions.similarity import resolver_key
from leadloom.functions.urls import blank_to_null, domain_discovery, tidy_url, unwrap_redirect

# Hosts that are no company's own site.
DIRECTORY_HOSTS = ("yellowpages.com", "yelp.com", "facebook.com", "linkedin.com", "mapquest.com", "bbb.org")


def normalize(records: DataFrame) -> DataFrame:
    """Adds mailing_address, street, city, state and zip, and puts the normalised phone in raw_phone where there is one."""
    parts = T.address(F.col("raw_address"))
    with_parts = records.withColumn("_address", parts)
    return with_parts.withColumns(
        {c: F.col(f"_address.{c}") for c in ("mailing_address", "mailing_street", "mailing_city", "mailing_state", "mailing_zip")}
        | {"raw_phone": F.coalesce(T.phone_lax(F.col("raw_phone")), F.col("raw_phone"))}
    ).drop("_address")


def industry(name: Column) -> Column:
    """Struct of industry_type and sub_industry, by what the name contains."""
    n = F.lower(F.coalesce(name, F.lit("")))
    hoa, managed = n.contains("hoa"), n.contains("property") | n.contains("pm ") | n.contains("pm, ")
    return F.struct(
        F.when(hoa | managed, "property_management").otherwise("unknown").alias("industry_type"), F.when(hoa, "hoa_management").alias("sub_industry")
    )


def raw_source_id(name: Column, phone: Column, city: Column) -> Column:
    tidy = lambda c, other: F.lower(F.trim(F.coalesce(blank_to_null(c), F.lit(other))))
    return F.concat_ws("|", tidy(name, "unknown"), tidy(phone, ""), tidy(city, ""))


def bad_domain(domain: Column) -> Column:
    """Whether a domain is missing or that of a directory or social site, subdomains included."""
    return once(domain, lambda d: d.isNull() | (d == "") | F.lower(F.trim(d)).rlike(rf"(?:^|\.)(?:{any_of(DIRECTORY_HOSTS)})\z"))


def _site(url: Column) -> Column:
    """Struct of url (unwrapped and tidied), domain, and whether that may be a company's own; each worked out once."""
    ok = lambda u: together({"url": u, "domain": domain_discovery(u)}, lambda s: F.struct(s["url"].alias("url"), s["domain"].alias("domain"), (~bad_domain(s["domain"])).alias("ok")))
    return once(once(unwrap_redirect(url), tidy_url), ok)


def discovered_websites(listings: DataFrame, raw_website: str = "raw_website", detail_website: str | None = None) -> DataFrame:
    """Adds website, domain, method and confidence: the card's link, else that of the landed detail page, else none."""
    detail = F.col(detail_website) if detail_website else None
    found = lambda site, method, confidence: F.struct(site["url"].alias("website"), site["domain"].alias("domain"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"))
    nothing = {"url": F.lit(None).cast("string"), "domain": F.lit(None).cast("string")}
    sites = {"card": _site(F.col(raw_website)), "detail": _site(detail)} if detail_website else {"card": _site(F.col(raw_website))}
    pick = lambda s: (F.when(s["card"]["ok"], found(s["card"], "yp_card", 0.8)).when(s["detail"]["ok"], found(s["detail"], "yp_detail", 0.7)) if detail_website else F.when(s["card"]["ok"], found(s["card"], "yp_card", 0.8))).otherwise(found(nothing, "none", 0.0))
    out = listings.withColumn("_found", together(sites, pick))
    return out.withColumns({c: F.col(f"_found.{c}") for c in ("website", "domain", "method", "confidence")}).drop("_found")


def website_summary(html: Column, status: Column) -> Column:
    """Struct of status, size in bytes and whether any page came."""
    return F.struct(status.alias("status"), F.octet_length(F.coalesce(html, F.lit(""))).alias("html_bytes"), (F.coalesce(html, F.lit("")) != "").alias("html_present"))


def keyed(records: DataFrame) -> DataFrame:
    """Adds dedupe_key, that of entity resolution, to normalised records."""
    key = resolver_key(F.col("raw_website"), F.lit(None).cast("string"), F.col("raw_company_name"), F.col("mailing_street"), F.col("mailing_zip"))
    return records.withColumn("dedupe_key", key)
