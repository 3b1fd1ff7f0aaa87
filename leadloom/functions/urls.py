"""URL and domain columns. The six domain rules differ on purpose; each belongs to one stage of the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.binding import filled, once

NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
#: Query keys of redirect wrappers, in the order in which they are tried.
REDIRECT_KEYS = ("url", "u", "dest", "destination", "redirect")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space (any, as Unicode has it) at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def netloc(url: Column) -> Column:
    """What stands between ``//`` and the path; empty where there is none."""
    return F.regexp_extract(url, NETLOC, 1)


def hostname(url: Column) -> Column:
    """Lower-case host without user and port; null where there is none."""
    return filled(F.lower(F.regexp_extract(netloc(url), r"^(?:.*@)?([^:]*)", 1)))


def _replace_first(c: Column, what: str) -> Column:
    at = F.instr(c, what)
    return F.when(at > 0, F.concat(F.substring(c, F.lit(1), at - 1), F.substring(c, at + len(what), F.length(c)))).otherwise(c)


def domain_resolver(url: Column) -> Column:
    """Host for entity resolution: a scheme is added unless the text begins with "http"; every "www." goes."""
    full = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://"), url))
    return F.when(url != "", F.replace(hostname(full), F.lit("www."), F.lit("")))


def domain_discovery(url: Column) -> Column:
    """Network location for website discovery: only a bare domain gets a scheme; the first "www." goes, a port stays."""
    full = lambda u: F.when(u.contains("/"), u).otherwise(F.concat(F.lit("https://"), u))
    return once(strip(url), lambda u: F.when(u != "", once(strip(F.lower(netloc(full(u)))), lambda d: filled(_replace_first(d, "www.")))))


def domain_expansion(url: Column) -> Column:
    """Host for company expansion: a scheme is added where "://" is missing; a leading "www." goes."""
    full = lambda u: F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u))
    return once(strip(url), lambda u: F.when(u != "", filled(F.regexp_replace(hostname(full(u)), r"^www\.", ""))))


def domain_bing(url: Column) -> Column:
    return F.lower(netloc(url))


def domain_brave(url: Column) -> Column:
    return netloc(url)


def domain_ddg(url: Column) -> Column:
    return F.replace(netloc(url), F.lit("www."), F.lit(""))


def _decoded(c: Column) -> Column:
    return once(c, lambda v: F.coalesce(F.try_url_decode(v), v))


def unwrap_redirect(url: Column) -> Column:
    """Target of a redirect wrapper (the first of REDIRECT_KEYS, decoded twice), else the URL itself."""
    given = lambda query: F.coalesce(*[filled(_decoded(F.regexp_extract(query, rf"(?:^|&){k}=([^&]*)", 1))) for k in REDIRECT_KEYS])
    target = lambda u: once(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), lambda query: F.when(query != "", given(query)))
    return once(strip(url), lambda u: F.coalesce(_decoded(F.replace(target(u), F.lit("+"), F.lit("%2B"))), u))


def tidy_url(unwrapped: Column) -> Column:
    """An unwrapped URL without fragment, with a scheme where it is protocol-relative or a bare domain; blank is null."""
    bare = lambda u: ~u.contains("://") & u.contains(".") & ~u.contains(" ")
    full = lambda u: F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(bare(u), F.concat(F.lit("https://"), u)).otherwise(u)
    return once(F.regexp_replace(unwrapped, "#.*$", ""), lambda u: F.when(u != "", full(u)))


def clean_urls(df: DataFrame, url: str, into: str) -> DataFrame:
    """Adds the unwrapped and tidied ``url``."""
    return df.withColumn(into, unwrap_redirect(F.col(url))).withColumn(into, tidy_url(F.col(into)))


def with_scheme(url: Column) -> Column:
    return once(strip(url), lambda u: F.when(u != "", F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u))))


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def listing_url(source_id: Column, base: str = "https://www.yellowpages.com") -> Column:
    """Address of a directory listing whose id is a path."""
    return F.when(source_id.startswith("/"), F.concat(F.lit(base), source_id))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
