"""Search results: which are businesses, and which is a company's own site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.binding import any_of, once, together
from leadloom.functions.similarity import overlap_words, token_overlap, words_overlap
from leadloom.functions.urls import domain_bing, domain_expansion, path_of, with_scheme

# Word lists that define the results.
BLOCKED_DOMAINS = (
    "stackoverflow.com", "reddit.com", "github.com", "medium.com", "wikipedia.org", "bing.com", "microsoft.com", "youtube.com", "facebook.com", "linkedin.com",
)
BLOCKED_PHRASES = ("what is", "how to", "difference", "guide", "tutorial", "stack overflow")
BUSINESS_HINTS = (
    "llc", "inc", "company", "services", "group", "management", "contractor", "electric", "plumbing", "roofing", "real estate", "insurance",
)
FREE_MAIL = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com")
SOCIAL_SUFFIXES = (
    "facebook.com", "m.facebook.com", "linkedin.com", "instagram.com", "twitter.com", "x.com", "yelp.com", "yellowpages.com", "mapquest.com", "bing.com", "google.com",
)
PATH_HINTS = ("/contact", "/about", "/services", "/team", "/our-team")
TITLE_HINTS = ("facebook", "linkedin", "instagram", "twitter", "x.com", "yelp", "yellow pages", "mapquest", "directory", "listing")
NOISE = (
    "stack overflow", "wikipedia", "reddit", "github", "medium", "tutorial", "guide", "what is", "how to", "documentation", "docs", "error", "syntax", "property", "api", "c#",
    "typescript", "python", "php",
)


def noise_name(name: Column) -> Column:
    return F.lower(name).rlike(any_of(NOISE))


def business_result(title: Column, url: Column, snippet: Column) -> Column:
    """Whether a search result looks like a business: no blocked site or phrase, and a hint or a bare site address."""
    known = lambda c: F.coalesce(c, F.lit(""))
    bare = lambda r: r["domain"].contains(".") & known(path_of(r["url"])).rlike(r"\A/*\z")
    blocked = lambda r: r["domain"].rlike(any_of(BLOCKED_DOMAINS)) | r["title"].rlike(any_of(BLOCKED_PHRASES))
    hinted = lambda r: F.concat_ws(" ", r["title"], r["snippet"], r["domain"]).rlike(any_of(BUSINESS_HINTS))
    values = {"title": known(F.lower(title)), "snippet": known(F.lower(snippet)), "domain": known(domain_bing(url)), "url": url}
    return together(values, lambda r: (r["domain"] != "") & ~blocked(r) & (hinted(r) | bare(r)))


def domain_score(domain: Column) -> Column:
    """-999 for none or a mail provider, -50 for a social or listing site, else by the number of labels. The suffix is a
    plain one: "netflix.com" ends with "x.com"."""
    of_labels = lambda d: once(F.size(F.split(d, r"\.")), lambda n: F.when(n <= 2, 30).when(n == 3, 15).otherwise(5))
    scored = lambda d: F.when(d.isin(*FREE_MAIL), -999).when(d.rlike(rf"(?:{any_of(SOCIAL_SUFFIXES)})\z"), -50).otherwise(of_labels(d))
    return once(domain, lambda d: F.when(F.coalesce(d, F.lit("")) == "", -999).otherwise(scored(d)))


def score_candidates(candidates: DataFrame) -> DataFrame:
    """Adds domain, website and score to candidate sites (url, title, canonical_name): what the domain, the title's words and the path
    are worth. Each value is worked out once in a row; a column name_words, if there, has the name's words already."""
    overlap = words_overlap(F.col("name_words"), F.col("title")) if "name_words" in candidates.columns else token_overlap(F.col("canonical_name"), F.col("title"))
    values = {"domain": domain_expansion(F.col("url")), "website": with_scheme(F.col("url")), "title": F.lower(F.trim(F.coalesce("title", F.lit(""))))}
    of_title = lambda r: F.when(r["title"].rlike(any_of(TITLE_HINTS)), -20).otherwise(0) + F.floor(overlap / 4).cast("int")
    of_path = lambda p: F.when(p.isin("", "/"), 12).when(p.rlike(rf"\A(?:{any_of(PATH_HINTS)})"), 4).otherwise(-3)
    path = lambda r: F.lower(F.trim(path_of(r["website"])))
    score = lambda r: F.when(r["domain"].isNull(), -999).otherwise(domain_score(r["domain"]) + F.when(r["title"] != "", of_title(r)).otherwise(0) + once(path(r), of_path))
    scored = together(values, lambda r: F.struct(r["domain"].alias("domain"), r["website"].alias("website"), score(r).alias("score")))
    out = candidates.withColumn("_scored", scored)
    return out.withColumns({c: F.col(f"_scored.{c}") for c in ("domain", "website", "score")}).drop("_scored")


def pick_websites(candidates: DataFrame, key: str = "company_id") -> DataFrame:
    """The best candidate (url, title, canonical_name, ord) of each key: website, domain, score and confidence. Equal scores
    go to the first; a score of -999 never wins. A partial aggregation by key, so hot keys are combined before the shuffle."""
    # No filter before the aggregation: it would be pushed below the columns and repeat their expressions.
    scored = score_candidates(candidates)
    rank = F.when(F.col("domain").isNotNull() & (F.col("score") > -999), F.struct("score", -F.col("ord")))
    best = scored.groupBy(key).agg(F.max_by(F.struct("website", "domain", F.col("score").alias("best_score")), rank).alias("b"))
    best = best.where("b is not null").select(key, "b.*")
    s = F.col("best_score")
    return best.select(key, "website", "domain", "best_score", F.when(s >= 55, 0.9).when(s >= 40, 0.8).when(s >= 25, 0.65).otherwise(0.5).alias("confidence"))


def search_query(name: Column, county: Column) -> Column:
    """Text of a search for a company and its place."""
    place = F.when(F.coalesce(county, F.lit("")) != "", F.concat(county, F.lit(", TN"))).otherwise("Tennessee")
    return F.concat_ws(" ", name, place)


def expand_companies(companies: DataFrame, candidates: DataFrame, contacts: DataFrame) -> DataFrame:
    """Website and contact fields for each company (company_id, canonical_name): the best of its search results (company_id, url, title, source,
    ord), then what was found on that site (website, phone, email, contact_form_url)."""
    of_company = companies.select("company_id", overlap_words(F.col("canonical_name")).alias("name_words"))
    named = candidates.join(of_company, "company_id")
    picked = pick_websites(named)
    sources = candidates.groupBy("company_id").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    out = companies.join(picked, "company_id", "left").join(sources, "company_id", "left").join(contacts, "website", "left")
    return out.select("company_id", "canonical_name", "website", "domain", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "phone", "email", "contact_form_url", "sources")
