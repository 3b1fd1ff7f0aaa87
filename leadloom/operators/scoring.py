"""Lead scores with their reasons, as row expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.urls import blank_to_null


def reachable(status: Column) -> Column:
    """Whether a status (number, text, or null) is a success or a redirect."""
    code = status.cast("string").try_cast("int")
    return F.coalesce((code >= 200) & (code < 400), F.lit(False))


def ladder(value: Column, steps: list[tuple[Column, int, str | None]]) -> tuple[Column, Column]:
    """(points, reason) of the first condition that holds; 0 and null where none does."""
    points, reason = F.lit(0), F.lit(None).cast("string")
    for condition, n, text in reversed(steps):
        points = F.when(condition, n).otherwise(points)
        reason = F.when(condition, F.lit(text)).otherwise(reason)
    return F.when(value.isNull(), F.lit(0)).otherwise(points), F.when(value.isNotNull(), reason)


def _filled(c: Column) -> Column:
    return blank_to_null(c).isNotNull()


# The words of the reasons, which are part of the results.
def _factors(signal, entity) -> dict[str, tuple[Column, Column]]:
    up = reachable(signal("website.status_code"))
    form = up & F.coalesce(signal("website.has_contact_form").cast("boolean"), F.lit(False))
    days = F.when(up, signal("website.last_modified_days").cast("string").try_cast("int"))
    age = signal("domain.age_years").cast("string").try_cast("double")
    reviews = signal("google.review_velocity_90d").cast("string").try_cast("int")
    hours = signal("profile.hours_completeness").cast("string").try_cast("double")
    flag = lambda c: F.coalesce(signal(c).cast("boolean"), F.lit(False))
    social = (
        F.when(_filled(signal("social.facebook_url")), 4).otherwise(0)
        + F.when(_filled(signal("social.instagram_url")), 4).otherwise(0)
        + F.when(flag("social.gmb_posts_detected") | flag("google.has_recent_posts"), 2).otherwise(0)
    )
    address = _filled(entity("mailing_address")) | _filled(entity("mailing_street"))
    place = entity("lat").isNotNull() & entity("lng").isNotNull()
    contacts = [_filled(entity("phone_primary")), _filled(entity("email_primary")), address, _filled(entity("website")), place]
    complete = sum((F.when(c, 2).otherwise(0) for c in contacts[1:]), F.when(contacts[0], 2).otherwise(0))
    return {
        "website": ladder(form, [(form, 25, "Website has an active contact form.")]),
        "freshness": ladder(
            days,
            [
                (days <= 30, 15, "Website appears recently updated (within 30 days)."),
                (days <= 90, 10, "Website updated within the last 90 days."),
                (days <= 180, 5, "Website updated within the last 180 days."),
            ],
        ),
        "domain_age": ladder(
            age,
            [
                (age >= 10, 10, "Established domain history (10+ years)."),
                (age >= 5, 7, "Established domain history (5+ years)."),
                (age >= 2, 4, "Domain history suggests stability (2+ years)."),
                (F.lit(True), 2, "Newer domain history detected."),
            ],
        ),
        "google_velocity": ladder(
            reviews,
            [
                (reviews >= 8, 20, "Strong recent Google review velocity (last 90 days)."),
                (reviews >= 4, 15, "Consistent recent Google review activity (last 90 days)."),
                (reviews >= 1, 8, "Some recent Google review activity (last 90 days)."),
            ],
        ),
        "hours": ladder(
            hours,
            [
                (hours >= 0.9, 10, "Business hours are fully configured."),
                (hours >= 0.6, 6, "Business hours are mostly configured."),
                (hours > 0, 3, "Business hours are partially configured."),
            ],
        ),
        "social": (
            social,
            F.when(social >= 8, "Active presence on social platforms.").when(social >= 4, "Some social presence detected.").when(social >= 2, "Recent posting activity detected (social/GMB)."),
        ),
        "completeness": (complete, F.when(complete >= 8, "Multiple verified contact fields available.").when(complete >= 4, "Some verified contact fields available.")),
    }


#: Breakdown entries of factors that scored: group, key, label, sources.
BREAKDOWN = {
    "website": ("intent", "contact_form", "Website has an active contact form", ("website",)),
    "freshness": ("intent", "recent_updates", "Website recently updated", ("website",)),
    "domain_age": ("authority", "domain_age", "Established domain history", ("whois",)),
    "google_velocity": ("authority", "google_review_velocity", "Recent Google review activity", ("google_places",)),
    "hours": ("visibility_gaps", "hours_configured", "Business hours configured", ("google_places",)),
    "social": ("visibility_gaps", "social_presence", "Social presence detected", ("facebook", "instagram", "google_places")),
}
ATTRIBUTED = {"website": "website", "freshness": "website", "google_velocity": "google_places"}
MAX_REASONS = 12


def tier(score: Column, high: int, medium: int = 50) -> Column:
    return F.when(score >= high, "high").when(score >= medium, "medium").otherwise("low")


def _entry(key: str | Column, label: str | Column, impact: Column, sources: tuple[str, ...]) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    listed = F.array(*[F.lit(s) for s in sources]).cast("array<string>")
    return F.struct(lit(key).alias("key"), lit(label).alias("label"), impact.cast("int").alias("impact"), listed.alias("source"))


def score_leads(entities: DataFrame, signals: str = "behavioral_signals", sources: str | None = "enrichment_sources") -> DataFrame:
    """Adds lead_quality (score, tier, explanation, factors, breakdown, attribution), overall_lead_score and three part scores.

    ``signals`` is a struct column; fields that it lacks count as missing, as do numbers that cannot be read.
    """
    kinds = {f.name: f.dataType for f in entities.schema.fields}
    parts = {f.name: {g.name for g in f.dataType.fields} for f in kinds[signals].fields if hasattr(f.dataType, "fields")}

    def signal(path: str) -> Column:
        group, name = path.split(".")
        return F.col(f"{signals}.{path}") if name in parts.get(group, ()) else F.lit(None).cast("string")

    def entity(name: str) -> Column:
        return F.col(name) if name in kinds else F.lit(None).cast("string")

    factors = _factors(signal, entity)
    work = entities.withColumns({f"_p_{k}": p for k, (p, _) in factors.items()} | {f"_r_{k}": r for k, (_, r) in factors.items()})
    points = {k: F.col(f"_p_{k}") for k in factors}
    entries: dict[str, list[Column]] = {"intent": [], "authority": [], "visibility_gaps": []}
    for k, (group, key, label, srcs) in BREAKDOWN.items():
        entries[group].append(F.when(points[k] > 0, _entry(key, label, points[k], srcs)))
    status, velocity = signal("website.status_code"), signal("google.review_velocity_90d").cast("string").try_cast("int")
    negative = F.array_compact(
        F.array(
            F.when(status.isNotNull() & ~reachable(status), _entry("website_unreachable", "Website unreachable during crawl", F.lit(-5), ("website",))),
            F.when(velocity == 0, _entry("low_review_velocity", "No recent Google review activity", F.lit(-8), ("google_places",))),
        )
    )
    missing = signal("debug.missing_signals")
    if "missing_signals" in parts.get("debug", ()):
        named = F.transform(missing, lambda m: _entry("missing_signal", F.concat(F.lit("Missing signal: "), F.replace(m, F.lit("."), F.lit(" "))), F.lit(0), ()))
        negative = F.concat(negative, F.coalesce(named, F.array().cast("array<struct<key:string,label:string,impact:int,source:array<string>>>")))
    given = F.coalesce(F.col(sources), F.array().cast("array<string>")) if sources and sources in kinds else F.array().cast("array<string>")
    credited = F.array_compact(F.array(*[F.when(points[k] > 0, F.lit(s)) for k, s in ATTRIBUTED.items()]))
    attribution = F.array_sort(F.array_distinct(F.concat(given, credited)))
    score = F.least(F.greatest(sum(list(points.values())[1:], points["website"]), F.lit(0)), F.lit(100))
    quality = F.struct(
        F.lit("lq_v2").alias("version"),
        score.alias("score"),
        tier(score, 75).alias("tier"),
        F.slice(F.array_compact(F.array(*[F.col(f"_r_{k}") for k in factors])), 1, MAX_REASONS).alias("explanation"),
        F.struct(*[points[k].alias(k) for k in factors]).alias("factors"),
        F.struct(*[F.array_compact(F.array(*v)).alias(g) for g, v in entries.items()], negative.alias("negative")).alias("breakdown"),
        F.struct(
            F.when(F.size(attribution) > 0, F.concat(F.lit("Derived from "), F.array_join(attribution, " + "))).alias("summary"), attribution.alias("sources")
        ).alias("attribution"),
    )
    scored = work.withColumns(
        {
            "lead_quality": quality,
            "overall_lead_score": score,
            "data_completeness_score": points["completeness"],
            "authority_score": points["domain_age"] + points["google_velocity"],
            "engagement_score": points["website"] + points["social"] + points["freshness"],
        }
    )
    return scored.drop(*[f"_p_{k}" for k in factors], *[f"_r_{k}" for k in factors])


def behavioral_signals(companies: DataFrame) -> DataFrame:
    """Adds signals and quality of the first scoring version, from website, website_status, contact_form_url,
    google_reviews_count, google_reviews_rating and facebook_url. A status that is no whole number earns nothing."""
    has = lambda c: _filled(F.col(c))
    reviews, rating = F.coalesce("google_reviews_count", F.lit(0)), F.coalesce(F.col("google_reviews_rating").cast("double"), F.lit(0.0))
    status = F.col("website_status").cast("string").try_cast("int")
    rules = [
        (has("website"), 15, "Website present"),
        (has("contact_form_url"), 20, "Website has a contact form"),
        (F.coalesce((status >= 200) & (status < 400), F.lit(False)), 10, "Website responds successfully"),
        (reviews >= 50, 20, "Strong Google review volume (50+)"),
        ((reviews >= 10) & (reviews < 50), 10, "Moderate Google review volume (10+)"),
        ((reviews > 0) & (reviews < 10), 5, "Some Google reviews present"),
        (rating >= 4.5, 10, "Excellent Google rating (4.5+)"),
        ((rating >= 4.0) & (rating < 4.5), 6, "Good Google rating (4.0+)"),
        (has("facebook_url"), 10, "Active Facebook presence"),
    ]
    points = [F.when(c, n).otherwise(0) for c, n, _ in rules]
    score = F.least(F.greatest(sum(points[1:], points[0]), F.lit(0)), F.lit(100))
    signals = F.struct(
        F.lit("bs_v1").alias("version"),
        F.struct(has("website").alias("has_website"), F.col("website_status"), has("contact_form_url").alias("has_contact_form"), F.col("contact_form_url")).alias("website"),
        F.struct(reviews.alias("reviews_count"), rating.alias("rating")).alias("google"),
        F.struct(F.col("facebook_url"), has("facebook_url").alias("has_social")).alias("social"),
    )
    quality = F.struct(
        F.lit("lq_v1").alias("version"),
        score.alias("score"),
        tier(score, 80).alias("tier"),
        F.slice(F.array_compact(F.array(*[F.when(c, F.lit(text)) for c, _, text in rules])), 1, 8).alias("explanation"),
    )
    return companies.withColumns({"behavioral_signals": signals, "lead_quality": quality})
