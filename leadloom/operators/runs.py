"""What a run did: counts, candidates, leads, benchmarks by source, alerts, resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import metric_int, safe_rate
from leadloom.functions.urls import blank_to_null, strip

ENRICHED = ("website", "domain", "phone_primary", "email_primary", "contact_form_url")


class ComplianceError(RuntimeError):
    """A source must not be collected automatically."""


def sellable(stage: Column, email: Column, syntax_valid: Column, mx_valid: Column) -> Column:
    """A lead past the prospect stage with a proven address; an unknown stage is none."""
    return F.coalesce((stage != "prospect") & email.isNotNull() & syntax_valid & mx_valid, F.lit(False))


def premium(lead_prefix: str, company_prefix: str) -> Column:
    """A named lead with e-mail and phone at a company with an address."""
    lead, company = (lambda c: F.col(f"{lead_prefix}{c}").isNotNull()), (lambda c: F.col(f"{company_prefix}{c}").isNotNull())
    place = company("mailing_street") | company("physical_address") | (company("mailing_city") & company("mailing_state") & company("mailing_zip"))
    return lead("full_name") & lead("email") & lead("phone") & place


def run_companies(companies: DataFrame, datasets: DataFrame, dataset_id) -> DataFrame:
    chosen = datasets.where(F.col("id") == dataset_id).select(F.col("id").alias("_dataset"))
    return companies.join(chosen, F.col("dataset_id") == F.col("_dataset")).drop("_dataset")


def validation_counts(companies: DataFrame, datasets: DataFrame, leads: DataFrame, dataset_id, run_id: str | None) -> DataFrame:
    """One row of counts over the companies and leads of a dataset: conditional counts in one pass over each, not a subquery for each figure."""
    ours = run_companies(companies, datasets, dataset_id)
    has = lambda c: F.count_if(F.col(c).isNotNull())
    of_companies = ours.agg(
        F.count(F.lit(1)).alias("companies_in_run"),
        has("website").alias("companies_with_website"),
        has("domain").alias("companies_with_domain"),
        has("phone_primary").alias("companies_with_phone"),
        has("email_primary").alias("companies_with_company_email"),
        has("contact_form_url").alias("companies_with_contact_form"),
    )
    place = ("id", "mailing_street", "physical_address", "mailing_city", "mailing_state", "mailing_zip")
    joined = leads.join(ours.select(*[F.col(c).alias(f"c_{c}") for c in place]), F.col("company_id") == F.col("c_id"))
    of_leads = joined.agg(
        F.count(F.lit(1)).alias("leads_from_run_companies"),
        F.count_if(F.col("source") == "company_expansion").alias("company_expansion_leads"),
        F.count_if(sellable(F.col("lead_stage"), F.col("email"), F.col("syntax_valid"), F.col("mx_valid"))).alias("sellable_leads_now"),
        F.count_if(premium("", "c_")).alias("premium_like_leads_now"),
    )
    dataset = datasets.where(F.col("id") == dataset_id).agg(F.first("id").alias("dataset_id"), F.first("record_count").alias("dataset_record_count"))
    one = F.lit(1).alias("_one")  # three one-row relations
    out = dataset.select("*", one).join(of_companies.select("*", one), "_one").join(of_leads.select("*", one), "_one").drop("_one")
    return out.withColumn("run_id", F.lit(run_id))


def company_candidates(
    companies: DataFrame, datasets: DataFrame, run_id: str | None = None, limit: int = 100, company_ids: list[int] | None = None, require_missing: bool = True
) -> DataFrame:
    """Companies to expand, by id. A run is told by the dataset's run_id, or by its notes where it has no such column;
    an underscore in the id then stands for any character, as it does in SQL patterns."""
    by_column = "run_id" in datasets.columns
    d = datasets.select(F.col("id").alias("_d"), F.col("run_id" if by_column else "notes").alias("_run"))
    out = companies.join(d, F.col("dataset_id") == F.col("_d"), "left")
    if run_id is not None:
        out = out.where((F.col("_run") == run_id) if by_column else F.col("_run").ilike(f"%run_id={run_id}%"))
    if company_ids:
        out = out.where(F.col("id").isin(*company_ids))
    if require_missing:
        missing = F.col(ENRICHED[0]).isNull()
        for c in ENRICHED[1:]:
            missing = missing | F.col(c).isNull()
        out = out.where(missing)
    return out.drop("_d").withColumnRenamed("_run", "run_ref").orderBy("id").limit(limit)


def lead_inspection(leads: DataFrame, companies: DataFrame, datasets: DataFrame, dataset_id) -> DataFrame:
    """Leads of a dataset with their company, the latest first, undated ones last."""
    ours = run_companies(companies, datasets, dataset_id).select(F.col("id").alias("company_id"), "canonical_name", "domain")
    return leads.join(ours, "company_id").orderBy(F.col("captured_at").desc_nulls_last(), F.col("id"))


def query_key(query: Column, market: Column) -> Column:
    q, m = (blank_to_null(strip(F.coalesce(c, F.lit("")))) for c in (query, market))
    return F.when(q.isNotNull() & m.isNotNull(), F.concat_ws("||", q, m)).otherwise(F.coalesce(q, m))


def error_source(error: Column) -> Column:
    return F.coalesce(blank_to_null(F.lower(F.regexp_extract(strip(F.coalesce(error, F.lit(""))), r"^\s*([A-Za-z0-9_]+)\[", 1))), F.lit("unknown"))


def source_name(source: Column) -> Column:
    return F.lower(strip(F.coalesce(blank_to_null(source), F.lit("unknown"))))


def source_benchmarks(raw: DataFrame, errors: DataFrame, sources: DataFrame, metrics: dict | None = None) -> DataFrame:
    """Figures for each source of a run. ``raw``: source, query, market, raw_website; ``errors``: error; ``sources``: source. Contact rates
    are told only where the run had a single source, from ``metrics``; otherwise sites come from the raw records."""
    metrics = metrics or {}
    stats = raw.groupBy(source_name(F.col("source")).alias("source")).agg(
        F.count(F.lit(1)).alias("raw_records"),
        F.count_if(strip(F.coalesce("raw_website", F.lit(""))) != "").alias("website_hits"),
        F.countDistinct(query_key(F.col("query"), F.col("market"))).alias("successful_query_pairs"),
    )
    failed = errors.groupBy(error_source(F.col("error")).alias("source")).agg(F.count(F.lit(1)).alias("failed_query_pairs"))
    named = sources.where(F.coalesce("source", F.lit("")) != "").select(F.lower(strip(F.col("source"))).alias("source"))
    names = named.unionByName(stats.select("source")).unionByName(failed.select("source")).distinct()
    out = names.join(stats, "source", "left").join(failed, "source", "left").na.fill(0)
    single = names.limit(2).count() == 1  # two rows at most
    total = F.col("successful_query_pairs") + F.col("failed_query_pairs")
    number = lambda k: F.lit(int(metrics.get(k) or 0))
    scanned, seeded = F.greatest(F.lit(1), number("companies_scanned")), number("companies_seeded")
    found = seeded if single else F.col("raw_records")
    rate = lambda k: safe_rate(number(k), scanned) if single else F.lit(None).cast("double")
    sites = safe_rate(number("companies_with_website"), F.greatest(F.lit(1), seeded)) if single else safe_rate(F.col("website_hits"), F.greatest(F.lit(1), F.col("raw_records")))
    return out.select(
        "source",
        "raw_records",
        "successful_query_pairs",
        "failed_query_pairs",
        total.alias("total_query_pairs"),
        safe_rate(F.col("failed_query_pairs"), total).alias("source_failure_rate"),
        F.lit("single-source-run" if single else "raw-ingestion-only").alias("attribution_mode"),
        F.round(safe_rate(found, F.greatest(F.lit(1), total), 6) * 100, 2).alias("companies_found_per_100_queries"),
        sites.alias("websites_discovered_rate"),
        rate("named_contacts_found").alias("named_contact_rate"),
        rate("sellable_leads_inserted").alias("sellable_email_rate"),
        rate("premium_leads_inserted").alias("premium_contact_rate"),
    )


def alerts(metrics: DataFrame, failure_rate: float = 0.25) -> DataFrame:
    """Adds alerts (key, message), alert_triggered and a rounded rate to run metrics (status, companies_seeded, leads_inserted,
    sellable_leads_inserted, max_source_failure_rate)."""
    worst = F.coalesce("max_source_failure_rate", F.lit(0.0))
    n = lambda c: metric_int(F.col(c))
    rules = [
        (F.lower(F.coalesce("status", F.lit(""))) != "completed", "run_failed", "The scheduled run did not complete successfully."),
        (n("companies_seeded") <= 0, "zero_inserted_companies", "No companies were seeded for this run."),
        (n("leads_inserted") <= 0, "zero_inserted_contacts", "No new contacts/leads were inserted during this execution."),
        (n("sellable_leads_inserted") <= 0, "zero_sellable_leads", "No sellable leads were inserted during this execution."),
        (worst > failure_rate, "abnormal_source_failure_rate", "At least one source exceeded the allowed query failure rate."),
    ]
    raised = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("key"), F.lit("error").alias("severity"), F.lit(m).alias("message"))) for c, k, m in rules]))
    return metrics.withColumns({"alerts": raised, "alert_triggered": F.size(raised) > 0, "source_failure_rate": F.round(worst, 4)})


def compliance_verdict(enabled: Column, automation_allowed: Column, tos_prohibits: Column, registered: Column) -> Column:
    """"ok", or the first rule that a source breaks."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return (
        F.when(no(registered), "not_registered")
        .when(no(enabled), "disabled")
        .when(no(automation_allowed), "automation_not_permitted")
        .when(F.coalesce(tos_prohibits, F.lit(False)), "terms_prohibit")
        .otherwise("ok")
    )


def require_source(registry: DataFrame, source_key: str) -> None:
    """Raises ComplianceError unless ``source_key`` may be collected."""
    row = registry.where(F.col("source_key") == source_key).limit(1)
    verdict = compliance_verdict(F.col("enabled"), F.col("automation_allowed"), F.col("tos_prohibits_mining"), F.lit(True))
    found = row.select(verdict.alias("v")).collect()
    if (v := found[0].v if found else "not_registered") != "ok":
        raise ComplianceError(f"{source_key}: {v}")


def remaining_seeds(seeds: DataFrame, attempts: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Seeds (parcel_id) still to fetch: none that succeeded, none tried ``max_attempts`` times; with the attempts so far."""
    done = attempts.where(F.col("status") == "ok").select("parcel_id").distinct()
    tried = attempts.groupBy("parcel_id").agg(F.count(F.lit(1)).alias("attempts"))
    left = seeds.join(done, "parcel_id", "left_anti").join(tried, "parcel_id", "left")
    return left.withColumn("attempts", F.coalesce("attempts", F.lit(0))).where(F.col("attempts") < max_attempts)


def seed_targets(rows: DataFrame, order: str, limit: int = 0) -> DataFrame:
    """Parcel ids of a run in order; ``limit`` (0 for all) applies before blank ids go."""
    ids = F.coalesce(blank_to_null(strip(F.col("parcel_id"))), blank_to_null(strip(F.col("Parcel ID")))) if "Parcel ID" in rows.columns else blank_to_null(strip(F.col("parcel_id")))
    taken = rows.orderBy(order).limit(limit) if limit else rows
    return taken.select(F.col(order), ids.alias("parcel_id")).where("parcel_id is not null")


def run_document(raw: DataFrame, errors: DataFrame, run_id: str, as_of: Column) -> DataFrame:
    """One row for a run: total, counts by source, errors, and completed only if any record came."""
    counts = raw.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    by_source = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("by_source"), F.lit(1).alias("_one")
    )
    wrong = errors.agg(F.array_sort(F.collect_list("error")).alias("errors"), F.lit(1).alias("_one"))
    out = by_source.join(wrong, "_one").drop("_one")
    return out.select(
        F.lit(run_id).alias("run_id"), F.when(F.col("total") > 0, "completed").otherwise("failed").alias("status"), "total", "by_source", "errors", as_of.alias("completed_at")
    )


def flatten_payloads(docs: DataFrame, payload: str = "payload") -> DataFrame:
    """Documents inside JSON payloads, one row each with the other columns: an object is one, an array its objects."""
    raw = F.trim(F.col(payload))
    items = F.when(raw.startswith("["), F.from_json(raw, "array<string>")).when(raw.startswith("{") & (raw != "{}"), F.array(raw))
    others = [c for c in docs.columns if c != payload]
    return docs.select(*others, F.explode(items).alias("document")).where(F.trim("document").startswith("{"))


def should_archive(mode: Column, run_id: Column, dataset_id: Column, status: Column, failed: Column) -> Column:
    """Whether a run's raw rows may be archived: wanted, complete and without any error."""
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    return (mode != "keep") & filled(run_id) & filled(dataset_id) & F.coalesce(status == "completed", F.lit(False)) & ~F.coalesce(failed, F.lit(False))


#: Fields of the run metrics: (name, [(source map, key), ...]); the first that is neither missing nor 0 counts.
METRIC_FIELDS = [
    ("raw_records_ingested", [("ingest", "raw_records_ingested")]),
    ("dataset_record_count", [("validation", "dataset_record_count"), ("etl", "dataset_record_count")]),
    ("companies_seeded", [("etl", "canonical_companies_upserted_current_state"), ("validation", "companies_in_run")]),
    ("companies_enriched", [("apply", "applied")]),
    ("contacts_found", [("contacts", "contacts_found")]),
    ("named_contacts_found", [("contacts", "named_contacts_found")]),
    *[(f"{k}_inserted", [("contacts", f"{k}_inserted_this_execution"), ("contacts", f"{k}_inserted_reported")]) for k in ("leads", "named_leads", "sellable_leads", "premium_leads")],
    ("companies_scanned", [("contacts", "companies_scanned")]),
    *[
        (k, [("validation", k)])
        for k in (
            "companies_in_run", "companies_with_website", "companies_with_domain", "companies_with_phone", "companies_with_company_email", "companies_with_contact_form", "leads_from_run_companies",
            "company_expansion_leads", "sellable_leads_now", "premium_like_leads_now",
        )
    ],
    ("raw_expansion_docs_written", [("expansion", "raw_expansion_docs_written_delta")]),
    ("expansion_apply_found", [("apply", "found")]),
    ("expansion_apply_applied", [("apply", "applied")]),
    *[(k, [("contacts", k)]) for k in ("company_phone_updates", "company_email_updates", "company_form_updates")],
]
#: Elapsed seconds, by the map that tells them.
ELAPSED = {"ingestion": "ingest", "etl": "etl", "expansion": "expansion", "expansion_apply": "apply", "contact_discovery": "contacts"}


def metrics_payload(results: DataFrame) -> DataFrame:
    """One typed row a run from what its stages printed: maps ingest, etl, expansion, apply, contacts and validation of text to text, beside
    run_id, dataset_id, trigger, status and error_message. For leads a figure of this execution counts even when it is 0."""

    def number(name: str, sources: list[tuple[str, str]]) -> Column:
        values = [F.try_element_at(F.col(m), F.lit(k)) for m, k in sources]
        if name.endswith("_inserted"):
            return F.coalesce(*[F.when(blank_to_null(v).isNotNull(), metric_int(v)) for v in values], F.lit(0).cast("bigint"))
        return F.coalesce(*[F.nullif(metric_int(v), F.lit(0).cast("bigint")) for v in values], F.lit(0).cast("bigint"))

    seconds = lambda m: F.round(F.coalesce(F.try_element_at(F.col(m), F.lit("elapsed_seconds")).try_cast("double"), F.lit(0.0)), 2)
    dataset = F.coalesce(*[blank_to_null(F.try_element_at(F.col(m), F.lit("dataset_id"))) for m in ("validation", "etl")], F.col("dataset_id"))
    return results.select(
        "run_id",
        dataset.alias("dataset_id"),
        *("trigger", "status", "error_message"),
        *[number(n, s).alias(n) for n, s in METRIC_FIELDS],
        *[seconds(m).alias(f"{n}_elapsed_seconds") for n, m in ELAPSED.items()],
    )


def has_website(*places: Column) -> Column:
    """Whether the first of ``places`` that is filled says more than blanks."""
    return F.coalesce(strip(F.coalesce(*[blank_to_null(p) for p in places])) != "", F.lit(False))


def tallies(rows: DataFrame) -> DataFrame:
    """One row a run of its rows (outcome, source_failure_rate, has_website): outcomes counted, the worst rate (0 without any), records with a website."""
    outcomes = [F.count_if(F.col("outcome") == o).alias(o) for o in ("inserted", "skipped", "failed")]
    return rows.groupBy("run_id").agg(*outcomes, F.coalesce(F.max("source_failure_rate"), F.lit(0.0)).alias("worst_failure_rate"), F.count_if("has_website").alias("with_website"))


def company_id_list(text: Column) -> Column:
    """Ids of a comma-separated list; blanks and a stray ">" at the end of one go."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.regexp_replace(strip(p), ">+$", ""))
    return F.transform(F.filter(parts, lambda p: p.rlike(r"^\d+$")), lambda p: p.cast("bigint"))


def set_record_counts(datasets: DataFrame, companies: DataFrame) -> DataFrame:
    """Datasets with the number of companies that they have now; those without any keep theirs."""
    counted = companies.groupBy(F.col("dataset_id").alias("_id")).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    joined = datasets.join(counted, F.col("id") == F.col("_id"), "left")
    return joined.withColumn("record_count", F.coalesce("_n", "record_count")).drop("_id", "_n")


def backfill(companies: DataFrame, updates: DataFrame, columns: list[str], domains: list[str]) -> DataFrame:
    """Companies of ``domains`` (with or without "www.") with ``columns`` replaced from ``updates`` (id and those columns)."""
    bare = F.replace(F.col("domain"), F.lit("www."), F.lit(""))
    wanted = F.col("domain").isin(*domains) | bare.isin(*domains)
    fresh = updates.select(F.col("id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = companies.join(fresh, (F.col("id") == F.col("_id")) & wanted, "left")
    merged = {c: F.when(F.col("_id").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(merged).drop("_id", *[f"_{c}" for c in columns])


def with_social_columns(entities: DataFrame) -> DataFrame:
    """Adds the social columns, unknown until some source fills them."""
    kinds = {"facebook_url": "string", "facebook_followers": "int", "linkedin_url": "string", "linkedin_employee_count": "int"}
    return entities.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in entities.columns})
