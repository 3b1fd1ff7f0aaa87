import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadloom.functions.similarity import common_length
from leadloom.operators import dedupe, records, resolve, runs, scoring, targets, upsert, websites
from leadloom.sources import readers
from leadloom.streaming import ingest

RECORD = "ord long, raw_company_name string, raw_phone string, raw_website string, mailing_street string, mailing_city string, mailing_state string, mailing_zip string, lat double, lng double"


def _resolved(spark, rows):
    return {tuple(r.record_ords): r for r in resolve.resolve_entities(spark.createDataFrame(rows, RECORD)).collect()}


def test_resolution_cases(spark):
    rec = lambda o, name, phone=None, site=None, z=None, lat=None, lng=None: (o, name, phone, site, None, None, None, z, lat, lng)
    got = _resolved(
        spark,
        [
            rec(1, "Acme Roofing", "865-555-0101", "acme.com"),
            rec(2, "Acme Roofing LLC", None, "https://www.acme.com"),  # like name and domain
            rec(3, "Wholly Different", None, "acme.com"),  # same domain, unlike name: veto
            rec(4, "Zed", "8655550199", None, "37000"),
            rec(5, "Other Name", "8655550199"),  # phone alone does not merge
            rec(6, "Zed", "8655550199", None, "37000"),  # phone, name and zip
            rec(7, "Far", "8655550111", None, "1", 35.0, -83.0),
            rec(8, "Far", "8655550111", None, "1", 36.0, -83.0),  # same phone, far away: veto
            rec(9, None, None, None),
        ],
    )
    assert set(got) == {(1, 2), (3,), (4, 6), (5,), (7,), (8,), (9,)}
    assert got[1, 2].merge_confidence == 65 and got[1, 2].alias_names == ["Acme Roofing", "acme roofing"] and got[1, 2].dedupe_key == "acme.com"
    assert got[4, 6].merge_confidence == 70


def test_resolution_by_component_equals_one_pass(spark):
    rng = random.Random(7)
    names = ["Acme Roofing", "Acme Roof", "Acme Roofing Inc", "Zenith Homes", "Zenith Home Co"]
    rows = []
    for o in range(150):
        phone = rng.choice([None, *[f"86555501{k:02d}" for k in range(12)]])
        site = rng.choice([None, *[f"site{k}.com" for k in range(12)]])
        rows.append((o, rng.choice(names), phone, site, None, None, None, rng.choice([None, "37000", "37001"]), rng.choice([None, 35.0, 35.01, 36.0]), -83.0))
    got = set(_resolved(spark, rows))
    p = resolve.prepared(spark.createDataFrame(rows, RECORD)).orderBy("ord").collect()
    whole = resolve.merge_in_order([r.asDict() for r in p])
    assert got == {tuple(e["members"]) for e in whole}


def test_common_length_is_the_subsequence():
    rng = random.Random(1)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for _ in range(200):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 80))) for _ in range(2))
        assert common_length(a, b) == plain(a, b)


def test_first_and_last_wins(spark):
    rows = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, None, 30), (4, None, 40)], "ord int, k string, v int")
    assert sorted(r.v for r in dedupe.first_wins(rows, ["k"], ["ord"]).collect()) == [10, 30]
    assert sorted((r.v, r.place) for r in dedupe.last_wins(rows, ["k"], ["ord"], place="place").collect()) == [(20, 1), (40, 3)]
    assert dedupe.first_wins(rows.limit(0), ["k"], ["ord"]).collect() == []


def test_ranks(spark):
    rows = spark.createDataFrame([("g", i, i != 2) for i in range(1, 5)], "g string, ord int, ok boolean")
    dense = dedupe.rank_kept(rows, ["g"], ["ord"], F.col("ok"), cap=2)
    gaps = dedupe.rank_kept(rows, ["g"], ["ord"], F.col("ok"), dense=False)
    assert [(r.ord, r.rank) for r in dense.orderBy("ord").collect()] == [(1, 1), (3, 2)] and [r.rank for r in gaps.orderBy("ord").collect()] == [1, 3, 4]


def test_upsert_rules(spark):
    schema = "dedupe_key string, canonical_name string, alias_names array<string>, lead_quality string, first_seen int"
    old = spark.createDataFrame([("a", "Old", ["x"], '{"s": 1}', 5), ("b", "Kept", None, None, None)], schema)
    new = spark.createDataFrame([(1, "a", None, ["y", "x"], "{}", 9), (2, "a", "New", None, None, 8), (3, "c", "", ["z"], "{}", 1)], "ord int, " + schema)
    got = {r.dedupe_key: r for r in upsert.upsert_companies(old, new, "ord").collect()}
    assert tuple(got["a"])[1:] == ("New", ["x", "y"], '{"s": 1}', 5)
    assert got["b"].canonical_name == "Kept" and tuple(got["c"])[1:] == ("", ["z"], "{}", 1)


def test_checkpoints(spark):
    old = spark.createDataFrame([("r", "etl", "started", 1, None, {"a": "1"}, 1)], "run_id string, stage_key string, status string, started_at int, completed_at int, meta map<string,string>, updated_at int")
    new = spark.createDataFrame([("r", "etl", "completed", {"a": "2", "b": "3"}), ("r", "apply", "completed", None)], "run_id string, stage_key string, status string, meta map<string,string>")
    got = {r.stage_key: r for r in upsert.set_checkpoints(old, new, F.lit(7)).collect()}
    assert (got["etl"].started_at, got["etl"].completed_at, got["etl"].meta) == (1, 7, {"a": "2", "b": "3"})
    assert (got["apply"].started_at, got["apply"].completed_at, got["apply"].meta) == (7, 7, {})


def test_market_order_and_pages(spark):
    rows = [("m0", None), ("m1", 0), ("m2", 2), ("m3", 1)]
    markets = spark.createDataFrame([(n, "TN", n, n, r, True, None, None, "r", "t") for n, r in rows], "market_slug string, state string, city string, market string, population_rank int, enabled boolean, default_pack string, source_profile string, region string, tier string")
    order = lambda **kw: [r.market for r in targets.filter_markets(markets, **kw).collect()]
    assert order() == ["m3", "m2", "m1", "m0"] and order(top_n=-1) == [] and order(batch_size=2, batch_index=1) == ["m1", "m0"]
    assert order(min_population_rank=1) == ["m3", "m2"] and order(state="tn ", market_slugs=["M2"]) == ["m2"]
    packs = spark.createDataFrame([("home_services", "Roofing", 0, True)], "pack string, query string, ord int, enabled boolean")
    profiles = spark.createDataFrame([("standard_city", True, True, 1, 3)], "profile string, enabled boolean, headless boolean, max_pages int, max_scrolls int")
    assert targets.build_targets(markets, packs, profiles, max_query_pairs=3).count() == 3
    with pytest.raises(KeyError):
        targets.build_targets(markets, packs, profiles, pack="nope")


def test_registry_rows(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿market_slug,state,city,market,population,population_rank,enabled,default_pack,source_profile,region,tier,notes\n,tn, Oak  Ridge ,,31000,x,no,,,,,\nx,,Y,,,,,,,,,\n", encoding="utf-8")
    got = readers.market_registry(readers.read_csv(spark, str(tmp_path / "m.csv"))).collect()
    assert len(got) == 1 and (got[0].market_slug, got[0].state, got[0].population, got[0].population_rank, got[0].enabled, got[0].default_pack) == ("oak-ridge-tn", "TN", 31000, None, False, "home_services")


def test_scores(spark):
    row = spark.createDataFrame([(1,)], "id int").select(
        "id",
        F.lit("8655550101").alias("phone_primary"), F.lit("a@b.c").alias("email_primary"), F.lit("1 Main").alias("mailing_street"), F.lit("w").alias("website"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"),
        F.struct(
            F.struct(F.lit("200").alias("status_code"), F.lit(True).alias("has_contact_form"), F.lit(-3).alias("last_modified_days")).alias("website"),
            F.struct(F.lit("0").alias("review_velocity_90d")).alias("google"),
            F.struct(F.lit(0.0).alias("age_years")).alias("domain"),
            F.struct(F.array(F.lit("a.b")).alias("missing_signals")).alias("debug"),
        ).alias("behavioral_signals"),
    )
    got = scoring.score_leads(row).first()
    q = got.lead_quality
    assert (q.score, q.tier, got.data_completeness_score, got.engagement_score, got.authority_score) == (52, "medium", 10, 40, 2)
    assert [n.key for n in q.breakdown.negative] == ["low_review_velocity", "missing_signal"] and q.breakdown.negative[1].label == "Missing signal: a b"
    assert q.attribution.summary == "Derived from website"
    assert [r[0] for r in spark.createDataFrame([(75,)], "s int").select(scoring.tier(F.col("s"), 75)).collect()] == ["high"]


def test_industry_and_noise(spark):
    rows = spark.createDataFrame([("Oak HOA",), ("RPM Living",), ("PM Group",), (None,)], "n string")
    got = [(r.i.industry_type, r.i.sub_industry) for r in rows.select(records.industry(F.col("n")).alias("i")).collect()]
    assert got == [("property_management", "hoa_management"), ("property_management", None), ("property_management", None), ("unknown", None)]
    assert [r[0] for r in spark.createDataFrame([("Property Co",), ("Acme",)], "n string").select(websites.noise_name(F.col("n"))).collect()] == [True, False]


def test_benchmarks_of_a_single_source_run(spark):
    raw = spark.createDataFrame([("yellowpages", f"q{i % 20}", "m", None) for i in range(568)], "source string, query string, market string, raw_website string")
    errors, sources = spark.createDataFrame([], "error string"), spark.createDataFrame([("yellowpages",)], "source string")
    metrics = {"companies_seeded": 356, "companies_with_website": 292, "companies_scanned": 140, "named_contacts_found": 23, "sellable_leads_inserted": 12, "premium_leads_inserted": 3}
    r = runs.source_benchmarks(raw, errors, sources, metrics).first()
    assert (r.companies_found_per_100_queries, r.websites_discovered_rate, r.named_contact_rate, r.sellable_email_rate, r.premium_contact_rate) == (1780.0, 0.8202, 0.1643, 0.0857, 0.0214)
    assert r.source_failure_rate == 0.0 and r.attribution_mode == "single-source-run"


def test_compliance(spark):
    registry = spark.createDataFrame([("ok", True, True, False), ("off", False, True, False)], "source_key string, enabled boolean, automation_allowed boolean, tos_prohibits_mining boolean")
    runs.require_source(registry, "ok")
    for key in ("off", "missing"):
        with pytest.raises(runs.ComplianceError):
            runs.require_source(registry, key)


def test_seeds_limit_before_blanks(spark):
    rows = spark.createDataFrame([(1, " "), (2, "p2"), (3, "p3")], "ord int, parcel_id string")
    assert [r.parcel_id for r in runs.seed_targets(rows, "ord", 2).collect()] == ["p2"] and runs.seed_targets(rows, "ord").count() == 2


def test_archive_and_purge(spark, tmp_path):
    raw = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "c")], "run_id string, v string")
    readers.append_run(raw, str(tmp_path / "raw"))
    landed = readers.read_run(spark, str(tmp_path / "raw"), "r1")
    assert landed.count() == 2
    manifest = readers.archive_run(raw, "r1", str(tmp_path / "archive")).first()
    assert (manifest.matched, manifest.written, manifest.complete) == (2, 2, True)
    assert [r.v for r in readers.purge_run(raw, "r1").collect()] == ["c"]
    with pytest.raises(ValueError):
        readers.read_run(spark, str(tmp_path), "")


def test_logs(spark):
    lines = spark.createDataFrame([(1, "run_id: a"), (2, "applied: 3"), (3, "applied: 4"), (4, "run_id: b"), (5, "INGESTION COMPLETE — 12 raw records (run_id=a)")], "line_no int, line string")
    assert {r.key: r.value for r in readers.log_values(lines.withColumn("g", F.lit(1)), ["g"]).collect()} == {"run_id": "a", "applied": "4"}
    got = lines.select(readers.ingested(F.col("line")).alias("i")).where("i is not null").first().i
    assert (got.records, got.run_id) == (12, "a")


def test_expansion(spark):
    companies = spark.createDataFrame([(1, "Acme Roofing"), (2, "Nobody")], "company_id int, canonical_name string")
    found = spark.createDataFrame([(1, "https://facebook.com/acme", "Acme", "bing", 1), (1, "acme.com", "Acme Roofing", "ddg", 2), (1, "acme.net", "Acme Roofing", "ddg", 3)], "company_id int, url string, title string, source string, ord int")
    contacts = spark.createDataFrame([("https://acme.com", "1", "e", None)], "website string, phone string, email string, contact_form_url string")
    got = {r.company_id: r for r in websites.expand_companies(companies, found, contacts).collect()}
    assert (got[1].website, got[1].domain, got[1].confidence, got[1].email, got[1].sources) == ("https://acme.com", "acme.com", 0.9, "e", ["bing", "ddg"])
    assert (got[2].website, got[2].confidence) == (None, 0.0)


def test_streaming_merge(spark, tmp_path):
    schema = "ord int, dedupe_key string, canonical_name string, source string, source_id string, market string, query string, captured_at timestamp"
    t = datetime(2024, 1, 1)
    rows = [(1, "a", "One", "s", "1", "m", "q", t), (2, "a", "Again", "s", "1", "m", "q", t), (3, "b", "Two", "s", "2", "m", "q", t)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    start = spark.createDataFrame([("b", None), ("c", "Old")], "dedupe_key string, canonical_name string")
    start.write.parquet(str(tmp_path / "table/initial"))
    stream = ingest.without_repeats(ingest.raw_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema))
    q = ingest.merge_companies(stream.select("ord", "dedupe_key", "canonical_name"), str(tmp_path / "table"), str(tmp_path / "cp"), "ord")
    q.awaitTermination(120)
    got = {r.dedupe_key: r.canonical_name for r in spark.read.parquet(str(tmp_path / "table/version=0")).collect()}
    assert got["a"] in ("One", "Again") and got["b"] == "Two" and got["c"] == "Old"


def test_record_counts_take_every_company(spark):
    from leadloom.plans import catalog

    sf = "/root/testdata/sf0.001"
    per_dataset = {r.dataset_id: r["count"] for r in catalog.companies(spark, sf).groupBy("dataset_id").count().collect()}
    got = {r.id: r.record_count for r in catalog.QUERIES["finalize_datasets_all"](spark, sf).collect()}
    assert per_dataset and all(got[i] == n for i, n in per_dataset.items() if i in got)
    datasets = spark.createDataFrame([(1, 9), (2, 7)], "id long, record_count int")
    companies = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id long, dataset_id long")
    assert {r.id: r.record_count for r in runs.set_record_counts(datasets, companies).collect()} == {1: 3, 2: 7}


def test_pairs_of_a_hot_key_in_tiles(spark, monkeypatch):
    from leadloom.operators import resolve

    monkeypatch.setattr(resolve, "BLOCK_ROWS", 30)
    n = 200
    rows = spark.range(n).selectExpr(
        "id AS ord", "concat('Acme Roofing ', id % 3) AS raw_company_name", "CASE WHEN id % 5 > 0 THEN '8655550100' END AS raw_phone", "CASE WHEN id % 2 = 0 THEN 'hot.com' WHEN id % 7 = 0 THEN 'x.com' END AS raw_website", "'37901' AS mailing_zip", "35.9D AS lat", "-83.9D AS lng"
    )
    site = lambda k: "hot" if k % 2 == 0 else "x" if k % 7 == 0 else None
    want = sorted((a, b) for a in range(n) for b in range(a + 1, n) if (site(a) and site(a) == site(b)) or (a % 5 and b % 5))
    got = resolve.candidate_pairs(rows).select("a_ord", "b_ord", "name_score", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.a_ord, r.b_ord) for r in got) == want and {r.name_score == 100 for r in got if r.a_ord % 3 == r.b_ord % 3} == {True}
    tasks = {}
    for r in got:
        tasks[r.task] = tasks.get(r.task, 0) + 1
    assert max(tasks.values()) < len(want) / 4


def test_cells_keep_nulls_and_types():
    import pyarrow as pa

    cells = [resolve._cells(pa.array(v, k)) for v, k in (([1, None, 1 << 60], pa.int64()), (["a", None], pa.string()), ([1.5, None], pa.float64()), ([1, 2], pa.int64()), ([], pa.string()))]
    assert cells == [[1, None, 1 << 60], ["a", None], [1.5, None], [1, 2], []] and type(cells[3][0]) is int


def test_scores_from_words_of_the_name(spark):
    from leadloom.functions.similarity import overlap_words

    rows = spark.createDataFrame([("acme.com", "Acme Roofing | Home", "Acme Roofing Experts"), ("b.org/about", None, None), ("c.net", "Zed Co", "")], "url string, title string, canonical_name string")
    want = [r.score for r in websites.score_candidates(rows).collect()]
    assert [r.score for r in websites.score_candidates(rows.withColumn("name_words", overlap_words(F.col("canonical_name"))).drop("canonical_name")).collect()] == want


def test_pairs_as_records_compared_one_by_one_give_them(spark):
    from leadloom.operators import resolve

    names = ["Acme Roofing", "Roofing Acme", "Akme Rofing Ltd", "", None, "Zed", "é" * 40 + " " + "b" * 50, "b" * 49 + " " + "é" * 41, "x\0y z", "Customer 7"]
    sites, phones, zips = ["hot.com", "hot.com", "b.org", None], ["8655550100", "8655550101", None], ["37901", "", None]
    places = [(35.9, -83.9), (35.95, -83.9), (None, -83.9), (float("nan"), -83.9), (35.9, None)]
    rows = [(k, names[k * 7 % 10], phones[k % 3], sites[k // 3 % 4], zips[k // 5 % 3], *places[k // 2 % 5]) for k in range(150)]
    df = spark.createDataFrame(rows, "ord long, raw_company_name string, raw_phone string, raw_website string, mailing_zip string, lat double, lng double")
    p = [r.asDict() for r in resolve.prepared(df).orderBy("ord").collect()]
    want = {}
    for a in p:
        for b in p[a["ord"] + 1 :]:
            same = {c: a[c] is not None and a[c] == b[c] for c in ("domain", "phone", "mailing_zip")}
            if same["domain"] or same["phone"]:
                ratio = None if None in (a["name"], b["name"]) else resolve._ratio(a["name"], b["name"])
                km = resolve._km(a, b)
                both = bool(a["name"] and b["name"])
                veto = (same["domain"] and both and ratio < 60) or (same["phone"] and km is not None and not km <= 5)
                want[a["ord"], b["ord"]] = (ratio, km if km is None else round(km, 9), veto, 30 * (both and ratio >= 85) + 35 * same["domain"] + 30 * same["phone"] + 10 * (same["mailing_zip"] and a["mailing_zip"] != ""))
    found = resolve.candidate_pairs(df)
    got = {(r.a_ord, r.b_ord): (r.name_score, r.km if r.km is None else round(r.km, 9), r.veto, r.score) for r in found.collect()}
    assert len(got) == found.count() and str(sorted(got.items())) == str(sorted(want.items()))
    short = {(r.a_ord, r.b_ord): r[2:] for r in resolve.candidate_pairs(df, digits=6, km=False).collect()}
    rounded = {k: (None if r is None else float(f"{r:.6f}"), v, s) for k, (r, _, v, s) in want.items()}
    assert short == rounded
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "SortMergeJoin [_key" not in plan, "pairs are made and scored in tiles, not row by row"


def test_common_lengths_of_many_pairs():
    import random

    import numpy as np

    from leadloom.functions.similarity import common_length
    from leadloom.operators.resolve import Common

    rng = random.Random(4)
    words = ["".join(rng.choice("abcé \0") for _ in range(rng.choice([0, 1, 5, 20, 63, 64]))) for _ in range(60)]
    for texts in (words, words + ["ab" * 40, "b" * 70]):
        x, y = (np.array([rng.randrange(len(texts)) for _ in range(500)]) for _ in range(2))
        want = [common_length(texts[a], texts[b]) for a, b in zip(x, y)]
        for n in (0, 1 << 20):  # pair by pair, and from a table of all
            assert Common(texts, n).of(x, y).tolist() == want
