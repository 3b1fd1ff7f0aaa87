"""Result lists, places, loader tables, presets, and expressions that are worked out once."""

import re

import pytest
from pyspark.sql import functions as F

from leadloom.functions import binding, text, urls
from leadloom.operators import html, places, records, websites
from leadloom.plans import catalog
from leadloom.sources import loaders, presets

SF = "/root/testdata/sf0.001"


def item(title, url, snippet=None):
    said = f'<div class="b_caption"><p>{snippet}</p></div>' if snippet else ""
    return f'<li class="b_algo"><h2><a href="{url}">{title}</a></h2>{said}</li>'


def test_results_are_filtered_before_they_are_ranked(spark):
    others = "".join(item("How to roof", "https://a.com/x") + item("Plain", "https://b.com/deep/path") for _ in range(20))
    page = others + "".join(item(f"Roofing {k}", f"https://r{k}.com/x", "said" if k % 2 else None) for k in range(40)) + others
    got = html.search_results(spark.createDataFrame([("p", page), ("none", others), ("empty", None)], "page string, html string"), "bing").orderBy("rank").collect()
    assert [(r.page, r.rank, r.title, r.snippet) for r in got] == [("p", k + 1, f"Roofing {k}", "said" if k % 2 else "") for k in range(30)]
    assert got[0].asDict().keys() == {"page", "source", "rank", "title", "url", "snippet"} and got[0].source == "bing_serp"


def test_places_take_the_last_result_and_fall_back_to_the_vicinity(spark):
    result = "struct<name:string,vicinity:string,geometry:struct<location:struct<lat:double,lng:double>>>"
    at = lambda name, near: (name, near, ((1.0, 2.0),))
    found = spark.createDataFrame(
        [("a", 1, "q", at("Old", "Near")), ("a", 3, "r", at("New", "Nearer")), ("a", 2, "q", at("Mid", "x")), ("b", 4, "q", ("B", "B St", None)), ("", 5, "q", at("no id", "x")), (None, 6, "q", at("no id", "x"))],
        f"place_id string, ord long, query string, result {result}",
    )
    details = spark.createDataFrame(
        [("a", 1, ("a.com", "", "555", 4.0, 10)), ("a", 2, ("aa.com", "Full", None, None, 11)), ("c", 3, ("c.com", "C", "1", 1.0, 1))],
        "place_id string, ord long, details struct<website:string,formatted_address:string,formatted_phone_number:string,rating:double,user_ratings_total:int>",
    )
    rows = {r.place_id: r for r in places.place_companies(found, details).collect()}
    assert set(rows) == {"a", "b"} and tuple(rows["a"])[1:] == ("New", "Full", None, "aa.com", 1.0, 2.0, None, 11, 3)
    assert tuple(rows["b"])[1:] == ("B", "B St", None, None, None, None, None, None, 1)
    docs = places.place_records(found, details, "r", "m", F.lit("2026-01-01").cast("timestamp")).collect()
    assert len(docs) == 4 and {d.extracted.raw_company_name for d in docs if d.source_id == "a"} == {"Old", "Mid", "New"}
    assert places.place_companies(found.limit(0), details).count() == 0


def test_company_rows_follow_the_loader(spark):
    e = spark.createDataFrame(
        [(" Acme.com ", None, "A", None, " 200 ", "7"), ("", "", None, "", "abc", None), (None, "w.com", "W", "Guess", "12.5", "")],
        "domain string, website string, canonical_name string, physical_address_guess string, website_status string, dataset_id string",
    ).withColumn("physical_address", F.lit("Plain"))
    rows = loaders.company_rows(e).collect()
    assert loaders.company_rows(e).columns == loaders.COMPANY_COLUMNS and len(loaders.COMPANY_COLUMNS) == 39
    assert [r.dedupe_key for r in rows][::2] == ["acme.com", "w.com"] and len(rows[1].dedupe_key) == 32
    assert [r.physical_address for r in rows] == ["Plain", "Plain", "Guess"] and [r.website_status for r in rows] == [200, None, None]
    assert [r.dataset_id for r in rows] == ["7", None, None] and [r.dataset_id for r in loaders.company_rows(e, "9").collect()] == ["9"] * 3
    assert {r.lead_quality for r in rows} == {"{}"} and loaders.clean_rows(e).columns == loaders.CLEAN_COLUMNS and len(loaders.CLEAN_COLUMNS) == 40
    assert loaders.raw_rows(e, F.lit("2026-01-01")).columns == loaders.RAW_COLUMNS


def test_metrics_of_a_run_are_replaced(spark, tmp_path):
    m = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "run_id string, n int, error string")
    loaders.write_metrics(m, str(tmp_path / "m"))
    loaders.write_metrics(m.where("run_id = 'a'").withColumn("n", F.lit(9)), str(tmp_path / "m"))
    assert sorted(loaders.read_metrics(spark, str(tmp_path / "m"), m.schema.simpleString()).collect()) == [("a", 9, None), ("b", 2, "x")]


def test_metrics_lie_in_few_folders(spark, tmp_path):
    m = spark.range(500).selectExpr("concat('r', id) AS run_id", "id AS n").unionByName(spark.sql("SELECT string(null) AS run_id, 0L AS n"))
    loaders.write_metrics(m.where("n < 300 OR run_id IS NULL"), str(tmp_path / "m"))
    loaders.write_metrics(m.withColumn("n", F.col("n") + 1), str(tmp_path / "m"))
    loaders.write_metrics(m.limit(0), str(tmp_path / "m"))
    got = loaders.read_metrics(spark, str(tmp_path / "m"), m.schema.simpleString())
    assert sorted((r.run_id or "", r.n) for r in got.collect()) == sorted((r.run_id or "", r.n + 1) for r in m.collect())
    assert len(list((tmp_path / "m").glob("*=*"))) <= loaders.METRIC_SLOTS


def test_presets_are_relations(spark):
    packs = presets.packs(spark)
    assert {r.pack: r["count"] for r in packs.groupBy("pack").count().collect()} == {"home_services": 12, "home_services_light": 10, "tourism_services": 9, "real_estate_agents": 9, "car_dealerships": 4}
    assert packs.where("pack = 'car_dealerships' AND ord = 2").first().query == "Automobile & Truck Brokers"
    assert presets.profiles(spark).where("profile = 'metro_heavy'").first().max_scrolls == 4
    assert presets.search_groups(spark).count() == 15 and presets.place_queries(spark).count() == 14
    assert {tuple(r) for r in presets.scraper_versions(spark, {"yellowpages": "1.2", "website_fetch": ""}).collect()} == {("yellowpages", "1.2"), ("website_discovery", "unknown"), ("website_fetch", "unknown")}


# Expressions ------------------------------------------------------------------------------------------------


def test_words_are_found_as_they_are_written(spark):
    df = spark.createDataFrame([("c#",), ("a.b",), ("axb",), ("(x)|y",), (None,)], "t string")
    got = [r.hit for r in df.select(F.col("t").rlike(binding.any_of(["c#", "a.b", "(x)|"])).alias("hit")).collect()]
    assert got == [True, True, False, True, None]


@pytest.mark.parametrize(
    "name, most",
    [("website_pick", 14), ("serp_rank", 4), ("website_discovery", 13), ("redirect_unwrap", 10), ("token_overlap", 8)],
)
def test_each_value_stands_once_in_the_plan(spark, name, most):
    """Regular expressions of the plan that runs, not as many as there are uses of what they give."""
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_(?:replace|extract)\(", plan)) <= most


def test_bound_values_equal_plain_ones(spark):
    """Blank, null and odd addresses through the functions that bind their values."""
    given = [None, "", " ", "a.com", "//x.com/y", "https://WWW.Www.b.com:80/x?u=1", "http://r.com/?url=http%3A%2F%2Fz.com%2B&u=no#f", "http://r.com/?u=&dest=%zz", "ftp://u:p@h.org", "netflix.com", "x y.com", "facebook.com", "m.facebook.com\n"]
    df = spark.createDataFrame([(g,) for g in given], "u string")
    u = F.col("u")
    row = {r.u: r for r in df.select("u", urls.domain_discovery(u).alias("d"), urls.domain_expansion(u).alias("e"), urls.unwrap_redirect(u).alias("w"), urls.tidy_url(u).alias("t"), urls.with_scheme(u).alias("s"), records.bad_domain(u).alias("b"), websites.domain_score(u).alias("n")).collect()}
    assert [row[g].b for g in given] == [True, True, False, False, False, False, False, False, False, False, False, True, False]
    assert row["https://WWW.Www.b.com:80/x?u=1"].d == "www.b.com:80" and row["https://WWW.Www.b.com:80/x?u=1"].e == "www.b.com" and row["https://WWW.Www.b.com:80/x?u=1"].w == "1"
    assert row["http://r.com/?url=http%3A%2F%2Fz.com%2B&u=no#f"].w == "http://z.com+" and row["http://r.com/?u=&dest=%zz"].w == "%zz"
    assert row[" "].t == " " and row["//x.com/y"].t == "https://x.com/y" and row["a.com"].t == "https://a.com" and row[None].t is None and row[""].t is None
    assert row["netflix.com"].n == -50 and row["a.com"].n == 30 and row[None].n == -999 and row[""].n == -999


def test_phones_of_long_texts_without_digits_are_read_in_time(spark):
    import time

    df = spark.createDataFrame([("x" * 200_000,), ("call 865 555 0101",)], "p string")
    began = time.time()
    assert [r.p for r in df.select(text.phone_lax(F.col("p")).alias("p")).collect()] == [None, "8655550101"] and time.time() - began < 20


def test_parcel_sections_are_typed(spark):
    from leadloom.operators import parcels

    df = spark.createDataFrame([("01 - PUBLIC - X",), ("NONE",), (" ",), (None,), ("$1,234,567.00 of 9",), ("a - ",), ("0",)], "t string")
    got = df.select(parcels.coded(F.col("t")).alias("c"), parcels.number(F.col("t")).alias("n")).collect()
    assert [tuple(r.c) for r in got] == [("01 - PUBLIC - X", "01", "PUBLIC - X"), ("NONE", None, "NONE"), (None,) * 3, (None,) * 3, ("$1,234,567.00 of 9", None, "$1,234,567.00 of 9"), ("a -", None, "a -"), ("0", None, "0")]
    assert [r.n for r in got] == [1, None, None, None, 1234567, None, 0]
    page = '<title>T</title><div class="card"><div class="card-header">Outbuildings & Yard Items</div><table><tr><th>a</th><th>b</th><th>c</th><th>d</th></tr><tr><td>1</td><td>SHED</td><td>x</td><td>0</td></tr><tr><td>short</td></tr></table></div>'
    row = parcels.parcel_sections(spark.createDataFrame([(1, page)], "id int, html string")).first()
    assert row.title == "T" and row.tax_year is None and [tuple(o) for o in row.outbuildings] == [("1", "SHED", "x", None, "0")]
    assert row["values"].assessment is None and row.utilities.gas.desc is None
    assert parcels.parcel_sections(spark.createDataFrame([(None,)], "html string")).first().outbuildings == []
