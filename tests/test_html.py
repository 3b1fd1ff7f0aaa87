from pyspark.sql import functions as F

from leadloom.operators import html, records

PAGE = """<html><title>Acme | Home</title><body><a href="/about-us?x=1">About</a><a href="mailto:a@b.co">mail</a><a href="https://other.com/team">Team</a>
<p>Call 1 (865) 555-0101 or write Info@Acme.com<br><a href="/reach">Get in Touch</a><script>var x='no@script.com'</script><footer> 1 Main  St </footer>"""


def test_site_page():
    got = html.site_page(PAGE, "https://acme.com/")
    assert got == {
        "title": "Acme | Home", "email": "info@acme.com", "phone": "8655550101", "contact_form_url": "https://acme.com/reach", "footer": "1 Main St", "links": ["https://acme.com/about-us"]
    }
    assert html.site_page("<form></form>", "https://a.com/c")["contact_form_url"] == "https://a.com/c"
    assert html.site_page(None, None) == {"title": None, "email": None, "phone": None, "contact_form_url": None, "footer": None, "links": []}


def test_sites_merge_the_first_hits(spark):
    rows = [("s", 1, 404, "x@bad.com"), ("s", 2, 200, "nothing"), ("s", 3, 200, "b@c.de"), ("s", 4, 200, "later@c.de")]
    pages = spark.createDataFrame(rows, "site string, ord int, status int, html string").withColumn("url", F.lit("https://s/"))
    got = html.merge_site(html.site_pages(pages), "site", "ord", "status").first()
    assert (got.email, got.pages_read, got.website_status, got.phone) == ("b@c.de", 3, 200, None)


CARDS = """<div class="result"><a class="business-name" href="/mip/1?x"><span>One</span></a><div class="street-address">1 Main</div><div class="locality">Town, TN</div><div class="phones">555</div>
<a class="track-visit-website" href="http://one.com">Website</a></div><div class="v-card"><a class="business-name" href="/mip/1?y">One</a><div class="street-address">1 Main</div><div class="locality">Town, TN</div></div>
<div class="result"><a class="business-name" href="x">Two</a></div><div class="result"><p>no name</p></div>"""


def test_directory_cards(spark):
    rows = html.directory_cards(CARDS)
    assert [r["raw_company_name"] for r in rows] == ["One", "Two"]
    assert rows[0] == {
        "raw_company_name": "One", "raw_address": "1 Main, Town, TN", "raw_phone": "555", "raw_website": "http://one.com", "source_id": "/mip/1", "detail_url": "https://www.yellowpages.com/mip/1"
    }
    assert rows[1]["detail_url"] is None and html.directory_cards("<h1>captcha</h1>") == [] == html.directory_cards(None)
    df = spark.createDataFrame([(CARDS, "hoa"), ("captcha", "x")], "html string, industry string")
    assert html.directory_records(df).count() == 2


def test_review_rows(spark):
    text = "Sort: best\nAcme Plumbing\n4.5 (1,200 reviews)\nPlumbing\n12 Main Street Knoxville\nOther Co\n\nThird One\n30 reviews\nRoofing\nYelp"
    rows = html.review_rows(text)
    assert [r["raw_company_name"] for r in rows] == ["Acme Plumbing", "Other Co"]  # the line after a name never ends its look-ahead
    assert rows[1]["google_reviews_count"] == 30
    assert (rows[0]["google_reviews_rating"], rows[0]["google_reviews_count"], rows[0]["categories"]) == (4.5, 1200, ["Plumbing"])
    assert rows[0]["raw_address"] == "12 Main Street Knoxville"
    assert html.review_rows(None) == [] and not html.business_name("12") and html.business_name("Abc Co")
    assert html.review_records(spark.createDataFrame([(1, text)], "id int, text string")).count() == len(rows)


def test_result_lists(spark):
    bing = '<ol><li class="b_algo"><h2><a href="http://a.com">A</a></h2><p>date</p><div class="b_caption"><p>said</p></div></li><li class="b_algo"><h2></h2></li><li class="b_algo"><h2><a href="http://b.com">B</a></h2></li></ol>'
    assert [(r["rank"], r["title"], r["snippet"]) for r in html.result_list(bing, "bing")] == [(1, "A", "said"), (2, "B", "")]
    ddg = '<table><tr><td><a class="result-link" href="u"><b>A</b> x</a></td></tr><tr><td><a class="result-link"></a><a class="result-link" href="v">B</a><a href="w">no</a></td></tr></table>'
    assert [(r["rank"], r["title"], r["url"]) for r in html.result_list(ddg, "ddg")] == [(1, "Ax", "u"), (3, "B", "v")]
    assert [r["rank"] for r in html.result_list(ddg, "ddg", 2)] == [1]
    brave = '<div class="snippet"><a class="result-header" href="u"><span>A</span></a><a href="w">no</a></div><a class="result-header" href="">C</a><a class="x result-header" href="v">B</a>'
    assert [(r["rank"], r["title"], r["url"]) for r in html.result_list(brave, "brave")] == [(1, "A", "u"), (2, "B", "v")]
    pages = spark.createDataFrame([(ddg,), (None,)], "html string")
    assert [r.source for r in html.search_results(pages, "ddg").collect()] == ["duckduckgo_serp"] * 2
    assert html.search_results(spark.createDataFrame([(bing,)], "html string"), "bing").count() == 2


PARCEL = """<div class="card"><div class="card-header">Property Owner and Mailing Address</div><div class="card-body"><div class="row"><div class="col">January 1 Owner</div></div><div class="col">DOE  JANE</div><p>aside</p><div class="col">12 OAK ST</div><div class="col">TOWN, TN 37000</div></div></div>
<div class="card"><div class="card-header">Property Location</div><p>Address: 12 Oak St</p></div>
<div class="card"><div class="card-header">Value Information</div><div><span>x</span></div><p>Land Market Value:</p><p>$10,500</p><p>Improvement Value: $90,000</p><p>Total Market Appraisal: $100,500</p></div>
<div class="card"><div class="card-header">Sale Information</div><table><tr><th>Sale Date</th><th>Price</th></tr><tr><td>1/2/2020</td><td>$1,940</td></tr></table></div>
<div class="card"><div class="card-header">Building Information - Residential</div><div class="card-body"><p class="detailsPage"><strong>Actual Year Built:</strong> 1940</p><p class="detailsPage"><strong>Square Feet of Living Area:</strong> 1,200</p><p class="detailsPage"><strong>Stories:</strong> 1.5 STORY</p><p class="detailsPage"><strong>Heat and AC:</strong> 8 - HEAT AND COOLING PKG</p><p class="detailsPage"><strong>Quality:</strong> AVERAGE</p><table class="table"><thead><tr><th>Areas</th><th>Square Feet</th></tr></thead><tbody><tr><td>BASE</td><td>1,000</td></tr></tbody></table><img class="buildingSketch" src="/s.png"></div></div>
<a class="pdf-button" href="/x/Parcel/PrintPDF/1">pdf</a>"""


def test_pages_of_one_file_are_parsed_in_many_tasks(spark, tmp_path):
    from leadloom.plans import pages, tables

    spark.range(400).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "int(id % 5) AS c_nationkey", "'X' AS c_mktsegment").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    for q in (tables.parcel_sections, pages.registry_records, pages.bureau_records, lambda *a: pages.site_contact_merge(*a).select("site")):
        plan = q(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" in plan
    tasks = tables.parcel_sections(spark, str(tmp_path)).select("parcel", F.spark_partition_id().alias("t"))
    assert tasks.count() == 400 and tasks.select("t").distinct().count() > 4


def test_a_parcel_page_is_parsed_once(spark, monkeypatch):
    asked, parse = [], html.parse
    monkeypatch.setattr(html, "parse", lambda h: asked.append(h) or parse(h))
    html.parcel_details(PARCEL)
    assert len(asked) == 1 and html._cards(parse("<div class='card'><p class='card-header'>A</p></div><p class='card-header'>A</p>"))["A"].tag == "div"


def test_a_registry_section_is_walked_once_and_then_its_columns(monkeypatch):
    walked, walk = [], html.Node.walk
    monkeypatch.setattr(html.Node, "walk", lambda n: walked.append(n) or walk(n))
    page = """<p>x</p><div id="business-details" class="col-md-4"><h4>Status: Old</h4><h2> </h2><h2>A  Co</h2><div class="col-md-6"><h4>Principal Office Address</h4><h4>1 Main</h4><h4> </h4><h4 class="col-md-4">PRINCIPAL OFFICE ADDRESS</h4>
<div class="col-md-4"><h4>Registered Agent</h4><h4>J  Doe</h4></div></div><h4>Status: New</h4></div>"""
    got = html.registry_details(page)
    assert (got["matched_name"], got["business_status"], got["registered_agent"]) == ("A Co", "New", "J Doe")
    assert got["principal_address"] == "1 Main, Registered Agent, J Doe"
    assert len(walked) == 2 + 3  # the page for its section, the section, its columns


def test_a_site_page_is_walked_once(monkeypatch):
    walked, walk = [], html.Node.walk
    monkeypatch.setattr(html.Node, "walk", lambda n: walked.append(n) or walk(n))
    assert html.site_page(PAGE, "https://acme.com/")["contact_form_url"] == "https://acme.com/reach" and len(walked) == 1


def test_stored_pages_are_dealt_out_before_parsing(spark, tmp_path):
    from leadloom.plans import catalog

    spark.range(400).selectExpr("id AS page_id", "concat('https://s', id % 7, '.com/') AS url", "concat('<footer>F', id, '</footer>') AS html").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    pages = catalog.site_pages(spark, str(tmp_path)).withColumn("t", F.spark_partition_id())
    assert pages.count() == 400 and pages.select("t").distinct().count() > 4 and pages.where("footer = concat('F', page_id)").count() == 400
    sites = catalog.site_contacts(spark, str(tmp_path))
    assert "Repartition" in sites._jdf.queryExecution().optimizedPlan().toString() and sites.where("pages_read > 56").count() == 7


def test_parcel_details(spark):
    got = html.parcel_details(PARCEL)
    assert (got["owner_name"], got["mailing_street"], got["mailing_city_state_zip"]) == ("DOE JANE", "12 OAK ST", "TOWN, TN 37000")
    assert got["property_address"] == "12 Oak St" and got["links"] == {"pdf_path": "/x/Parcel/PrintPDF/1", "pdf_url": "https://assessment.cot.tn.gov/x/Parcel/PrintPDF/1"}
    assert (got["market_land_value"], got["improvement_value"], got["total_value"]) == (10_500, 90_000, 100_500)
    assert got["sales"] == [{"Sale Date": "1/2/2020", "Price": "$1,940", "Price_num": "1940"}]
    facts = got["building_facts"]
    assert (facts["actual_year_built"], facts["sqft_living_area"], facts["stories"], facts["building_sketch_url"]) == (1940, 1200, 1.5, "/s.png")
    assert facts["coded"]["heat_and_ac"] == {"raw": "8 - HEAT AND COOLING PKG", "code": "8", "desc": "HEAT AND COOLING PKG"} and facts["coded"]["quality"]["desc"] == "AVERAGE"
    assert facts["areas"] == [{"area": "BASE", "sqft": 1000}] and facts["coded"]["condition"]["raw"] is None and html.parcel_details("")["building_facts"] is None
    row = html.parcel_records(spark.createDataFrame([(PARCEL,), (None,)], "html string")).collect()
    assert row[0].details.total_value == 100_500 and row[0].detail_hash != row[1].detail_hash
    assert html.stable_hash({"b": 1, "a": "é"}) == html.stable_hash({"a": "é", "b": 1})


def test_canonical_address():
    assert html.canonical("../x?q=1#f", "https://a.com/b/c") == "https://a.com/x"
    assert html.canonical("mailto:x@y.z", "https://a.com") is None and html.canonical("https://a.com") == "https://a.com/"


def test_registry_and_bureau(spark):
    page = """<div id="business-details"><h2>Acme  LLC</h2><h4>Entity Type: LLC</h4><h4>Status: Active</h4><div class="col-md-4"><h4>Registered Agent</h4><h4>Jane Doe</h4><h4>1 Main St</h4></div></div>"""
    got = html.registry_details(page)
    assert (got["matched_name"], got["entity_type"], got["business_status"], got["registered_agent"], got["source_status"]) == ("Acme LLC", "LLC", "Active", "Jane Doe, 1 Main St", "parsed")
    assert html.registry_details("<p>x</p>")["source_status"] == "details_not_found" and html.registry_details("<div id=business-details></div>")["source_status"] == "detail_fields_missing"
    bureau = html.bureau_profile("<span>BBB Accredited</span><span class='x LetterGrade'>A+</span><p>12 complaints closed</p>")
    assert bureau == {"accredited": True, "rating": "A+", "complaints": 12} and html.bureau_profile(None) == {"accredited": False, "rating": None, "complaints": None}
    df = spark.createDataFrame([(page,)], "html string").select(html.extract(html.registry_details, html.REGISTRY, F.col("html")).alias("r"), html.extract(html.bureau_profile, html.BUREAU, F.col("html")).alias("b"))
    assert df.first().r.entity_type == "LLC" and df.first().b.accredited is False


def test_detail_websites(spark):
    page = "<a href='https://www.facebook.com/x'>Visit website</a><a href='https://r.co/?url=https%3A%2F%2Fown.com%2F'>Website</a><a class='track-visit-website' href='http://late.com'>go</a>"
    pages = spark.createDataFrame([(1, page), (2, "<a href='http://x.com'>home</a>"), (3, "captcha" + page), (4, None)], "id int, html string")
    assert {r.id: r.detail_website for r in html.detail_websites(pages, "id").collect()} == {1: "https://own.com/"}
    both = pages.join(html.detail_websites(pages, "id"), "id", "left").withColumn("raw_website", F.when(F.col("id") == 2, "card.com"))
    got = {r.id: (r.website, r.method, r.confidence) for r in records.discovered_websites(both, detail_website="detail_website").collect()}
    assert got == {1: ("https://own.com/", "yp_detail", 0.7), 2: ("https://card.com", "yp_card", 0.8), 3: (None, "none", 0.0), 4: (None, "none", 0.0)}
