import pytest
from pyspark.sql import functions as F

from leadloom.functions import nested, similarity, text, urls


def _each(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (urls.domain_resolver, {"www.a.com/x": "a.com", "httpbin.org": None, "https://A.com:8080": "a.com", "": None, "http://u:p@www.B.org/?q": "b.org"}),
        (urls.domain_discovery, {"e.com/x": None, "https://www.e.com:81/": "e.com:81", " E.com ": "e.com", "": None}),
        (urls.domain_expansion, {"www.e.com/x": "e.com", "https://M.www.e.com:81/": "m.www.e.com", " ": None}),
        (urls.unwrap_redirect, {"https://r.x/?u=https%3A%2F%2Fb.com": "https://b.com", "https://r.x/?q=1": "https://r.x/?q=1", "https://r/?url=a%252Fb": "a/b"}),
        (urls.without_query, {"a?b": "a", "a": "a"}),
        (urls.listing_url, {"/mip/1": "https://www.yellowpages.com/mip/1", "x": None}),
        (text.phone_lax, {"+1 (555) 010-1234": "5550101234", "555-0101": None}),
        (text.phone_resolver, {"+1 (555) 010-1234": "15550101234", "12": None}),
        (text.phone_expansion, {"call 1-865-555-0101 now": "8655550101", "865555010": None}),
        (text.name_resolver, {"Blue Collar LLC": "bluellar", "X Company": "xmpany", "": None}),
        (text.name_canonical, {"Acme, Roofing Co.": "acme roofing", None: ""}),
        (text.name_bbb, {"A&B  Co.": "ab co"}),
        (text.squish, {" a \n b ": "a b", "\t": None}),
        (text.first_email, {"x A.b@C.org, d@e.fr": "a.b@c.org", "none": None}),
        (text.money, {"$ 1,234.00": 1234, "x": None}),
        (text.first_int, {"about 1,940 sq": 1940, "": None}),
        (text.truthy, {"Yes": True, "0": False, "x": False}),
        (text.safe_int, {"12": 12, "12.5": None, " 7 ": 7}),
        (text.metric_int, {"12.9": 12, "x": 0, None: 0}),
    ],
)
def test_cases(spark, f, cases):
    assert _each(spark, f, list(cases)) == list(cases.values())


def test_address(spark):
    a = _each(spark, text.address, ["123 N Main St, Townsville, TN 37000", "11020 Pike Rd,, Townsville", None])
    assert (a[0].mailing_street, a[0].mailing_city, a[0].mailing_state, a[0].mailing_zip) == ("123 N Main St", "Townsville", "ST", "37000")
    assert (a[1].mailing_city, a[1].mailing_zip, a[2].mailing_address) == ("Townsville", "11020", None)


def test_likeness(spark):
    rows = spark.createDataFrame([("Acme Roofing LLC", "Acme Roofing Experts", "b a", "a  b"), ("x", "", None, "a")], "a string, b string, c string, d string")
    got = rows.select(similarity.token_overlap(F.col("a"), F.col("b")).alias("o"), similarity.token_sort_ratio(F.col("c"), F.col("d")).alias("r")).collect()
    assert [r.o for r in got] == [100, 0] and got[0].r == 100.0 and got[1].r is None
    assert similarity.common_length("abcde", "ace") == 3 and similarity.common_length("", "a") == 0


def test_rates(spark):
    rows = spark.createDataFrame([(23, 140), (1, 0)], "n int, d int")
    assert [r[0] for r in rows.select(text.safe_rate(F.col("n"), F.col("d"))).collect()] == [0.1643, 0.0]


def test_nested_values(spark):
    docs = ['{"a": {"b": 3}}', '{"a": {"b": null}}', '{"a": {}}', '{"a": 1}', "no json", None]
    assert _each(spark, lambda v: nested.nested(v, "a.b", "int", 9), docs) == [3, None, 9, None, None, None]
    assert _each(spark, lambda v: nested.nested(v, "a.b"), docs)[:3] == ["3", None, None]
