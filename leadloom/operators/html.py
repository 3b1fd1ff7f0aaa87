"""Rows out of landed HTML: directory cards, search result lists, company pages, parcel and registry details.

A small tree on the standard parser runs inside Arrow batches; every extractor returns structs, and what follows
(merging pages of a site, exploding rows) is DataFrame work.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Callable
from html.parser import HTMLParser
from typing import NamedTuple
from urllib.parse import urldefrag, urljoin, urlparse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from leadloom.functions.text import EMAIL, US_PHONE
from leadloom.functions.urls import domain_discovery, tidy_url, unwrap_redirect
from leadloom.operators.records import bad_domain
from leadloom.operators.websites import business_result

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
#: Open elements that a start tag ends, as browsers do.
ENDS = {
    "li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "div": ("p",), "ul": ("p",), "table": ("p",),
}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            if node.children:
                stack.extend([c for c in reversed(node.children) if isinstance(c, Node)])

    def find_all(self, test) -> list[Node]:
        return [n for n in self.walk() if n is not self and test(n)]

    def find(self, test) -> Node | None:
        return next((n for n in self.walk() if n is not self and test(n)), None)

    def strings(self):
        stack = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            elif node.tag not in SILENT:
                stack.extend(reversed(node.children))

    def text(self, sep: str = "") -> str:
        return sep.join(filter(None, map(str.strip, self.strings())))

    def up(self, cls: str) -> Node | None:
        node = self.parent
        while node and cls not in node.classes:
            node = node.parent
        return node


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        while self.here.tag in ENDS.get(tag, ()):
            self.here = self.here.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.here
        while node and node.tag != tag:
            node = node.parent
        if node and node.parent:
            self.here = node.parent

    def handle_data(self, data):
        self.here.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def squish(s: str | None) -> str | None:
    return " ".join((s or "").split()) or None


def is_a(tag: str, *classes: str):
    return lambda n: n.tag == tag and all(c in n.classes for c in classes)


def has_class(*classes: str):
    wanted = frozenset(classes)
    return lambda n: not wanted.isdisjoint(n.classes)


# Directory cards ---------------------------------------------------------------------------------

CARD = "array<struct<raw_company_name:string,raw_address:string,raw_phone:string,raw_website:string,source_id:string,detail_url:string>>"


def _said(test) -> Callable[[Node], str | None]:
    """Text of the first element that passes, null if there is none or it says nothing."""
    return lambda n: ((found := n.find(test)) and found.text()) or None


def _leads(test) -> Callable[[Node], str | None]:
    """Where the first element that passes leads."""
    return lambda n: (found := n.find(test)) and found.attrs.get("href")


def _visit(n: Node) -> bool:
    """A link to the business's own site: it says so by its class, or is absolute and not followed by search engines."""
    href = n.attrs.get("href") if n.tag == "a" else None
    named = has_class("track-visit-website", "website-link")(n)
    return href is not None and (named or (href.startswith("http") and "nofollow" in n.attrs.get("rel", "")))


_NAME = is_a("a", "business-name")
#: What is read of a card, by part.
CARD_PARTS: dict[str, Callable[[Node], str | None]] = {
    "name": lambda card: (link := card.find(_NAME)) and (link.find(is_a("span")) or link).text(),
    "listing": lambda card: ((_leads(_NAME)(card) or "").partition("?")[0]) or None,
    "street": _said(has_class("street-address")),
    "locality": _said(has_class("locality")),
    "phone": _said(has_class("phones")),
    "site": _leads(_visit),
}


def directory_cards(html: str | None) -> list[dict]:
    """Businesses of a directory's result page, each (id, name, address) once; a page without cards gives none."""
    cards = [{part: read(card) for part, read in CARD_PARTS.items()} for card in parse(html).find_all(has_class("result", "v-card"))]
    rows = [
        {
            "raw_company_name": c["name"],
            "raw_address": ", ".join(filter(None, (c["street"], c["locality"]))) or None,
            "raw_phone": c["phone"],
            "raw_website": c["site"],
            "source_id": c["listing"],
            "detail_url": f"https://www.yellowpages.com{c['listing']}" if (c["listing"] or "").startswith("/") else None,
        }
        for c in cards
        if c["name"]
    ]
    once: dict[tuple, dict] = {}
    for r in rows:
        once.setdefault((r["source_id"], r["raw_company_name"], r["raw_address"]), r)
    return list(once.values())


def website_links(html: str | None) -> list[str]:
    """Outgoing links of a listing's detail page that may be the business's own site: those that say so, then those marked so."""
    root = parse(html)
    if "captcha" in (html or "").lower():
        return []
    links = root.find_all(lambda n: n.tag == "a" and n.attrs.get("href"))
    said = [a.attrs["href"] for a in links if a.attrs["href"].startswith("http") and "website" in a.text(" ").lower()]
    return said + [a.attrs["href"] for a in links if "track-visit-website" in a.classes]


# Review pages as lines ---------------------------------------------------------------------------

RATED = re.compile(r"^\s*(\d\.\d)\s*\((\d[\d,]*)\s+reviews?\)\s*$", re.I)
REVIEWS = re.compile(r"^\s*(\d[\d,]*)\s+reviews?\s*$", re.I)
# The address pattern, categories, and lines that are no names.
ADDRESS_LINE = re.compile(
    r"^\s*\d{1,6}\s+[A-Za-z0-9 .'\-#&]+(?:St|Street|Ave|Avenue|Rd|Road|Dr|Drive|Ln|Lane|Blvd|Boulevard|Pike|Way|Ct|Court|Cir|Circle|Pl|Place|Hwy|Highway)\b.*$", re.I
)
CATEGORIES = frozenset(
    (
        "Plumbing", "Water Heater Installation/Repair", "Water Purification Services", "Electricians", "General Contractors", "Roofing", "Property Management", "Commercial Real Estate", "Insurance",
        "Insurance Agency", "Insurance Agencies", "Real Estate Services", "Real Estate Agents",
    )
)
NO_NAME_STARTS = (
    "top 10 best", "sort:", "filters", "get pricing", "see portfolio", "yelp guaranteed", "response time", "excellent", "featured", "open now", "virtual consultations", "request a quote", "start a project",
    "write a review",
)
NO_NAMES = frozenset(
    (
        "Yelp", "Yelp for Business", "Plumbers", "Electricians", "Roofing", "General Contractors", "Home Services", "Get pricing & availability", "Emergency services", "Free estimates",
        "Locally owned & operated", "Certified professionals", "Family-owned & operated", "Veteran-owned & operated", "New on Yelp", "See Portfolio",
    )
)
LOOK_AHEAD = 13
REVIEW_ROW = "array<struct<raw_company_name:string,raw_address:string,google_reviews_rating:double,google_reviews_count:int,categories:array<string>>>"


def business_name(line: str | None) -> bool:
    v = squish(line)
    no = not v or v in NO_NAMES or v.lower().startswith(NO_NAME_STARTS) or len(v) < 3 or ADDRESS_LINE.match(v) or RATED.match(v) or REVIEWS.match(v) or v.isdigit()
    return not no


def _kind(line: str) -> str:
    """What a line of a review page says; the first kind that fits."""
    tests = {"rating": RATED.match, "reviews": REVIEWS.match, "address": ADDRESS_LINE.match, "category": CATEGORIES.__contains__, "name": business_name}
    return next((kind for kind, says in tests.items() if says(line)), "other")


def _runs(lines: list[tuple[str, str]]):
    """Stretches of tagged lines that each begin with a name and end before the next one, the line right after the name left out
    of account; a stretch has LOOK_AHEAD lines after its name at most. A category may serve as the name where none is open."""
    ends = [k for k, (kind, _) in enumerate(lines) if kind == "name"]
    opens = [k for k, (kind, v) in enumerate(lines) if kind == "name" or (kind == "category" and business_name(v))]
    at = 0
    while (o := bisect_left(opens, at)) < len(opens):
        start = opens[o]
        e = bisect_left(ends, start + 2)
        at = min([start + 1 + LOOK_AHEAD, len(lines), *ends[e : e + 1]])
        yield lines[start:at]


def _business(run: list[tuple[str, str]]) -> dict:
    """A stretch as one record: its last rating with the count beside it, else its first count; its first address; its categories."""
    said = {kind: [v for k, v in run[1:] if k == kind] for kind in ("rating", "reviews", "address", "category")}
    rated = RATED.match(said["rating"][-1]) if said["rating"] else None
    count = rated[2] if rated else REVIEWS.match(said["reviews"][0])[1] if said["reviews"] else None
    return {
        "raw_company_name": run[0][1],
        "raw_address": next(iter(said["address"]), None),
        "google_reviews_rating": float(rated[1]) if rated else None,
        "google_reviews_count": int(count.replace(",", "")) if count else None,
        "categories": said["category"],
    }


def review_rows(text: str | None, limit: int | None = 100, repeats: bool = False) -> list[dict]:
    """Businesses of a review site's page text, each (name, address) once unless ``repeats``, the first ``limit`` (None: all): a name, then up to
    LOOK_AHEAD lines of rating, address and categories; a name without a rating, address or category is no business."""
    lines = [(_kind(v), v) for v in map(squish, (text or "").splitlines()) if v]
    found = (b for b in map(_business, _runs(lines)) if b["google_reviews_rating"] is not None or b["raw_address"] is not None or b["categories"])
    once: dict[tuple, dict] = {}
    for k, b in enumerate(found):
        once.setdefault((b["raw_company_name"], b["raw_address"], k if repeats else None), b)
        if len(once) == limit:
            break
    return list(once.values())


REVIEW_COLUMNS = [("place", IntegerType()), ("raw_company_name", StringType()), ("raw_address", StringType()), ("google_reviews_rating", DoubleType()), ("google_reviews_count", IntegerType()), ("categories", ArrayType(StringType()))]


@udtf
class ReviewLines:
    """Table function over the lines of review pages: ``review_lines(TABLE(lines), 'page', 'line_no')`` gives, for each page and in the order of
    the second column, what ``review_rows`` gives for its text without a limit; with repeats where a fourth argument is true. ``lines`` has a line's text in its column ``line``. Held are the lines of one page."""

    def __init__(self):
        self.page, self.lines, self.repeats = None, [], False

    @staticmethod
    def analyze(lines: AnalyzeArgument, by: AnalyzeArgument, order: AnalyzeArgument, repeats: AnalyzeArgument = None) -> AnalyzeResult:
        page = next(f for f in lines.dataType if f.name == by.value)
        schema = StructType([StructField(by.value, page.dataType), *[StructField(n, k) for n, k in REVIEW_COLUMNS]])
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn(by.value)], orderBy=[OrderingColumn(order.value)])

    def eval(self, lines, by: str, order: str, repeats: bool = False):
        self.page, self.repeats = lines[by], repeats
        self.lines.append(lines["line"] or "")

    def terminate(self):
        for place, b in enumerate(review_rows("\n".join(self.lines), None, self.repeats)):
            yield self.page, place, *b.values()


def review_lines(lines: DataFrame, by: str, order: str, repeats: bool = False) -> DataFrame:
    """Businesses of review pages, all of each: ``by``, then REVIEW_COLUMNS, from rows ``by``, ``order`` and ``line``. A (name, address) stands once in a page unless ``repeats``."""
    lines.sparkSession.udtf.register("review_lines", ReviewLines)
    return lines.sparkSession.sql(f"SELECT * FROM review_lines(TABLE({{lines}}), '{by}', '{order}', {str(repeats).lower()})", lines=lines.select(by, order, "line"))


# Company pages -----------------------------------------------------------------------------------

SURFACE = re.compile(r"(contact|about|team|staff|leadership|management|people|careers|jobs|employment|news|press|media|blog|articles|insights)", re.I)
_EMAIL, _PHONE = re.compile(EMAIL), re.compile(US_PHONE)
SITE_PAGE = "struct<title:string,email:string,phone:string,contact_form_url:string,footer:string,links:array<string>>"


def canonical(url: str | None, base: str | None = None) -> str | None:
    """Absolute web address without fragment and query."""
    if not url:
        return None
    try:
        parsed = urlparse(urldefrag(urljoin(base, url) if base else url)[0])
    except ValueError:
        return None
    return f"{parsed.scheme}://{parsed.netloc}{parsed.path or '/'}" if parsed.scheme in ("http", "https") else None


def site_page(html: str | None, url: str | None) -> dict:
    """Contact facts of one page of a company's site; its elements are walked once, its text is read once."""
    root, base = parse(html), url or ""
    text = root.text(" ")
    email, phone = _EMAIL.search(text), _PHONE.search(text)
    digits = re.sub(r"\D", "", phone[0]) if phone else None
    parts = root.find_all(lambda n: n.tag in ("form", "footer", "title") or (n.tag == "a" and "href" in n.attrs))
    links = [(n.attrs["href"], n.text(" ")) for n in parts if n.tag == "a"]
    form, footer, title = (next((n for n in parts if n.tag == tag), None) for tag in ("form", "footer", "title"))
    form = base if form else next((urljoin(base, href) for href, says in links if re.search("contact|get in touch", says.lower())), None)
    telling = (href for href, says in links if SURFACE.search(f"{href} {says}"))
    pages = (canonical(href, base) for href in telling if not href.startswith(("mailto:", "tel:", "#", "javascript:")))
    here = urlparse(base).netloc if links else None
    inside = dict.fromkeys(page for page in pages if page and urlparse(page).netloc == here)
    return {
        "title": squish(title.text(" ")) if title else None,
        "email": email[0].lower() if email else None,
        "phone": digits[1:] if digits and len(digits) == 11 and digits[0] == "1" else digits,
        "contact_form_url": form or None,
        "footer": squish(footer.text(" ")) if footer else None,
        "links": list(inside),
    }


def merge_site(pages: DataFrame, site: str, order: str, status: str) -> DataFrame:
    """One row a site from its parsed pages (column ``page``): the first hit of each fact in page order, over pages with status 200."""
    ok = F.col(status) == 200
    first = lambda c: F.min_by(f"page.{c}", F.when(ok & F.col(f"page.{c}").isNotNull(), F.col(order))).alias(c)
    return pages.groupBy(site).agg(
        F.max_by(status, order).alias("website_status"), *[first(c) for c in ("email", "phone", "contact_form_url", "footer")], F.count_if(ok).alias("pages_read")
    )


# Search result lists ------------------------------------------------------------------------------

RESULT_LIST = "array<struct<rank:int,title:string,url:string,snippet:string>>"


class Engine(NamedTuple):
    """How an engine's page lists its results: the items, the title link of an item, its snippet, what stands for a missing one, what the rank
    counts, how many ranks there are, and whether only results that look like a business have one."""

    source: str
    item: Callable[[Node], bool]
    link: Callable[[Node], Node | None]
    snippet: Callable[[Node], Node | None]
    rank_is_place: bool
    no_snippet: str | None = None
    limit: int = 10
    businesses: bool = False


def _under(item: Node, outer, inner) -> Node | None:
    """The first descendant of ``item`` that is ``inner`` and stands in an ``outer`` of it."""
    return next((n for o in item.find_all(outer) for n in o.find_all(inner)), None)


ENGINES = {
    "bing": Engine(
        "bing_serp", is_a("li", "b_algo"), lambda n: _under(n, is_a("h2"), is_a("a")), lambda n: _under(n, has_class("b_caption"), is_a("p")), False, "", 30, True
    ),
    "brave": Engine("brave_serp", is_a("a", "result-header"), lambda n: n, lambda n: None, False),
    "ddg": Engine("duckduckgo_serp", is_a("a", "result-link"), lambda n: n, lambda n: None, True),
}


def result_list(html: str | None, engine: str, limit: int | None = None) -> list[dict]:
    """Results with a title and a link, in order, of the engine's ranks; the rank is a result's place among those kept, or for engines that
    say so among all items of the list. Of an engine that ranks businesses, all results: ``search_results`` filters, then ranks."""
    e = ENGINES[engine]
    items = [(n, e.link(n)) for n in parse(html).find_all(e.item)]
    ranked = [(k, n, a, a.text(" " if a is not n else "") if a else "") for k, (n, a) in enumerate(items, 1)]
    whole = [(k, n, a, title) for k, n, a, title in ranked if title and a.attrs.get("href")]
    ranks = [k for k, *_ in whole] if e.rank_is_place else range(1, len(whole) + 1)
    return [
        {"rank": r, "title": title, "url": a.attrs["href"], "snippet": said.text(" ") if (said := e.snippet(n)) else e.no_snippet}
        for r, (_, n, a, title) in zip(ranks, whole)
        if e.businesses or r <= (limit or e.limit)
    ]


# Parcel details ------------------------------------------------------------------------------------

NUMBER = re.compile(r"([0-9]+(?:,[0-9]{3})*)")
PARCEL = (
    "struct<links:map<string,string>,county_information:map<string,string>,owner_lines:array<string>,owner_name:string,mailing_street:string,mailing_city_state_zip:string,"
    "property_address:string,value_information:map<string,string>,subdivision_data:map<string,string>,general_information:map<string,string>,building:map<string,string>,"
    "building_facts:struct<actual_year_built:bigint,sqft_living_area:bigint,stories:double,plumbing_fixtures:bigint,building_sketch_url:string,"
    "coded:map<string,struct<raw:string,code:string,desc:string>>,areas:array<struct<area:string,sqft:bigint>>>,"
    "outbuildings:array<array<string>>,sales:array<map<string,string>>,land_summary:map<string,string>,land_rows:array<map<string,string>>,market_land_value:bigint,improvement_value:bigint,total_value:bigint>"
)


def first_number(s: str | None) -> int | None:
    m = NUMBER.search(s or "")
    return int(m[1].replace(",", "")) if m else None


def _cards(root: Node) -> dict[str | None, Node | None]:
    """The card of each header, of equal headers the first."""
    found: dict[str | None, Node | None] = {}
    for h in root.find_all(has_class("card-header")):
        if (says := squish(h.text(" "))) not in found:
            found[says] = h.up("card")
    return found


def _pairs(card: Node | None) -> dict[str, str]:
    """Label and value of "label: value" paragraphs and cells, or of a label and what stands next to it."""
    out: dict[str, str] = {}
    for n in card.find_all(lambda n: n.tag in ("p", "div", "td", "li") and not n.find(lambda c: c.tag in ("p", "div", "td", "li", "table"))) if card else []:
        label, colon, value = (squish(n.text(" ")) or "").partition(":")
        if not colon:
            continue
        if not value.strip() and n.parent:
            after = n.parent.children[n.parent.children.index(n) + 1 :]
            beside = next((c for c in after if isinstance(c, Node)), None)
            value = beside.text(" ") if beside else ""
        out.setdefault(label.strip(), value.strip())
    return out


def _table(card: Node | None) -> list[dict[str, str]]:
    rows = card.find_all(lambda n: n.tag == "tr") if card else []
    cells = [[squish(c.text(" ")) or "" for c in r.find_all(lambda n: n.tag in ("td", "th"))] for r in rows]
    cells = [c for c in cells if c]
    return [dict(zip(cells[0], c)) for c in cells[1:]]


def _value(pairs: dict[str, str], *words: str) -> int | None:
    return next((first_number(v) for k, v in pairs.items() if all(w in k.lower() for w in words)), None)


# The county's address, and the labels of building facts.
PARCEL_SITE = "https://assessment.cot.tn.gov"
CODED = {
    "roof_framing": "Roof Framing", "foundation": "Foundation", "heat_and_ac": "Heat and AC", "quality": "Quality", "condition": "Condition", "roof_cover_deck": "Roof Cover/Deck",
    "exterior_wall": "Exterior Wall",
}


def _coded(value: str | None) -> dict:
    """"8 - HEAT AND COOLING" as code and description; without a dash all is description."""
    raw = squish(value)
    code, dash, desc = (raw or "").partition(" - ")
    return {"raw": raw, "code": code or None, "desc": desc or None} if dash else {"raw": raw, "code": None, "desc": raw}


def _building(card: Node | None) -> tuple[dict[str, str], dict | None]:
    """Labelled values of a building card, and its typed facts; a page without the card has no facts."""
    if card is None:
        return {}, None
    raw = _pairs(card)
    tables = [_table(t) for t in card.find_all(is_a("table", "table"))]
    areas = next((t for t in tables if t and {"Areas", "Square Feet"} <= set(t[0])), [])
    sketch = card.find(is_a("img", "buildingSketch"))
    number = re.match(r"\d+(\.\d*)?(?=\s|$)", raw.get("Stories") or "")
    return raw, {
        "actual_year_built": first_number(raw.get("Actual Year Built")),
        "sqft_living_area": first_number(raw.get("Square Feet of Living Area")),
        "stories": float(number[0]) if number else None,
        "plumbing_fixtures": first_number(raw.get("Plumbing Fixtures")),
        "building_sketch_url": (sketch.attrs.get("src") or None) if sketch else None,
        "coded": {field: _coded(raw.get(label)) for field, label in CODED.items()},
        "areas": [{"area": v[0], "sqft": first_number(v[1])} for v in (list(r.values()) for r in areas) if len(v) >= 2],
    }


def parcel_details(html: str | None) -> dict:
    """Sections of a county's parcel page."""
    return _details(parse(html))


def _details(root: Node) -> dict:
    cards = _cards(root)
    hrefs = [a.attrs["href"] for a in root.find_all(lambda n: n.tag == "a" and "href" in n.attrs)]
    href = lambda part: next((h for h in hrefs if part in h), None)
    links = {"pdf_path": href("/Parcel/PrintPDF"), "gis_url": href("/assessment/#/parcel/"), "search_back_path": href("/Search?serializedParameters=")}
    absolute = {part + "_url": PARCEL_SITE + p if p.startswith("/") else p for part in ("pdf", "search_back") if (p := links[part + "_path"])}
    owner = cards.get("Property Owner and Mailing Address")
    said = [squish(c.text(" ")) for body in owner.find_all(has_class("card-body")) for c in body.find_all(has_class("col"))] if owner else []
    lines = [x for x in said if x and not x.lower().startswith("january 1 owner")]
    building, building_facts = _building(cards.get("Building Information - Residential"))
    location = _pairs(cards.get("Property Location"))
    values, land = _pairs(cards.get("Value Information")), cards.get("Land Information")
    outbuildings = [list(r.values()) for r in _table(cards.get("Outbuildings & Yard Items")) if len(r) >= 4]
    sales = [r | ({"Price_num": str(n)} if (n := first_number(r.get("Price"))) is not None else {}) for r in _table(cards.get("Sale Information"))]
    return {
        "links": {k: v for k, v in (links | absolute).items() if v},
        "county_information": _pairs(cards.get("County Information")),
        "owner_lines": lines,
        "owner_name": lines[0] if lines else None,
        "mailing_street": lines[1] if len(lines) > 1 else None,
        "mailing_city_state_zip": lines[2] if len(lines) > 2 else None,
        "property_address": next((v for k, v in location.items() if k.lower() == "address"), None),
        "value_information": values,
        "subdivision_data": _pairs(cards.get("Subdivision Data")),
        "general_information": _pairs(cards.get("General Information")),
        "building": building,
        "building_facts": building_facts,
        "outbuildings": outbuildings,
        "sales": sales,
        "land_summary": _pairs(land),
        "land_rows": _table(land),
        "market_land_value": _value(values, "land"),
        "improvement_value": _value(values, "improvement"),
        "total_value": _value(values, "total"),
    }


def parcel_heading(html: str | None) -> dict:
    """The page's title, and its line of county and tax year."""
    return _heading(parse(html))


def _heading(root: Node) -> dict:
    title, line = root.find(is_a("title")), root.find(has_class("parcel-county-and-tax-year"))
    return {"title": squish(title.text(" ")) if title else None, "county_tax_year": squish(line.text(" ")) if line else None}


def stable_hash(value) -> str:
    """SHA-256 of a value's JSON with sorted keys and without blanks."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


# Registry and bureau details ----------------------------------------------------------------------

#: Fields of a state registry's detail page by the label before the colon.
REGISTRY_LABELS = {"entity type": "entity_type", "status": "business_status", "control number": "control_number", "initial filing date": "business_start_date"}
REGISTRY = (
    "struct<source_status:string,matched_name:string,entity_type:string,business_status:string,control_number:string,business_start_date:string,registered_agent:string,principal_address:string>"
)
_COLUMN = has_class("col-md-4", "col-md-6")


def registry_details(html: str | None) -> dict:
    """A company's facts on a state registry's page: labelled headings, and the columns of agent and principal address; its section is walked once, then its columns."""
    names = ("matched_name", *REGISTRY_LABELS.values(), "registered_agent", "principal_address")
    out: dict = {"source_status": "parsed"} | dict.fromkeys(names)
    root = parse(html).find(lambda n: n.attrs.get("id") == "business-details")
    if root is None:
        return out | {"source_status": "details_not_found"}
    parts = root.find_all(lambda n: n.tag in ("h2", "h4") or _COLUMN(n))
    said = {tag: {n: v for n in parts if n.tag == tag and (v := squish(n.text(" ")))} for tag in ("h2", "h4")}
    out["matched_name"] = next(iter(said["h2"].values()), None)
    for line in said["h4"].values():
        label, colon, value = line.partition(":")
        field = REGISTRY_LABELS.get(label.strip().lower())
        if colon and field and value.strip():
            out[field] = value.strip()
    for column in filter(_COLUMN, parts):
        lines = [said["h4"][n] for n in column.find_all(said["h4"].__contains__)]
        field = {"registered agent": "registered_agent", "principal office address": "principal_address"}.get(lines[0].lower()) if lines else None
        if field:
            out[field] = ", ".join(x for x in lines[1:] if x.lower() != lines[0].lower()) or None
    if not any(out[f] for f in REGISTRY_LABELS.values()):
        out["source_status"] = "detail_fields_missing"
    return out


BUREAU = "struct<accredited:boolean,rating:string,complaints:int>"


def bureau_profile(html: str | None) -> dict:
    """Accreditation, letter grade and complaints of a review bureau's profile page."""
    root = parse(html)
    says = lambda tag, word: next((t for n in root.find_all(lambda n: n.tag == tag) if word in (t := n.text(" ")).lower()), None)
    grade = root.find(lambda n: n.tag == "span" and "LetterGrade" in n.attrs.get("class", ""))
    count = re.search(r"\d+", says("p", "complaints") or "")
    return {"accredited": bool(says("span", "accredited")), "rating": squish(grade.text()) if grade else None, "complaints": int(count[0]) if count else None}


# In Spark -----------------------------------------------------------------------------------------


def extract(extractor, schema: str, *columns: Column) -> Column:
    """``extractor`` of the columns, shipped in Arrow batches, as a column of type ``schema``."""
    return F.udf(extractor, schema, useArrow=True)(*columns)


def site_pages(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Adds ``page``, the contact facts of each landed page of a company's site."""
    return pages.withColumn("page", extract(site_page, SITE_PAGE, F.col(html), F.col(url)))


def directory_records(pages: DataFrame, html: str = "html", industry: str = "industry") -> DataFrame:
    """One raw record for each card of landed directory pages; each (id, name, address, industry) of a page once."""
    cards = pages.withColumn("card", F.explode(extract(directory_cards, CARD, F.col(html))))
    return cards.select(*[c for c in pages.columns if c != html], F.lit("yellowpages").alias("source"), "card.*")


def review_records(pages: DataFrame, text: str = "text") -> DataFrame:
    """One raw record for each business on landed review pages, given as text."""
    rows = pages.withColumn("row", F.explode(extract(review_rows, REVIEW_ROW, F.col(text))))
    return rows.select(*[c for c in pages.columns if c != text], F.lit("yelp").alias("source"), "row.*")


def search_results(pages: DataFrame, engine: str, html: str = "html") -> DataFrame:
    """One row for each result of landed search pages of ``engine``: its rank, title, url and snippet. Where only businesses count, the others
    go first, then the rest are ranked within their page and cut."""
    e = ENGINES[engine]
    rows = pages.withColumn("hits", extract(lambda h: result_list(h, engine), RESULT_LIST, F.col(html)))
    hits = F.col("hits")
    if e.businesses:
        kept = F.slice(F.filter(hits, lambda h: business_result(h["title"], h["url"], h["snippet"])), 1, e.limit)
        hits = F.transform(kept, lambda h, k: h.withField("rank", (k + 1).cast("int")))
    rows = rows.withColumn("hit", F.explode(hits))
    return rows.select(*[c for c in pages.columns if c != html], F.lit(e.source).alias("source"), "hit.*")


def detail_websites(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``key`` and ``detail_website``: the first link of each landed detail page that leads to no directory or social site."""
    links = pages.select(key, F.posexplode(extract(website_links, "array<string>", F.col(html))).alias("place", "link"))
    links = links.withColumn("link", unwrap_redirect(F.col("link"))).withColumn("link", tidy_url(F.col("link")))
    usable = F.when(~bad_domain(domain_discovery(F.col("link"))), F.col("place"))
    return links.groupBy(key).agg(F.min_by("link", usable).alias("detail_website"))


def registry_records(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without their text, with the facts of a state registry's detail page."""
    return _facts(pages, html, registry_details, REGISTRY)


def bureau_records(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without their text, with accreditation, grade and complaints of a review bureau's profile."""
    return _facts(pages, html, bureau_profile, BUREAU)


def _facts(pages: DataFrame, html: str, read: Callable, kind: str) -> DataFrame:
    found = pages.withColumn("_facts", extract(read, kind, F.col(html)))
    return found.select(*[F.col(f"`{c}`") for c in pages.columns if c != html], "_facts.*")


def parcel_records(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``details``, the sections of a parcel page, and ``detail_hash``, by which a change shows."""
    return parcel_pages(pages, html).select(*[F.col(f"`{c}`") for c in pages.columns], "_parcel.details", "_parcel.detail_hash")


def parcel_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``_parcel``: the details of a parcel page, their hash, and what the page says of itself."""
    read = lambda h: {"details": (d := _details(root := parse(h))), "detail_hash": stable_hash(d), "page": _heading(root)}
    kind = f"struct<details:{PARCEL},detail_hash:string,page:struct<title:string,county_tax_year:string>>"
    return pages.withColumn("_parcel", extract(read, kind, F.col(html)))
