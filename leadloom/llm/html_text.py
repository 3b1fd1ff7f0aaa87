"""Main text of web pages by consensus paths of hosts.

Each page scores its containers: the lowest one that holds all its headings and prose takes the page's vote. The pages of
a host vote on the generalised tag-class paths of those containers, summed in Spark; then each page is read again with
the path that won its host. A page whose prose does not lie mostly there, or that has a title elsewhere, is read
under its own best container, so that no article text is lost to the majority.

What goes: elements of menus, footers, asides and forms, headers outside of the article, raw text elements such as scripts, hidden
elements, and elements whose class, id or role marks them, as a whole token or as a compound of mark words and
mere words of layout ("share-box", not "ad-note"). Ids of headings, paragraphs and of sections in an article are anchors
and mark nothing, but for those of reader comments.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize, table

# Element kinds of HTML.
CONTAINERS = frozenset("html body main article section div td center blockquote details figure".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption pre hr address figcaption header footer nav aside form fieldset legend summary menu dialog".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "template", "noscript", "iframe", "object", "svg", "textarea", "title", "select", "canvas", "audio", "video")
NEVER = frozenset("nav footer aside form menu dialog button fieldset head".split())
# Words of a class, id or role that mark what is not the article.
MARKS = frozenset(
    "nav navbar navigation menu sidebar side ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup share sharing social related recommended recommendations comment comments commentlist reply replies respond disqus footer header masthead breadcrumb "
    "breadcrumbs pagination pager widget toolbar login search skip copyright complementary contentinfo tags adsbygoogle outbrain taboola".split()
)
# Words that say nothing beside a mark in a compound name.
LAYOUT = frozenset(
    "area article articles bar block body bottom box btn bundle button buttons center col column container content desktop entry foot form global group head holder icon icons inner item items layer layout left link "
    "links list lists main message mobile module nested outer page panel placeholder post posts primary region right row secondary section site slot stories story text thread title top unit user wrap wrapper zone".split()
)
# Words that make a header the article's own, and names of reader comments.
TITLED, COMMENTS = frozenset("article post entry story content page main title".split()), frozenset("comment comments commentlist respond disqus replies".split())
# Names of what holds an article, where a header is the article's own.
HOLDERS = frozenset("content main main-content post article entry story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Ids of these are anchors: they mark nothing.
ANCHORS = HEADINGS | frozenset("p li dt dd ul ol dl table tr td th blockquote figure pre a span".split())
#: An article element is taken alone if it holds this share of the prose and no title lies beside it.
ARTICLE_SHARE = 0.8
#: The host's path is used on a page where it holds this share of the prose.
PATH_SHARE = 0.6
#: Bytes of hosts and paths that are broadcast; beyond it the join shuffles, each host dealt to SALTS tasks.
MAX_BROADCAST_BYTES, SALTS = 32 << 20, 32

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^'\"<>])*+)>"
    # Broken quotes: up to the next ">"; at the end of the page only what has begun an attribute. Any other "<" is text.
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/<>]*)(?P<attrs2>[^<>]*>|\s[^<>]*=[^<>]*\Z)|</[a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
_ATTR = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)}


def _marked(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if attrs.get("aria-hidden") == "true" or ("style" in attrs and _HIDDEN.search(attrs["style"])):
        return True
    own_id = attrs.get("id", "")
    if own_id and (tag in ANCHORS or (in_article and tag == "section" and own_id.lower() not in COMMENTS)):
        own_id = ""
    names = [*attrs.get("class", "").split(), own_id, attrs.get("role", "")]
    return any(_mark(name) for name in names if name)


def _mark(name: str) -> bool:
    """Whether a class, id or role marks what is not the article: "sidebar" and "post-comments" do, "has-sidebar" and "post-header" do not."""
    words = {part for w in _NAME_PART.findall(name) if len(w) > 1 for part in _cut(w.lower())}
    found = words & MARKS
    if found == {"header"} and words & TITLED:
        return False
    return bool(found) and words <= MARKS | LAYOUT


def _cut(word: str) -> tuple[str, ...]:
    """A word, or the two of layout or of a mark that are joined in it ("cookiebar")."""
    known = MARKS | LAYOUT
    if word in known or len(word) < 6:
        return (word,)
    return next(((word[:k], word[k:]) for k in range(3, len(word) - 2) if word[:k] in known and word[k:] in known), (word,))


class Page:
    """Containers (parent, path, is it an article) and text blocks (container, text, weight, is it a title) in page order.

    A path is a number: containers of one parent path and one generalised name share it. Time and memory are linear in the page.

    The weight of a block is its characters outside links if they are its greater part (prose), all of them for a heading, else 0."""

    def __init__(self, html: str):
        for self.marks in (True, False):  # a page that is nothing but marked elements is read without minding the marks
            self.parent, self.path, self.article, self.holder = [-1], [0], [False], [False]
            self.paths: dict[tuple[int, str], int] = {}
            self.blocks: list[tuple[int, str, int, bool]] = []
            self.marked = False
            self._read(html)
            if self.blocks or not self.marked:
                break

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, str]] = [("", 0, "")]  # tag, container, tag of what excludes it
        opened: dict[str, int] = {}
        parts: list[str] = []
        state = {"linked": 0, "in_link": False, "heading": ""}

        def flush() -> None:
            text = "".join(parts)
            if text and not text.isspace():
                text = " ".join((unescape(text) if "&" in text else text).split())
                if text:
                    plain = max(0, len(text) - state["linked"])
                    prose = len(text) if state["heading"] else plain if 2 * plain >= len(text) else 0
                    self.blocks.append((stack[-1][1], text, prose, state["heading"] == "h1"))
            parts.clear()
            state["linked"] = 0

        def words(chunk: str) -> None:
            if not stack[-1][2]:
                parts.append(chunk)
                if state["in_link"]:
                    state["linked"] += len(chunk)

        at = 0
        for m in _TOKEN.finditer(html):
            if m.start() > at:
                words(html[at : m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if tag is None:
                continue
            tag, closing = tag.lower(), bool(m["end"] or m["end2"])
            if tag in BLOCKS:
                flush()
            elif tag == "br":
                words(" ")
            if tag == "a":
                state["in_link"] = not closing
            elif tag in HEADINGS:
                state["heading"] = "" if closing else tag
            elif tag in BLOCKS:
                state["heading"] = ""
            if closing:
                self._close(stack, opened, tag)
            elif tag not in VOID:
                self._open(stack, opened, tag, m["attrs"] or m["attrs2"] or "", flush)
        if at < len(html):
            words(html[at:])
        flush()

    def _open(self, stack: list, opened: dict, tag: str, raw: str, flush) -> None:
        def push(container: int, excluded: str) -> None:
            stack.append((tag, container, excluded))
            opened[tag] = opened.get(tag, 0) + 1

        if tag in BLOCKS and stack[-1][0] == "p":
            stack.pop()
            opened["p"] -= 1
        _, container, excluded = stack[-1]
        if excluded:
            if tag == excluded:
                push(container, excluded)
            return
        attrs = _attributes(raw) if "=" in raw else {}
        own = tag in ("html", "body", "main", "article")
        in_article = self.holder[container]
        marked = self.marks and not own and bool(attrs) and _marked(tag, attrs, in_article)
        self.marked |= marked
        if marked or tag in NEVER or "hidden" in raw.split() or (tag == "header" and not in_article):
            flush()
            push(container, tag)
        elif tag in CONTAINERS:
            kinds = sorted(_DIGITS.sub("#", c).replace(">", "#") for c in attrs.get("class", "").split())
            article = tag == "article" or "articleBody" in attrs.get("itemprop", "")
            named = tag not in ("html", "body") and {*attrs.get("class", "").lower().split(), attrs.get("id", "").lower()} & HOLDERS
            self.parent.append(container)
            self.path.append(self.paths.setdefault((self.path[container], ".".join([tag, *kinds])), len(self.paths) + 1))
            self.article.append(article)
            self.holder.append(in_article or article or tag == "main" or bool(named) or attrs.get("role") == "main")
            push(len(self.path) - 1, "")

    def _close(self, stack: list, opened: dict, tag: str) -> None:
        if not opened.get(tag) or (stack[-1][2] not in ("", tag) and tag not in CONTAINERS):
            return  # a stray end tag, also within what is excluded around it, ends nothing
        was = None
        while was != tag:
            was = stack.pop()[0]
            opened[was] -= 1

    def _sums(self) -> tuple[list[int], list[int]]:
        """Prose characters and titles under each container."""
        prose, titles = [0] * len(self.path), [0] * len(self.path)
        for container, _, weight, title in self.blocks:
            prose[container] += weight
            titles[container] += title
        for k in range(len(prose) - 1, 0, -1):
            prose[self.parent[k]] += prose[k]
            titles[self.parent[k]] += titles[k]
        return prose, titles

    def best(self) -> int:
        """The lowest container that holds all prose and headings; or an article that holds most of it with all titles."""
        prose, titles = self._sums()
        whole: dict[int, int] = {}  # a container's first child that holds all of it
        last = list(range(len(prose)))  # containers come in page order: those under k are k + 1 to last[k]
        for k in range(len(prose) - 1, 0, -1):
            p = self.parent[k]
            last[p] = max(last[p], last[k])
            if prose[k] == prose[p] and titles[k] == titles[p]:
                whole[p] = k
        at = 0
        while prose[0] and at in whole:
            at = whole[at]
        for k in range(at + 1, len(prose)):
            if self.article[k] and prose[k] >= ARTICLE_SHARE * prose[at] > 0 and titles[k] == titles[at] and k <= last[at]:
                at = k
        return at

    def _name(self, path: int) -> str:
        """A path in full."""
        up = {number: key for key, number in self.paths.items()}
        names = []
        while path:
            path, name = up[path]
            names.append(">" + name)
        return "".join(reversed(names))

    def _number(self, name: str) -> int | None:
        """The number of a path in full; None if the page has none such."""
        at: int | None = 0
        for step in name.split(">")[1:]:
            at = self.paths.get((at, step))
            if at is None:
                return None
        return at

    def vote(self) -> tuple[str, float] | None:
        """(path, score) of the best container: 1, as its prose is most or all of the page's; None without prose."""
        prose, _ = self._sums()
        at = self.best()
        return (self._name(self.path[at]), round(prose[at] / prose[0], 6)) if prose[0] else None

    def text_under(self, path: str | None) -> str:
        """Blocks under the containers at ``path`` if they hold most of the prose and every title, else under the page's own best container."""
        number = self._number(path) if path is not None else None
        inside = [p == number for p in self.path] if number is not None else [False]
        if any(inside):
            for k in range(1, len(inside)):
                inside[k] = inside[k] or inside[self.parent[k]]
            held = sum(w for c, _, w, _ in self.blocks if inside[c])
            if held and held >= PATH_SHARE * sum(w for _, _, w, _ in self.blocks) and all(inside[c] for c, _, _, title in self.blocks if title):
                return "\n".join(t for c, t, _, _ in self.blocks if inside[c])
        at = self.best()
        inside = [k == at for k in range(len(self.path))]
        for k in range(1, len(inside)):
            inside[k] = inside[k] or inside[self.parent[k]]
        return "\n".join(t for c, t, _, _ in self.blocks if inside[c])


def host_of(url: Column) -> Column:
    """Lower-case host without port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _votes(batches):
    import pyarrow as pa

    for batch in batches:
        sums: dict[tuple[str, str], float] = {}
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            vote = Page(html or "").vote()
            if vote is not None:
                sums[host, vote[0]] = sums.get((host, vote[0]), 0.0) + vote[1]
        yield pa.RecordBatch.from_pydict(
            {"host": pa.array([k[0] for k in sums], pa.string()), "path": pa.array([k[1] for k in sums], pa.string()), "score": pa.array(list(sums.values()), pa.float64())}
        )


def consensus(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host`` and its winning ``path``: the largest sum of scores, rounded so that the order of adding does not matter."""
    votes = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInArrow(_votes, "host string, path string, score double")
    sums = votes.groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("score"))
    return sums.groupBy("host").agg(F.max_by("path", F.struct("score", "path")).alias("path"))


def _with_winners(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """``rows`` with the ``path`` of their ``host``: broadcast if the winners are few bytes, else joined with each host dealt to many tasks."""
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 16)).first()[0] or 0
    if size <= MAX_BROADCAST_BYTES:
        return rows.join(F.broadcast(winners), "host", "left")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    return salted.join(winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "salt"], "left")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text of each row: blocks joined by newlines, white space inside a block one space.

    Null and empty pages have an empty text; pages without a host vote together under the empty host. Repeated rows
    give a row each, ties between paths go to the last in order, and other columns are not read. Very long pages are
    read whole. A page that is nothing but marked elements is read without minding class, id and role.
    """
    winners = materialize(consensus(pages, url_col, html_col), "host-paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    rows = _with_winners(rows, winners).select("page_id", "url", "html", "path")

    def of_batches(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [Page(h or "").text_under(p) for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(of_batches, f"page_id {kind}, url string, text string")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page, as ``extract`` defines them; null and empty pages have an empty text."""
    found = extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
