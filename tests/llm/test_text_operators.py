import math
import random
import re
from collections import Counter, defaultdict
from html import unescape

import pytest
import regex
from pyspark.sql import functions as F

from leadloom.llm import chat, html_text, language_id, quality, toxicity
from tests.llm.conftest import ODD


def _base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


EN = "the quick fox of the wood went to the river and it was in the sun for a day with the bear on that hill "
TEXTS = [
    (1, " ".join(EN + w for w in ("alpha", "beta gamma", "delta")), "en"),
    (2, "word### " * 60, "en"),
    (3, "\n".join(["one two three", "one two three", "", " ", "x"] * 5), "en"),
    (4, EN * 5, "en"),
    (5, "".join(f"cell{i} | " for i in range(120)), "en"),
    (6, None, None),
    (7, "", None),
    (8, "a b c a b c d", None),
]


def test_quality_counts(docs_of, none):
    got = {r.doc_id: r for r in quality.score_quality(docs_of(TEXTS)).select("_row.doc_id", "*").collect()}
    for i, text, _ in TEXTS:
        r = got[i]
        want = _base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality.score_quality(none).collect() == []


def test_quality_odd_rows_and_long_text(odd):
    rows = quality.score_quality(odd, carry=True)
    assert rows.count() == len(ODD)
    long = rows.where("_row.doc_id = 7").first()
    assert (long.n_words, long.n_repeat_words, long.base_failed) == (30_002, 30_000, True)
    assert len(long["_row"].text) == len(ODD[7][1])


def test_repeats_of_a_text_of_four_million_words(spark):
    words = F.transform(F.sequence(F.lit(0), F.lit(3_999_996)), lambda i: F.concat(F.lit("w"), i.cast("string")))
    text = F.concat(F.array_join(words, " "), F.lit(" a b c a b c"))
    r = quality.score_quality(spark.range(1).select("id", text.alias("text")), lang_col=None).first()
    assert (r.n_words, r.n_repeat_words, r.base_failed, r.kept) == (4_000_003, 6, False, True)


def _plain_verdicts(rows):
    """kept by doc_id, counted word by word: (doc_id, text, lang) in."""
    low = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]
    patterns = [r"\p{Ll}", r"[\p{Lu}\p{Lt}]", r"\s", r"\p{Nd}", r"""[.,;:'"?()\-]""", r"[\p{L}\p{M}]"]

    def classes(t):
        n = [0] * 7
        for c in t or "":
            n[next((k for k, p in enumerate(patterns) if regex.match(p, c)), 6)] += 1
        return [x / max(1, len(t or "")) for x in n]

    def commons(t, lists):
        c, n = Counter(w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")), _base(t)[0]
        h = [c[w] / max(1, n) for w in lists]
        return [*h, 1 - sum(h)]

    def far(p, q):
        part = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0.0
        return math.sqrt(max(0.0, sum((part(a, b) + part(b, a)) / 2 for a, b in zip(p, q))))

    by, kept = defaultdict(list), {}
    for i, t, lang in rows:
        n, _, _, _, repeats = _base(t)
        kept[i] = n >= 50 and 100 * repeats <= 50 * n
        by[lang].append((i, t, n))
    judged = {lang: [r for r in rs if len(low(r[1])) >= 60] for lang, rs in by.items() if lang is not None}
    for lang, rs in judged.items():
        if len(rs) < 20 or len(rs) * 1000 < sum(map(len, judged.values())):
            continue
        docs = Counter(w for _, t, _ in rs for w in set(low(t)))
        found = [w for w, n in docs.items() if n * 20 >= len(rs) and regex.fullmatch(r"\p{L}+", w)]
        lists = sorted(sorted(found, key=lambda w: (-docs[w], w))[:32])
        mean = lambda hs: [sum(x) / len(hs) for x in zip(*hs)]
        fit = [(t, n) for _, t, n in rs if n >= 60]
        class_ref, common_ref = mean([classes(t) for t, _ in fit]), mean([commons(t, lists) for t, _ in fit])
        class_limit = round(2 * sorted(far(classes(t), class_ref) for t, _ in fit)[(len(fit) - 1) // 2], 3)
        word_limit = 0.85 * far([0.0] * len(lists) + [1.0], common_ref)
        for i, t, n in by[lang]:
            if n >= 50 and far(classes(t), class_ref) > class_limit or n >= 60 and far(commons(t, lists), common_ref) > word_limit:
                kept[i] = False
    return kept


def test_quality_verdict_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = _plain_verdicts([(r.doc_id, r.text, r.lang) for r in docs.collect()])
    got = {r.doc_id: r.kept for r in quality.score_quality(docs).select("_row.doc_id", "kept").collect()}
    assert got == want and {True, False} == set(want.values())


def test_quality_judges_a_language_by_its_own_words(docs_of):
    rng = random.Random(1)
    small = {"en": "the of and to in is it that for was on are as with be by".split(), "it": "il di che la e un per non si da con del una sono alla nel".split()}
    word = lambda lang: rng.choice(small[lang]) if rng.random() < 0.4 else "".join(rng.choice("aeinorst") for _ in range(6))
    prose = [(1000 * k + i, " ".join(word(lang) for _ in range(120)) + ".", lang) for k, lang in enumerate(small) for i in range(40)]
    rare = [(5000, "".join(chr(0x4E00 + k) + " " for k in range(120)), "zh"), (5001, prose[0][1], "xx"), (5002, prose[50][1], None)]
    junk = [(100, " ".join(f"W{k}RD!!" for k in range(200)), "en"), (101, " ".join(f"cell{k} |" for k in range(100)), "it")]
    got = {r.doc_id: r.kept for r in quality.score_quality(docs_of(prose + rare + junk)).select("_row.doc_id", "kept").collect()}
    assert got.pop(100) is False and got.pop(101) is False and all(got.values())


def test_js_distance(spark):
    row = spark.range(1).select(
        quality.js_distance(F.array(F.lit(0.5), F.lit(0.5)), F.array(F.lit(0.5), F.lit(0.5))).alias("same"),
        quality.js_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))).alias("far"),
        quality.js_distance(F.array(F.lit(0.75), F.lit(0.25)), F.array(F.lit(0.25), F.lit(0.75))).alias("some"),
    ).first()
    kl = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b))
    want = math.sqrt((kl((0.75, 0.25), (0.25, 0.75)) + kl((0.25, 0.75), (0.75, 0.25))) / 2)
    assert row.same == 0 and row.far == pytest.approx(1) and row.some == pytest.approx(want)


def test_fold():
    assert toxicity.fold("You are an 1d10t, a l0ser!") == " you are an idiot a loser"
    assert toxicity.fold("іdіоt сlоwn") == " idiot clown"
    assert toxicity.fold(None) == " " and toxicity.fold("in 2024 the$$$") == " in the"


def _toxic_rows():
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, f"plain words number{i % 7} are here and {'you loser idiot' if toxic else 'you reader friend'} again", "en"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_learns_and_scores(spark, docs_of, odd, none):
    rows, labels = _toxic_rows()
    docs = docs_of(rows)
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in got)
    extra = docs_of([(900, "what an 1D10T and L0S3R he is", None), (901, None, None), (902, "the trash can is full", None)])
    scores = {r.doc_id: r.score for r in toxicity.toxicity(extra, model).collect()}
    assert scores[900] > 0.5 and scores[901] < 0.5 and scores[902] < 0.5
    assert toxicity.toxicity(odd, model).count() == len(ODD) and toxicity.toxicity(none, model).collect() == []
    assert toxicity.drop_toxic(odd, model).columns == odd.columns and toxicity.drop_toxic(extra, model).count() == 2


def test_toxicity_exceptions_hide_a_term():
    terms = (("trash", 5.0),)
    assert toxicity.features("take out the trash can", terms)[0] == 0
    assert toxicity.features("you are trash", terms)[0] > 0


def test_toxicity_without_labels(spark, docs_of, none):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs_of(TEXTS), empty)
    assert model[0] == () and all(0 <= r.score < 0.5 for r in toxicity.toxicity(docs_of(TEXTS), model).collect())


def test_language(docs_of, odd, none):
    en = ["the house of the king was on that hill and with it the river", "she went to the market for bread and the fish"]
    de = ["das haus von dem könig war auf dem hügel und mit ihm der fluss", "sie ging zu dem markt für brot und den fisch"]
    rows = [(i, en[i % 2] + f" w{i}", "en") for i in range(60)] + [(100 + i, de[i % 2] + f" w{i}", "de") for i in range(60)]
    model = language_id.learn(docs_of(rows))
    assert sorted(model) == ["de", "en"]
    got = {r.doc_id: r for r in language_id.identify(docs_of(rows), model).collect()}
    assert all(r.lang_pred == ("en" if i < 100 else "de") and 0 <= r.score <= 1 for i, r in got.items())
    seen = defaultdict(set)
    for r in language_id.identify(odd, model).collect():
        seen[r.doc_id].add(r.lang_pred)
    assert seen[3] == seen[4] == seen[5] == seen[8] == {"und"} and seen[6] == {"de"}
    assert language_id.identify(none, model).collect() == []
    assert {r.lang_pred for r in language_id.identify(odd, {}).collect()} == {"und"}


def test_language_blocks_do_not_matter(monkeypatch):
    text = ODD[7][1][:5000]
    whole = language_id.document_vector(text)
    monkeypatch.setattr(language_id, "BLOCK", 97)
    assert (language_id.document_vector(text) == whole).all()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li>menu</li></ul></nav>
<!-- c --><div class="ad">Buy</div><article><h1>Head &amp; line</h1><p><b>Bold
  text<br><p>Second &lt;b&gt; para %s</p><div class="share-box">share</div><section class="comments"><p>no</p></section></article>
<aside>side</aside><form>f</form><footer>&copy; x</footer>"""


def test_page_text(spark):
    rows = [(i, f"http://h{i % 2}.example.com/{i}", PAGE % i, "x") for i in range(6)]
    rows += [(50, None, None, ""), (51, "", "", ""), (52, "http://h0.example.com/q", "<nav>menu</nav>", ""), (53, "nohost", "just text &eacute;", "")]
    rows += [(54, "http://h1.example.com/broken", "<article><p>open <a href='x", ""), (0, rows[0][1], rows[0][2], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = Counter((r.page_id, r.text) for r in html_text.extract(df).collect())
    want = Counter((i, f"Head & line\nBold text\nSecond <b> para {i}") for i in range(6))
    want += Counter({(50, ""): 1, (51, ""): 1, (52, ""): 1, (53, "just text é"): 1, (54, "open"): 1, (0, "Head & line\nBold text\nSecond <b> para 0"): 1})
    assert got == want
    assert html_text.extract(df.limit(0)).collect() == []


def test_marks():
    text = lambda h: html_text.Page(h).text_under(None)
    page = "<div class='layout has-sidebar'><div class='post-header'><h1>T</h1></div><p>main text here</p><div class='post-comments'>c</div><div id='cookieNotice'>k</div></div>"
    assert text(page) == "T\nmain text here"
    assert text("<div class='widget'><p>only this</p></div>") == "only this" and text("<nav>menu</nav>") == ""


LONG = "This is a long sentence of the story that the page is about. "


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<div id=content><h1>Title</h1><div class=rest><p>{LONG * 9}</p></div></div>", ["Title", LONG * 9]),
        (f"<div class=post><h1>T</h1><p>{LONG}</p><div class=content><p>{LONG * 9}</p></div></div>", ["T", LONG, LONG * 9]),
        (f"<main><section><p>{LONG}</p></section><section><p>{LONG * 9}</p></section></main>", [LONG, LONG * 9]),
        (f"<article><h1>T</h1><h2 id='related-work'>Related work</h2><section id='social-history'><p>{LONG}</p></section><p class='ad-note'>{LONG}</p></article>", ["T", "Related work", LONG, LONG]),
        (f"<header><p>Site</p></header><main><header><h1>Head</h1></header><p>{LONG}</p></main>", ["Head", LONG]),
        (f"<article><p>{LONG} <math><mi>x</mi></math> end</p></article>", [f"{LONG}x end"]),
        (f"<article><p>if a<b then stop</p><p>{LONG}</p></article>", ["if a<b then stop", LONG]),
        (f"<article><p>{LONG}</p><section class='comments'><p>{LONG}</p></section><div id='comments'>{LONG}</div></article>", [LONG]),
        (f"<article><p>{LONG}</p><div class='related-posts'><p>{LONG}</p></div><div class='share_buttons'>x</div><div id='cookieNotice'>x</div></article>", [LONG]),
        (f"<main><h1>T</h1><article><p>{LONG * 9}</p></article></main>", ["T", LONG * 9]),
        (f"<article><p title='a > b'>{LONG}</p><p alt=it's>{LONG}</p></article>", [LONG, LONG]),
        (f"<article><p>{LONG}</p><pre>1 < 2\n &lt;3</pre><table><tr><td>a<td>b</table></article>", [LONG, "1 < 2 <3", "a", "b"]),
    ],
)
def test_no_article_text_is_lost(page, want):
    found = html_text.Page(f"<html><body><nav>menu</nav>{page}<footer>foot</footer></body></html>")
    assert found.text_under(None) == "\n".join(x.strip() for x in want)
    assert found.text_under(found.vote()[0]) == found.text_under(None)


def test_a_page_off_the_hosts_path_keeps_its_article(spark, monkeypatch):
    usual = "<body><div class='top-1'><a href='/'>home</a></div><div class='body-%d'><h1>T</h1><p>" + LONG * 9 + "</p></div></body>"
    teaser = "<body><div class='top-9'><p>" + LONG + "</p></div><div class='body-7'><h1>T</h1><p>" + LONG * 9 + "</p></div></body>"
    other = "<body><div class='story'><h1>Own</h1><p>" + LONG * 20 + "</p></div><div class='body-7'><p>short box</p></div></body>"
    rows = [(i, "http://a.example.com/", usual % i) for i in range(5)] + [(8, "http://a.example.com/", teaser), (9, "http://a.example.com/", other)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: "T\n" + (LONG * 9).strip() for i in (0, 1, 2, 3, 4, 8)} | {9: "Own\n" + (LONG * 20).strip() + "\nshort box"}
    assert {r.page_id: r.text for r in html_text.extract(df).collect()} == want
    monkeypatch.setattr(html_text, "MAX_BROADCAST_BYTES", -1)
    assert {r.page_id: r.text for r in html_text.extract(df).collect()} == want


def test_made_pages_give_their_articles(spark):
    rng = random.Random(4)
    sentence = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(6, 20))) + "."
    noise = [
        "<nav><ul><li><a href='/'>Home page of the site</a></ul></nav>", "<aside><p>%s</p></aside>", "<div class='sidebar-%d'><p>%s</p></div>", "<form><p>%s</p><input></form>",
        "<div class='ad banner'><p>%s</p></div>", "<div id='newsletter-box'>%s</div>", "<script>if (a<b) document.write('<p>x</p>')</script>", "<style>p > a {}</style>", "<!-- <p>%s</p> -->",
        "<div role='navigation'><a href=x>%s</a></div>", "<section id='comments'><p>%s</p></section>", "<div hidden>%s</div>", "<noscript>%s</noscript>",
    ]
    clutter = lambda n: "".join(x.replace("%d", "7").replace("%s", sentence()) for x in rng.sample(noise, n))
    shells = [
        "<html><head><title>t</title></head><body><header><p>Site</p></header>{a}<div class='page'><div class='text-{n}'>{art}</div>{b}</div><footer>{s}</footer></body></html>",
        "<body>{a}<main id=main>{art}</main>{b}<div class='site-footer'>{s}</div>",
        "<body>{a}<div><article>{art}{b}</article></div><footer>{s}</footer></body>",
    ]
    rows, want = [], {}
    for i in range(150):
        paragraphs = [sentence() + " " + sentence() for _ in range(rng.randint(1, 8))]
        blocks = ["Head & title", *paragraphs]
        art = "<h1>Head &amp; <em>title</em></h1>" + "".join(rng.choice(["<p>%s</p>", "<p>%s", "<div class='row'><p>%s</p></div>", "<blockquote>%s</blockquote>", "<ul><li>%s</ul>", "<section><p>%s</p></section>"]) % p.replace(" ", rng.choice([" ", "\n  ", "&nbsp;"])) for p in paragraphs)
        page = shells[i % 3].replace("{a}", clutter(4)).replace("{b}", clutter(4)).replace("{n}", str(i)).replace("{art}", art).replace("{s}", sentence())
        rows.append((i, f"http://h{i % 5}.example.com/{i}", page))
        want[i] = "\n".join(blocks)
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [i for i in want if got[i] != want[i]] == []


def test_unescape_is_the_standard_one():
    assert unescape("&eacute;&#33;") == "é!"


def test_chat(spark):
    log = {
        1: [("user", "hi"), ("bot", "hello")],
        2: [("user", "hi"), ("bot", "hello"), ("user", "more")],
        3: [("user", "hi"), ("bot", "other")],
        4: [("user", "hi"), ("bot", "other")],
        5: [("user", "hi")],
        6: [(None, None)],
        7: [("bot", "hello"), ("user", "hi")],
        8: [("user", "x" * 100_000)],
    }
    rows = [(c, t, r, x, "extra", 0) for c, turns in log.items() for t, (r, x) in enumerate(turns)] + [(None, 0, "user", "lost", "", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, shown string, place int")
    got = {r.conv_id: (r.n_turns, r.copies, r.text) for r in chat.format_chats(df).collect()}
    show = lambda c: "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in log[c])
    assert got == {2: (3, 1, show(2)), 3: (2, 2, show(3)), 6: (1, 1, show(6)), 7: (2, 1, show(7)), 8: (1, 1, show(8))}
    assert chat.format_chats(df.limit(0)).collect() == []


def test_chat_ties_and_missing_turn_numbers(spark):
    rows = [(1, 1, "b", "y"), (1, 1, "a", "x"), (1, None, "c", "z"), (1, 1, "a", "x")]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert re.findall(r"start\|>(\w)", got.text) == ["a", "a", "b", "c"] and got.n_turns == 4


def test_reading_deeply_nested_pages_is_linear():
    import time
    import tracemalloc

    pages = {
        "<div>" * 100_000 + "<p>some words" + "</div>" * 100_000: "some words", "<div>" * 100_000 + "x" + "</span>" * 100_000: "x", "<article>" * 50_000 + "<p>words": "words",
        "<b><nav>" + "<nav>" * 100_000 + "</b>" * 100_000: "", "<div class='a>b'><p>in it</div>" * 2: "in it\nin it",
    }
    for page, want in pages.items():
        began = time.process_time()
        found = html_text.Page(page)
        vote = found.vote()
        assert found.text_under(vote and vote[0]) == want and time.process_time() - began < 5
    tracemalloc.start()
    html_text.Page("<div>" * 100_000 + "<p>some words").vote()
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


@pytest.mark.parametrize("name", ["comment-thread", "comment-form", "adsbygoogle", "cookiebar", "topnav", "outbrain"])
def test_clutter_in_an_article_goes(name):
    page = html_text.Page(f"<article><h1>Title</h1><p>{LONG}</p><div class='{name}'><p>clutter</p></div><p>end of it</p></article>")
    assert page.text_under(None) == f"Title\n{LONG.strip()}\nend of it"


def test_digits_are_folded_as_a_pattern_for_each_digit_does():
    """The plain rule: a digit stands for a letter before digits that end in one, or right after a letter, but for an 8 that ends a word."""
    import time

    plain = re.compile(r"[0134578](?=[0-9]*[^\W\d_])|(?<=[^\W\d_])[0134578](?=[^\W_])|(?<=[^\W\d_])[013457](?![^\W_])")
    rng = random.Random(9)
    for _ in range(20_000):
        s = "".join(rng.choice("a80135 79é٣_.-x") for _ in range(rng.randint(0, 10)))
        assert toxicity._DIGITS.sub(toxicity._letters_for, s) == plain.sub(lambda m: m[0].translate(toxicity.SUBSTITUTES), s)
    began = time.process_time()
    assert toxicity.fold("1" * 1_000_000) == " " and len(toxicity.fold("a" + "1" * 1_000_000)) > 2
    assert time.process_time() - began < 2


def _plain_vector(text):
    """Product of the rotated letter vectors of each 3-gram whose middle is a letter, summed, in plain Python loops."""
    letters = language_id._letter_vectors()[0].tolist()
    slot = lambda ch: ord(ch) % (language_id.LETTER_SLOTS - 1) + 1 if ch.isalpha() else 0
    turned = lambda s, r: letters[s][-r:] + letters[s][:-r] if r else letters[s]
    codes = [0, *[slot(ch) for ch in text.lower()], 0]
    codes = [c for k, c in enumerate(codes) if c or not k or codes[k - 1]]
    total = [0] * language_id.DIMENSIONS
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            total = [t + x * y * z for t, x, y, z in zip(total, turned(a, 0), turned(b, 1), turned(c, 2))]
    return total


def test_language_vectors_and_scores_are_the_plain_ones(docs_of):
    texts = {1: "The cat, the hat.", 2: "Straße é 12 ü", 3: "漢字 漢字 かな", 4: "a", 5: "the the cat"}
    for text in texts.values():
        assert language_id.document_vector(text).tolist() == _plain_vector(text)
    prototypes = {"x": [float(v) for v in _plain_vector("the cat the hat")], "y": [float(v) for v in _plain_vector("straße ü")]}
    cosine = lambda u, v: sum(a * b for a, b in zip(u, v)) / math.sqrt(sum(a * a for a in u) * sum(b * b for b in v))
    for r in language_id.identify(docs_of([(i, t, None) for i, t in texts.items()]), prototypes).collect():
        near = {k: cosine(_plain_vector(texts[r.doc_id]), p) for k, p in prototypes.items()}
        shares = {k: math.exp(c / language_id.SHARPNESS) for k, c in near.items()}
        assert r.lang_pred == max(near, key=near.get) and abs(r.score - shares[r.lang_pred] / sum(shares.values())) < 1e-4


def test_toxicity_matches_are_those_of_a_plain_scan():
    """At each place the longest term or phrase counts, then the scan goes on behind it."""
    rng = random.Random(6)
    terms = tuple({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))): rng.random() for _ in range(14)}.items()) + (("trash", 2.0), ("clown", 1.0))

    def plain(text):
        words, weight, total, at = toxicity.fold(text), {" " + t: w for t, w in terms} | {" " + p: 0.0 for p in toxicity.EXCEPTIONS}, 0.0, 0
        while at < len(words):
            found = max((t for t in weight if words.startswith(t, at)), key=len, default="")
            total += weight.get(found, 0.0)
            at += max(1, len(found))
        n = max(1, words.count(" "))
        return math.log1p(total), math.log1p(100 * total / n), math.log1p(total / math.sqrt(n))

    for _ in range(500):
        text = " ".join(rng.choice(["trash", "trash can", "clown", "clown fish", "".join(rng.choice("abcd") for _ in range(rng.randint(1, 6)))]) for _ in range(rng.randint(0, 12)))
        assert all(abs(a - b) < 1e-9 for a, b in zip(toxicity.features(text, terms), plain(text)))
