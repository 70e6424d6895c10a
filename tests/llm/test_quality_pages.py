from __future__ import annotations

import base64
import math
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from tests.llm.cases import ODD_ROWS, WORD, documents, prose
from textloom.llm import bpe, fertility, html_text, url_filter
from textloom.llm.queries import BYTE_RANKS, PIECE_MODEL, QUERIES, RULES
from textloom.sources.tables import load


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@pytest.fixture(scope="module")
def vocabularies(spark):
    return [bpe.share_file(spark, public_tokenizers.path(name)) for name in (PIECE_MODEL, BYTE_RANKS)]


def test_base_counts_of_odd_rows(spark, vocabularies):
    rows = [*ODD_ROWS, (40, "a a a a a"), (41, "x\ny\nx\r\nx\n \nx"), (42, "# a|b <c>"), (43, prose(2, 60)), (44, "漢字 " * 60)]
    docs = documents(spark, rows).withColumns({"script": F.lit(1), "n_words": F.lit("n")})
    got = fertility.quality(docs, *vocabularies).collect()
    assert sorted((str(r.doc_id), *[r[c] for c in BASE]) for r in got) == sorted((str(i), *base(t)) for i, t, *_ in rows)
    assert all(r.kept is not None and not (r.kept and r.base_failed) for r in got)


def test_base_counts_of_the_query(spark, sf):
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in QUERIES["op3_fertility"](spark, sf).collect()}
    assert got == {r.doc_id: base(r.text) for r in load(spark, sf, "documents").select("doc_id", "text").collect()}


def measured(text, pieces, byte_level):
    """The four measures of a text with a word, word by word."""
    words = WORD.findall(text)
    ids = [t for w in words for t in pieces.encode(w)]
    chars, shares = sum(map(len, words)), [n / len(ids) for n in Counter(ids).values()]
    return {
        "chars_per_piece": chars / len(ids), "chars_per_byte_token": chars / sum(len(byte_level.encode_ordinary(" " + w)) for w in words),
        "fallback_share": sum(pieces.is_byte(t) for t in ids) / len(ids), "token_entropy": -sum(p * math.log2(p) for p in shares),
    }


@pytest.fixture(scope="module")
def libraries(vocabularies):
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabularies[1].value.splitlines() if line.strip())}
    encoding = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return sentencepiece.SentencePieceProcessor(model_proto=vocabularies[0].value), encoding


def test_measures_match_the_libraries(spark, vocabularies, libraries):
    texts = {1: "the cat 漢字 sat", 2: "𐍈𐍈 the the", 3: "Привет мир", 4: "don't abc123!? x"}
    got = {r.doc_id: r for r in fertility.measures(documents(spark, list(texts.items())), *vocabularies).collect()}
    for i, text in texts.items():
        for name, value in measured(text, *libraries).items():
            assert got[i][name] == pytest.approx(value)
    assert got[2].fallback_share > 0 and got[3].script == "cyrillic" and got[1].script == "latin"


def test_verdicts_of_the_query_against_brute_force(spark, sf, libraries):
    """Bands over all texts of a script that pass the base rules, and every verdict."""
    texts = {r.doc_id: r.text for r in load(spark, sf, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in QUERIES["op3_fertility"](spark, sf).collect()}
    known = {i: measured(t, *libraries) for i, t in texts.items() if t and WORD.findall(t)}
    passing = {i for i in texts if not base(texts[i])[-1]}
    ends = {}
    for script in {got[i].script for i in passing}:
        mine = [known[i] for i in passing if got[i].script == script]
        for name, least in fertility.LEAST_RANGE.items():
            values = sorted(m[name] for m in mine)
            low, high = (values[math.ceil(q * len(values)) - 1] for q in (0.25, 0.75))
            reach = fertility.FENCE * max(high - low, least)
            ends[script, name] = low - reach, high + reach
    for i in texts:
        inside = all(ends[got[i].script, m][0] - 1e-9 <= known[i][m] <= ends[got[i].script, m][1] + 1e-9 for m in fertility.MEASURES) if i in passing else False
        assert got[i].kept == inside, i


def test_strays_of_a_script_are_rejected(spark, vocabularies):
    rows = [(i, prose(i, 80)) for i in range(40)] + [(99, " ".join(f"{'ab'[i % 2]}{i}#%$&*#%$&*" for i in range(80)))]
    got = {r.doc_id: r.kept for r in fertility.quality(documents(spark, rows), *vocabularies).collect()}
    assert not got[99] and sum(got.values()) == 40
    assert fertility.quality(documents(spark, []), *vocabularies).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<div id="cookie-notice">We use cookies</div><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="sidebar"><p>Related <div>things</div></p></div>
<div><h1>A &amp; B</h1><p>First   paragraph with
 enough text to be a paragraph of an article, really.<p>Second one<br>goes on&hellip;</p><div class="ad banner">Buy!</div>
<p>Ok.</p><blockquote>Quoted &lt;text&gt; is &#8364;5 here</blockquote></div>
<section class="comments"><p>I disagree with all of this, and here is why in many words.</p></section>
<form><p>Sign up</p></form><footer><p>&copy; Someone</p></footer></body></html>"""
TEXT = "A & B\nFirst paragraph with enough text to be a paragraph of an article, really.\nSecond one goes on…\nOk.\nQuoted <text> is €5 here"


@pytest.mark.parametrize(
    "html, text",
    [
        (PAGE, TEXT),
        (PAGE.replace("<div><h1>", "<article><h1>").replace("</blockquote></div>", "</blockquote></article>"), TEXT),
        (None, ""),
        ("", ""),
        ("<nav>x</nav>", ""),
        ("just text", "just text"),
        ("<p>a < b and c > d", "a < b and c > d"),
        ("<p title='x > y'>one</p><!-- <p>no</p> --><p>two", "one\ntwo"),
        ("<style>p{}</style><p>one<div class=ad>no", "one"),
        ("<div class=ad>Buy<p>kept<p>too", "kept\ntoo"),
        ("<aside>never closed<div>kept</div>", "kept"),
        ("<div id='cookieNotice'>we use</div><div class='page-header'>Site</div><div class='entry-header'>Title</div><p>text", "Title\ntext"),
        ("<article><header><h1>Head</h1></header><p>x</p></article><header>top</header>", "Head\nx"),
        ("<p>" + "word " * 30_000 + "</p>", " ".join(["word"] * 30_000)),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


BODY = "<h1>Title</h1><p>" + "long " * 60 + "</p><p>" + "more " * 50 + "</p>"
BODY_TEXT = "Title\n" + " ".join(["long"] * 60) + "\n" + " ".join(["more"] * 50)


@pytest.mark.parametrize("name", ["content has-sidebar", "with-sidebar", "no-comments", "social-policy", "banner-story", "page comments-open", "hasSidebar"])
@pytest.mark.parametrize("tag", ["article", "div", "main"])
def test_names_of_wrappers_drop_nothing(name, tag):
    page = f"<body><nav>Home</nav><div class='{name}'><{tag}>{BODY}</{tag}></div><div class='sidebar'><p>Other</p></div></body>"
    assert html_text.main_text(page) == BODY_TEXT
    bare = page.replace("<h1>Title</h1>", "")  # most of the text, without a mark
    assert html_text.main_text(bare) == BODY_TEXT.removeprefix("Title\n")


def test_names_of_inline_elements_and_of_asides():
    assert html_text.main_text("<p>It cost <span class='share-price'>5 euros</span> <a id=ad-1>then</a>.</p>") == "It cost 5 euros then."
    replies = "<section class='comments'><article><p>" + "reply " * 200 + "</p></article></section>"
    assert html_text.main_text(f"<article>{BODY}</article>{replies}") == BODY_TEXT
    short = "<article><h1>Title</h1><p>Short.</p></article>"
    assert html_text.main_text(f"<div class='ad'>An advert longer than all of the article</div>{short}") == "Title\nShort."
    assert html_text.main_text(f"<div>{BODY}</div><div class='cookie-consent'><p>{'we use ' * 300}</p></div>") == BODY_TEXT


def test_short_blocks_beside_dropped_containers():
    long, other = "x" * 400, "y" * 300
    share, advert = "<div class='share'>Share</div>", "<div class='ad'>Buy</div>"
    page = f"<div>Home</div>{share}<h1>A title of some thirty letters</h1>{share}<p>{long}</p><p>{other}</p>{advert}<p>End.</p>{advert}<div>Imprint</div>"
    assert html_text.main_text(page) == f"A title of some thirty letters\n{long}\n{other}\nEnd."
    assert html_text.main_text(f"<h2>One</h2>{advert}<h3>Two</h3>{advert}<p>{long}</p>{advert}<p>Last<br>line</p>") == f"One\nTwo\n{long}\nLast line"


def test_articles_are_a_cue_and_windows_decide():
    teasers = "".join(f"<article><h2>Other {i}</h2><p>Read on</p></article>" for i in range(3))
    advert = "<div class='ad'>Buy</div>"
    assert html_text.main_text(f"<div>{BODY}</div>{teasers}") == BODY_TEXT
    reply = "<article><p>" + "reply " * 60 + "</p></article>"  # the longest paragraph, but not most of the text
    assert html_text.main_text(f"<div>{BODY}</div>{reply}").startswith(BODY_TEXT)
    # Within the article that holds the text all lines stay; a small one beside it does not surge.
    page = f"<div>Menu here</div><article><div>By me</div>{advert}{BODY}{advert}<ul><li>Note</li></ul></article><article><p>Next</p></article>"
    assert html_text.main_text(page) == f"By me\n{BODY_TEXT}\nNote"


@pytest.mark.parametrize("wrapper", ["form id='aspnetForm'", "dialog open", "div role='search form'", "form", "div role='dialog'"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_wrappers_that_hold_the_page_drop_nothing(wrapper, tag):
    page = f"<body><nav>Home</nav><{wrapper}><{tag}>{BODY}</{tag}></{wrapper.split()[0]}><footer>Imprint</footer></body>"
    assert html_text.main_text(page) == BODY_TEXT
    assert html_text.main_text(page.replace("<h1>Title</h1>", "")) == BODY_TEXT.removeprefix("Title\n")
    assert html_text.main_text(f"<div>{BODY}</div><form><p>Sign up</p></form>") == BODY_TEXT


def test_what_follows_an_advert_in_the_same_wrapper_stays():
    long, advert = "x" * 400, "<div class='ad'>Buy</div>"
    steps = "<ul><li>Step one</li><li>Step two</li></ul><table><tr><td>a</td><td>b</td></tr></table>"
    wanted = f"{long}\nStep one\nStep two\na\nb"
    assert html_text.main_text(f"<p>{long}</p>{advert}{steps}") == wanted
    page = f"<div><div><p>{long}</p>{advert}{steps}{advert}<div>Closing words</div></div><div>Imprint</div></div>"
    assert html_text.main_text(page) == f"{wanted}\nClosing words"


def test_a_slash_closes_no_block():
    assert html_text.main_text("<p>one</p><div class=ad/>Buy</div><p>two</p>") == "one\ntwo"
    assert html_text.main_text("<p>one<br/>more</p><div class='ad' />Buy</div><p>two</p>") == "one more\ntwo"


def test_unmarked_page_by_its_line_blocks():
    lines = ["Home", "", "x" * 300, "short", "y" * 200, "", "Imprint"]
    assert html_text.main_span(html_text.np.array([len(x) for x in lines])) == (2, 5)


def test_html_query(spark, sf):
    got = {r.page_id: r for r in QUERIES["op8_html_text"](spark, sf).collect()}
    pages = load(spark, sf, "pages").collect()
    assert len(got) == len(pages)
    for page in pages:
        assert got[page.page_id].text == html_text.main_text(page.html) and got[page.page_id].n_chars == len(got[page.page_id].text)
    odd = spark.createDataFrame([(1, None, None), (None, "u", "<p>x"), (2, "u", "")], "page_id long, url string, html string")
    assert [r.text for r in html_text.extract(odd, ["page_id"]).collect()] == ["", "x", ""]
    assert html_text.extract(odd.limit(0), ["page_id", "url"]).count() == 0


URLS = [
    (1, "http://WWW.Example.com/en/x?utm_source=a#t"), (2, "https://example.com/en/"), (3, "https://b.example.com/en"), (4, "ftp://a.net/es/1"),
    (5, "http://net/fr/"), (6, None), (7, "no scheme"), (8, "://"), (9, "http://bad.org/p/?ref=1&q=2"), (10, "http://www.bad.org/p?q=2#z"),
    (11, "http://bad.org/p?q=3"), (12, "http://x.com"), (13, "http://bad.org/p/?q=2"), (13, "http://bad.org/p/?q=2"),
]


def test_url_rules_and_list(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumns({"host": F.lit(1), "_key": F.lit(2)})
    listed = spark.createDataFrame([("https://m.bad.org/p?q=2",), (None,), ("nothing",), ("http://x.com/",)], "u string")
    judged = url_filter.judge(pages.drop("host"), RULES, listed)
    assert judged.columns == ["page_id", "url", "_key", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.collect()}
    assert judged.count() == len(URLS)
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[3] == ("b.example.com", "/en", "com/", "allow")
    assert got[4][2:] == ("net/es/", "block") and got[5][2:] == ("net/fr/", "block")
    for i in (6, 7, 8):
        assert got[i] == ("", "", None, "allow")
    assert [got[i][3] for i in (9, 10, 11, 12, 13)] == ["block", "block", "allow", "block", "block"]
    assert url_filter.judge(pages.limit(0), RULES, listed.limit(0)).count() == 0
