import itertools
import os
import random
import re
import time
from collections import Counter

import pytest

from tablewright.llm.html import best_region, extract, learn, learned, main_text, tokens

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
STORY = ["The first paragraph has a good number of words in it.", "A second one &amp; it follows, with a <a href='/x'>link</a> inside.",
         "The last paragraph ends the story of the day."]
TEXT = "A heading\n\nThe first paragraph has a good number of words in it.\n\nA second one & it follows, with a link inside.\n\n" \
       "The last paragraph ends the story of the day."


def page(open_, close, between=""):
    body = "".join(f"<p>{p}</p>\n{between}" for p in STORY)
    return (f"<!DOCTYPE html><html><head><title>Title here</title><style>p > a {{}}</style><script>var t='<p>no</p>';</script></head>"
            f"<body class='page'><header><h2>The site</h2><p>All the news that we can find for you today</p></header>"
            f"<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>About us</a></li></ul></nav>"
            f"<!-- a comment with words --><div class=\"cookie-notice\"><p>We use cookies to make this site better for you.</p></div>"
            f"{open_}<h1>A heading</h1>{body}{close}"
            f"<aside><p>Other stories that you may want to read</p></aside><form>Your name <input name=a> <button>Send it now</button></form>"
            f"<section id='comments'><p>I like this story a lot, thank you very much.</p></section>"
            f"<footer><p>All rights are ours, and this is a long footer line.</p></footer></body></html>")


@pytest.fixture(scope="module")
def scores():
    counts = {}
    for t in tokens(page("<article>", "</article>")):
        key = t.kind, t.content and t.kind != "word:furniture"
        counts[key] = counts.get(key, 0) + (t.words if t.kind.startswith("word") else 1)
    return learned([(k, c, n) for (k, c), n in counts.items()])


@pytest.mark.parametrize("wrap", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class='content with-sidebar'>", "</div>"), ("<div>", "</div>")])
@pytest.mark.parametrize("between", ["", "<div class='ad'>Buy this thing now, it is so good</div>", "<script>if (a < b) {}</script>", "<!-- x -->"])
def test_story(scores, wrap, between):
    assert main_text(page(*wrap, between), scores) == TEXT


def test_blocks(scores):
    assert main_text("<article>one\n two<br>three<p><b>four <i>five</b></i><p>six &eacute;&#8364;&nbsp;seven</article>", scores) == \
        "one two three\n\nfour five\n\nsix é€ seven"
    assert main_text("just some words without a tag", scores) == "just some words without a tag"
    assert main_text("<article><p class='a\" b>odd quote in here</p><p>next one</p></article>", scores).endswith("next one")


def test_broken_and_long(scores):
    for broken in ("", None, "<", "<p", "<p>text", "</p></div>", "<script>never closed", "<!-- never closed", "<a href='x", "&#xZZ; &bogus;"):
        main_text(broken, scores)
    text = main_text("<article>" + "<p>some words of text here</p>" * 30_000 + "</article>", scores)
    assert text.count("\n\n") == 29_999
    main_text("<div>" * 5_000 + "deep words", scores)


@pytest.mark.parametrize("odd", ["<i>" * 60_000 + "</b>" * 60_000, "<i>" * 60_000 + "<p>word</p>" * 20_000, "<i>" * 60_000 + "<div></div>" * 20_000,
                                 "<svg>" + "<g>" * 60_000 + "<p>word" * 20_000, "<" * 500_000, " " * 1_000_000, "<a>" * 200_000, "." * 1_000_000])
def test_time_grows_with_the_page_alone(scores, odd):
    start = time.process_time()
    main_text(f"<body>{odd}<article><p>The words of the page are these.</p></article></body>", scores)
    assert time.process_time() - start < 8


@pytest.mark.parametrize("sides", [(3, 60), (60, 3), (2, 2)])
def test_furniture_inside_the_article(scores, sides):
    parts = [" ".join(f"{side}{i}" for i in range(n)) for side, n in zip("ab", sides)]
    for box in ("<div class='ad'>" + "buy this now " * 30 + "</div>", "<form><p>" + "get our news by mail " * 20 + "<button>Go</button></p></form>"):
        text = f"<body><nav>Home</nav><article><p>{parts[0]}</p>{box}<p>{parts[1]}</p></article><footer>All rights</footer></body>"
        assert main_text(text, scores) == "\n\n".join(parts)
        assert main_text(text, scores | {"word:furniture": -12.8}) == "\n\n".join(parts)
    assert min(learned([("word", True, 10 ** 9), ("word:furniture", False, 10 ** 9), ("nav", False, 10 ** 6)]).values()) >= -4


PROSE = "These words of the article are about the matter itself and have to stay."


@pytest.mark.parametrize("open_, name", [("section id='related-work'", "section"), ("section class='discussion'", "section"),
                                         ("div class='search-algorithm'", "div"), ("p class='notice-period'", "p"),
                                         ("div class='ad-hoc-methods'", "div"), ("ol class='menu-recipes'", "ol"), ("div class='no-ads'", "div")])
def test_names_inside_the_article_need_evidence(scores, open_, name):
    before, after = "<p>Before it there is a sentence.</p>", "<p>After it there is one, too.</p>"
    want = ["Before it there is a sentence.", PROSE, "After it there is one, too."]
    assert main_text(f"<article>{before}<{open_}>{PROSE}</{name}>{after}</article>", scores).split("\n\n") == want
    if name != "p" and "no-ads" not in open_:
        for box in ("<a href=x>One of ten more stories</a> by us", "Your words <input name=q>"):
            for end in (f"</{name}>", ""):
                got = main_text(f"<article>{before}<div><{open_}>{box}{end}</div>{after}</article>", scores).split("\n\n")
                assert got == [want[0], want[2]]


@pytest.mark.parametrize("name", ["ad", "ad-box", "adBanner", "related-posts", "share-buttons", "cookie-notice", "newsletter signup", "comments"])
def test_names_of_furniture_alone(scores, name):
    assert main_text(f"<article><p>One sentence here.</p><div class='{name}'>{PROSE}</div><p>Two are here.</p></article>", scores) == \
        "One sentence here.\n\nTwo are here."


def test_pages_without_article_elements(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    scores, words, found, wrong = learn(pages), 0, 0, 0
    for r in pages.select("html").collect():
        want = Counter(main_text(r.html, scores).split())
        got = Counter(main_text(re.sub(r"<(/?)(?:article|main)(?=[\s>])", r"<\1div", r.html or ""), scores).split())
        words, found, wrong = words + want.total(), found + (want & got).total(), wrong + (got - want).total()
    assert words > 1000 and found >= 0.95 * words and wrong <= 0.02 * words


@pytest.mark.parametrize("odd", ["<svg class=x viewBox='0 0 1 1'/>", "<math/>", "<div><svg><path d='M0'><text>icon</text></div>",
                                 "<div><object data=x>no plugin here</div>", "<svg><title>t</title><path/></svg>", "<svg><g>"])
def test_foreign_elements(scores, odd):
    text = "<p>All of these words are there.</p><p>And these ones are, too.</p>"
    want = "All of these words are there.\n\nAnd these ones are, too."
    assert main_text(f"<body>{odd}<article>{text}</article></body>", scores) == want
    assert main_text(f"<body><article>{odd}{text}</article></body>", scores) == want


def test_formula_and_wrappers(scores):
    formula = ("<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='application/x-tex'>x=2</annotation>"
               "</semantics></math>")
    assert main_text(f"<article><p>We know that {formula} holds here.</p></article>", scores) == "We know that x=2 holds here."
    article = "<article><p>The story of the day is told in these words.</p></article>"
    want = "The story of the day is told in these words."
    for wrap in ("<form id=f>{}</form>", "<div class='layout sidebar-right'>{}</div>", "<form><div class='page top'>{}</div></form>"):
        assert main_text("<body>" + wrap.format(f"<nav>Home</nav>{article}<footer>All rights</footer>") + "</body>", scores) == want
    assert main_text(f"<body><aside>{article}</aside><div class='related'>{article}</div></body>", scores) == ""


def test_best_region_equals_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        row = [rng.choice([-2.0, -1.0, 1.0, 2.0]) for _ in range(rng.randint(0, 12))]
        start, end = best_region(row)
        best = max([0.0, *(sum(row[a:b]) for a, b in itertools.combinations(range(len(row) + 1), 2))])
        assert sum(row[start:end]) == best


def test_extract(spark):
    rows = [(1, "u1", page("<article>", "</article>")), (1, "u1", page("<article>", "</article>")), (2, "u2", None), (None, None, ""),
            (3, "u3", page("<div>", "</div>"))]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.url, r.text) for r in extract(frame).collect()), key=str)
    assert got == sorted([(1, "u1", TEXT), (1, "u1", TEXT), (2, "u2", ""), (None, None, ""), (3, "u3", TEXT)], key=str)
    assert learn(frame.limit(0)) == {} and extract(frame.limit(0)).count() == 0
