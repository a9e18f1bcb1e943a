import random
import re
from html import unescape
from itertools import product

from gaugeflow.llm import html as H

SCHEMA = "page_id long, url string, html string, text string, n_chars int"

PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><div class="logo">My Site</div></header><nav><ul><li><a href="/a">Home</a></li><li><a href='/b>c'>News</a></ul></nav>
<!-- <p>hidden</p> --><div class="cookie-banner">We use cookies to give you the very best experience on this long site.</div>
<div class="ad">Buy now!</div><article><header><h1>The  big&nbsp;title</h1></header><p><b>First &eacute; para<br>goes on.<br><p>Short.
<ul><li>one item<li>two <a href="x">items</a></ul><p class=lead>A longer closing paragraph with enough words to be text.</p>
<div class="ad">Sponsored words in the middle</div><p>After the ad.</p><form><input name=q><button>Go</button> search here</form>
<div id="comments"><p>I liked this article a lot, said a reader who wrote many words about it.</p></div></article>
<aside><p>Related reading on another page</p></aside><footer>&copy; 2024 &middot; All rights reserved</footer></body></html>"""


def test_page():
    assert H.main_text(PAGE) == "\n".join([
        "The big title", "First é para goes on.", "Short.", "one item", "two items",
        "A longer closing paragraph with enough words to be text.", "After the ad."])


def test_page_without_article_tag():
    body = "".join(f"<p>This paragraph number {i} of the story has quite a few words in it, as prose does.</p>" for i in range(4))
    page = f"<div class=menu><a href=1>One</a> <a href=2>Two</a></div><div><h2>Head</h2>{body}<p>End.</p></div><div><a href=3>Back</a></div>"
    got = H.main_text(page).split("\n")
    assert len(got) == 6 and got[0] == "Head" and got[-1] == "End."


def test_odd_pages():
    assert H.main_text(None) == "" and H.main_text("") == "" and H.main_text("<") == ""
    assert H.main_text("<nav>only menu") == ""
    assert H.main_text("<article>1 < 2 &lt; 3 <b title='a>b'>bold</b></article>") == "1 < 2 < 3 bold"
    assert H.main_text("<article><p>x</p><script>never closed <p>y") == "x"
    assert H.main_text('<article><p title="open>x</p><p>y</p></article>') == "x\ny"
    assert H.main_text("<article>" + "<div>" * 5000 + "deep" + "</p></b>" * 5000) == "deep"
    long = "<article>" + "<p>word &amp; word</p>" * 20000 + "</article>"
    assert H.main_text(long).count("\n") == 19999
    assert len(H.main_text("<article>" + "<" * 50000 + "a" * 50000)) > 0


def test_min_cut_is_minimal():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randint(1, 8)
        costs = [rnd.randint(-9, 9) for _ in range(n)]
        ties = [(a, b, rnd.randint(0, 6)) for a in range(n) for b in range(a) if rnd.random() < 0.5]

        def energy(keep, costs=costs, ties=ties):
            return sum(c for c, k in zip(costs, keep, strict=True) if c > 0 and not k) + sum(
                -c for c, k in zip(costs, keep, strict=True) if c < 0 and k) + sum(c for a, b, c in ties if keep[a] != keep[b])

        got = H.min_cut(costs, ties)
        assert energy(got) == min(energy(k) for k in product([True, False], repeat=n))


def test_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<article>x</article>")]
    got = H.extract(spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA)).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sample_pages(spark):
    """The pages of the test table mark their article; read it plainly."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in H.extract(pages).collect()}
    wrong = 0
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|ul|li|article|div)\b[^>]*>", re.sub(r"<br>", " ", inner))
        want = [" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        wrong += got[r.page_id] != "\n".join(p for p in want if p)
    assert wrong == 0


STORY = "This article has quite a few words in it, as the prose of any story does."


def test_head_and_body_can_be_left_out():
    for page in (f"<html><head><title>T</title><p>{STORY}", f"<head><meta charset=utf-8><link rel=x><title>T</title><style>p{{}}</style><p>{STORY}</p>",
                 f"<html><head><title>T</title>{STORY}", f"<title>T</title><article><p>{STORY}</p></article>",
                 f"<html><head><title>T</title></head><p>{STORY}</p></html>"):
        assert H.main_text(page) == STORY, page
    assert H.main_text(f"<body><article><p>{STORY}<head> And more.</p></article>") == STORY + " And more."


def test_unseen_elements_without_their_end():
    for tag in ("svg", "noscript", "template", "object", "canvas", "video"):
        assert H.main_text(f"<article><p>{STORY}</p><{tag}><p>After it.</p></article>") == STORY + "\nAfter it."
        # A later closed one does not close the first; a nested one not its parent.
        later = f"<article><{tag} class=x><p>{STORY}</p><{tag}>unseen</{tag}><p>After it.</p></article>"
        assert H.main_text(later) == STORY + "\nAfter it."
        assert H.main_text(f"<article><p>{STORY}<{tag}>a<{tag} t='>'>b</{tag}>c</{tag}></p></article>") == STORY
    assert H.main_text(f"<article><p>{STORY}<svg/></p><svg><!-- </svg> --><text>no</text></svg><p>End.</p>") == STORY + "\nEnd."
    for tag in H.RAW:
        assert H.main_text(f"<article><p>{STORY}</p><{tag}>never closed <p>y") == STORY
    assert H.main_text("<article><p>x</p>" + "<svg>" * 20000 + "<p>y</p>") == "x\ny"


def test_formulas_are_text():
    page = ("<article><p>Mass: <math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow>"
            "<annotation encoding='application/x-tex'>E=m</annotation></semantics></math> holds.</p></article>")
    assert H.main_text(page) == "Mass: E=m holds."


def test_names_of_wrappers_do_not_empty_pages():
    """One listed word in a wrapper's class or id, or a form around the page."""
    inner = f"<h1>Head line</h1><p>{STORY}</p><p>{STORY} Again.</p>"
    want = f"Head line\n{STORY}\n{STORY} Again."
    for page in (f'<div class="wrap has-sidebar"><article>{inner}</article></div>', f'<article class="post no-comments">{inner}</article>',
                 f'<div class="post no-comments">{inner}</div>', f'<div class="ad-free">{inner}</div>',
                 f'<section id="share-prices-today">{inner}</section>', f'<section id="related-rates-calculus">{inner}</section>',
                 f"<form action=x>{inner}</form>", f'<form><div class="sidebar-layout"><main>{inner}</main></div></form>',
                 f'<div class="menu-page">{inner}</div>'):
        assert H.main_text(page) == want, page


def test_headline_is_kept():
    for head in ('<header class="article-header"><h1>Head line</h1></header>', '<div class="post-header"><h1>Head line</h1></div>',
                 "<header><h1>Head line</h1></header>"):
        for outer in ("article", "main"):
            page = f"<header><p>Site name</p></header><{outer}>{head}<p>{STORY}</p></{outer}><footer>Foot</footer>"
            assert H.main_text(page) == f"Head line\n{STORY}", page
    assert H.main_text(f'<div><header class="entry-header"><h1>Head line</h1></header><p>{STORY}</p></div>') == f"Head line\n{STORY}"


def test_short_pages_without_marks():
    assert H.main_text("<p>Only a few words here.</p>") == "Only a few words here."
    assert H.main_text(f"<div><p>{STORY}</p><p>End.</p></div>") == f"{STORY}\nEnd."
    assert H.main_text("<ul><li><a href=a>Home</a></li><li><a href=b>News and more</a></li></ul>") == ""


def test_boilerplate_inside_and_around():
    long = " ".join(["A reader wrote a long remark about it."] * 12)
    teaser = f'<section class="related"><article><h2>Other</h2><p>{STORY}</p></article></section>'
    comments = f'<ol class="comment-list"><li><article class="comment-body"><p>{long}</p></article></li><li><article><p>{long}</p></article></li></ol>'
    page = f"<article><h1>Head line</h1><p>{STORY}</p><p>{STORY * 20}</p>{comments}</article>{teaser}<div hidden><p>{long}</p></div>"
    assert H.main_text(page) == f"Head line\n{STORY}\n{STORY * 20}"
    assert H.main_text(f"<div><p>{STORY}</p></div><div class=sidebar><p>{STORY}</p></div><div id=comments><p>{long}</p></div>") == STORY


def flips(page):
    """Blocks whose label the cut changes against the sign of their cost."""
    found = H.blocks(page)
    keep = H.min_cut([b.cost for b in found], H.edges(found))
    return [(b.text, k) for b, k in zip(found, keep, strict=True) if k != (b.cost > 0)]


def test_the_cut_decides_doubtful_blocks():
    page = f"<div><h2>Part</h2><p>{STORY}</p><p>Yes.</p><p>{STORY}</p></div>"
    assert ("Yes.", True) in flips(page) and H.main_text(page) == f"Part\n{STORY}\nYes.\n{STORY}"
    links = "<li><a href=x>First link text</a></li><li><a href=x>Second link text</a></li>"
    page = f"<div><p>{STORY}</p><p>{STORY}</p></div><ul>{links}<li>More of these</li>{links}</ul>"
    assert flips(page) == [("More of these", False)] and H.main_text(page) == f"{STORY}\n{STORY}"
    # A list of sources inside an article: links, but its own.
    page = f"<article><p>{STORY}</p><p>See <a href=x>the first source</a> or</p><p>{STORY}</p></article>"
    assert H.main_text(page).count("\n") == 2
