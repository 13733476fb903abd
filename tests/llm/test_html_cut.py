"""Main text of pages: labels against all labellings, texts against what the pages say."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm.html_cut import PRIOR, PRIOR_WEIGHT, Network, blocks_of, extract_main_text, fit, main_text

LONG = "The river rose again in the night, and by morning the lower fields were under water from end to end. "


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 8).flatmap(lambda n: st.tuples(st.lists(st.integers(-9, 9), min_size=n, max_size=n), st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(0, 9)), max_size=14))))
def test_cut_is_the_least_of_all_labellings(case):
    gain, edges = case
    net = Network(len(gain))
    net.gain = list(gain)
    for a, b, c in edges:
        net.join(a, b, c)

    def cost(labels):
        return sum(max(0, -g) if x else max(0, g) for g, x in zip(gain, labels)) + sum(c for a, b, c in edges if labels[a] != labels[b])

    every = {labels: cost(labels) for labels in itertools.product((False, True), repeat=len(gain))}
    least = min(every.values())
    got = tuple(net.cut())
    assert every[got] == least
    # Ties are on the sink side: the least source side of all minimum cuts.
    assert all(all(y or not x for x, y in zip(got, labels)) for labels, c in every.items() if c == least)


def test_cut_of_a_large_network():
    rng = random.Random(7)
    net = Network(30000)
    net.gain = [rng.randint(-40, 40) for _ in range(30000)]
    for a in range(29999):
        net.join(a, a + 1, 60)
        if a % 100:
            net.join(a, a - a % 100, 30)
    labels = net.cut()
    assert 0 < sum(labels) < 30000


ARTICLE = f"""<!DOCTYPE html><html><head><title>T &lt; U</title><style>p {{ }}</style><script>document.write("<p>no</p>")</script></head>
<body class="has-sidebar single-post"><header><a href="/">Site</a><p>The site of many things and of much more than that.</p></header><nav><ul><li><a href=a>Home</a><li><a href=b>World news of today</a></ul></nav>
<div id="cookie-notice"><p>We use cookies to make this site better for you. {LONG}</p></div>
<main class="with-sidebar"><article class="post comments-open"><header class="entry-header"><h1>Flood &amp; water</h1></header>
<p>{LONG}<a href=x>One</a> link&nbsp;here, <b>bold</b>ly.<br>After a break.</p><!-- a <p>comment</p> --><ul><li>first</li><li>second point</li></ul>
<aside><p>{LONG} Aside.</p></aside><div class="advert">Buy it now. {LONG}</div><p>Short.</p><form><label>Mail</label><input><button>Send</button></form>
<div class="share-buttons"><a href=s>Share</a></div><p>Last &#8220;words&#x201D; 1 &lt; 2 &amp &notit; end.</p>
<footer>Filed under water.</footer></article>
<section id="comments"><h2>2 comments</h2><ol><li><p>{LONG * 4} I say.</p></li><li><p>{LONG * 3} No.</p></li></ol></section></main>
<div class="sidebar"><article><h3>Teaser</h3><p>{LONG} Teaser.</p></article></div><footer>&copy; 2024 The site. All rights reserved.</footer></body></html>"""


def test_article_with_everything_around_it():
    want = f"Flood & water {LONG}One link\xa0here, boldly. After a break. first second point Short. Last “words” 1 < 2 & ¬it; end."
    assert main_text(ARTICLE)[0] == want


def test_pages_without_names_go_by_the_classifier():
    page = f"<div><a href=a>Home</a> <a href=b>News</a> <a href=c>About us</a></div><div><div><div>{LONG * 2}</div><div>{LONG * 3}</div><div>He left.</div><div>{LONG}</div></div></div><div><a href=q>Terms</a> <a href=r>Privacy policy</a></div><div>© 2024 All rights reserved</div>"
    assert main_text(page)[0] == f"{LONG * 2}{LONG * 3}He left. {LONG}".strip()


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("  <p> \n </p>", ""),
        ("<nav><a href=a>Home</a></nav><footer>Foot of the page.</footer>", ""),
        (f"<article><p>{LONG}<p>two  \t\n words<p><b>open<br><p>next</article>", f"{LONG}two words open next"),
        (f"<article>{LONG}<p>half a ref &amp; &am", f"{LONG}half a ref & &am"),
        (f"<article>{LONG}<p>1 <2 and a<b c", f"{LONG}1 <2 and a"),
        (f"<article><p>{LONG}</p><script>if (a < b) '</p>'</script><p title='a > b'>Shown.</p><style>x", f"{LONG}Shown."),
        (f"<article><p>{LONG}</p><svg><text>no</text><p>Kept, since it is never closed.</p>", f"{LONG}no Kept, since it is never closed."),
        (f"<article><table><tr><td>{LONG}<td>b<tr><td>c</table></article>", f"{LONG}b c"),
        (f"<ARTICLE><P>{LONG}</P><NAV><A HREF=x>Next</A></NAV></ARTICLE>", LONG.strip()),
        (f"<div class='page-wrapper sidebar-layout'><article><h1>Head</h1><p>{LONG * 3}</p></article></div><p class=ad>{LONG}</p>", f"Head {LONG * 3}".strip()),
        (f"<div role=main><p>{LONG}</p></div><div role=contentinfo><p>{LONG}</p></div><div role=\"complementary\">{LONG}</div>", LONG.strip()),
        ("😀 &#128512; &#x0; &bogus; &#xD800;", ""),
    ],
)
def test_small_pages(page, want):
    assert main_text(page)[0] == want


def test_words_of_content_stay_whole_and_in_order():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    parts = "".join(rng.choice(["<p>", "</p>", "<b>", "</b>", " ", "<br>", "<i>", "</i>", "<div>", "</div>", "<li>", "\n"]) + " " + w + " " for w in words)
    assert main_text(f"<article>{parts}</article>")[0].split() == words


def test_long_and_odd_pages_take_linear_time():
    for page in ("<p>" * 50000, "<a href='" * 20000, "<!--" * 20000, "<b>x" * 5000, "<div class=comment>" * 2000, "&" * 50000, "<" * 50000, 'a="' * 50000):
        main_text(page)
    assert main_text("<article>" + f"<p>{LONG}</p>" * 5000 + "</article>")[0] == " ".join([LONG.strip()] * 5000)


def test_blocks_know_their_links():
    blocks, _ = blocks_of("<ul><li><a href=a>one two</a> three</li></ul><p>x <a>y</a></p>")
    assert [(b.text, b.words, b.linked) for b in blocks] == [("one two three", 3, 2), ("x y", 2, 1)]


def test_fit_learns_and_stays_near_the_prior_without_data():
    assert (fit(np.empty((0, len(PRIOR))), np.empty(0), np.empty(0)) == np.array(PRIOR)).all()
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(400), rng.integers(0, 9, (400, len(PRIOR) - 1))])
    y = (x[:, 3] > 4).astype(float)
    w = fit(x, y, np.ones(400))
    assert ((x @ w > 0) == (y == 1)).mean() > 0.9
    # The gradient of the penalised loss, both labels weighing 500, is 0 there.
    weight = np.where(y == 1, 500 / y.sum(), 500 / (1 - y).sum())
    assert np.abs(x.T @ (weight * (1 / (1 + np.exp(-x @ w)) - y)) + PRIOR_WEIGHT * (w - np.array(PRIOR))).max() < 1e-6


def test_edge_rows(spark):
    rows = [(1, "u", ARTICLE, "a"), (1, "u", ARTICLE, "b"), (None, None, None, "c"), (2, None, "", "d"), (3, "v", "plain", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in extract_main_text(pages).collect()), key=str)
    text = main_text(ARTICLE)[0]
    assert got == sorted([(1, "u", text, len(text)), (1, "u", text, len(text)), (None, None, "", 0), (2, None, "", 0), (3, "v", "", 0)], key=str)
    empty = extract_main_text(pages.limit(0))
    assert empty.collect() == [] and empty.columns[:4] == ["page_id", "url", "text", "n_chars"]


def test_given_pages_give_their_articles(spark):
    """All that an article element holds, by a plain reading of these well-formed articles."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = extract_main_text(pages).collect()
    assert len(got) == len(source)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", source[r["page_id"]], re.S)[1]
        assert r["text"].split(" ") == html.unescape(re.sub(r"<[^>]*>", " ", inner)).split()
