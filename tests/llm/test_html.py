import random
import re

import pytest

from fennmark.llm import html_extract as h
from fennmark.llm import queries
from tests.oracle import SF

PROSE = "The article says that it is one of the things which they have been with for a long time, and it was so in the end of all."


def test_query_rows(spark):
    got = queries.op8_html(spark, SF).collect()
    assert len(got) == 50 and all(r.n_chars == len(r.text) and r.text for r in got)
    assert not any(mark in r.text for r in got for mark in ("<p>", "</", "&amp;", "track(", "margin:0"))


def test_article_without_what_is_around_it():
    page = f"""<!DOCTYPE html><html><head><title>No title</title><style>p{{a:b}}</style><script>var t="</p><p>no script";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">{PROSE} Cookies.</div><div id=ad-7>Buy {PROSE}</div>
    <article class=post><h1>Head &amp; title</h1><p>First&nbsp;<b>bold</b>\n\t text &#233;&lt;p&gt;.</p><!-- <p>no comment</p> --><aside>Sidebar {PROSE}</aside>
    <p>Unclosed <a href=y>a link</a><p>Next<br>line</p><table><tr><td>Cell one<td>Cell two</table><form><p>Sign up</p><input value=q></form></article>
    <section class="comments"><article class="comment"><p>Reader: {PROSE}</p></article></section><footer>&copy; Foot</footer></body></html>"""
    assert h.main_text(page) == "Head & title\n\nFirst bold text é<p>.\n\nUnclosed a link\n\nNext line\n\nCell one\n\nCell two"


def test_two_passes_without_an_article_element():
    links = " ".join(f"<a href=/{k}>Link number {k} of the list</a>" for k in range(20))
    page = f"<body><div>{links}</div><div>Home</div><h2>A heading</h2><p>{PROSE}</p><p>Short one.</p><p>{PROSE}</p><div>{links}</div><div>Imprint</div><div>{links}</div></body>"
    assert h.main_text(page) == f"A heading\n\n{PROSE}\n\nShort one.\n\n{PROSE}"


def test_second_pass_equals_brute_force():
    rng = random.Random(4)
    for _ in range(500):
        labels = [rng.choice([h.GOOD, h.BAD, h.OPEN]) for _ in range(rng.randrange(12))]
        want = []
        for k, label in enumerate(labels):
            near = sorted((abs(j - k), -x) for j, x in enumerate(labels) if x != h.OPEN)
            want.append(label if label != h.OPEN else -near[0][1] if near else h.BAD)
        assert h.second_pass(labels) == want


def test_odd_pages(spark):
    pages = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (4, "u", "no markup & none"), (5, "u", "<article><p>" + "word and the " * 100_000 + "</article>"), (5, "u", "<article>same</article>"), (5, "u", "<article>same</article>"), (6, "u", "<div" * 5000), (7, "u", "<article>1 < 2 &bogus; &#x1F600;</article>"), (8, "u", "<script>never closed"), (9, "u", "</div></p></article>" * 1000)]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, text string, label int")
    got = h.extract_pages(df).collect()
    assert got[0].text == got[1].text == got[2].text == "" and len(got) == len(pages)
    assert got[4].text == ("word and the " * 100_000).strip()
    assert got[5].text == got[6].text == "same" and got[8].text == "1 < 2 &bogus; \U0001f600" and got[9].text == ""
    assert h.extract_pages(df.limit(0)).count() == 0


def test_a_teaser_article_does_not_hide_the_body():
    page = f"<body><article><h3>Card</h3><p>{PROSE} Teaser text.</p></article><div><h1>Title</h1><p>{PROSE} One.</p><p>Short.</p><p>{PROSE} Two.</p></div></body>"
    got = h.main_text(page)
    assert f"{PROSE} One.\n\nShort.\n\n{PROSE} Two." in got


def test_link_lists_inside_an_article_go():
    links = "".join(f"<li><a href=/{k}>Another story number {k}</a></li>" for k in range(8))
    page = f"<body><article><h1><a href=/me>Title</a></h1><p>{PROSE} One.</p><p>Short.</p><p>{PROSE} Two.</p><ul>{links}</ul></article></body>"
    assert h.main_text(page) == f"Title\n\n{PROSE} One.\n\nShort.\n\n{PROSE} Two."
    bare = h.main_text(page.replace("<article>", "<div>").replace("</article>", "</div>"))
    assert "Another story" not in bare and f"{PROSE} One.\n\nShort.\n\n{PROSE} Two." in bare


def pages_of(spark):
    return [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()]


def test_rules_decide_inside_articles_too(spark):
    """On the driver's pages blocks are decided by stop-word density and by link density, and others are open and inherit."""
    kinds = {"dropped": 0, "links": 0, "density": 0, "open": 0}
    for page in pages_of(spark):
        for block in h.blocks(page):
            label = h.first_pass(*block)
            kinds["links" if block[1] > h.LINKS * len(block[0]) else "dropped" if block[2] else "open" if label == h.OPEN else "density"] += 1
            assert label != h.GOOD or h.stop_share(block[0]) >= h.STOPS_INSIDE
    assert min(kinds.values()) > 50


def test_inherited_bad_and_good():
    links = "".join(f"<p><a href=/{k}>Another story of ours, number {k}</a></p>" for k in range(4))
    page = f"<article><p>{PROSE}</p><p>Short.</p>{links}<p>Share it.</p>{links}<table><tr><td>{'12 | 7 | ' * 12}</table><p>{PROSE}</p></article>"
    assert h.main_text(page) == f"{PROSE}\n\nShort.\n\n{('12 | 7 | ' * 12).strip()}\n\n{PROSE}"


@pytest.mark.parametrize("around", ["<aside class=related>{}</aside>", "<footer>{}</footer>", "<nav>{}</nav>", "<div class=sidebar><div>{}</div></div>", "<div class=comments>{}</div>"])
def test_articles_within_what_is_dropped_stay_dropped(around):
    card = around.format(f"<article><h3>Card</h3><p>{PROSE} Card.</p></article>")
    assert h.main_text(f"<body>{card}<article><h1>Title</h1><p>{PROSE}</p></article>{card}</body>") == f"Title\n\n{PROSE}"
    assert h.main_text(f"<body><nav><ul><li>Never closed<article><h1>Title</h1><p>{PROSE}</p></article></body>") == f"Title\n\n{PROSE}"


def test_names_that_an_article_bears_itself():
    page = f"<article><div class='post-header'><h1>Title</h1></div><p>{PROSE}</p><section class=discussion><h2>Discussion</h2><p>{PROSE} D.</p></section><div class=comments><p>{PROSE} C.</p></div></article>"
    assert h.main_text(page) == f"Title\n\n{PROSE}\n\nDiscussion\n\n{PROSE} D."
    assert h.main_text(f"<div class=discussion><p>{PROSE} D.</p></div><p>{PROSE}</p>") == PROSE


def test_pages_stripped_of_article_tags_keep_their_text(spark):
    """Against the text with the article element as prior: of the characters 0.95 stay, and next to nothing else comes."""
    want = kept = more = 0
    for page in pages_of(spark):
        text = set(h.main_text(page).split("\n\n"))
        bare = set(h.main_text(re.sub(r"</?(article|main)\b[^>]*>", "", page)).split("\n\n"))
        want, kept, more = want + sum(map(len, text)), kept + sum(map(len, text & bare)), more + sum(map(len, bare - text))
    print("without article tags", kept / want, more / want)
    assert kept >= 0.95 * want and more <= 0.05 * want


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<p>{PROSE}</p>", PROSE),
        (f"<div><p>{PROSE}</p><p>{PROSE}</p></div>", f"{PROSE}\n\n{PROSE}"),
        (f"<h1>A title</h1><p>{PROSE}</p>", f"A title\n\n{PROSE}"),
        (f"<ul class=menu><li>One<li>Two</ul><p>{PROSE}</p>", PROSE),
        (f"<p>{PROSE}</p><footer>{PROSE}</footer>", PROSE),
        (f"<p>{PROSE}</p><p>Short end.</p>", f"{PROSE}\n\nShort end."),
        (f"<div id=sidebar>{PROSE}</div><p>{PROSE}</p>", PROSE),
        (f"<p><a href=x>{PROSE}</a></p><p>{PROSE}</p>", PROSE),
        (f"<form><p>{PROSE}</p></form><blockquote>{PROSE}</blockquote>", PROSE),
        ("<p>Short alone.</p>", ""),
        (f"<nav>{PROSE}</nav>", ""),
        (f"<p>{PROSE}</p><p><a href=1>More one</a> <a href=2>More two</a></p><p>{PROSE}</p>", f"{PROSE}\n\n{PROSE}"),
    ],
)
def test_small_pages_without_an_article_element(page, text):
    assert h.main_text(f"<html><body>{page}</body></html>") == text
