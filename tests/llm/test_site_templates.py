"""Main text of pages that name nothing: what recurs on a site is deleted, what does not stays."""

import random

import pytest

from airway.llm import html_extraction

WORDS = "river stone copper lantern harbour meadow winter signal orchard ribbon castle engine valley planet garden".split()


def text_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["id"]: r["text"] for r in html_extraction.extract_main_text(pages).collect()}


def one(body):
    root = html_extraction.parse(f"<html><body>{body}</body></html>")
    return "\n".join(b for t in html_extraction.main_elements(root)[0] for b in html_extraction.blocks(t))


def test_unnamed_menus_footers_and_promos_go_by_recurrence(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for site in range(3):
        for n in range(30):
            # The open entry of the menu differs; promos are three per site and stand between paragraphs.
            menu = "".join(f"<div><a href='/{w}'>{w} of site {site}</a></div>" for w in WORDS[:6] if WORDS.index(w) != n % 6)
            promo = f"<div><p>Read more about {WORDS[n % 3]} on site {site} today</p></div>"
            story = [" ".join(rng.choices(WORDS, k=30)) + f" {site}.{n}.{i}" for i in range(4)]
            body = f"<p>{story[0]}</p><p>{story[1]}</p>{promo}<p>{story[2]}</p><p>{story[3]}</p>"
            page = f"<body><div>{menu}</div><div>{body}</div><div><p>All rights of site {site} reserved</p></div></body>"
            key = 100 * site + n
            rows.append((key, f"https://s{site}.example/{n}", page))
            want[key] = "\n".join(story)
    assert text_of(spark, rows) == want


def test_template_of_marked_pages_helps_pages_that_mark_nothing(spark):
    foot = "<div><p>Printed by the harbour press</p></div>"
    rows = [(n, f"https://a.example/{n}", f"<body><article><p>Story {n}</p></article>{foot}</body>") for n in range(20)]
    rows += [(50, "https://a.example/50", f"<body><div><p>Story 50</p></div>{foot}</body>")]
    # Inside an article the same words are its own.
    rows += [(51, "https://a.example/51", f"<body><article><p>Story 51</p>{foot}</article></body>")]
    found = text_of(spark, rows)
    assert found[50] == "Story 50" and found[51] == "Story 51\nPrinted by the harbour press"
    assert all(found[n] == f"Story {n}" for n in range(20))


def test_a_page_of_template_alone_has_no_text(spark):
    foot = "<div><p>Printed by the harbour press</p></div>"
    rows = [(n, f"https://a.example/{n}", f"<body><div><p>Story {n}</p></div>{foot}</body>") for n in range(20)]
    assert text_of(spark, [*rows, (50, "https://a.example/50", f"<body>{foot}</body>")])[50] == ""


def test_empty_table_and_very_long_pages(spark):
    assert text_of(spark, [(1, "u", None)])[1] == ""
    assert spark.createDataFrame([], "page_id long, url string, html string").transform(html_extraction.extract_main_text).count() == 0
    long = "<body>" + "".join(f"<p>paragraph {i}</p>" for i in range(60_000)) + "</body>"
    assert text_of(spark, [(1, "https://a.example/", long), (1, "https://a.example/", long)])[1].count("\n") == 59_999


@pytest.mark.parametrize(
    "part",
    [
        '<h2 id="social-impact">Social impact</h2>',
        '<h2 class="related">Related</h2>',
        '<h2 id="recommended-settings">Recommended settings</h2>',
        '<section id="related-work"><p>Earlier work</p></section>',
        '<section id="cookies"><h2>Cookies</h2><p>Bake them</p></section>',
        '<section id="discussion"><h2>Discussion</h2><p>We found</p></section>',
        '<p class="share-price">Shares rose</p>',
        '<div class="notice-period"><p>Three months</p></div>',
        '<div class="with-sidebar"><p>Wide text</p></div>',
    ],
)
def test_names_made_from_texts_lose_nothing(part):
    import re

    inner = [b for b in re.split(r"<[^>]+>", part) if b]
    assert one(f"<article><h1>Head</h1><p>First</p>{part}<p>Last</p></article>") == "\n".join(["Head", "First", *inner, "Last"])
    assert one(f"<div><h1>Head</h1><p>First</p>{part}<p>Last</p></div>") == "\n".join(["Head", "First", *inner, "Last"])


@pytest.mark.parametrize(
    "part",
    [
        '<div class="ad-slot-2"><p>Buy</p></div>',
        '<div class="site-footer">Imprint</div>',
        '<section class="relatedPosts"><p>Other</p></section>',
        '<div id="comments"><p>Reader</p></div>',
        '<section class="responses"><p>Reader</p></section>',
        '<div class="discussion"><p>Reader</p></div>',
        '<article class="ad promo"><p>Buy</p></article>',
        '<div class="cookie-consent-banner">Accept</div>',
        "<form><p>Sign up</p></form>",
    ],
)
def test_named_containers_go(part):
    assert one(f"<article><h1>Head</h1>{part}<p>Last</p></article>") == "Head\nLast"
    assert one(f"<div><h1>Head</h1>{part}<p>Last</p></div>") == "Head\nLast"
    assert one(f"{part}<article><h1>Head</h1><p>Last</p></article>{part}") == "Head\nLast"


def test_what_never_ends_swallows_nothing():
    menu = '<ul><li><a href="/">Home</a></ul>'
    assert one(f"<nav>{menu}<div><h1>Head</h1><p>Story</p></div>") == "Head\nStory"
    assert one(f"<div><nav>{menu}</div><div><h1>Head</h1><p>Story</p></div>") == "Head\nStory"
    assert one('<div class="ad"><p>Buy<div><p>Story</p>') == "Buy\nStory"
    assert one("<form><div><h1>Head</h1><p>Story</p></div></form>") == "Head\nStory"
