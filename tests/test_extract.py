import pytest
from pyspark.sql import functions as F

from cardfold.operators import extract
from cardfold.operators.html import compile_selectors, html_nodes

BASE = "https://dir.example/directory/"

CARD = """
<section id="listings"><ul>
  <li data-post-id="77" class="wide jet-listing-grid__item">
    <h3 class="big elementor-heading-title"><a href="../directory/kea-tiling/">Kea <i>Tiling</i></a></h3>
    <p>not the excerpt</p>
    <a href="/location/otago/"><em class="elementor-icon-list-text">Otago</em></a>
    <a href="tel:03%20477%2000"><em class="elementor-icon-list-text">03 477 00</em></a>
    <a class="x jet-listing-dynamic-terms__link" href="/business-category/tilers/"> Tilers </a>
    <div class="elementor-widget-theme-post-excerpt"><p>Floors ,walls,roofs</p><p>second</p></div>
  </li>
</ul></section>
"""


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, html string")


def card(i, name=None, href=None):
    title = f'<h3><a href="{href or f"/directory/b-{i}/"}">{name}</a></h3>' if name else ""
    return f'<div class="jet-listing-grid__item" data-post-id="{i}">{title}</div>'


def test_directory_listing(spark):
    page = pages(spark, (BASE, CARD), ("https://dir.example/empty", "<p>none"))
    counts = {r.url: r.n_cards for r in extract.count_cards(page).collect()}
    assert counts == {BASE: 1, "https://dir.example/empty": 0}
    (row,) = extract.extract_listings(page).collect()
    assert row.asDict() == {
        "card": 0,
        "business_name": "Kea Tiling",
        "trade_category": "Tilers",
        "region": "Otago",
        "phone": "03 477 00",
        "description": "Floors, walls, roofs",
        "listing_url": "https://dir.example/directory/kea-tiling/",
        "source_url": BASE,
    }


def test_adjacent_anchors_stay_apart(spark):
    html = (
        '<div id="listings"><p class="jet-listing-grid__item" data-post-id><h3><a>Tui Solar</a></h3>'
        '<a class="jet-listing-dynamic-terms__link" href="/business-category/solar/">Solar</a>'
        '<a href="/location/nelson/"><b class="elementor-icon-list-text">Nelson</b></a></p></div>'
    )
    (row,) = extract.extract_listings(pages(spark, (BASE, html))).collect()
    assert (row.trade_category, row.region) == ("Solar", "Nelson")


def test_limit_counts_cards_before_the_name_check(spark):
    html = f'<div id="listings">{card(1)}{card(2, "B")}{card(3, "C")}</div>'
    rows = extract.extract_listings(pages(spark, (BASE, html)), limit=2).collect()
    assert [r.business_name for r in rows] == ["B"]
    with pytest.raises(ValueError):
        extract.extract_listings(pages(spark, (BASE, html)), limit=0)


def test_generic_listing_prefers_phone_link(spark):
    html = """<article><h4>Moa Decks</h4><u>Decking</u><a class="ring" href="tel:+6495550101">Ring us</a>
      <q>Decks &amp; fences.</q></article><article><h4>Second</h4><b class="ring">09 1 , 2</b></article>"""
    selectors = {
        "listing": "article",
        "business_name": "h4",
        "trade_category": "u",
        "phone": ".ring, a[href^='tel:']",
        "description": "article > q",
    }
    rows = extract.extract_listings_generic(pages(spark, (BASE, html)), selectors).collect()
    assert [r.phone for r in rows] == ["+6495550101", "09 1, 2"]
    directory = extract.extract_listings(pages(spark, (BASE, html)), selectors=selectors).collect()
    assert [r.phone for r in directory] == ["Ring us", "09 1 , 2"]
    assert rows[0].trade_category == "Decking" and rows[0].description == "Decks & fences."
    with pytest.raises(ValueError):
        extract.extract_listings_generic(pages(spark, (BASE, html)), {"nope": "p"})


def test_phone_falls_back_to_link(spark):
    html = """<div id="listings"><div class="jet-listing-grid__item" data-post-id="1">
      <h3><a>X</a></h3><a href="tel:0800%2012+3"><img src="p"></a></div></div>"""
    (row,) = extract.extract_listings(pages(spark, (BASE, html))).collect()
    assert row.phone == "0800 12+3"
    assert row.listing_url is None


def test_categories(spark):
    def link(slug, name):
        return f'<a href="/business-category/{slug}/">{name}</a>'

    def category_card(slug, name, count):
        return (
            f'<p class="jet-listing-grid__item"><span class="jet-engine-listing-overlay-wrap" '
            f'data-url="/business-category/{slug}/"><h5>{link(slug, name)}</h5>'
            f'<i class="jet-listing-dynamic-field__content">{count}</i></span></p>'
        )

    html = (
        category_card("roofs", "Old roofs", "(2)") + link("roofs", "roof") + link("plumbing", "Plumbing")
        + link("blank", " ") + link("plumbing", "Other name") + link("air", "air")
        + category_card("roofs", "Roofs", "all (1,089)")
    )
    rows = extract.discover_categories(pages(spark, (BASE, html)))
    got = rows.orderBy("sort_key", "first_at").collect()
    assert [(r.trade_category, r.category_url, r.listed_count) for r in got] == [
        ("air", "https://dir.example/business-category/air/", None),
        ("Plumbing", "https://dir.example/business-category/plumbing/", None),
        ("Roofs", "https://dir.example/business-category/roofs/", 1089),
    ]


def test_next_page_rules(spark):
    cases = {
        "https://d/c/": ('<a class="next page-numbers" href="/c/page/2/">More</a>', "https://d/c/page/2/"),
        "https://d/1": ('<a class="Next" href="/x">x</a><link rel="prev NEXT" href="/y">', "https://d/y"),
        "https://d/2": ('<a href="/n">nextgen</a><a href="/m">next</a>', "https://d/n"),
        "https://d/3": ('<a href="/a/page/1/">1</a><a href="/a/page/9/">9</a>', "https://d/a/page/1/"),
        "https://d/4": ('<a href="/a/PAGE/1/">1</a><a>next</a><link href="/next" class="next">', None),
        "https://d/5": ('<a href="">next', "https://d/5"),
    }
    rows = extract.next_page(pages(spark, *[(u, h) for u, (h, _) in cases.items()])).collect()
    assert {r.url: r.next_url for r in rows} == {u: want for u, (_, want) in cases.items()}


def test_detail(spark):
    wrap = '<div class="elementor-widget-theme-post-content"><div class="elementor-widget-container">{}</div></div>'
    rows = pages(
        spark,
        ("1", wrap.format("<p>We tile floors.</p>\n<p>And walls, since 1999.</p>")),
        ("2", wrap.format("<b>Neat</b>. Fair,fast <i>crew</i> , always")),
        ("3", "<p>nothing</p>"),
        ("4", wrap.format(" ")),
        ("5", wrap.format("a<!-- c -->b<script>no()</script> &amp; &lt;c&gt; &#8217;&nbsp;&foo; x<br>y")),
    )
    got = {r.url: r.description for r in extract.extract_detail(rows).collect()}
    assert got == {
        "1": "We tile floors. And walls, since 1999.",
        "2": "Neat. Fair, fast crew, always",
        "3": None,
        "4": None,
        "5": "a b & <c> ’ &foo x y",
    }


def test_lenient_tree(spark):
    # Unclosed paragraphs nest; a stray end tag is ignored; an end tag closes
    # everything inside its partner; void tags never hold content.
    html = "<div><p>one<p>two<br></i>three</div><p>four"
    rows = html_nodes(pages(spark, (BASE, html)), "p, div, br").orderBy("pre").collect()
    assert [(r.tag, r.pre, r.last, r.text) for r in rows] == [
        ("div", 0, 3, "one two three"),
        ("p", 1, 3, "one two three"),
        ("p", 2, 3, "two three"),
        ("br", 3, 3, ""),
        ("p", 4, 4, "four"),
    ]


def test_deep_nesting_stays_linear(spark):
    html = '<div id="x">' + "<p>word" * 20_000
    (row,) = html_nodes(pages(spark, (BASE, html)), "#x").collect()
    assert len(row.text.split()) == 20_000


def test_selectors(spark):
    html = """<div id="a" class="k m"><ul><li data-x="one two"><a href="/q">t</a></li></ul></div>
      <li><a href="/r">u</a></li>"""
    def texts(selector):
        return [r.text for r in html_nodes(pages(spark, (BASE, html)), selector).orderBy("pre").collect()]
    assert texts("#a.k.m a") == ["t"]
    assert texts("div > a") == [] and texts("li > a") == ["t", "u"]
    assert texts("li[data-x~='two'] a, a[href='/r']") == ["t", "u"]
    assert texts("a[href$=q]") == ["t"] and texts("a[href*='']") == []
    assert texts("#a *") == ["t", "t", "t"]
    for bad in ("a:hover", "a,,b", "> a", "a >", ""):
        with pytest.raises(ValueError):
            compile_selectors({"x": bad})


def test_null_page(spark):
    page = pages(spark, (BASE, None))
    assert extract.extract_listings(page).count() == 0
    assert extract.count_cards(page).first().n_cards == 0


def test_unclosed_cards_take_linear_time(spark):
    items = "".join(f"<li><a href='/p{i}'>shop {i}</a>" for i in range(50_000))
    pages = spark.createDataFrame([("http://h/", f"<nav>{items}</nav>")], "url string, html string")
    wanted = {"listing": "nav li", "business_name": "a", "listing_url": "a"}
    found = extract.extract_listings_generic(pages, wanted).agg(
        F.count("*").alias("n"), F.max("card").alias("last"), F.max_by("listing_url", "card").alias("url")
    )
    assert tuple(found.first()) == (50_000, 49_999, "http://h/p49999")
