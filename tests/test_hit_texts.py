"""Hits read in one go against the same selections over node arrays."""

import random

import pytest
from pyspark.sql import functions as F

from dwellframe.functions.select import El
from dwellframe.operators import extract
from dwellframe.plans.driver_views import search_pages
from dwellframe.plans.site_rules import FIRST, SITES, AfterLabel, Attr, LabelledItem, RunValue, SiteRules, Take, Texts

JOINED = Take(sep="|", when_empty="")
OWN = SiteRules(
    page_style="path", blocks=(El("div", cls="hit"),), page_fields={},
    hit_fields={
        "href": (Attr((El("a"),), "href"), FIRST),
        "property_price_raw": (AfterLabel("Price", "b", "i"), JOINED),
        "property_size_raw": (LabelledItem("Size"), JOINED),
        "property_area": (Texts((El("p"), El("span", child=True))), JOINED),
        "posted_date": (Texts((El("div"), El("p"), El("span"))), JOINED),
        "link": (RunValue("type"), FIRST),
    },
)
PIECES = {
    "own": ['<div class="hit">', "<div>", "</div>", "<b>", "Price", "</b>", "<i>", "1 &amp; 2", "</i>", '<ul class="list-info clearfix">', "<ul>", "<li>", "Size",
            "</li>", "</ul>", "<p>", "</p>", "<span>", "</span>", "x", '<a href="/a&amp;b">', "<a href=/c HREF='/d'>", "</a>", "<script>s<p></script>", "<!-- c -->",
            "<td>", "<table>", "</table>", "<br>", "</html>"],
    "bds": ['<div class="vip0 hit">', '<div class="vip1">', "<div>", "</div>", '<div class="p-title">', '<a  href=" /x ">', "<a>", "</a>", "<span>", "</span>",
            '<span class="product-price" id="a">', '<span class="product-city-dist">', "t", "5&nbsp;ty", '<div class="floatright">', "<p>", "<style>z</style>"],
    "tbds": ['<div class="col-gr-75per">', '<ul class="group-prd">', "<li>", "</li>", "</ul>", "</div>", '<div class="content">', '<div class="title">', '<div class="info">',
             '<a href="/y">', "</a>", "<span>", "</span>", '<p class="fsize-13">', "u", "v", "</p>"],
    "mbnd": ['<div class="x resultItem">', '<div class="resultItem resultItem">', '<div class="row title">', '<a href="/z">', "</a>", "</div>", '<p class="listing-price">', "7 ty", '<div class="lline col-xs-12">',
             '<div class="row lline">', '<div class="col-xs-6">', "q", "</p>", "<td>", "</td>", '<div class="col-lg-4 lline hidden-xs">'],
}


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(8)
    rows = [(i, site, "".join(rng.choice(PIECES[site]) for _ in range(rng.randrange(70)))) for i in range(250) for site in [*PIECES][i % 4:i % 4 + 1]]
    rows += [(900, "own", None), (901, "own", ""), (902, "none", '<div class="hit">'), (903, None, "<p>"), (904, "own", '<div class="hit">' * 60 + "x")]
    made = spark.createDataFrame(rows, "page_id long, site string, html string")
    return made.select("*", F.lit("http://v").alias("vendor"), F.lit("sell").alias("type"), F.lit("/ban.htm").alias("crawl_url"), F.lit("2024-01-01").cast("timestamp").alias("crawled_date"))


def test_hits_are_the_same_as_selected_over_node_arrays(pages):
    sites = {**SITES, "own": OWN}
    fields = extract._fields(sites, "hit_fields")
    arrays = extract.hit_rows(extract.search_nodes(pages, sites), sites, keep_empty=True)
    want = arrays.select("page_id", "hit_no", *[c.cast("string").alias(n) for n, c in fields.items()]).collect()
    rules = extract.hit_rules(sites)
    found = list(dict.fromkeys(n for r in rules.values() for n in r.fields))
    hits = extract.with_hits(pages, rules, found, keep_empty=True)
    got = hits.select("page_id", "hit_no", *[extract._field_of_hits(sites, n).cast("string").alias(n) for n in fields]).collect()
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len(got) > 600 and all(any(r[n] for r in got) for n in fields)
    assert len({r.page_id for r in got}) == 255


def test_nodes_stay_in_python(spark):
    """Only the selected texts cross over to the JVM."""
    text = extract.extract_hits(search_pages(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "elements" not in text and "own_text" not in text
