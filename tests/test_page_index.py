"""Marks and slices of a page against searching it, and pages of a size that searching could not do."""

import time

from pyspark.sql import functions as F

from dwellframe.functions import select as sel
from dwellframe.functions.select import El
from dwellframe.operators import extract
from dwellframe.plans import driver_views as dv
from dwellframe.plans.site_rules import SITES
from dwellframe.sources import html_nodes
from dwellframe.sources.html_nodes import Names, parse_page, with_nodes

SF = "/root/testdata/sf0.001"


def page(spark, html):
    return with_nodes(spark.createDataFrame([(1, html)], "page_id int, html string"))


def test_marked_fields_equal_searched_ones(spark):
    pages = dv.detail_pages(spark, SF)
    marked = with_nodes(pages, extract.page_names(SITES, "page_fields"))
    searched = with_nodes(pages).withColumns({"elements_before": F.lit(0), "texts_before": F.lit(0)})
    for site, rules in SITES.items():
        marks = extract._marks(rules, "page_fields")
        sources = {f"f{n}": source for n, (source, _) in enumerate(rules.page_fields.values())}
        one = marked.filter(F.col("site") == site).select("page_id", *[F.expr(extract._values(s, marks)).alias(n) for n, s in sources.items()])
        two = searched.filter(F.col("site") == site).select("page_id", *[F.expr(extract._values(s)).alias(n) for n, s in sources.items()])
        rows = sorted(one.collect())
        assert rows == sorted(two.collect()) and rows
    few = marked.agg(F.sum(F.size("elements"))).first()[0]
    assert 0 < few < searched.agg(F.sum(F.size("elements"))).first()[0]


def test_slices_are_the_insides():
    html = "a<div>b<p>c<i>d</i><p>e</div>f<ul><li>g<li>h<b>i</b></ul><script>x<y></script>j"
    elements, texts = parse_page(html)
    for e in elements:
        inner = [x["place"] for x in elements if e["seq"] < x["seq"] <= e["end_seq"]]
        assert inner == list(range(e["place"] + 1, e["place"] + 1 + e["size"]))
        told = [n + 1 for n, t in enumerate(texts) if e["seq"] < t["seq"] <= e["end_seq"]]
        assert told == list(range(e["text_place"], e["text_place"] + e["n_texts"]))
        own = [n + 1 for n, t in enumerate(texts) if t["parent_seq"] == e["seq"]]
        assert e["own"] == own and e["own_text"] == (texts[own[0] - 1]["text"] if own else None)


def test_elements_around_each_other_give_their_insides_once_and_in_order(spark):
    nested = page(spark, "<div class=o>1<div class=o>2<a>x</a>3</div>4<a>y</a></div><div class=o><a>z</a></div>")
    outer = El("div", cls="o")
    get = lambda e: nested.select(F.expr(e)).first()[0]
    assert get(sel.own_texts(sel.elements_at(outer, El("a")))) == ["x", "y", "z"]
    assert get(sel.own_texts(sel.elements_at(outer, El("a", child=True)))) == ["x", "y", "z"]
    assert get(sel.own_texts(sel.elements_at(outer))) == ["1", "2", "3", "4"]
    assert get(sel.all_texts(sel.elements_at(outer))) == ["1", "2", "x", "3", "4", "y", "z"]


def test_marks_of_labels_and_dropped_nodes(spark):
    html = "<p>Tel</p><p>x</p><div>Tel: <i>no</i></div><span>1</span><div>else</div><div><b>q</b>Tel</div><span>2<u>3</u></span><div>Tel</div>"
    names = Names([("b", (), None, None, None, 1)], [("div", "Tel", "span", 0)], 2)
    got = with_nodes(spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string"), names).orderBy("page_id").collect()
    assert [e["tag"] for e in got[0].elements] == ["span", "b", "span"]
    assert got[0].marks == [[1, 3], [2]] and [t["text"] for t in got[0].texts] == ["1", "q", "2", "3"]
    assert got[1].marks == got[2].marks == [[], []]
    plain = page(spark, html).select(F.expr(sel.texts_after_label("div", "Tel", "span"))).first()[0]
    assert plain == ["1", "2", "3"]


def test_deep_and_long_pages_take_time_in_proportion(spark):
    began = time.time()
    for html in ("<div>" * 60_000, "<p><table><tr><td>" + "<div>" * 60_000, "<ul>" + "<li>a<ul>" * 40_000, "<b>x" * 60_000 + "</i>" * 60_000):
        parse_page(html)
    assert time.time() - began < 30  # minutes, if open tags were searched
    hit = '<div class="vip0"><div class="p-title"><a href="/x-pr{0}.htm">go</a></div><span class="product-price">{0} ty</span></div>'
    label = "<div>Số tầng</div><div>{0} tầng</div>"
    many = 20_000
    rows = [(1, "bds", "http://v", "sell", "/ban/x.htm", "".join(hit.format(i) for i in range(many))), (2, "bds", "http://v", "sell", "/ban/x.htm", "none")]
    pages = spark.createDataFrame(rows, "page_id int, site string, vendor string, type string, crawl_url string, html string")
    hits = extract.extract_hits(pages).select("hit_no", "property_id", "property_price").collect()
    assert sorted((r.hit_no, r.property_id, r.property_price) for r in hits) == [(i, str(i), float(i)) for i in range(many)]
    long = spark.createDataFrame([(1, "bds", "http://v", "sell", "u", "".join(label.format(i) for i in range(many)))], "page_id int, site string, vendor string, type string, url string, html string")
    assert extract.extract_listings(long).first().num_floors == 0
    assert time.time() - began < 120


def test_search_pages_are_read_only_as_far_as_rules_name_them(spark):
    """Elements tell which rules they fulfil, instead of all they have; blocks alone need none of the fields."""
    hit = '<div class="x resultItem" id=i><div class="row title"><a href="/h" title=t>go</a></div><p class="listing-price">1</p></div>'
    pages = spark.createDataFrame([(1, "mbnd", f"<p>no</p>{hit}{hit}")], "page_id int, site string, html string")
    page = extract.search_nodes(pages).first()
    marks = extract._marks(SITES["mbnd"], "hit_fields")
    assert "class_attr" not in page.elements[0] and [e.fits for e in page.elements if e.attrs] == [[marks[El("a")]]] * 2
    assert [e.attrs for e in page.elements if e.attrs] == [{"href": "/h"}] * 2 and page.marks == [[1, 5]]
    blocks = extract.search_nodes(pages, part="blocks")
    assert [e.fits for e in blocks.first().elements] == [[0], [0]]
    assert extract.page_blocks(blocks).first().n_hits == 2


def test_short_markup_is_read_once():
    """Recurring pieces of markup are kept a while, those told for some names apart from those read whole."""
    known, names = {}, Names([("b", (), None, None, None, 0)], [], 1, frozenset(["k"]))
    piece = html_nodes.read_piece('<b k="1&amp;2" l=3>', names, known)
    assert known['<b k="1&amp;2" l=3>'] is piece and piece.attrs == {"k": "1&2"} and piece.fits == [0]
    assert html_nodes.read_piece("<!-- x -->", None, known) is None and html_nodes.read_piece("</B >", None, known).closes
    for text in ("<SCRIPT a='>'>x</b></script>", "<script/>", "<style>a", '<a b="', "<a b='>'>", "<span/>", "</ p>", "<ſ>", "<?x"):
        assert "".join(html_nodes.MARKUP.split(f"1{text}2")) == f"1{text}2"
    assert html_nodes.MARKUP.split("a<style b>c<d></STYLE >e<strong f='>'>g")[1::2] == ["<style b>c<d></STYLE >", "<strong f='>'>"]


def test_reasons_are_told_without_extracting_the_rest(spark):
    pages = spark.createDataFrame(
        [(1, "bds", "v", "sell", "/c.htm", "2024-01-01", "<div class=vip></div>")], "page_id int, site string, vendor string, type string, crawl_url string, crawled_date string, html string"
    )
    _, bad = extract.quarantine(extract.extract_hits(pages))
    only = bad.select("page_id", "_errors")
    assert [tuple(r) for r in only.collect()] == [(1, ["missing link"])] and bad.columns[-1] == "_errors"
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "property_price_raw" in text(bad) and "property_price_raw" not in text(only)
