"""Page parsing, selections and the site rules on hand-written pages."""

import datetime as dt
import unicodedata
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from dwellframe.functions import select as sel
from dwellframe.operators import extract
from dwellframe.plans.site_rules import SITES, AfterLabel, LabelledItem
from dwellframe.schemas import LISTING
from dwellframe.sources.html_nodes import html_nodes, parse_page, with_nodes

AT = dt.datetime(2024, 1, 1)


def tree(html):
    elements, texts = parse_page(html)
    by_seq = {e["seq"]: e["tag"] for e in elements}
    return (
        [(e["tag"], by_seq.get(e["parent_seq"])) for e in elements],
        [(t["text"], by_seq.get(t["parent_seq"])) for t in texts],
    )


@pytest.mark.parametrize("html, elements, texts", [
    ("<p>a<p>b", [("p", None), ("p", None)], [("a", "p"), ("b", "p")]),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", [("ul", None), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul")],
     [("a", "li"), ("b", "li"), ("c", "li")]),
    ("<table><tr><td>a<td>b<tr><th>c</table>d",
     [("table", None), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"), ("th", "tr")],
     [("a", "td"), ("b", "td"), ("c", "th"), ("d", None)]),
    ("<select><option>a<option>b</select>", [("select", None), ("option", "select"), ("option", "select")],
     [("a", "option"), ("b", "option")]),
    ("<p><b>x<br><div>y</div>", [("p", None), ("b", "p"), ("br", "b"), ("div", None)], [("x", "b"), ("y", "div")]),
    ("a<!-- <b>no</b> -->c", [], [("a", None), ("c", None)]),
    ("<script>'</p>'<b></script>t", [("script", None)], [("'</p>'<b>", "script"), ("t", None)]),
    ("<style>x", [("style", None)], [("x", "style")]),
    ("x < y &lt; z", [], [("x < y < z", None)]),
    ("</b><i>a</b></i>", [("i", None)], [("a", "i")]),
    ("<b><table><tr><td>a</b>c</table>", [("b", None), ("table", "b"), ("tr", "table"), ("td", "tr")], [("a", "td"), ("c", "td")]),
    ('<a title="a>b" x>c</a><a y="d>e</a>', [("a", None), ("a", None)], [("c", "a"), ("e", "a")]),
    ("", [], []), (None, [], []), ("<", [], [("<", None)]), ("<!-- open", [], []),
])
def test_tree(html, elements, texts):
    assert tree(html) == (elements, texts)


def test_attributes():
    elements, _ = parse_page("<IMG SRC='a&amp;b' alt=x disabled class=' p  q '><img src=/z/>")
    assert elements[0]["attrs"] == {"src": "a&b", "alt": "x", "disabled": "", "class": " p  q "}
    assert elements[0]["classes"] == ["p", "q"] and elements[0]["tag"] == "img"


def test_intervals_nest():
    elements, texts = parse_page("<div>a<p>b<i>c</i><p>d</div>e")
    spans = {e["tag"] + str(e["seq"]): (e["seq"], e["end_seq"]) for e in elements}
    assert spans == {"div0": (0, 7), "p2": (2, 5), "i4": (4, 5), "p6": (6, 7)}
    assert [t["seq"] for t in texts] == [1, 3, 5, 7, 8]


def test_long_broken_pages_are_read_in_reasonable_time():
    for html in ("<a " * 50_000 + '"', "<a 'x" * 50_000, "<" * 200_000, "<!--" * 50_000, "<script>" * 20_000):
        parse_page(html)


class Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.text = [], []

    def handle_starttag(self, tag, attrs):
        self.tags.append((tag, dict(attrs)))

    def handle_data(self, data):
        self.text.append(data)


def test_driver_pages_read_as_the_standard_parser_reads_them(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect():
        reader = Reader()
        reader.feed(row.html)
        reader.close()
        elements, texts = parse_page(row.html)
        assert [(e["tag"], e["attrs"]) for e in elements] == reader.tags
        assert "".join(t["text"] for t in texts) == "".join(reader.text)


def test_run_constants_and_time(spark):
    pages = extract.of_run(page(spark, HITS["bds"]), url="u", site="bds", vendor="v", type="sell", crawl_url="/a.htm")
    hit = extract.extract_hits(pages).first()
    assert hit.vendor == "v" and hit.listing_type == "a" and hit.created_date is not None


def page(spark, html, **columns):
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    return df.select("page_id", "html", *[F.lit(v).alias(k) for k, v in columns.items()])


def chosen(spark, html, expr):
    return with_nodes(page(spark, html)).select(F.expr(expr)).first()[0]


def test_node_table(spark):
    nodes = html_nodes(with_nodes(page(spark, "<p class='a b' id=i>x<b>y</b></p>"))).orderBy("seq").collect()
    assert [(n.seq, n.end_seq, n.parent_seq, n.tag, n.text) for n in nodes] == [
        (0, 3, None, "p", None), (1, 1, 0, "#text", "x"), (2, 3, 0, "b", None), (3, 3, 2, "#text", "y"),
    ]
    assert nodes[0].classes == ["a", "b"] and nodes[0].id == "i"


def test_paths(spark):
    html = "<div class='a'><p class='b c'>1<i>2</i></p><div class='b'><p>3</p></div></div><p class='b'>4</p>"
    El = sel.El
    own = lambda *steps: chosen(spark, html, sel.own_texts(sel.elements_at(*steps)))
    assert own(El("p")) == ["1", "3", "4"]
    assert own(El(cls="a"), El(cls="b")) == ["1"]
    assert own(El(cls="a"), El("div"), El("p")) == ["3"]
    assert own(El(cls="a"), El("p", child=True)) == ["1"]
    assert own(El(cls="c b")) == ["1"] and own(El(class_attr="b")) == ["4"] and own(El(class_prefix="b c")) == ["1"]
    assert own(El("section"), El("p")) == []
    assert chosen(spark, html, sel.all_texts(sel.elements_at(El("div")))) == ["1", "2", "3"]


@pytest.mark.parametrize("html, want", [
    ("<div>Tel</div><div>5 <b>6</b></div>", ["5 ", "6"]),
    ("<div>Tel<div>inside</div></div><p>x</p><div>after</div>", ["after"]),
    ("<div><p>x</p>Tel</div><div>v</div>", ["v"]),
    ("<div><b>Tel</b></div><div>v</div>", []),
    ("<div>Tel</div><div>Tel</div><div>v</div>", ["Tel", "v"]),
    ("<div>Tel</div><div>1<div>Tel</div><div>2</div></div>", ["1", "Tel", "2"]),
    ("<div>Tel</div>", []), ("<div>none</div><div>v</div>", []),
    ("<section><div>Tel</div></section><div></div><div>late</div>", []),
])
def test_after_label(spark, html, want):
    assert chosen(spark, html, sel.texts_after_label("div", "Tel", "div")) == want


def test_labelled_items(spark):
    html = "<ul class='l'><li><b>Tel</b><i>5</i>.<li>Fax</ul><ul class='l x'><li>Tel<i>6</i></ul>"
    assert chosen(spark, html, sel.texts_of_labelled_items("l", "Tel")) == ["Tel", "5", "."]


def test_picks(spark):
    v = "array(' a', 'b ', 'c')"
    rows = spark.range(1)
    value = lambda e: rows.select(F.expr(e)).first()[0]
    assert [value(sel.pick(v, i)) for i in (0, 2, 3, -1, -3, -4)] == ["a", "c", None, "c", "a", None]
    assert value(sel.pick(v, 1, more_than=3)) is None and value(sel.pick(v, 1, exactly=3)) == "b"
    assert value(sel.join_texts(v, ",")) == "a,b,c" and value(sel.join_texts("cast(array() as array<string>)", ",")) == ""
    assert value(sel.list_or_null("array()")) is None and value(sel.first_or_null(v)) == "a"
    assert sel.quoted("it's \\") == "'it\\'s \\\\'" and value(sel.quoted("it's \\")) == "it's \\"


def test_labels_are_composed_text():
    for rules in SITES.values():
        for source, _ in rules.page_fields.values():
            if isinstance(source, (AfterLabel, LabelledItem)):
                assert source.label == unicodedata.normalize("NFC", source.label)


def listing(spark, site, html, url="https://x/nha-pr7.htm"):
    df = page(spark, html, url=url, site=site, vendor="http://v", type="sell", crawled_date=AT)
    good, bad = extract.quarantine(extract.extract_listings(df))
    assert [f.name for f in good.schema][1:] == LISTING.names
    rows, faults = good.collect(), bad.collect()
    assert len(rows) + len(faults) == 1
    return (rows[0].asDict(), None) if rows else (None, faults[0]._errors)


BDS_PAGE = """<div class="prd-more-info"><div>ma</div><div> 01-01 </div><div>x</div><div>02-01</div></div>
<div class="pm-title"><h1> Nha </h1></div><div class="pm-content"><div class="pm-desc">a<br> b</div></div>
<div class="kqchitiet"><span class="gia-title">Gia<strong>2 tỷ</strong></span>{size}</div>
<div>Địa chỉ</div><div> 1 Pho </div>{second}
<div>Điện thoại</div><div></div><div>Mobile</div><div>09</div><div>Quy mô</div><div>to</div>
<div>Chủ đầu tư</div><div>ai</div><div>Hướng ban công</div><div>Nam</div><div>Đường vào</div><div>3,5 m</div>
<div>Mặt tiền</div><div>4m</div><div>Số toilet</div><div>2</div>
<div id="LeftMainContent__productDetail_ltVideo"><iframe src="/v"></iframe></div><div class="list-img"></div>"""
SIZE = '<span class="gia-title"><strong>50 m²</strong></span>'


def test_bds_page(spark):
    row, _ = listing(spark, "bds", BDS_PAGE.format(size=SIZE, second=""))
    want = dict(
        key="http://v:7:sell", property_id="7", link="https://x/nha-pr7.htm", posted_date="01-01", expire_date="02-01",
        title="Nha", description="a b", price_raw="2 tỷ", price=2.0, price_unit=" tỷ", property_size=50.0,
        price_per_sqm=0.04, address="1 Pho", contact_address=None, contact_phone=None, contact_mobile="09",
        project_scale="to", project_owner="ai", balcony_orientation="Nam", distance_to_road=3.5, frontage=4.0,
        num_bathrooms=2.0, num_floors=None, images=None, videos=["/v"], furniture=None, contact_email=None, area=None,
    )
    assert {k: row[k] for k in want} == want


def test_bds_addresses_and_faults(spark):
    second = "<div>Địa chỉ</div><div>2 Pho</div>"
    row, _ = listing(spark, "bds", BDS_PAGE.format(size=SIZE, second=second))
    assert (row["address"], row["contact_address"]) == ("1 Pho", "2 Pho")
    row, _ = listing(spark, "bds", BDS_PAGE.format(size=SIZE, second=second * 2), url="https://x/nha.htm")
    assert (row["address"], row["contact_address"], row["key"]) == ("1 Pho", None, "http://v:FAILURE:sell")
    assert listing(spark, "bds", BDS_PAGE.format(size="", second=""))[1] == ["missing property_size"]
    short = '<div class="prd-more-info"><div>a</div><div>b</div></div>'
    assert set(listing(spark, "bds", short)[1]) == {f"missing {f}" for f in ("posted_date", "title", "price", "property_size")}


def test_mbnd_page(spark):
    box = "MainContent_ctlDetailBox_"
    html = f"""<div class="navi-title">T</div><span id="{box}lblPrice">3,2 tỷ</span>
    <table><tr><th>Diện tích</th><td><span>80 m²</span></td></tr><tr><th>Tiện ích<td><span>a<b>b</b></span>
    <tr><th>Tình trạng pháp lý<td><span>so do</span><tr><th>Phòng tắm<td><span>3</span><tr><th>Đường trước nhà<td><span>5m</span>
    <tr><th>Hướng<td><span>Bac</span></table><span id="{box}lblStreet"></span><span id="{box}lblCity"><a>HN</a></span>
    <span id="{box}lblAddressContact"> so 1 </span><div class="name-contact"><a href="/c">Ten</a></div>
    <div class="flexslider"><img src="/1"><img alt="none"></div>"""
    row, _ = listing(spark, "mbnd", html)
    want = dict(
        title="T", price=3.2, property_size=80.0, furniture=" a,b", ownership_certificate="so do", num_bathrooms=3.0,
        road_width="5m", house_orientation="Bac", address=None, city="HN", contact_address="so 1", contact_name="Ten",
        contact_link="http://v/doanh-nghiep/detail/c", images=["/1"], videos=None, listing_type="sell", description=None,
        price_per_sqm=0.04, project_name=None,
    )
    assert {k: row[k] for k in want} == want
    empty, _ = listing(spark, "mbnd", "<p>nothing</p>")
    assert empty["furniture"] == " " and empty["contact_link"] is None and empty["price_per_sqm"] is None


def test_tbds_page(spark):
    html = """<div class="folder-title"><h1>T</h1><i class="pull-left">a</i><i class="pull-left">b</i><i class="pull-left"> Ha Noi </i></div>
    <span>Giá</span><span>0 tỷ</span><span>Diện tích</span><span>90 m²</span>
    <ul class="list-info clearfix"><li><span>Số toilet</span><b> 2 </b><i></i> x</li><li>Đường vào<b>4</b></li></ul>
    <div class="info-contact"><b class="fweight-bold dblue-clr">N</b><span id="toEmail">e@x</span><span id="toAddress"> A </span></div>
    <div class="slide_show"><img src="/1"></div>"""
    row, _ = listing(spark, "tbds", html)
    want = dict(
        title="T", address="Ha Noi", price=0.0, property_size=90.0, price_per_sqm=None, num_bathrooms=2.0,
        distance_to_road=None, contact_name="N", contact_email="e@x", contact_address="A", contact_phone=None,
        images=["/1"], posted_date=None,
    )
    assert {k: row[k] for k in want} == want


HITS = {
    "bds": """<div class="vip1"><p class="p-title"><a href="/a-pr1">x</a></p><b class="product-price">1 tỷ</b>
      <b class="product-area">10 m²</b><b class="product-city-dist"> p </b><b class="product-city-dist">q</b></div>
      <div class="vip2"><b class="product-price">no link</b></div><div class="other vip3"></div>""",
    "mbnd": """<div class="resultItem"><div class="title row"><a href=" /a-pr1 ">x</a></div><b class="listing-price">1 tỷ</b>
      <div class="col-xs-12 lline">3 PN</div><div class="col-xs-12 lline">10 m²</div>
      <div class="row lline"><b class="col-xs-6">p</b><b class="col-xs-6">q</b></div></div><div class="resultItem"></div>""",
    "tbds": """<ul><li>menu</ul><div class="col-gr-75per"><ul class="group-prd"><li><div class="content"><h3 class="title">
      <a href="/a-pr1">x</a></h3><p class="info"><span>1 tỷ</span><span>10 m²</span></p><b class="fsize-13">d</b>
      <b class="fsize-13">p, q</b></div><li>empty</ul></div>""",
}


@pytest.mark.parametrize("site", SITES)
@pytest.mark.parametrize("type_", ["sell", "lease"])
def test_search_pages(spark, site, type_):
    columns = dict(url="u", site=site, vendor="http://v", type=type_, crawl_url="/ban/dat.htm", crawled_date=AT)
    pages = page(spark, HITS[site], **columns).union(page(spark, "<p>no hits</p>", **columns).withColumn("page_id", F.lit(2)))
    counts = extract.page_blocks(with_nodes(pages)).select("page_id", "n_hits")
    assert {tuple(r) for r in counts.collect()} == {(1, 2), (2, 0)}
    good, bad = extract.quarantine(extract.extract_hits(pages))
    (hit,), (lost,) = good.collect(), bad.collect()
    assert lost.hit_no == 1 and lost._errors == ["missing link"]
    assert (hit.link, hit.property_id, hit.listing_type, hit.property_area) == ("http://v/a-pr1", "1", "dat", "p, q")
    assert (hit.property_price_raw, hit.property_size_raw) == ("1 tỷ", "10 m²")
    parsed = site != "bds" or type_ == "sell"
    assert (hit.property_price, hit.property_size) == ((1.0, 10.0) if parsed else (None, None))
    assert (hit.property_price_unit, hit.property_size_unit) == ((" tỷ", " m²") if parsed else (None, None))
    assert hit.created_date == AT and hit.last_crawled_date is None
