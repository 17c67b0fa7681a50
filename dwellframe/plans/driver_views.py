"""Listing-crawl tables seen in the driver's generic tables.

The SQL runs unchanged in Spark and DuckDB; ``{table}`` stands for a driver table. Pages in the
sites' markup are rendered from rows, as the driver's own pages belong to no such site.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# search hits with every link form and both decimal marks
HITS = """
select l_orderkey, l_linenumber,
  concat('http://v', cast(l_suppkey % 3 as string), '.example.com') as vendor,
  case l_returnflag when 'A' then 'sell' when 'R' then 'rent' else 'lease' end as type,
  concat('/ban-nha', case l_linenumber % 4 when 0 then '-ad' when 1 then '-pr' when 2 then '-' else '/x' end,
         cast(l_partkey as string), '.htm') as link,
  case when l_linenumber = 7 then 'Thoa thuan'
       else concat(replace(cast(cast(l_extendedprice as decimal(12,2)) as string), '.',
                           case when l_linenumber % 2 = 0 then ',' else '.' end), ' ty') end as price_raw,
  concat(cast(cast(l_quantity as int) as string), case when l_linenumber = 3 then ' m2' else ' m²' end) as size_raw,
  l_shipdate as created_date
from {lineitem}
"""

# rental documents, many with missing fields, many per property
RENTAL = """
select l_partkey as property_id, l_orderkey*10 + l_linenumber as seq,
  case when l_linenumber < 5 then cast(l_quantity as int) end as property_area,
  case when l_discount > 0.05 then 'm2' end as property_size_unit,
  case when l_tax > 0.04 then 'ty' end as property_price_unit,
  l_extendedprice as ep, l_suppkey as sk
from {lineitem}
"""

# work items
INDEX = """
select concat('http://v', cast(o_custkey % 3 as string), '.example.com') as vendor,
  case o_orderstatus when 'F' then 'sell' when 'O' then 'rent' else 'lease' end as type,
  cast(o_orderkey as string) as property_id,
  concat('/x-pr', cast(o_orderkey as string)) as link,
  o_orderdate as created_date,
  case when o_orderpriority <> '5-LOW' then o_orderdate end as last_crawled_date,
  o_totalprice as property_price
from {orders}
"""

# visits of search pages: seed, page number, hits found
VISITS = """
select conv_id as seed, turn as idx, case when text like '%the%' then 1 else 0 end as n_results
from {conversations}
"""

CHECKS = """
select cast(user_id as string) as ip, ts as date, case when event_type = 'error' then 500 else 200 end as status,
  event_id
from {events}
"""

JOBS = """
select concat('http://h', cast(l_suppkey as string), '.example.com:6800') as host,
  case when l_linestatus = 'O' then 'running' when l_linenumber < 6 then 'finished' else 'pending' end as state,
  l_shipdate as start_time, cast(floor(l_extendedprice) as bigint) as secs
from {lineitem}
"""

HOSTS = """
select s_name as host, s_nationkey % 6 as running
from {supplier}
"""

TASK_PAIRS = """
select distinct concat('http://v', cast(s_suppkey % 4 as string), '.example.com') as vendor from {supplier}
"""

# seed settings, one per supplier
SEED_ROWS = """
select concat('search_', cast(s_nationkey % 3 as string)) as spider,
  concat('http://s', cast(s_suppkey as string), '.example.com') as vendor,
  cast(s_nationkey % 6 as int) as max_depth, cast(s_suppkey % 5 as int) as start_index, s_suppkey, s_name
from {supplier}
"""

PARTS = "select * from {part}"
ORDERS = "select * from {orders}"


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Spread a scan over the cores when it yields fewer partitions than there are cores.

    For the driver's tables only, which are files of a row group or two that would keep one core busy; the library's own
    readers never move a page. A scan with more partitions than cores is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(HITS, lineitem=spread_small_scan(table(spark, sf_dir, "lineitem")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, SEED_ROWS)
    urls = F.create_map(
        F.lit("sell"), F.array(F.concat(F.lit("/ban-"), "s_suppkey", F.lit(".htm")), F.lit("/ban")),
        F.lit("rent"), F.array(F.concat(F.lit("/thue-"), "s_suppkey", F.lit(".htm"))),
    )
    return rows.select("spider", "vendor", "max_depth", "start_index", urls.alias("crawl_urls"))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = F.array(*[F.lit(t) for t in ("rent", "sell", "auction", "lease")])
    return view(spark, sf_dir, TASK_PAIRS).select(F.lit("spider").alias("spider"), "vendor", types.alias("types"))


# --- pages rendered from rows -------------------------------------------------------------------


def _html(*parts: Column | str) -> Column:
    """Strings are markup; columns are values."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _if(cond: Column, text: Column) -> Column:
    return F.when(cond, text).otherwise("")


def _site(number: Column) -> Column:
    return F.when(number % 3 == 0, "bds").when(number % 3 == 1, "mbnd").otherwise("tbds")


def _pages(rows: DataFrame, page_id: str, html: dict[str, Column], **columns: Column) -> DataFrame:
    site = _site(F.col(page_id))
    body = reduce(lambda a, kv: a.when(site == kv[0], kv[1]), html.items(), F.when(F.lit(False), F.lit("")))
    return spread_small_scan(rows).select(
        F.col(page_id).alias("page_id"), site.alias("site"),
        F.concat(F.lit("http://"), site, F.lit(".example.com")).alias("vendor"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("crawled_date"),
        *[c.alias(n) for n, c in columns.items()],
        F.concat(F.lit("<!DOCTYPE html><html><head><title>t</title></head><body>"), body, F.lit("</body></html>")).alias("html"),
    )


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page per part: some without a size, some with a second address, entities and open tags."""
    return rendered_detail_pages(view(spark, sf_dir, PARTS))


def rendered_detail_pages(rows: DataFrame) -> DataFrame:
    """Detail pages of rows with a part's columns, in the markup of the site that the key names."""
    key, size = F.col("p_partkey"), F.col("p_size")
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    with_size = size % 10 != 0
    two = size % 2 == 0

    bds = _html(
        '<div class="pm-title"><h1>\n ', name, ' </h1></div><div class="pm-content"><div class="pm-desc"> ', kind,
        '<br>', brand, ' </div></div><div class="kqchitiet"><span class="gia-title">Giá: <strong>', price,
        ' ty</strong></span>',
        _if(with_size, _html('<span class="gia-title">Diện tích: <strong>', size, ' m²</strong></span>')),
        '</div><span class="diadiem-title mar-right-15"><b><a href=" /area-', size, '?a=1&amp;b=2">x</a></b></span>',
        '<div class="prd-more-info"><div>code</div><div> 0', size, '-01</div><div>~</div><div>0', size, '-02 </div></div>',
        '<div class="row"><div class="left">Địa chỉ</div><div class="right">', brand, ' street</div></div>',
        _if(two, _html('<div class="left">Địa chỉ</div><div class="right"><span>', kind, ' office</span></div>')),
        '<div>Số tầng<div>inside the label</div></div><div><b>', size, '</b> tầng</div>',
        '<div>Số phòng ngủ</div><p>between</p><div>', key, ' phòng</div><div>Nội thất\r\n</div><div>full</div>',
        '<div>Hướng nhà</div><div></div>',
        '<div class="list-img"><img src="/a', key, '.jpg"><p><img src="/b.jpg"></div>',
        '<div>Loại tin rao</div><div>Vip</div><div>Tên liên lạc</div><div>Mr ', size, '</div>',
        '<div>Tên dự án</div><div>', brand, '</div>',
        '<a id="LeftMainContent__productDetail_linkProject" href="/project">p</a>',
    )
    box = "MainContent_ctlDetailBox_"
    mbnd = _html(
        '<div class="navi-title"> ', name, '</div><div class="box-description">', kind, '<br> ', brand, '</div>',
        f'<span id="{box}lblDateCreated">0', size, f'-01 </span><span id="{box}lblPrice">', price, ' ty</span><table>',
        _if(with_size, _html('<tr><th>Diện tích<td><span>', size, ' m²</span>')),
        '<tr><th>Số tầng<td><span>', size, ' tầng</span><tr><th>Phòng ngủ<td><span>', key, '</span>',
        '<tr><th>Tiện ích<td><span> bed<i>table</i> </span><tr><th>Hướng<td><span>', brand, '</span></table>',
        f'<span id="{box}lblWard"><a href="#">ward ', size, f'</a></span><span id="{box}lblStreet">',
        _if(two, _html(brand, ' street')), '</span>',
        '<div class="flexslider"><img src="/a', key, '.jpg"><img src="/b.jpg"></div>',
        '<div class="name-contact"><a href="/', size, '">Mr ', size, '</a></div>',
        f'<span id="{box}lblAddressContact"> </span>',
        f'<span id="{box}lblProject"><a href="/project">', brand, '</a></span>',
    )
    tbds = _html(
        '<div class="folder-title"><h1>', name, ' </h1><span class="pull-left">a</span><span class="pull-left">b</span>',
        _if(two, _html('<span class="pull-left"> ', brand, ' street</span>')), '</div>',
        '<div id="infoDetail">', kind, '<br>', brand, '</div><p><span>Giá</span><span>', price, ' ty</span></p>',
        _if(with_size, _html('<span>Diện tích</span> <b><span>', size, ' m²</span></b>')),
        '<ul class="list-info clearfix"><li><span>Số phòng</span><b>', key, '</b><i>.</i><li>Số tầng<b>', size,
        '</b></li><li><span>Hướng nhà</span><b> ', brand, ' </b>!</ul>',
        '<div class="list-info clearfix"><div class="value line">0', size, '-01</div><div class="value line"> x </div>',
        '<div class="value line">y</div></div><div class="slide_show"><a><img src="/a', key, '.jpg"></a><img src="/b.jpg"></div>',
        '<div class="info-contact"><p class="fweight-bold dblue-clr">Mr ', size, '</p><span id="toPhone">', key,
        '</span></div>',
    )
    return _pages(
        rows, "p_partkey", {"bds": bds, "mbnd": mbnd, "tbds": tbds},
        type=F.when(size % 3 == 0, "sell").otherwise("rent"),
        url=F.concat(F.lit("https://x.example.com/nha-pr"), key.cast("string"), F.when(size % 5 == 0, ".html").otherwise(".htm")),
    )


# seeds whose search pages have hits up to some page, then none
PAGED_SEEDS = """
select s_suppkey as seed, case s_suppkey % 3 when 0 then 'bds' when 1 then 'mbnd' else 'tbds' end as site,
  concat('http://s', cast(s_suppkey as string), '.example.com') as vendor, 'sell' as type, '/ban/nha-dat.htm' as crawl_url,
  cast(case when s_nationkey % 5 > 0 then s_nationkey % 5 + 1 end as int) as max_depth,
  cast(case when s_suppkey % 4 = 0 then 2 end as int) as start_index,
  cast(s_suppkey % 6 as int) as filled, s_acctbal
from {supplier}
"""


def paged_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, PAGED_SEEDS)


def fetch_paged(due: DataFrame) -> DataFrame:
    """The due pages of ``paged_seeds``, rendered: page idx has three hits up to ``filled``, none beyond; page 4 of some never landed."""
    landed = due.filter("not (idx = 4 and seed % 7 = 0)")
    rows = landed.select(
        "url", (F.col("seed") * 300 + F.col("idx") * 3 + F.col("seed") % 3).alias("o_orderkey"), F.lit(1).alias("o_custkey"),
        F.col("s_acctbal").alias("o_totalprice"), F.lit("F").alias("o_orderstatus"),
        F.when(F.col("idx") <= F.col("filled"), "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"),
    )
    return rendered_search_pages(rows, F.col("url"))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search page per order with up to three hits; some pages are empty, some hits have no link."""
    url = F.concat(F.lit("http://x.example.com/ban/nha-dat.htm/p"), F.col("o_orderkey").cast("string"))
    return rendered_search_pages(view(spark, sf_dir, ORDERS), url)


def rendered_search_pages(rows: DataFrame, url: Column) -> DataFrame:
    """Search pages of rows with an order's columns, in the markup of the site that the key names."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    filled = F.col("o_orderpriority") != "5-LOW"
    lost = F.col("o_custkey") % 7 == 0

    def three(hit) -> Column:
        return _if(filled, _html(*[hit(i) for i in range(3)]))

    def link(i: int) -> Column:
        href = _html('<a href=" /ban-nha-pr', key, f'{i}.htm ">go</a>')
        return _if(~lost, href) if i == 1 else href

    def bds(i: int) -> Column:
        return _html(
            f'<div class="vip{i} hit"><div class="p-title">', link(i), '</div><span class="product-price"> ', price,
            f' ty</span><span class="product-area">{i}0 m²</span><span class="product-city-dist"> a </span>',
            '<span class="product-city-dist">', F.col("o_custkey"), '</span><div class="floatright">today</div></div>',
        )

    def mbnd(i: int) -> Column:
        return _html(
            '<div class="x resultItem"><div class="row title">', link(i), '</div><p class="listing-price">', price,
            f' ty<div class="col-xs-12 lline">3 PN</div><div class="lline col-xs-12"> {i}0 m² </div>',
            '<div class="row lline"><div class="col-xs-6">a</div><div class="col-xs-6"> ', F.col("o_custkey"), '</div></div>',
            '<div class="col-lg-4 lline hidden-xs">today</div></div>',
        )

    def tbds(i: int) -> Column:
        return _html(
            '<li><div class="content"><div class="title">', link(i), '</div><div class="info"><span> ', price,
            f' ty</span><span>{i}0 m²</span></div><p class="fsize-13">a<p class="fsize-13">', F.col("o_custkey"), '</div>',
        )

    return _pages(
        rows, "o_orderkey",
        {
            "bds": _html('<div class="nav">x</div>', three(bds)),
            "mbnd": three(mbnd),
            "tbds": _html('<ul><li>menu</ul><div class="col-gr-75per"><ul class="group-prd">', three(tbds), '</ul></div>'),
        },
        type=F.expr("case o_orderstatus when 'F' then 'sell' when 'O' then 'rent' else 'lease' end"),
        crawl_url=F.lit("/ban/nha-dat.htm"),
        url=url,
    )
