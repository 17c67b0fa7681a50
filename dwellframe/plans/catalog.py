"""Every query over the driver tables, by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellframe.functions import scalars as S
from dwellframe.functions import select as sel
from dwellframe.operators import dedupe, encode, extract, frontier, monitor, sinks, tables, work
from dwellframe.operators.ordering import first_per_key
from dwellframe.plans import driver_views as dv
from dwellframe.plans import flows, streams
from dwellframe.schemas import LISTING, PROPERTY_INDEX
from dwellframe.session import scratch_root
from dwellframe.sources.html_nodes import Names, html_nodes, with_nodes
from dwellframe.sources.readers import read_jobs, read_lines, read_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = "2024-06-01 00:00:00"
SPLIT_DATE = "1998-01-01 00:00:00"
CHECK_SPLIT = "2024-01-05 00:00:00"
CRAWLED_SINCE = "1997-07-30 00:00:00"
NOW = "2003-01-01 12:34:56"
STREAM_DATES = ("1994-06-01 00:00:00", "1997-01-01 00:00:00")
CHECK_DATES = ("2024-01-05 00:00:00", "2024-01-15 00:00:00")
BATCH = 25
MAX_PARALLEL = 5
SECURE_VENDOR = "http://v1.example.com"
HOST_SUFFIX = ".example.com:6800"


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits with their parsed columns, as the index takes them."""
    return dv.hits(spark, sf_dir).select(
        "vendor", "type", S.extract_property_id("link").alias("property_id"), "link", "created_date",
        F.col("price_raw").alias("property_price_raw"),
        S.extract_number("price_raw").alias("property_price"),
        S.extract_unit("price_raw").alias("property_price_unit"),
        F.col("size_raw").alias("property_size_raw"),
        S.extract_number("size_raw").alias("property_size"),
        S.extract_unit("size_raw").alias("property_size_unit"),
    )


def _split(df: DataFrame, column: str, at: str) -> tuple[DataFrame, DataFrame]:
    """What was there before a date, and what arrives from then on."""
    return df.filter(F.col(column) < _ntz(at)), df.filter(F.col(column) >= _ntz(at))


# --- scalars ------------------------------------------------------------------------------------


@query
def number_unit(spark, sf_dir):
    v = dv.hits(spark, sf_dir)
    return v.select(
        "l_orderkey", "l_linenumber", "price_raw", "size_raw",
        S.extract_number("price_raw").alias("price"), S.extract_unit("price_raw").alias("price_unit"),
        S.extract_number("size_raw").alias("size"), S.extract_unit("size_raw").alias("size_unit"),
    )


@query
def typed_parse(spark, sf_dir):
    v = dv.hits(spark, sf_dir)
    return v.select(
        "l_orderkey", "l_linenumber", "type", "price_raw",
        S.parse_for_types(S.extract_number("price_raw"), "type", ["sell", "rent"]).alias("price"),
        S.parse_for_types(S.extract_unit("price_raw"), "type", ["sell", "rent"]).alias("price_unit"),
    )


@query
def property_key(spark, sf_dir):
    v = dv.hits(spark, sf_dir).withColumn("property_id", S.extract_property_id("link"))
    return v.select("link", "property_id", S.listing_key("vendor", "property_id", "type").alias("key"))


@query
def price_per_sqm(spark, sf_dir):
    read = dv.hits(spark, sf_dir).withColumns(
        {"price": S.extract_number("price_raw"), "size": S.extract_number("size_raw")}
    )
    ratio = S.price_per_sqm("price", "size").alias("price_per_sqm")
    return read.select("l_orderkey", "l_linenumber", "price_raw", "size_raw", ratio)


@query
def abs_link(spark, sf_dir):
    v = dv.hits(spark, sf_dir)
    padded = F.concat(F.lit(" \n "), "link", F.lit(" 　"))
    return v.select("vendor", "link", S.absolute_link("vendor", padded).alias("abs_link"))


@query
def listing_type(spark, sf_dir):
    return dv.table(spark, sf_dir, "pages").select(
        "page_id", "url", S.extract_listing_type("url").alias("listing_type")
    )


@query
def strip(spark, sf_dir):
    docs = dv.table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("\x1c  \t"), "text", F.lit(" 　\x85\n"))
    stripped = S.py_strip(padded)
    return docs.select(
        "doc_id", F.md5(stripped).alias("digest"), F.octet_length(stripped).cast("bigint").alias("n_bytes"),
        S.blank_to_null(S.py_strip(F.when(F.col("lang") == "en", F.lit("   ")).otherwise(F.col("lang")))).alias("lang"),
    )


@query
def host_name(spark, sf_dir):
    v = dv.view(spark, sf_dir, dv.JOBS)
    return v.select("host", S.host_name("host", HOST_SUFFIX).alias("name")).distinct()


@query
def elapsed_parts(spark, sf_dir):
    ev = dv.table(spark, sf_dir, "events")
    parts = S.days_hours_minutes(_ntz("2024-01-31 00:00:00"), "ts")
    return ev.select("event_id", parts.alias("p")).select("event_id", "p.days", "p.hours", "p.minutes")


# --- sources, sinks, mutations ------------------------------------------------------------------


@query
def pages_scan(spark, sf_dir):
    p = read_pages(spark, f"{sf_dir}/pages.parquet")
    return p.select("page_id", "url", F.octet_length("html").cast("bigint").alias("n_bytes"))


@query
def index_first_write(spark, sf_dir):
    stored, arriving = _split(_hits(spark, sf_dir), "created_date", SPLIT_DATE)
    empty = stored.filter(F.lit(False))
    return tables.insert_hits(tables.insert_hits(empty, stored), arriving)


@query
def first_status(spark, sf_dir):
    checks = dv.view(spark, sf_dir, dv.CHECKS)
    stored, arriving = _split(checks, "date", CHECK_SPLIT)
    known = first_per_key(stored, ["ip"], [F.col("date"), F.col("event_id")])
    return tables.insert_checks(known, arriving)


@query
def listing_last_write(spark, sf_dir):
    h = _hits(spark, sf_dir).withColumn("key", S.listing_key("vendor", "property_id", "type"))
    rows = h.select("key", "link", "property_price_raw", F.col("created_date").alias("crawled_date"))
    stored, arriving = _split(rows, "crawled_date", SPLIT_DATE)
    latest = first_per_key(stored, ["key"], [F.col("crawled_date").desc(), F.col("link"), F.col("property_price_raw")])
    return tables.put_by_key(latest, arriving)


@query
def mark_crawled(spark, sf_dir):
    index = dv.view(spark, sf_dir, dv.INDEX)
    claimed = index.filter("last_crawled_date is null and property_price > 300000")
    marked = tables.mark_crawled(index, claimed, _ntz(RUN_TS))
    return marked.select("vendor", "type", "property_id", "last_crawled_date")


@query
def recode_type(spark, sf_dir):
    h = dv.hits(spark, sf_dir)
    return tables.recode(h, "type", "rent", "lease").select("l_orderkey", "l_linenumber", "link", "type")


@query
def recrawl_reset(spark, sf_dir):
    index = dv.view(spark, sf_dir, dv.INDEX)
    reset = tables.reset_crawled(index, SECURE_VENDOR, _ntz(CRAWLED_SINCE))
    return reset.select("vendor", "property_id", "last_crawled_date")


@query
def kv_encode(spark, sf_dir):
    ev = dv.table(spark, sf_dir, "events").select(
        "event_id", "ts", F.to_date("ts").alias("day"), "value",
        F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type"), "user_id",
    )
    return encode.encode_for_kv(ev)


@query
def require_fields(spark, sf_dir):
    complete, _ = tables.require_fields(_hits(spark, sf_dir), ["property_id", "property_price"])
    return complete.select("vendor", "type", "property_id", "created_date", "property_price")


@query
def merge_rental(spark, sf_dir):
    """Clean up the rentals, add them to the index, recode their type, reset one vendor."""
    rental = dv.view(spark, sf_dir, dv.RENTAL).select(
        F.col("property_id").cast("string").alias("property_id"), "seq", "property_area", "property_size_unit",
        "property_price_unit", "ep", "sk", F.lit("rent").alias("type"),
        F.concat(F.lit("http://v"), F.col("sk") % 3, F.lit(".example.com")).alias("vendor"),
    )
    index = dv.view(spark, sf_dir, dv.INDEX).select("vendor", "type", "property_id", "last_crawled_date")
    merged = flows.merge_rental(index, rental, ["seq", "ep", "sk"], SECURE_VENDOR, _ntz(CRAWLED_SINCE))
    return merged.select("vendor", "type", "property_id", "last_crawled_date", "property_area")


# --- streams ------------------------------------------------------------------------------------


def _third(column: str, *bounds: str):
    """Slice 0, 1 or 2 by two dates."""
    return sum((F.when(F.col(column) >= _ntz(b), 1).otherwise(0) for b in bounds), F.lit(0))


@query
def stream_index(spark, sf_dir):
    return streams.stream_index(spark, _hits(spark, sf_dir), _third("created_date", *STREAM_DATES))


@query
def stream_checks(spark, sf_dir):
    return streams.stream_checks(spark, dv.view(spark, sf_dir, dv.CHECKS), _third("date", *CHECK_DATES))


@query
def stream_listings(spark, sf_dir):
    """Times are months, so most rows tie with others of their key; slices go by the day of the month."""
    h = _hits(spark, sf_dir).withColumn("key", S.listing_key("vendor", "property_id", "type"))
    month = F.date_trunc("month", "created_date").cast("timestamp_ntz")
    rows = h.select("key", "link", "property_price_raw", month.alias("crawled_date"), F.day("created_date").alias("slice"))
    slice_of = F.when(F.col("slice") <= 10, 0).when(F.col("slice") <= 20, 1).otherwise(2)
    return streams.stream_listings(spark, rows, slice_of)


@query
def stream_routed(spark, sf_dir):
    """Hits as index and listing records, errors as raw records, other events as checks."""
    h = _hits(spark, sf_dir).withColumn("key", S.listing_key("vendor", "property_id", "type"))
    ev = dv.view(spark, sf_dir, dv.CHECKS)
    columns = {
        "vendor": "string", "type": "string", "property_id": "string", "created_date": "timestamp_ntz", "link": "string", "key": "string",
        "crawled_date": "timestamp_ntz", "ip": "string", "date": "timestamp_ntz", "status": "int",
    }

    def records(rows, kind, when, **made):
        fields = [(F.col(made[c]) if c in made else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
        return rows.select(kind.alias("kind"), when.alias("slice"), F.struct(*fields).alias("record"))

    by_date, by_check = _third("created_date", *STREAM_DATES), _third("date", *CHECK_DATES)
    index = records(h, F.lit("index"), by_date, vendor="vendor", type="type", property_id="property_id", created_date="created_date", link="link")
    listing = records(h, F.lit("listing"), by_date, key="key", crawled_date="created_date", link="link")
    told = F.when(F.col("status") == 500, "raw").otherwise("check")
    checks = records(ev, told, by_check, ip="ip", date="date", status="status")
    return streams.stream_routed(spark, index.unionByName(listing).unionByName(checks), F.col("slice"))


# --- duplicates ---------------------------------------------------------------------------------


@query
def dup_groups(spark, sf_dir):
    return dedupe.dup_groups(dv.view(spark, sf_dir, dv.RENTAL), ["property_id"])


@query
def dup_members(spark, sf_dir):
    v = dv.view(spark, sf_dir, dv.RENTAL).select("property_id", "seq", "ep", "sk")
    return dedupe.dup_members(v, ["property_id"], [F.col("seq"), F.col("ep"), F.col("sk")])


@query
def dedupe_survivor(spark, sf_dir):
    v = dv.view(spark, sf_dir, dv.RENTAL)
    return dedupe.dedupe_survivor(v, order=["seq", "ep", "sk"]).select("property_id", "seq", "property_area", "ep")


@query
def survivor_merge(spark, sf_dir):
    """Survivors of two deliveries, the second merged into the states kept of the first."""
    v, order = dv.view(spark, sf_dir, dv.RENTAL), ["seq", "ep", "sk"]
    known = dedupe.survivor_states(v.filter("seq % 3 > 0"), order=order)
    arriving = dedupe.survivor_states(v.filter("seq % 3 = 0"), order=order)
    merged = dedupe.survivors(dedupe.merge_survivors(known, arriving), v.columns)
    return merged.select("property_id", "seq", "property_area", "ep")


# --- frontier -----------------------------------------------------------------------------------


@query
def seed_rows(spark, sf_dir):
    return frontier.expand_seeds(dv.seeds(spark, sf_dir))


@query
def page_urls(spark, sf_dir):
    rows = frontier.expand_seeds(dv.seeds(spark, sf_dir))
    styled = rows.withColumn("style", F.when(F.col("spider") == "search_1", "query").otherwise("path"))
    return frontier.page_plan(styled).select("vendor", "type", "crawl_url", "idx", "url")


@query
def page_prefix(spark, sf_dir):
    return frontier.pages_until_empty(dv.view(spark, sf_dir, dv.VISITS), max_depth=20)


@query
def next_page(spark, sf_dir):
    return frontier.next_page(dv.view(spark, sf_dir, dv.VISITS), max_depth=5)


@query
def frontier_topk(spark, sf_dir):
    top = frontier.frontier_per_pair(dv.view(spark, sf_dir, dv.INDEX), k=100)
    return top.select("vendor", "type", "property_id", "link", "created_date", F.col("rn").cast("bigint").alias("rn"))


@query
def frontier_pair(spark, sf_dir):
    top = frontier.frontier(dv.view(spark, sf_dir, dv.INDEX), SECURE_VENDOR, "sell", k=100)
    return top.select("property_id", "link")


@query
def crawl_batches(spark, sf_dir):
    rows = frontier.batch_rows(dv.view(spark, sf_dir, dv.INDEX), BATCH)
    packed = frontier.crawl_batches(rows)
    ids = F.array_join("property_ids", ",").alias("ids")
    return packed.select("vendor", "type", "batch", "n", "links", ids)


@query
def assign_batches(spark, sf_dir):
    hosts = dv.view(spark, sf_dir, dv.HOSTS)
    rows = frontier.batch_rows(dv.view(spark, sf_dir, dv.INDEX), BATCH, frontier.fleet_capacity(hosts, MAX_PARALLEL))
    numbered = frontier.number_batches(frontier.batch_counts(rows), dv.tasks(spark, sf_dir))
    slots = frontier.free_slots(hosts, MAX_PARALLEL)
    return frontier.assign_batches(numbered, slots).select("host", "slot", "vendor", "type", "batch", "n")


@query
def exhausted_types(spark, sf_dir):
    return frontier.exhausted_types(dv.tasks(spark, sf_dir), dv.view(spark, sf_dir, dv.INDEX))


@query
def split_links(spark, sf_dir):
    v = dv.hits(spark, sf_dir)
    full = F.concat("vendor", "link")
    pair = F.concat(full, F.lit(","), full, F.lit("?from="), "vendor")
    batches = v.select("l_orderkey", "l_linenumber", "vendor", pair.alias("links"))
    return frontier.split_links(batches, [SECURE_VENDOR])


@query
def claim_cycle(spark, sf_dir):
    index = dv.view(spark, sf_dir, dv.INDEX)
    _, after = frontier.claim_cycle(
        index, dv.tasks(spark, sf_dir), dv.view(spark, sf_dir, dv.HOSTS), MAX_PARALLEL, _ntz(RUN_TS), BATCH
    )
    return after.select("vendor", "type", "property_id", "last_crawled_date")


@query
def claim_dispatch(spark, sf_dir):
    index = dv.view(spark, sf_dir, dv.INDEX)
    assigned, _ = frontier.claim_cycle(
        index, dv.tasks(spark, sf_dir), dv.view(spark, sf_dir, dv.HOSTS), MAX_PARALLEL, _ntz(RUN_TS), BATCH
    )
    return assigned.select("host", "slot", "vendor", "type", "batch", "n", "links", F.array_join("property_ids", ",").alias("ids"))


@query
def claim_repeat(spark, sf_dir):
    """A claim from the work table, asked for twice: the batches of the second answer."""
    root = f"{scratch_root(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    work.write_work(dv.view(spark, sf_dir, dv.INDEX), root, "year")
    for _ in range(2):
        batches = work.claim_work(
            spark, root, "morning", dv.tasks(spark, sf_dir), dv.view(spark, sf_dir, dv.HOSTS), MAX_PARALLEL, _ntz(RUN_TS), BATCH
        )
    return batches.select("host", "slot", "vendor", "type", "batch", "n", "links", F.array_join("property_ids", ",").alias("ids"))


@query
def snapshot_reset(spark, sf_dir):
    """One vendor's rows made due again in a stored index: its partitions alone are rewritten."""
    root = f"{scratch_root(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    sinks.write_snapshot(dv.view(spark, sf_dir, dv.INDEX), root, ["vendor", "type"])
    sinks.update_snapshot(
        spark, root, [{"vendor": SECURE_VENDOR}], lambda rows: tables.reset_crawled(rows, SECURE_VENDOR, _ntz(CRAWLED_SINCE))
    )
    return sinks.read_snapshot(spark, root).select("vendor", "property_id", "last_crawled_date")


# --- figures ------------------------------------------------------------------------------------


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = dv.view(spark, sf_dir, dv.JOBS)
    return v.withColumn("end_time", F.col("start_time") + F.make_dt_interval(secs=F.col("secs").cast("decimal(18,6)")))


@query
def job_stats(spark, sf_dir):
    return monitor.job_stats(_jobs(spark, sf_dir))


@query
def job_stats_compat(spark, sf_dir):
    return monitor.job_stats(_jobs(spark, sf_dir), compat=True)


@query
def fleet_summary(spark, sf_dir):
    jobs = dv.view(spark, sf_dir, dv.JOBS)
    hosts = jobs.groupBy("host").agg(
        (F.count_if(F.col("state") == "running") > 280).alias("alive"),
        F.count("*").alias("spawned"),
        F.min("start_time").alias("started_at"),
    )
    return monitor.fleet_summary(hosts, _ntz(NOW))


# --- pages --------------------------------------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str, names: Names | None = None) -> DataFrame:
    pages = dv.spread_small_scan(read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "html"))
    return with_nodes(pages, names)


@query
def node_counts(spark, sf_dir):
    nodes = html_nodes(_parsed(spark, sf_dir)).filter("tag <> '#text'")
    return nodes.groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query
def blocks(spark, sf_dir):
    """Hits per search page, empty pages included."""
    parsed = extract.search_nodes(dv.search_pages(spark, sf_dir).select("page_id", "site", "html"), part="blocks")
    return extract.page_blocks(parsed).select("page_id", "site", F.col("n_hits").cast("bigint").alias("n_hits"))


@query
def page_title(spark, sf_dir):
    title = sel.first_or_null(sel.own_texts(sel.elements_at(sel.El("h1"))))
    return _parsed(spark, sf_dir).select("page_id", F.expr(title).alias("title"))


@query
def page_links(spark, sf_dir):
    links = sel.list_or_null(sel.attr_values(sel.elements_at(sel.El("a")), "href"))
    return _parsed(spark, sf_dir).select("page_id", F.expr(links).alias("links")).select(
        "page_id", F.size("links").cast("bigint").alias("n_links"), F.array_join("links", " ").alias("links")
    )


@query
def label_value(spark, sf_dir):
    """Texts of the paragraph after a headline, any headline being the label; the parser marks it."""
    value = F.expr(sel.all_texts(sel.marked(0)))
    return _parsed(spark, sf_dir, Names([], [("h1", "", "p", 0)], 1)).select("page_id", F.array_join(value, "").alias("value"))


@query
def page_text(spark, sf_dir):
    """Ad and menu texts, each trimmed, joined."""
    ad = sel.join_texts(sel.own_texts(sel.elements_at(sel.El("div", cls="ad"))), " ")
    menu = sel.join_texts(sel.all_texts(sel.elements_at(sel.El("nav"))), ", ")
    return _parsed(spark, sf_dir).select("page_id", F.expr(ad).alias("ad"), F.expr(menu).alias("menu"))


@query
def pick_pos(spark, sf_dir):
    links = F.expr(sel.attr_values(sel.elements_at(sel.El("a")), "href"))
    rows = _parsed(spark, sf_dir).select("page_id", links.alias("links"))
    picks = {
        "first": sel.pick("links", 0), "second": sel.pick("links", 1), "third_last": sel.pick("links", -3),
        "last": sel.pick("links", -1), "second_of_five": sel.pick("links", 1, more_than=4),
        "second_of_exactly_five": sel.pick("links", 1, exactly=5),
    }
    return rows.select("page_id", *[F.expr(e).alias(n) for n, e in picks.items()])


@query
def li_value(spark, sf_dir):
    pages = with_nodes(dv.detail_pages(spark, sf_dir))
    labels = {"rooms": "Số phòng", "floors": "Số tầng", "facing": "Hướng nhà"}
    items = {n: sel.texts_of_labelled_items("list-info clearfix", label) for n, label in labels.items()}
    return pages.select(
        "page_id", *[F.expr(sel.pick(values, 1, more_than=2)).alias(n) for n, values in items.items()]
    )


@query
def extract_hits(spark, sf_dir):
    good, _ = extract.quarantine(extract.extract_hits(dv.search_pages(spark, sf_dir)))
    return good.drop("created_date", "last_indexed_date", "last_crawled_date")


@query
def extract_pages(spark, sf_dir):
    good, _ = extract.quarantine(extract.extract_listings(dv.detail_pages(spark, sf_dir)))
    flat = good.withColumn("images", F.array_join("images", " ")).withColumn("videos", F.array_join("videos", " "))
    return flat.drop("crawled_date")


@query
def quarantine(spark, sf_dir):
    """Records set aside, with reasons: hits without a link and pages lacking a required part."""
    _, hits = extract.quarantine(extract.extract_hits(dv.search_pages(spark, sf_dir)))
    _, pages = extract.quarantine(extract.extract_listings(dv.detail_pages(spark, sf_dir)))
    reasons = F.array_join("_errors", "; ").alias("reasons")
    return hits.select(F.lit("hit").alias("kind"), "page_id", reasons).unionByName(
        pages.select(F.lit("page").alias("kind"), "page_id", reasons)
    )


# --- whole flows --------------------------------------------------------------------------------


@query
def search_to_index(spark, sf_dir):
    """Search pages -> hits -> index, first write wins."""
    index = flows.index_search_pages(dv.search_pages(spark, sf_dir), spark.createDataFrame([], PROPERTY_INDEX)).index
    return index.select("vendor", "type", "property_id", "link", "property_price", "property_area")


@query
def pages_due(spark, sf_dir):
    """All search pages visited until none is due, with their hits."""
    visits = flows.page_through(dv.paged_seeds(spark, sf_dir), dv.fetch_paged).visits
    return visits.select("seed", F.col("idx").cast("bigint").alias("idx"), "url", "n_results")


@query
def search_visits(spark, sf_dir):
    """Hits per search page, counted from the extracted records."""
    return extract.hits_per_page(extract.extract_hits(dv.search_pages(spark, sf_dir), keep_empty=True))


@query
def pages_to_listings(spark, sf_dir):
    """Detail pages -> listings -> last write per key -> encoded rows."""
    landed = flows.land_listings(dv.detail_pages(spark, sf_dir), spark.createDataFrame([], LISTING))
    return flows.for_kv(landed.listings).select("key", "link", "crawled_date", "title", "price", "address")


# --- second deliveries into filled tables ---------------------------------------------------------


def _dearer(rows: DataFrame, price: str) -> DataFrame:
    return rows.withColumn(price, F.col(price).cast("decimal(12,2)") + 1)


@query
def index_refill(spark, sf_dir):
    """Search pages into an index that has half of their hits already: stored hits keep their prices."""
    orders = dv.view(spark, sf_dir, dv.ORDERS)
    url = F.concat(F.lit("http://x.example.com/ban/nha-dat.htm/p"), F.col("o_orderkey").cast("string"))
    first = dv.rendered_search_pages(orders.filter("o_orderkey % 2 = 0"), url)
    root = f"{scratch_root(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    empty = spark.createDataFrame([], PROPERTY_INDEX)
    sinks.write_snapshot(flows.index_search_pages(first, empty).index, root, ["vendor", "type"])
    again = dv.rendered_search_pages(_dearer(orders, "o_totalprice"), url)
    index = flows.index_search_pages(again, sinks.read_snapshot(spark, root)).index
    return index.select("vendor", "type", "property_id", "link", "property_price")


@query
def listings_refill(spark, sf_dir):
    """Detail pages into filled listings: later crawls replace what is stored, earlier ones do not."""
    parts = dv.view(spark, sf_dir, dv.PARTS)
    stored = flows.land_listings(dv.rendered_detail_pages(parts), spark.createDataFrame([], LISTING)).listings
    root = f"{scratch_root(spark).rstrip('/')}/listings-{uuid.uuid4().hex}"
    sinks.write_snapshot(stored, root)
    when = F.when(F.col("page_id") % 2 == 0, "2024-02-01 00:00:00").otherwise("2023-12-01 00:00:00").cast("timestamp")
    again = dv.rendered_detail_pages(_dearer(parts, "p_retailprice")).withColumn("crawled_date", when)
    landed = flows.land_listings(again, sinks.read_snapshot(spark, root))
    return landed.listings.select("key", "link", "price", F.col("crawled_date").cast("timestamp_ntz").alias("crawled_date"))


@query
def work_insert(spark, sf_dir):
    """Hits into the work table: the keys it lacks, in the partitions that get rows."""
    stored, arriving = _split(_hits(spark, sf_dir), "created_date", SPLIT_DATE)
    columns = stored.columns
    known = tables.insert_hits(stored.filter(F.lit(False)), stored).withColumn("last_crawled_date", F.lit(None).cast("timestamp_ntz"))
    root = f"{scratch_root(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    work.write_work(known, root, "year")
    work.insert_work(spark, root, arriving)
    return work.read_work(spark, root).select(*columns)


# --- readers, appends, deletions -----------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query
def lines_read(spark, sf_dir):
    """Texts landed as text files, read back as trimmed lines."""
    path = _scratch(spark, "lines")
    dv.table(spark, sf_dir, "documents").select(F.concat(F.lit("  "), "text", F.lit(" \u3000\n\n")).alias("value")).write.text(path)
    return read_lines(spark, path).groupBy(F.md5("value").alias("digest")).agg(F.count("*").alias("n"))


@query
def jobs_read(spark, sf_dir):
    """Job records landed as JSON lines, and their figures."""
    path = _scratch(spark, "jobs")
    _jobs(spark, sf_dir).select("host", "state", "start_time", "end_time").write.json(path)
    return monitor.job_stats(read_jobs(spark, path))


@query
def append_twice(spark, sf_dir):
    """Two deliveries appended to one table, duplicates and all."""
    path = _scratch(spark, "appended")
    rows = dv.hits(spark, sf_dir).select("l_orderkey", "l_linenumber", "vendor", "type", "link")
    for part in (rows, rows.filter("type = 'rent'")):
        sinks.append(part, path, ["type"])
    return spark.read.parquet(path).select(*rows.columns)


@query
def url_stem(spark, sf_dir):
    return dv.table(spark, sf_dir, "pages").select("page_id", S.rchop("url", ".html").alias("stem"))


@query
def rental_deleted(spark, sf_dir):
    """The rental documents that the clean-up deletes."""
    v = dv.view(spark, sf_dir, dv.RENTAL)
    kept = dedupe.dedupe_survivor(v, order=["seq", "ep", "sk"])
    return dedupe.delete_unless_survivor(v, kept, ["property_id", "seq", "ep", "sk"]).select("property_id", "seq", "ep", "sk")


@query
def wanted_pairs(spark, sf_dir):
    """Work items of the vendors and types that some task asks for."""
    index = dv.view(spark, sf_dir, dv.INDEX)
    wanted = frontier.task_types(dv.tasks(spark, sf_dir))
    return tables.semi_by_keys(index, wanted, ["vendor", "type"]).select("vendor", "type", "property_id")
