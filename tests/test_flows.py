"""The flows from pages and tables to their end results."""

import datetime as dt

from pyspark.sql import functions as F

from dwellframe.operators import extract, sinks
from dwellframe.plans import driver_views as dv
from dwellframe.plans import flows
from dwellframe.schemas import LISTING, PROPERTY_INDEX
from dwellframe.streaming import sinks as streams

SF = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 1, 1)


def test_indexing_twice_adds_nothing_and_counts_every_page(spark):
    pages = dv.search_pages(spark, SF)
    empty = spark.createDataFrame([], PROPERTY_INDEX)
    once = flows.index_search_pages(pages, empty)
    again = flows.index_search_pages(pages, once.index)
    assert once.index.count() == again.index.count() == once.index.select("vendor", "type", "property_id").distinct().count()
    assert once.visits.count() == pages.count()
    total = once.visits.agg(F.sum("n_results")).first()[0]
    assert once.index.count() + once.set_aside.count() == total
    assert {tuple(r._errors) for r in once.set_aside.collect()} == {("missing link",)}


def test_next_pages(spark):
    visits = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("b", 0, 2), ("c", 1, 0), ("d", 4, 1)], "seed string, idx int, n_results int")
    plan = spark.createDataFrame([(s, "http://v", f"/{s}", "query" if s == "b" else "path") for s in "abcd"],
                                 "seed string, vendor string, crawl_url string, style string")
    got = {r.seed: r.url for r in flows.pages_to_fetch(visits, plan, 4).collect()}
    assert got == {"a": "http://v/a/p3", "b": "http://v/b?p=1"}


def test_landing_again_later_replaces(spark):
    pages = dv.detail_pages(spark, SF)
    first = flows.land_listings(pages, spark.createDataFrame([], LISTING))
    later = flows.land_listings(pages.withColumn("crawled_date", F.lit(AT + dt.timedelta(days=1))), first.listings)
    earlier = flows.land_listings(pages.withColumn("crawled_date", F.lit(AT - dt.timedelta(days=1))), first.listings)
    assert first.listings.count() == later.listings.count() == earlier.listings.count()
    assert {r[0] for r in later.listings.select("crawled_date").distinct().collect()} == {AT + dt.timedelta(days=1)}
    assert {r[0] for r in earlier.listings.select("crawled_date").distinct().collect()} == {AT}
    assert first.set_aside.count() == pages.filter("site = 'bds' and html not like '%Diện tích%'").count() > 0
    assert "price" in flows.for_kv(first.listings).columns


def test_merge(spark):
    stamp = AT + dt.timedelta(days=9)
    index = spark.createDataFrame([("v", "rent", "1", stamp), ("w", "sell", "2", stamp)],
                                  "vendor string, type string, property_id string, last_crawled_date timestamp")
    rental = spark.createDataFrame(
        [("v", "rent", "1", 0, None, None, None), ("v", "rent", "1", 1, "a", None, None), ("v", "rent", "3", 2, None, None, None)],
        "vendor string, type string, property_id string, seq int, property_area string, property_size_unit string, property_price_unit string")
    merged = flows.merge_rental(index, rental, ["seq"], "v", F.lit(AT))
    got = sorted(tuple(r) for r in merged.select("vendor", "type", "property_id", F.coalesce("property_area", F.lit("-")), F.col("last_crawled_date").isNull()).collect())
    assert got == [("v", "lease", "1", "-", True), ("v", "lease", "1", "a", True), ("v", "lease", "3", "-", True), ("w", "sell", "2", "-", False)]


def test_page_streams_equal_batch(spark, tmp_path):
    path = lambda n: str(tmp_path / n)
    pages = dv.search_pages(spark, SF)
    for i in range(3):
        pages.filter(F.col("page_id") % 3 == i).coalesce(1).write.mode("append").parquet(path("pages"))
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(path("pages"))
    sink = streams.page_sink(extract.extract_hits, streams.index_sink(path("index"), "a"), path("aside"), "a")
    streams.start_sink(stream, sink, path("cp")).start().awaitTermination()
    batch = flows.index_search_pages(pages, spark.createDataFrame([], PROPERTY_INDEX))
    got = sinks.read_batches(spark, path("index"), PROPERTY_INDEX)
    assert got.exceptAll(batch.index.select(*PROPERTY_INDEX.names)).count() == 0 and got.count() == batch.index.count()
    assert spark.read.parquet(path("aside")).count() == batch.set_aside.count()


def test_detail_stream_without_contacts(spark, tmp_path):
    path = lambda n: str(tmp_path / n)
    pages = dv.detail_pages(spark, SF)
    pages.write.parquet(path("pages"))
    stream = spark.readStream.schema(pages.schema).parquet(path("pages"))
    sink = streams.page_sink(extract.extract_listings, streams.listing_sink(path("out"), "a"), path("aside"), "a", drop_contacts=True)
    streams.start_sink(stream, sink, path("cp")).start().awaitTermination()
    got = streams.read_latest(spark, path("out"))
    want = flows.land_listings(pages, spark.createDataFrame([], LISTING)).listings
    assert got.count() == want.count() and got.filter("contact_name is not null").count() == 0
    assert got.select("key", "link").exceptAll(want.select("key", "link")).count() == 0
