"""Physical plans that matter at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from dwellframe.operators import dedupe, extract, frontier, ordering, sinks, tables
from dwellframe.plans.catalog import QUERIES
from dwellframe.plans.driver_views import detail_pages, search_pages
from dwellframe.session import stage

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index"))
    rows = [("v", t, str(i), f"/{i}", dt.datetime(2024, 1, 1), None, i) for i in range(50) for t in ("sell", "rent")]
    df = spark.createDataFrame(
        rows, "vendor string, type string, property_id string, link string, created_date timestamp_ntz, "
        "last_crawled_date timestamp_ntz, extra int")
    sinks.write_snapshot(df, root, ["vendor", "type"])
    return sinks.read_snapshot(spark, root)


def test_frontier_scan_is_pruned_and_pushed(spark, index):
    text = plan(frontier.frontier(index, "v", "sell", 5).select("link"))
    assert "PushedFilters: [IsNull(last_crawled_date)]" in text
    assert re.search(r"PartitionFilters: \[[^\]]*vendor[^\]]*type", text)
    assert "TakeOrderedAndProject" in text and "extra" not in text


def test_top_k_is_limited_before_each_shuffle(spark, index):
    text = plan(frontier.frontier_per_pair(index, 5))
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 2
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


def test_survivor_needs_one_shuffle_of_partial_rows(spark):
    rows = spark.createDataFrame([(1, 2, None, None, None)], "property_id int, seq int, property_area string, property_size_unit string, property_price_unit string")
    text = plan(dedupe.dedupe_survivor(rows))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_min_by" in text and "Window" not in text


def test_insert_cuts_the_source_before_shuffling_it(spark, index, no_broadcast):
    text = plan(tables.insert_hits(index, index))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", text)
    assert "NestedLoop" not in text


def test_insert_shuffles_each_side_once(spark, index, no_broadcast):
    text = plan(tables.insert_hits(index, index.filter("extra < 3")))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and "Join" not in text
    other = index.withColumn("property_id", F.col("property_id").cast("int"))
    added = tables.new_rows(other, index.filter("extra < 3").unionByName(index.filter("extra = 4").withColumn("property_id", F.lit("77"))), ["property_id"], [F.col("link")])
    assert [(r.property_id, r.link) for r in added.collect()] == [("77", "/4")]


def test_small_source_leaves_the_target_unshuffled(spark, index, no_broadcast):
    keys = ordering.broadcast_if_small(index.select("vendor", "type", "property_id"))
    source = index.filter("extra < 3")
    text = plan(tables.put_by_key(index.withColumnRenamed("created_date", "crawled_date"), source.withColumnRenamed("created_date", "crawled_date"), key="property_id", small_keys=F.broadcast(source.select("property_id"))))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    marked = plan(tables.mark_crawled(index, source, F.current_timestamp(), check_size=True))
    assert "SortMergeJoin" not in marked
    assert keys.count() == 100


def test_large_key_sets_are_not_hinted(spark, index, no_broadcast):
    keys = ordering.broadcast_if_small(index.select("property_id"), limit=10)
    joined = index.join(keys, tables.null_safe(index, keys, ["property_id"]), "left_semi")
    assert "SortMergeJoin" in plan(joined)


def test_numbering_of_few_groups_shuffles_rows_once(spark, index, no_broadcast):
    text = plan(ordering.number_rows(index, ["vendor", "type"], [F.col("created_date"), F.col("property_id")]))
    assert "SortMergeJoin" not in text and "rangepartitioning" not in text


@pytest.mark.parametrize("build", [
    lambda spark, p: extract.extract_listings(p(detail_pages)), lambda spark, p: extract.extract_hits(p(search_pages)),
])
def test_extraction_is_one_narrow_stage(spark, build):
    text = plan(build(spark, lambda pages: stage(pages(spark, SF))))
    assert "Exchange" not in text and text.count("MapInArrow") == 1


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_pairs_rows_blindly(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
