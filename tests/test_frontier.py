"""Seeds, paging, batches and their assignment."""

import datetime as dt
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellframe.operators import frontier, monitor
from dwellframe.schemas import SEEDS, TASKS

DAY = dt.datetime(2024, 1, 1)
IDX = "vendor string, type string, property_id string, link string, created_date timestamp_ntz, last_crawled_date timestamp_ntz"


def test_seeds_and_pages(spark):
    configs = spark.createDataFrame(
        [("s", "http://v", 3, 1, {"sell": ["/a", "/b"], "rent": ["/c"]}), ("s", "http://w", None, None, {"sell": ["/d"]})], SEEDS
    )
    seeds = frontier.expand_seeds(configs)
    assert {(r.vendor, r.type, r.crawl_url) for r in seeds.collect()} == {
        ("http://v", "sell", "/a"), ("http://v", "sell", "/b"), ("http://v", "rent", "/c"), ("http://w", "sell", "/d"),
    }
    styled = seeds.withColumn("style", F.when(F.col("vendor") == "http://w", "query").otherwise("path"))
    urls = defaultdict(set)
    for r in frontier.page_plan(styled).collect():
        urls[r.crawl_url].add(r.url)
    assert urls["/a"] == {"http://v/a/p1", "http://v/a/p2", "http://v/a/p3"}
    assert urls["/d"] == {"http://w/d?p=0", "http://w/d?p=1", "http://w/d?p=2"}


def test_first_page_is_visited_past_the_depth(spark):
    seed = spark.sql("select 'v' as vendor, '/a' as crawl_url, 'path' as style, 5 as start_index, 2 as max_depth")
    assert [r.url for r in frontier.page_plan(seed).collect()] == ["v/a/p5"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=8), min_size=1, max_size=12))
def test_prefix_and_next_page(spark, seeds):
    rows = [(s, i, n) for s, hits in enumerate(seeds) for i, n in enumerate(hits, 1)]
    visits = spark.createDataFrame(rows, "seed int, idx int, n_results int")
    kept, following = set(), set()
    for s, hits in enumerate(seeds):
        for i, n in enumerate(hits[:6], 1):
            kept.add((s, i))
            if n == 0:
                break
        if hits and hits[-1] > 0 and len(hits) < 5:
            following.add((s, len(hits) + 1))
    assert {(r.seed, r.idx) for r in frontier.pages_until_empty(visits, 6).collect()} == kept
    assert {tuple(r) for r in frontier.next_page(visits, 5).collect()} == following


def make_index(spark, n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        done = DAY if rng.random() < 0.3 else None
        rows.append((rng.choice("vvvw"), rng.choice(["sell", "sell", "rent"]), str(i), f"/x-pr{i}", DAY + dt.timedelta(days=rng.randrange(9)), done))
    return rows, spark.createDataFrame(rows, IDX)


def test_frontier_and_batches(spark):
    rows, index = make_index(spark, 400)
    want = defaultdict(list)
    for v, t, pid, link, created, done in sorted(rows, key=lambda r: (r[4], r[2])):
        if done is None:
            want[v, t].append(pid)
    pair = frontier.frontier(index, "v", "sell", 10)
    assert [r.property_id for r in pair.orderBy(*frontier.oldest_first()).collect()] == want["v", "sell"][:10]
    got = defaultdict(dict)
    for r in frontier.frontier_per_pair(index, 15).collect():
        got[r.vendor, r.type][r.rn] = r.property_id
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == {k: v[:15] for k, v in want.items()}

    for limit in (None, 2):
        batches = frontier.crawl_batches(frontier.batch_rows(index, 7, limit)).collect()
        found = defaultdict(dict)
        for r in batches:
            assert r.links == ",".join(f"/x-pr{i}" for i in r.property_ids) and r.n == len(r.property_ids) <= 7
            found[r.vendor, r.type][r.batch] = r.property_ids
        for k, ids in want.items():
            runs = [ids[i : i + 7] for i in range(0, len(ids), 7)][:limit]
            assert [found[k][i] for i in sorted(found[k])] == runs


def test_bounded_numbering_beyond_the_limit_threshold(spark):
    _, index = make_index(spark, 400)
    index = index.withColumn("created_date", F.when(F.col("property_id") % 11 != 0, F.col("created_date") + F.expr("make_dt_interval(0, cast(property_id as int) % 5)")))
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(key, "10")
    try:
        bounded = frontier.batch_rows(index, 6, 5)
        rows = frontier.uncrawled(index).select("vendor", "type", "link", "property_id", "created_date")
        assert 0 < frontier.oldest_candidates(rows, 3).count() < rows.count()
    finally:
        spark.conf.unset(key)
    full = frontier.batch_rows(index, 6).filter("batch < 5")
    as_rows = lambda df: sorted((r.vendor, r.type, r.batch, r.rn, r.property_id) for r in df.collect())
    assert as_rows(bounded) == as_rows(full) == as_rows(frontier.batch_rows(index, 6, 5))


def test_prefix_keeps_a_start_beyond_the_depth(spark):
    visits = spark.createDataFrame([("a", 5, 3), ("a", 6, 1), ("b", 1, 2), ("b", 2, 1), ("b", 3, 1)], "seed string, idx int, n_results int")
    assert {(r.seed, r.idx) for r in frontier.pages_until_empty(visits, 2).collect()} == {("a", 5), ("b", 1), ("b", 2)}


def test_repeated_pairs_and_task_order(spark):
    batches = spark.createDataFrame([(v, "sell", b, 10) for v in "av" for b in range(3)], "vendor string, type string, batch long, n long")
    tasks = spark.createDataFrame(
        [(0, "s", "v", ["sell"]), (1, "s", "a", ["sell"]), (2, "s2", "v", ["rent", "sell"])], "task_pos int, spider string, vendor string, types array<string>")
    got = sorted((r.slot, r.vendor, r.batch) for r in frontier.number_batches(batches, tasks).collect())
    assert got == [(0, "v", 0), (1, "v", 1), (2, "v", 2), (3, "a", 0), (4, "a", 1), (5, "a", 2)]


def test_no_free_place_claims_nothing(spark):
    _, index = make_index(spark, 50)
    tasks = spark.createDataFrame([("s", "v", ["sell"])], TASKS)
    hosts = spark.createDataFrame([("h1", 5)], "host string, running int")
    assigned, after = frontier.claim_cycle(index, tasks, hosts, 5, F.lit("2024-06-01").cast("timestamp_ntz"))
    assert assigned.count() == 0 and after.exceptAll(index).count() == 0


def test_claim_assigns_every_batch_once(spark):
    rows, index = make_index(spark, 300)
    tasks = spark.createDataFrame([("s", "v", ["rent", "none", "sell"]), ("s", "w", ["sell"])], TASKS)
    hosts = spark.createDataFrame([("h1", 3), ("h2", 0), ("h3", 9), ("h4", 4)], "host string, running int")
    now = F.lit("2024-06-01").cast("timestamp_ntz")
    assigned, after = frontier.claim_cycle(index, tasks, hosts, 5, now, size=10)
    assigned = assigned.collect()
    assert sorted(r.slot for r in assigned) == list(range(len(assigned))) == list(range(8))
    per_host = defaultdict(int)
    for r in assigned:
        per_host[r.host] += 1
    assert per_host == {"h1": 2, "h2": 5, "h4": 1}
    order = [(r.vendor, r.type) for r in sorted(assigned, key=lambda r: r.slot)]
    assert order == sorted(order, key=lambda k: (k[0], ["rent", "none", "sell"].index(k[1])))
    claimed = {(r.vendor, r.type, i) for r in assigned for i in r.property_ids}
    stamped = {(r.vendor, r.type, r.property_id) for r in after.filter(F.col("last_crawled_date") == now).collect()}
    assert stamped == claimed and after.count() == 300
    short = {(r.vendor, r.type) for r in frontier.exhausted_types(tasks, index).collect()}
    assert short == {("v", "none")}


def test_split_links(spark):
    batches = spark.sql("select 'http://v' as vendor, 'http://v/a,http://v/b?u=http://c' as links union all select 'w', 'http://w/a'")
    got = [(r.vendor, r.url) for r in frontier.split_links(batches, ["http://v"]).collect()]
    assert sorted(got) == [("http://v", "https://v/a"), ("http://v", "https://v/b?u=https://c"), ("w", "http://w/a")]


def test_figures(spark):
    t = lambda m: DAY + dt.timedelta(minutes=m)
    jobs = spark.createDataFrame(
        [("h", "finished", t(0), t(70)), ("h", "finished", t(0), t(10)), ("h", "running", t(0), None), ("g", "pending", None, None)],
        "host string, state string, start_time timestamp_ntz, end_time timestamp_ntz",
    )
    got = {r.host: tuple(r)[1:] for r in monitor.job_stats(jobs).collect()}
    assert got == {"h": (1, 2, 40.0), "g": (0, 0, None)}
    assert {r.host: r.avg_minutes for r in monitor.job_stats(jobs, compat=True).collect()} == {"h": 10.0, "g": None}
    hosts = spark.createDataFrame([("a", True, 3, t(0)), ("b", False, 4, t(5))], "host string, alive boolean, spawned int, started_at timestamp_ntz")
    now = F.lit(str(t(2 * 1440 + 3 * 60 + 4))).cast("timestamp_ntz")
    assert tuple(monitor.fleet_summary(hosts, now).first()) == (1, 7, 2, 3, 4)
