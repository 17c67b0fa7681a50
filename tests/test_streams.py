"""Streams against their batch counterparts, over several micro-batches, with a replay."""

import datetime as dt
import pathlib
import random

from pyspark.sql import functions as F

from dwellframe.operators import sinks, tables
from dwellframe.operators.ordering import first_per_key
from dwellframe.schemas import FETCH_CHECK, LISTING, PROPERTY_INDEX
from dwellframe.session import scratch_root
from dwellframe.sources.readers import read_jobs, read_lines, read_page_files
from dwellframe.streaming import sinks as streams

DAY = dt.datetime(2024, 1, 1)


def land(df, path, files):
    """Write rows as files in order of their number."""
    for i in range(files):
        df.filter(F.col("file") == i).drop("file").coalesce(1).write.mode("append").parquet(path)


def run(spark, path, schema, sink, checkpoint):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = streams.start_sink(stream, sink, checkpoint).start()
    query.awaitTermination()
    assert query.exception() is None
    return query


def hits(spark, n=400):
    rng = random.Random(5)
    rows = [(rng.choice("vw"), "sell", rng.choice([None, *map(str, range(40))]), f"/l{i}", DAY + dt.timedelta(minutes=i), i * 4 // n) for i in range(n)]
    return spark.createDataFrame(rows, "vendor string, type string, property_id string, link string, created_date timestamp, file int")


def test_index_stream_equals_batch_and_survives_replay(spark, tmp_path):
    data = hits(spark)
    source, out = str(tmp_path / "in"), str(tmp_path / "index")
    land(data, source, 4)
    schema = data.drop("file").schema
    run(spark, source, schema, streams.index_sink(out, "a"), str(tmp_path / "cp"))
    got = lambda: sorted(str(tuple(r)) for r in sinks.read_batches(spark, out, PROPERTY_INDEX).collect())
    empty = spark.createDataFrame([], PROPERTY_INDEX)
    want = sorted(str(tuple(r)) for r in tables.insert_hits(empty, data.drop("file")).select(*PROPERTY_INDEX.names).collect())
    first = got()
    assert first == want and len(first) == len({(r.vendor, r.property_id) for r in data.collect()})
    assert len([p for p in (tmp_path / "index" / "stream=a").iterdir() if p.name.startswith("batch_id=")]) == 4
    streams.index_sink(out, "a")(data.filter("file = 3").drop("file"), 3)
    assert got() == first
    assert sinks.fold_batches(spark, out, PROPERTY_INDEX) == {"a": 2}
    assert got() == first
    streams.index_sink(out, "a")(data.filter("file = 3").drop("file"), 3)
    streams.index_sink(out, "a")(data.drop("file"), 4)
    assert got() == first


def test_check_stream_keeps_first_status(spark, tmp_path):
    rows = [(200 + i % 3, DAY + dt.timedelta(seconds=i), f"ip{i % 7}", i // 20) for i in range(60)]
    data = spark.createDataFrame(rows, "status int, date timestamp, ip string, file int")
    land(data, str(tmp_path / "in"), 3)
    run(spark, str(tmp_path / "in"), FETCH_CHECK, streams.check_sink(str(tmp_path / "out"), "a"), str(tmp_path / "cp"))
    got = {r.ip: r.status for r in sinks.read_batches(spark, str(tmp_path / "out"), FETCH_CHECK).collect()}
    assert got == {f"ip{i}": 200 + i % 3 for i in range(7)}


def listings(spark, n=300):
    rng = random.Random(6)
    rows = [(f"k{rng.randrange(30)}", DAY + dt.timedelta(minutes=rng.randrange(1000)), f"t{i}", i * 3 // n) for i in range(n)]
    df = spark.createDataFrame(rows, "key string, crawled_date timestamp, title string, file int")
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in LISTING], "file")


def test_listing_stream_equals_batch_and_folds(spark, tmp_path):
    data = listings(spark)
    source, out = (str(tmp_path / p) for p in ("in", "out"))
    land(data, source, 3)
    run(spark, source, LISTING, streams.listing_sink(out, "a"), str(tmp_path / "cp"))
    rows = data.drop("file")
    want = {r.key: r.title for r in first_per_key(rows, ["key"], streams.latest_first(rows, "crawled_date")).collect()}
    assert {r.key: r.title for r in streams.read_latest(spark, out).collect()} == want
    assert streams.fold_latest(spark, out) == {"a": 1}
    assert {r.key: r.title for r in streams.read_latest(spark, out).collect()} == want
    folded = spark.read.parquet(f"{out}/base=0")
    assert folded.count() == folded.select("key").distinct().count()


def test_second_stream_and_new_checkpoint_lose_nothing(spark, tmp_path):
    """Two streams into one table, before and after folds: every key is there once, no batch hides another's."""
    data, out = hits(spark), str(tmp_path / "index")
    part = lambda k: data.filter(F.col("file") == k).drop("file")
    keys = lambda: sorted((r.vendor, r.property_id or "") for r in sinks.read_batches(spark, out, PROPERTY_INDEX).collect())
    wanted = lambda n: sorted({(r.vendor, r.property_id or "") for r in data.filter(F.col("file") < n).collect()})
    one, two = (streams.index_sink(out, name) for name in ("one", "two"))
    one(part(0), 0)
    one(part(1), 1)
    two(part(2), 0)
    assert keys() == wanted(3)
    assert sinks.fold_batches(spark, out, PROPERTY_INDEX) == {"one": 0}
    streams.index_sink(out, "three")(part(3), 0)
    two(part(2), 0)  # a replay
    assert keys() == wanted(4)
    two(part(0), 1)
    assert sinks.fold_batches(spark, out, PROPERTY_INDEX) == {"one": 0, "two": 0}
    assert sinks.fold_batches(spark, out, PROPERTY_INDEX) == {"one": 0, "two": 0}
    assert keys() == wanted(4)


def test_concurrent_inserts_are_settled_on_reading(spark, tmp_path):
    out = str(tmp_path / "checks")
    row = lambda status, day: spark.createDataFrame([(status, DAY + dt.timedelta(days=day), "ip")], "status int, date timestamp, ip string")
    sinks.write_batch(row(500, 1), out, "b", 0)
    sinks.write_batch(row(200, 0), out, "a", 0)  # as if both had read the table before either wrote
    got = streams.read_first(spark, out, FETCH_CHECK, ["ip"], ["date"]).collect()
    assert [r.status for r in got] == [200]


def test_equal_times_go_to_the_later_write(spark, tmp_path):
    out = str(tmp_path / "out")
    one = lambda title: listings(spark, 1).drop("file").withColumns({"title": F.lit(title), "key": F.lit("k"), "crawled_date": F.lit(DAY)})
    sink = streams.listing_sink(out, "a")
    for n, title in enumerate(("z old", "b new", "a newest")):
        sink(one(title), n)
    assert [r.title for r in streams.read_latest(spark, out).collect()] == ["a newest"]
    streams.fold_latest(spark, out)
    assert [r.title for r in streams.read_latest(spark, out).collect()] == ["a newest"]
    put = tables.put_by_key(one("z old"), one("b new"))
    assert [r.title for r in put.collect()] == ["b new"]


def test_routed_stream(spark, tmp_path):
    base = hits(spark, 100).withColumn("kind", F.when(F.col("vendor") == "v", "index").otherwise("raw"))
    source, index, raw = (str(tmp_path / p) for p in ("in", "index", "raw"))
    land(base, source, 4)
    sink = streams.route({"index": streams.index_sink(index, "a"), "raw": streams.append_sink(raw, "a")})
    run(spark, source, base.drop("file").schema, sink, str(tmp_path / "cp"))
    kept = sinks.read_batches(spark, index, PROPERTY_INDEX)
    assert {r.vendor for r in kept.collect()} == {"v"}
    assert kept.count() == base.filter("kind = 'index'").select("property_id").distinct().count()
    assert sinks.read_batches(spark, raw, base.drop("file").schema).count() == base.filter("kind = 'raw'").count()


def test_snapshots_and_appends(spark, tmp_path):
    root, houses = str(tmp_path / "idx"), str(tmp_path / "houses")
    data = hits(spark, 50).drop("file")
    assert sinks.snapshot_version(spark, root) is None
    assert sinks.write_snapshot(data, root, ["vendor", "type"]) == 1
    grown = tables.append_all(sinks.read_snapshot(spark, root), data)
    assert sinks.write_snapshot(grown, root, ["vendor", "type"]) == 2
    assert sinks.read_snapshot(spark, root).count() == 100
    (tmp_path / "idx" / "v=3").mkdir()  # a write that was never committed
    assert sinks.snapshot_version(spark, root) == 2
    rows = listings(spark, 20).drop("file")
    sinks.append(rows, houses)
    sinks.append(rows, houses, drop_contacts=True)
    back = spark.read.schema(LISTING).parquet(houses)
    assert back.count() == 40


def test_text_sources(spark, tmp_path):
    (tmp_path / "lines.txt").write_text(" a \n\n\xa0\nb\t\n", encoding="utf8")
    assert [r.value for r in read_lines(spark, str(tmp_path / "lines.txt")).collect()] == ["a", "b"]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p.html").write_text("<p>Giá</p>", encoding="utf8")
    (tmp_path / "pages" / "q.html").write_bytes(b"<p>\xff</p>")
    assert {r.html for r in read_page_files(spark, str(tmp_path / "pages")).collect()} == {"<p>Giá</p>", "<p>\ufffd</p>"}
    (tmp_path / "jobs.json").write_text('{"host": "h", "state": "running", "start_time": "2024-01-01 00:00:00"}\n')
    job = read_jobs(spark, str(tmp_path / "jobs.json")).first()
    assert (job.host, job.state, job.start_time, job.end_time) == ("h", "running", DAY, None)


def test_first_batch_of_an_empty_table_is_compared_with_nothing(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(streams, "small_or_none", lambda keys: asked.append(keys))
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "ip string, date int")
    sink = streams.insert_sink(str(tmp_path / "t"), "s", rows.schema, ["ip"], ["date"])
    sink(rows, 0)
    assert not asked
    sink(spark.createDataFrame([("a", 0), ("b", 4)], rows.schema), 1)
    assert len(asked) == 1
    got = sinks.read_batches(spark, str(tmp_path / "t"), rows.schema).collect()
    assert sorted(got, key=str) == sorted([("a", 1), (None, 3), ("b", 4)], key=str)


def test_routed_batches_are_kept_on_disk_and_dropped(spark, tmp_path):
    """No cached partition takes an executor's memory, or is fetched whole by another, while sinks read a batch."""
    rows = hits(spark, 40).drop("file").withColumns({"kind": F.lit("index"), "key": F.col("property_id"), "crawled_date": F.col("created_date")})
    cached, folders = [], set()
    scratch = pathlib.Path(scratch_root(spark).removeprefix("file:"))

    def seen(sink):
        def write(batch, batch_id):
            sink(batch, batch_id)
            cached.append(batch.storageLevel.useMemory)
            folders.update(p.name for p in scratch.glob("kept-*"))
        return write

    one, two = streams.index_sink(str(tmp_path / "i"), "a"), streams.listing_sink(str(tmp_path / "l"), "a", schema=rows.select("key", "crawled_date").schema)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    streams.route({"index": seen(one), "none": seen(two)})(rows, 0)
    assert len(folders) == 1 and not any(cached)
    assert not list(scratch.glob("kept-*")) and spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert sinks.read_batches(spark, str(tmp_path / "i"), PROPERTY_INDEX).count() == rows.select("vendor", "property_id").distinct().count()
