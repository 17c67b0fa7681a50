"""The commit log, hash buckets and merges of stream tables, snapshots rewritten in part."""

import datetime as dt
import random
import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.operators import commits, sinks
from dwellframe.operators.commits import CommitTaken, commit, read_state
from dwellframe.operators.tables import mark_crawled, reset_crawled
from dwellframe.schemas import LISTING
from dwellframe.streaming import sinks as streams

DAY = dt.datetime(2024, 1, 1)
ITEM = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("at", T.TimestampType()), T.StructField("note", T.StringType()),
])


def items(spark, ids, note, day=0):
    return spark.createDataFrame([(i, "k", DAY + dt.timedelta(days=day), note) for i in ids], ITEM)


# --- log ----------------------------------------------------------------------------------------


def test_a_number_has_one_writer(spark, tmp_path):
    root = str(tmp_path)
    start = read_state(spark, root)
    one = commit(spark, root, start, {"a": {"rows": 1}}, streams={"s": 0})
    assert one.seq == 1 and commit(spark, root, start, {"b": {"rows": 1}}) is None
    two = commit(spark, root, one, {"c": {"rows": 2}}, ["a"], note="x")
    assert read_state(spark, root) == two
    assert (two.seq, list(two.folders), two.streams, two.more) == (2, ["c"], {"s": 0}, {"note": "x"})


def test_racing_writers_get_different_numbers(spark, tmp_path):
    root, won = str(tmp_path), []

    def writer(name):
        for i in range(6):
            while not (done := commit(spark, root, read_state(spark, root), {f"{name}{i}": {}})):
                pass
            won.append(done.seq)

    threads = [threading.Thread(target=writer, args=(n,)) for n in "abc"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(won) == list(range(1, 19)) and len(read_state(spark, root).folders) == 18


def test_a_long_log_is_read_from_its_last_sum(spark, tmp_path, monkeypatch):
    state = commits.State()
    for i in range(3 * commits.STATE_EVERY + 5):
        state = commit(spark, str(tmp_path), state, {f"f{i}": {}}, [f"f{i - 1}"] if i else [], {"s": i})
    calls, plain = [], commits.Files.exists
    monkeypatch.setattr(commits.Files, "exists", lambda self, name: calls.append(name) or plain(self, name))
    assert read_state(spark, str(tmp_path)) == state and state.streams == {"s": 52}
    assert len(calls) <= 14
    log = tmp_path / "_log"  # as if no writer had lived to write a sum
    sums = sorted(log.glob("state-*.json"))
    assert len(sums) == 3
    for file in sums:
        file.unlink()
    assert read_state(spark, str(tmp_path)) == state
    assert sorted(log.glob("state-*.json")) == sums


# --- streams ------------------------------------------------------------------------------------


def listing(spark, title):
    row = {"key": "k", "crawled_date": DAY, "title": title}
    return spark.createDataFrame([tuple(row.get(f.name) for f in LISTING)], LISTING)


def test_equal_times_go_to_the_later_commit_of_any_stream(spark, tmp_path):
    out = str(tmp_path)
    a, b = streams.listing_sink(out, "a"), streams.listing_sink(out, "b")
    for n, title in enumerate(("z", "y", "x")):
        a(listing(spark, title), n)
    b(listing(spark, "w of b"), 0)
    now = lambda: [r.title for r in streams.read_latest(spark, out).collect()]
    assert now() == ["w of b"]
    a(listing(spark, "x"), 2)  # a replay is no later write
    assert now() == ["w of b"]
    streams.fold_latest(spark, out)
    assert now() == ["w of b"]
    a(listing(spark, "v of a"), 3)
    assert now() == ["v of a"]


def test_only_buckets_of_the_batch_are_opened(spark, tmp_path):
    out, keys = str(tmp_path), ["id"]
    sink = lambda s: streams.insert_sink(out, s, ITEM, keys, ["at"], bucket_rows=20)
    sink("a")(items(spark, [f"i{n}" for n in range(600)], "first"), 0)
    sink("b")(items(spark, [f"i{n}" for n in range(500, 900)], "second"), 0)
    state = read_state(spark, out)
    assert [p["rows"] for p in state.folders.values()] == [600, 300]
    assert [p["bits"] for p in state.folders.values()] == [5, 5]  # 600 and at most 400 rows, 20 a bucket
    few = items(spark, ["i3", "i700", "new"], "third")
    opened = sinks.rows_at_keys(spark, out, ITEM, keys, few, state)
    assert len({f.rsplit("/", 1)[0] for f in opened.inputFiles()}) <= 2 * 3 < 64
    assert {r.id for r in opened.collect()} >= {"i3", "i700"}
    # an untouched bucket may be unreadable without anyone noticing
    hit = {f.rsplit("/", 1)[0].rsplit("=", 1)[1] for f in opened.inputFiles()}
    spoiled = next(p for p in (tmp_path / "stream=a" / "batch_id=0").iterdir() if p.name.startswith("bucket=") and p.name.split("=")[1] not in hit)
    for file in spoiled.glob("*.parquet"):
        (spoiled / f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"no parquet")
    sink("a")(few, 1)
    added = sinks._rows(spark, out, ITEM, state, ["stream=a/batch_id=1"]).collect()
    assert [(r.id, r.note) for r in added] == [("new", "third")]


def test_a_writer_that_was_overtaken_looks_again(spark, tmp_path, monkeypatch):
    out, keys, plain = str(tmp_path), ["id"], sinks.commit
    overtaken = []

    def late(*args, **more):
        if more.get("streams") == {"slow": 0} and not overtaken:
            overtaken.append(1)
            streams.insert_sink(out, "fast", ITEM, keys, ["at"])(items(spark, ["x", "y"], "fast"), 0)
        return plain(*args, **more)

    monkeypatch.setattr(sinks, "commit", late)
    streams.insert_sink(out, "slow", ITEM, keys, ["at"])(items(spark, ["w", "x"], "slow", day=-9), 0)
    got = sorted((r.id, r.note) for r in sinks.read_batches(spark, out, ITEM).collect())
    assert got == [("w", "slow"), ("x", "fast"), ("y", "fast")]
    assert read_state(spark, out).streams == {"fast": 0, "slow": 0}


@pytest.mark.parametrize("kind", ["first", "last", "all"])
def test_merges_keep_rows_and_bound_folders(spark, tmp_path, kind):
    out, rng, told, counts = str(tmp_path), random.Random(2), {}, 0
    sink = {
        "first": streams.insert_sink(out, "a", ITEM, ["id"], ["at"], fan=3, bucket_rows=10),
        "last": streams.listing_sink(out, "a", "id", "at", schema=ITEM, fan=3, bucket_rows=10),
        "all": streams.append_sink(out, "a", fan=3),
    }[kind]
    for n in range(14):
        ids = rng.sample(range(60), 12)
        sink(items(spark, [f"i{i}" for i in ids], f"n{n}"), n)
        sink(items(spark, [f"i{i}" for i in ids], "replayed"), n)
        counts += 12
        for i in ids:
            told[f"i{i}"] = told.get(f"i{i}", f"n{n}") if kind == "first" else f"n{n}"
        assert len(read_state(spark, out).folders) <= 2 * 3
    if kind == "all":
        assert sinks.read_batches(spark, out, ITEM).count() == counts
        return
    rows = sinks.read_batches(spark, out, ITEM) if kind == "first" else streams.read_latest(spark, out, ITEM, "id", "at")
    assert {r.id: r.note for r in rows.collect()} == told and rows.count() == len(told)


def test_null_keys_and_empty_batches(spark, tmp_path):
    sink = streams.insert_sink(str(tmp_path), "a", ITEM, ["id", "kind"], ["at"])
    rows = spark.createDataFrame([(None, None, None, "n"), (None, "k", DAY, "m"), (None, None, DAY, "late")], ITEM)
    sink(rows.limit(0), 0)
    sink(rows, 1)
    sink(rows, 2)
    assert sorted(r.note for r in sinks.read_batches(spark, str(tmp_path), ITEM).collect()) == ["m", "n"]


def test_a_stream_that_dies_between_two_sinks_goes_on(spark, tmp_path):
    """One sink has written the batch, the next fails: after the restart every table has every row once."""
    source, out = str(tmp_path / "in"), str(tmp_path)
    for n in range(3):
        items(spark, [f"i{i}" for i in range(n * 10, n * 10 + 15)], f"n{n}").coalesce(1).write.mode("append").parquet(source)
    failures = [1]

    def dies(batch, batch_id):
        if batch_id == 1 and failures:
            failures.pop()
            raise RuntimeError("executor gone")

    def run():
        both = {"k": lambda b, n: (streams.insert_sink(f"{out}/first", "a", ITEM, ["id"], ["at"])(b, n), dies(b, n), streams.append_sink(f"{out}/all", "a")(b, n))}
        rows = spark.readStream.schema(ITEM).option("maxFilesPerTrigger", 1).parquet(source)
        streams.start_sink(rows, streams.route(both), f"{out}/cp").start().awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert sinks.read_batches(spark, f"{out}/all", ITEM).count() == 15
    run()
    assert sinks.read_batches(spark, f"{out}/all", ITEM).count() == 45
    assert sinks.read_batches(spark, f"{out}/first", ITEM).count() == 35


# --- snapshots ----------------------------------------------------------------------------------


@pytest.fixture()
def snapshot(spark, tmp_path):
    root = str(tmp_path / "index")
    rows = [(v, t, f"{n}", DAY + dt.timedelta(hours=n), None) for v in ("v", "w", None) for t in ("sell", "a/b=c") for n in range(20)]
    df = spark.createDataFrame(rows, "vendor string, type string, property_id string, created_date timestamp, last_crawled_date timestamp")
    assert sinks.write_snapshot(df, root, ["vendor", "type"]) == 1
    return root


def files(spark, root, **part):
    return set(sinks.read_snapshot(spark, root, [part] if part else None).inputFiles())


def test_an_update_leaves_other_partitions_alone(spark, snapshot):
    before, mine = files(spark, snapshot), files(spark, snapshot, vendor="v", type="a/b=c")
    claimed = sinks.read_snapshot(spark, snapshot, [{"vendor": "v", "type": "a/b=c"}]).limit(5)
    parts = sinks.parts_of(claimed, ["vendor", "type"])
    assert parts == [{"vendor": "v", "type": "a/b=c"}]
    assert sinks.update_snapshot(spark, snapshot, parts, lambda rows: mark_crawled(rows, claimed, F.lit(DAY))) == 2
    after = files(spark, snapshot)
    assert mine and before - after == mine and before & after == before - mine
    rows = sinks.read_snapshot(spark, snapshot)
    assert rows.count() == 120 and rows.filter("last_crawled_date is not null").select("vendor", "type").distinct().count() == 1
    # one vendor, all its types, null values and new columns
    assert sinks.update_snapshot(spark, snapshot, [{"vendor": "v"}], lambda r: reset_crawled(r, "v", F.lit(DAY - dt.timedelta(1)))) == 3
    assert sinks.update_snapshot(spark, snapshot, [{"vendor": None}], lambda r: r.withColumn("seen", F.lit(1))) == 4
    rows = sinks.read_snapshot(spark, snapshot)
    assert rows.filter("last_crawled_date is not null").count() == 0 and rows.count() == 120
    assert sorted((r.vendor or "", r.seen or 0) for r in rows.groupBy("vendor").agg(F.max("seen").alias("seen")).collect()) == [("", 1), ("v", 0), ("w", 0)]


def test_the_second_writer_fails_and_starts_over(spark, snapshot):
    def slow(rows):
        sinks.update_snapshot(spark, snapshot, [{"vendor": "w"}], lambda r: r.filter("property_id <> '3'"))
        return rows

    with pytest.raises(CommitTaken):
        sinks.update_snapshot(spark, snapshot, [{"vendor": "v"}], slow)
    rows = sinks.read_snapshot(spark, snapshot)
    assert sinks.snapshot_version(spark, snapshot) == 2 and rows.filter("vendor = 'w'").count() == 38 and rows.count() == 118
    with pytest.raises(CommitTaken):
        sinks.write_snapshot(rows, snapshot, ["vendor", "type"], on=1)
    with pytest.raises(ValueError, match="outside"):
        sinks.update_snapshot(spark, snapshot, [{"vendor": "v"}], lambda r: r.withColumn("vendor", F.lit("w")))
    assert sinks.snapshot_version(spark, snapshot) == 2


def test_a_partition_can_vanish_and_a_large_one_spans_files(spark, snapshot, tmp_path):
    sinks.update_snapshot(spark, snapshot, [{"vendor": "w"}], lambda r: r.filter("false"))
    assert sinks.read_snapshot(spark, snapshot).count() == 80
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        rows = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("vendor"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        sinks.write_snapshot(rows, str(tmp_path / "hot"), ["vendor"])
    finally:
        spark.conf.set(key, before)
    assert len(files(spark, str(tmp_path / "hot"), vendor="a")) > 4
    with pytest.raises(FileNotFoundError):
        sinks.update_snapshot(spark, str(tmp_path / "none"), [], lambda r: r)
