"""Table changes, duplicates and numbering against step-by-step readings."""

import datetime as dt
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellframe.operators import dedupe, encode, ordering, sinks, tables
from dwellframe.schemas import INDEX_KEYS

IDX = "vendor string, type string, property_id string, link string, created_date timestamp_ntz, last_crawled_date timestamp_ntz"
DAY = dt.datetime(2024, 1, 1)


def index(spark, rows):
    return spark.createDataFrame([(v, t, p, link, DAY + dt.timedelta(days=d), c) for v, t, p, link, d, c in rows], IDX)


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_insert_keeps_first_and_matches_null_keys(spark):
    stored = index(spark, [("v", "sell", None, "old", 5, DAY), ("v", "sell", "1", "old", 5, None)])
    hits = index(spark, [
        ("v", "sell", None, "new", 1, None), ("v", "sell", "1", "new", 1, None), ("v", "rent", "1", "b", 2, None),
        ("v", "rent", "1", "a", 1, None), ("v", "rent", None, "c", 1, None), ("v", "rent", None, "d", 1, None),
    ])
    once = tables.insert_hits(stored, hits)
    links = {(r.type, r.property_id): r.link for r in once.collect()}
    assert links == {("sell", None): "old", ("sell", "1"): "old", ("rent", "1"): "a", ("rent", None): "c"}
    assert as_set(tables.insert_hits(once, hits)) == as_set(once)
    added = once.filter("link = 'a'").first()
    assert added.last_crawled_date is None


def test_small_key_path_gives_the_same(spark):
    rng = random.Random(1)
    make = lambda n: index(spark, [("v", rng.choice("ab"), rng.choice([None, "1", "2", "3", "4"]), str(i), i % 5, None) for i in range(n)])
    stored, hits = tables.insert_hits(make(0), make(6)), make(30)
    order = [F.col("created_date"), F.col("link")]
    keys = ordering.broadcast_if_small(hits.select(*INDEX_KEYS))
    slim = tables.new_rows(stored, hits, INDEX_KEYS, order, keys)
    assert as_set(slim) == as_set(tables.new_rows(stored, hits, INDEX_KEYS, order))


def test_put_by_key(spark):
    schema = "key string, crawled_date timestamp_ntz, title string"
    at = lambda d: DAY + dt.timedelta(days=d)
    stored = spark.createDataFrame([("a", at(1), "old"), ("b", at(9), "newer"), ("c", at(1), "same day")], schema)
    puts = spark.createDataFrame([("a", at(2), "x"), ("a", at(3), "y"), ("b", at(5), "late"), ("c", at(1), "put"), ("d", at(1), "d")], schema)
    want = {"a": "y", "b": "newer", "c": "put", "d": "d"}
    assert {r.key: r.title for r in tables.put_by_key(stored, puts).collect()} == want
    keys = F.broadcast(puts.select("key").distinct())
    assert {r.key: r.title for r in tables.put_by_key(stored, puts, small_keys=keys).collect()} == want


def test_mark_recode_reset(spark):
    rows = index(spark, [("v", "rent", None, "a", 1, None), ("v", "rent", "1", "b", 1, None), ("v", "sell", "1", "c", 1, None)])
    claimed = rows.filter("link in ('a', 'b')")
    now = F.lit("2024-06-01").cast("timestamp_ntz")
    for check in (False, True):
        marked = tables.mark_crawled(rows, claimed.union(claimed), now, check)
        assert {r.link: r.last_crawled_date is not None for r in marked.collect()} == {"a": True, "b": True, "c": False}
    assert {r.type for r in tables.recode(rows, "type", "rent", "lease").collect()} == {"lease", "sell"}
    reset = tables.reset_crawled(marked, "v", F.lit("2024-05-01").cast("timestamp_ntz"))
    assert reset.filter("last_crawled_date is not null").count() == 0
    kept = tables.reset_crawled(marked, "v", now)
    assert kept.filter("last_crawled_date is not null").count() == 2


def test_append_and_semi(spark):
    a, b = spark.sql("select 1 as x, 'p' as p"), spark.sql("select 2 as x, 'q' as q")
    assert as_set(tables.append_all(a, b)) == {(1, "p", None), (2, None, "q")}
    df = spark.sql("select * from values (1, cast(null as string)), (2, 'a'), (3, 'b') t(i, k)")
    wanted = spark.sql("select * from values (cast(null as string)), ('a'), ('a') t(k)")
    assert {r.i for r in tables.semi_by_keys(df, wanted, ["k"]).collect()} == {1, 2}


def test_require_fields(spark):
    df = spark.sql("select * from values (1, 'a', array('x')), (2, '', array('x')), (3, 'a', array()), (4, null, null) t(i, s, l)")
    good, bad = tables.require_fields(df, ["s", "l"])
    assert [r.i for r in good.collect()] == [1]
    assert {r.i: r._missing for r in bad.collect()} == {2: ["s"], 3: ["l"], 4: ["s", "l"]}
    good, bad = tables.require_fields(df)
    assert good.count() == 4 and bad.count() == 0


def three_passes(docs):
    """The clean-up as three rounds of deletion over documents in scan order."""
    kept = list(docs)
    if len(kept) > 1:
        kept = kept[:1] + [d for d in kept[1:] if d[1] is not None]
    if len(kept) > 1:
        kept = [d for d in kept if any(v is not None for v in d[1:])]
    return kept[0]


maybe = st.sampled_from([None, "x"])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), maybe, maybe, maybe), min_size=1, max_size=80))
def test_survivor_equals_three_passes(spark, docs):
    rows = [(None if k == 0 else k, i, a, s, p) for i, (k, a, s, p) in enumerate(docs)]
    df = spark.createDataFrame(
        rows, "property_id int, seq int, property_area string, property_size_unit string, property_price_unit string"
    )
    groups = defaultdict(list)
    for k, *doc in rows:
        groups[k].append(tuple(doc))
    want = {(k, *three_passes(v)) for k, v in groups.items()}
    assert as_set(dedupe.dedupe_survivor(df.repartition(4))) == want
    deleted = dedupe.delete_unless_survivor(df, dedupe.dedupe_survivor(df), ["property_id", "seq"])
    assert deleted.count() == len(rows) - len(want)


def test_dup_groups_and_members(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 5), ("b", 4)], "k string, seq int")
    assert as_set(dedupe.dup_groups(df, ["k"])) == {(None, 2), ("b", 2)}
    got = dedupe.dup_members(df, ["k"], [F.col("seq")]).select("k", "seq", "n", "pos")
    assert as_set(got) == {(None, 1, 2, 1), (None, 2, 2, 2), ("b", 4, 2, 1), ("b", 5, 2, 2)}


def test_numbering_with_a_hot_group(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "hot", "hot", "hot", "x"]), rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, a int, i int").repartition(8)
    want = {}
    for g in (None, "hot", "x"):
        for n, r in enumerate(sorted(r[1:] for r in rows if r[0] == g), 1):
            want[r[1]] = n
    order = [F.col("a"), F.col("i")]
    numbered = ordering.number_rows(df, ["g"], order)
    assert {r.i: r.rn for r in numbered.collect()} == want
    top = ordering.top_k_per_group(df, ["g"], order, 100, salt_by=["i"])
    assert {r.i: r.rn for r in top.collect()} == {i: n for i, n in want.items() if n <= 100}
    beyond = ordering.top_k_per_group(df, ["g"], order, 1200, salt_by=["i"])
    assert {r.i: r.rn for r in beyond.collect()} == {i: n for i, n in want.items() if n <= 1200}


def test_running_total(spark):
    df = spark.createDataFrame([(f"h{i:03}", i % 4) for i in range(200)], "host string, free int").repartition(5)
    total, want = 0, {}
    for i in range(200):
        total += i % 4
        want[f"h{i:03}"] = total
    got = ordering.running_total(df, [F.col("host")], "free", "upto")
    assert {r.host: r.upto for r in got.collect()} == want


def test_encode(spark):
    df = spark.sql(
        "select timestamp'2024-01-02 03:04:05.678' as t, timestamp_ntz'2024-01-02 03:04:05' as n, date'2024-01-02' as d, "
        "0.1d as f, cast(2.5 as float) as g, '' as e, 'x' as s, 7 as i, array('') as a, cast(null as string) as z"
    )
    row = encode.encode_for_kv(df).first().asDict()
    assert {k: str(v) for k, v in row.items() if k in "fg"} == {"f": "0.100000000000000000", "g": "2.500000000000000000"}
    assert {k: v for k, v in row.items() if k not in "fg"} == {
        "t": "2024-01-02 03:04:05", "n": "2024-01-02 03:04:05", "d": "2024-01-02", "e": " ", "s": "x", "i": 7, "a": [""],
        "z": None, "f_text": None, "g_text": None,
    }
    upper = encode.encode_for_kv(df.select("s", "e"), {"string": F.upper}).first()
    assert tuple(upper) == ("X", "")


def test_encode_loses_no_number(spark):
    values = [1e21, 123456789012345678901.0, 1.5e-19, float("nan"), float("inf"), -float("inf"), 0.1, -2.5, 0.0, None]
    rows = encode.encode_for_kv(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")).orderBy("i").collect()
    for v, r in zip(values, rows, strict=True):
        assert (r.x is None) or (r.x_text is None)
        back = None if r.x is None and r.x_text is None else float(r.x if r.x is not None else r.x_text.replace("Infinity", "inf"))
        assert repr(back) == repr(v)
    assert [r.x is None for r in rows] == [True] * 6 + [False] * 3 + [True]


def test_encode_time(spark):
    df = spark.sql("select time'03:04:05.678' as t")
    assert encode.encode_for_kv(df).first()[0] == "03:04:05"


def test_staged_tables_are_dropped(spark, tmp_path):
    from dwellframe import session

    before, kept = session.staged(), session.stage(spark.range(3))
    with session.staging(spark):
        inner = session.stage(spark.range(5))
        folder = session.staged()[-1]
        assert inner.count() == 5 and sinks.exists(spark, folder)
    assert not sinks.exists(spark, folder) and session.staged()[:-1] == before and kept.count() == 3
    assert session.drop_staged(spark, len(before)) == 1 and session.staged() == before


def test_far_too_many_keys_are_not_shuffled_to_be_measured(spark, monkeypatch):
    keys = spark.range(5000).selectExpr("cast(id % 4000 as string) as k", "id % 2 as l")
    assert ordering.small_or_none(keys).count() == 4000
    monkeypatch.setattr(ordering, "measured_bytes", lambda df: 1 / 0)
    assert ordering.small_or_none(keys, limit=4000) is None
