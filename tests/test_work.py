"""The work table and its claims, paging to a fixed point, survivors kept up to date."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.operators import dedupe, frontier, sinks, work
from dwellframe.operators.commits import read_state
from dwellframe.plans import driver_views as dv
from dwellframe.plans import flows
from dwellframe.plans.site_rules import SITES
from dwellframe.schemas import PROPERTY_INDEX

DAY = dt.datetime(2024, 1, 1)
NOW = F.lit  # a constant run time
SF = "/root/testdata/sf0.001"


def index_rows(spark, days=6, per_day=5, pairs=(("v", "sell"), ("v", "rent"), ("w", "sell")), first=0):
    rows = [
        {"vendor": v, "type": t, "property_id": f"{first + d * per_day + n}", "link": f"/{v}{t}{d}-{n}", "created_date": DAY + dt.timedelta(days=d, hours=n)}
        for v, t in pairs for d in range(days) for n in range(per_day)
    ]
    return spark.createDataFrame([tuple(r.get(f.name) for f in PROPERTY_INDEX) for r in rows], PROPERTY_INDEX)


@pytest.fixture()
def fleet(spark):
    tasks = spark.createDataFrame([("v", ["sell", "rent"]), ("w", ["sell"])], "vendor string, types array<string>")
    return tasks, spark.createDataFrame([("h1", 1), ("h2", 2)], "host string, running long")


def claim(spark, root, name, fleet, places=3, size=4):
    return work.claim_work(spark, root, name, *fleet, places, F.lit(DAY), size)


def rows_of(batches):
    return sorted((r.host, r.slot, r.vendor, r.type, r.batch, r.n, r.links) for r in batches.collect())


def test_a_claim_reads_the_oldest_partitions_only(spark, tmp_path, fleet):
    root = str(tmp_path / "w")
    index = index_rows(spark)
    work.write_work(index, root)
    state = read_state(spark, root)
    assert len(state.folders) == 18 and {(p["rows"], p["due"]) for p in state.folders.values()} == {(5, 5)}
    parts = work.oldest_parts(state, 12)  # three days of five rows for each of three pairs
    assert sorted((p["vendor"], p["type"], p["period"][:10]) for p in parts) == sorted((v, t, f"2024-01-0{d}") for v, t in (("v", "sell"), ("v", "rent"), ("w", "sell")) for d in (1, 2, 3))
    for folder in state.folders:  # later days may be unreadable
        if sinks._partition(folder)["period"] > "2024-01-04":
            for file in (tmp_path / "w" / folder).glob("*.parquet"):
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
                file.write_bytes(b"no parquet")
    got = rows_of(claim(spark, root, "a", fleet))
    want, after = frontier.claim_cycle(index, *fleet, 3, F.lit(DAY), 4)
    assert got == rows_of(want) and len(got) == 3
    marked = after.filter("last_crawled_date is not null").select("link")
    now = sinks.read_snapshot(spark, root, parts).filter("last_crawled_date is not null").select("link")
    assert sorted(marked.collect()) == sorted(now.collect()) and now.count() == 12
    due = {f: p["due"] for f, p in read_state(spark, root).folders.items()}
    assert sum(due.values()) == 90 - 12


def test_a_claim_asked_for_again_is_the_same_and_the_next_goes_on(spark, tmp_path, fleet):
    root = str(tmp_path / "w")
    work.write_work(index_rows(spark), root)
    first = rows_of(claim(spark, root, "a", fleet))
    version = sinks.snapshot_version(spark, root)
    assert rows_of(claim(spark, root, "a", fleet)) == first and sinks.snapshot_version(spark, root) == version
    taken = [link for r in first for link in r[-1].split(",")]
    for name in ("b", "a", "c", "d", "e", "f", "g", "h", "i", "a"):
        batches = rows_of(claim(spark, root, name, fleet))
        if name == "a":
            assert batches == first
        else:
            taken += [link for r in batches for link in r[-1].split(",")]
    assert len(taken) == len(set(taken)) == 90  # every row once, then none
    assert rows_of(claim(spark, root, "z", fleet)) == []


def test_a_claim_that_died_before_its_commit_never_happened(spark, tmp_path, fleet, monkeypatch):
    root = str(tmp_path / "w")
    work.write_work(index_rows(spark), root)
    with monkeypatch.context() as m:
        m.setattr(sinks, "update_snapshot", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            claim(spark, root, "a", fleet)
    assert work.read_work(spark, root).filter("last_crawled_date is not null").count() == 0
    got = rows_of(claim(spark, root, "a", fleet))
    assert sum(r[5] for r in got) == 12 == work.read_work(spark, root).filter("last_crawled_date is not null").count()
    assert rows_of(claim(spark, root, "a", fleet)) == got


def test_a_claimer_that_was_overtaken_takes_other_rows(spark, tmp_path, fleet, monkeypatch):
    root, plain, others = str(tmp_path / "w"), sinks.update_snapshot, []
    work.write_work(index_rows(spark), root)

    def late(*args, **more):
        if more.get("claim", "").startswith("claims/slow") and not others:
            others.append(rows_of(claim(spark, root, "fast", fleet)))
        return plain(*args, **more)

    monkeypatch.setattr(sinks, "update_snapshot", late)
    slow = rows_of(claim(spark, root, "slow", fleet))
    links = lambda rows: {link for r in rows for link in r[-1].split(",")}
    assert len(links(slow)) == len(links(others[0])) == 12 and not links(slow) & links(others[0])
    assert rows_of(claim(spark, root, "fast", fleet)) == others[0]


def test_inserts_rewrite_only_partitions_that_get_rows(spark, tmp_path):
    root = str(tmp_path / "w")
    work.write_work(index_rows(spark), root)
    before = set(read_state(spark, root).folders)
    hits = index_rows(spark, days=7, pairs=(("v", "sell"),)).withColumn("link", F.lit("later"))
    assert work.insert_work(spark, root, hits) == 2
    state = read_state(spark, root)
    assert before <= set(state.folders) and len(state.folders) == 19  # a day more, the others known
    assert work.read_work(spark, root).filter("link = 'later'").count() == 5
    assert work.insert_work(spark, root, hits) == 2
    nulls = index_rows(spark, days=1, per_day=1, pairs=(("v", "sell"),)).withColumn("created_date", F.lit(None).cast("timestamp")).withColumn("property_id", F.lit(None).cast("string"))
    assert work.insert_work(spark, root, nulls) == 3
    assert {"vendor": "v", "type": "sell", "period": "-"} in work.oldest_parts(read_state(spark, root), 1)
    assert work.insert_work(spark, root, nulls) == 3


# --- paging -------------------------------------------------------------------------------------


def test_paging_stops_at_empty_pages_depth_and_pages_that_never_landed(spark):
    seeds = dv.paged_seeds(spark, SF)
    rounds = []

    def fetch(due):
        rounds.append(due.count())
        return dv.fetch_paged(due)

    paged = flows.page_through(seeds, fetch)
    want = []
    for s in seeds.collect():
        first = s.start_index if s.start_index is not None else 0 if s.site == "mbnd" else 1
        idx, depth = first, s.max_depth if s.max_depth is not None else frontier.DEFAULT_DEPTH
        while not (idx == 4 and s.seed % 7 == 0):
            n = 3 if idx <= s.filled else 0
            want.append((s.seed, idx, n))
            idx += 1
            if not n or idx > depth:
                break
    got = paged.visits.collect()
    assert sorted((r.seed, r.idx, r.n_results) for r in got) == sorted(want)
    assert all(("?p=" in r.url) == (SITES[{0: "bds", 1: "mbnd", 2: "tbds"}[r.seed % 3]].page_style == "query") for r in got)
    assert rounds[0] == seeds.count() and rounds == sorted(rounds, reverse=True) and 3 <= len(rounds) <= 7
    assert paged.hits.count() + paged.set_aside.count() == sum(n for *_, n in want)
    with pytest.raises(RuntimeError):
        flows.page_through(seeds, dv.fetch_paged, max_rounds=2)
    with pytest.raises(ValueError):
        flows.page_through(seeds.limit(0), dv.fetch_paged)


# --- survivors ----------------------------------------------------------------------------------

RENTAL = T.StructType([
    T.StructField("property_id", T.IntegerType()), T.StructField("seq", T.IntegerType()),
    *[T.StructField(n, T.StringType()) for n in ("property_area", "property_size_unit", "property_price_unit")],
])


def test_merged_survivors_equal_those_of_the_union(spark):
    rng = random.Random(9)
    some = lambda: rng.choice([None, None, "x"])
    rows = [(rng.choice([None, *range(60)]), seq, some(), some(), some()) for seq in rng.sample(range(1000), 500)]
    deliveries = [spark.createDataFrame(rows[k::3] or [], RENTAL) for k in range(3)]
    states = dedupe.survivor_states(deliveries[0])
    for arriving in deliveries[1:]:
        states = dedupe.merge_survivors(states, dedupe.survivor_states(arriving))
    states = dedupe.merge_survivors(states, dedupe.survivor_states(deliveries[0].limit(0)))
    got = dedupe.survivors(states, RENTAL.names).collect()
    want = dedupe.dedupe_survivor(spark.createDataFrame(rows, RENTAL)).collect()
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 61
