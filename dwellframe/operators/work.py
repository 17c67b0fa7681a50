"""The work table: an index kept in time order, from which claims are taken once and can be asked for again.

The index lies in partitions of (vendor, type, period of creation), and its log says how many rows of each are
uncrawled. So a claim reads the oldest partitions that have enough rows, and counts nothing. A claim is one commit:
the partitions it took rows from, rewritten with those rows marked, and the record of what was claimed. Asking again
under the same name gives the record; two claimers cannot get the same rows, since the later one's commit fails and
it starts over on the newer version.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellframe.operators import frontier, sinks, tables
from dwellframe.operators.commits import CommitTaken, Files, State, read_entry, read_state
from dwellframe.schemas import INDEX_KEYS
from dwellframe.session import stage

PERIOD = "period"
PARTS = [*frontier.GROUP, PERIOD]


def measures() -> dict[str, Column]:
    """What the log keeps of each partition."""
    return {"rows": F.count(F.lit(1)), "due": F.count_if(F.col("last_crawled_date").isNull())}


def with_period(index: DataFrame, unit: str = "day") -> DataFrame:
    """``index`` with the period of its creation as sortable text; empty where that is not known, so it sorts first."""
    start = F.date_format(F.date_trunc(unit, "created_date"), "yyyy-MM-dd HH:mm")
    return index.withColumn(PERIOD, F.coalesce(start, F.lit("-")))


def write_work(index: DataFrame, root: str, unit: str = "day") -> int:
    """Write an index, in which every key occurs once, as a work table or its next version; returns the version."""
    return sinks.write_snapshot(with_period(index, unit), root, PARTS, measures=measures(), unit=unit)


def read_work(spark: SparkSession, root: str) -> DataFrame:
    return sinks.read_snapshot(spark, root).drop(PERIOD)


def insert_work(spark: SparkSession, root: str, hits: DataFrame) -> int:
    """Add hits of keys the table lacks, first write wins. Rewrites only the partitions that get rows.

    A key's earlier row may lie in any period of its vendor and type, so their keys are read (and only those columns).
    """
    state = read_state(spark, root)
    rows = with_period(tables.index_rows(hits), state.more["unit"])
    known = sinks.read_snapshot(spark, root, sinks.parts_of(rows, frontier.GROUP)).select(*INDEX_KEYS)
    order = tables.total_order(rows, [F.col("created_date").asc_nulls_first()], [*INDEX_KEYS, "created_date"])
    fresh = stage(tables.new_rows(known, rows, INDEX_KEYS, order))
    parts = sinks.parts_of(fresh, PARTS)
    if not parts:
        return state.seq
    return sinks.update_snapshot(spark, root, parts, lambda old: old.unionByName(fresh, allowMissingColumns=True), state.seq, measures())


def oldest_parts(state: State, wanted: int) -> list[dict]:
    """For each vendor and type the oldest partitions with uncrawled rows, until there are ``wanted`` rows. From the log alone."""
    by_pair = defaultdict(list)
    for folder, props in state.folders.items():
        own = sinks._partition(folder)
        if props["due"]:
            by_pair[own["vendor"], own["type"]].append((own[PERIOD], props["due"], own))
    parts = []
    for periods in by_pair.values():
        found = 0
        for _, due, own in sorted(periods, key=lambda p: p[0]):
            if found >= wanted:
                break
            parts.append(own)
            found += due
    return parts


def _claimed(spark: SparkSession, root: str, claim: str) -> DataFrame | None:
    """The rows of a claim that was committed: of its tries, the one that its commit names."""
    for name in Files(spark, root).names(f"claims/{claim}"):
        entry = read_entry(spark, root, int(name.split("-")[0]))
        if entry and entry["more"].get("claim") == f"claims/{claim}/{name}":
            return _read_claim(spark, root, f"claims/{claim}/{name}")
    return None


def _read_claim(spark: SparkSession, root: str, folder: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{folder}")


def claim_work(
    spark: SparkSession, root: str, claim: str, tasks: DataFrame, hosts: DataFrame, max_parallel: int, run_ts: Column,
    size: int = 100, tries: int = 10,
) -> DataFrame:
    """Batches of claim ``claim`` with their hosts, as :func:`frontier.claim_cycle` would hand them out; marked as crawled.

    The claim's rows are written first and become valid with the commit that marks them. A claim known to the table is
    not made again: whoever retries gets the same batches.
    """
    if not claim or "/" in claim:
        raise ValueError("a claim's name must not be empty or hold /")
    capacity = frontier.fleet_capacity(hosts, max_parallel)
    for _ in range(tries):
        state = read_state(spark, root)
        if (rows := _claimed(spark, root, claim)) is not None:
            return frontier.crawl_batches(rows, "host", "slot")
        due = sinks.read_snapshot(spark, root, oldest_parts(state, size * capacity), state)
        rows = frontier.uncrawled(due).select(*frontier.GROUP, "link", "property_id", "created_date")
        numbered = stage(frontier.in_batches(frontier.bounded_rows(rows, size * capacity), size))
        folder = f"claims/{claim}/{state.seq + 1}-{uuid.uuid4().hex[:12]}"
        frontier.placed_rows(numbered, tasks, hosts, max_parallel).write.parquet(f"{root.rstrip('/')}/{folder}")
        rows = _read_claim(spark, root, folder)
        taken = sinks.parts_of(with_period(rows, state.more["unit"]), PARTS)
        mark = lambda old: tables.mark_crawled(old, rows, run_ts, check_size=True)  # noqa: E731, B023
        try:
            sinks.update_snapshot(spark, root, taken, mark, state.seq, measures(), claim=folder)
        except CommitTaken:
            continue
        return frontier.crawl_batches(rows, "host", "slot")
    raise CommitTaken(f"claim {claim} was overtaken {tries} times")
