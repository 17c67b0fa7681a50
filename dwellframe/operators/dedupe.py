"""Duplicate groups and survivorship, as pre-aggregated group-bys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellframe.operators.ordering import null_safe, number_rows


def dup_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def dup_members(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Every row of a duplicate group with the group's size ``n`` and its scan position ``pos`` (from 1).

    One row per member instead of one list per group: a list of a hot group's ids would not fit a task.
    """
    return number_rows(df, keys, order, "pos", size_out="n").filter("n > 1")


def survivor_states(
    df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None, area: str = "property_area"
) -> DataFrame:
    """Per key the two candidates for survival, as (keys, first, with_area): the first document, and the first with an area.

    Each is a struct (rank, doc). Both are ``min_by`` aggregates, so one shuffle of at most one partial row per key and
    map task is enough, however many copies a key has.
    """
    keys = keys or ["property_id"]
    rank = F.struct(*(order or ["seq"]))
    told = F.struct(rank.alias("rank"), F.struct(*[c for c in df.columns if c not in keys]).alias("doc"))
    has_area = F.when(F.col(area).isNotNull(), rank)
    return df.groupBy(*keys).agg(F.min_by(told, rank).alias("first"), F.min_by(told, has_area).alias("with_area"))


def merge_survivors(states: DataFrame, arriving: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """States of the union of the documents behind two sets of states.

    Arriving documents are reduced to states first, so what is shuffled is a row per key of each side; documents seen
    before are not read again. The result can be stored and merged with what comes next.
    """
    keys = keys or ["property_id"]
    both = states.unionByName(arriving)
    return both.groupBy(*keys).agg(
        F.min_by("first", "first.rank").alias("first"), F.min_by("with_area", "with_area.rank").alias("with_area")
    )


def survivors(
    states: DataFrame, columns: list[str], area: str = "property_area", others: tuple[str, ...] = ("property_size_unit", "property_price_unit")
) -> DataFrame:
    """The surviving document of each key, from its states.

    The passes of the clean-up delete, per key, (1) later documents without an area, (2) documents with none of area,
    size unit and price unit, (3) all but the first of what remains. Hence the survivor is the first
    document if it carries any of the three; else the first one with an area; else the first.
    """
    described = reduce(lambda a, b: a | b, [F.col(f"first.doc.{c}").isNotNull() for c in (area, *others)])
    kept = F.when(described, F.col("first.doc")).otherwise(F.coalesce("with_area.doc", "first.doc"))
    keys = [c for c in states.columns if c not in ("first", "with_area")]
    return states.select(*keys, kept.alias("doc")).select(*keys, "doc.*").select(*columns)


def dedupe_survivor(
    df: DataFrame,
    keys: list[str] | None = None,
    order: list[str] | None = None,
    area: str = "property_area",
    others: tuple[str, ...] = ("property_size_unit", "property_price_unit"),
) -> DataFrame:
    """One document per key, chosen the way a three-pass clean-up would leave it. One shuffle of partial states."""
    return survivors(survivor_states(df, keys, order, area), df.columns, area, others)


def delete_unless_survivor(df: DataFrame, survivors: DataFrame, identity: list[str]) -> DataFrame:
    """Rows of ``df`` the clean-up deletes."""
    return df.join(survivors.select(*identity), null_safe(df, survivors, identity), "left_anti")
