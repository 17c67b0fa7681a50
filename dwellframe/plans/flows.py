"""The crawl's data flows from end to end."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellframe.operators import dedupe, encode, extract, frontier, tables
from dwellframe.operators.ordering import small_or_none
from dwellframe.plans.site_rules import SITES, SiteRules
from dwellframe.schemas import CONTACT_COLUMNS, INDEX_KEYS
from dwellframe.session import stage


class Indexed(NamedTuple):
    index: DataFrame
    set_aside: DataFrame
    visits: DataFrame  # page_id, n_results


def index_search_pages(pages: DataFrame, index: DataFrame) -> Indexed:
    """Search pages into the index, first write wins. Pages are parsed once; the records are staged."""
    records = stage(extract.extract_hits(pages, keep_empty=True))
    good, bad = extract.quarantine(records)
    keys = small_or_none(good.select(*INDEX_KEYS))
    visits = extract.hits_per_page(records)
    return Indexed(tables.insert_hits(index, good, keys), bad.filter("hit_no is not null"), visits)


def pages_to_fetch(visits: DataFrame, plan: DataFrame, max_depth: int) -> DataFrame:
    """The next page of every seed whose last visited page had hits.

    ``visits(seed, idx, n_results)``; ``plan(seed, vendor, crawl_url, style)`` says how a seed's pages are addressed.
    """
    due = frontier.next_page(visits, max_depth).join(plan, "seed")
    return due.withColumn("url", frontier.page_url("vendor", "crawl_url", "style", "next_idx"))


def page_style(sites: Mapping[str, SiteRules] = SITES) -> Column:
    """How a row's ``site`` numbers its search pages, as its rules say."""
    return F.coalesce(*[F.when(F.col("site") == name, F.lit(rules.page_style)) for name, rules in sites.items()])


class Paged(NamedTuple):
    hits: DataFrame  # index records of all pages
    set_aside: DataFrame
    visits: DataFrame  # seed, idx, url, n_results


def page_through(
    seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], sites: Mapping[str, SiteRules] = SITES, max_rounds: int = 1000
) -> Paged:
    """Visit the search pages of ``seeds`` until no page is due: each seed's first page, then the next as long as the last had hits.

    ``seeds(seed, site, vendor, type, crawl_url, max_depth, start_index)``; a null depth or start is the default one. ``fetch``
    gets the due pages (a seed's columns, idx, url) and returns those of them that have landed, as ``extract.extract_hits``
    takes them; a page that has not landed ends its seed. A round reads the pages due in it once and stages their records;
    there are as many rounds as the deepest seed has pages, so what is due shrinks to a fixed point. Null pages, seeds or
    urls are never due.
    """
    styled = seeds.withColumn("style", page_style(sites)).withColumn("max_depth", F.coalesce("max_depth", F.lit(frontier.DEFAULT_DEPTH)))
    planned = frontier.page_plan(styled.withColumn("depth", F.col("max_depth")).withColumn("max_depth", F.lit(-1)))
    due = planned.filter("seed is not null and url is not null").drop("max_depth").withColumnRenamed("depth", "max_depth")
    rounds: list[tuple[DataFrame, DataFrame]] = []
    for _ in range(max_rounds):
        due = stage(due)
        if due.isEmpty():
            break
        pages = fetch(due).withColumn("page_id", F.col("url"))
        records = stage(extract.extract_hits(pages, sites, keep_empty=True))
        visits = stage(due.join(extract.hits_per_page(records).withColumnRenamed("page_id", "url"), "url"))
        rounds.append((records, visits.select("seed", "idx", "url", "n_results")))
        more = visits.filter((F.col("n_results") > 0) & (F.col("idx") < F.col("max_depth"))).withColumn("idx", F.col("idx") + 1)
        due = more.withColumn("url", frontier.page_url("vendor", "crawl_url", "style", "idx")).select(*due.columns)
    else:
        raise RuntimeError(f"pages still due after {max_rounds} rounds")
    if not rounds:
        raise ValueError("no seed has a page to visit")
    records, visits = (reduce(DataFrame.unionByName, side) for side in zip(*rounds, strict=True))
    good, bad = extract.quarantine(records)
    return Paged(good, bad.filter("hit_no is not null"), visits)


class Landed(NamedTuple):
    listings: DataFrame
    set_aside: DataFrame


def land_listings(pages: DataFrame, listings: DataFrame, drop_contacts: bool = False) -> Landed:
    """Detail pages into the listing table, last write wins. ``drop_contacts`` leaves contact columns out of both tables."""
    records = extract.extract_listings(pages)
    good, bad = extract.quarantine(stage(records.drop(*CONTACT_COLUMNS) if drop_contacts else records))
    keys = small_or_none(good.select("key"))
    return Landed(tables.put_by_key(listings, good.drop("page_id"), small_keys=keys), bad)


def for_kv(listings: DataFrame) -> DataFrame:
    return encode.encode_for_kv(listings)


def merge_rental(
    index: DataFrame, rental: DataFrame, order: list[str], vendor: str, since: Column, keys: list[str] | None = None
) -> DataFrame:
    """Clean up the rental documents, add them to the index, recode rent to lease, and make one vendor's
    rows crawled after ``since`` due again. One shuffle in all: that of the clean-up."""
    kept = dedupe.dedupe_survivor(rental, keys, order)
    merged = tables.append_all(index, kept.select(*[c for c in kept.columns if c not in order or c in index.columns]))
    return tables.reset_crawled(tables.recode(merged, "type", "rent", "lease"), vendor, since)
