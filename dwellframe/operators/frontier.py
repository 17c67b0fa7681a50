"""Seeds, paging, the crawl frontier and its batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellframe.functions.scalars import as_column, upgrade_scheme
from dwellframe.operators.ordering import broadcast_if_small, limit_threshold, number_rows, top_k_per_group
from dwellframe.operators.tables import mark_crawled
from dwellframe.session import stage

# The two page-number forms and the first page each starts at.
PAGE_STYLES = {"path": ("/p", 1), "query": ("?p=", 0)}
DEFAULT_DEPTH = 2
GROUP = ["vendor", "type"]


def oldest_first() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("created_date", "property_id", "link")]


# --- seeds and paging ---------------------------------------------------------------------------


def expand_seeds(configs: DataFrame) -> DataFrame:
    """One row per configured start url, carrying its spider settings."""
    per_type = configs.select(
        "spider", "vendor", "max_depth", "start_index", F.explode("crawl_urls").alias("type", "urls")
    )
    return per_type.select(
        "spider", "vendor", "type", F.explode("urls").alias("crawl_url"), "max_depth", "start_index"
    )


def page_url(vendor: Column | str, crawl_url: Column | str, style: Column | str, index: Column | str) -> Column:
    style = as_column(style)
    mark = F.coalesce(*[F.when(style == name, F.lit(text)) for name, (text, _) in PAGE_STYLES.items()])
    return F.concat(as_column(vendor), as_column(crawl_url), mark, as_column(index).cast("string"))


def page_plan(seeds: DataFrame) -> DataFrame:
    """Every page a seed may visit. The first page is visited even when it lies past the depth."""
    style = F.col("style")
    first_page = F.coalesce(*[F.when(style == name, F.lit(start)) for name, (_, start) in PAGE_STYLES.items()])
    start = F.coalesce("start_index", first_page)
    depth = F.coalesce("max_depth", F.lit(DEFAULT_DEPTH))
    pages = seeds.withColumn("idx", F.explode(F.sequence(start, F.greatest(start, depth))))
    return pages.withColumn("url", page_url("vendor", "crawl_url", "style", "idx"))


def pages_until_empty(visits: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Visits up to and including a seed's first empty page.

    The first empty page is a grouped minimum joined back, not a window over the seed: a hot seed is
    combined on the map side, and the join can be broadcast or split where skewed.
    """
    empty = F.min(F.when(F.col("n_results") == 0, F.col("idx")))
    bounds = [empty.alias("stop"), F.min("idx").alias("start")]
    joined = visits.join(visits.groupBy("seed").agg(*bounds), "seed", "left")
    kept = F.col("stop").isNull() | (F.col("idx") <= F.col("stop"))
    if max_depth is not None:  # the page a seed starts from is always visited
        kept &= F.col("idx") <= F.greatest(F.lit(max_depth), F.col("start"))
    return joined.filter(kept).drop("stop", "start")


def next_page(visits: DataFrame, max_depth: int) -> DataFrame:
    """The page to fetch next, for seeds whose last page had hits and lies above the depth bound."""
    last = visits.groupBy("seed").agg(
        F.max("idx").alias("idx"), F.max_by("n_results", "idx").alias("n_results")
    )
    more = (F.col("n_results") > 0) & (F.col("idx") < max_depth)
    return last.filter(more).select("seed", (F.col("idx") + 1).alias("next_idx"))


# --- frontier and batches -----------------------------------------------------------------------


def uncrawled(index: DataFrame, vendor: str | None = None, type_: str | None = None) -> DataFrame:
    """Rows never crawled, optionally of one vendor and type. Equality filters reach the scan."""
    rows = index.filter(F.col("last_crawled_date").isNull())
    if vendor is not None:
        rows = rows.filter(F.col("vendor") == vendor)
    if type_ is not None:
        rows = rows.filter(F.col("type") == type_)
    return rows


def frontier(index: DataFrame, vendor: str, type_: str, k: int = 100) -> DataFrame:
    """The oldest ``k`` uncrawled rows of one vendor and type."""
    return uncrawled(index, vendor, type_).orderBy(*oldest_first()).limit(k)


def frontier_per_pair(index: DataFrame, k: int = 100) -> DataFrame:
    """The oldest ``k`` uncrawled rows of every (vendor, type), numbered in ``rn``."""
    return top_k_per_group(uncrawled(index), GROUP, oldest_first(), k, ["property_id", "link"])


def oldest_candidates(rows: DataFrame, k: int) -> DataFrame:
    """A superset of each pair's oldest ``k`` rows, cut at an hour: no older row is left out.

    Rows are counted per pair and hour, which combines on the map side; a pair's cut is the last hour
    before which it has fewer than ``k`` rows. So a claim of a few batches does not sort a whole frontier.
    """
    hour = F.date_trunc("hour", "created_date")
    counts = rows.groupBy(*GROUP, hour.alias("hour")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*GROUP).orderBy(F.col("hour").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).filter(F.col("before") < k)
    cuts = needed.groupBy(*[F.col(g).alias(f"_c_{g}") for g in GROUP]).agg(F.max("hour").alias("_cut"))
    cuts = broadcast_if_small(stage(cuts))
    same = reduce(lambda a, b: a & b, [rows[g].eqNullSafe(cuts[f"_c_{g}"]) for g in GROUP])
    kept = rows.join(cuts, same).filter(F.col("created_date").isNull() | (hour <= F.col("_cut")))
    return kept.select(*rows.columns)


def batch_rows(index: DataFrame, size: int = 100, batches: int | None = None) -> DataFrame:
    """Uncrawled rows with their batch number: consecutive runs of ``size`` per (vendor, type).

    ``batches`` bounds how many batches of a pair are numbered, as a fleet's free places do. Without
    it the whole frontier is numbered.
    """
    rows = uncrawled(index).select(*GROUP, "link", "property_id", "created_date")
    if batches is None:
        numbered = number_rows(rows, GROUP, oldest_first())
    elif size * batches <= limit_threshold(index):
        numbered = top_k_per_group(rows, GROUP, oldest_first(), size * batches, ["property_id", "link"])
    else:
        numbered = bounded_rows(oldest_candidates(rows, size * batches), size * batches)
    return in_batches(numbered, size)


def in_batches(numbered: DataFrame, size: int) -> DataFrame:
    return numbered.withColumn("batch", F.expr(f"(rn - 1) div {int(size)}"))


def bounded_rows(rows: DataFrame, k: int) -> DataFrame:
    """Each pair's oldest ``k`` rows, numbered, of rows cut down already to those and few more."""
    return number_rows(rows, GROUP, oldest_first()).filter(F.col("rn") <= k)


def batch_counts(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy(*GROUP, "batch").agg(F.count("*").alias("n"))


def crawl_batches(numbered: DataFrame, *carried: str) -> DataFrame:
    """One row per batch: its links comma-joined and its ids listed, both in frontier order.

    A batch holds at most ``size`` rows, so the lists are bounded. ``carried`` names columns that are
    the same for a whole batch.
    """
    rows = F.array_sort(F.collect_list(F.struct("rn", "link", "property_id")))
    packed = numbered.groupBy(*GROUP, "batch", *carried).agg(rows.alias("rows"), F.count("*").alias("n"))
    return packed.select(
        *GROUP,
        "batch",
        *carried,
        "n",
        F.array_join(F.transform("rows", lambda r: r["link"]), ",").alias("links"),
        F.transform("rows", lambda r: r["property_id"]).alias("property_ids"),
    )


def task_types(tasks: DataFrame) -> DataFrame:
    """Requested (vendor, type) pairs with their place in the task's list, and the task's own if it has a ``task_pos``."""
    place = ["task_pos"] if "task_pos" in tasks.columns else []
    return tasks.select("vendor", *place, F.posexplode("types").alias("type_pos", "type"))


def exhausted_types(tasks: DataFrame, index: DataFrame) -> DataFrame:
    """Requested pairs without a single uncrawled row."""
    live = uncrawled(index).select(*GROUP).distinct()
    return task_types(tasks).select(*GROUP).distinct().join(live, GROUP, "left_anti")


def fleet_capacity(hosts: DataFrame, max_parallel: int) -> int:
    """Free places of all hosts together."""
    free = F.greatest(F.lit(max_parallel) - F.col("running"), F.lit(0))
    return hosts.agg(F.coalesce(F.sum(free), F.lit(0))).first()[0]


def free_slots(hosts: DataFrame, max_parallel: int) -> DataFrame:
    """``hosts(host, running)`` -> one row per free place, numbered from 0 in host order."""
    free = hosts.select("host", F.greatest(F.lit(max_parallel) - F.col("running"), F.lit(0)).alias("free"))
    # one row per host of the fleet: a configured number, so one plain window is enough
    upto = F.sum("free").over(Window.orderBy("host").rowsBetween(Window.unboundedPreceding, 0))
    summed = free.filter("free > 0").withColumn("upto", upto)
    places = F.sequence(F.col("upto") - F.col("free"), F.col("upto") - 1)
    return summed.select("host", F.explode(places).alias("slot"))


def number_batches(batches: DataFrame, tasks: DataFrame) -> DataFrame:
    """Give batches of the requested pairs one running number ``slot``: tasks by ``task_pos`` (without it, vendors
    by name), types in list order. A pair that several tasks name counts once, at its first place.

    The window runs over one count per requested pair, which the task configuration bounds; the
    batches themselves are not gathered.
    """
    named = task_types(tasks)
    first = F.min(F.struct("task_pos" if "task_pos" in named.columns else "vendor", "type_pos")).alias("place")
    wanted = batches.join(named.groupBy(*GROUP).agg(first), GROUP)
    per_pair = wanted.groupBy(*GROUP, "place").agg((F.max("batch") + 1).alias("n_batches"))
    before = Window.orderBy("place", *GROUP).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_pair.select(*GROUP, F.coalesce(F.sum("n_batches").over(before), F.lit(0)).alias("offset"))
    return wanted.join(offsets, GROUP).withColumn("slot", F.col("batch") + F.col("offset")).drop("offset", "place")


def assign_batches(batches: DataFrame, slots: DataFrame) -> DataFrame:
    """Batches to hosts in slot order: an equi-join on the slot number instead of a range join."""
    return batches.join(slots, "slot")


def split_links(batches: DataFrame, secure_vendors: list[str] | None = None) -> DataFrame:
    """One row per url of a batch's comma list; vendors in ``secure_vendors`` get https links."""
    urls = batches.withColumn("url", F.explode(F.split("links", ","))).drop("links")
    if not secure_vendors:
        return urls
    secure = F.col("vendor").isin(secure_vendors)
    return urls.withColumn("url", F.when(secure, upgrade_scheme("url")).otherwise(F.col("url")))


def placed_rows(numbered: DataFrame, tasks: DataFrame, hosts: DataFrame, max_parallel: int) -> DataFrame:
    """Rows of the batches that get a free place, with their host and slot; ``numbered`` is read twice, so pinned before."""
    placed = assign_batches(number_batches(batch_counts(numbered), tasks), free_slots(hosts, max_parallel))
    # no more rows than the fleet has free places
    placed = broadcast_if_small(stage(placed.select(*GROUP, "batch", "host", "slot")))
    return numbered.join(placed, [*GROUP, "batch"])


def claim_cycle(
    index: DataFrame, tasks: DataFrame, hosts: DataFrame, max_parallel: int, run_ts: Column, size: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Hand out batches to hosts with free places, and mark what was handed out as crawled.

    Returns (assigned batches, updated index). Both come from one staged set of claimed rows, so what
    is dispatched and what is marked are the same rows.
    """
    numbered = stage(batch_rows(index, size, fleet_capacity(hosts, max_parallel)))
    rows = stage(placed_rows(numbered, tasks, hosts, max_parallel))
    assigned = crawl_batches(rows, "host", "slot")
    return assigned, mark_crawled(index, rows, run_ts, check_size=True)
