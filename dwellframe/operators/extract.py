"""Pages -> records, by applying the site rules.

Rules turn into column expressions over a page's node arrays, chosen per row by its ``site``. The
whole extraction is one narrow stage: scan, parse, project. Nothing is shuffled or pivoted.

Pages come as rows (page_id, url, html, site, vendor, type, crawled_date), search pages also with
the ``crawl_url`` they came from. Without a ``crawled_date`` the time of the run stands in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellframe.functions import scalars as S
from dwellframe.functions import select as sel
from dwellframe.functions.select import El
from dwellframe.plans.site_rules import (
    SITES, AfterLabel, Attr, LabelledItem, RunValue, SiteRules, Source, Take, Texts,
)
from dwellframe.schemas import LISTING, PROPERTY_INDEX
from dwellframe.sources.hit_texts import HitRules, Steps, Wanted, with_hits
from dwellframe.sources.html_nodes import Names, with_nodes

COUNT_FIELDS = ["num_floors", "num_bedrooms", "num_bathrooms", "frontage", "distance_to_road"]


def of_run(pages: DataFrame, **constants: str) -> DataFrame:
    """Pages of one crawl run, with the run's constants (site, vendor, type, crawl_url) as columns."""
    return pages.withColumns({name: F.lit(value) for name, value in constants.items()})


def _dated(pages: DataFrame) -> DataFrame:
    if "crawled_date" in pages.columns:
        return pages
    return pages.withColumn("crawled_date", F.current_timestamp())


def _start(source: Source) -> El | AfterLabel | None:
    """What a selection starts from: the parser marks it, so that no field searches the page."""
    match source:
        case Texts(path) | Attr(path, _):
            return path[0]
        case LabelledItem(_, list_class):
            return El("ul", class_attr=list_class)
        case AfterLabel():
            return source
    return None


def _paths(rules: SiteRules, part: str) -> list[tuple[El, ...]]:
    """The steps that the selections of ``part`` go through, on search pages the blocks' first."""
    paths = [rules.blocks] if part != "page_fields" else []
    for source, _ in () if part == "blocks" else getattr(rules, part).values():
        match source:
            case Texts(path) | Attr(path, _):
                paths.append(path)
            case LabelledItem(_, list_class):
                paths.append((El("ul", class_attr=list_class), El("li", child=True)))
            case AfterLabel(_, label_tag, value_tag) if part == "hit_fields":
                paths.append((El(label_tag), El(value_tag)))
    return paths


def _starts(rules: SiteRules, part: str) -> list[El | AfterLabel]:
    """What the parser marks the places of: where a site's page fields start, or its search hits."""
    starts = [_start(source) for source, _ in rules.page_fields.values()] if part == "page_fields" else [rules.blocks[0]]
    return list(dict.fromkeys(s for s in starts if s is not None))


def _marks(rules: SiteRules, part: str) -> dict[El | AfterLabel, int]:
    """Numbers of all that a site's selections name: the marks first, then what elements only tell in their ``fits``."""
    named = [*_starts(rules, part), *(step for path in _paths(rules, part) for step in path)]
    return {e: n for n, e in enumerate(dict.fromkeys(named))}


#: What selections read of an element that tells what it fulfils; those after a label read more.
READ = ("seq", "parent_seq", "attrs", "place", "size", "text_place", "n_texts", "own")


def page_names(sites: Mapping[str, SiteRules], part: str) -> dict[str, Names]:
    """What the parser is to keep of each site's pages for the fields of ``part``, or for the ``blocks`` alone: what some rule names."""
    made = {}
    for name, rules in sites.items():
        marks = _marks(rules, part)
        sources = [source for source, _ in ({} if part == "blocks" else getattr(rules, part)).values()]
        elements = [(e.tag, tuple(e.cls.split()), e.id, e.class_attr, e.class_prefix, n) for e, n in marks.items() if isinstance(e, El)]
        labels = [(e.label_tag, e.label, e.value_tag, n) for e, n in marks.items() if isinstance(e, AfterLabel)]
        told = part == "hit_fields" and any(isinstance(s, AfterLabel) for s in sources)
        read = READ + (("tag", "own_text") if told else ())
        made[name] = Names(elements, labels, len(_starts(rules, part)), frozenset(s.name for s in sources if isinstance(s, Attr)), read)
    return made


def _values(source: Source, marks: Mapping | None = None, hit: bool = False) -> str:
    """The texts a rule finds on a page with ``marks``, or else in one hit; ``hit`` says that a hit has their numbers."""
    part = replace(sel.HIT if hit or marks is None else sel.PAGE, fits=marks)
    first = None if hit or marks is None or (start := _start(source)) is None else sel.marked(marks[start])
    match source:
        case Texts(path):
            return sel.own_texts(sel.elements_at(*path, part=part, first=first), part)
        case Attr(path, name):
            return sel.attr_values(sel.elements_at(*path, part=part, first=first), name)
        case AfterLabel(label, label_tag, value_tag):
            return sel.all_texts(first) if first else sel.texts_after_label(label_tag, label, value_tag, part)
        case LabelledItem(label, list_class):
            return sel.texts_of_labelled_items(list_class, label, part, first)
        case RunValue(column):
            return f"array({column})"
    raise TypeError(f"no such rule source: {source!r}")


def _taken(values: str, take: Take) -> str:
    if take.as_list:
        return sel.list_or_null(values)
    if take.at is not None:
        return sel.pick(values, take.at, take.more_than, take.exactly)
    part = f"slice(v, 1, {take.first})" if take.first else "v"
    if take.trim_whole:
        text = sel.stripped(f"array_join({part}, {sel.quoted(take.sep)})")
    else:
        text = sel.join_texts(part, take.sep)
    empty = "null" if take.when_empty is None else sel.quoted(take.when_empty)
    filled = f"concat({sel.quoted(take.prefix)}, {text})"
    return sel.bind(values, "v", f"if(size(v) > {take.more_than}, {filled}, {empty})")


def _per_site(sites: Mapping[str, SiteRules], build: Callable[[SiteRules], str | None]) -> str:
    """The expression of a row's own site; null for sites without one."""
    built = {name: build(rules) for name, rules in sites.items()}
    cases = " ".join(f"when {sel.quoted(name)} then {expr}" for name, expr in built.items() if expr is not None)
    return f"case site {cases} end" if cases else "null"


def _fields(sites: Mapping[str, SiteRules], part: str) -> dict[str, Column]:
    """One column per field any site has a rule for."""

    marks = {id(r): _marks(r, part) for r in sites.values()}

    def built(name: str) -> Column:
        def of_site(r: SiteRules) -> str | None:
            rule = getattr(r, part).get(name)
            return _taken(_values(rule[0], marks[id(r)], part == "hit_fields"), rule[1]) if rule else None

        return F.expr(_per_site(sites, of_site))

    return {n: built(n) for n in dict.fromkeys(n for r in sites.values() for n in getattr(r, part))}


def _faults(sites: Mapping[str, SiteRules]) -> Column:
    """Reasons a page's record is unusable, from its fields."""

    def build(rules: SiteRules) -> str | None:
        found = [f"if({when}, {sel.quoted(f'missing {part}')}, null)" for part, when in rules.page_faults.items()]
        return f"array_compact(array({', '.join(found)}))" if found else None

    return F.expr(f"coalesce({_per_site(sites, build)}, cast(array() as array<string>))")


# --- search pages -------------------------------------------------------------------------------


def search_nodes(pages: DataFrame, sites: Mapping[str, SiteRules] = SITES, part: str = "hit_fields") -> DataFrame:
    """Search pages parsed to what their sites' rules name, for the fields of the hits or for the ``blocks`` alone."""
    return with_nodes(pages, page_names(sites, part))


def page_blocks(parsed: DataFrame, sites: Mapping[str, SiteRules] = SITES) -> DataFrame:
    """Add ``blocks``, the hit elements of each search page, and ``n_hits``."""
    marked = "marks" in parsed.columns

    def of_site(rules: SiteRules) -> str:
        marks = _marks(rules, "blocks")  # the blocks' steps come first on all search pages
        return sel.elements_at(*rules.blocks, part=replace(sel.PAGE, fits=marks), first=sel.marked(marks[rules.blocks[0]]))

    blocks = _per_site(sites, of_site if marked else lambda r: sel.elements_at(*r.blocks))
    return parsed.withColumn("blocks", F.expr(blocks)).withColumn("n_hits", F.size("blocks"))


def _texts_column(sites: Mapping[str, SiteRules], name: str) -> str:
    """Where the texts read for a field of hits lie, from which the field itself is taken only if it is asked for."""
    names = dict.fromkeys(n for r in sites.values() for n in r.hit_fields)
    return f"_texts_{list(names).index(name)}"


def hit_rules(sites: Mapping[str, SiteRules]) -> dict[str, HitRules]:
    """The blocks and hit fields of each site, in the numbers under which the parser tells what elements fulfil."""
    asked, made = page_names(sites, "hit_fields"), {}
    for name, rules in sites.items():
        marks = _marks(rules, "hit_fields")

        def steps(path: tuple[El, ...], marks: Mapping = marks) -> Steps:
            return tuple((marks[e], e.child) for e in path)

        def wanted(source: Source, marks: Mapping = marks) -> Wanted | None:
            match source:
                case Texts(path):
                    return Wanted(steps(path))
                case Attr(path, attr):
                    return Wanted(steps(path), attr=attr)
                case AfterLabel(label, label_tag, value_tag):
                    return Wanted(steps((El(label_tag),)), label=label, value=marks[El(value_tag)])
                case LabelledItem(label, list_class):
                    return Wanted(steps((El("ul", class_attr=list_class), El("li", child=True))), label=label)
            return None

        fields = {_texts_column(sites, n): w for n, (source, _) in rules.hit_fields.items() if (w := wanted(source)) is not None}
        made[name] = HitRules(asked[name], len(marks), steps(rules.blocks), fields)
    return made


def hit_rows(parsed: DataFrame, sites: Mapping[str, SiteRules] = SITES, keep_empty: bool = False) -> DataFrame:
    """One row per hit, carrying only the nodes of its own block: ``elements`` and ``texts``, slices of the page's.

    ``elements_before`` and ``texts_before`` say how many of the page's come before them. ``keep_empty`` gives a page
    without hits one row with a null ``hit_no``.
    """
    cut = F.expr(
        "transform(blocks, b -> struct(slice(elements, b.place, b.size + 1) as elements, slice(texts, b.text_place, b.n_texts) as texts,"
        " b.place - 1 as elements_before, b.text_place - 1 as texts_before))"
    )
    blocks = page_blocks(parsed, sites)
    kept = [c for c in parsed.columns if c not in ("elements", "texts", "marks")]
    exploded = blocks.select(*kept, (F.posexplode_outer if keep_empty else F.posexplode)(cut).alias("hit_no", "hit"))
    return exploded.select(*kept, "hit_no", "hit.*")


def _field_of_hits(sites: Mapping[str, SiteRules], name: str) -> Column:
    """A field of hits from the texts that were read for it."""
    def of_site(rules: SiteRules) -> str | None:
        source, take = rules.hit_fields.get(name, (None, None))
        return source and _taken(_values(source) if isinstance(source, RunValue) else _texts_column(sites, name), take)

    return F.expr(_per_site(sites, of_site))


def extract_hits(
    pages: DataFrame, sites: Mapping[str, SiteRules] = SITES, keep_empty: bool = False
) -> DataFrame:
    """Search pages -> property index rows, with ``page_id``, ``hit_no`` and ``_errors``.

    With ``keep_empty`` a page without hits also gives a row, set aside as having none, so that
    :func:`hits_per_page` can count all pages from one staged result.
    """
    passed = ["page_id", "site", "vendor", "type", "crawl_url", "crawled_date"]
    rules = hit_rules(sites)
    found = list(dict.fromkeys(n for r in rules.values() for n in r.fields))
    hits = with_hits(_dated(pages).select(*passed, "html"), rules, found, keep_empty)

    raw = hits.select(
        "hit_no", *passed,
        *[_field_of_hits(sites, n).alias(n) for n in dict.fromkeys(n for r in sites.values() for n in r.hit_fields)],
    )
    linked = raw.withColumn("link", S.absolute_link("vendor", "href"))

    def parsed(value: Column) -> Column:
        unread = [
            (F.col("site") == name) & ~F.col("type").isin(list(rules.parsed_types))
            for name, rules in sites.items() if rules.parsed_types
        ]
        return F.when(~reduce(lambda a, b: a | b, unread, F.lit(False)), value)

    computed = {
        "property_id": S.extract_property_id("link"),
        "listing_type": S.extract_listing_type("crawl_url"),
        "created_date": F.col("crawled_date"),
        "last_indexed_date": F.col("crawled_date"),
        "last_crawled_date": F.lit(None),
        **{f"property_{q}": parsed(S.extract_number(f"property_{q}_raw")) for q in ("price", "size")},
        **{f"property_{q}_unit": parsed(S.extract_unit(f"property_{q}_raw")) for q in ("price", "size")},
    }
    columns = [
        (computed[f.name] if f.name in computed else _or_null(linked, f.name)).cast(f.dataType).alias(f.name)
        for f in PROPERTY_INDEX
    ]
    lost = (
        F.when(F.col("hit_no").isNull(), F.array(F.lit("no hits")))
        .when(F.col("link").isNull(), F.array(F.lit("missing link")))
        .otherwise(F.array().cast("array<string>"))
    )
    return linked.select("page_id", "hit_no", *columns, lost.alias("_errors"))


def hits_per_page(records: DataFrame) -> DataFrame:
    """Hits of each page, linkless ones included, from records extracted with ``keep_empty``."""
    return records.groupBy("page_id").agg(F.count("hit_no").alias("n_results"))


# --- detail pages -------------------------------------------------------------------------------


def extract_listings(
    pages: DataFrame, sites: Mapping[str, SiteRules] = SITES, keep_raw: bool = False
) -> DataFrame:
    """Detail pages -> listings, with ``page_id`` and ``_errors``.

    ``keep_raw`` also returns the texts the count columns were read from, as ``<field>_raw``.
    """
    raw = with_nodes(_dated(pages), page_names(sites, "page_fields")).select(
        "page_id", "site", "vendor", "type", F.col("url").alias("link"), "crawled_date",
        *[c.alias(n) for n, c in _fields(sites, "page_fields").items()],
    )
    # read once, used several times below
    read = raw.withColumns({
        "property_id": S.extract_property_id("link"),
        "price": S.extract_number("price_raw"),
        "property_size": S.extract_number("property_size_raw"),
        "_errors": _faults(sites),
    })
    computed = {
        "key": S.listing_key("vendor", "property_id", "type"),
        "price_unit": S.extract_unit("price_raw"),
        "property_size_unit": S.extract_unit("property_size_raw"),
        "price_per_sqm": S.price_per_sqm("price", "property_size"),
        "address": _blank_on(F.col("address"), "mbnd", "tbds"),
        "contact_address": _blank_on(F.col("contact_address"), "mbnd"),
        "contact_link": S.contact_link("vendor", "contact_href") if "contact_href" in raw.columns else F.lit(None),
        **{f: S.extract_number(f"{f}_raw") for f in COUNT_FIELDS},
    }
    columns = [
        (computed[f.name] if f.name in computed else _or_null(read, f.name)).cast(f.dataType).alias(f.name) for f in LISTING
    ]
    extra = [f"{f}_raw" for f in COUNT_FIELDS] if keep_raw else []
    return read.select("page_id", *columns, *extra, "_errors")


def _or_null(df: DataFrame, name: str) -> Column:
    """A field that none of the given sites has is null."""
    return F.col(name) if name in df.columns else F.lit(None)


def _blank_on(value: Column, *sites: str) -> Column:
    """Blank text counts as absent on these sites."""
    return F.when(F.col("site").isin(*sites), S.blank_to_null(value)).otherwise(value)


def quarantine(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split extracted records into (usable, set aside with reasons).

    Both halves are lazy: to write both, stage the records first, or the pages are parsed twice.
    """
    # a generator of the reasons alone keeps the filters from being pushed below the extraction, which would then run twice,
    # while columns that nobody reads are still not extracted
    told = records.select(*[c for c in records.columns if c != "_errors"], F.inline(F.array(F.struct("_errors"))))
    records = told.select(*records.columns)
    good = F.size("_errors") == 0
    return records.filter(good).drop("_errors"), records.filter(~good)
