"""Search pages -> one row per hit with the texts that its fields select.

A page's hits and what the site's rules select in them are found while its nodes are still Python lists, so that only
these texts cross over to the JVM, neither the page's nodes nor a search of them there. Selections mean the same
as those of ``functions.select`` over the arrays of ``html_nodes``, and markup is read by the same rules.
"""

from __future__ import annotations

import gc
import sys
from bisect import bisect, bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dwellframe.sources.html_nodes import CELLS, MARKUP, NO_ENDS, Names, Piece, pieces_of, read_piece

# Ship this module's code with the task, so executors need no copy of the package for it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HIT_NO = "hit_no"
TEXTS = pa.list_(pa.string())
PAGES_PER_BATCH = 4096

#: Steps of a path: the number of what an element must fulfil, and whether directly below the step before.
Steps = tuple[tuple[int, bool], ...]


@dataclass(frozen=True)
class Wanted:
    """One field of a hit: direct texts of the elements at ``path``, or else

    the values of their attribute ``attr``; the texts of the elements ``value`` that follow those at ``path`` whose first own text holds
    ``label``; without ``value``, all texts of the elements at ``path`` in which some text holds ``label``.
    """

    path: Steps
    attr: str | None = None
    label: str | None = None
    value: int | None = None


@dataclass(frozen=True)
class HitRules:
    """What to read of one site's search pages: the ``names`` that number what elements fulfil, the blocks' path, fields by name."""

    names: Names
    n_fits: int
    blocks: Steps
    fields: dict[str, Wanted]


class Known(dict):
    """Pieces of markup as read for some names."""

    def __init__(self, names: Names) -> None:
        super().__init__()
        self.names = names

    def __missing__(self, markup: str) -> Piece | None:
        return read_piece(markup, self.names, self)


#: A kept element: the piece of markup that says what it is, the place of the last element inside it, the element directly around it (None: not
#: kept), where the texts inside it start and end, the places of its own texts. Places count from 0.
PIECE, LAST, AROUND, START, END, OWN = range(6)


class Nodes:
    """The kept nodes of one page in document order: elements, texts, and ``where``, the places of the elements that fulfil each number."""

    __slots__ = ("elements", "texts", "where")

    def __init__(self, n_fits: int) -> None:
        self.elements: list[list] = []
        self.texts: list[str] = []
        self.where: list[list[int]] = [[] for _ in range(n_fits)]


def read_nodes(html: str, known: Known, n_fits: int) -> Nodes:
    """Read a page as ``html_nodes.parse_into`` does for names without labels."""
    nodes = Nodes(n_fits)
    elements, texts, where = nodes.elements, nodes.texts, nodes.where
    open_tags: list[str] = []
    open_elements: list[list | None] = [None]  # that of the page itself first; None: not kept
    depths: dict[str, list[int]] = {}
    kept = 0  # kept elements around here
    n_elements = n_texts = 0

    def close_to(depth: int) -> int:
        """How many of the closed ones were kept."""
        closed = 0
        while len(open_tags) > depth:
            depths[open_tags.pop()].pop()
            if (element := open_elements.pop()) is not None:
                element[LAST] = n_elements - 1
                element[END] = n_texts
                closed += 1
        return closed

    def innermost(tags) -> int:
        return max([d[-1] for t in tags if (d := depths.get(t))], default=-1)

    parts = MARKUP.split(html)
    parts.append("")
    parts = iter(parts)
    for text, markup in zip(parts, parts):
        if text and kept:
            if (element := open_elements[-1]) is not None:
                element[OWN].append(n_texts)
            texts.append(unescape(text) if "&" in text else text)
            n_texts += 1
        if not markup:
            break
        piece = known[markup]
        if piece is None:
            continue
        tag = piece.tag
        if piece.closes:
            if open_tags and open_tags[-1] == tag:
                open_tags.pop()
                depths[tag].pop()
                if (element := open_elements.pop()) is not None:
                    element[LAST] = n_elements - 1
                    element[END] = n_texts
                    kept -= 1
            elif at := depths.get(tag):
                depth = at[-1]
                if piece.closes == 2 or innermost(CELLS) <= depth:
                    kept -= close_to(depth)
            continue
        if piece.ends is not NO_ENDS:
            ended, bounds = piece.ends
            for t in ended:
                if depths.get(t):
                    bound = innermost(bounds)
                    cut = min([d[i] for t in ended if (d := depths.get(t)) and (i := bisect(d, bound)) < len(d)], default=-1)
                    if cut >= 0:
                        kept -= close_to(cut)
                    break
        element = None
        if piece.found:
            for n in piece.fits:
                where[n].append(n_elements)
            element = [piece, n_elements, open_elements[-1], n_texts, n_texts, []]
            elements.append(element)
            n_elements += 1
        if piece.raw_text is not None:
            if piece.raw_text and (kept or element is not None):
                if element is not None:
                    element[OWN].append(n_texts)
                    element[END] += 1
                texts.append(piece.raw_text)
                n_texts += 1
        elif not piece.void:
            if (at := depths.get(tag)) is None:
                at = depths[tag] = []
            at.append(len(open_tags))
            open_tags.append(tag)
            open_elements.append(element)
            if element is not None:
                kept += 1
    close_to(0)
    return nodes


def elements_at(nodes: Nodes, path: Steps, low: int, high: int) -> list[int]:
    """Elements from ``low`` to ``high`` that match the last step and lie inside matches of the steps before, in page order."""
    at, elements = nodes.where[path[0][0]], nodes.elements
    found = at[bisect_left(at, low):bisect(at, high)] if at else at
    for number, child in path[1:]:
        if not found:
            break
        at = nodes.where[number]
        if child:
            inner = [r for o in found for r in at[bisect(at, o):bisect(at, elements[o][LAST])] if elements[r][AROUND] is elements[o]]
            found = sorted(inner) if len(found) > 1 else inner
        else:
            inner, done = [], -1
            for o in found:
                if (last := elements[o][LAST]) > done:  # what lies inside an element before is in already
                    inner += at[bisect(at, o):bisect(at, last)]
                    done = last
            found = inner
    return found


def all_texts(nodes: Nodes, found: list[list]) -> list[str]:
    """Every text inside the found elements, once each, in page order."""
    places = {i for e in found for i in range(e[START], e[END])}
    return [nodes.texts[i] for i in sorted(places)]


def values_of(nodes: Nodes, wanted: Wanted, low: int, high: int) -> list[str]:
    """What a field selects in the hit whose elements are those from ``low`` to ``high``."""
    elements, texts = nodes.elements, nodes.texts
    found = [elements[i] for i in elements_at(nodes, wanted.path, low, high)]
    if not found:
        return []
    if wanted.attr is not None:
        return [v for e in found if (v := e[PIECE].attrs.get(wanted.attr)) is not None]
    if wanted.label is None:
        own = found[0][OWN] if len(found) == 1 else sorted([i for e in found for i in e[OWN]])
        return [texts[i] for i in own]
    if wanted.value is None:
        return all_texts(nodes, [e for e in found if any(wanted.label in texts[i] for i in range(e[START], e[END]))])
    at = nodes.where[wanted.value]
    told = [bisect(at, e[LAST]) for e in found if e[OWN] and wanted.label in texts[e[OWN][0]]]
    return all_texts(nodes, [elements[at[i]] for i in told if i < len(at) and at[i] <= high])


def _blocks(nodes: Nodes, path: Steps) -> list[int]:
    """The hits of a page. One whose class attribute repeats the class asked for comes as often, as it does under the parser's marks."""
    found = elements_at(nodes, path, 0, len(nodes.elements))
    if len(path) > 1:
        return found
    number = path[0][0]
    return [b for b in found for _ in range(nodes.elements[b][PIECE].found.count(number))]


def _rows(html: list[str | None], sites: list[str], rules: dict[str, HitRules], known: dict[str, Known], fields: list[str], keep_empty: bool):
    """Of each row that some pages give: which page, the hit's number, and by field its texts."""
    page_of: list[int] = []
    numbers: list[int | None] = []
    values: list[list[list[str] | None]] = [[] for _ in fields]
    wanted = {site: [(column, r.fields.get(f)) for column, f in zip(values, fields, strict=True)] for site, r in rules.items()}
    for page, (text, site) in enumerate(zip(html, sites, strict=True)):
        hits = 0
        if text and site in rules:
            nodes = read_nodes(text, known[site], rules[site].n_fits)
            for block in _blocks(nodes, rules[site].blocks):
                page_of.append(page)
                numbers.append(hits)
                hits += 1
                last = nodes.elements[block][LAST]
                for column, field in wanted[site]:
                    column.append(values_of(nodes, field, block, last) if field else None)
        if keep_empty and not hits:
            page_of.append(page)
            numbers.append(None)
            for column in values:
                column.append(None)
    return page_of, numbers, values


def _read_batches(rules: dict[str, HitRules], fields: list[str], keep_empty: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {site: Known(r.names) for site, r in rules.items()}
        for whole in batches:
            html, site = (whole.schema.get_field_index(c) for c in ("html", "site"))
            passed = [i for i in range(whole.num_columns) if i != html]
            names = [whole.schema.field(i).name for i in passed] + [HIT_NO, *fields]
            for at, n in pieces_of(whole.column(html), PAGES_PER_BATCH):
                batch, collects = whole.slice(at, n), gc.isenabled()
                gc.disable()  # nodes hold no cycles, and looking for some takes a tenth of the time
                try:
                    page_of, numbers, values = _rows(batch.column(html).to_pylist(), batch.column(site).to_pylist(), rules, known, fields, keep_empty)
                finally:
                    if collects:
                        gc.enable()
                rows = pa.array(page_of, pa.int32())
                made = [batch.column(i).take(rows) for i in passed] + [pa.array(numbers, pa.int32()), *[pa.array(v, TEXTS) for v in values]]
                yield pa.RecordBatch.from_arrays(made, names=names)

    return run


def with_hits(pages: DataFrame, rules: dict[str, HitRules], fields: list[str], keep_empty: bool = False) -> DataFrame:
    """One row per hit of the pages: their columns without ``html``, ``hit_no`` from 0, and the texts of each field. No shuffle.

    A field that a page's site has no rule for is null. ``keep_empty`` gives a page without hits one row with a null ``hit_no``.
    """
    kept = [f for f in pages.schema if f.name != "html"]
    made = [T.StructField(HIT_NO, T.IntegerType()), *[T.StructField(f, T.ArrayType(T.StringType())) for f in fields]]
    return pages.mapInArrow(_read_batches(rules, fields, keep_empty), T.StructType(kept + made))
