"""Page text -> node arrays.

The only Python in page extraction. Each page stays one row: its nodes come back as two arrays on
that row, so every later selection is a narrow JVM expression and no page is ever shuffled.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.schemas import ELEMENT, TEXT_NODE

# Ship this module's code with the task, so executors need no copy of the package for it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the HTML language.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote center details dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
CELLS = frozenset(["table", "td", "th", "caption", "button", "object"])
# start tag -> (open elements it ends, elements the search for them does not leave)
ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    **{tag: (frozenset(["p"]), CELLS) for tag in BLOCKS},
    "li": (frozenset(["li", "p"]), frozenset(["ul", "ol", "table"])),
    "dt": (frozenset(["dt", "dd", "p"]), frozenset(["dl", "table"])),
    "dd": (frozenset(["dt", "dd", "p"]), frozenset(["dl", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    **{tag: (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"]))
       for tag in ("tbody", "thead", "tfoot")},
    "body": (frozenset(["head"]), frozenset()),
}
# One split of a page by this pattern yields its texts and, between them, its markup. A quote that never closes is no quote.
_REST = r"""[^<>"']*+(?:(?:"[^"]*"|'[^']*')[^<>"']*+)*+"""
_RAW = "|".join(rf"{tag}(?=[\s/>]){_REST}>.*?(?:</{tag}\s*>|\Z)" for tag in ("script", "style"))
# the usual tags come first, spelled so that they are found without trying the rest
_PLAIN = r"""/[a-zA-Z]+>|(?:[a-rt-zA-RT-Z]|[sS](?![cCtT]))[^\s/<>]*+[^<>"']*+(?:"[^"]*"[^<>"']*+)*+>"""
MARKUP = re.compile(rf"(<(?:{_PLAIN}|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(?i:{_RAW})|/?[a-zA-Z\u0130\u0131\u017f\u212a][^\s/<>]*+(?:{_REST}(?=>)|[^<>]*)>))", re.S)
# What one piece of markup says: (raw tag, its attributes, its raw text, slash, name, attributes). Comments and declarations leave all empty.
PIECE = re.compile(
    r"<[!?].*"
    rf"|<(script|style)(?=[\s/>])({_REST})>(.*?)(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-z][^\s/<>]*+)({_REST}(?=>)|[^<>]*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
# A start tag as most are spelled, and its attributes; other spellings are read by the patterns above.
SIMPLE = re.compile(r"""<(?!script\b|style\b)([a-z][a-z0-9]*+)((?:\s++[a-z-]++="[^"]*+")++)\s*+>""")
VALUES = re.compile(r"""([a-z-]++)="([^"]*+)\"""")
NO_ENDS: tuple[frozenset[str], frozenset[str]] = (frozenset(), frozenset())


CACHED, SHORT = 4096, 80


def _attributes(text: str) -> dict[str, str]:
    """Attributes by name."""
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


class Piece:
    """One piece of markup as read: an end tag, or a start tag with its attributes and what asked for it. Nobody changes it."""

    __slots__ = ("tag", "ends", "closes", "void", "raw_text", "id", "css", "classes", "attrs", "found", "fits")

    def __init__(self, raw_tag: str | None, raw_rest: str, raw_text: str | None, slash: str, name: str, rest: str, names: Names | None) -> None:
        self.tag = tag = sys.intern((name or raw_tag).lower())
        self.closes = (2 if tag in BLOCKS or tag in CELLS else 1) if slash else 0  # 2: whatever cells are open in it
        if slash:
            return
        self.ends = NO_ENDS if raw_tag else ENDS.get(tag, NO_ENDS)
        self.void, self.raw_text = tag in VOID, raw_text if raw_tag else None
        attrs = _attributes(rest if name else raw_rest) if (rest if name else raw_rest) else {}
        self.id, self.css = attrs.get("id"), attrs.get("class")
        self.classes = self.css.split() if self.css else ()
        self.found = names.match(tag, self.id, self.css) if names else ()
        self.fits = sorted({n for n in self.found if n is not None})
        self.attrs = attrs if names is None or names.attrs is None else {k: v for k, v in attrs.items() if k in names.attrs}


    def with_attrs(self, attrs: dict[str, str]) -> Piece:
        """The same start tag with other attributes, ``id`` and ``class`` aside."""
        piece = Piece.__new__(Piece)
        piece.tag, piece.ends, piece.closes, piece.void, piece.raw_text = self.tag, self.ends, self.closes, self.void, self.raw_text
        piece.id, piece.css, piece.classes, piece.found, piece.fits = self.id, self.css, self.classes, self.found, self.fits
        piece.attrs = attrs
        return piece


def _simple_piece(tag: str, rest: str, text: str, names: Names) -> Piece:
    """A start tag in its usual spelling: all but its other attributes is the same for one tag, id and class, and read once."""
    attrs: dict[str, str] = {}
    for name, value in VALUES.findall(rest):
        if name not in attrs:
            attrs[name] = unescape(value) if "&" in value else value
    key = tag, attrs.get("id"), attrs.get("class")
    kind = names.kinds.get(key)
    if kind is None:
        if len(names.kinds) >= CACHED:
            names.kinds.clear()
        kind = names.kinds[key] = Piece(*PIECE.match(text).groups(), names).with_attrs({})
    if names.attrs is not None:
        attrs = {k: v for k, v in attrs.items() if k in names.attrs}
    return kind.with_attrs(attrs) if attrs else kind


def read_piece(text: str, names: Names | None, known: dict[str, Piece | None]) -> Piece | None:
    """What a piece of markup says, None for comments and the like. Short pieces recur, so their readings are kept a while."""
    if names is not None and (simple := SIMPLE.fullmatch(text)):
        piece = _simple_piece(simple[1], simple[2], text, names)
    else:
        groups = PIECE.match(text).groups()
        piece = Piece(*groups, names) if groups[0] or groups[4] else None
    if len(text) <= SHORT:
        if len(known) >= CACHED:
            known.clear()
        known[text] = piece
    return piece


_known: dict[str, Piece | None] = {}
UNKNOWN = object()


class Names:
    """What to keep of a page, and what to mark in it.

    ``elements`` are (tag, classes, id, class attribute, class prefix, mark): an element that fulfils all that is
    not None is kept and its place noted under the mark, if there is one. ``labels`` are (label tag, label, value tag, mark): the
    next value tag after the end of a label tag whose first own text holds the label is kept and marked likewise.
    Texts are kept inside kept elements. Numbers of ``n_marks`` and more only show in the ``fits`` of the elements.
    Of the attributes all are kept, or those named in ``attrs``; of an element's ``fields`` all, or those named.
    """

    def __init__(
        self, elements: list[tuple], labels: list[tuple], n_marks: int, attrs: frozenset[str] | None = None, fields: tuple[str, ...] | None = None
    ) -> None:
        self.n_marks, self.attrs, self.fields = n_marks, attrs, fields
        self.known: dict[str, Piece | None] = {}
        self.by: dict[tuple[str, str], list[tuple]] = {}  # filed under the rarest thing asked for
        self.prefixes: list[tuple] = []
        for asked in elements:
            tag, classes, id_, css, prefix, _ = asked
            if prefix is not None:
                self.prefixes.append(asked)
            else:
                key = ("id", id_) if id_ is not None else ("css", css) if css is not None else ("class", classes[0]) if classes else ("tag", tag)
                self.by.setdefault(key, []).append(asked)
        self.labels: dict[str, list[tuple]] = {}
        for tag, label, value_tag, mark in labels:
            self.labels.setdefault(tag, []).append((label, value_tag, mark))
        self.matched: dict[tuple, list[int | None]] = {}
        self.kinds: dict[tuple, Piece] = {}

    def match(self, tag: str, id_: str | None, css: str | None) -> list[int | None]:
        """Marks of an element, with None for each thing it fulfils that has no mark. Elements recur, so answers are kept a while."""
        key = tag, id_, css
        if (found := self.matched.get(key)) is None:
            if len(self.matched) >= CACHED:
                self.matched.clear()
            found = self.matched[key] = self._match(tag, id_, css, css.split() if css else [])
        return found

    def _match(self, tag: str, id_: str | None, css: str | None, classes: list[str]) -> list[int | None]:
        by = self.by
        asked = by.get(("tag", tag), ())
        if css is not None:
            asked = [*asked, *by.get(("css", css), ()), *self.prefixes]
            for name in classes:
                asked += by.get(("class", name), ())
        if id_ is not None:
            asked = [*asked, *by.get(("id", id_), ())]
        return [
            mark
            for want_tag, want_classes, want_id, want_css, prefix, mark in asked
            if (want_tag is None or want_tag == tag) and (want_id is None or want_id == id_) and (want_css is None or want_css == css)
            and (prefix is None or css.startswith(prefix)) and all(c in classes for c in want_classes)
        ]


NOT_ASKED, UNREAD = None, ()


def parse_into(html: str | None, elements: list[list], texts: list[list], names: Names | None = None) -> list[list[int]]:
    """Append one page's elements and text nodes, numbered in document order, to column lists; returns the marks.

    Recovers from unclosed and misnested tags the way browsers mostly do; markup broken beyond that
    may nest differently from another parser's reading. Open tags are looked up by name, so deep nesting costs no more.
    """
    n_marks = names.n_marks if names else 0
    marks: list[list[int]] = [[] for _ in range(n_marks)]
    if not html:
        return marks
    e_seq, e_end, e_parent, e_piece = elements
    t_seq, t_parent, t_text = texts
    before = len(e_seq) - 1  # places count from 1
    open_tags: list[str] = []
    open_rows: list[int] = []  # -1: not kept
    open_seqs: list[int] = [-1]  # that of the page itself first
    open_told: list = []  # of a label tag: the labels its first own text holds
    depths: dict[str, list[int]] = {}
    waiting: dict[str, list[int]] = {}  # value tag -> marks for the next one
    asked_labels = names.labels if names else {}
    known = names.known if names else _known
    whole = names is None
    seq = 0
    kept = 0 if names else 1  # kept elements around here; without names all is kept

    def close_to(depth: int) -> None:
        nonlocal kept
        while len(open_tags) > depth:
            depths[open_tags.pop()].pop()
            open_seqs.pop()
            if (row := open_rows.pop()) >= 0:
                e_end[row] = seq - 1
                kept -= 1
            if asked_labels and (told := open_told.pop()):
                for value_tag, mark in told:
                    waiting.setdefault(value_tag, []).append(mark)

    def innermost(tags) -> int:
        """Depth of the innermost open one of some tags; -1 if none is."""
        return max([d[-1] for t in tags if (d := depths.get(t))], default=-1)

    parts = iter([*MARKUP.split(html), ""])
    for text, markup in zip(parts, parts):
        if text:
            unread = asked_labels and open_told and open_told[-1] is UNREAD
            if kept or unread:
                if "&" in text:
                    text = unescape(text)
                if kept:
                    t_seq.append(seq)
                    t_text.append(text)
                    t_parent.append(open_seqs[-1])
                if unread:
                    open_told[-1] = [(v, mark) for label, v, mark in asked_labels[open_tags[-1]] if label in text]
            seq += 1
        if not markup:
            break
        piece = known.get(markup, UNKNOWN)
        if piece is UNKNOWN:
            piece = read_piece(markup, names, known)
        if piece is None:
            continue
        tag = piece.tag
        at = depths.get(tag)
        if piece.closes:
            if at:
                depth = at[-1]
                if depth == len(open_tags) - 1 and not asked_labels:
                    open_tags.pop()
                    at.pop()
                    open_seqs.pop()
                    if (row := open_rows.pop()) >= 0:
                        e_end[row] = seq - 1
                        kept -= 1
                elif depth == len(open_tags) - 1 or piece.closes == 2 or innermost(CELLS) <= depth:
                    close_to(depth)
            continue
        ended, bounds = piece.ends
        for t in ended:
            if depths.get(t):
                bound = innermost(bounds)
                cut = min([d[i] for t in ended if (d := depths.get(t)) and (i := bisect(d, bound)) < len(d)], default=-1)
                if cut >= 0:
                    close_to(cut)
                break
        found = piece.found
        if waiting and tag in waiting:
            found = found + waiting.pop(tag)
        row = -1
        if whole or found:
            row = len(e_seq)
            for mark in found:
                if mark is not None and mark < n_marks:
                    marks[mark].append(row - before)
            e_parent.append(open_seqs[-1])
            e_seq.append(seq)
            e_end.append(seq)
            e_piece.append(piece)
        if piece.raw_text is not None:
            if piece.raw_text:
                seq += 1
                if row >= 0 or kept:
                    t_seq.append(seq)
                    t_parent.append(seq - 1)
                    t_text.append(piece.raw_text)
                if row >= 0:
                    e_end[-1] = seq
        elif not piece.void:
            if at is None:
                at = depths[tag] = []
            at.append(len(open_tags))
            open_tags.append(tag)
            open_rows.append(row)
            open_seqs.append(seq)
            if asked_labels:
                open_told.append(UNREAD if tag in asked_labels else NOT_ASKED)
            if row >= 0:
                kept += 1
        seq += 1
    close_to(0)
    return marks


ARROW_ELEMENT = pa.struct(
    [
        ("seq", pa.int64()), ("end_seq", pa.int64()), ("parent_seq", pa.int64()), ("tag", pa.string()),
        ("id", pa.string()), ("class_attr", pa.string()), ("classes", pa.list_(pa.string())),
        ("attrs", pa.map_(pa.string(), pa.string())), ("own_text", pa.string()), ("place", pa.int32()), ("size", pa.int32()),
        ("text_place", pa.int32()), ("n_texts", pa.int32()), ("own", pa.list_(pa.int32())),
    ]
)
#: Of elements read for names: the numbers of those that the element fulfils.
FITS = "fits"
ARROW_NAMED = pa.struct([*ARROW_ELEMENT, (FITS, pa.list_(pa.int32()))])
ARROW_MARKS = pa.list_(pa.list_(pa.int32()))
#: What reading a page gives for an element: its numbers and the piece of markup that says the rest.
PARSED = "seq end_seq parent_seq piece".split()
ARROW_TEXT = pa.struct([("seq", pa.int64()), ("parent_seq", pa.int64()), ("text", pa.string())])
#: Pages laid out at once: so many, or fewer that hold so many bytes.
PAGES_PER_BATCH, BYTES_PER_BATCH = 256, 1 << 20


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_map(kind):
        offsets = pa.array([0, *accumulate(map(len, values))], pa.int32())
        keys = pa.array([k for v in values for k in v], pa.string())
        return pa.MapArray.from_arrays(offsets, keys, pa.array([x for v in values for x in v.values()], pa.string()))
    if pa.types.is_list(kind):
        offsets = pa.array([0, *accumulate(map(len, values))], pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array([x for v in values for x in v], kind.value_type))
    return pa.array(values, kind)


def _inner(e_seq: np.ndarray, e_end: np.ndarray, ends: list[int], t_seq: np.ndarray, t_parent: np.ndarray, text_ends: list[int], told: pa.Array) -> dict[str, pa.Array]:
    """Where the insides of all elements of a batch lie, from the numbers of its nodes: places, sizes, own texts.

    Numbers grow along a page and, with the page's own high bits, along the batch, so that places are found by bisection.
    """
    e_page, t_page = (np.repeat(np.arange(len(x) - 1), np.diff(x)) for x in (ends, text_ends))
    e_key, t_key = (e_page << 32) + e_seq, (t_page << 32) + t_seq
    last = (e_page << 32) + e_end
    row = np.arange(len(e_seq))
    size = np.searchsorted(e_key, last, "right") - row - 1
    text_at = np.searchsorted(t_key, e_key, "right")
    n_texts = np.searchsorted(t_key, last, "right") - text_at
    parent_key = (t_page << 32) + t_parent
    parent = np.searchsorted(e_key, parent_key)
    mine = np.flatnonzero((t_parent >= 0) & (parent < len(e_key)))
    mine = mine[e_key[parent[mine]] == parent_key[mine]]
    mine = mine[np.argsort(parent[mine], kind="stable")]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(parent[mine], minlength=len(e_seq)))])
    has = np.diff(offsets) > 0
    first = np.where(has, mine[np.minimum(offsets[:-1], max(len(mine) - 1, 0))] if len(mine) else 0, 0)
    e_first, t_first = np.asarray(ends)[e_page], np.asarray(text_ends)
    own = (mine - t_first[t_page[mine]] + 1).astype(np.int32)
    return {
        "own_text": told.take(pa.array(first, mask=~has)) if len(told) else pa.nulls(len(e_seq), pa.string()),
        "place": pa.array((row - e_first + 1).astype(np.int32)), "size": pa.array(size.astype(np.int32)),
        "text_place": pa.array((text_at - t_first[e_page] + 1).astype(np.int32)), "n_texts": pa.array(n_texts.astype(np.int32)),
        "own": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(own)),
    }


def _said(pieces: list[Piece], fields: list[pa.Field]) -> dict[str, pa.Array]:
    """What the elements' markup says. Elements of a batch share pieces, so each is laid out once."""
    places: dict[Piece, int] = {}
    codes = pa.array([places.setdefault(p, len(places)) for p in pieces], pa.int32())
    own = {"class_attr": "css"}
    return {
        f.name: _column([getattr(p, own.get(f.name, f.name)) for p in places], f.type).take(codes)
        for f in fields if f.name in ("tag", "id", "class_attr", "classes", "attrs", FITS)
    }


def node_columns(pages: list[str | None], names: list[Names | None] | None = None, kind: pa.StructType = ARROW_ELEMENT) -> tuple[pa.ListArray, pa.ListArray, list[list[list[int]]]]:
    """Elements, of the ``kind`` given, texts and marks of some pages, one list a page."""
    elements: list[list] = [[] for _ in PARSED]
    texts: list[list] = [[] for _ in range(ARROW_TEXT.num_fields)]
    element_ends, text_ends, marks = [0], [0], []
    for html, asked in zip(pages, names or [None] * len(pages), strict=True):
        marks.append(parse_into(html, elements, texts, asked))
        element_ends.append(len(elements[0]))
        text_ends.append(len(texts[0]))
    told = pa.array(texts[2], pa.string())
    e_seq, e_end, e_parent, t_seq, t_parent = (np.array(c, np.int64) for c in (*elements[:3], texts[0], texts[1]))
    made = _inner(e_seq, e_end, element_ends, t_seq, t_parent, text_ends, told)
    made |= {"seq": pa.array(e_seq), "end_seq": pa.array(e_end), "parent_seq": pa.array(e_parent, mask=e_parent < 0)}
    fields = list(kind)
    made |= _said(elements[3], fields)
    whole = pa.StructArray.from_arrays([made[f.name] for f in fields], fields=fields)
    read = pa.StructArray.from_arrays([pa.array(t_seq), pa.array(t_parent, mask=t_parent < 0), told], fields=list(ARROW_TEXT))
    return pa.ListArray.from_arrays(pa.array(element_ends, pa.int32()), whole), pa.ListArray.from_arrays(pa.array(text_ends, pa.int32()), read), marks


def parse_page(html: str | None) -> tuple[list[dict], list[dict]]:
    """Elements and text nodes of one page as dicts."""
    elements, texts, _ = node_columns([html])
    return [{**e, "attrs": dict(e["attrs"])} for e in elements[0].as_py()], texts[0].as_py()


def pieces_of(html: pa.Array, most: int = PAGES_PER_BATCH) -> Iterator[tuple[int, int]]:
    """Starts and lengths of runs of pages to be laid out together, ``most`` at the most."""
    at = held = 0
    for i, size in enumerate(pc.binary_length(html).fill_null(0).to_pylist()):
        if i > at and (i - at >= most or held + size > BYTES_PER_BATCH):
            yield at, i - at
            at, held = i, 0
        held += size
    if at < len(html):
        yield at, len(html) - at


def _fields(names: Names | dict[str, Names] | None) -> list[str]:
    """What is told of each element: all, or for names what they ask for."""
    if not names:
        return ELEMENT.names
    asked = [n.fields or ELEMENT.names for n in (names.values() if isinstance(names, dict) else [names])]
    return [f for f in ELEMENT.names if any(f in a for a in asked)] + [FITS]


def _parse_batches(names: Names | dict[str, Names] | None):
    kind = pa.struct([ARROW_NAMED.field(n) for n in _fields(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = Names([], [], 0)
        for whole in batches:
            where = whole.schema.get_field_index("html")
            kept = [i for i in range(whole.num_columns) if i != where]
            columns = [whole.schema.field(i).name for i in kept] + ["elements", "texts"] + (["marks"] if names else [])
            for at, n in pieces_of(whole.column(where)):
                batch = whole.slice(at, n)
                by_page = [names] * batch.num_rows
                if isinstance(names, dict):
                    by_page = [names.get(s, nothing) for s in batch.column(whole.schema.get_field_index("site")).to_pylist()]
                elements, texts, marks = node_columns(batch.column(where).to_pylist(), by_page, kind)
                made = [elements, texts, *([pa.array(marks, ARROW_MARKS)] if names else [])]
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + made, names=columns)

    return run


def with_nodes(pages: DataFrame, names: Names | dict[str, Names] | None = None) -> DataFrame:
    """Replace ``html`` by the arrays ``elements`` and ``texts``. No shuffle; other columns pass through.

    With ``names``, or names for each value of the column ``site``, only what they ask for is kept, elements say in ``fits`` what they fulfil, and ``marks`` has
    the places of the elements found under each mark, so that selections need not search the page.
    """
    named = {f.name: f for f in [*ELEMENT, T.StructField(FITS, T.ArrayType(T.IntegerType()))]}
    element = T.StructType([named[n] for n in _fields(names)])
    made = [T.StructField("elements", T.ArrayType(element)), T.StructField("texts", T.ArrayType(TEXT_NODE))]
    if names:
        made.append(T.StructField("marks", T.ArrayType(T.ArrayType(T.IntegerType()))))
    schema = T.StructType([f for f in pages.schema if f.name != "html"] + made)
    return pages.mapInArrow(_parse_batches(names), schema)


def html_nodes(parsed: DataFrame) -> DataFrame:
    """Parsed pages as a node table, one row per element or text node (tag ``#text``)."""
    nulls = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in ELEMENT}
    fields = "seq end_seq parent_seq tag id class_attr classes attrs".split()
    elements = parsed.select("page_id", F.explode("elements").alias("n")).select(
        "page_id", *[F.col(f"n.{f}") for f in fields], F.lit(None).cast("string").alias("text")
    )
    as_nodes = {
        **nulls,
        "seq": F.col("n.seq"), "end_seq": F.col("n.seq").alias("end_seq"),
        "parent_seq": F.col("n.parent_seq"), "tag": F.lit("#text").alias("tag"),
    }
    texts = parsed.select("page_id", F.explode("texts").alias("n")).select(
        "page_id", *[as_nodes[f] for f in fields], F.col("n.text").alias("text")
    )
    return elements.unionByName(texts)
