"""Selections inside one parsed page, as SQL over its ``elements`` and ``texts`` arrays.

Every function takes and returns SQL expression text, to be handed to ``F.expr``: a rule set is some
dozens of nested lambdas, and the planner reads them as one text much faster than they could be put
together call by call. Nothing here joins or shuffles. What lies inside an element is a slice of each array, so a
selection reads what it returns and the insides of the elements it goes through, not the page once for each element.

Arrays may hold a part of a page (one hit): ``Part`` says how far its places are off.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from dwellframe.functions.scalars import WHITESPACE


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class El:
    """What one element must look like. ``cls`` lists class names it must all carry."""

    tag: str | None = None
    cls: str = ""
    id: str | None = None
    class_attr: str | None = None
    class_prefix: str | None = None
    child: bool = False  # directly below the step before it, not just anywhere inside

    def matches(self, e: str) -> str:
        tests = []
        if self.tag:
            tests.append(f"{e}.tag = {quoted(self.tag)}")
        if self.id is not None:
            tests.append(f"{e}.id <=> {quoted(self.id)}")
        if self.class_attr is not None:
            tests.append(f"{e}.class_attr <=> {quoted(self.class_attr)}")
        if self.class_prefix is not None:
            tests.append(f"coalesce(startswith({e}.class_attr, {quoted(self.class_prefix)}), false)")
        tests += [f"array_contains({e}.classes, {quoted(name)})" for name in self.cls.split()]
        return " and ".join(tests) or "true"


def bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once though the body may loop over it."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


@dataclass(frozen=True)
class Part:
    """Where the nodes are: the arrays' names, and how many elements and texts of the page come before theirs.

    ``fits`` has the numbers under which the parser told what elements fulfil; others are tested here.
    """

    elements: str = "elements"
    texts: str = "texts"
    elements_before: str = "0"
    texts_before: str = "0"
    fits: Mapping[El, int] | None = None

    def test(self, step: El, e: str) -> str:
        known = None if self.fits is None else self.fits.get(step)
        return step.matches(e) if known is None else f"array_contains({e}.fits, {known})"


PAGE = Part()
#: One hit of a search page, as ``extract.hit_rows`` cuts it out.
HIT = Part(elements_before="elements_before", texts_before="texts_before")


def inside(element: str, part: Part = PAGE) -> str:
    """The elements inside one of the part's."""
    return f"slice({part.elements}, {element}.place - {part.elements_before} + 1, {element}.size)"


def at_places(places: str, part: Part = PAGE) -> str:
    return f"transform({places}, p -> element_at({part.elements}, p - {part.elements_before}))"


def marked(mark: int) -> str:
    """Elements that the parser found under a mark; none where the page was read without it."""
    return at_places(f"coalesce(get(marks, {mark}), cast(array() as array<int>))")


def elements_at(*steps: El, part: Part = PAGE, first: str | None = None) -> str:
    """Elements matching the last step and lying inside matches of the steps before, once each, in page order.

    ``first`` gives the matches of the first step where they are known already.
    """
    found = first or f"filter({part.elements}, e -> {part.test(steps[0], 'e')})"
    for step in steps[1:]:
        linked = " and e.parent_seq = o.seq" if step.child else ""
        below = f"filter({inside('o', part)}, e -> {part.test(step, 'e')}{linked})"
        places = f"sort_array(array_distinct(flatten(transform(outer, o -> transform({below}, e -> e.place)))))"
        one = f"flatten(transform(outer, o -> {below}))"  # elements around each other hold the same ones
        found = bind(found, "outer", f"if(size(outer) < 2, {one}, {at_places(places, part)})")
    return found


def _texts(places: str, part: Part) -> str:
    return f"transform({places}, i -> element_at({part.texts}, i - {part.texts_before}).text)"


def own_texts(found: str, part: Part = PAGE) -> str:
    """Direct text children of the found elements, in page order."""
    return _texts(f"sort_array(flatten(transform({found}, e -> e.own)))", part)


def all_texts(found: str, part: Part = PAGE) -> str:
    """Every text inside the found elements, once each, in page order."""
    run = "if(e.n_texts > 0, sequence(e.text_place, e.text_place + e.n_texts - 1), cast(array() as array<int>))"
    return _texts(f"sort_array(array_distinct(flatten(transform({found}, e -> {run}))))", part)


def attr_values(found: str, name: str) -> str:
    """An attribute's values over the found elements, those lacking it left out."""
    return f"filter(transform({found}, e -> element_at(e.attrs, {quoted(name)})), v -> v is not null)"


def texts_after_label(label_tag: str, label: str, value_tag: str, part: Part = PAGE) -> str:
    """Texts of the value elements that follow a label.

    A label is a ``label_tag`` element whose first own text contains ``label``. Its value is the next
    ``value_tag`` element after the label's end, so neither inside it nor around it. Texts over all
    labels come as one list, each once. For pages read without marks: it looks through what follows each label.
    """
    told = f"e.tag = {quoted(label_tag)} and coalesce(contains(e.own_text, {quoted(label)}), false)"
    labels = f"filter({part.elements}, e -> {told})"
    rest = f"slice({part.elements}, l.place - {part.elements_before} + l.size + 1, size({part.elements}))"
    next_value = f"get(filter({rest}, c -> c.tag = {quoted(value_tag)}), 0)"
    return all_texts(f"array_compact(transform({labels}, l -> {next_value}))", part)


def texts_of_labelled_items(list_class: str, label: str, part: Part = PAGE, first: str | None = None) -> str:
    """Texts of the ``li`` items of a ``ul`` (exact class attribute) in which some text contains ``label``."""
    items = elements_at(El("ul", class_attr=list_class), El("li", child=True), part=part, first=first)
    told = f"slice({part.texts}, i.text_place - {part.texts_before}, i.n_texts)"
    return all_texts(f"filter({items}, i -> exists({told}, t -> contains(t.text, {quoted(label)})))", part)


# --- picking from a list of texts ---------------------------------------------------------------


def stripped(text: str) -> str:
    return f"trim(both '{WHITESPACE}' from {text})"


def first_or_null(values: str) -> str:
    return stripped(f"get({values}, 0)")


def list_or_null(values: str) -> str:
    return bind(values, "v", "if(size(v) > 0, v, null)")


def pick(values: str, position: int, more_than: int = 0, exactly: int | None = None) -> str:
    """The text at a position (from 0, negative from the end) if the list is long enough; trimmed."""
    index = position + 1 if position >= 0 else position
    wanted = f"size(v) = {exactly}" if exactly is not None else f"size(v) > {more_than}"
    return bind(values, "v", f"if({wanted}, {stripped(f'try_element_at(v, {index})')}, null)")


def join_texts(values: str, sep: str) -> str:
    """Each text trimmed, then joined; empty text for an empty list."""
    return f"array_join(transform({values}, t -> {stripped('t')}), {quoted(sep)})"
