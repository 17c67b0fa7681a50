"""Column functions for listing text: numbers, units, ids, keys, links, durations.

All of them are built-in expressions, so they stay inside generated JVM code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "py_strip", "blank_to_null", "extract_number", "extract_unit", "extract_property_id",
    "extract_listing_type", "rchop", "listing_key", "price_per_sqm", "absolute_link", "contact_link",
    "host_name", "runtime_minutes", "days_hours_minutes", "upgrade_scheme", "parse_for_types", "as_column",
]

# The characters Unicode calls whitespace, as text trimming sees them.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NUMBER_PATTERN = r"\d*\.?,?\d+"
ID_PATTERN = r"-(?:pr|ad)?([0-9]+)(?:\.htm)?\z"
FAILURE = "FAILURE"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def py_strip(s: Column | str) -> Column:
    """Trim every kind of Unicode whitespace, not only blanks."""
    return F.trim(as_column(s), F.lit(WHITESPACE))


def blank_to_null(s: Column | str) -> Column:
    return F.nullif(as_column(s), F.lit(""))


def extract_number(s: Column | str) -> Column:
    """All number-like pieces joined, commas read as dots; null if that is no number."""
    pieces = F.regexp_extract_all(as_column(s), F.lit(NUMBER_PATTERN), F.lit(0))
    return F.translate(F.array_join(pieces, ""), ",", ".").try_cast("double")


def extract_unit(s: Column | str) -> Column:
    """Everything that is no ASCII digit, untrimmed; null for empty or null text."""
    s = as_column(s)
    return F.when(s != "", F.translate(s, "0123456789", ""))


def rchop(s: Column | str, suffix: str) -> Column:
    s = as_column(s)
    return F.when(F.endswith(s, F.lit(suffix)), F.left(s, F.length(s) - len(suffix))).otherwise(s)


def extract_property_id(link: Column | str) -> Column:
    """Digits ending the link after ``-``, ``-pr`` or ``-ad``, one trailing ``.htm`` aside; else null."""
    return F.get(F.regexp_extract_all(as_column(link), F.lit(ID_PATTERN), F.lit(1)), F.lit(0))


def extract_listing_type(url: Column | str) -> Column:
    """Text after the last slash and before the first dot; null without a slash."""
    url = as_column(url)
    tail = F.split_part(F.substring_index(url, "/", -1), F.lit("."), F.lit(1))
    return F.when(F.contains(url, F.lit("/")), tail)


def listing_key(vendor: Column | str, property_id: Column | str, type_: Column | str) -> Column:
    found = F.coalesce(as_column(property_id), F.lit(FAILURE))
    return F.concat(as_column(vendor), F.lit(":"), found, F.lit(":"), as_column(type_))


def price_per_sqm(price: Column | str, size: Column | str) -> Column:
    price, size = as_column(price), as_column(size)
    return F.when((price != 0) & (size != 0), price / size)


def absolute_link(vendor: Column | str, href: Column | str) -> Column:
    return F.concat(as_column(vendor), py_strip(href))


def contact_link(vendor: Column | str, href: Column | str, section: str = "/doanh-nghiep/detail") -> Column:
    href = blank_to_null(href)
    return F.concat(as_column(vendor), F.lit(section), href)


def host_name(url: Column | str, suffix: str) -> Column:
    bare = F.replace(as_column(url), F.lit("http://"), F.lit(""))
    return F.replace(bare, F.lit(suffix), F.lit(""))


def upgrade_scheme(url: Column | str) -> Column:
    return F.replace(as_column(url), F.lit("http://"), F.lit("https://"))


def _elapsed_seconds(end: Column | str, start: Column | str) -> Column:
    """Whole seconds from start to end, rounded down; exact in integers."""
    micros = F.unix_micros(as_column(end).cast("timestamp")) - F.unix_micros(as_column(start).cast("timestamp"))
    return _div(micros - F.pmod(micros, F.lit(1000000)), 1000000)


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def runtime_minutes(end: Column | str, start: Column | str, compat: bool = False) -> Column:
    """Whole minutes between two instants.

    ``compat`` keeps only the minute-of-the-hour part of the time within a day, the figure older
    reports show.
    """
    seconds = _elapsed_seconds(end, start)
    if compat:
        return _div(F.pmod(seconds, F.lit(86400)), 60) % 60
    return _div(seconds - F.pmod(seconds, F.lit(60)), 60)


def days_hours_minutes(end: Column | str, start: Column | str) -> Column:
    """Elapsed time split into a struct of days, hours and minutes."""
    seconds = _elapsed_seconds(end, start)
    in_day = F.pmod(seconds, F.lit(86400))
    return F.struct(
        _div(seconds - in_day, 86400).alias("days"),
        _div(in_day, 3600).alias("hours"),
        (_div(in_day, 60) % 60).alias("minutes"),
    )


def parse_for_types(value: Column, type_: Column | str, parsed_types: list[str] | None) -> Column:
    """``value`` only for the listed types, else null; no list means every type."""
    if parsed_types is None:
        return value
    return F.when(as_column(type_).isin(parsed_types), value)
