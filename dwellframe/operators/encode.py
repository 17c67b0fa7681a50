"""Encoding rows for a key-value store that takes text, decimals and no empty strings."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMAL = "decimal(38,18)"


def _float_to_decimal(c: Column) -> Column:
    # through text, so that the shortest form of the number is what gets stored
    return c.cast("string").try_cast(DECIMAL)


ENCODERS: dict[str, Callable[[Column], Column]] = {
    "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
    "timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
    "date": lambda c: F.date_format(c, "yyyy-MM-dd"),
    "time": lambda c: F.substring(c.cast("string"), 1, 8),
    "double": _float_to_decimal,
    "float": _float_to_decimal,
    "string": lambda c: F.when(c == "", F.lit(" ")).otherwise(c),
}


def _type_name(t: T.DataType) -> str:
    return t.typeName().split("(")[0]


def encode_for_kv(
    df: DataFrame, overrides: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """Encode top-level columns by type; nested values and other types pass unchanged.

    A floating-point column ``x`` gets a column ``x_text`` beside it: a number that the store's decimals
    cannot hold exactly, NaN and infinities included, is kept there as its shortest text, and ``x`` is null.

    ``overrides`` maps a Spark type name to a Column -> Column function replacing the default.
    """
    rules = {**ENCODERS, **(overrides or {})}
    keep: Callable[[Column], Column] = lambda c: c
    out = []
    for f in df.schema:
        value, kind = F.col(f"`{f.name}`"), _type_name(f.dataType)
        made = rules.get(kind, keep)(value)
        if kind in ("double", "float") and rules[kind] is _float_to_decimal:
            if f"{f.name}_text" in df.columns:
                raise ValueError(f"column {f.name}_text is taken")
            exact = made.cast(kind).eqNullSafe(value)
            out += [F.when(exact, made).alias(f.name), F.when(~exact, value.cast("string")).alias(f"{f.name}_text")]
        else:
            out.append(made.alias(f.name))
    return df.select(*out)
