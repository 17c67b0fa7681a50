"""Table changes as DataFrame -> DataFrame functions: the caller decides where the result goes.

``broadcast`` is never hinted on data whose size is unknown; the planner and adaptive execution
broadcast a side only when its measured size is under their threshold and shuffle otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellframe.operators.ordering import broadcast_if_small, first_per_key, null_safe
from dwellframe.schemas import INDEX_INSERTED, INDEX_KEYS


def total_order(df: DataFrame, lead: list[Column], besides: list[str] | None = None) -> list[Column]:
    """``lead`` followed by every sortable column not in ``besides``, so that 'first' is one definite row."""
    skip = set(besides or [])
    names = [f.name for f in df.schema if f.name not in skip and f.dataType.typeName() not in ("map", "variant")]
    return lead + [F.col(c).asc_nulls_first() for c in names]


def new_rows(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[Column], small_keys: DataFrame | None = None
) -> DataFrame:
    """Rows of ``source`` to add so that each key is present once and existing rows stay untouched.

    ``small_keys``, the source's keys behind a broadcast hint, first cuts the target down to the keys
    in question, so that a large table is only scanned, not shuffled, for a small source. Stored keys come before all
    rows of the source, so that one shuffle by key tells a key's first row and whether it is there already.
    """
    present = target.select(*keys)
    if small_keys is not None:
        present = present.join(small_keys, null_safe(present, small_keys, keys), "left_semi")
    if any(present.schema[k].dataType != source.schema[k].dataType for k in keys):  # a union would change the source's types
        first = first_per_key(source, keys, order)
        return first.join(present, null_safe(first, present, keys), "left_anti")
    both = source.withColumn("_new", F.lit(1)).unionByName(present.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    return first_per_key(both, keys, [F.col("_new").asc(), *order]).filter("_new = 1").drop("_new")


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[Column], small_keys: DataFrame | None = None
) -> DataFrame:
    """First write wins: ``target`` plus the first source row of every key it lacks."""
    added = new_rows(target, source, keys, order, small_keys)
    return target.unionByName(added, allowMissingColumns=True)


def index_rows(hits: DataFrame) -> DataFrame:
    """The columns an index insert writes; a column the hits lack becomes null."""
    names = set(hits.columns)
    return hits.select(*[c for c in INDEX_KEYS + INDEX_INSERTED if c in names])


def insert_hits(index: DataFrame, hits: DataFrame, small_keys: DataFrame | None = None) -> DataFrame:
    rows = index_rows(hits)
    order = total_order(rows, [F.col("created_date").asc_nulls_first()], INDEX_KEYS + ["created_date"])
    return insert_if_absent(index, rows, INDEX_KEYS, order, small_keys)


def insert_checks(checks: DataFrame, source: DataFrame) -> DataFrame:
    order = total_order(source, [F.col("date").asc_nulls_first()], ["ip", "date"])
    return insert_if_absent(checks, source, ["ip"], order)


def put_by_key(
    target: DataFrame, source: DataFrame, key: str = "key", written_at: str = "crawled_date",
    small_keys: DataFrame | None = None,
) -> DataFrame:
    """Last write wins, whole row. On equal times the source row replaces the stored one.

    With ``small_keys``, the source's keys behind a broadcast hint, stored rows of other keys pass
    through without a shuffle.
    """
    order = [F.col(written_at).desc_nulls_last(), F.col("_new").desc()]
    order += total_order(source, [], [key, written_at])
    untouched = None
    if small_keys is not None:
        untouched = target.join(small_keys, null_safe(target, small_keys, [key]), "left_anti")
        target = target.join(small_keys, null_safe(target, small_keys, [key]), "left_semi")
    both = target.withColumn("_new", F.lit(0)).unionByName(
        source.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    current = first_per_key(both, [key], order).drop("_new")
    return current if untouched is None else untouched.unionByName(current, allowMissingColumns=True)


def update_where(
    target: DataFrame, matches: DataFrame, keys: list[str], assign: dict[str, Column], check_size: bool = False
) -> DataFrame:
    """Set columns on every target row whose keys occur in ``matches``; nothing is inserted.

    With ``check_size`` the match keys are measured first and broadcast if small, so the target is
    not shuffled. Meant for staged matches, since measuring reads them.
    """
    hit = matches.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    hit = (broadcast_if_small(hit) if check_size else hit).withColumn("_hit", F.lit(True))
    cond = reduce(lambda a, b: a & b, [target[k].eqNullSafe(hit[f"_k_{k}"]) for k in keys])
    joined = target.join(hit, cond, "left")
    for name, value in assign.items():
        kept = F.col(name) if name in target.columns else F.lit(None)
        joined = joined.withColumn(name, F.when(F.col("_hit"), value).otherwise(kept))
    return joined.drop("_hit", *[f"_k_{k}" for k in keys])


def mark_crawled(index: DataFrame, claimed: DataFrame, run_ts: Column, check_size: bool = False) -> DataFrame:
    """Stamp every index row of the claimed (vendor, type, property_id) keys; null ids match null ids."""
    return update_where(index, claimed, INDEX_KEYS, {"last_crawled_date": run_ts}, check_size)


def recode(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    c = F.col(column)
    return df.withColumn(column, F.when(c == old, F.lit(new)).otherwise(c))


def reset_crawled(index: DataFrame, vendor: str, since: Column) -> DataFrame:
    """Make one vendor's rows crawled after ``since`` uncrawled again."""
    crawled = F.col("last_crawled_date")
    due = (F.col("vendor") == vendor) & (crawled > since)
    return index.withColumn("last_crawled_date", F.when(due, F.lit(None)).otherwise(crawled))


def append_all(target: DataFrame, source: DataFrame) -> DataFrame:
    """Bag union; a column missing on one side is null there."""
    return target.unionByName(source, allowMissingColumns=True)


def _is_empty(df: DataFrame, name: str) -> Column:
    """Null, empty text or an empty array."""
    c, kind = F.col(name), df.schema[name].dataType.typeName()
    if kind == "array":
        return c.isNull() | (F.size(c) == 0)
    return c.isNull() | (c == "") if kind == "string" else c.isNull()


def require_fields(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into (complete, incomplete) rows; the latter name their empty columns in ``_missing``.

    No columns are required by default, so nothing is held back.
    """
    empty = {c: _is_empty(df, c) for c in columns or []}
    lacking = reduce(lambda a, b: a | b, empty.values(), F.lit(False))
    names = F.array(*[F.when(e, F.lit(c)) for c, e in empty.items()]).cast("array<string>")
    return df.filter(~lacking), df.filter(lacking).withColumn("_missing", F.array_compact(names))


def semi_by_keys(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur in ``wanted``: an IN-list of any length as a semi join."""
    return df.join(wanted.select(*keys), null_safe(df, wanted, keys), "left_semi")
