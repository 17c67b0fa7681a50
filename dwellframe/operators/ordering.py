"""First-per-key, top-k-per-group and exact numbering that do not hang on one hot group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellframe.session import stage


# Largest table handed to every executor, in measured bytes.
BROADCAST_BYTES = 64 << 20
# What a value counts besides its text.
KEY_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows hold, counted over the actual rows. Runs a job: for data already staged or kept."""
    per_row = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + KEY_BYTES for c in df.columns]
    return df.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, per_row)), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows; otherwise unchanged, to be shuffled.

    A hint rather than adaptive execution, because by the time that has seen this side to be small it
    has already shuffled the other.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def small_or_none(keys: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame | None:
    """The distinct keys behind a broadcast hint, or None if they are too large for it.

    An estimate of their number comes first, so that keys far too many are not shuffled to be measured.
    """
    estimate = keys.agg(F.approx_count_distinct(F.struct(*keys.columns))).first()[0]
    if estimate * KEY_BYTES * len(keys.columns) > 2 * limit:
        return None
    keys = keys.distinct()
    return F.broadcast(keys) if measured_bytes(keys) <= limit else None


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition in which null keys match each other; still an equi-join for the planner."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` is planned with a window group limit, so each map task sends at most one
    row per key: a key holding a third of the input costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def limit_threshold(df: DataFrame) -> int:
    """The largest k the planner cuts groups to before a shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_k_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int, salt_by: list[str], out: str = "rn", salts: int = 32
) -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1 in ``out``.

    Groups are few and large (vendor and type), so they are first cut into ``salts`` slices by a hash
    of ``salt_by`` and limited there; the last step sees at most ``salts * k`` rows of a group. Beyond the
    planner's limit threshold the slices would not be cut on the map side; such a ``k`` goes to
    :func:`number_rows`, which needs no group in one task.
    """
    if k > limit_threshold(df):
        numbered = number_rows(df, group, order, out)
        return numbered.filter(F.col(out) <= k)
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(salts))
    sliced = Window.partitionBy(*group, "_salt").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("_in_slice", F.row_number().over(sliced))
        .filter(F.col("_in_slice") <= k)
        .drop("_salt", "_in_slice")
        .withColumn(out, F.row_number().over(whole))
        .filter(F.col(out) <= k)
    )


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in global order with partition number ``_part`` and place in it ``_place``, staged.

    monotonically_increasing_id puts the partition in the upper 31 bits and the row's place in the
    lower 33. Staging pins both: range bounds are sampled and need not repeat on a second run.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    return stage(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", place)
        .withColumn("_part", F.shiftright("_place", 33))
        .withColumn("_place", F.col("_place") - F.shiftleft(F.col("_part"), 33))
    )


def _offsets(sizes: DataFrame) -> DataFrame:
    """``sizes(_part, _n)`` -> running total before each partition.

    One row per shuffle partition, so both the unpartitioned window here and the broadcasts of its
    result are bounded by configuration, not by data.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))


def number_rows(
    df: DataFrame, group: list[str], order: list[Column], out: str = "rn", size_out: str | None = None
) -> DataFrame:
    """Exact 1-based row numbers per group, in ``order``, with no group gathered in one task.

    Rows are range-partitioned over (group, order), so a hot group spans many partitions. A row's
    global position is its place in its partition plus the rows before that partition; its number is
    that minus the position where its group starts. ``size_out`` also returns the group's row count.
    """
    ranged = _ranged(df, [F.col(g).asc_nulls_first() for g in group] + order)
    pieces = stage(ranged.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.min("_place").alias("_first")))
    offsets = F.broadcast(_offsets(pieces.groupBy("_part").agg(F.sum("_n").alias("_n"))))
    starts = (
        pieces.join(offsets, "_part")
        .groupBy(*[F.col(g).alias(f"_g_{g}") for g in group])
        .agg(F.min(F.col("_before") + F.col("_first")).alias("_start"), F.sum("_n").alias("_size"))
    )
    # few groups: broadcast, so the rows are not shuffled again; many: an even shuffle on the group
    starts = broadcast_if_small(starts)
    placed = ranged.join(offsets, "_part").withColumn("_at", F.col("_before") + F.col("_place"))
    match = reduce(lambda a, b: a & b, [placed[g].eqNullSafe(starts[f"_g_{g}"]) for g in group])
    numbered = placed.join(starts, match).withColumn(out, F.col("_at") - F.col("_start") + 1)
    if size_out:
        numbered = numbered.withColumnRenamed("_size", size_out)
    return numbered.drop("_part", "_place", "_before", "_at", "_start", "_size", *[f"_g_{g}" for g in group])


def running_total(df: DataFrame, order: list[Column], value: str, out: str) -> DataFrame:
    """Inclusive running sum of an integer column over the whole table, partition by partition."""
    ranged = _ranged(df, order)
    offsets = F.broadcast(_offsets(ranged.groupBy("_part").agg(F.sum(value).alias("_n"))))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_sum", F.sum(value).over(inside))
        .join(offsets, "_part")
        .withColumn(out, F.col("_before") + F.col("_sum"))
        .drop("_part", "_place", "_sum", "_before")
    )
