"""Record streams into tables, micro-batch by micro-batch.

Tables are folders of committed micro-batches in one order over all streams that write them (``operators.commits``).
An insert-only table takes just the rows it lacks, and looks for them only in the hash buckets that the batch's keys
fall into; a last-write-wins table takes each batch's winners and is resolved when read. Folders of one size
are merged from time to time. So a micro-batch reads and writes data in proportion to itself, never the table, and a
replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from dwellframe.operators.commits import State, read_state
from dwellframe.operators.extract import quarantine
from dwellframe.operators.ordering import first_per_key, small_or_none
from dwellframe.operators.sinks import BUCKET_ROWS, FAN, fold_batches, merge_batches, read_batches, rows_at_keys, write_batch
from dwellframe.operators.tables import new_rows, total_order
from dwellframe.schemas import CONTACT_COLUMNS, FETCH_CHECK, INDEX_INSERTED, INDEX_KEYS, LISTING, PROPERTY_INDEX
from dwellframe.session import kept

Sink = Callable[[DataFrame, int], None]


def _of_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` that ``df`` has, in its types."""
    there = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in there])


def insert_sink(
    path: str, stream: str, schema: T.StructType, keys: list[str], lead: list[str], fan: int = FAN, bucket_rows: int = BUCKET_ROWS
) -> Sink:
    """First write wins: over the table in the order of commits, and within a batch in ``lead`` order.

    The batch's keys say which buckets of the table are opened; there they are broadcast if they are measured to fit,
    else joined by shuffle. If another stream commits first, the batch is compared with the table again, so streams that
    write at the same time insert no key twice.
    """
    key_schema = T.StructType([schema[k] for k in keys])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= read_state(spark, path).streams.get(stream, -1):
            return
        rows = _of_schema(batch, schema)
        order = total_order(rows, [F.col(c).asc_nulls_first() for c in lead], keys + lead)
        with kept(first_per_key(rows, keys, order)) as first:
            wanted = first.select(*keys)
            few = cache(lambda: small_or_none(wanted))

            def lacking(state: State) -> DataFrame:
                if not any(p["rows"] for p in state.folders.values()):
                    return first  # there is nothing to compare with
                return new_rows(rows_at_keys(spark, path, key_schema, keys, wanted, state), first, keys, order, few())

            write_batch(first, path, stream, batch_id, keys, first.count(), bucket_rows, lacking)
        merge_batches(spark, path, schema, keys=keys, fan=fan, bucket_rows=bucket_rows)

    return write


def read_first(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], lead: list[str]) -> DataFrame:
    """An insert-only table with one row per key even if rows were written without looking: the first in ``lead`` order."""
    rows = read_batches(spark, path, schema, written=True)
    order = total_order(rows, [F.col(c).asc_nulls_first() for c in [*lead, "written_seq"]], keys + lead)
    return first_per_key(rows, keys, order).select(*schema.names)


def index_sink(path: str, stream: str, **sizes: int) -> Sink:
    inserted = T.StructType([PROPERTY_INDEX[c] for c in INDEX_KEYS + INDEX_INSERTED])
    return insert_sink(path, stream, inserted, INDEX_KEYS, ["created_date"], **sizes)


def check_sink(path: str, stream: str, schema: T.StructType = FETCH_CHECK, **sizes: int) -> Sink:
    return insert_sink(path, stream, schema, ["ip"], ["date"], **sizes)


def latest_first(df: DataFrame, written_at: str) -> list[Column]:
    """Later times first; of equal times the later commit, where rows say which."""
    lead = [written_at, *(c for c in ("written_seq",) if c in df.columns)]
    return total_order(df, [F.col(c).desc_nulls_last() for c in lead], lead)


def _current(key: str, written_at: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: first_per_key(df, [key], latest_first(df, written_at))


def listing_sink(
    path: str, stream: str, key: str = "key", written_at: str = "crawled_date", drop_contacts: bool = False,
    schema: T.StructType = LISTING, fan: int = FAN, bucket_rows: int = BUCKET_ROWS,
) -> Sink:
    """Last write wins: keeps each key's last row of the batch. ``drop_contacts`` leaves contact columns out."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= read_state(spark, path).streams.get(stream, -1):
            return
        rows = _of_schema(batch.drop(*CONTACT_COLUMNS) if drop_contacts else batch, schema)
        with kept(_current(key, written_at)(rows)) as winners:
            write_batch(winners, path, stream, batch_id, [key], winners.count(), bucket_rows)
        merge_batches(spark, path, schema, _current(key, written_at), [key], fan, bucket_rows)

    return write


def append_sink(path: str, stream: str, fan: int = FAN) -> Sink:
    """All rows of every batch, once each. Needs the same columns in every batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, stream, batch_id)
        merge_batches(batch.sparkSession, path, batch.schema, fan=fan)

    return write


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType = LISTING, key: str = "key",
    written_at: str = "crawled_date",
) -> DataFrame:
    """The current rows of a last-write-wins table."""
    return _current(key, written_at)(read_batches(spark, path, schema, written=True)).select(*schema.names)


def fold_latest(
    spark: SparkSession, path: str, schema: T.StructType = LISTING, key: str = "key",
    written_at: str = "crawled_date",
) -> dict[str, int]:
    """Fold a last-write-wins table's older batches into their current rows."""
    return fold_batches(spark, path, schema, _current(key, written_at), [key])


def route(sinks: dict[str, Sink], kind: str = "kind") -> Sink:
    """Send each record kind to its own sink. The batch is kept while all of them read it, each its own kind's rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as rows:
            for name, sink in sinks.items():
                sink(rows.filter(F.col(kind) == name).select("record.*" if "record" in rows.columns else "*"), batch_id)

    return write


def page_sink(
    extractor: Callable[[DataFrame], DataFrame], sink: Sink, set_aside: str, stream: str, drop_contacts: bool = False
) -> Sink:
    """Extract a batch of pages once; usable records go to ``sink``, the others to a table of their own.

    ``drop_contacts`` leaves personal contact columns out of both.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        records = extractor(batch)
        records = (records.drop(*CONTACT_COLUMNS) if drop_contacts else records).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = quarantine(records)
            sink(good, batch_id)
            write_batch(bad, set_aside, stream, batch_id)
        finally:
            records.unpersist()

    return write


def start_sink(stream: DataFrame, sink: Sink, checkpoint: str, available_now: bool = True) -> DataStreamWriter:
    """A writer over the stream; call ``start()`` on it."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer
