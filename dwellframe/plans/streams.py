"""The record streams over the driver's tables: landed slice by slice, read by several streams, restarted in the middle.

A slice is written to the folder a stream watches, the stream runs until it has read all there is and stops; the next
slice goes to the next stream, and so on. Before the last slice the commit mark of the last micro-batch is taken out of a
checkpoint, as if the process had died between writing a batch and marking it: the stream then repeats that batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.operators.commits import Files
from dwellframe.operators.sinks import read_batches
from dwellframe.operators.tables import index_rows
from dwellframe.schemas import INDEX_KEYS
from dwellframe.session import scratch_root
from dwellframe.streaming import sinks

SLICES = 3


class Runs:
    """Streams of one query, each with a landing folder and a checkpoint of its own below the shared scratch folder."""

    def __init__(self, spark: SparkSession, schema: T.StructType, sinks_: dict[str, sinks.Sink], root: str) -> None:
        self.spark, self.schema, self.sinks, self.root = spark, schema, sinks_, root

    def land(self, stream: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/landed-{stream}")

    def run(self, stream: str) -> None:
        source = self.spark.readStream.schema(self.schema).parquet(f"{self.root}/landed-{stream}")
        query = sinks.start_sink(source, self.sinks[stream], f"{self.root}/checkpoint-{stream}").start()
        query.awaitTermination()

    def forget_last(self, stream: str) -> None:
        """Take the last micro-batch's commit mark out of the checkpoint, so that the next run repeats the batch."""
        files = Files(self.spark, f"{self.root}/checkpoint-{stream}")
        last = max((n for n in files.names("commits") if n.isdigit()), key=int)
        for name in (last, f".{last}.crc"):
            files.fs.delete(files._path(f"commits/{name}"), False)


def stream_root(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/streams-{uuid.uuid4().hex}"


def run_slices(
    spark: SparkSession, rows: DataFrame, slice_of: Column, sink: Callable[[str], sinks.Sink], root: str, streams: tuple[str, ...] = ("a", "b")
) -> None:
    """Send ``rows`` through the streams, slice ``i`` through the one whose turn it is; the first repeats a batch before its last."""
    runs = Runs(spark, rows.schema, {s: sink(s) for s in streams}, root)
    for i in range(SLICES):
        stream = streams[i % len(streams)]
        runs.land(stream, rows.filter(slice_of == i))
        if i and i >= SLICES - len(streams) and stream == streams[0]:
            runs.forget_last(stream)
        runs.run(stream)


def stream_index(spark: SparkSession, hits: DataFrame, slice_of: Column) -> DataFrame:
    """Search hits into the index, first write wins."""
    root, rows = stream_root(spark), index_rows(hits)
    run_slices(spark, rows, slice_of, lambda s: sinks.insert_sink(f"{root}/index", s, rows.schema, INDEX_KEYS, ["created_date"]), root)
    return read_batches(spark, f"{root}/index", rows.schema)


def stream_checks(spark: SparkSession, checks: DataFrame, slice_of: Column) -> DataFrame:
    """Fetch checks, the first of each address."""
    root = stream_root(spark)
    run_slices(spark, checks, slice_of, lambda s: sinks.insert_sink(f"{root}/checks", s, checks.schema, ["ip"], ["date", "event_id"]), root)
    return read_batches(spark, f"{root}/checks", checks.schema)


def stream_listings(spark: SparkSession, listings: DataFrame, slice_of: Column) -> DataFrame:
    """Listings, the last of each key; of equal times the one that was committed later, whichever stream wrote it."""
    root = stream_root(spark)
    schema = T.StructType([f for f in listings.schema if f.name != "slice"])
    run_slices(spark, listings, slice_of, lambda s: sinks.listing_sink(f"{root}/listings", s, schema=schema), root)
    return sinks.read_latest(spark, f"{root}/listings", schema)


def stream_routed(spark: SparkSession, records: DataFrame, slice_of: Column) -> DataFrame:
    """Records of four kinds in one stream, each to its own sink: (kind, id, value) of what the tables then hold.

    ``records(kind, slice, record)``: index records are inserted, checks too, listings replace, other kinds are appended.
    """
    root = stream_root(spark)
    of = {f.name: f for f in records.schema["record"].dataType}
    schemas = {
        "index": T.StructType([of[c] for c in (*INDEX_KEYS, "created_date", "link")]), "check": T.StructType([of[c] for c in ("ip", "date", "status")]),
        "listing": T.StructType([of[c] for c in ("key", "crawled_date", "link")]), "raw": T.StructType(list(of.values())),
    }

    def sink(stream: str) -> sinks.Sink:
        return sinks.route({
            "index": sinks.insert_sink(f"{root}/index", stream, schemas["index"], INDEX_KEYS, ["created_date"]),
            "check": sinks.insert_sink(f"{root}/check", stream, schemas["check"], ["ip"], ["date"]),
            "listing": sinks.listing_sink(f"{root}/listing", stream, schema=schemas["listing"]),
            "raw": sinks.append_sink(f"{root}/raw", stream),
        })

    run_slices(spark, records, slice_of, sink, root, ("a",))

    def told(kind: str, rows: DataFrame, ids: Column, value: Column) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), ids.alias("id"), value.cast("string").alias("value"))

    table = lambda kind: read_batches(spark, f"{root}/{kind}", schemas[kind])
    current = sinks.read_latest(spark, f"{root}/listing", schemas["listing"])
    parts = [
        told("index", table("index"), F.concat_ws(":", *[F.coalesce(F.col(k), F.lit("")) for k in INDEX_KEYS]), F.col("link")),
        told("check", table("check"), F.col("ip"), F.col("status")),
        told("listing", current, F.col("key"), F.col("link")),
        told("raw", table("raw"), F.col("ip"), F.col("status")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
