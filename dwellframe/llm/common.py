"""Shared pieces of the corpus operators: hold-out remainders, text workers, staged tables, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.session import new_staged

#: Texts handed to a worker function at once, in bytes; one longer text forms a batch of its own.
BATCH_BYTES = 1 << 20


#: Bytes of an Arrow batch between the JVM and Python; without a limit, 10,000 rows however long they are.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session in bytes, unless it says how itself."""
    if spark.conf.get(ARROW_BYTES[0], None) is None:
        spark.conf.set(*ARROW_BYTES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table below the shared checkpoint folder and read it back.

    The lineage ends there, so lost executors cost no recomputation and values are pinned. ``session.staging`` and
    ``session.drop_staged`` drop such tables.
    """
    spark, path = df.sparkSession, new_staged(df.sparkSession, name)
    bound_batches(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: int, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` of about ``limit`` bytes in the given text column."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for row, n in enumerate(size.tolist()):
        if held and held + n > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str | None]], Sequence]],
    fields: list[T.StructField],
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: the kept columns and ``fields`` computed from the text column.

    ``make`` runs once per task and returns the function from a list of texts to one list (or Arrow
    array) per field. Other columns of ``docs`` are not read, so their names cannot clash.
    """
    bound_batches(docs.sparkSession)
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, work = to_arrow_schema(schema), make()
        n = len(kept)
        for batch in batches:
            for part in slices(batch, n):
                made = work(part.column(n).to_pylist())
                columns = [
                    x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type)
                    for x, f in zip([*part.columns[:n], *made], out, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    return docs.select(*(F.col(c).alias(f"c{k}") for k, c in enumerate(keep)), F.col(text).alias("text")).mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents, the first in the order of a hash of their id.

    Only rows with ``train`` true and a non-null label and id take part. A repeated id counts once, with its largest
    label and, of several texts, the first by bytes. The ids chosen are at most ``rows`` long integers, so they are broadcast.
    """
    chosen = (
        labels.filter(train & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("__doc"), F.col("text"))
    found = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
    return found.groupBy("__id", "y").agg(F.min("text").alias("text")).select("text", "y")


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (A-Z lower-cased, cut at ASCII white space), and each text's place in them."""
    import pandas as pd

    cut = [t.encode().lower().split() if t else [] for t in texts.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in cut])]).astype(np.int64)
    distinct = pa.array([w for words in cut for w in words], pa.large_binary()).dictionary_encode()
    hashed = pd.util.hash_array(distinct.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return hashed[distinct.indices.to_numpy()] if offsets[-1] else np.zeros(0, np.uint64), offsets


def mix(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close values apart."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))
