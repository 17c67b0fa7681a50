"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Values every job here relies on. Sizing (shuffle partitions, memory) is left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # pages are large rows: batches handed to Python are bounded in bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def build_session(app: str = "dwellframe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session without that setting gets a temporary folder of its own; a cluster
    session without it is refused, since a machine-local folder would not survive an executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dwellframe-"))
    return spark.sparkContext.getCheckpointDir()


_staged: list[str] = []


def new_staged(spark: SparkSession, name: str = "staged") -> str:
    """A folder for a staged table, known to :func:`drop_staged` and :func:`staging`."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def staged() -> list[str]:
    """The tables staged and not dropped yet, oldest first."""
    return list(_staged)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once under the scratch folder and read it back.

    Cuts the lineage and pins values that a recomputation might not repeat (partition numbers,
    clock readings), so several consumers see one and the same table even when executors are lost.
    """
    path = new_staged(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written once under the scratch folder, to be read several times inside and dropped at the end.

    For rows of any number: unlike a cache it takes no memory of the executors, and no executor fetches a cached partition of
    another as a whole. What is dropped is this table alone, so streams in several threads can keep their own.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def drop_staged(spark: SparkSession, since: int = 0, keep: str | None = None) -> int:
    """Delete the tables this process has staged (since it had staged ``since``), once their readers are done. Returns how many."""
    paths, dropped = _staged[since:], 0
    _staged[since:] = [p for p in paths if p == keep]
    for path in paths:
        if path != keep:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            dropped += bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True))
    return dropped


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside is dropped at the end: for jobs that write their result before then."""
    before = len(_staged)
    try:
        yield
    finally:
        drop_staged(spark, before)
