"""Reading landed data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellframe.functions.scalars import py_strip
from dwellframe.schemas import JOBS


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed, non-empty lines of UTF-8 text files in column ``value``."""
    return spark.read.text(path).select(py_strip("value").alias("value")).filter("value != ''")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages from Parquet: whatever columns were stored, at least url and html."""
    return spark.read.parquet(path)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages kept as one file each; the file's address stands in for the url.

    Bytes that are no UTF-8 become replacement characters, so one bad page cannot fail the job.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("url"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job records as JSON lines."""
    return spark.read.schema(JOBS).json(path)
