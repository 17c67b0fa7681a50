import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that results, or the operators themselves, use too
    T.StructField("score", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("class", T.StringType()), T.StructField("block", T.StringType()),
])


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows, with clashing extra columns, in several partitions."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", None, "x", "y", "z", None) for r in rows]
        return spark.createDataFrame(full, DOCUMENT).repartition(3)

    return make


def odd_texts():
    """Null, empty, blank, repeated, very long and strange texts; null and repeated ids."""
    words = [f"w{i % 977}x{i % 31}" for i in range(30_000)]
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "a b c d"), (7, "a b c d e"), (8, "a b c d e f"),
        (None, "a b c d e f"), (None, None), (9, " ".join(words)), (10, " ".join(words[:29_900])), (11, "x" * 50_000),
        (12, "Ünïcode ÄÖ ▁under▁   line \x1c sep \x85 next \U0001f600 end"), (13, "  double  spaced  \n\n lines \n\n"),
        (14, "\x00 nul \x00"), (15, "same same same same same same same same"), (16, "  double  spaced  \n\n lines \n\n"),
    ]
