"""Corpus pipeline: documents that are not toxic, one of each group of near copies, without benchmark
passages, with secrets masked, encoded for training.

Each stage reads all rows that the one before kept and returns the columns of ``documents``; the last one
returns the encoded texts. ``run`` writes each stage's rows below the shared checkpoint folder and reads them
again, so a lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellframe.llm import decontaminate, ngram_jaccard, pieces, secrets, toxicity
from dwellframe.llm.common import documents, remainder, stage
from dwellframe.llm.queries import PIECE_MODEL, SECRET_VOCABULARY, vocabulary
from dwellframe.session import drop_staged, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored 0.7 or more go. Learned from labels of ids outside the hold-out; no labels: seed words alone."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, labels, remainder("doc_id", 3) != 1))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts with Jaccard similarity 0.75 or more the row with the least id stays."""
    return ngram_jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows holding a window of ten words of a benchmark item (or a whole shorter item) go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay; secrets in their texts become ``[secret]``, and n_chars follows the new text."""
    masked = secrets.redact(docs, vocabulary(SECRET_VOCABULARY))
    if "n_chars" not in docs.columns:
        return masked
    n_chars = F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", n_chars).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (end id last), n_tokens and the two digests of each row, in training form."""
    made = pieces.encode_texts(docs, vocabulary(PIECE_MODEL))
    return made.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), pieces.sha256_of_ids("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic), ("ngram_jaccard", keep_one_of_each), ("decontaminate", drop_contaminated), ("secrets", mask_secrets), ("pieces", encode),
]

#: A learned grammar, an automaton and a tokenizer are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. Each stage's tables are dropped once its result is written, but for that result, and
    the result once the next stage has read it; the last one's input stays for the returned rows."""
    docs, before = documents(spark, sf_dir), len(staged())
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        drop_staged(spark, before, keep=staged()[-1])
    return STAGES[-1][1](spark, docs, sf_dir)
