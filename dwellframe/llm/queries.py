"""Registered queries of the corpus operators over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellframe.llm import chat_format, decontaminate, katz, language, ngram_jaccard, pieces, quality_gam, quality_rules
from dwellframe.llm import secrets, toxicity, turn_repair, url_rules, whitening
from dwellframe.llm.common import documents, remainder
from dwellframe.llm.oracles import ORACLES as SQL
from dwellframe.llm.oracles import url_rules_sql


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


SECRET_VOCABULARY = "byte_bpe_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"

#: (verdict, host and path) of the host rules.
HOST_RULES = url_rules.rule_list([
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
])
#: Pattern rules for URLs that no host rule fits.
PATTERNS = [
    url_rules.Pattern(*r)
    for r in [
        ("block", "||spam-farm."), ("block", "||adult-x."), ("block", "||*casino*."), ("block", "^ads^"), ("block", "^banner^"),
        ("block", "^tracker^"), ("block", "^cart^checkout^"), ("block", "^login^"), ("allow", "://blog.*^en^"),
        ("allow", "^wiki^"), ("block", "^feed.xml|"), ("block", "^wp-admin^"),
    ]
]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(documents(spark, sf_dir), vocabulary(SECRET_VOCABULARY)))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.score(katz.learn(documents(spark, sf_dir), remainder("doc_id", 5) != 1))
    return scored.select("doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.scan_benchmark(documents(spark, sf_dir), benchmark)
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def toxicity_grammar(spark: SparkSession, sf_dir: str) -> toxicity.Grammar:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.fit_toxicity(documents(spark, sf_dir), labels, remainder("doc_id", 3) != 1)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(documents(spark, sf_dir), toxicity_grammar(spark, sf_dir))
    return scored.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "n_clauses", "top_clause",
    )


def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_gam.score_quality(docs, quality_gam.fit_quality(docs, labels, remainder("doc_id", 5) != 0))
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encode_texts(documents(spark, sf_dir), vocabulary(PIECE_MODEL)))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), HOST_RULES, PATTERNS)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(documents(spark, sf_dir))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    predicted = language.predict_language(docs, language.fit_language(docs, remainder("doc_id", 3) != 1))
    return predicted.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digests(chat_format.format_chats(chat_format.with_hostile(conversations(spark, sf_dir))))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.whiten(rows, whitening.fit_whitening(rows))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.audits(turn_repair.repair_turns(turn_repair.damage(conversations(spark, sf_dir))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets, op2_katz, op3_quality_rules, op4_decontaminate, op5_toxicity, op6_quality_gam, op7_pieces, op8_url_rules,
        op9_ngram_jaccard, op10_language, op11_chat_format, op12_whitening, op13_turn_repair,
    )
}
ORACLES = {**SQL, "op8_url_rules": url_rules_sql(HOST_RULES, PATTERNS)}
