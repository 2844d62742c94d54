"""Queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.align import aligned_corpus, load_tokenizers
from ledgerlake.llm.bpe import Vocabulary, build_lexicon, round_trip_digests
from ledgerlake.llm.chat import chat_digests, format_chat
from ledgerlake.llm.common import read_table
from ledgerlake.llm.html_density import extract_main_text
from ledgerlake.llm.licenses import license_digest, scan_licenses
from ledgerlake.llm.lines import line_dedup, line_digest
from ledgerlake.llm.mixing import KEEP, mix
from ledgerlake.llm.oracle import ORACLE_SQL
from ledgerlake.llm.pq_dedup import embedding_near_dedup
from ledgerlake.llm.runs import collapse_runs, run_digest, with_planted_runs
from ledgerlake.llm.simhash import simhash_dedup
from ledgerlake.llm.substring import kept_digest, substring_dedup
from ledgerlake.llm.topk import exact_top_k
from ledgerlake.llm.toxicity import toxicity

__all__ = ["ORACLE_SQL", "QUERIES", "tokenizer_path"]

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), cosine=0.9)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    vocabulary = Vocabulary.load(tokenizer_path())
    return round_trip_digests(docs, vocabulary, build_lexicon(docs, vocabulary))


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_main_text(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digest(substring_dedup(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), window=20))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), shingle=4, distance=4)


def op6_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"]), keep=KEEP)
    return mixed.select("doc_id", "source", "lang", F.expr("substr(topic_mix, 2)").alias("topic"), F.col("w_mix").alias("weight"), F.col("p_mix").alias("probability"), F.col("kept_mix").alias("kept"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(line_dedup(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), min_words=5))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return chat_digests(format_chat(turns.unionByName(extra)))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), k=5, every=50, scale=256, by_row=True)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents", ["doc_id", "text"]), read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return toxicity(docs, labels).drop("offending")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return run_digest(collapse_runs(docs, min_length=24, min_exponent=3))


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizers = load_tokenizers(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return aligned_corpus(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), tokenizers, hashed=True).withColumnRenamed("groups", "groups_sha256")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(scan_licenses(read_table(spark, sf_dir, "documents", ["doc_id", "text"])))


QUERIES: dict[str, Query] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_html_main_text": op3_html_main_text,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_mix_to_targets": op6_mix_to_targets,
    "op7_line_dedup": op7_line_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_align_tokenizers": op12_align_tokenizers,
    "op13_license_scan": op13_license_scan,
}
