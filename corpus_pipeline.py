"""The corpus pipeline: documents through five stages, each reading what the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import Vocabulary, build_lexicon, encode
from ledgerlake.llm.common import read_table, scratch_table
from ledgerlake.llm.lines import line_rows
from ledgerlake.llm.mixing import sample_mixed
from ledgerlake.llm.queries import tokenizer_path
from ledgerlake.llm.simhash import keep_one_per_group
from ledgerlake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted to the labels, calls toxic go."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated lines and runs of lines go; a document keeps its row, and n_chars follows its text."""
    done = line_rows(docs)
    changed = F.col("_lines.n_removed") > 0
    columns = {"text": F.when(changed, F.col("_lines.text")).otherwise(F.col("r.text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("_lines.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("r.n_chars"))
    return done.select(*[(columns[c] if c in columns else F.col("r").getField(c)).alias(c) for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    return keep_one_per_group(docs, shingle=4, distance=4)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that token shares of sources, languages and topics meet their targets."""
    return sample_mixed(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, text, ids and n_tokens of every document."""
    vocabulary = Vocabulary.load(tokenizer_path())
    out = encode(docs, vocabulary, build_lexicon(docs, vocabulary))
    return out.select("doc_id", "source", "lang", "text", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_near_dedup),
    ("mixing", mix_to_targets),
    ("bpe", bpe),
]

#: The first stage is a fitted model, so SQL cannot give run()'s rows; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents; each stage's result is written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = scratch_table(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
