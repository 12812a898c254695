"""From raw documents to packed training sequences, in five stages.

Each stage gets the documents that the one before kept, as a stored table, and returns
a table with the columns of `documents`; the last one returns packed pieces. Rows that
share a doc_id are kept or dropped together; documents without doc_id are not dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relay.llm import decontamination, lines, near_copies, packing, quality
from relay.llm.catalogue import word_bpe
from relay.llm.common import table
from relay.llm.sieve import without
from relay.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more; learned without the held-out labels."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out(1, 3))
    bad = quality.score(docs, labels).filter("score < 0.5 AND doc_id IS NOT NULL").select("doc_id")
    return without(docs, stage(bad, "rejected"))


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines seen before. One that consists of such lines only goes."""
    done = lines.deduplicate(docs)
    done = done.filter("n_removed = 0 OR text RLIKE '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]'")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                               .otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are near copies of each other, the one with the smallest doc_id."""
    copies = near_copies.groups(docs).filter("NOT kept").select("doc_id")
    return without(docs, stage(copies, "copies"))


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    found = decontamination.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id")
    return without(docs, stage(found, "leaks"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 ids."""
    return packing.pack(packing.cut(docs, word_bpe())).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.col("offset").cast("long").alias("offset"))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", new_lines),
    ("MinHash near-dedup", one_of_a_group),
    ("benchmark decontamination", clean_of_benchmarks),
    ("packing", packed),
]

# Latent vectors, MinHash and the tokenizer cannot be told in SQL; the stages are held
# against brute-force versions in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{number}")
    return docs
