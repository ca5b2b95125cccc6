"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, word
sequences that an earlier document has are cut, contaminated documents go, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows of the stage before. All but the
last return the columns of `documents`; the last returns id, language, source, ids and their
number. Nulls, empty and repeated rows are handled as the operators' docstrings say; a document
whose text is cut to nothing stays with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstone.llm import bpe, decontamination, jaccard_join, substring_dedup, toxicity
from flagstone.llm.queries import table, tokenizer_path
from flagstone.sources.scratch import staged


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier chain calls toxic."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group."""
    return jaccard_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts windows of 50 words that a document of smaller id has too."""
    cut = substring_dedup.remove_repeats(docs, output="replace")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    cut = cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item or a re-parameterised one."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", contaminated),
    ("bpe", encoded),
]

ORACLE_SQL = None  # a trained classifier decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the documents, written and read again between stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
