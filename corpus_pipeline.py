"""Training-corpus pipeline: five stages over ``documents``, each written and read again.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with
their columns, whatever their number; the last one returns their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.llm import langid, toxicity
from brickyard.llm.byte_bpe import encode_digests
from brickyard.llm.decontam import contamination
from brickyard.llm.ngram_join import jaccard_components
from brickyard.llm.queries import remainder, table, vocabulary
from brickyard.llm.token_output import fresh_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letter in it) go."""
    profiles = langid.train(langid.training_rows(docs, remainder(docs, 4) != 2, "lang", "text", "doc_id"))
    placed = langid.identify(docs, profiles, carry=COLUMNS)
    return placed.filter("lang_pred <> 'und'").select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder(docs, 3) != 1)
    return toxicity.score(docs, model, carry=COLUMNS).filter(F.col("score") < toxicity.AT).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; rows that repeat it stay with it."""
    groups = jaccard_components(docs)
    gone = groups.filter("component_id <> id").select(F.col("id").alias("doc_id")).distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = found.filter("contaminated").select(F.col("id").alias("doc_id")).distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of the ids and of their decoded text."""
    coded = encode_digests(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), keep_ids=True)
    return coded.withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Neither the shingle join's closure nor byte-pair merging is within SQL; the tests hold brute force against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage's rows pass through the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = fresh_folder(spark, "corpus-pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
