"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes all documents that the one before kept, with all their columns, those of
clashing names too. Edge cases: a null text counts as empty everywhere; an empty or very short
text has no five words, so it is a near-duplicate of its equals alone, and it stays or goes by
its score as any other; rows with a null ``doc_id`` have no label and all stay in the near-duplicate stage, as they
cannot be told apart; of rows that repeat an id one stays there; very long texts are scored, compared
and cut whole; an empty table passes through as one, to no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folkmoot.llm import decontaminate, lines, packing, quality, simhash
from folkmoot.llm.common import discard, watched, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that no earlier document has; ``n_chars`` counts what is left."""
    kept = lines.dedup_lines(docs)
    changed = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", own_lines),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", uncontaminated),
    ("best_fit_packing", sequences),
]

#: Not expressible: a fitted network, MinHash and SimHash links, and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written before the next reads it.

    Once a stage's result is written, its working tables and the result before it are deleted; what
    is left is the input of the last stage and its own tables, which the lazy result reads.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with watched() as made:
            kept = written(stage(spark, docs, sf_dir), name)
        for table in [docs, *made]:
            if table is not kept:
                discard(table)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
