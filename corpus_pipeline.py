"""The corpus pipeline: quality rules, near duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller
writes it as Parquet and reads it again as the next stage's docs. All
but the last stage return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import packing, pii, quality, simhash, substring
from wakeline.llm.common import delete_folder, scratch_folder, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the learned rules keep.

    Null and empty texts fail the base limits; equal rows stay or go together; an empty table gives no rows.
    """
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by a Jaccard similarity of five-word shingles of 0.8 or more.

    Rows with a null doc_id stay; rows that share one are one document; texts without a word are one group.
    """
    return simhash.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document, or their own text before, holds.

    Rows with a null doc_id or text stay as they are; a document that is left without a word goes.
    """
    return substring.drop_passages(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data; a null text stays null."""
    return pii.replace_entities(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, a row for each; a null text is one piece of the end id."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: Tokens and fingerprints have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    Between stages the rows are written to the session's checkpoint folder and
    read again; a stage's rows are deleted once the next one's are written, the last ones
    with the application's checkpoints when the driver's JVM ends.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, last = None, None
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        folder = folder or scratch_folder(spark, "pipeline")
        docs = written(out, f"{folder}/{name}")
        if last:
            delete_folder(spark, last)
        last = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
