"""A corpus from raw documents to packed sequences, in stages that are each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last
return the columns of `documents`.

Odd rows pass through whole. Null and empty texts are kept by every stage (a document that loses all its
lines stays, with an empty text) and become one end id each when they are packed. Null ids are kept; rows that
repeat an id and a text are one document for the near duplicates, of which one row stays, and separate rows
elsewhere. Null sources are a source of their own. Texts of any length are read whole. Further columns,
whatever their names, are carried as far as mixing. Empty tables give empty results.
"""

from pyspark.sql import DataFrame, SparkSession

from clickmill.llm import line_dedup, mixing, ngram_join, packing, toxicity
from clickmill.llm.common import documents, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity model rejects."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that repeat in windows of three; a text may become empty, its document stays."""
    return line_dedup.shortened(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every document as often as its source's target asks; repeats are equal rows."""
    return mixing.emit(mixing.mix(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1024."""
    return packing.pack(docs, packing.public_vocabulary())


STAGES = [
    ("toxicity", toxic),
    ("line dedup", repeated_lines),
    ("near duplicates", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None  # learned scores and a tokenizer's ids have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, on the documents of `sf_dir`."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
