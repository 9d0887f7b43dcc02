"""The training-data pipeline: each stage reads what the one before it kept.

Toxic documents go, exact copies go, one document of each group of near copies
stays, the sources are put in the order of their target weights, and the stream
is packed into sequences. Stages are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import exact_dedup, minhash, mixing, packing, toxicity
from ridgeline.llm.common import read_table, ship, write_step
from ridgeline.llm.queries import TOKENIZER, WEIGHTS, tokenizer_path

#: The network, the token ids and the schedule are not SQL: stages are tested against brute force.
ORACLE_SQL = None


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (operator 2), fitted on the labelled rows of ``documents``."""
    ship(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts (operator 9)."""
    ship(spark)
    return exact_dedup.dedup(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 6)."""
    ship(spark)
    return minhash.dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the schedule (operator 10): the files, in order of their names, are the stream."""
    ship(spark)
    return mixing.stream(docs, WEIGHTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens (operator 8), packed within stretches of the stream so that each keeps its mix."""
    ship(spark)
    try:
        docs.select("_metadata.file_name")
    except AnalysisException:  # not read from files: no order to keep
        return packing.pack(docs, tokenizer_path(TOKENIZER))
    return packing.pack(docs, tokenizer_path(TOKENIZER), stretch=F.col("_metadata.file_name"))


STAGES = [("toxicity", clean), ("exact_dedup", unique), ("near_dedup", distinct), ("source_mix", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_step(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
