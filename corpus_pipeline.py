"""A training corpus from raw documents: five stages, each written before the next.

Quality filter, line dedup, SimHash near-dedup, benchmark decontamination,
packing. Every stage works on all that the one before it kept; all but the last
return the columns of ``documents``. SQL can't express trained scores, rolling
hashes, components or a tokenizer, so ``ORACLE_SQL`` is None and the tests hold
the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridelake.llm import decontamination, lines, packing, quality, simhash
from ridelake.llm.common import materialize, table
from ridelake.llm.queries import tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; every document stays, with what is left of it."""
    return lines.remove_repeated_chunks(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def harmonic_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("harmonic_packing", harmonic_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
