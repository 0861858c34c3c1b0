"""Cleaning of a training corpus in five stages, from ``documents`` to packed sequences.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import fuzzy_lines, packing_swap, simhash_ball, weak_toxicity, wu_manber
from ledgerlens.llm.catalog import public_tokenizer
from ledgerlens.llm.common import remainder
from ledgerlens.session import materialize
from ledgerlens.sources.tables import read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject.  It learns from labelled
    documents whose crc32(doc_id) mod 4 is not 2."""
    model = weak_toxicity.fit(docs, read_table(spark, sf_dir, "labels"), learn=remainder("doc_id", 4) != 2)
    return weak_toxicity.scored(docs, model, name="__score").filter(
        F.col("__score") < weak_toxicity.THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; those left without any line go.
    ``n_chars`` counts the characters of the new text."""
    out = fuzzy_lines.dedup_lines(docs, rule=fuzzy_lines.WIDE)
    if "n_chars" not in docs.columns:
        return out
    kind = dict(docs.dtypes)["n_chars"]
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group: the one with the smallest id."""
    return simhash_ball.keep_one_per_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    return wu_manber.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens."""
    return packing_swap.packed(docs, public_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# The first and the last stage have no SQL: learned scores and a local search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each one's result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", wide=True)
    return STAGES[-1][1](spark, docs, sf_dir)
