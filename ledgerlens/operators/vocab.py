"""Vocabulary reconciliation between a training and a scoring table
(18, 20-22, 61).

A vocabulary is a DataFrame ``(attribute, value, n_left, n_right)`` built by
ONE stacked aggregation over both tables, never a Python list: distinct
values of free-text columns grow with the data.  It is materialized (a
reliable checkpoint in the cluster's checkpoint folder) because both tables
read it; its exact size then decides how it is joined back (see
``plans.joins.lookup_attributes``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import NULL_SENTINEL
from ..plans.joins import lookup_attributes
from ..session import materialize
from .profile import unpivot_as_text


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def vocabulary(left: DataFrame, right: DataFrame, attributes: Sequence[str],
               persist: bool = False) -> DataFrame:
    """Per (attribute, value): row counts in ``left`` and ``right``."""
    both = (unpivot_as_text(left, attributes).withColumn("_side", F.lit(0))
            .unionByName(unpivot_as_text(right, attributes).withColumn("_side", F.lit(1))))
    vocab = (both.filter(F.col("value").isNotNull())
             .groupBy("attribute", "value")
             .agg(F.sum(1 - F.col("_side")).alias("n_left"), F.sum("_side").alias("n_right")))
    return materialize(vocab, "vocabulary") if persist else vocab


def only_left(vocab: DataFrame) -> DataFrame:
    """Values of ``left`` that ``right`` lacks (anti-membership, 20)."""
    return vocab.filter((F.col("n_left") > 0) & (F.col("n_right") == 0)).select("attribute", "value")


def only_right(vocab: DataFrame) -> DataFrame:
    return vocab.filter((F.col("n_right") > 0) & (F.col("n_left") == 0)).select("attribute", "value")


def shared(vocab: DataFrame) -> DataFrame:
    """Values both tables have (intersection, 21)."""
    return vocab.filter((F.col("n_left") > 0) & (F.col("n_right") > 0)).select("attribute", "value")


def fold_to_shared(df: DataFrame, shared_vocab: DataFrame, attributes: Sequence[str],
                   sentinel: str = NULL_SENTINEL, hot_for=None, key: str | None = None) -> DataFrame:
    """Values not shared by both tables -> ``sentinel`` (61).

    All attributes are looked up together (``plans.joins.lookup_attributes``; ``key``: see there).
    ``hot_for()`` may supply the hot (attribute, value, rows).
    """
    found = lookup_attributes(df, shared_vocab.withColumn("_shared", F.lit(1)), attributes, "_shared", "_shared_",
                              key=key, hot=hot_for)
    folded = {a: F.when(F.col(f"_shared_{a}") == 1, F.col(a).cast("string")).otherwise(F.lit(sentinel)) for a in attributes}
    return found.withColumns(folded).drop(*[f"_shared_{a}" for a in attributes])


def mutual_vocab(left: DataFrame, right: DataFrame, attributes: Sequence[str],
                 sentinel: str = NULL_SENTINEL, materialize_inputs: bool = True,
                 key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Fold both tables to their shared vocabulary, both directions (61).

    Each table is read twice (vocabulary, then fold); unless the caller has
    already materialized them, they are written once so an expensive input
    plan (joins, aggregates) is not computed twice."""
    if materialize_inputs:
        left = materialize(left, "fold_left", wide=True)
        right = materialize(right, "fold_right", wide=True)
    vocab = vocabulary(left, right, attributes, persist=True)
    common = materialize(shared(vocab), "shared_vocabulary")
    # hot values (for the salted path only) from the vocabulary's counts
    return (fold_to_shared(left, common, attributes, sentinel,
                           hot_for=lambda: hot_values(vocab, attributes, "n_left"), key=key),
            fold_to_shared(right, common, attributes, sentinel,
                           hot_for=lambda: hot_values(vocab, attributes, "n_right"), key=key))


def hot_values(vocab: DataFrame, attributes: Sequence[str], side: str = "n_left",
               partitions: int | None = None) -> list[tuple]:
    """(attribute, value, rows) of the values that hold more than half a task's share of one table's
    (row, attribute) pairs, read from the vocabulary's counts (no pass over the rows).  At most
    ``2 * partitions`` values can pass."""
    parts = partitions or int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sub = vocab.filter(F.col("attribute").isin(list(attributes)))
    total = sub.agg(F.sum(side)).first()[0] or 0
    threshold = max(total // (2 * parts), 1)
    return [tuple(r) for r in sub.filter(F.col(side) > threshold).select("attribute", "value", side).collect()]
