"""Segments and splits (64, 65, 73).

Splits are functions of the ticket key, not of a random column: a lost
task recomputes exactly the same assignment, and the split needs no global
ordering.  Folds that keep the classes' shares to the row need positions in a
class; they come from the range-partitioned ranking (a per-class
``row_number`` would put a whole class in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CV_FOLDS, HOLDOUT_FRACTION, SPLIT_SEED, TRAIN_WAIVED_PATTERNS
from ..functions.numeric import unit_hash
from ..plans.ranking import ordered_positions
from .filters import contains_any

WAIVED, UNDATED, DATED = "waived", "undated", "dated"


def segment_of(disposition: str = "disposition", hearing: str = "hearing_date",
               waived_patterns: Sequence[str] = TRAIN_WAIVED_PATTERNS) -> Column:
    """waived (disposition matches) / undated (no hearing date) / dated."""
    return (F.when(contains_any(disposition, waived_patterns), F.lit(WAIVED))
            .when(F.col(hearing).isNull(), F.lit(UNDATED))
            .otherwise(F.lit(DATED)))


def with_segment(df: DataFrame, waived_patterns: Sequence[str] = TRAIN_WAIVED_PATTERNS,
                 name: str = "segment") -> DataFrame:
    return df.withColumn(name, segment_of(waived_patterns=waived_patterns))


def holdout_flag(key: str = "ticket_id", fraction: float = HOLDOUT_FRACTION,
                 seed: int = SPLIT_SEED) -> Column:
    return unit_hash(key, seed) < F.lit(fraction)


def holdout_split(df: DataFrame, key: str = "ticket_id", fraction: float = HOLDOUT_FRACTION,
                  seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """(fit part, hold-out part), about 75/25."""
    flag = holdout_flag(key, fraction, seed)
    return df.filter(~flag), df.filter(flag)


def fold_of(key: str = "ticket_id", folds: int = CV_FOLDS, seed: int = SPLIT_SEED + 1) -> Column:
    """Fold number in [0, folds) from the key."""
    return F.least(F.floor(unit_hash(key, seed) * F.lit(float(folds))).cast("int"),
                   F.lit(folds - 1))


def with_folds(df: DataFrame, key: str = "ticket_id", folds: int = CV_FOLDS,
               seed: int = SPLIT_SEED + 1, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_of(key, folds, seed))


def stratified_folds(df: DataFrame, label: str, key: str = "ticket_id", folds: int = CV_FOLDS,
                     seed: int = SPLIT_SEED + 1, name: str = "fold") -> DataFrame:
    """Labelled rows of ``df`` with a fold in [0, folds): the rows of each class in the order of their key's
    hash (equal hashes by key), dealt in turn, so folds differ by one row of a class at most.  Rows without a
    label have no class and are left out; a null key is a key like any other."""
    order = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")),
                     F.lit(":"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    placed = ordered_positions(df.filter(F.col(label).isNotNull()).withColumn("_order", order), [label], "_order")
    return placed.select(*[F.col(c) for c in df.columns if c != name], (F.col("_start") % folds).cast("int").alias(name))
