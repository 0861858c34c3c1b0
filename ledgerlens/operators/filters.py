"""Projections and filters (operators 5-18).

All are narrow transformations: no shuffle, and Catalyst pushes the
predicates and the column pruning into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LEAKAGE_COLUMNS, SPARSE_COLUMNS
from ..functions.temporal import seconds_between


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the named columns that exist (missing names are ignored)."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present)


def drop_leakage(df: DataFrame, leakage: Sequence[str] = LEAKAGE_COLUMNS,
                 sparse: Sequence[str] = SPARSE_COLUMNS) -> DataFrame:
    return drop_columns(df, list(leakage) + list(sparse))


def select_all_but(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    keep = [c for c in df.columns if c not in set(excluded)]
    return df.select(*keep)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def labelled_rows(df: DataFrame, target: str = "compliance") -> DataFrame:
    """Rows whose target is known (null = violator not responsible)."""
    return df.filter(F.col(target).isNotNull() & ~F.isnan(F.col(target)))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def class_slice(df: DataFrame, value: float, target: str = "compliance") -> DataFrame:
    return df.filter(F.col(target) == F.lit(value))


def amount_at_most(df: DataFrame, threshold: float, column: str = "judgment_amount") -> DataFrame:
    return df.filter(F.col(column) <= F.lit(threshold))


def amount_above(df: DataFrame, threshold: float, column: str = "judgment_amount") -> DataFrame:
    return df.filter(F.col(column) > F.lit(threshold))


def with_time_to_hearing(df: DataFrame, hearing: str = "hearing_date",
                         issued: str = "ticket_issued_date",
                         name: str = "time_to_hearing") -> DataFrame:
    """Seconds from issue to hearing (null when the hearing date is null)."""
    return df.withColumn(name, seconds_between(hearing, issued))


def positive_interval(df: DataFrame, column: str = "time_to_hearing") -> DataFrame:
    return df.filter(F.col(column) > 0)


def nonpositive_interval_of_class(df: DataFrame, value: float, column: str = "time_to_hearing",
                                  target: str = "compliance") -> DataFrame:
    return df.filter((F.col(column) <= 0) & (F.col(target) == F.lit(value)))


def contains_any(column: str, substrings: Sequence[str]) -> Column:
    """Null-safe 'text contains any of the substrings'."""
    text = F.col(column)
    hits = [F.coalesce(text.contains(s), F.lit(False)) for s in substrings]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


def split_by_substring(df: DataFrame, column: str, substrings: Sequence[str]
                       ) -> tuple[DataFrame, DataFrame]:
    """(rows containing any substring, the other rows)."""
    cond = contains_any(column, substrings)
    return df.filter(cond), df.filter(~cond)


def isin_filter(df: DataFrame, column: str, values: DataFrame, value_column: str | None = None,
                keep: bool = True) -> DataFrame:
    """Membership filter against a DataFrame of values (semi / anti join:
    no value list is collected to the driver)."""
    vc = value_column or column
    vals = values.select(F.col(vc).alias(column)).distinct()
    return df.join(vals, column, "left_semi" if keep else "left_anti")
