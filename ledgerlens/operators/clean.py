"""Cleaning operators (41-51, 57b, 57c).

Every operator is a single ``select``/``withColumns`` of built-in
expressions: no UDF, no shuffle, one whole-stage-codegen span however many
rules are chained.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (COUNTRY_FROM_CITY, DEFAULT_CITY, DISPOSITION_COLLAPSE, NULL_SENTINEL,
                         SCORING_CITY_ALIASES, SCORING_CITY_REPLACEMENTS, SENTINEL_COLUMNS,
                         STRING_CAST_COLUMNS, TRAIN_CITY_ALIASES, TRAIN_CITY_REPLACEMENTS)
from ..functions import text as T


def fill_sentinel(df: DataFrame, columns: Sequence[str] = SENTINEL_COLUMNS,
                  sentinel: str = NULL_SENTINEL) -> DataFrame:
    """Null -> sentinel text in the named text columns (41)."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: T.with_sentinel(c, sentinel) for c in present})


def fill_default(df: DataFrame, column: str = "city", value: str = DEFAULT_CITY) -> DataFrame:
    """Null -> a default value in one column (42)."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def cast_to_text(df: DataFrame, columns: Sequence[str] = STRING_CAST_COLUMNS) -> DataFrame:
    """Number-like columns as text, integral numbers without ``.0`` (43)."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: T.number_text(c) for c in present})


def normalise_city(df: DataFrame, column: str = "city", rules: str = "train",
                   null_as: str | None = None,
                   replacements: Sequence[tuple[str, str]] | None = None,
                   aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Upper-case, replace, alias (44, 48, 49).  ``rules`` picks the fixed
    training or scoring rule set; explicit lists override it."""
    if rules == "train":
        repl, alias = TRAIN_CITY_REPLACEMENTS, TRAIN_CITY_ALIASES
    elif rules == "scoring":
        repl, alias = SCORING_CITY_REPLACEMENTS, SCORING_CITY_ALIASES
    else:
        raise ValueError(f"unknown rule set {rules!r}")
    repl = replacements if replacements is not None else repl
    alias = aliases if aliases is not None else alias
    return df.withColumn(column, T.normalise_city(column, repl, alias, null_as))


def apply_aliases(df: DataFrame, column: str, aliases: Mapping[str, str]) -> DataFrame:
    """Whole-value alias map only (49)."""
    return df.withColumn(column, T.alias_lookup(column, aliases))


def add_text_flags(df: DataFrame, name_col: str = "violator_name",
                   address_col: str = "mailing_address_str_name") -> DataFrame:
    """``people`` (1 = person), ``address_BOX`` and ``address_MILE`` (45-47)."""
    cols = {}
    if name_col in df.columns:
        cols["people"] = T.person_flag(name_col)
    if address_col in df.columns:
        cols["address_BOX"] = T.po_box_flag(address_col)
        cols["address_MILE"] = T.mile_flag(address_col)
    return df.withColumns(cols)


def collapse_categories(df: DataFrame, column: str = "disposition",
                        rules: Sequence[tuple[str, str]] = DISPOSITION_COLLAPSE) -> DataFrame:
    """Substring rules to canonical values; a later rule wins (50)."""
    return df.withColumn(column, T.last_rule_wins(column, rules, F.col(column)))


def country_from_city(df: DataFrame, city: str = "city", country: str = "country",
                      rules: Sequence[tuple[str, str]] = COUNTRY_FROM_CITY) -> DataFrame:
    """Country read from the city text; a later rule wins (51)."""
    return df.withColumn(country, T.last_rule_wins(city, rules, F.col(country)))


def or_columns(df: DataFrame, target: str, sources: Sequence[str], drop: bool = True) -> DataFrame:
    """Merge 0/1 dummies by logical OR (57b)."""
    merged = F.greatest(*[F.coalesce(F.col(s).cast("int"), F.lit(0)) for s in sources])
    out = df.withColumn(target, merged)
    return out.drop(*[s for s in sources if s != target]) if drop else out


def mean_of_columns(df: DataFrame, target: str, sources: Sequence[str]) -> DataFrame:
    """Row-wise mean of score columns (57c)."""
    total = sum((F.col(s) for s in sources[1:]), F.col(sources[0]))
    return df.withColumn(target, total / F.lit(float(len(sources))))
