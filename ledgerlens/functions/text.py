"""Text column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (MILE_PATTERN, NULL_SENTINEL, ORGANISATION_PATTERNS, PO_BOX_PATTERN)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


_REGEX_META = set(".^$*+?()[]{}|\\")


def any_pattern(c: str | Column, patterns: Sequence[str]) -> Column:
    """True when any regex matches anywhere in the text.

    Patterns without regex syntax are plain substring tests (a fast literal
    search); the others are ``rlike`` with ``(?d)`` so that only ``\n``
    ends a line and ``.`` matches ``\r`` as Python's ``re`` does.  The tests
    are OR-ed in one expression, which stops at the first hit.
    """
    text = _col(c)
    tests = [text.contains(p) if not (set(p) & _REGEX_META) else text.rlike("(?d)" + p)
             for p in patterns]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def pattern_flag(c: str | Column, pattern: str) -> Column:
    """1 when the regex matches, else 0 (null text counts as no match)."""
    return F.when(F.coalesce(_col(c).rlike(pattern), F.lit(False)), 1).otherwise(0)


def person_flag(c: str | Column, patterns: Sequence[str] = ORGANISATION_PATTERNS) -> Column:
    """1 for a person, 0 when any organisation pattern matches the name."""
    hit = F.coalesce(any_pattern(c, patterns), F.lit(False))
    return F.when(hit, 0).otherwise(1)


def po_box_flag(c: str | Column) -> Column:
    return pattern_flag(c, PO_BOX_PATTERN)


def mile_flag(c: str | Column) -> Column:
    return pattern_flag(c, MILE_PATTERN)


def replace_chain(c: str | Column, rules: Sequence[tuple[str, str]], regex: bool = False) -> Column:
    """Apply ordered replacements as one nested expression.

    Literal by default (``replace``); ``regex=True`` uses ``regexp_replace``.
    """
    def step(acc: Column, rule: tuple[str, str]) -> Column:
        old, new = rule
        if regex:
            return F.regexp_replace(acc, old, new)
        return F.replace(acc, F.lit(old), F.lit(new))
    return reduce(step, rules, _col(c))


def alias_lookup(c: str | Column, aliases: Mapping[str, str]) -> Column:
    """Whole-value alias map as a literal map: no join, no shuffle."""
    if not aliases:
        return _col(c)
    pairs = [x for k, v in aliases.items() for x in (F.lit(k), F.lit(v))]
    mapped = F.try_element_at(F.create_map(*pairs), _col(c))
    return F.when(_col(c).isNull(), _col(c)).otherwise(F.coalesce(mapped, _col(c)))


def normalise_city(c: str | Column, replacements: Sequence[tuple[str, str]],
                   aliases: Mapping[str, str], null_as: str | None = None) -> Column:
    """Upper-case, ordered literal replacements, then whole-value aliases.

    ``null_as`` gives null cities a text (the original turns them into
    ``'nan'`` when it casts to text); the default keeps them null.
    """
    up = F.upper(_col(c))
    if null_as is not None:
        up = F.coalesce(up, F.lit(null_as))
    return alias_lookup(replace_chain(up, replacements), aliases)


def last_rule_wins(c: str | Column, rules: Sequence[tuple[str, str]], base: Column) -> Column:
    """``when(contains(p), v)`` per rule, folded so that a later rule wins
    over an earlier one, as sequential overwrites do."""
    text = _col(c)
    return reduce(lambda acc, r: F.when(F.coalesce(text.contains(r[0]), F.lit(False)),
                                        F.lit(r[1])).otherwise(acc), rules, base)


def with_sentinel(c: str | Column, sentinel: str = NULL_SENTINEL) -> Column:
    return F.coalesce(_col(c), F.lit(sentinel))


def number_text(c: str | Column) -> Column:
    """Number-like value as text: integral doubles lose the ``.0`` or exponent
    (``12.0`` -> ``12``, ``1.2345678E7`` -> ``12345678``), other text is kept,
    so the same house number read as int in one table and float in the other
    gets one spelling."""
    text = _col(c).cast("string")
    floating = text.rlike(r"^-?[0-9]+(\.0+|(\.[0-9]+)?[eE]\+?[0-9]+)$")
    exact = F.when(floating, text).try_cast("decimal(38,10)")
    whole = F.floor(exact)
    return F.coalesce(F.when(exact == whole, whole.cast("string")), text)
