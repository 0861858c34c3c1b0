"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DAY_PARTS, SENTINEL_DATE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Text -> ``timestamp_ntz``; unparsable text gives null (ANSI-safe)."""
    parsed = F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))
    return parsed.cast("timestamp_ntz")


def interval_between(end: str | Column, start: str | Column) -> Column:
    """``end - start`` as a day-time interval."""
    return _col(end) - _col(start)


def seconds_between(end: str | Column, start: str | Column) -> Column:
    """Whole seconds from ``start`` to ``end``; fractions of a second of
    either side are ignored, as in a day/hour/minute/second difference."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", _col(start)),
                           F.date_trunc("second", _col(end)))


def sentinel_date(c: str | Column, sentinel: str = SENTINEL_DATE) -> Column:
    """Null date -> a far-past sentinel (kept as an option; the operators
    branch on ``isNull`` instead)."""
    return F.coalesce(_col(c), F.lit(sentinel).cast("timestamp_ntz"))


def calendar_parts(c: str | Column, prefix: str = "") -> list[Column]:
    """year, month, weekday (Monday = 0) and hour of a timestamp."""
    ts = _col(c)
    return [F.year(ts).alias(f"{prefix}year"), F.month(ts).alias(f"{prefix}month"),
            F.weekday(ts).alias(f"{prefix}weekday"), F.hour(ts).alias(f"{prefix}hour")]


def day_part_flags(c: str | Column) -> list[Column]:
    """Boolean day-part columns from the hour of a timestamp."""
    h = F.hour(_col(c))
    return [((h >= lo) & (h < hi)).alias(name) for name, lo, hi in DAY_PARTS]
