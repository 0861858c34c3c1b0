"""Exact quantiles by repeated counting, without sorting or shuffling values.

The value at a rank is looked for in a range that starts as its group's minimum
to maximum.  A pass counts, for every range, its values in equal bins, with
each bin's smallest and largest value; the bin that holds the rank is the next
range.  Counts are combined before the shuffle, so a pass shuffles at most
ranges x bins rows for each task, however many rows or distinct values there
are, and every pass narrows a range by about the number of bins.  A range's
ends are values that occur and lie in different bins, so each pass gets on,
whatever the distribution; it ends when a range is a single value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bins of a range: as many as fit the counts that the driver takes in a pass, in these limits.
COUNTS_A_PASS, FEWEST_BINS, MOST_BINS = 400_000, 64, 4096
WIDE = 1e4  # ranges whose ends differ by more than this factor are binned by logarithm


def number(value: str | Column) -> Column:
    """The value as a double; null for NaN."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(~F.isnan(v), v)


def _shape(lo: float, hi: float, bins: int) -> tuple[float, float, float]:
    """How a range, lo < hi, is cut: (unit of the logarithm or 0 for equal steps, place of ``lo`` on that scale, bins to a
    unit of it or 0 if its width can't be written: then all values between the ends share a bin)."""
    big, small = max(abs(lo), abs(hi)), min(abs(lo), abs(hi))
    near = big / (WIDE * WIDE) if math.isfinite(big) and (lo < 0 < hi or big > small * WIDE) else 0.0
    place = (lambda v: math.copysign(math.log1p(abs(v) / near), v)) if near > 0 else (lambda v: v / 2)
    width = place(hi) - place(lo)
    steps = bins / width if width > 0 and math.isfinite(width) else 0.0
    return near, place(lo), steps if math.isfinite(steps) else 0.0


def _bin(v: Column, bins: int) -> Column:
    """Bin of ``v`` in its range's shape: never falling in ``v``, 0 at the lower end and the last at the upper."""
    near, start, steps = F.col("_near"), F.col("_start"), F.col("_steps")
    at = F.when(near > 0, F.signum(v) * F.log1p(F.abs(v) / near)).otherwise(v / 2)
    place = F.when(steps > 0, F.least(F.greatest(F.floor((at - start) * steps), F.lit(0)), F.lit(bins - 1))).otherwise(F.lit(bins // 2))
    return F.when(v <= F.col("_lo"), F.lit(0)).when(v >= F.col("_hi"), F.lit(bins - 1)).otherwise(place).cast("int")


class _Target:
    """One rank (from 0) of one group, and the range its value is in with the rows below it."""

    def __init__(self, group: tuple, rank: int, lo: float, hi: float, rows: int) -> None:
        self.group, self.rank, self.below, self.rows = group, rank, 0, rows
        self.narrow(lo, hi, 0, rows)

    def narrow(self, lo: float, hi: float, below: int, rows: int) -> None:
        self.lo, self.hi, self.below, self.rows = lo, hi, below, rows
        if self.rank == below:
            self.hi = lo
        elif self.rank == below + rows - 1:
            self.lo = hi

    @property
    def open(self) -> bool:
        return self.lo < self.hi


def select_ranks(data: DataFrame, value: str, groups: Sequence[str], ranks: dict[tuple, Sequence[int]],
                 totals: dict[tuple, tuple[int, float, float]], bins: int | None = None) -> dict[tuple, dict[int, float]]:
    """The values at ``ranks`` (group -> ranks from 0, ascending order) of a column of doubles without NaN.

    ``totals``: group -> (rows, minimum, maximum).  ``data`` is scanned once a pass, two to four times as a rule; the
    driver holds a range for each rank and, a pass, at most ``bins`` counts for each range (more bins, fewer passes)."""
    g = list(groups)
    targets = [_Target(k, r, totals[k][1], totals[k][2], totals[k][0]) for k, rs in ranks.items() for r in rs]
    numbers = [T.StructField(c, T.DoubleType()) for c in ("_lo", "_hi", "_near", "_start", "_steps")]
    schema = T.StructType([data.schema[c] for c in g] + [T.StructField("_range", T.IntegerType()), *numbers])
    while any(t.open for t in targets):
        ranges: dict[tuple, int] = {}
        for t in targets:
            if t.open:
                ranges.setdefault((t.group, t.lo, t.hi), len(ranges))
        wide = bins or max(FEWEST_BINS, min(MOST_BINS, COUNTS_A_PASS // len(ranges)))
        table = data.sparkSession.createDataFrame([(*k, i, lo, hi, *_shape(lo, hi, wide)) for (k, lo, hi), i in ranges.items()], schema)
        v = F.col(value)
        inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
        met = data.select(*g, value).join(F.broadcast(table), g, "inner") if g else data.select(value).join(F.broadcast(table), inside)
        counted = (met.filter(inside).groupBy("_range", _bin(v, wide).alias("_bin"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")).collect())
        found: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: r["_bin"]):
            found.setdefault(r["_range"], []).append(r)
        for t in targets:
            if not t.open:
                continue
            below = t.below
            for r in found[ranges[t.group, t.lo, t.hi]]:
                if t.rank < below + r["n"]:
                    t.narrow(r["lo"], r["hi"], below, r["n"])
                    break
                below += r["n"]
    out: dict[tuple, dict[int, float]] = {}
    for t in targets:
        out.setdefault(t.group, {})[t.rank] = t.lo
    return out


def quantile_ranks(rows: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    """(lower rank, upper rank, share of the way) of each quantile by linear interpolation."""
    out = []
    for p in probs:
        at = (rows - 1) * float(p)
        out.append((math.floor(at), math.ceil(at), at - math.floor(at)))
    return out


def interpolated(values: dict[int, float], places: Sequence[tuple[int, int, float]]) -> list[float]:
    return [values[lo] if lo == hi else values[lo] + (values[hi] - values[lo]) * share for lo, hi, share in places]


def exact_quantiles(data: DataFrame, value: str, probs: Sequence[float], bins: int | None = None) -> list[float] | None:
    """Exact quantiles of a whole column; null and NaN are no values; None without any."""
    rows = data.select(number(value).alias("v")).filter(F.col("v").isNotNull())
    n, lo, hi = rows.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    places = quantile_ranks(n, probs)
    ranks = sorted({r for p in places for r in p[:2]})
    return interpolated(select_ranks(rows, "v", [], {(): ranks}, {(): (n, lo, hi)}, bins)[()], places)
