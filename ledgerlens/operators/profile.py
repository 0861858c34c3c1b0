"""Profiling operators (23-35): null counts, rates by attribute, describe,
histograms, box-plot summaries, category drift, target prior.

Scale notes
-----------
* Many attributes are profiled in ONE pass: the attributes are unpivoted
  (``stack``) into ``(attribute, value)`` rows and aggregated once.  The
  partial aggregate runs before the shuffle, so a hot value (one city with a
  third of the rows) is pre-summed on every mapper and crosses the network
  as one row per mapper.
* Quantiles are exact by repeated counting in shrinking ranges
  (``plans.selection``): no value is sorted or shuffled, and no group sits in
  one task.  The ranges are held by the driver; with more groups than that
  allows, rows are reduced to a ``(group, value, count)`` frequency table and
  positions come from a range-partitioned ranking (``plans.ranking``).
* Means are plain double means unless the caller states the number of
  decimals (see ``functions.numeric``); nothing is rounded here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import HISTOGRAM_BINS
from ..functions.numeric import exact_mean
from ..plans import selection
from ..plans.ranking import ordered_positions
from ..session import materialize


def unpivot_as_text(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = (),
                    name: str = "attribute", value: str = "value") -> DataFrame:
    """(ids..., attribute, value-as-text) rows, one per input row and column."""
    casted = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns])
    return casted.unpivot(list(ids), list(columns), name, value)


# --------------------------------------------------------------------------- 23
def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count): every column counted in one aggregate."""
    cols = list(columns or df.columns)
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c)
                      for c in cols])
    return counts.unpivot([], cols, "column_name", "null_count")


# --------------------------------------------------------------------------- 24
def conditional_rate(df: DataFrame, condition: Column, target: str = "compliance") -> DataFrame:
    """Mean target (and row count) over rows meeting ``condition``."""
    sub = df.filter(condition)
    return sub.agg(F.avg(F.col(target)).alias("rate"), F.count(F.col(target)).alias("n"))


# --------------------------------------------------------------------------- 25-27
def rate_by(df: DataFrame, attribute: str, target: str = "compliance") -> DataFrame:
    """Mean target and count per value, highest rate first (null values are
    not a group, as in a pandas group-by)."""
    return (df.filter(F.col(attribute).isNotNull())
            .groupBy(attribute)
            .agg(F.avg(F.col(target)).alias("rate"), F.count(F.col(target)).alias("n"))
            .orderBy(F.desc("rate"), F.asc(attribute)))


def rate_by_attributes(df: DataFrame, attributes: Sequence[str],
                       target: str = "compliance") -> DataFrame:
    """``rate_by`` for many attributes in one pass (one shuffle)."""
    long = unpivot_as_text(df, attributes, ids=[target])
    return (long.filter(F.col("value").isNotNull())
            .groupBy("attribute", "value")
            .agg(F.avg(F.col(target)).alias("rate"), F.count(F.col(target)).alias("n"))
            .orderBy("attribute", F.desc("rate"), "value"))


def rate_by_sets(df: DataFrame, sets: Sequence[Sequence[str]], target: str = "compliance") -> DataFrame:
    """(grouping, value, rate, n): mean target and count per value of each attribute or combination of attributes
    (``sets``), in one Expand and one aggregate.  ``grouping`` names the attributes and ``value`` their values as text,
    joined by " * "; a combination with a null value is no group."""
    columns = sorted({c for s in sets for c in s})
    found = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().alias("_set"), F.avg(F.col(target)).alias("rate"), F.count(F.col(target)).alias("n"))
    name = value = F.lit(None).cast("string")
    for s in sets:
        # bit i from the right: the i-th column from the end is not in the set
        this = F.col("_set") == sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s)
        name = F.when(this, F.lit(" * ".join(s))).otherwise(name)
        joined = [x for c in s for x in (F.lit(" * "), F.col(c).cast("string"))][1:]
        value = F.when(this, F.concat(*joined)).otherwise(value)
    return found.select(name.alias("grouping"), value.alias("value"), "rate", "n").filter(F.col("value").isNotNull())


def frequency_by(df: DataFrame, attribute: str, measure: str, scale: int | None = None) -> DataFrame:
    """Mean of ``measure`` and count per value, most frequent first."""
    return (df.filter(F.col(attribute).isNotNull())
            .groupBy(attribute)
            .agg(exact_mean(measure, scale).alias("mean"), F.count(F.col(measure)).alias("n"))
            .orderBy(F.desc("n"), F.asc(attribute)))


# --------------------------------------------------------------------------- 28, 30, 32
def value_frequencies(df: DataFrame, value: str, groups: Sequence[str]) -> DataFrame:
    """``(groups..., value, _cnt)``: the only pass over the raw rows that
    describe / quantiles need (partial aggregation before the shuffle),
    materialized because everything after reads it several times."""
    freq = (df.filter(F.col(value).isNotNull())
            .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_cnt")))
    return materialize(freq, "value_frequencies")


def quantiles_from_frequencies(freq: DataFrame, value: str, groups: Sequence[str],
                               probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolation quantiles from a frequency table."""
    g = list(groups)
    ranked = ordered_positions(freq, g, value, weight="_cnt", input_materialized=True)
    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [
            F.max(F.when((F.col("_start") <= lo) & (lo <= F.col("_end")), F.col(value))).alias(f"_lo{i}"),
            F.max(F.when((F.col("_start") <= hi) & (hi <= F.col("_end")), F.col(value))).alias(f"_hi{i}"),
            F.max(pos - lo).alias(f"_fr{i}"),
        ]
    out = ranked.groupBy(*g).agg(*aggs)
    return out.select(*g, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_fr{i}")).alias(f"q{i}")
        for i in range(len(probs))])


# Groups whose quantiles are found by counting at most; the driver holds a few ranges for each.  More groups take
# the frequency table.
MOST_COUNTED_GROUPS = 2_000


def _summaries(df: DataFrame, value: str, groups: Sequence[str], probs: Sequence[float],
               scale: int | None) -> tuple[list[tuple], DataFrame] | None:
    """(group values..., count, mean, std, min, max, quantiles...) of each group and the groups' rows, or None if
    there are more than ``MOST_COUNTED_GROUPS``.  Null groups, null and NaN values are left out."""
    g = list(groups)
    data = df.select(*g, selection.number(value).alias("_v"), F.col(value).alias("_raw")).dropna(subset=["_v", *g])
    data = materialize(data, "values", wide=True)  # read once a pass; a narrow copy, no shuffle
    mean = F.avg("_v") if scale is None else exact_mean("_raw", scale)
    moments = data.groupBy(*g).agg(F.count("_v").alias("n"), mean.alias("mean"), F.stddev_samp("_v").alias("std"),
                                   F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    rows = moments.limit(MOST_COUNTED_GROUPS + 1).collect()
    if len(rows) > MOST_COUNTED_GROUPS:
        return None
    rows = [r for r in rows if r["n"]]
    key = lambda r: tuple(r[c] for c in g)
    places = {key(r): selection.quantile_ranks(r["n"], probs) for r in rows}
    ranks = {k: sorted({r for p in ps for r in p[:2]}) for k, ps in places.items()}
    found = selection.select_ranks(data, "_v", g, ranks, {key(r): (r["n"], r["lo"], r["hi"]) for r in rows})
    out = [(*key(r), r["n"], r["mean"], r["std"], r["lo"], r["hi"],
            *selection.interpolated(found[key(r)], places[key(r)])) for r in rows]
    return out, data


def grouped_quantiles(df: DataFrame, value: str, groups: Sequence[str],
                      probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per group.

    Returns groups + ``q0..qk`` columns; no group's rows or distinct values sit
    in one task.  Null groups and null or NaN values are left out.
    """
    g = list(groups)
    found = _summaries(df, value, g, probs, None)
    if found is None:
        known = df.filter(selection.number(value).isNotNull())
        return quantiles_from_frequencies(value_frequencies(known, value, g), value, g, probs)
    rows, data = found
    schema = T.StructType([data.schema[c] for c in g] + [T.StructField(f"q{i}", T.DoubleType()) for i in range(len(probs))])
    return df.sparkSession.createDataFrame([(*r[:len(g)], *r[len(g) + 5:]) for r in rows], schema)


def describe_numeric(df: DataFrame, value: str, groups: Sequence[str] = (),
                     scale: int | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max — per group.

    One aggregate and the counting passes of the quantiles.  With ``scale`` the
    mean is the exact one of amounts with so many decimals (decimal sum).  Null
    and NaN are no values; without groups and values there is one row of count 0.
    """
    g = list(groups)
    kind = df.schema[value].dataType
    found = _summaries(df, value, g, [0.25, 0.5, 0.75], scale)
    if found is None:
        return _describe_by_frequencies(df.filter(selection.number(value).isNotNull()), value, g, scale)
    rows, data = found
    rows = rows or ([] if g else [(0, *[None] * 7)])
    names = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    schema = T.StructType([data.schema[c] for c in g] + [
        T.StructField(n, T.LongType() if n == "count" else T.DoubleType()) for n in names])
    out = df.sparkSession.createDataFrame(
        [(*r[:len(g) + 3], r[len(g) + 3], *r[len(g) + 5:], r[len(g) + 4]) for r in rows], schema)
    return out.withColumns({c: F.col(c).cast(kind) for c in ("min", "max")})


def _describe_by_frequencies(df: DataFrame, value: str, groups: Sequence[str], scale: int | None) -> DataFrame:
    """:func:`describe_numeric` for any number of groups, from one frequency table; the standard deviation is the
    two-pass centred form."""
    g = list(groups)
    freq = value_frequencies(df, value, g)
    v = F.col(value).cast("double") if scale is None else F.col(value).cast(f"decimal(28,{scale})")
    moments = freq.groupBy(*g).agg(
        F.sum("_cnt").alias("count"),
        F.try_divide(F.sum(v * F.col("_cnt")).cast("double"), F.sum("_cnt").cast("double")).alias("mean"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    # one row per group on the right: the planner broadcasts it when it is small
    centred = freq.join(moments.select(*g, F.col("mean").alias("_mean")), g, "inner")
    spread = centred.groupBy(*g).agg(
        F.sum(F.col("_cnt") * (F.col(value) - F.col("_mean")) * (F.col(value) - F.col("_mean")))
        .alias("_ss"))
    qs = quantiles_from_frequencies(freq, value, g, [0.25, 0.5, 0.75])
    return (moments.join(spread, g, "inner").join(qs, g, "inner")
            .select(*g, "count", "mean",
                    F.sqrt(F.try_divide(F.col("_ss"), (F.col("count") - 1).cast("double"))).alias("std"),
                    "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max"))


def boxplot_summary(df: DataFrame, value: str, slice_col: str = "slice") -> DataFrame:
    """min, q1, median, q3, max per slice (whiskers at the range)."""
    qs = grouped_quantiles(df, value, [slice_col], [0.0, 0.25, 0.5, 0.75, 1.0])
    return qs.select(slice_col, *[F.col(f"q{i}").alias(n) for i, n in
                                  enumerate(["lo", "q1", "median", "q3", "hi"])])


def tag_slices(df: DataFrame, slices: Sequence[tuple[str, Column]],
               slice_col: str = "slice") -> DataFrame:
    """One output row per (row, slice it belongs to), in a single scan: a
    row may be in several slices (compliant AND undated)."""
    tags = F.array(*[F.when(cond, F.lit(name)) for name, cond in slices])
    return (df.withColumn(slice_col, F.explode(F.filter(tags, lambda t: t.isNotNull()))))


# --------------------------------------------------------------------------- 29
def describe_categorical(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """count, unique, top, freq per attribute (ties for top: smallest value)."""
    long = unpivot_as_text(df, attributes).filter(F.col("value").isNotNull())
    freq = long.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("cnt"))
    return freq.groupBy("attribute").agg(
        F.sum("cnt").alias("count"),
        F.count("value").alias("unique"),
        F.min_by("value", F.struct((-F.col("cnt")).alias("c"), F.col("value").alias("v"))).alias("top"),
        F.max("cnt").alias("freq"))


# --------------------------------------------------------------------------- 31
def histogram(df: DataFrame, value: str, groups: Sequence[str] = (),
              bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over [min, max] of each group, last bin closed.

    The bounds come from a grouped aggregate joined back by group key: one
    row per group, so the planner broadcasts them when the groups are few
    and splits hot groups of a shuffle join otherwise.
    """
    g = list(groups)
    data = df.filter(F.col(value).isNotNull())
    if not g:
        data = data.withColumn("_all", F.lit(1))
        g = ["_all"]
    bounds = data.groupBy(*g).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    joined = data.select(*g, value).join(bounds, g, "inner")
    width = F.col("_mx") - F.col("_mn")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("_mn")) * F.lit(float(bins)) / width),
                F.lit(bins - 1)))
    counted = (joined.withColumn("bin", b.cast("int"))
               .groupBy(*g, "bin", "_mn", "_mx").agg(F.count(F.lit(1)).alias("n")))
    out = counted.select(
        *g, "bin",
        (F.col("_mn") + (F.col("_mx") - F.col("_mn")) * F.col("bin") / F.lit(float(bins))).alias("lower"),
        (F.col("_mn") + (F.col("_mx") - F.col("_mn")) * (F.col("bin") + 1)
         / F.lit(float(bins))).alias("upper"),
        "n")
    return out.drop("_all") if "_all" in out.columns else out


# --------------------------------------------------------------------------- 33-34
def category_drift(left: DataFrame, right: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Per attribute: share of ``left`` rows whose value never occurs in
    ``right`` and the reverse.  Null is a value of its own.

    One stacked aggregation over both tables gives per-value row counts on
    each side; the ratios follow from those counts, with no join back to the
    rows.
    """
    both = (unpivot_as_text(left, attributes).withColumn("_side", F.lit(0))
            .unionByName(unpivot_as_text(right, attributes).withColumn("_side", F.lit(1))))
    per_value = both.groupBy("attribute", "value").agg(
        F.sum(1 - F.col("_side")).alias("n_left"), F.sum("_side").alias("n_right"))
    return per_value.groupBy("attribute").agg(
        F.try_divide(F.sum(F.when(F.col("n_right") == 0, F.col("n_left")).otherwise(0)).cast("double"),
                     F.sum("n_left").cast("double")).alias("left_only_ratio"),
        F.try_divide(F.sum(F.when(F.col("n_left") == 0, F.col("n_right")).otherwise(0)).cast("double"),
                     F.sum("n_right").cast("double")).alias("right_only_ratio"))


# --------------------------------------------------------------------------- 35
def target_prior(df: DataFrame, target: str = "compliance") -> DataFrame:
    return df.agg(F.avg(F.col(target)).alias("prior"), F.count(F.col(target)).alias("n"))
