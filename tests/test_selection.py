"""Exact quantiles by counting against numpy, on awkward distributions."""

import numpy as np
import pytest

from ledgerlens.operators import profile
from ledgerlens.plans import selection

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def _passes(monkeypatch):
    seen = []
    plain = selection._bin
    monkeypatch.setattr(selection, "_bin", lambda *a: seen.append(1) or plain(*a))
    return seen


@pytest.mark.parametrize("kind", ["uniform", "skewed", "signed", "ties", "tiny", "single", "huge", "neighbours"])
def test_whole_column(spark, monkeypatch, kind):
    rng = np.random.default_rng(3)
    v = {"uniform": rng.uniform(0, 1e6, 5000), "skewed": np.exp(rng.normal(0, 12, 5000)), "signed": rng.standard_cauchy(5000) * 1e9,
         "ties": rng.integers(0, 4, 5000).astype(float), "tiny": rng.uniform(1e-300, 2e-300, 500), "single": np.array([7.25]),
         "huge": rng.uniform(-1.7, 1.7, 500) * 1e308, "neighbours": 1.0 + np.arange(50) * 2.0 ** -52}[kind]
    passes = _passes(monkeypatch)
    df = spark.createDataFrame([(float(x),) for x in [*v, float("nan")]] + [(None,)], "x double").repartition(4)
    got = selection.exact_quantiles(df, "x", PROBS, bins=64)
    with np.errstate(over="ignore"):
        want = [np.sort(v)[int(np.floor((len(v) - 1) * p))] if (len(v) - 1) * p % 1 == 0 else None for p in PROBS]
    order = np.sort(v)
    for p, g, w in zip(PROBS, got, want):
        at = (len(v) - 1) * p
        lo, hi = order[int(np.floor(at))], order[int(np.ceil(at))]
        assert lo <= g <= hi and (w is None or g == w), (p, g)
    assert len(passes) <= 8


def test_infinite_values_and_no_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in [-inf, 1.0, 2.0, 3.0, inf, inf]], "x double")
    assert selection.exact_quantiles(df, "x", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], bins=4) == [-inf, 1.0, 2.0, 3.0, inf, inf]
    assert selection.exact_quantiles(df.filter("x > 5 and x < 6"), "x", [0.5]) is None


def test_groups_by_counting_and_by_frequencies_agree(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(g) if g < 6 else None, float(round(x, 2))) for g, x in zip(rng.integers(0, 7, 4000), rng.normal(0, 100, 4000))]
    df = spark.createDataFrame([*rows, (9, 1.0), (10, None), (1, None)], "g int, x double")
    counted = {r["g"]: r for r in profile.describe_numeric(df, "x", ["g"]).collect()}
    boxes = {r["g"]: tuple(r) for r in profile.grouped_quantiles(df, "x", ["g"], [0.0, 0.3, 1.0]).collect()}
    monkeypatch.setattr(profile, "MOST_COUNTED_GROUPS", 3)
    listed = {r["g"]: r for r in profile.describe_numeric(df, "x", ["g"]).collect()}
    assert set(counted) == set(listed) == {0, 1, 2, 3, 4, 5, 9} and counted[9]["std"] is None
    for g, a in counted.items():
        for c, v in a.asDict().items():
            assert v == listed[g][c] or abs(v - listed[g][c]) < 1e-9, (g, c)
    assert boxes == {r["g"]: tuple(r) for r in profile.grouped_quantiles(df, "x", ["g"], [0.0, 0.3, 1.0]).collect()}


def test_describe_without_rows(spark):
    df = spark.createDataFrame([], "g int, x double")
    assert profile.describe_numeric(df, "x", ["g"]).count() == 0
    assert tuple(profile.describe_numeric(df, "x").first()) == (0, *[None] * 7)
    assert profile.boxplot_summary(df.withColumnRenamed("g", "slice"), "x").count() == 0
