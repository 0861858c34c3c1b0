"""Property checks against brute force on small random inputs."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.operators import profile
from ledgerlens.plans import metrics

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=60))
def test_grouped_quantiles_equal_numpy(spark, rows):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g int, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(5)]
           for r in profile.grouped_quantiles(df, "x", ["g"], probs).collect()}
    for g in {g for g, _ in rows}:
        vals = np.array([v for gg, v in rows if gg == g], dtype=float)
        assert np.allclose(got[g], np.quantile(vals, probs))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=80))
def test_auc_equals_pairwise_count(spark, rows):
    labels = [y for _, y in rows]
    if len(set(labels)) < 2:
        return
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "score double, label int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(metrics.roc_auc(df).first()["auc"] - want) < 1e-12


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["HOT", "HOT", "HOT", "a", "b", "c"])),
                min_size=1, max_size=80),
       st.sets(st.sampled_from(["HOT", "a", "b", "z"]), max_size=4),
       st.sampled_from(["left", "inner"]))
def test_salted_lookup_equals_broadcast(spark, keys, lookup, how):
    from ledgerlens.plans.joins import lookup_join
    big = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string")
    small = spark.createDataFrame([(k, len(k)) for k in sorted(lookup)] or [("none", 0)],
                                  "k string, v int")
    a = sorted(lookup_join(big, small, "k", how).collect(), key=lambda r: r["id"])
    b = sorted(lookup_join(big, small, "k", how, max_broadcast_bytes=0).collect(),
               key=lambda r: r["id"])
    assert a == b
