import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.operators import filters, profile
from ledgerlens.sources.ticket_view import scoring_tickets, train_tickets

from conftest import SF001


def _labelled_pdf(spark):
    return filters.labelled_rows(train_tickets(spark, SF001)).toPandas()


def test_null_profile_matches_pandas(spark, train_df):
    got = {r["column_name"]: r["null_count"] for r in profile.null_profile(train_df).collect()}
    pdf = train_df.toPandas()
    assert got == {c: int(pdf[c].isna().sum()) for c in pdf.columns}


def test_rate_by_attributes_matches_pandas_groupby(spark):
    df = filters.labelled_rows(train_tickets(spark, SF001))
    got = profile.rate_by_attributes(df, ["disposition", "city"]).toPandas()
    pdf = df.toPandas()
    for attr in ["disposition", "city"]:
        want = pdf.groupby(attr)["compliance"].agg(["mean", "count"])
        sub = got[got.attribute == attr].set_index("value")
        assert sorted(sub.index) == sorted(want.index)
        for v, row in want.iterrows():
            assert math.isclose(sub.loc[v, "rate"], row["mean"], rel_tol=1e-12)
            assert sub.loc[v, "n"] == row["count"]


def test_describe_matches_pandas(spark):
    pdf = _labelled_pdf(spark)
    got = profile.describe_numeric(filters.labelled_rows(train_tickets(spark, SF001)),
                                   "judgment_amount", ["compliance"]).toPandas()
    want = pdf.groupby("compliance")["judgment_amount"].describe()
    for _, r in got.iterrows():
        w = want.loc[r["compliance"]]
        assert r["count"] == w["count"]
        assert math.isclose(r["mean"], w["mean"], rel_tol=1e-12)
        assert math.isclose(r["std"], w["std"], abs_tol=1e-3)
        for a, b in [("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert math.isclose(r[a], w[b], abs_tol=1e-3), (a, r[a], w[b])


def test_quantiles_with_heavy_ties(spark):
    vals = [5.0] * 50 + [1.0, 2.0, 3.0] + [9.0] * 7
    df = spark.createDataFrame([(1, v) for v in vals], "g int, x double")
    got = profile.grouped_quantiles(df, "x", ["g"], [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).first()
    want = np.quantile(np.array(vals), [0.0, 0.1, 0.25, 0.5, 0.9, 1.0])
    assert np.allclose([got[f"q{i}"] for i in range(6)], want)


def test_histogram_matches_numpy(spark):
    pdf = _labelled_pdf(spark)
    got = profile.histogram(filters.labelled_rows(train_tickets(spark, SF001)),
                            "judgment_amount").orderBy("bin").toPandas()
    counts, edges = np.histogram(pdf["judgment_amount"], bins=10)
    dense = np.zeros(10, dtype=int)
    dense[got["bin"].to_numpy()] = got["n"].to_numpy()
    assert dense.tolist() == counts.tolist()
    assert np.allclose(got["lower"], edges[got["bin"]], atol=1e-3)


def test_boxplot_slices_overlap(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 0.0, 5.0), (3, 1.0, None)],
                               "id int, compliance double, hearing double")
    tagged = profile.tag_slices(df, [("compliant", F.col("compliance") == 1),
                                     ("undated", F.col("hearing").isNull())])
    assert tagged.count() == 4   # rows 1 and 3 are in both slices
    box = {r["slice"]: r for r in profile.boxplot_summary(tagged, "id").collect()}
    assert box["compliant"]["lo"] == 1 and box["compliant"]["hi"] == 3
    assert box["undated"]["median"] == 2


def test_describe_categorical_tie_rule(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string")
    r = profile.describe_categorical(df, ["v"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)


def test_category_drift_brute_force(spark):
    t = filters.labelled_rows(train_tickets(spark, SF001))
    s = scoring_tickets(spark, SF001)
    attrs = ["violation_street_number", "violation_code"]
    got = {r["attribute"]: r for r in profile.category_drift(t, s, attrs).collect()}
    tp, sp = t.toPandas(), s.toPandas()
    for a in attrs:
        tv, sv = set(tp[a].dropna()), set(sp[a].dropna())
        t_null_ok = sp[a].isna().any()
        left = sum(1 for v in tp[a] if (pd.isna(v) and not t_null_ok) or (not pd.isna(v) and v not in sv))
        s_null_ok = tp[a].isna().any()
        right = sum(1 for v in sp[a] if (pd.isna(v) and not s_null_ok) or (not pd.isna(v) and v not in tv))
        assert math.isclose(got[a]["left_only_ratio"], left / len(tp))
        assert math.isclose(got[a]["right_only_ratio"], right / len(sp))


def test_conditional_rate_and_prior(spark, train_df):
    lab = filters.labelled_rows(train_df)
    r = profile.conditional_rate(lab, F.col("hearing_date").isNull()).first()
    assert r["rate"] == 1.0 and r["n"] == 1
    p = profile.target_prior(lab).first()
    assert math.isclose(p["prior"], 4 / 8) and p["n"] == 8


def test_degenerate_groups_give_null_not_errors(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0), (3, 2.0)], "g int, x double")
    d = {r["g"]: r for r in profile.describe_numeric(df, "x", ["g"]).collect()}
    assert d[1]["count"] == 1 and d[1]["std"] is None and d[1]["p50"] == 5.0
    assert 2 not in d and math.isclose(d[3]["std"], 2 ** 0.5 / 2, rel_tol=1e-12)
    f = {r["g"]: r["mean"] for r in profile.frequency_by(df, "g", "x").collect()}
    assert f[2] is None and f[3] == 1.5
    empty = df.filter("g = 99")
    r = profile.category_drift(df, empty, ["g"]).first()
    assert r["left_only_ratio"] == 1.0 and r["right_only_ratio"] is None


def test_ranking_is_independent_of_range_partition_count(spark):
    from ledgerlens.plans.ranking import ordered_positions
    df = spark.createDataFrame([(i % 3, float(i % 17), 1 + i % 4) for i in range(500)],
                               "g int, v double, w int")
    freq = df.groupBy("g", "v").agg(F.sum("w").alias("w"))
    one = sorted(ordered_positions(freq, ["g"], "v", "w", partitions=1)
                 .select("g", "v", "_start", "_end", "_n").collect())
    many = sorted(ordered_positions(freq, ["g"], "v", "w", partitions=7)
                  .select("g", "v", "_start", "_end", "_n").collect())
    assert one == many
    # positions are contiguous within each group
    for gid in range(3):
        rows = [r for r in one if r["g"] == gid]
        assert rows[0]["_start"] == 0 and rows[-1]["_end"] == rows[-1]["_n"] - 1
        assert all(a["_end"] + 1 == b["_start"] for a, b in zip(rows, rows[1:]))


def test_describe_keeps_small_decimals(spark):
    df = spark.createDataFrame([(0.001,), (0.002,), (0.003,)], "x double")
    r = profile.describe_numeric(df, "x").first()
    assert math.isclose(r["mean"], 0.002, rel_tol=1e-12) and math.isclose(r["std"], 0.001, rel_tol=1e-9)
    h = profile.histogram(df, "x").collect()
    assert min(b["lower"] for b in h) == 0.001 and sum(b["n"] for b in h) == 3
