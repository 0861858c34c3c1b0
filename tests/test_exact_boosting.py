"""Boosted trees whose cuts are exact, against plain numpy and Spark's own on bins for every value."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import exact_boosting as eb
from ledgerlens.plans import models


def _rare_code(spark, n=4000):
    """Only one code of 2,000 has class 1: a cut on either side of it is needed, no bin of many codes shows it."""
    return spark.range(n).select(
        F.col("id").alias("ticket_id"), (F.col("id") % 2000).cast("int").alias("code"), ((F.col("id") * 7919) % 1009 / 10.0).alias("amount"),
        (F.col("id") % 2000 >= 1237).cast("double").alias("label"))


def _plain(x, y, h, fit):
    """Margins by trees grown node by node, every value of every tried feature a cut."""
    s = np.where(y > 0.5, 1.0, -1.0)
    margin = np.zeros(len(y))
    for number in range(fit.trees):
        r = np.floor((s if number == 0 else 4 * s / (1 + np.exp(2 * s * margin))) * eb.UNIT + 0.5) / eb.UNIT
        seen = eb._mixed(h, fit.seed + number) < fit.subsample
        step = np.zeros(len(y))

        def go(rows, node):
            inside = rows & seen
            n, total = inside.sum(), r[inside].sum()
            best = (1e-9, None)
            if node.bit_length() <= fit.max_depth:
                for f in fit.features(x.shape[1], number, node):
                    for v in np.unique(x[inside, f])[:-1]:
                        left = inside & (x[:, f] <= v)
                        m = left.sum()
                        if m < fit.min_rows or n - m < fit.min_rows:
                            continue
                        gain = r[left].sum() ** 2 / m + (total - r[left].sum()) ** 2 / (n - m) - total ** 2 / n
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, v))
            if best[1] is None:
                step[rows] = total / n
                return
            f, v = best[1]
            go(rows & (x[:, f] <= v), 2 * node)
            go(rows & (x[:, f] > v), 2 * node + 1)

        go(np.ones(len(y), bool), 1)
        margin += step * (1.0 if number == 0 else fit.learning_rate)
    return margin


def _fit(spark, df, feats, fits, bins, at_once, **kw):
    edges = eb.bin_edges(df, feats, bins)
    data = eb.rows_for(df, feats, edges, "label", "ticket_id", "fold" if "fold" in df.columns else None)
    return eb.fit_many(data, feats, max(len(e) for e in edges) + 1, fits, at_once, **kw)


@pytest.mark.parametrize("tried,subsample", [("all", 1.0), ("sqrt", 0.8)])
def test_trees_equal_plain_numpy_whatever_the_bins(spark, tried, subsample):
    rng = np.random.default_rng(3)
    n = 1500
    x = np.stack([rng.normal(size=n), rng.integers(0, 400, n), np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)), rng.integers(0, 3, n)], 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-x[:, 0] - (x[:, 1] % 7 == 3) - x[:, 2]))).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "ticket_id long, a double, b double, c double, d double, label double")
    h = np.array([r["h"] for r in df.orderBy("ticket_id").select(F.xxhash64("ticket_id").alias("h")).collect()])
    fit = eb.Fit(4, 0.3, 4, 15, tried, subsample, 0.0, 5)
    want = _plain(x, y, h, fit)
    # all levels in passes, some of them, whole trees in a task; margins written on the way or not
    for bins, at_once, every in ((8, 10, 2), (200, 500, 2), (16, 10_000, 2)):
        (m,) = _fit(spark, df, ["a", "b", "c", "d"], [fit], bins, at_once, write_every=every)
        assert np.abs(m.margin(eb.Columns(x)) - want).max() < 1e-6, (bins, at_once)


def test_equal_to_spark_with_a_bin_for_each_value(spark):
    rng = np.random.default_rng(4)
    n = 600
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * x[:, 0] + x[:, 1]))).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "ticket_id long, a double, b double, c double, label double")
    est = models.boosted_trees(n_trees=5, max_depth=3, min_samples_leaf=20, max_features="all", subsample=1.0, max_bins=n + 1)
    scored = models.score(models.fit(est, df, ["a", "b", "c"]), df).orderBy("ticket_id").collect()
    (m,) = _fit(spark, df, ["a", "b", "c"], [eb.Fit.of(est)], 16, 50)
    assert np.abs(1 / (1 + np.exp(-2 * m.margin(eb.Columns(x)))) - [r["score"] for r in scored]).max() < 1e-6


def test_gbt_grid_cuts_at_any_code(spark):
    """32 bins of 2,000 codes can't tell the classes apart, cuts at the codes can."""
    df, feats = _rare_code(spark), ["code", "amount"]
    est = models.boosted_trees(n_trees=2, max_features="all", subsample=1.0)
    grid = {"maxDepth": [1, 2], "minInstancesPerNode": [1, 50]}
    binned = {r["params"]: r["mean_auc"] for r in models.grid_search(est, grid, df, feats, folds=2).collect()}
    exact = {r["params"]: r["mean_auc"] for r in models.grid_search(est, grid, df, feats, folds=2, exact=True).collect()}
    assert set(exact) == set(binned) and len(exact) == 4
    assert all(v > 0.999 and v > binned[k] for k, v in exact.items())


def test_gbt_staged_cuts_at_any_code(spark):
    """past 1,024 codes the bins were quantiles."""
    df, feats = _rare_code(spark), ["code", "amount"]
    est = models.boosted_trees(n_trees=9, max_features="all", subsample=1.0, min_samples_leaf=5)
    out = models.staged_cv(est, df, feats, [3, 1], folds=2, exact=True).collect()
    assert sorted((r["trees"], r["fold"]) for r in out) == [(t, f) for t in (1, 3) for f in range(2)]
    assert all(r["auc"] > 0.999 and abs(r["n_pos"] - r["n_neg"] * 763 / 1237) < 3 for r in out)


def test_queries_cut_at_any_value(spark, monkeypatch):
    """Both queries ask for exact cuts and all of the analysis's tree counts."""
    from ledgerlens.constants import GBT_TREE_GRID
    from ledgerlens.plans import catalog
    seen = {}
    monkeypatch.setattr(catalog, "_dated", lambda spark, sf: ("rows", None, ["x"]))
    monkeypatch.setattr(models, "grid_search", lambda est, grid, *a, **kw: seen.update(grid=kw))
    monkeypatch.setattr(models, "staged_cv", lambda est, t, feats, stages, **kw: seen.update(staged=kw, stages=list(stages)))
    catalog.q_gbt_grid(spark, "")
    catalog.q_gbt_staged(spark, "")
    assert seen == {"grid": {"exact": True}, "staged": {"exact": True}, "stages": GBT_TREE_GRID}
