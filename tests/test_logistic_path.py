"""Grids of logistic regressions fitted together, against the estimator that fits them one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import segment
from ledgerlens.plans import logistic_path as lp
from ledgerlens.plans import models
from test_models import _planted

FEATS = ["x1", "x2", "x3"]
STRENGTHS = [0.001, 0.01, 0.1, 1.0, 100.0]


@pytest.fixture(scope="module")
def rows(spark):
    df = _planted(spark, 2000).withColumn("x2", F.col("x2") * 1000 + 5000).withColumn("x3", F.col("x3") * 0.01)
    return segment.stratified_folds(df, "label")


def test_fits_equal_the_estimator(spark, rows):
    """Five strengths, both penalties, with and without a held-out fold: probabilities within 1e-3."""
    fits = [lp.Fit(c, p, k) for c in STRENGTHS for p in (lp.L1, lp.L2) for k in (None, 2)]
    data = lp.rows_for(rows, FEATS, fold="fold", keep=["ticket_id"])
    fitted = lp.fit_many(data, FEATS, fits)
    x = np.array([r["x"] for r in data.orderBy("ticket_id").collect()])
    assert fitted.passes < 100
    for i, f in enumerate(fits):
        part = rows if f.fold is None else rows.filter(F.col("fold") != f.fold)
        est = models.logistic(f.c, part.count(), f.penalty, max_iter=500).setTol(1e-10)
        alone = models.fit(est, part, FEATS).stages[-1]
        mine = 1 / (1 + np.exp(-(x @ fitted.weights[:, i] + fitted.intercepts[i])))
        theirs = 1 / (1 + np.exp(-(x @ alone.coefficients.toArray() + alone.intercept)))
        assert np.abs(mine - theirs).max() < 1e-3, f
        scale = x.std(axis=0)
        assert np.abs((fitted.weights[:, i] - alone.coefficients.toArray()) * scale).max() < 1e-3, f


def test_grid_scores_every_combination(spark, rows):
    out = lp.grid_scores(rows.drop("fold"), FEATS, [0.01, 1.0]).collect()
    assert len({(r["penalty"], r["c"], r["fold"]) for r in out}) == len(out) == 20
    assert sum(r["n_pos"] + r["n_neg"] for r in out) == 4 * 2000
    assert all(r["auc"] > 0.7 for r in out if r["penalty"] == "l2")


def test_constant_features_and_empty_tables(spark, rows):
    data = lp.rows_for(rows.withColumn("same", F.lit(7.5)), ["same", "x1"])
    fitted = lp.fit_many(data, ["same", "x1"], [lp.Fit(1.0, lp.L2), lp.Fit(1.0, lp.L1)])
    assert (fitted.weights[0] == 0).all() and (fitted.weights[1] > 0.5).all()
    with pytest.raises(ValueError, match="no rows"):
        lp.fit_many(data.filter("y > 5"), ["same", "x1"], [lp.Fit(1.0)])
    with pytest.raises(Exception, match="feature x1 is null"):
        lp.rows_for(rows.withColumn("x1", F.when(F.col("ticket_id") != 3, F.col("x1"))), ["x1"])


def test_stratified_folds_differ_by_one_row_a_class(spark):
    df = spark.range(1003).select(F.col("id").alias("ticket_id"), F.when(F.col("id") % 13 == 0, 1.0).when(
        F.col("id") % 13 == 1, F.lit(None)).otherwise(0.0).alias("label"), F.lit(9).alias("fold"))
    out = segment.stratified_folds(df, "label")
    assert out.columns == ["ticket_id", "label", "fold"]
    counts = {}
    for r in out.groupBy("label", "fold").count().collect():
        counts.setdefault(r["label"], []).append(r["count"])
    assert set(counts) == {0.0, 1.0} and all(len(c) == 5 and max(c) - min(c) <= 1 for c in counts.values())
    assert out.count() == df.filter("label is not null").count()
    assert segment.stratified_folds(df.filter("false"), "label").count() == 0


def test_tasks_that_count_scores_are_bounded(spark):
    """The scores of a grid are made by more tasks as rows and fits grow, whatever files the rows lie in."""
    data = spark.range(1000).coalesce(1)
    parts = lp.score_parts(data, 14, most=2000)
    assert parts.rdd.getNumPartitions() == 7 and parts.count() == 1000
    assert max(parts.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) * 14 <= 2100
    assert lp.score_parts(data.filter("id < 0"), 14).count() == 0
