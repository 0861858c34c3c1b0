import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import segment
from ledgerlens.plans import metrics, models
from ledgerlens.plans.routing import RouteSpec, routed_scores


def _planted(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x1, x2, x3 = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    p = 1 / (1 + np.exp(-(1.8 * x1 - 1.2 * x2)))
    y = (rng.uniform(size=n) < p).astype(float)
    rows = [(i, float(a), float(b), float(c), float(t)) for i, (a, b, c, t) in
            enumerate(zip(x1, x2, x3, y))]
    return spark.createDataFrame(rows, "ticket_id long, x1 double, x2 double, x3 double, label double")


FEATS = ["x1", "x2", "x3"]


def test_models_beat_threshold_on_planted_signal(spark):
    df = _planted(spark)
    fit_part, hold = segment.holdout_split(df)
    n = fit_part.count()
    for est in [models.logistic(n_rows=n), models.boosted_trees(n_trees=20),
                models.forest(n_trees=20, max_depth=5), models.linear_svc(1.0, n)]:
        m = models.fit(est, fit_part, FEATS)
        assert metrics.auc_value(models.score(m, hold), "score", "label") > 0.7


def test_staged_scores_are_the_scores_of_shorter_ensembles(spark):
    df = _planted(spark, 1200)
    fit_part, hold = segment.holdout_split(df)
    make = lambda n: models.boosted_trees(n_trees=n, subsample=0.8, min_samples_leaf=20)
    staged = models.staged_scores(models.fit(make(12), fit_part, FEATS), hold, [12, 4, 1])
    got = {(r["ticket_id"], r["trees"]): r["score"] for r in staged.collect()}
    for n in (1, 4, 12):
        for r in models.score(models.fit(make(n), fit_part, FEATS), hold).collect():
            assert abs(got.pop((r["ticket_id"], n)) - r["score"]) < 1e-12
    assert not got
    with pytest.raises(ValueError, match="stages"):
        models.staged_scores(models.fit(make(2), fit_part, FEATS), hold, [3])


def test_staged_cv_last_stage_is_the_fold_score(spark):
    df = _planted(spark, 1200).withColumn("code", (F.col("ticket_id") % 50).cast("int"))
    feats = [*FEATS, "code"]
    assert models.bins_for(df, feats) == 50 and models.bins_for(df, feats, most=40) == 40 and models.bins_for(df, FEATS) == 32
    est = models.boosted_trees(n_trees=99, min_samples_leaf=20)
    staged = models.staged_cv(est, df, feats, [2, 8], folds=3).collect()
    assert sorted((r["trees"], r["fold"]) for r in staged) == [(t, f) for t in (2, 8) for f in range(3)]
    whole = {r["fold"]: r for r in models.cv_scores(lambda n: models.boosted_trees(n_trees=8, min_samples_leaf=20), df, feats, 3,
                                                    stratified=True).collect()}
    for r in staged:
        assert abs(r["n_pos"] - whole[0]["n_pos"]) <= 1
        if r["trees"] == 8:
            assert abs(r["auc"] - whole[r["fold"]]["auc"]) < 1e-9


def test_rff_svc_and_importance(spark):
    df = _planted(spark, 1500)
    scaler, svc = models.fit_rff_svc(df, FEATS, c=1.0, gamma=0.2, n_components=32)
    scored = models.score_rff_svc(scaler, svc, df, FEATS, gamma=0.2, n_components=32)
    assert metrics.auc_value(scored, "score", "label") > 0.7
    m = models.fit(models.forest(n_trees=10, max_depth=4), df, FEATS)
    imp = models.feature_importance(m, FEATS, spark).collect()
    assert imp[-1]["feature"] == "x3"   # the pure-noise feature ranks last


def test_cv_scores_and_grid(spark):
    df = _planted(spark, 1500)
    cv = models.cv_scores(lambda n: models.logistic(n_rows=n), df, FEATS).collect()
    assert sorted(r["fold"] for r in cv) == [0, 1, 2, 3, 4]
    assert all(r["auc"] > 0.7 for r in cv)
    grid = models.grid_search(models.forest(n_trees=5), {"maxDepth": [2, 4]}, df, FEATS, folds=3)
    assert grid.count() == 2


def test_routed_scores_one_per_ticket(spark, train_df, scoring_df):
    spec = RouteSpec(dated_features=["city", "violation_code", "disposition", "judgment_amount",
                                     "time_to_hearing"],
                     undated_features=["city", "disposition", "judgment_amount"])

    def fixed(t_seg, s_seg, feats, seg):
        return s_seg.select("ticket_id", F.lit(0.5 if seg == "dated" else 0.25).alias("compliance"))

    out = {r["ticket_id"]: r["compliance"] for r in
           routed_scores(train_df, scoring_df, spec, scorer=fixed).collect()}
    assert out == {101: 0.5, 102: 1.0, 103: 1.0, 104: 0.25, 105: 0.5, 106: 0.5}


def test_routed_scores_with_models_on_driver_view(spark):
    from ledgerlens.plans.catalog import _view_spec
    from ledgerlens.sources.ticket_view import scoring_tickets, train_tickets
    from conftest import SF001
    scoring = scoring_tickets(spark, SF001)
    out = routed_scores(train_tickets(spark, SF001), scoring, _view_spec())
    rows = out.collect()
    ids = [r["ticket_id"] for r in rows]
    assert len(ids) == len(set(ids)) == scoring.count()          # one score per ticket
    assert all(0.0 <= r["compliance"] <= 1.0 for r in rows)


def test_document_quality_model_has_signal(spark):
    from ledgerlens.plans.catalog import QUERIES
    from conftest import SF01
    r = QUERIES["document_quality"](spark, SF01).first()
    assert r["n_pos"] > 0 and r["n_neg"] > 0 and r["auc"] > 0.7
