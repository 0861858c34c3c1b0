"""Models, selection and scoring (58, 66-73, 75) on ``pyspark.ml``.

Training is distributed by Spark ML itself (tree aggregation of gradients /
split statistics); the driver only holds coefficients, trees and metrics.
Inputs are materialized before fitting because every iteration rescans them.

Parameter mapping from the single-machine originals:

* inverse regularisation ``C`` over ``n`` rows -> ``regParam = 1 / (C * n)``
  (the original sums the loss; Spark averages it);
* L1 -> ``elasticNetParam = 1``; L2 -> ``0``;
* boosted trees: estimators -> ``maxIter``, learning rate -> ``stepSize``,
  min leaf -> ``minInstancesPerNode``, sqrt features ->
  ``featureSubsetStrategy='sqrt'``, subsample -> ``subsamplingRate``; the
  split minimum has no peer and is ignored;
* unlimited forest depth -> ``maxDepth = 30`` (Spark's limit).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CV_FOLDS, GBT_PARAMS, LOGREG_L1_C
from ..operators.segment import fold_of, stratified_folds
from ..session import materialize
from .metrics import roc_auc

FEATURES = "features"
LABEL = "label"


def assembler(features: Sequence[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def checked(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` that fails with the feature's name on a null or NaN feature: a
    model would otherwise give such a row the score NaN without a word."""
    def sure(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(v.isNull() | F.isnan(v), F.raise_error(F.lit(f"feature {c} is null or NaN")).cast("double")).otherwise(v)
    return df.withColumns({c: sure(c) for c in dict.fromkeys(features)})


MOST_BINS = 1024


def bins_for(df: DataFrame, features: Sequence[str], most: int = MOST_BINS) -> int:
    """``maxBins`` that gives every distinct value of the label codes its own split point: the largest code
    plus one (codes are ranks), 32 at least.  Beyond ``most`` split points are quantiles of the codes, as
    they are for amounts: a node's statistics take memory in proportion to the bins."""
    codes = [c for c, kind in df.select(*dict.fromkeys(features)).dtypes if kind in ("int", "bigint")]
    if not codes:
        return 32
    top = df.agg(*[F.max(c).alias(c) for c in codes]).first()
    return max(32, min(most, max(int(top[c] or 0) + 1 for c in codes)))


def with_label(df: DataFrame, target: str = "compliance") -> DataFrame:
    return df.withColumn(LABEL, F.col(target).cast("double"))


def reg_param(c: float, n_rows: int) -> float:
    return 1.0 / (float(c) * max(int(n_rows), 1))


def logistic(c: float = LOGREG_L1_C, n_rows: int = 1, penalty: str = "l1",
             max_iter: int = 100, standardize: bool = False) -> LogisticRegression:
    return LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, maxIter=max_iter,
                              regParam=reg_param(c, n_rows),
                              elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              standardization=standardize)


def boosted_trees(n_trees: int = GBT_PARAMS["n_trees"],
                  learning_rate: float = GBT_PARAMS["learning_rate"],
                  max_depth: int = GBT_PARAMS["max_depth"],
                  min_samples_leaf: int = GBT_PARAMS["min_samples_leaf"],
                  max_features: str = GBT_PARAMS["max_features"],
                  subsample: float = GBT_PARAMS["subsample"],
                  seed: int = GBT_PARAMS["seed"], min_info_gain: float = 0.0,
                  max_bins: int = 32) -> GBTClassifier:
    return GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, maxIter=n_trees,
                         stepSize=learning_rate, maxDepth=max_depth,
                         minInstancesPerNode=min_samples_leaf,
                         featureSubsetStrategy=max_features, subsamplingRate=subsample,
                         minInfoGain=min_info_gain, maxBins=max_bins, seed=seed)


def forest(n_trees: int = 100, max_depth: int | None = None, seed: int = 0,
           max_bins: int = 32) -> RandomForestClassifier:
    """Deep trees: node ids are cached on the executors (``cacheNodeIds``)
    instead of shipping the growing trees every level, and a larger node
    batch per pass (``maxMemoryInMB``) means fewer passes over the data."""
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, numTrees=n_trees,
                                  maxDepth=30 if max_depth is None else max_depth, seed=seed, maxBins=max_bins,
                                  cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=1024)


def linear_svc(c: float = 1.0, n_rows: int = 1, max_iter: int = 100) -> LinearSVC:
    return LinearSVC(featuresCol=FEATURES, labelCol=LABEL, regParam=reg_param(c, n_rows),
                     maxIter=max_iter)


def positive_probability(pred: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1 from a classifier's output; models without
    probabilities (linear SVM) expose their margin (``rawPrediction[1]``),
    which ranks rows the same way for AUC."""
    src = "probability" if "probability" in pred.columns else "rawPrediction"
    return pred.withColumn(out, vector_to_array(F.col(src))[1])


def fit(estimator, df: DataFrame, features: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=[assembler(features), estimator]).fit(checked(df, features))


def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    return positive_probability(model.transform(checked(df, model.stages[0].getInputCols())), out)


def feature_importance(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """(feature, importance), most important first (58).  The importances
    are model coefficients (one per feature), not data."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), F.asc("feature")))


def staged_scores(model: PipelineModel, df: DataFrame, stages: Sequence[int], keep: Sequence[str] = ("ticket_id",)) -> DataFrame:
    """(keep..., trees, score): probability of class 1 by the first ``trees`` trees of a fitted boosted ensemble, for
    each of ``stages``.  All trees score a row in one projection; a prefix of the ensemble is the ensemble that
    fewer iterations would have given, so a grid of tree counts costs the fit of its largest."""
    boosted = model.stages[-1]
    trees, weights = boosted.trees, boosted.treeWeights
    if not stages or min(stages) < 1 or max(stages) > len(trees):
        raise ValueError(f"stages must be 1 to {len(trees)}")
    out = model.stages[0].transform(checked(df, model.stages[0].getInputCols()))
    for i, tree in enumerate(trees[:max(stages)]):
        out = tree.setPredictionCol(f"_tree{i}").transform(out)
    parts = F.array(*[F.col(f"_tree{i}") * F.lit(float(weights[i])) for i in range(max(stages))])
    margin = lambda k: F.aggregate(F.slice("_parts", 1, k), F.lit(0.0), lambda a, v: a + v)
    each = F.array(*[F.struct(F.lit(int(k)).alias("trees"), margin(k).alias("margin")) for k in sorted(set(stages))])
    staged = out.select(*keep, parts.alias("_parts")).select(*keep, F.explode(each).alias("_s"))
    return staged.select(*keep, "_s.trees", (1.0 / (1.0 + F.exp(-2.0 * F.col("_s.margin")))).alias("score"))


def staged_cv(estimator, df: DataFrame, features: Sequence[str], stages: Sequence[int], folds: int = CV_FOLDS,
              key: str = "ticket_id", label: str = LABEL, parallelism: int = 4, exact: bool = False) -> DataFrame:
    """(trees, fold, auc, n_pos, n_neg) of a boosted ensemble's held-out scores after each of ``stages`` trees: one
    fit a fold, whatever the stages.  Folds keep the classes' shares.  ``exact``: any value of a feature may be a
    cut (:mod:`.exact_boosting`), not only the ends of ``maxBins`` bins."""
    data = materialize(stratified_folds(checked(df, features), label, key, folds).select(
        key, label, "fold", *dict.fromkeys(features)), "staged_folds", wide=True)
    most = estimator.copy({estimator.maxIter: max(stages)})
    if exact:
        from .exact_boosting import cross_validated
        return cross_validated([most], data, features, "fold", folds, stages, label, key).drop("candidate")

    def one(k: int) -> DataFrame:
        model = fit(most, data.filter(F.col("fold") != k), features)
        return staged_scores(model, data.filter(F.col("fold") == k), stages, ("fold", label))

    parts = run_concurrently([lambda k=k: one(k) for k in range(folds)], parallelism)
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    return roc_auc(scored, "score", label, ["trees", "fold"])


# --------------------------------------------------------------------------- 70
def rff_transform(df: DataFrame, input_col: str, n_features: int, n_components: int = 100,
                  gamma: float = 0.1, seed: int = 0, out: str = "rff") -> DataFrame:
    """Random Fourier features for an RBF kernel exp(-gamma |x-y|^2)
    (Rahimi & Recht, 2007): z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma),
    b ~ U(0, 2 pi).  W is D x d, fixed by the parameters (not the data), and
    is shipped with the function; rows are transformed in Arrow batches."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_features, n_components))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    norm = math.sqrt(2.0 / n_components)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _rff(x: pd.Series) -> pd.Series:
        mat = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, n_features))
        z = norm * np.cos(mat @ w + b)
        return pd.Series(list(z))

    arr = vector_to_array(F.col(input_col)) if dict(df.dtypes).get(input_col) == "vector" \
        else F.col(input_col)
    return df.withColumn(out, array_to_vector(_rff(arr)))


def fit_rff_svc(df: DataFrame, features: Sequence[str], c: float = 1.0, gamma: float = 0.1,
                n_components: int = 100, seed: int = 0):
    """Approximate RBF-kernel SVM: scale, random Fourier features, linear SVM."""
    base = assembler(features, "_raw").transform(df)
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(base)
    mapped = rff_transform(scaler.transform(base), "_scaled", len(features), n_components,
                           gamma, seed, out=FEATURES)
    n = mapped.count()
    svc = linear_svc(c, n).fit(mapped)
    return scaler, svc


def score_rff_svc(scaler, svc, df: DataFrame, features: Sequence[str], gamma: float = 0.1,
                  n_components: int = 100, seed: int = 0, out: str = "score") -> DataFrame:
    base = assembler(features, "_raw").transform(df)
    mapped = rff_transform(scaler.transform(base), "_scaled", len(features), n_components,
                           gamma, seed, out=FEATURES)
    return positive_probability(svc.transform(mapped), out)


# --------------------------------------------------------------------------- 72, 73
def grid_search(estimator, grid: dict, df: DataFrame, features: Sequence[str],
                folds: int = CV_FOLDS, parallelism: int | None = None,
                key: str = "ticket_id", exact: bool = False) -> DataFrame:
    """Exhaustive grid with k-fold AUC (exact: ``numBins=0``); folds come
    from the ticket key, so they are reproducible.  Returns one row per
    parameter combination with its mean AUC, best first.

    ``exact`` (boosted trees): any value of a feature may be a cut, and all
    candidates and folds share their passes (:mod:`.exact_boosting`).

    A grid of forest depths takes one forest without a depth limit a fold
    (:mod:`.deep_forest`): Spark's own would keep all nodes of all candidates
    in the driver."""
    if isinstance(estimator, RandomForestClassifier) and list(grid) == ["maxDepth"]:
        from .deep_forest import depth_grid
        dealt = checked(df, features).select(key, LABEL, *dict.fromkeys(features), fold_of(key, folds).alias("_fold"))
        found = depth_grid(dealt, list(features), list(grid["maxDepth"]), estimator.getNumTrees(), "_fold", folds, estimator.getSeed() % 2 ** 31, key=key)
        return found.select(F.concat(F.lit("maxDepth="), "depth").alias("params"), "mean_auc").orderBy(F.desc("mean_auc"))
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    names = [", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)) for pm in maps]
    if exact:
        from .exact_boosting import cross_validated
        found = cross_validated([estimator.copy(pm) for pm in maps], df.withColumn("_fold", fold_of(key, folds)), features, "_fold", folds, key=key)
        table = df.sparkSession.createDataFrame(list(enumerate(names)), "candidate int, params string")
        return (found.groupBy("candidate").agg(F.avg("auc").alias("mean_auc")).join(F.broadcast(table), "candidate")
                .select("params", "mean_auc").orderBy(F.desc("mean_auc")))
    # all candidates of a fold are fitted side by side (small fits leave
    # most cores idle); capped so a big grid does not flood the scheduler
    parallelism = parallelism or min(len(maps), 8)
    # the validator caches its folds: without the table's other columns
    data = assembler(features).transform(checked(df, features)).select(FEATURES, LABEL, fold_of(key, folds).alias("_fold"))
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC",
                                              numBins=0, rawPredictionCol="rawPrediction")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=folds, foldCol="_fold", parallelism=parallelism)
    model = cv.fit(data)
    rows = [(name, float(metric)) for name, metric in zip(names, model.avgMetrics)]
    spark = df.sparkSession
    return spark.createDataFrame(rows, "params string, mean_auc double").orderBy(F.desc("mean_auc"))


def run_concurrently(tasks: Sequence, parallelism: int) -> list:
    """Run independent Spark jobs from driver threads (as CrossValidator's
    ``parallelism`` does): small fits leave most cores idle, so several run
    side by side.  Results keep the order of ``tasks``."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda t: t(), tasks))


def cv_scores(estimator_factory, df: DataFrame, features: Sequence[str],
              folds: int = CV_FOLDS, key: str = "ticket_id", parallelism: int = 4,
              label: str = LABEL, stratified: bool = False) -> DataFrame:
    """(fold, auc, n_pos, n_neg) per held-out fold.  ``estimator_factory(n_rows)``
    builds the estimator for a fit set of ``n_rows`` rows.  A fold whose held-out
    rows are all of one class has no AUC (null).  Folds follow from the key alone, or
    keep the classes' shares (``stratified``; rows without a label are left out).

    The rows are assembled and written once; all folds' scores are ranked in
    one pass."""
    rows = checked(df, features).select(key, label, *dict.fromkeys(features))
    dealt = stratified_folds(rows, label, key, folds) if stratified else rows.withColumn("fold", fold_of(key, folds))
    data = materialize(assembler(features).transform(dealt).select(key, label, FEATURES, "fold"), "folds", wide=True)
    n = {r["fold"]: r["n"] for r in data.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())

    def one(k: int) -> DataFrame:
        model = estimator_factory(total - n.get(k, 0)).fit(data.filter(F.col("fold") != k))
        return positive_probability(model.transform(data.filter(F.col("fold") == k))).select("fold", "score", label)

    parts = run_concurrently([lambda k=k: one(k) for k in range(folds)], parallelism)
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    return roc_auc(scored, "score", label, ["fold"])
