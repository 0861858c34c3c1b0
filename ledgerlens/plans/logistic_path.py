"""Many penalised logistic regressions fitted together (68, 72, 73).

A grid of inverse strengths, penalties and held-out folds is one weight
matrix, one column a fit.  A pass over the rows multiplies each batch by the
matrix, gives back every fit's gradient and loss with a second product, and
Spark sums them; the driver takes one accelerated proximal-gradient step for
all fits.  A grid of any size so costs as many passes as its slowest fit.

Steps are taken in standardised coordinates (penalties stay on the original
weights) and in the metric of a fixed bound on the Hessian, a quarter of the
features' second moments (Boehning & Lindsay 1988), which one pass counts by
fold: the bound needs no step size and no line search.  The driver holds
features x fits numbers and one second-moment matrix a fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CV_FOLDS
from ..operators.segment import stratified_folds
from ..session import materialize, spread
from .metrics import roc_auc
from .models import LABEL, checked
from .ranking import ROWS_PER_TASK

L1, L2 = "l1", "l2"


@dataclass(frozen=True)
class Fit:
    """One regression: inverse strength of the penalty, its kind, the fold it does not see (None: it sees all rows)."""
    c: float
    penalty: str = L1
    fold: int | None = None


@dataclass
class Fitted:
    """Weights (features x fits) and intercepts in the features' own units."""
    features: list[str]
    fits: list[Fit]
    weights: np.ndarray
    intercepts: np.ndarray
    passes: int


def rows_for(df: DataFrame, features: Sequence[str], label: str = LABEL, fold: str | None = None,
             keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., x, y, fold) with the features as one array of doubles; null or NaN features are an error.
    Written once: every pass reads it again."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    held = F.col(fold).cast("int") if fold else F.lit(-1)
    return materialize(spread(checked(df, features).select(*keep, x.alias("x"), F.col(label).cast("double").alias("y"),
                                                           held.alias("fold"))), "logistic_rows", wide=True)


def _summed(data: DataFrame, per_batch) -> np.ndarray:
    """Sum over all batches of the array that ``per_batch(x, y, fold)`` gives (of one shape)."""

    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                part = per_batch(x, b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["v"])

    rows = (data.select("x", "y", "fold").mapInArrow(run, "v array<double>")
            .select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect())
    out = np.zeros(len(rows))
    for r in rows:
        out[r["at"]] = r["v"]
    return out


def loss_and_gradient(data: DataFrame, weights: np.ndarray, held_out: Sequence[int | None],
                      mean: np.ndarray | None = None, scale: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(loss of each column, gradient) of the summed logistic loss, in one pass.  ``weights`` is (1 + features) x fits,
    the intercepts first; column j leaves out the rows of fold ``held_out[j]``; features are centred and scaled first."""
    d = len(weights) - 1
    mean, scale = np.zeros(d) if mean is None else mean, np.ones(d) if scale is None else scale
    held = np.array([-2 if f is None else f for f in held_out])

    def per_batch(x, y, fold):
        z = np.concatenate([np.ones((len(x), 1)), (x - mean) / scale], axis=1)
        margin = z @ weights
        seen = fold[:, None] != held[None, :]
        loss = np.logaddexp(0.0, margin) - y[:, None] * margin
        off = (1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700))) - y[:, None]) * seen
        return np.concatenate([(loss * seen).sum(axis=0)[None, :], z.T @ off])

    out = _summed(data, per_batch).reshape(2 + d, len(held))
    return out[0], out[1:]


def _moments(data: DataFrame, d: int, mean, scale, folds: Sequence[int | None]) -> dict:
    """Second moments of the standardised features with the constant, over the rows each held-out fold leaves."""
    kinds = sorted({-2 if f is None else f for f in folds})

    def per_batch(x, y, fold):
        z = np.concatenate([np.ones((len(x), 1)), (x - mean) / scale], axis=1)
        whole = z.T @ z
        return np.stack([whole - z[fold == k].T @ z[fold == k] for k in kinds])

    return dict(zip(kinds, _summed(data, per_batch).reshape(len(kinds), d + 1, d + 1)))


def _step(at: np.ndarray, gradient: np.ndarray, bound: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """argmin g.(v - at) + (v - at) B (v - at) / 2 + sum l1 |v| + l2 v^2 / 2 for each column, by coordinate descent
    over all columns at once (``bound``: fits x d x d)."""
    v = at.copy()
    diagonal = np.einsum("fii->if", bound) + l2
    slope = gradient.copy()  # of the quadratic part at v
    for _ in range(200):
        most = 0.0
        for i in range(len(v)):
            target = diagonal[i] * v[i] - slope[i] - l2[i] * v[i]
            new = np.sign(target) * np.maximum(np.abs(target) - l1[i], 0.0) / np.maximum(diagonal[i], 1e-300)
            move = new - v[i]
            if move.any():
                slope += bound[:, :, i].T * move
                most = max(most, float(np.abs(move).max()))
                v[i] = new
        if most < 1e-9 * (1.0 + float(np.abs(v).max())):
            break
    return v


def fit_many(data: DataFrame, features: Sequence[str], fits: Sequence[Fit], max_passes: int = 300,
             tolerance: float = 1e-5) -> Fitted:
    """All ``fits`` on ``data`` (see :func:`rows_for`).  Each minimises C x summed loss + penalty (L1: sum of absolute
    weights; L2: half the sum of squares; the intercept is free).  A fit is done, and takes no more part, when two
    steps running move its rows' log-odds by less than ``tolerance`` (root of the mean square); all end after
    ``max_passes`` passes.  A feature that never varies gets weight zero."""
    d = len(features)
    stats = data.agg(F.count(F.lit(1)).alias("n"), *[f(F.col("x")[i]).alias(f"{f.__name__}{i}") for i in range(d)
                                                     for f in (F.avg, F.stddev_pop)]).first()
    if not stats["n"]:
        raise ValueError("no rows to fit")
    mean = np.array([stats[f"avg{i}"] for i in range(d)])
    spread = np.array([stats[f"stddev_pop{i}"] for i in range(d)])
    varies = spread > 1e-12 * (1.0 + np.abs(mean))
    scale = np.where(varies, spread, 1.0)
    folds = [f.fold for f in fits]
    moments = _moments(data, d, mean, scale, folds)
    bound = np.stack([moments[-2 if f is None else f] / 4.0 for f in folds])
    strength = np.array([1.0 / f.c for f in fits])
    # A weight w on a feature is v = w x scale on the standardised one.
    own = np.concatenate([[0.0], 1.0 / scale])[:, None]
    l1 = own * strength * np.array([f.penalty == L1 for f in fits])
    l2 = own ** 2 * strength * np.array([f.penalty == L2 for f in fits])
    l1[1:][~varies] = 1e300
    v = np.zeros((d + 1, len(fits)))
    ahead, momentum = v.copy(), np.ones(len(fits))
    counts = bound[:, 0, 0] * 4.0  # rows that each fit sees
    quiet = np.where(counts > 0, 0, 2)
    passes = 0
    while passes < max_passes and (quiet < 2).any():
        go = np.flatnonzero(quiet < 2)
        b = bound[go]
        _, gradient = loss_and_gradient(data, ahead[:, go], [folds[f] for f in go], mean, scale)
        passes += 1
        new = _step(ahead[:, go], gradient, b, l1[:, go], l2[:, go])
        moved = new - v[:, go]
        # Momentum starts again in the fits whose step turns back (O'Donoghue & Candes 2015).
        restart = (np.einsum("fij,jf->if", b, ahead[:, go] - new) * moved).sum(axis=0) > 0
        old = np.where(restart, 1.0, momentum[go])
        momentum[go] = (1.0 + np.sqrt(1.0 + 4.0 * old ** 2)) / 2.0
        ahead[:, go] = new + np.where(restart, 0.0, (old - 1.0) / momentum[go]) * moved
        v[:, go] = new
        change = np.einsum("if,fij,jf->f", moved, 4.0 * b, moved) / counts[go]
        quiet[go] = np.where(change <= tolerance ** 2, quiet[go] + 1, 0)
    weights = v[1:] / scale[:, None]
    return Fitted(list(features), list(fits), weights, v[0] - mean @ weights, passes)


def scores(data: DataFrame, fitted: Fitted, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., fit, fold, score, label): each row's probability by the fits that did not see it (by all that saw
    every row if a fit has no held-out fold)."""
    held = np.array([-2 if f.fold is None else f.fold for f in fitted.fits])
    weights, intercepts = fitted.weights, fitted.intercepts
    names = [*keep, "fit", "fold", "score", "label"]
    kinds = dict(data.dtypes)

    def run(batches):
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(weights))
            fold = b.column(2).to_numpy(zero_copy_only=False)
            row, fit = np.nonzero((held[None, :] == -2) | (fold[:, None] == held[None, :]))
            margin = (x @ weights + intercepts)[row, fit]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*[c.take(at) for c in b.columns[3:]], pa.array(fit, pa.int32()), b.column(2).take(at),
                 pa.array(1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))), b.column(1).take(at)], names)

    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], "fit int, fold int, score double, label double"])
    return data.select("x", "y", "fold", *keep).mapInArrow(run, schema)


def score_parts(data: DataFrame, each: int, most: int = ROWS_PER_TASK) -> DataFrame:
    """``data`` in enough partitions that ``each`` scores of every row are at most about ``most`` scores a task."""
    return data.repartition(max(1, -(-data.count() * each // most)))


def grid_scores(df: DataFrame, features: Sequence[str], strengths: Sequence[float], penalties: Sequence[str] = (L1, L2),
                folds: int = CV_FOLDS, key: str = "ticket_id", label: str = LABEL) -> DataFrame:
    """(penalty, c, fold, auc, n_pos, n_neg) of every combination and held-out fold (folds keep the classes'
    shares).  A fold of one class has no AUC."""
    dealt = stratified_folds(df, label, key, folds)
    data = rows_for(dealt, features, label, "fold")
    fits = [Fit(float(c), p, k) for p in penalties for c in strengths for k in range(folds)]
    fitted = fit_many(data, features, fits)
    # scores hardly repeat, so a task that counts them holds as many as it makes
    data = score_parts(data, len(fits) // folds)
    names = df.sparkSession.createDataFrame([(i, f.penalty, f.c) for i, f in enumerate(fits)], "fit int, penalty string, c double")
    found = roc_auc(scores(data, fitted).select("fit", "fold", "score", "label"), "score", "label", ["fit", "fold"])
    return found.join(F.broadcast(names), "fit").select("penalty", "c", "fold", "auc", "n_pos", "n_neg")
