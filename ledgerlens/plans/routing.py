"""The segment-routed scoring plan (64, 76) end to end.

training table  -> drop leakage -> labelled -> sentinels, text casts,
                   flags, city rules -> segment
scoring table   -> sentinels, text casts, default city, city rules -> segment
both, not waived -> fold to the shared vocabulary -> collapse dispositions
                 -> label codes fitted on training -> time to hearing
dated segment   -> mean of logistic (L1) and boosted-tree probabilities
undated segment -> logistic (L1) probability
waived segment  -> 1
union           -> (ticket_id, compliance), one row per scoring ticket
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (DATED_FEATURES, DISPOSITION_COLLAPSE, ENCODED_ATTRIBUTES,
                         FOLD_ATTRIBUTES, NULL_SENTINEL, SCORING_WAIVED_PATTERNS,
                         TRAIN_WAIVED_PATTERNS, UNDATED_FEATURES)
from ..operators import clean, encode, filters, vocab
from ..operators.segment import DATED, UNDATED, WAIVED, with_segment
from ..session import in_one_wave, materialize
from . import models

@dataclass
class RouteSpec:
    """What to fold, encode and feed to each segment's models."""
    fold_attributes: Sequence[str] = tuple(FOLD_ATTRIBUTES)
    encoded_attributes: Sequence[str] = tuple(ENCODED_ATTRIBUTES)
    dated_features: Sequence[str] = tuple(DATED_FEATURES)
    undated_features: Sequence[str] = tuple(UNDATED_FEATURES)
    train_waived: Sequence[str] = tuple(TRAIN_WAIVED_PATTERNS)
    scoring_waived: Sequence[str] = tuple(SCORING_WAIVED_PATTERNS)
    collapse_rules: Sequence[tuple[str, str]] = tuple(DISPOSITION_COLLAPSE)
    city_rules: bool = True


def prepare_train(df: DataFrame, spec: RouteSpec) -> DataFrame:
    out = filters.labelled_rows(filters.drop_leakage(df))
    out = clean.cast_to_text(clean.fill_sentinel(out))
    out = clean.add_text_flags(out)
    if spec.city_rules:
        out = clean.normalise_city(out, rules="train")
    return with_segment(out, spec.train_waived)


def prepare_scoring(df: DataFrame, spec: RouteSpec) -> DataFrame:
    out = clean.cast_to_text(clean.fill_sentinel(filters.drop_leakage(df)))
    out = clean.add_text_flags(out)
    if spec.city_rules:
        out = clean.normalise_city(clean.fill_default(out), rules="scoring")
    return with_segment(out, spec.scoring_waived)


def encoded_segments(train: DataFrame, scoring: DataFrame, spec: RouteSpec,
                     materialize_inputs: bool = True) -> tuple[DataFrame, DataFrame]:
    """Fold, collapse, encode and add time to hearing for the non-waived
    rows of both tables (materialized: every model pass rereads them).

    The prepared inputs are read several times (vocabulary, codes, folds);
    they are materialized first unless they already come from a
    materialized table (then the preparation is a cheap projection)."""
    t = train.filter(F.col("segment") != WAIVED)
    s = scoring.filter(F.col("segment") != WAIVED)
    s = clean.collapse_categories(s, "disposition", spec.collapse_rules)
    if materialize_inputs:
        t = materialize(t, "train_prepared", wide=True)
        s = materialize(s, "scoring_prepared", wide=True)
    # fold + encode fused: one vocabulary aggregate over both tables gives
    # the shared values and the codes; then one lookup of all attributes
    attrs = list(dict.fromkeys([*spec.fold_attributes, *spec.encoded_attributes]))
    voc = vocab.vocabulary(t, s, attrs, persist=True)
    codes, nan_codes = encode.fit_folded_codes(voc, spec.fold_attributes,
                                               spec.encoded_attributes, NULL_SENTINEL)
    # hot values for the (rare) salted join path come from the vocabulary's
    # per-table counts, not from another pass over the rows
    hot = {side: (lambda side=side: vocab.hot_values(voc, attrs, side)) for side in ("n_left", "n_right")}
    t = encode.apply_folded_codes(t, codes, spec.encoded_attributes, nan_codes, hot_for=hot["n_left"], key="ticket_id")
    s = encode.apply_folded_codes(s, codes, spec.encoded_attributes, nan_codes, hot_for=hot["n_right"], key="ticket_id")
    fold_only = [a for a in spec.fold_attributes if a not in set(spec.encoded_attributes)]
    if fold_only:
        common = materialize(vocab.shared(voc), "shared_vocabulary")
        t = vocab.fold_to_shared(t, common, fold_only, key="ticket_id")
        s = vocab.fold_to_shared(s, common, fold_only, key="ticket_id")
    t = filters.with_time_to_hearing(t)
    s = filters.with_time_to_hearing(s)
    return (materialize(models.with_label(t), "train_encoded", wide=True),
            materialize(s, "scoring_encoded", wide=True))


def model_scorers() -> dict[str, list[Callable[[int], object]]]:
    """Estimators per segment (the final choice of the original analysis);
    each factory takes the row count of the segment's training rows."""
    return {
        DATED: [lambda n: models.logistic(n_rows=n), lambda n: models.boosted_trees()],
        UNDATED: [lambda n: models.logistic(n_rows=n)],
    }


def _segment_filter(seg: str):
    return F.col("hearing_date").isNotNull() if seg == DATED else F.col("hearing_date").isNull()


def _model_scores(t: DataFrame, s: DataFrame, spec: RouteSpec) -> list[DataFrame]:
    """Fit every segment's estimators concurrently, then score each scoring
    segment with a chain of transforms on one assembled frame (no join: the
    models write differently named output columns)."""
    feats = {DATED: list(spec.dated_features), UNDATED: list(spec.undated_features)}
    rows = {seg: t.filter(_segment_filter(seg)).select(models.LABEL, *dict.fromkeys(feats[seg])) for seg in feats}
    rows[DATED] = in_one_wave(rows[DATED], "dated_rows")  # read again by every level of every boosted tree
    train_seg = {seg: models.assembler(feats[seg]).transform(models.checked(rows[seg], feats[seg])) for seg in feats}
    counts = {seg: df.count() for seg, df in train_seg.items()}
    jobs, keys = [], []
    for seg, factories in model_scorers().items():
        for i, make in enumerate(factories):
            est = make(counts[seg])
            est = (est.setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}")
                   .setPredictionCol(f"_y{i}"))
            jobs.append(lambda est=est, seg=seg: est.fit(train_seg[seg]))
            keys.append((seg, i))
    fitted = dict(zip(keys, models.run_concurrently(jobs, parallelism=len(jobs))))
    parts = []
    for seg in feats:
        scored = models.assembler(feats[seg]).transform(models.checked(s.filter(_segment_filter(seg)), feats[seg]))
        idx = sorted(i for (g, i) in fitted if g == seg)
        for i in idx:
            scored = fitted[(seg, i)].transform(scored)
        probs = [models.vector_to_array(F.col(f"_p{i}"))[1] for i in idx]
        mean = sum(probs[1:], probs[0]) / F.lit(float(len(probs)))
        parts.append(scored.select("ticket_id", mean.alias("compliance")))
    return parts


def routed_scores(train_raw: DataFrame, scoring_raw: DataFrame, spec: RouteSpec | None = None,
                  scorer: Callable[[DataFrame, DataFrame, Sequence[str], str], DataFrame] | None = None,
                  inputs_materialized: bool = False) -> DataFrame:
    """One probability per scoring ticket.

    ``scorer(train_seg, score_seg, features, segment)`` may replace the
    models (it must return ``ticket_id, compliance``); by default the
    logistic / boosted-tree pair of the original is fitted.
    """
    spec = spec or RouteSpec()
    train = prepare_train(train_raw, spec)
    scoring = prepare_scoring(scoring_raw, spec)
    t, s = encoded_segments(train, scoring, spec, materialize_inputs=not inputs_materialized)
    out = (scoring.filter(F.col("segment") == WAIVED)
           .select("ticket_id", F.lit(1.0).alias("compliance")))
    if scorer is None:
        parts = _model_scores(t, s, spec)
    else:
        parts = [scorer(t.filter(_segment_filter(seg)), s.filter(_segment_filter(seg)),
                        feats, seg)
                 for seg, feats in ((DATED, spec.dated_features),
                                    (UNDATED, spec.undated_features))]
    for part in parts:
        out = out.unionByName(part.select("ticket_id", "compliance"))
    return out


def score_ticket_files(spark, train_csv: str, scoring_csv: str, out_csv: str,
                       spec: RouteSpec | None = None) -> DataFrame:
    """Read the two ticket CSVs (training in Latin-1), score every scoring
    ticket with the routed plan, write ``ticket_id, compliance`` as CSV and
    return the scores."""
    from ..sources.csv_io import read_scoring, read_train, write_scores_csv
    scores = routed_scores(read_train(spark, train_csv), read_scoring(spark, scoring_csv), spec)
    scores = materialize(scores, "scores", wide=True)
    write_scores_csv(scores, out_csv)
    return scores
