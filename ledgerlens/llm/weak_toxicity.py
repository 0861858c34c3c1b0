"""Toxicity by weak supervision.

Voters are words and word beginnings (lexicon and pattern votes) that
labelled training rows show far more often in toxic texts.  A generative
label model estimates from the votes alone how often each voter fires in
either class, and from the correlations that remain within a class how much
of a voter's evidence is its own; its posterior labels train a linear
classifier, which scores every text.

The models are fitted on a bounded sample of labelled rows (``SAMPLE`` of
each label, chosen by a hash of the key); class frequencies come from all of them,
and every document is scored whole.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_TABLE, checkpointed, extended, utf8

SAMPLE = 4_000  # labelled rows of each label that the models are fitted on
STEMS = (4, 5, 6)  # lengths of word beginnings, in bytes
MIN_TOXIC = 3  # toxic sample texts that a voter must occur in
MIN_SHARE = 0.01  # of the toxic sample texts, likewise
MIN_LIFT = 20.0  # times as frequent in toxic texts
MIN_PRECISION = 0.9  # share of toxic texts among those it fires in, at the labels' frequencies
SHARED = 0.8  # correlation within a class beyond which voters share their evidence
VOTERS = 96
FEATURES = 512
THRESHOLD = 0.3
MEMORY = 300_000  # words whose features a worker remembers


def features_of(word: bytes) -> list[bytes]:
    """A word and its beginnings (marked by a trailing star)."""
    return [word, *(word[:n] + b"*" for n in STEMS if len(word) >= n)]


def text_features(text: bytes) -> set[bytes]:
    return {f for w in set(text.translate(WORD_TABLE).split()) for f in features_of(w)}


@dataclass
class Model:
    """Linear classifier: weight of each feature's presence, and the intercept."""

    names: list[bytes]
    weights: np.ndarray
    intercept: float

    def scorer(self):
        """Function from a text (UTF-8) to its score, with a bounded memory of words."""
        index = {n: i for i, n in enumerate(self.names)}
        weights = self.weights.tolist()
        memory: dict[bytes, tuple[int, ...]] = {}

        def score(text: bytes) -> float:
            if len(memory) > MEMORY:
                memory.clear()
            on: set[int] = set()
            for w in set(text.translate(WORD_TABLE).split()):
                f = memory.get(w)
                if f is None:
                    f = memory[w] = tuple(index[x] for x in features_of(w) if x in index)
                if f:
                    on.update(f)
            z = self.intercept + sum(weights[i] for i in sorted(on))
            return float(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))

        return score


def label_model(votes: np.ndarray, prior: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM over 0/1 votes (rows, voters): posterior of the positive class, firing
    rates (2, voters + 1) and evidence weights of the voters.

    A voter that doesn't fire abstains: voters of different languages exclude
    each other, so silence of one says nothing.  One more voter, the last,
    fires for the negative class where all others abstain.  EM starts from
    "any vote".  Voters that stay correlated within a class (beyond
    ``SHARED``) share their evidence: a voter's weight is one over the number of
    voters it goes with, itself included.
    """
    votes = np.c_[votes, 1.0 - votes.any(1)]
    n, m = votes.shape
    weight = np.ones(m)
    post = np.where(votes[:, -1] == 0, 0.9, 0.02)
    rates = np.zeros((2, m))
    for step in range(2):  # before and after the correlations are known
        for _ in range(rounds):
            for c, p in ((1, post), (0, 1 - post)):
                rates[c] = (p @ votes + 0.1) / (p.sum() + 1.0)
            z = np.log(prior / (1 - prior)) + votes @ (np.log(rates[1] / rates[0]) * weight)
            new = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            if np.abs(new - post).max() < 1e-6:
                post = new
                break
            post = new
        if step == 0:
            left = votes - (post[:, None] * rates[1] + (1 - post[:, None]) * rates[0])
            sd = left.std(0) + 1e-9
            weight = 1 / (np.abs((left.T @ left) / n / np.outer(sd, sd)) > SHARED).sum(1).clip(1)
    return post, rates, weight


def linear_classifier(x: np.ndarray, target: np.ndarray, rows: np.ndarray, steps: int = 400,
                      penalty: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets with row weights (Adam on all rows)."""
    w = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    rows = rows / rows.sum()
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -40, 40)))
        e = (p - target) * rows
        g = np.r_[x.T @ e + penalty * w[:-1], e.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
              learn: Column | None) -> tuple[DataFrame, dict[int, int]]:
    """The bounded sample (text, y), and the labelled rows of each label."""
    given = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    given = given.filter(learn) if learn is not None else given
    given = given.groupBy(F.col(key).alias("key")).agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    known = checkpointed(given)
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y in sorted(counts):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return known.withColumn("text", F.lit("")), counts
    # at most 2 x SAMPLE keys: a bounded side
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen), "key"), counts


def _candidates(sample: DataFrame, rows_of: np.ndarray, counts: dict[int, int]) -> DataFrame:
    """(name, n0, n1): the features that may vote or become features of the
    classifier, with their hits in the sample texts of either label.

    Hits are counted by Spark, and what a voter must satisfy is tested there,
    so that no frequent word takes a rarer one's place: all that qualify as
    voters, and of the others the ``4 * FEATURES`` with the highest gain.
    """
    def tally(batches):
        for b in batches:
            seen = [Counter(), Counter()]
            for t, y in zip(utf8(b.column(0)), b.column(1).to_pylist()):
                seen[y].update(text_features(t))
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), *[pa.array([s[k] for k in names], pa.int64()) for s in seen]], ["name", "n0", "n1"])

    rate = [(F.col(f"n{c}") + 0.5) / F.lit(float(rows_of[c] + 1)) for c in (0, 1)]
    fires = [F.col(f"n{c}") * F.lit(counts[c] / float(rows_of[c])) for c in (0, 1)]
    lift = rate[1] / rate[0]
    common = checkpointed(
        sample.select("text", "y").mapInArrow(tally, "name binary, n0 long, n1 long")
        .groupBy("name").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .filter(F.col("n1") >= F.lit(float(max(MIN_TOXIC, MIN_SHARE * rows_of[1]))))
        .withColumn("strong", (lift >= MIN_LIFT) & (fires[1] >= MIN_PRECISION * (fires[0] + fires[1])))
        .withColumn("gain", F.abs(F.log(lift)) * F.sqrt("n1")))
    others = common.filter(~F.col("strong")).orderBy(F.desc("gain"), "name").limit(4 * FEATURES)
    return common.filter("strong").unionByName(others).orderBy(F.desc("n1"), "name").select("name", "n0", "n1")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", learn: Column | None = None) -> Model:
    """Fit on labelled rows for which ``learn`` holds.  Without rows of both
    labels the model gives every text the share of toxic rows."""
    sample, counts = _labelled(docs, labels, key, text, label, learn)
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    if not 0 < share < 1:
        return Model([], np.zeros(0), -40.0 if share == 0 else 40.0)
    # a text that repeats counts once: copies of one toxic text would make lexicon of all its words
    sample = checkpointed(sample.groupBy("text").agg(F.max("y").alias("y")))

    rows_of = np.array([sample.filter(F.col("y") == c).count() for c in (0, 1)], np.int64)
    if not rows_of.all():  # labels whose texts aren't in the table teach nothing but their share
        return Model([], np.zeros(0), float(np.log(share / (1 - share))))
    heads = _candidates(sample, rows_of, counts).toArrow()
    names = [bytes(x) for x in heads.column("name").to_pylist()]
    hits = np.stack([np.array(heads.column(c), np.int64) for c in ("n0", "n1")])
    place = {k: i for i, k in enumerate(names)}

    def presence(batches):
        for b in batches:
            found = [sorted(place[f] for f in text_features(t) if f in place) for t in utf8(b.column(0))]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.list_(pa.int32()))], ["y", "on"])

    got = sample.select("text", "y").mapInArrow(presence, "y int, on array<int>").toArrow()
    y = np.array(got.column("y"), np.int64)
    lists = got.column("on").combine_chunks()
    sizes = np.diff(np.array(lists.offsets))
    doc = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    feature = np.array(lists.flatten(), np.int32)
    rate = (hits + 0.5) / (rows_of[:, None] + 1)
    lift = rate[1] / rate[0]
    common = hits[1] >= max(MIN_TOXIC, MIN_SHARE * rows_of[1])
    fires = hits * (np.array([counts[0], counts[1]]) / rows_of)[:, None]
    precise = fires[1] >= MIN_PRECISION * fires.sum(0)
    strong = np.flatnonzero((lift >= MIN_LIFT) & common & precise)
    gain = np.where(common, np.abs(np.log(lift)) * np.sqrt(hits[1]), 0.0)
    if not len(strong):
        strong = np.argsort(-np.log(np.maximum(lift, 1e-9)) * np.sqrt(hits[1]))[:8]

    def matrix(columns: np.ndarray) -> np.ndarray:
        at = np.full(len(names), -1)
        at[columns] = np.arange(len(columns))
        x = np.zeros((len(y), len(columns)), np.float32)
        ok = at[feature] >= 0
        x[doc[ok], at[feature[ok]]] = 1
        return x

    by_feature = np.argsort(feature, kind="stable")
    edges = np.searchsorted(feature[by_feature], np.arange(len(names) + 1))
    rows_with = lambda c: doc[by_feature[edges[c]:edges[c + 1]]]

    def distinct(columns: np.ndarray) -> np.ndarray:
        """Of features that occur in the same rows (a word and its beginnings) the first."""
        seen: dict[bytes, int] = {}
        for c in columns.tolist():
            seen.setdefault(rows_with(c).tobytes(), c)
        return np.array(list(seen.values()), np.int64)

    # voters: cover the toxic rows first, then by strength
    order = distinct(strong[np.argsort(-gain[strong], kind="stable")])
    at = np.full(len(names), -1)
    at[order] = np.arange(len(order))
    place_of = at[feature]
    open_rows = y == 1
    voters: list[int] = []
    while len(order) and len(voters) < VOTERS // 2 and open_rows.any():
        new = np.bincount(place_of[(place_of >= 0) & open_rows[doc]], minlength=len(order))
        best = int(np.argmax(new))
        if new[best] < 2:
            break
        voters.append(best)
        open_rows[rows_with(order[best])] = False
    taken = set(voters)
    voters += [i for i in range(len(order)) if i not in taken][:VOTERS - len(voters)]
    weight = np.where(y == 1, counts[1] / rows_of[1], counts[0] / rows_of[0])
    sample_prior = rows_of[1] / rows_of.sum()
    post, _, _ = label_model(matrix(order[voters]).astype(np.float64), sample_prior)
    # from the sample's class frequencies to those of all labelled rows
    odds = post / np.clip(1 - post, 1e-12, None) * (share / (1 - share)) / (sample_prior / (1 - sample_prior))
    target = odds / (1 + odds)
    chosen = np.r_[order[voters], np.argsort(-gain, kind="stable")[:FEATURES]]
    chosen = distinct(chosen[np.sort(np.unique(chosen, return_index=True)[1])])[:FEATURES]
    w, b = linear_classifier(matrix(chosen), target, weight)
    return Model([names[i] for i in chosen], w, b)


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of toxicity of every whole text.

    Null and empty texts have no feature and get the score of the intercept;
    rows are independent, other columns are passed on, an empty table stays empty.
    """
    def run(batches):
        score = model.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([score(t) for t in utf8(b.column(text))], pa.float64())], [*b.schema.names, name])

    return docs.mapInArrow(run, extended(docs.schema, f"{name} double"))
