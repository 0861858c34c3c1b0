"""Secret scan: patterns, and character Markov models for strings that no pattern names.

Bigram counts of characters are gathered over all documents: what a pattern
labels as a secret trains one model of random strings for each kind, all
other text trains the model of ordinary identifiers and words.  A long run of
token characters outside the patterns' spans is a secret if its
log-likelihood under the best random model exceeds that under the ordinary
model by ``threshold``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, extended, slices, utf8

# Kinds in listed order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1  # 0: anything else, that is the edge of a run
MIN_RUN = 16  # characters of a run that the models judge
THRESHOLD = 13.8  # log-likelihood ratio, about a million to one
UNIFORM = 0.2  # share of uniform strings in the model of each kind
BACKOFF = 5.0  # weight of single characters in the ordinary model
ADDED = "markov"

_CODES = bytes(ALPHABET.find(bytes([b])) + 1 for b in range(256))
_NOT_HEX = bytes(0 if b in b"0123456789abcdef" else 1 for b in range(256))


def base_spans(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, order of kind, kind, value start, end) of the pattern matches, in order."""
    out = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST["assign"]:
            out.append((m.start(), 0, "assign", m.start(2), m.end()))
    for order, kind, pattern in ((1, "access", ACCESS), (2, "hex", HEX)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= LEAST[kind]:
                out.append((m.start(), order, kind, m.start(), m.end()))
    return sorted(out)


def _long_runs(raw: bytes, stops: bytes, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of at least ``least`` bytes that the table ``stops`` maps to zero."""
    edge = np.flatnonzero(np.frombuffer(raw.translate(stops), np.uint8))
    edge = np.r_[-1, edge, len(raw)]
    long = np.diff(edge) - 1 >= least
    return edge[:-1][long] + 1, edge[1:][long]


_NOT_TOKEN = bytes(0 if c else 1 for c in _CODES)


def _suspects(texts: list[bytes]) -> list[int]:
    """Texts in which some pattern can match (an exact test for each kind's fixed part)."""
    hexes = set()
    raw = b"\0".join(texts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    start, _ = _long_runs(raw, _NOT_HEX, LEAST["hex"])
    hexes.update(np.searchsorted(ends, start, "right").tolist())
    out = []
    for i, t in enumerate(texts):
        low = t.translate(LOWER)
        if i in hexes or b"AKIA" in t or any(w in low for w in WORDS):
            out.append(i)
    return out


def bigrams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, pair, n): counts of neighbouring characters over all texts, for each
    kind of labelled secret and for the ordinary rest."""
    def count(codes: np.ndarray) -> np.ndarray:
        return np.bincount(codes[:-1].astype(np.int32) * STATES + codes[1:], minlength=STATES * STATES)

    def run(batches):
        for b in batches:
            texts = utf8(b.column(0))
            total = {k: np.zeros(STATES * STATES, np.int64) for k in (*KINDS, "ordinary")}
            for lo, hi in slices([len(t) for t in texts], 8_000_000):
                part = texts[lo:hi]
                values: dict[str, list[bytes]] = {k: [] for k in KINDS}
                for i in _suspects(part):
                    t = part[i].decode()
                    spans = base_spans(t)
                    kept, at = [], 0
                    for start, _, kind, value, end in spans:
                        values[kind].append(t[value:end].encode())
                        if start >= at:  # spans of two kinds may overlap
                            kept.append(t[at:start])
                        at = max(at, end)
                    part[i] = "\0".join([*kept, t[at:]]).encode()
                for kind, found in {**values, "ordinary": part}.items():
                    joined = b"\0" + b"\0".join(found) + b"\0"
                    codes = np.frombuffer(joined.translate(_CODES), np.uint8).copy()
                    if kind == "ordinary":  # long runs of letters and digits are what is to be judged
                        for s, e in zip(*_long_runs(joined, _NOT_TOKEN, MIN_RUN)):
                            digit = (codes[s:e] > 52) & (codes[s:e] < 63)
                            if digit.any() and not digit.all():
                                codes[s:e] = 0
                    total[kind] += count(codes)
            kinds, pairs, ns = [], [], []
            for kind, n in total.items():
                at = np.flatnonzero(n)
                kinds += [kind] * len(at)
                pairs += at.tolist()
                ns += n[at].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(pairs, pa.int32()),
                                              pa.array(ns, pa.int64())], ["kind", "pair", "n"])

    return (docs.select(text).mapInArrow(run, "kind string, pair int, n long")
            .groupBy("kind", "pair").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log ratios (random model, from, to): of each kind, and of uniform strings, against the ordinary one.
    At most (kinds + 1) x 68 x 68 counts reach the driver."""
    counts = {k: np.ones((STATES, STATES)) for k in (*KINDS, "ordinary")}
    for r in bigrams(docs, text).collect():
        counts[r["kind"]].reshape(-1)[r["pair"]] += r["n"]
    ordinary = counts.pop("ordinary") - 1
    single = (ordinary.sum(0) + 1) / (ordinary.sum() + STATES)
    # what was never seen after a character counts by how rare it is at all
    usual = np.log((ordinary + BACKOFF * single) / (ordinary.sum(1, keepdims=True) + BACKOFF))
    random = [np.log((1 - UNIFORM) * c / c.sum(1, keepdims=True) + UNIFORM / STATES) for c in counts.values()]
    random.append(np.full_like(usual, -np.log(STATES)))  # strings of any characters alike
    return np.stack([r - usual for r in random]).astype(np.float32)


def ratio(codes: np.ndarray, model: np.ndarray) -> float:
    """Best log-likelihood ratio of a run (its codes with an edge at both ends)."""
    return float(model[:, codes[:-1], codes[1:]].sum(1).max()) - float(np.log(len(model)))


def scan(docs: DataFrame, model: np.ndarray, text: str = "text", min_run: int = MIN_RUN,
         threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with __spans: array of (kind, start, end, score) in code points,
    end exclusive, by start and then kind; score is null for pattern matches.

    Every text is read whole; null counts as empty and has no span.  Rows are
    independent, so repeated rows repeat their spans and an empty table stays
    empty; other columns are passed on.
    """
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                    ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            texts = utf8(b.column(text))
            column: list[list[dict]] = [[] for _ in texts]
            for lo, hi in slices([len(t) for t in texts], 8_000_000):
                part = texts[lo:hi]
                known: dict[int, list] = {}
                for i in _suspects(part):
                    known[i] = base_spans(part[i].decode())
                raw = b"\0".join(part)
                ends = np.cumsum([len(t) + 1 for t in part])
                begin, stop = _long_runs(raw, _NOT_TOKEN, min_run)
                codes = np.frombuffer(raw.translate(_CODES), np.uint8)
                added: dict[int, list[tuple[int, int, float]]] = {}
                for s, e, i in zip(begin.tolist(), stop.tolist(), np.searchsorted(ends, begin, "right").tolist()):
                    score = ratio(np.r_[0, codes[s:e], 0], model)
                    if score >= threshold:
                        zero = int(ends[i]) - len(part[i]) - 1
                        added.setdefault(i, []).append((s - zero, e - zero, score))
                for i in known.keys() | added.keys():
                    spans = [(s, o, k, e, None) for s, o, k, _, e in known.get(i, [])]
                    for s, e, score in added.get(i, []):
                        a = len(part[i][:s].decode())
                        z = a + (e - s)
                        if all(z <= x[0] or a >= x[3] for x in spans):
                            spans.append((a, len(KINDS), ADDED, z, score))
                    column[lo + i] = [{"kind": k, "start": s, "end": e, "score": v}
                                      for s, o, k, e, v in sorted(spans, key=lambda x: (x[0], x[1]))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(column, kind_type)], [*b.schema.names, "__spans"])

    return docs.mapInArrow(run, extended(
        docs.schema, "__spans array<struct<kind:string,start:long,end:long,score:double>>"))
