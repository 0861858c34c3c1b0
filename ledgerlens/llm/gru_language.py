"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads runs of text between ASCII white space (A-Z lower-cased,
cut after ``SEGMENT`` bytes) byte by byte in both directions, with the state
reset between runs, and labels every byte position with a distribution over
the languages.  The positions' log-probabilities are pooled to those of their
run, of which a share is taken for noise, and the runs' to the document's.
Because the state is reset between runs, equal runs have
equal labels: each distinct run of a batch goes through the network once.

Weights are trained in numpy by backpropagation through time with Adam, on
runs of a bounded sample of labelled documents (``SAMPLE`` of each language,
chosen by a hash of the key).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, extended, slices, utf8

SAMPLE = 300  # documents of each language that the network is trained on
SAMPLE_BYTES = 6_000  # bytes of such a document that are used for training
LANGUAGES = 200  # languages the network can tell apart (the most frequent)
SEGMENT = 24  # bytes of a run at most
HIDDEN = 24
STEPS = 1_500
BATCH = 256
MEMORY = 200_000  # runs whose pooled labels a worker remembers
POOL = 0.35  # weight of a position's log-probability: neighbours are no independent witnesses
NOISE = 0.1  # share of runs (numbers, names, codes) that say nothing about the language


def segments(text: bytes) -> list[bytes]:
    """The runs of a text."""
    words = text.lower().split()
    if all(len(w) <= SEGMENT for w in words):
        return words
    return [w[i:i + SEGMENT] for w in words for i in range(0, len(w), SEGMENT)]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _padded(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes + 1 as (time, run), zero after the end, and the mask."""
    width = max(map(len, runs))
    x = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in runs), np.uint8).reshape(-1, width).T.astype(np.int64)
    mask = np.arange(width)[:, None] < np.array([len(r) for r in runs])[None, :]
    return np.where(mask, x + 1, 0), mask


class Network:
    """One GRU in each direction and a softmax over both states at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        f = np.float32
        self.p: dict[str, np.ndarray] = {}
        for d in ("f", "b"):
            # rows of w: input byte (0 is padding); columns: update, reset and candidate parts
            self.p["w" + d] = rng.normal(0, 0.3, (257, 3 * hidden)).astype(f)
            self.p["u" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 2 * hidden)).astype(f)
            self.p["c" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, hidden)).astype(f)
        self.p["o"] = rng.normal(0, 0.1, (2 * hidden, len(languages))).astype(f)
        self.p["ob"] = np.zeros(len(languages), f)

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States (time, run, hidden) of direction ``d``, and what backward needs."""
        h_size, (steps, n) = self.hidden, x.shape
        w, u, c = self.p["w" + d], self.p["u" + d], self.p["c" + d]
        h = np.zeros((n, h_size), np.float32)
        states = np.empty((steps, n, h_size), np.float32)
        trace = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = w[x[t]]
            g = _sigmoid(a[:, :2 * h_size] + h @ u)
            z, r = g[:, :h_size], g[:, h_size:]
            m = np.tanh(a[:, 2 * h_size:] + (r * h) @ c)
            new = np.where(mask[t][:, None], h + z * (m - h), h)
            if keep:
                trace.append((t, h, z, r, m))
            h = states[t] = new
        return states, trace

    def logs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities (time, run, language) of every position, and the mask."""
        x, mask = _padded(runs)
        both = np.concatenate([self._run(d, x, mask, False)[0] for d in "fb"], 2)
        z = both @ self.p["o"] + self.p["ob"]
        z -= z.max(2, keepdims=True)
        return z - np.log(np.exp(z).sum(2, keepdims=True)), mask

    def pooled(self, runs: list[bytes]) -> np.ndarray:
        """Sum over positions of the log-probabilities of each run (run, language)."""
        out = np.empty((len(runs), len(self.languages)), np.float32)
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        for lo in range(0, len(order), 2048):
            part = order[lo:lo + 2048]
            logs, mask = self.logs([runs[i] for i in part])
            out[part] = (logs * mask[:, :, None]).sum(0)
        return out

    def gradients(self, runs: list[bytes], label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions and its gradients, through time."""
        x, mask = _padded(runs)
        h_size, n, total = self.hidden, len(runs), float(mask.sum())
        (sf, tf), (sb, tb) = self._run("f", x, mask, True), self._run("b", x, mask, True)
        both = np.concatenate([sf, sb], 2)
        z = both @ self.p["o"] + self.p["ob"]
        z -= z.max(2, keepdims=True)
        prob = np.exp(z)
        prob /= prob.sum(2, keepdims=True)
        loss = -float(np.log(prob[:, np.arange(n), label] + 1e-12)[mask].sum()) / total
        dz = prob
        dz[:, np.arange(n), label] -= 1
        dz *= mask[:, :, None] / np.float32(total)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["o"] = np.tensordot(both, dz, ([0, 1], [0, 1]))
        g["ob"] = dz.sum((0, 1))
        dboth = dz @ self.p["o"].T
        for d, trace, part in (("f", tf, dboth[:, :, :h_size]), ("b", tb, dboth[:, :, h_size:])):
            u, c = self.p["u" + d], self.p["c" + d]
            dh = np.zeros((n, h_size), np.float32)
            for t, h, zt, r, m in reversed(trace):
                dh = dh + part[t]
                live = mask[t][:, None]
                dn = np.where(live, dh, 0)
                dm = dn * zt * (1 - m * m)
                dzt = dn * (m - h) * zt * (1 - zt)
                drh = dm @ c.T
                dr = drh * h * r * (1 - r)
                gates = np.concatenate([dzt, dr], 1)
                dx = np.concatenate([gates, dm], 1)
                np.add.at(g["w" + d], x[t], dx)
                g["u" + d] += h.T @ gates
                g["c" + d] += (r * h).T @ dm
                dh = np.where(live, dn * (1 - zt) + drh * r + gates @ u.T, dh)
        return loss, g

    def train(self, runs: list[bytes], label: np.ndarray, steps: int = STEPS, batch: int = BATCH,
              rate: float = 0.01, seed: int = 11) -> float:
        """Adam over random batches that hold every language alike; the last mean loss."""
        rng = np.random.default_rng(seed)
        by = [np.flatnonzero(label == k) for k in range(len(self.languages))]
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        loss = 0.0
        for t in range(1, steps + 1):
            pick = np.concatenate([rng.choice(i, max(1, batch // len(by))) for i in by])
            now, g = self.gradients([runs[i] for i in pick], label[pick])
            loss = now if t == 1 else 0.98 * loss + 0.02 * now
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for k, v in g.items():
                v *= min(1.0, 1.0 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                step = (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
                self.p[k] -= np.float32(rate * (1 - t / (steps + 1))) * step.astype(np.float32)
        return loss


@dataclass
class Identifier:
    """A trained network with a bounded memory of pooled runs."""

    network: Network | None
    languages: list[str]
    memory: dict = field(default_factory=dict)

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """Language and its pooled probability; ``und`` and 0 without a letter."""
        split = [segments(t) for t in texts]
        if len(self.memory) > MEMORY:
            self.memory.clear()
        met = list(set().union(*split))
        new = [r for r in met if r not in self.memory]
        if new and self.network is not None:
            z = POOL * self.network.pooled(new)
            e = np.exp(z - z.max(1, keepdims=True))
            e = (1 - NOISE) * e / e.sum(1, keepdims=True) + NOISE / len(self.languages)
            self.memory.update(zip(new, np.log(e)))
        names, scores = [], []
        place = {r: i for i, r in enumerate(met)}
        logs = np.array([self.memory[r] for r in met]) if self.network is not None and met else None
        for text, runs in zip(texts, split):
            if not self.languages or not has_letter(text.decode()):
                names.append("und")
                scores.append(0.0)
            elif self.network is None:
                names.append(self.languages[0])
                scores.append(1.0)
            else:
                z = logs[[place[r] for r in runs]].sum(0, dtype=np.float64)
                e = np.exp(z - z.max())
                k = int(np.argmax(z))
                names.append(self.languages[k])
                scores.append(float(e[k] / e.sum()))
        return names, scores


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        learn: Column | None = None) -> Identifier:
    """Train on rows with a text and a language for which ``learn`` holds."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = (rows.filter(learn) if learn is not None else rows).select(
        F.col(key).cast("string").alias("key"), F.col(lang).alias("lang"),
        F.xxhash64(F.col(key).cast("string"), F.lit(1)).alias("h"), F.col(text).alias("text"))
    most = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in most)
    if len(languages) < 2:
        return Identifier(None, languages)
    # keys of the sample first (narrow rows), then their texts; a share by hash
    # leaves about twice as many rows of each language as are ranked
    share = F.lit(1.0)
    for r in most:
        share = F.when(F.col("lang") == r["lang"], min(1.0, (2 * SAMPLE + 50) / r["count"])).otherwise(share)
    few = rows.filter(F.col("lang").isin(languages) & (F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "key"))
    chosen = checkpointed(few.select("lang", "key", "h").withColumn("rank", rank)
                          .filter(F.col("rank") <= SAMPLE).select("key", "lang").distinct())
    sample = rows.join(F.broadcast(chosen), ["key", "lang"]).select("lang", F.substring("text", 1, SAMPLE_BYTES).alias("text"))
    runs: list[bytes] = []
    label: list[int] = []
    for r in sample.dropDuplicates().orderBy("lang", "text").toLocalIterator():
        found = segments(r["text"].encode())
        runs += found
        label += [languages.index(r["lang"])] * len(found)
    present = sorted(set(label))
    if len(present) < 2:
        return Identifier(None, languages[:1])
    if len(present) < len(languages):  # languages whose sample has no run
        languages = [languages[k] for k in present]
        label = [present.index(k) for k in label]
    network = Network(languages)
    network.train(runs, np.array(label))
    return Identifier(network, languages)


def identified(docs: DataFrame, model: Identifier, text: str = "text") -> DataFrame:
    """``docs`` with __lang and __score.  Whole texts are read; null texts and
    texts without a letter get ``und`` and score 0.  Rows are independent and
    other columns pass through; an empty table stays empty."""
    def run(batches):
        for b in batches:
            texts = utf8(b.column(text))
            names: list[str] = []
            scores: list[float] = []
            for lo, hi in slices([len(t) for t in texts], 4_000_000):
                n, s = model.predict(texts[lo:hi])
                names += n
                scores += s
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             [*b.schema.names, "__lang", "__score"])

    return docs.mapInArrow(run, extended(docs.schema, "__lang string, __score double"))
