"""Exact top-k by inner product over an impact-ordered index.

Vectors are quantised to integers.  In a block of candidates every dimension
holds its posting segments (candidates of equal quantised component) ordered
by component, so for a query the segments of highest impact (query component
times candidate component) are at one end of each list.  A query is processed
score at a time: waves of segments above a falling impact threshold add their
impact to the accumulators.  What a candidate can still gain is at most the
threshold for each dimension it was not met in, so after a wave all but the
candidates whose bound reaches the k-th best exact score so far are proven
out; once those left cost less to score than the segments left, they are
rescored exactly and the block is done.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


SCALE = 256
BLOCK_VECTORS = 16_384  # candidates of one block on average
QUERY_VECTORS = 2_048  # queries of one block on average
WAVES = 12
LARGEST = 1 << 62  # components are cut to plus and minus this
_LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
              scale: int = SCALE) -> DataFrame:
    """(key, q): floor(scale * x) of every component.  Rows whose key or vector
    is null, whose vector is empty, or which hold a null or non-finite
    component are left out; components beyond plus or minus 2^62 count as that."""
    x = F.col(vector)
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (vectors.filter(F.col(key).isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(ok)
            .select(F.col(key).alias("key"),
                    F.transform(x, lambda v: F.floor(F.greatest(F.least(
                v.cast("double") * F.lit(float(scale)), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long")).alias("q")))


class Index:
    """Posting segments of one block, ordered by impact in each dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        by = np.argsort(self.rows, axis=0, kind="stable")
        self.postings = [np.ascontiguousarray(by[:, d]) for d in range(rows.shape[1])]
        self.levels = [self.rows[p, d] for d, p in enumerate(self.postings)]

    def top(self, query: np.ndarray, own: int, k: int, waves: int = WAVES):
        """The k best (score, id) of the block, ties to the smaller id, without ``own``."""
        n, dims = self.rows.shape
        total = n * dims
        ints = query.tolist()
        ends = [(q * int(lv[0]), q * int(lv[-1])) for q, lv in zip(ints, self.levels)]
        if sum(max(map(abs, e)) for e in ends) >= LARGEST:  # sums could pass 64 bits: all are scored in long integers
            exact = self.rows.astype(object) @ query.astype(object)
            return self._best(np.flatnonzero(self.ids != own), exact.clip(-_LONG, _LONG).astype(np.int64), k)
        acc, met = np.zeros(n, np.int64), np.zeros(n, np.int64)
        best_impact = [max(e) for e in ends]
        high, low = max(best_impact), min(min(e) for e in ends)
        # thresholds fall evenly from the highest impact to the lowest
        thresholds = [high - (high - low) * (i + 1) // waves for i in range(waves)]
        done = [0] * dims  # postings processed, from the high-impact end
        processed, alive = 0, self.ids != own
        for t in thresholds:
            for d, q in enumerate(ints):
                lv = self.levels[d]
                if done[d] == n or best_impact[d] < t:
                    continue
                if q == 0:
                    upto = n if t <= 0 else 0
                elif q > 0:  # impact q * level >= t: levels from the top
                    upto = n - int(np.searchsorted(lv, -(-t // q), "left"))
                else:  # negative component: levels from the bottom
                    upto = int(np.searchsorted(lv, t // q, "right"))
                if upto > done[d]:
                    s = slice(n - upto, n - done[d]) if q >= 0 else slice(done[d], upto)
                    at = self.postings[d][s]
                    acc[at] += lv[s] * q
                    met[at] += 1
                    processed += upto - done[d]
                    done[d] = upto
            bound = acc + (dims - met) * t  # a segment not processed yet has an impact below t
            room = min(k, int(alive.sum()))
            if room == 0:
                return []
            lead = np.argpartition(np.where(alive, bound, np.iinfo(np.int64).min), n - room)[n - room:]
            kth = np.sort(self.rows[lead] @ query)[0]
            left = np.flatnonzero(alive & (bound >= kth))
            if len(left) * dims <= max(total - processed, 4096) or processed == total:
                return self._best(left, self.rows[left] @ query, k, picked=True)
        raise AssertionError("the last threshold covers every segment")

    def _best(self, rows: np.ndarray, exact: np.ndarray, k: int, picked: bool = False):
        """The k best (score, id) of ``rows``; ``exact`` are their scores (``picked``) or those of all rows."""
        exact = exact if picked else exact[rows]
        order = np.lexsort((self.ids[rows], -exact))[:k]
        return [(int(exact[o]), int(self.ids[rows][o])) for o in order]


def _blocks(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


def dealt_queries(ask: DataFrame, n: int) -> DataFrame:
    """Distinct queries (key, q) with their block ``qb``, by what they hold: their rows
    come from a shuffle, whose order a task that is run again need not repeat."""
    return ask.withColumn("qb", F.pmod(F.xxhash64("key", "q"), F.lit(n)).cast("int"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id",
          vector: str = "embedding", scale: int = SCALE, block: int = BLOCK_VECTORS,
          query_block: int = QUERY_VECTORS) -> DataFrame:
    """(query_id, rank, key, score): for every query the ``k`` candidates (all,
    if fewer) of highest integer inner product, ties to the smaller key; a
    query is no candidate of its own.

    Every block of queries meets every block of candidates; a task holds one
    block of each.  Vectors of another length than the query's don't compare
    and are no candidates of it.  Repeated keys are candidates each; a repeated
    query is asked once.  Empty tables give an empty result.  A score beyond
    2^63 - 1 in size counts as that.
    """
    cand = quantised(vectors, key, vector, scale)
    ask = quantised(queries, key, vector, scale).distinct()
    nc, nq = _blocks(cand, block), _blocks(ask, query_block)
    # candidates by row, not by key: a key that repeats often must not fill one block
    deal = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    left = (cand.withColumn("cb", deal(nc)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
            .withColumn("dims", F.size("q")))
    right = (dealt_queries(ask, nq).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1))))
             .withColumn("dims", F.size("q")))

    def meet(c: pa.Table, q: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if c.num_rows and q.num_rows:
            dims = c.column("dims")[0].as_py()
            grid = lambda t: np.array(t.column("q").combine_chunks().flatten(), np.int64).reshape(-1, dims)
            index = Index(np.array(c.column("key"), np.int64), grid(c))
            for i, row in zip(q.column("key").to_pylist(), grid(q)):
                out += [(i, s, v) for s, v in index.top(row, i, k)]
        a = np.array(out, np.int64).reshape(-1, 3)
        return pa.table({"query_id": a[:, 0], "score": a[:, 1], "key": a[:, 2]})

    met = (left.groupBy("cb", "qb", "dims").cogroup(right.groupBy("cb", "qb", "dims"))
           .applyInArrow(meet, "query_id long, score long, key long"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("key"))
    return (met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("key").alias(key), "score"))


