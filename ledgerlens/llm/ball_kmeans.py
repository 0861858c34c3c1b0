"""Vector codes by product quantisation, codebooks trained by ball k-means in exact integers.

A codebook entry and the parts assigned to it form a ball: its radius is the
largest distance of a part to the entry.  An entry further away than twice the
radius is no neighbour: it is nearest to no part of the ball.  Among neighbours
a part at distance d to its own entry can only be nearer to entries at most 2 d
from that one, so parts within half the distance of the nearest neighbour (the
stable core) are not compared at all, and the others, by the annular ring that
d falls in, with that ring's neighbours only.  Any subset of a ball is a ball,
so radii are taken over the rows of a batch and need no pass of their own, and
any assignment is a right start; rows carry the last one along.

Each round is one pass: tasks assign their rows' parts and give sums and counts
for each entry, Spark adds them up, and the driver holds the codebooks (parts x
entries x components integers, whatever the size of the table).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, extended, release

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 62  # components are cut to plus and minus this
SMALL = 1 << 28  # below this, distances fit 64 bits for parts of up to 32 components
BLOCK_ROWS = 8192


def quantised(column: str, scale: int = SCALE):
    """Every component x as floor(scale * x), as long; null for vectors that take no part: null, empty, or with a null
    or non-finite component."""
    x = F.transform(column, lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(float(LARGEST))),
                                                         F.lit(-float(LARGEST)))).cast("long"))
    bad = F.exists(column, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return F.when(F.col(column).isNull() | (F.size(column) == 0) | bad, F.lit(None)).otherwise(x)


def squared(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances over the last axis; Python integers where 64 bits could overflow."""
    gap = x - centre
    return (gap * gap).sum(axis=-1)


def assign(x: np.ndarray, book: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row of ``x`` (ties to the lower index) and its squared distance, from any first ``code``."""
    own = squared(x, book[code])
    between = squared(book[:, None, :], book[None, :, :])
    out, best = code.copy(), own.copy()
    order = np.lexsort((own, code))
    bounds = np.searchsorted(code[order], np.arange(len(book) + 1))
    for i in range(len(book)):
        ball = order[bounds[i]:bounds[i + 1]]  # by distance: a ring and all outside it are one slice
        if not len(ball):
            continue
        reach = own[ball]
        # d(x, j) >= d(i, j) - d(x, i), so j is as near as i only if d(i, j) <= 2 d(x, i): in squares, rounded up
        quarter = (between[i] + 3) // 4
        for j in np.flatnonzero(quarter <= reach[-1]):
            if j == i:
                continue
            ring = ball[np.searchsorted(reach, quarter[j]):]
            d = squared(x[ring], book[j])
            nearer = (d < best[ring]) | ((d == best[ring]) & (j < out[ring]))
            out[ring[nearer]], best[ring[nearer]] = j, d[nearer]
    return out, best


def _parts(column, dims: int, size: int) -> np.ndarray:
    """Rows x parts x components of a binary column of little-endian integers."""
    x = np.frombuffer(b"".join(column.to_pylist()), f"<i{size}").reshape(len(column), PARTS, dims // PARTS)
    return x.astype(np.int64)


def _codes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), PARTS).astype(np.int64)


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def assigned(x: np.ndarray, books: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New codes of all parts and each row's squared error, from the last codes."""
    large = max(abs(int(v)) for v in (x.max(), x.min(), books.max(), books.min())) >= SMALL
    x, books = x.astype(object if large else np.int64), books.astype(object if large else np.int64)
    out, far = np.empty_like(codes), np.zeros(len(x), x.dtype)
    for p in range(PARTS):
        out[:, p], d = assign(x[:, p], books[p], codes[:, p])
        far += d
    return out, far


def _sums(table: DataFrame, books: np.ndarray, dims: int, size: int) -> DataFrame:
    """The table with new codes, followed by one row for each entry of each part and task: count and sums of its parts."""
    names = ["row", "x", "codes", "part", "entry", "n", "sums"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]

    def run(batches):
        totals: dict[tuple[int, int], tuple[int, list[int]]] = {}
        kept = None
        for b in batches:
            kept = b.schema
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                piece = b.slice(lo, BLOCK_ROWS)
                x = _parts(piece.column(1), dims, size)
                codes, _ = assigned(x, books, _codes(piece.column(2)))
                for p in range(PARTS):
                    for e in np.unique(codes[:, p]).tolist():
                        mine = x[codes[:, p] == e, p]
                        n, sums = totals.get((p, e), (0, [0] * mine.shape[1]))
                        new = mine.astype(object) if size == 8 else mine
                        totals[p, e] = n + len(mine), [s + int(v) for s, v in zip(sums, new.sum(axis=0))]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), _binary(codes.astype(np.uint8)),
                     *[pa.nulls(len(codes), k) for k in kinds]], names)
        if totals:
            keys = list(totals)
            values = [[p for p, _ in keys], [e for _, e in keys], [totals[k][0] for k in keys],
                      [[str(v) for v in totals[k][1]] for k in keys]]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(keys), f.type) for f in list(kept)[:3]],
                 *[pa.array(v, k) for v, k in zip(values, kinds)]], names)

    return table.mapInArrow(run, extended(table.schema, "part int, entry int, n long, sums array<string>"))


def _moved(books: np.ndarray, state: DataFrame) -> np.ndarray:
    """Codebooks whose used entries are the floored means of their parts."""
    each = state.filter("part IS NOT NULL").select("part", "entry", "n", F.posexplode("sums").alias("at", "sum"))
    rows = each.groupBy("part", "entry", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")).collect()
    out = books.copy()
    for r in rows:  # parts x entries x components at most
        out[r["part"], r["entry"], r["at"]] = int(r["sum"]) // r["n"]
    return out


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
               columns: tuple[str, ...] = ("label",)) -> tuple[DataFrame, np.ndarray]:
    """(key, ``columns``, codes, error) of every kept row and the codebooks (parts x entries x components).

    ``codes`` is binary, one byte for each part; ``error`` the squared distances summed over the parts, cut to the
    largest long.  Vectors that are null, empty or hold null or non-finite components take no part, nor do those
    whose length is not the first row's or cannot be cut into equal parts.  Rows without a key are coded
    but start no entry.  Components beyond 2^62 / 4096 in size count as that.  Codebooks start from the rows with the smallest keys (rows
    of equal keys by their components); with fewer rows there are fewer entries; without any (or without keys) the result is empty.
    Repeated rows each count.  Rows keep their codes in the shared folder from round to round.
    """
    kept = vectors.select(F.struct(F.col(key).alias("key"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]).alias("row"),
                          quantised(vector).alias("x")).filter(F.size("x") % PARTS == 0)
    by_key = kept.filter(F.col("row.key").isNotNull()).orderBy("row.key", "x")
    first = by_key.limit(1).collect()
    dims = len(first[0]["x"]) if first else PARTS
    kept = kept.filter(F.size("x") == dims)
    start = by_key.filter(F.size("x") == dims).limit(ENTRIES).collect()
    books = np.array([r["x"] for r in start], object).reshape(len(start), PARTS, dims // PARTS).transpose(1, 0, 2)
    largest = kept.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0] or 0
    size = 4 if largest < 1 << 31 else 8
    kind = T.StructField("row", kept.schema["row"].dataType, True)

    def packed(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _binary(x.astype(f"<i{size}")), _binary(np.zeros((b.num_rows, PARTS), np.uint8))],
                ["row", "x", "codes"])

    whole = T.StructType([kind, *T.StructType.fromDDL("x binary, codes binary").fields])
    state = kept.mapInArrow(packed, whole)
    if not start:
        none = kept.filter(F.lit(False)).select("row.*", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"))
        return none.toDF(key, *columns, "codes", "error"), books
    for _ in range(ROUNDS):
        state = checkpointed(_sums(state, _narrow(books, size), dims, size))
        books = _moved(books, state)
        state = state.filter("part IS NULL").select("row", "x", "codes")
        release(vectors.sparkSession)
    final = _narrow(books, size)

    def finish(batches):
        for b in batches:
            if not b.num_rows:
                continue
            codes, far = zip(*[assigned(_parts(p.column(1), dims, size), final, _codes(p.column(2))) for p in
                               (b.slice(lo, BLOCK_ROWS) for lo in range(0, b.num_rows, BLOCK_ROWS))])
            far = np.array([min(int(v), (1 << 63) - 1) for f in far for v in f], np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _binary(np.concatenate(codes).astype(np.uint8)), pa.array(far)], ["row", "codes", "error"])

    done = state.mapInArrow(finish, T.StructType([kind, *T.StructType.fromDDL("codes binary, error long").fields]))
    return done.select("row.*", "codes", "error").toDF(key, *columns, "codes", "error"), books


def _narrow(books: np.ndarray, size: int) -> np.ndarray:
    return books.astype(np.int64) if size == 4 else books


def digest(books: np.ndarray) -> str:
    """SHA-256 of the codebooks' components in decimal, comma-joined by part, entry, position."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.reshape(-1)).encode()).hexdigest()
