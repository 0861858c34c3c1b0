"""Shared pieces: the hold-out rule, ASCII words, graph components, block sizes."""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, materialize

# 10 words a window, word characters and so on are stated by each operator;
# these two byte tables are used by several of them.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def keep_bytes(keep) -> bytes:
    """Translation table: A-Z lower-cased, bytes that ``keep`` refuses become spaces."""
    return bytes(LOWER[b] if keep(LOWER[b]) else 32 for b in range(256))


# Letters a-z, digits and every byte of a non-ASCII character.
WORD_TABLE = keep_bytes(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder of ``spark.checkpoint.dir`` (reliable)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark) -> None:
    """Let Spark's cleaner drop the shuffle and checkpoint files of tables that
    nothing refers to any more: it acts when the driver's JVM collects garbage,
    which a driver with a small heap share in use may not do for a long time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remainder(key: str, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod``; -1 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % mod, F.lit(-1)).cast("int")


def remainder_sql(key: str, mod: int) -> str:
    """Spark SQL text of :func:`remainder` (DuckDB has no crc32)."""
    return f"coalesce(crc32(cast(cast({key} as string) as binary)) % {mod}, -1)"


def extended(schema: T.StructType, ddl: str) -> T.StructType:
    """A copy of ``schema`` with more fields."""
    return T.StructType(schema.fields + T.StructType.fromDDL(ddl).fields)


def utf8(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string or binary column; null becomes empty."""
    import pyarrow as pa
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def slices(sizes, most: int):
    """Consecutive index ranges whose sizes sum to at most ``most`` (one item at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def splitmix(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit integers (public SplitMix64 finaliser); wraps silently."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Forest:
    """Union-find over 64-bit ids seen by one task; ``join`` says whether the
    link was new, so a task emits a spanning forest of its links only."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.parent
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(x, x)) != r:
            up[x] = r
            x = p
        return r

    def join(self, a: int, b: int) -> bool:
        ra, rb = self.root(a), self.root(b)
        if ra == rb:
            return False
        self.parent[max(ra, rb)] = min(ra, rb)
        self.parent.setdefault(min(ra, rb), min(ra, rb))
        return True


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links of comparable ids -> (node, component), component being the
    smallest id reachable.

    Each round hooks every node to its first neighbour in an order by hash and
    contracts the links; rounds end when no link between different nodes is
    left, after about the log of the node count, as the hash order makes even
    a long chain of consecutive ids fall into short pieces.  Minima are aggregated
    before the shuffle, so a node with a third of all links is no hot group.
    Every round is written out; nothing is collected.  Links are written as
    Parquet, whose files tell their size: a checkpoint keeps the planner's
    estimate, the product of those of all tables joined, whose digits triple with
    each round until the driver's memory goes into multiplying them.
    """
    links = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "links", wide=True)
    levels: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        place = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        hooks = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min(place("b")).alias("m"))
                             .select("node", F.least(place("node"), F.col("m"))["v"].alias("up")))
        levels.append(hooks)
        links = materialize(
            links.join(hooks.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a")
            .join(hooks.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
            .filter("ua <> ub").select(F.greatest("ua", "ub").alias("a"), F.least("ua", "ub").alias("b"))
            .distinct(), "links", wide=True)
    if not levels:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = levels[0].select("node", F.col("up").alias("component"))
    for hooks in levels[1:]:
        step = hooks.select(F.col("node").alias("component"), "up")
        out = out.join(step, "component", "left").select(
            "node", F.coalesce("up", "component").alias("component"))
    out = materialize(out, "components", wide=True)
    smallest = out.groupBy(F.col("component").alias("root")).agg(F.min("node").alias("low"))
    return out.join(smallest, F.col("component") == F.col("root")).select("node", F.col("low").alias("component"))
