"""How five document filters interact: what each one removes first, again, alone and on average over all orders.

A transducer of five states reads the bytes of a text once.  Every transition
emits what it has seen: the start or the end of a word, a code point, a capital,
a listed symbol.  The spans between start and end go into a hash table, where a
span meets its like: spans are hashed eight bytes at a time and equal hashes are
compared byte by byte, so the count of distinct words is exact.  The rest is
counting: texts that occur again are found by digest, and documents that fail
the same filters are counted together, so 120 orders cost 120 x 5 rows for each
set of failed filters, not for each document.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, slices, splitmix, utf8
from .transducer import Transducer, joined

FILTERS = "ABCDE"
FEWEST_WORDS = 100
DISTINCT_PERCENT = 80  # at least
CAPITAL_PERCENT = 10  # at most
SYMBOLS = b"#$%&*|"
BLOCK_BYTES = 2_000_000
WORD_START, WORD_END, CODE_POINT, CAPITAL, SYMBOL = 1, 2, 4, 8, 16


def scanner() -> Transducer:
    """State 0 is between words, state 1 inside one; 2 to 4 are inside one with 1 to 3 bytes of a code point to come.
    A byte that can't stand where it is counts as a code point of its own."""

    def rule(state: int, b: int) -> tuple[int, int]:
        if b == 32 or 9 <= b <= 13:
            return 0, CODE_POINT | (WORD_END if state else 0)
        out = 0 if state else WORD_START
        if 0x80 <= b < 0xC0:
            return (state - 1, out) if state > 1 else (1, out | CODE_POINT)
        if b >= 0xC0:
            return (2 if b < 0xE0 else 3 if b < 0xF0 else 4), out | CODE_POINT
        return 1, out | CODE_POINT | (CAPITAL if 65 <= b <= 90 else 0) | (SYMBOL if b in SYMBOLS else 0)

    return Transducer.build(5, rule)


class Spans:
    """Words of a block as spans, read eight bytes at a time."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.eights = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded.data, 0, (1,))
        self.starts, self.lengths = starts, lengths

    def part(self, which: np.ndarray, k: int) -> np.ndarray:
        """The ``k``-th eight bytes of each span, zero after its end."""
        left = np.clip(self.lengths[which] - 8 * k, 0, 8).astype(np.uint64)
        value = self.eights[self.starts[which] + 8 * k]
        return np.where(left == 8, value, value & ((np.uint64(1) << (left * np.uint64(8))) - np.uint64(1)))

    def hashes(self, seed: np.ndarray) -> np.ndarray:
        out = splitmix(seed.astype(np.uint64) << np.uint64(32) ^ self.lengths.astype(np.uint64))
        live, k = np.arange(len(self.starts)), 0
        while len(live):
            out[live] = splitmix(out[live] ^ self.part(live, k))
            k += 1
            live = live[self.lengths[live] > 8 * k]
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a`` and ``b`` hold the same bytes."""
        out = self.lengths[a] == self.lengths[b]
        live, k = np.flatnonzero(out), 0
        while len(live):
            same = self.part(a[live], k) == self.part(b[live], k)
            out[live[~same]] = False
            k += 1
            live = live[same]
            live = live[self.lengths[a[live]] > 8 * k]
        return out


def distinct_words(spans: Spans, owner: np.ndarray, owners: int, mixer=None) -> np.ndarray:
    """Distinct spans of each owner: open addressing, all spans at once.  A span that finds a free slot claims it;
    one that finds its like (same owner, hash and bytes) is a repeat; any other goes on to the next slot."""
    n = len(owner)
    out = np.zeros(owners, np.int64)
    if not n:
        return out
    hashes = (mixer or spans.hashes)(owner)
    mask = (1 << (2 * n - 1).bit_length()) - 1
    table = np.full(mask + 1, -1, np.int64)
    slot = (hashes & np.uint64(mask)).astype(np.int64)
    left = np.arange(n)
    while len(left):
        free = left[table[slot[left]] < 0]
        table[slot[free]] = free
        there = table[slot[left]]
        mine = there == left
        np.add.at(out, owner[left[mine]], 1)
        left, there = left[~mine], there[~mine]
        like = (owner[left] == owner[there]) & (hashes[left] == hashes[there])
        like[like] = spans.equal(left[like], there[like])
        left = left[~like]
        slot[left] = (slot[left] + 1) & mask
    return out


def measure(texts: list[bytes], machine: Transducer) -> dict[str, np.ndarray]:
    """Words, distinct words, code points, capitals and symbols of each text."""
    data, at = joined(texts, b"\n")
    seen = machine.run(data)
    total = lambda bit: np.add.reduceat((seen & bit) != 0, at, dtype=np.int64)
    starts = np.flatnonzero(seen & WORD_START)
    lengths = np.flatnonzero(seen & WORD_END) - starts
    owner = np.searchsorted(at, starts, "right") - 1
    return {"words": np.bincount(owner, minlength=len(texts)),
            "distinct": distinct_words(Spans(data, starts, lengths), owner, len(texts)),
            "points": total(CODE_POINT) - 1,  # without the mark after the text
            "capitals": total(CAPITAL), "symbols": total(SYMBOL)}


def failures(m: dict[str, np.ndarray]) -> np.ndarray:
    """Bit i is set if filter ``FILTERS[i]`` fails (A to D)."""
    tests = [m["words"] < FEWEST_WORDS, 100 * m["distinct"] < DISTINCT_PERCENT * m["words"],
             100 * m["capitals"] > CAPITAL_PERCENT * m["points"], m["symbols"] > 0]
    return sum(t.astype(np.int64) << i for i, t in enumerate(tests))


def marked(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(key, part, digest, fails) of every row: SHA-256 of the text, bits of the failed filters A to D."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(whole, 256)).alias("digest"), whole.alias("text"))

    def run(batches):
        machine = scanner()
        for b in batches:
            texts = utf8(b.column(3))
            found = [failures(measure(texts[lo:hi], machine)) for lo, hi in slices([len(t) for t in texts], BLOCK_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(np.concatenate(found or [np.zeros(0, np.int64)]), pa.int32())],
                ["key", "part", "digest", "fails"])

    return rows.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, part string, digest binary, fails int")


def failure_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   part: str = "lang") -> DataFrame:
    """(part, fails, n, good, toxic): documents of each part by the set of filters they fail, A to E.

    A row fails E if a row with a smaller key has the same text anywhere in the table; rows without a key never do and
    make no other row fail.  A document is good (toxic) if any labels row of its key has quality (toxic) 1.
    """
    marks = checkpointed(marked(docs, key, text, part))
    groups = ["part", "digest", "fails"]
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        flag("quality").alias("good"), flag("toxic").alias("toxic"))
    keyed = (marks.filter("key IS NOT NULL").groupBy("key", *groups).agg(F.count("*").alias("n"))
             .join(known, "key", "left")
             .select("key", *groups, "n", F.coalesce("good", F.lit(False)).alias("good"),
                     F.coalesce("toxic", F.lit(False)).alias("toxic")))
    # Copies are counted before they meet: one row for each text, part and label, with its first key and that key's rows.
    copies = checkpointed(keyed.groupBy(*groups, "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "n")).alias("first")))
    first = copies.groupBy("digest").agg(F.min("first.key").alias("key"), F.count("*").alias("rows"))
    # A text in one row only needs no join: its first key's rows pass, all others fail.
    passing = F.when(F.col("first.key") == F.col("least"), F.col("first.n")).otherwise(F.lit(0))
    split = copies.join(first.select("digest", F.col("key").alias("least")), "digest").select(
        "part", "fails", "n", "good", "toxic", passing.cast("long").alias("passing"))
    last = 1 << FILTERS.index("E")
    each = split.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("fails").alias("fails"), F.col("passing").alias("n")),
        F.struct((F.col("fails") + last).alias("fails"), (F.col("n") - F.col("passing")).alias("n")))).alias("x"))
    keyless = marks.filter("key IS NULL").groupBy("part", "fails").agg(F.count("*").alias("n"))
    rows = each.select("part", "x.fails", "x.n", "good", "toxic").unionByName(
        keyless.select("part", "fails", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic")))
    counted = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0)))
    return rows.filter("n > 0").groupBy("part", "fails").agg(
        F.sum("n").alias("n"), counted("good").alias("good"), counted("toxic").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row for each part, order of the five filters and step in that order; an empty table has no parts.

    Columns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.  Null
    texts are empty, null parts the empty string; see :func:`failure_counts` for keys and labels.
    """
    sets = checkpointed(failure_counts(docs, labels, key, text, part))
    steps = F.explode(F.array([
        F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(i + 1).alias("step"),
                 F.lit(1 << FILTERS.index(order[i])).alias("bit"),
                 F.lit(sum(1 << FILTERS.index(f) for f in order[:i])).alias("before"))
        for order in permutations(FILTERS) for i in range(len(FILTERS))]))
    fails, bit, before = F.col("fails"), F.col("s.bit"), F.col("s.before")
    here, earlier = fails.bitwiseAND(bit) != 0, fails.bitwiseAND(before) != 0
    removed = here & ~earlier
    alone = fails == bit
    # Each of a document's k failed filters comes first in 120 / k orders.
    share = F.lit(120) / F.bit_count(fails)
    sums = lambda when, what: F.coalesce(F.sum(F.when(when, what)), F.lit(0)).cast("long")
    return sets.withColumn("s", steps).groupBy("part", "s.filter_order", "s.step").agg(
        sums(~here & ~earlier, F.col("n")).alias("kept"), sums(removed, F.col("n")).alias("removed"),
        sums(here & earlier, F.col("n")).alias("redundant"), sums(alone, F.col("n")).alias("unique_fails"),
        sums(removed, F.col("good")).alias("good_lost"), sums(removed, F.col("toxic")).alias("toxic_lost"),
        sums(here, F.col("n") * share.cast("long")).alias("shapley"))
