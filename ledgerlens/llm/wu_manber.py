"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts become runs of ASCII-lower-cased words between single spaces; every
window of consecutive item words is a byte pattern with a space at both
ends, so a match is a run of whole words.  Patterns of like length form one
matcher: a shift table over hashed byte blocks says how far the next
possible window end lies, blocks with shift zero lead to a bucket of
patterns that end in this block, and a direct comparison confirms them.  The
scan runs over many positions of a batch side by side (numpy lanes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_TABLE, checkpointed, extended, slices, utf8

WINDOW_WORDS = 10
PATTERNS_PER_BLOCK = 200_000  # windows searched in one pass over the documents
LANE = 2048  # bytes of a batch that one lane scans
_SEP = 1  # between documents; no word byte, so no pattern crosses it


class Matcher:
    """Wu-Manber tables for patterns of ``min(len) >= m`` bytes."""

    def __init__(self, patterns: list[bytes], numbers: list[int]) -> None:
        self.patterns, self.numbers = patterns, np.array(numbers, np.int64)
        self.m = min(map(len, patterns))
        self.block = min(8, self.m)  # long blocks: few of them are both frequent and near a pattern's end
        self.bits = min(22, max(12, int(np.ceil(np.log2(16 * len(patterns) * self.m)))))
        widest = self.m - self.block + 1
        self.shift = np.full(1 << self.bits, min(widest, 255), np.uint8)
        heads = np.frombuffer(b"".join(p[:self.m] for p in patterns), np.uint8).reshape(-1, self.m)
        for j in range(widest):  # a block that ends the first m bytes minus (widest-1-j)
            h = self.hashes(heads, np.full(len(heads), j), rows=True)
            np.minimum.at(self.shift, h, np.uint8(min(widest - 1 - j, 255)))
        last = self.hashes(heads, np.full(len(heads), widest - 1), rows=True)
        self.order = np.argsort(last, kind="stable")
        self.bucket = last[self.order]

    def hashes(self, buf: np.ndarray, at: np.ndarray, rows: bool = False) -> np.ndarray:
        x = np.zeros(len(at), np.uint64)
        for i in range(self.block):
            byte = buf[np.arange(len(at)), at + i] if rows else buf[at + i]
            x = (x << np.uint64(8)) | byte.astype(np.uint64)
        x *= np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """All (position, pattern number) occurrences in ``raw``."""
        last = len(raw) - self.m
        if last < 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        buf = np.frombuffer(raw, np.uint8)
        words8 = np.lib.stride_tricks.sliding_window_view(buf, 8).view("<u8")[:, 0] if self.block == 8 else None
        pos = np.arange(0, last + 1, LANE, dtype=np.int64)
        end = np.minimum(pos + LANE, last + 1)
        found_p, found_k = [], []
        while len(pos):
            tail = pos + (self.m - self.block)
            if words8 is not None:
                x = words8[tail].astype(np.uint64).byteswap()
                h = ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
            else:
                h = self.hashes(buf, tail)
            step = self.shift[h].astype(np.int64)
            zero = step == 0
            if zero.any():
                p, hz = pos[zero], h[zero]
                lo = np.searchsorted(self.bucket, hz, "left")
                n = np.searchsorted(self.bucket, hz, "right") - lo
                p = np.repeat(p, n)
                which = self.order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
                for q, k in zip(p.tolist(), which.tolist()):
                    if raw.startswith(self.patterns[k], q):
                        found_p.append(q)
                        found_k.append(k)
                step[zero] = 1
            pos += step
            live = pos < end
            if not live.all():
                pos, end = pos[live], end[live]
        return np.array(found_p, np.int64), self.numbers[np.array(found_k, np.int64)]


def build_matchers(patterns: list[bytes]) -> list[Matcher]:
    """One matcher for each class of length (powers of two), so that a short
    pattern doesn't shorten the skips of the long ones."""
    classes: dict[int, list[int]] = {}
    for i, p in enumerate(patterns):
        classes.setdefault(min(len(p).bit_length(), 6), []).append(i)
    return [Matcher([patterns[i] for i in c], c) for c in classes.values()]


def merged(ranges: list[tuple[int, int]]) -> list[dict]:
    """Sorted (first, last) ranges with those that overlap or touch made one."""
    out: list[dict] = []
    for a, b in ranges:
        if out and a <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], b)
        else:
            out.append({"first": a, "last": b})
    return out


def find_windows(texts: list[bytes], matchers: list[Matcher]):
    """For texts as UTF-8: number of words of each, and the occurrences as
    (document, first word within it, pattern)."""
    runs = [b" ".join(t.translate(WORD_TABLE).split()) for t in texts]
    raw = bytes([_SEP]).join(b" %s " % r for r in runs)
    buf = np.frombuffer(raw, np.uint8)
    spaces = buf == 32
    starts = np.flatnonzero(spaces[:-1] & (buf[1:] > 32)) + 1 if len(buf) > 1 else np.empty(0, np.int64)
    doc_at = np.cumsum([0] + [len(r) + 3 for r in runs])
    first = np.searchsorted(starts, doc_at)
    hits = [m.search(raw) for m in matchers]
    pos = np.concatenate([h[0] for h in hits]) if hits else np.empty(0, np.int64)
    pat = np.concatenate([h[1] for h in hits]) if hits else np.empty(0, np.int64)
    doc = np.searchsorted(doc_at, pos, "right") - 1
    word = np.searchsorted(starts, pos + 1) - first[doc]
    return np.diff(first), doc, word, pat


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text",
                 window: int = WINDOW_WORDS) -> DataFrame:
    """(pattern, length, ids): the distinct windows of the items with the ids
    (as text, sorted) that have them.  Items with a null id, null text or no
    word have none."""
    def run(batches):
        for b in batches:
            ids, pats, sizes = [], [], []
            for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                words = t.translate(WORD_TABLE).split()
                k = min(window, len(words))
                for s in range(len(words) - k + 1 if words and i is not None else 0):
                    ids.append(i)
                    pats.append(b" %s " % b" ".join(words[s:s + k]))
                    sizes.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(pats, pa.binary()), pa.array(sizes, pa.int32())],
                ["id", "pattern", "length"])

    rows = items.select(F.col(key).cast("string"), F.col(text)).mapInArrow(run, "id string, pattern binary, length int")
    return rows.groupBy("pattern", "length").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def occurrences(docs: DataFrame, windows: list, text: str = "text") -> DataFrame:
    """``docs`` with __words (word count), __spans (the words inside any
    occurrence, as disjoint (first, last) ranges) and __items (sorted ids found)."""
    patterns = [bytes(w["pattern"]) for w in windows]
    lengths = np.array([w["length"] for w in windows], np.int64)
    ids = [list(w["ids"]) for w in windows]

    def run(batches):
        matchers = build_matchers(patterns)
        for b in batches:
            texts = utf8(b.column(text))
            n_words, spans, items = [], [], []
            for lo, hi in slices([len(t) for t in texts], 16_000_000):
                n, doc, word, pat = find_windows(texts[lo:hi], matchers)
                n_words += n.tolist()
                found: dict[int, tuple[set, set]] = {}
                for d, w, p in zip(doc.tolist(), word.tolist(), pat.tolist()):
                    s, i = found.setdefault(d, (set(), set()))
                    s.add((w, w + int(lengths[p]) - 1))
                    i.update(ids[p])
                for d in range(hi - lo):
                    s, i = found.get(d, ((), ()))
                    spans.append(merged(sorted(s)))
                    items.append(sorted(i))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(n_words, pa.int64()), pa.array(spans, span_type), pa.array(items, pa.list_(pa.string()))],
                [*b.schema.names, "__words", "__spans", "__items"])

    span_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    schema = extended(docs.schema, "__words long, __spans array<struct<first:int,last:int>>, __items array<string>")
    return docs.mapInArrow(run, schema)


def _window_blocks(items: DataFrame, key: str, text: str, window: int):
    """The item windows in blocks of at most PATTERNS_PER_BLOCK, so what a task
    holds is bounded however many items there are."""
    table = checkpointed(item_windows(items, key, text, window))
    n = table.count()
    blocks = max(1, -(-n // PATTERNS_PER_BLOCK))
    for k in range(blocks):
        part = table if blocks == 1 else table.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k)
        yield part.collect()


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text",
                  window: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: key, n_words, spans (merged hit word ranges as
    (first, last)), n_hit (words inside any occurrence), items (sorted ids of
    the items with an occurrence).

    Null text has no words; a document without words has no hit; an empty
    item table hits nothing; repeated rows and items stay or merge as they
    are; extra columns are ignored.
    """
    plain = docs.select(F.col(key).alias("doc"), F.col(text).alias("txt"))
    parts = [occurrences(plain, w, "txt") for w in _window_blocks(items, item_key, item_text, window)]
    if len(parts) == 1:
        found = parts[0].select("doc", "__words", "__spans", "__items")
    else:  # several blocks of items: put a document's findings together again
        row = [p.withColumn("row", F.xxhash64("doc", "txt")).withColumn("copy", F.row_number().over(
            _copies())).select("doc", "row", "copy", "__words", "__spans", "__items") for p in parts]
        found = row[0]
        for p in row[1:]:
            found = found.unionByName(p)
        found = (found.groupBy("doc", "row", "copy").agg(
            F.max("__words").alias("__words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("__spans")))).alias("__spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("__items")))).alias("__items")))
        found = found.withColumn("__spans", merged_spans("__spans"))
    return found.select(F.col("doc").alias(key), F.col("__words").alias("n_words"),
                        F.col("__spans").alias("spans"), F.col("__items").alias("items")) \
        .withColumn("n_hit", F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)"))


def _copies():
    from pyspark.sql import Window
    return Window.partitionBy("doc", "row").orderBy(F.lit(1))


def merged_spans(spans: str):
    """The same merge for a sorted array column (used when the items came in several blocks)."""
    return F.expr(f"""
        aggregate({spans}, cast(array() as array<struct<first:int,last:int>>), (acc, s) ->
          if(size(acc) > 0 and s.first <= element_at(acc, -1).last + 1,
             concat(slice(acc, 1, size(acc) - 1), array(named_struct('first', element_at(acc, -1).first,
                    'last', greatest(element_at(acc, -1).last, s.last)))),
             concat(acc, array(s))))""")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text",
                      item_key: str = "item_id", item_text: str = "text",
                      window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` without the rows in whose text a window of an item occurs."""
    out = docs
    for windows in _window_blocks(items, item_key, item_text, window):
        out = occurrences(out, windows, text).filter(F.size("__items") == 0).select(*docs.columns)
    return out

