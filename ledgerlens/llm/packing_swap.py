"""Packing of tokenised documents into sequences by swap-based local search.

Documents are tokenised where they lie; pieces of full length are sequences
of their own.  The others are dealt into groups of bounded size.  Each group
starts from best fit by falling length and is improved by local search among
its underfull bins: moving a document, exchanging one for one or one for two,
always from a less filled bin into a fuller one, so the sum of squared fills
rises with every step and the least filled bins run empty.  Bins that stay
clearly underfull are dealt again, together with those of other groups.
"""

from __future__ import annotations

import threading
import time
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, extended, slices, utf8

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 16_384  # pieces of one group on average
REPACK_BELOW = 0.98  # bins filled less than this are dealt again
WORD_CACHE = 900_000  # words whose ids a worker remembers in each of two generations
LONG_WORD = 48  # longer words are not remembered
FORGET_AFTER = 15.0  # seconds without a text after which a worker forgets its words

_tokenizers: dict = {}


def _tokenizer(path: str):
    """The tokenizer, the same without its preparation of text (for words of
    a-z, which that leaves as they are), and the words met lately."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        whole, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        plain.normalizer = normalizers.Sequence([])
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        _tokenizers[path] = (whole, plain, {"new": {}, "old": {}, "used": 0.0, "watch": None})
    return _tokenizers[path]


def _forget_when_idle(memory: dict) -> None:
    """Drops a worker's words when it has met no text for ``FORGET_AFTER`` seconds: workers outlive
    a stage, and their memory is the executor's that the next stage's tasks share."""
    while (left := memory["used"] + FORGET_AFTER - time.monotonic()) > 0:
        time.sleep(left)
    memory["old"], memory["new"] = {}, {}


def _in_use(memory: dict) -> None:
    memory["used"] = time.monotonic()
    if memory["watch"] is None or not memory["watch"].is_alive():
        memory["watch"] = threading.Thread(target=_forget_when_idle, args=(memory,), daemon=True)
        memory["watch"].start()


def _encode_runs(words: list[str], mark: str, tokenizer) -> list[bytes]:
    """Ids of each word, little-endian 32-bit.  Words are encoded in runs with a
    mark between them that is in none of them; its id cuts the runs' ids again."""
    (stop,) = tokenizer.encode(mark, add_special_tokens=False).ids
    out: list[bytes] = []
    runs = [f" {mark} ".join(words[lo:lo + 2000]) for lo in range(0, len(words), 2000)]
    for e in tokenizer.encode_batch_fast(runs, add_special_tokens=False):
        ids = np.array(e.ids, "<u4")
        cuts = 4 * np.flatnonzero(ids == stop)
        raw = ids.tobytes()
        out += [raw[s:t] for s, t in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)])]
    return out


def _encode_words(words: list[bytes], whole, plain) -> dict[bytes, bytes]:
    """Ids of each word.  The tokenizer lower-cases first and starts a new token
    where a letter is followed by a mark, so a word of a-z and its final comma
    or full stop are encoded apart."""
    ends = {m: np.array(whole.encode(m.decode(), add_special_tokens=False).ids, "<u4").tobytes() for m in (b",", b".")}
    ends[b""] = b""
    letters: list[tuple[bytes, bytes, bytes]] = []
    others: list[bytes] = []
    out: dict[bytes, bytes] = {}
    for w in words:
        if w.isalpha():
            letters.append((w, w, b""))
        elif w[-1:] in b",." and w[:-1].isalpha():
            letters.append((w, w[:-1], w[-1:]))
        elif b"\x01" in w:
            out[w] = np.array(whole.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        else:
            others.append(w)
    for (w, _, m), ids in zip(letters, _encode_runs([x.lower().decode() for _, x, _ in letters], ".", plain)):
        out[w] = ids + ends[m]
    out.update(zip(others, _encode_runs([w.decode() for w in others], "\x01", whole)))
    return out


def encode(texts: list[bytes], path: str) -> list[bytes]:
    """Ids of each text (UTF-8), as little-endian 32-bit integers.  The
    tokenizer's pre-tokenizer never joins characters across white space, which
    it drops, so a text's ids are those of its words between ASCII white
    space; each word is encoded once and looked up afterwards."""
    whole, plain, memory = _tokenizer(path)
    _in_use(memory)
    split = [t.split() for t in texts]
    if len(memory["new"]) > WORD_CACHE:  # forget words not met since the last time
        memory["old"], memory["new"] = memory["new"], {}
    known, old = memory["new"], memory["old"]
    unknown = set().union(*split) - known.keys()
    again = unknown & old.keys()
    known.update((w, old[w]) for w in again)
    fresh = _encode_words(list(unknown - again), whole, plain)
    known.update(fresh)
    out = [b"".join([known[w] for w in words]) for words in split]
    for w in fresh:
        if len(w) > LONG_WORD:
            del known[w]
    return out


def pieces(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc, piece, start, length, ids_crc32) of every document, null text being empty."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        for b in batches:
            texts = utf8(b.column(1))
            out: list[list] = [[] for _ in range(4)]
            at: list[int] = []
            for lo, hi in slices([len(t) for t in texts], 4_000_000):
                for i, ids in zip(range(lo, hi), encode(texts[lo:hi], tokenizer_path)):
                    ids += end
                    for p, s in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * s:4 * (s + capacity)]
                        at.append(i)
                        for column, v in zip(out, (p, s, len(part) // 4, zlib.crc32(part))):
                            column.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
                ["doc", "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("doc"), F.col(text).cast("string")).mapInArrow(
        run, f"doc {kind}, piece int, start long, length long, ids_crc32 long")


class _Bins:
    """Bins as lists of item lengths; items are (length, number)."""

    def __init__(self, lengths: list[int], capacity: int) -> None:
        self.capacity = capacity
        self.bins: list[list[tuple[int, int]]] = []
        self.fill: list[int] = []
        by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        rooms = 0  # bit r: some bin has room r
        for length, i in sorted(((n, i) for i, n in enumerate(lengths)), key=lambda x: (-x[0], x[1])):
            fit = rooms >> length
            if fit:
                room = length + (fit & -fit).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
                self.bins[b].append((length, i))
                self.fill[b] += length
            else:
                b = len(self.bins)
                self.bins.append([(length, i)])
                self.fill.append(length)
            room = capacity - self.fill[b]
            by_room[room].append(b)
            rooms |= 1 << room

    def improve(self, most_passes: int = 8) -> None:
        """Passes of local search over the underfull bins until none helps."""
        for _ in range(most_passes):
            if not self._one_pass():
                break

    def _one_pass(self) -> int:
        under = sorted((b for b in range(len(self.bins)) if 0 < self.fill[b] < self.capacity),
                       key=lambda b: (-self.fill[b], b))
        if len(under) < 2:
            return 0
        # givers: the least filled bins, as many as could run empty
        spare = sum(self.capacity - self.fill[b] for b in under)
        givers, kept = [], 0
        for b in reversed(under):
            if givers and kept + self.fill[b] > spare:
                break
            givers.append(b)
            kept += self.fill[b]
        givers = set(givers[:max(1, len(under) // 2)])
        stock: list[list[tuple[int, int]]] = [[] for _ in range(self.capacity + 1)]  # by length: (bin, item)
        lengths = 0
        for b in sorted(givers):
            for n, i in self.bins[b]:
                stock[n].append((b, i))
                lengths |= 1 << n

        def largest(most: int) -> int:
            return (lengths & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 else -1

        def take(n: int) -> tuple[int, int]:
            nonlocal lengths
            b, i = stock[n].pop()
            if not stock[n]:
                lengths &= ~(1 << n)
            self.bins[b].remove((n, i))
            self.fill[b] -= n
            return b, i

        def give(b: int, n: int, i: int) -> None:
            nonlocal lengths
            self.bins[b].append((n, i))
            self.fill[b] += n
            stock[n].append((b, i))
            lengths |= 1 << n

        steps = 0
        for a in under:
            if a in givers:
                continue
            pairs = True  # one for two is tried
            while self.fill[a] < self.capacity and lengths:
                gap = self.capacity - self.fill[a]
                best = (0, None, ())  # gain, what leaves, what comes
                n = largest(gap)  # move
                if n > 0:
                    best = (n, None, (n,))
                    m = largest(gap - n)  # two moves at once
                    if m > 0 and (m != n or len(stock[n]) > 1):
                        best = (n + m, None, (n, m))
                for x in self.bins[a]:
                    if best[0] == gap:
                        break
                    n = largest(x[0] + gap)  # one for one
                    if n - x[0] > best[0]:
                        best = (n - x[0], x, (n,))
                    n = largest((x[0] + gap) // 2) if pairs else -1  # one for two
                    m = largest(x[0] + gap - n) if n > 0 else -1
                    if m > 0 and (m != n or len(stock[n]) > 1) and n + m - x[0] > best[0]:
                        best = (n + m - x[0], x, (n, m))
                gain, leaves, comes = best
                if gain <= 0:
                    break
                taken = [(n, *take(n)) for n in comes]
                homes = [home for _, home, _ in taken]
                if leaves is not None:
                    room = [h for h in homes if self.fill[h] + leaves[0] <= self.capacity]
                    after = {h: self.fill[h] + (leaves[0] if room and h == room[0] else 0) for h in homes}
                    before = {h: self.fill[h] + sum(n for n, g, _ in taken if g == h) for h in homes}
                    squares = (self.fill[a] + gain) ** 2 + sum(f * f for f in after.values())
                    if not room or squares <= self.fill[a] ** 2 + sum(f * f for f in before.values()):
                        for n, home, i in taken:  # it doesn't fit there: leave things as they were
                            give(home, n, i)
                        if not pairs:
                            break
                        pairs = False
                        continue
                    self.bins[a].remove(leaves)
                    self.fill[a] -= leaves[0]
                    give(room[0], *leaves)
                for n, _, i in taken:
                    self.bins[a].append((n, i))
                    self.fill[a] += n
                steps += 1
        return steps


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins as lists of item numbers, by best fit and local search."""
    state = _Bins(lengths, capacity)
    state.improve()
    return [[i for _, i in b] for b in state.bins if b]


def _pack_groups(items: DataFrame, groups: int, level: int, capacity: int) -> DataFrame:
    """Pack each of ``groups`` groups; sequence_id is unique over levels and groups.
    ``items`` is checkpointed, so dealing by row number holds when a task is run again."""
    cols = items.columns

    def run(key, table):
        order = table.sort_by([("doc", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = order.column("length").to_pylist()
        sequence, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
        for b, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = b, at
                at += lengths[i]
            fill[members] = at
        base = (level << 60) + (key[0].as_py() << 24)
        return order.select(cols).append_column("sequence_id", pa.array(sequence + base)) \
            .append_column("offset", pa.array(offset)).append_column("fill", pa.array(fill))

    dealt = items.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(level)), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(run, extended(items.schema, "sequence_id long, offset long, fill long"))


def packed(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP_PIECES) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    A document's ids are its text's and ``end_id``; only documents of more
    than ``capacity`` ids are cut.  Sequences hold at most ``capacity`` ids and
    offsets in them are gapless from 0.  Null and empty texts are one id long;
    repeated rows are packed each; an empty table gives an empty result.
    """
    cut = checkpointed(pieces(docs, tokenizer_path, key, text, capacity, end_id))
    whole = cut.filter(F.col("length") == capacity).select(
        "*", ((F.lit(3).cast("long") * F.lit(1 << 60)) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rest = cut.filter(F.col("length") < capacity)
    out, level, n = [whole], 0, rest.count()
    while n:
        groups = max(1, -(-n // group))
        done = checkpointed(_pack_groups(rest, groups, level, capacity))
        low = F.col("fill") < int(capacity * REPACK_BELOW)
        if groups == 1 or level == 2:
            out.append(done.drop("fill"))
            break
        out.append(done.filter(~low).drop("fill"))
        rest = done.filter(low).select(*cut.columns)
        level, n = level + 1, rest.count()
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result.withColumnRenamed("doc", key)
