"""Token counts by finite-state transducers compiled from a tokenizer's file.

For byte-level BPE with word ends: the file states a normalizer (NFC, white
space runs to one space, lower case), a splitting pattern (contractions,
letter runs, single numbers, runs of other characters), a vocabulary and
merges.  Two deterministic transducers are made of it:

* :func:`splitter` reads the bytes of the normalised text, code points
  replaced by their class, and marks the first byte of each word.  It has eight
  states, so a chunk's state map is complete and chunks compose by prefix scan.
* :class:`Counter` reads the marked bytes and emits token counts.  A token
  sequence is a word's BPE exactly if every token is its own BPE and so is
  every pair of neighbours, so the open ways to read a prefix are few: the
  vocabulary prefixes that end it, each with the token before.  Such a set,
  with the tokens counted so far relative to the least, is a state; a
  transition emits by how much the least count rose.  States are compiled when
  a text first needs them.  Chunks are cut where words start, there the state
  is the start state.  A chunk cut inside a word longer than a chunk is first
  run from the start state and run again from its real one (the end state of
  the chunk before) until both runs meet; its map is constant from there on.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, slices, splitmix, utf8
from .transducer import Transducer, joined

BLOCK_BYTES = 2_000_000
CHUNK = 256
MOST_TRANSITIONS = 1_500_000  # compiled transitions that a worker keeps between blocks
LETTER, NUMBER, SPACE, OTHER, INSIDE = range(128, 133)  # symbols of the bytes above ASCII
START, START_BEFORE, DROP = 1, 2, 4
# Unicode White_Space beyond ASCII (fixed values)
WIDE_SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SUFFIX = "</w>"


def byte_symbols() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable Latin-1
    characters for themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def splitter() -> Transducer:
    """Marks where words start, over bytes below 128 and the class symbols.  ``'s 't 'm 'd 're 've 'll`` are
    words if a word starts with their apostrophe; whether ``'r`` goes on is known one byte later, hence START_BEFORE."""
    blank, done, letters, others, mark, mark_r, mark_v, mark_l = range(8)
    whole, begun = b"stmd", {ord("r"): mark_r, ord("v"): mark_v, ord("l"): mark_l}
    ends = {mark_r: ord("e"), mark_v: ord("e"), mark_l: ord("l")}

    def rule(state: int, b: int) -> tuple[int, int]:
        if b == INSIDE:
            return state, DROP if state == blank else 0
        if state in ends:
            if b == ends[state]:
                return done, 0
            after, out = rule(letters, b)
            return after, out | START_BEFORE
        if state == mark:
            if b in whole:
                return done, 0
            if b in begun:
                return begun[b], 0
            state = others
        if b in b" \t\n\v\f\r" or b == SPACE:
            return blank, DROP
        if 48 <= b <= 57 or b == NUMBER:
            return done, START
        if 65 <= b <= 90 or 97 <= b <= 122 or b == LETTER:
            return letters, 0 if state == letters else START
        if b == ord("'") and state != others:
            return mark, START
        return others, 0 if state == others else START

    return Transducer.build(8, rule)


def code_point_classes() -> np.ndarray:
    """Class symbol of every code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k in "LN":
            kinds[c] = LETTER if k == "L" else NUMBER
    kinds[WIDE_SPACES] = SPACE
    return kinds


def normalised(text: bytes) -> bytes:
    """NFC and lower case, character by character; white space is left to the splitter."""
    if text.isascii():
        return text.lower()
    s = unicodedata.normalize("NFC", text.decode("utf-8", "replace"))
    return s.replace("Σ", "σ").lower().encode()  # no final sigma


class Counter:
    """The counting transducer over byte symbols; 256 is added to the last byte of a word."""

    def __init__(self, vocabulary: dict[str, int], merges: list) -> None:
        chars = byte_symbols()

        def symbols(token: str) -> tuple[int, ...]:
            end = token.endswith(SUFFIX) and token != SUFFIX
            out = [chars[c] for c in (token[:-len(SUFFIX)] if end else token)]
            return (*out[:-1], out[-1] + 256) if end else tuple(out)

        self.spelling: list[tuple[int, ...]] = [()] * (max(vocabulary.values()) + 1)
        self.child: dict[int, int] = {}
        self.token = [-1]  # of a trie node
        self.unit: dict[int, int] = {}  # the token of one symbol
        for token, i in vocabulary.items():
            try:
                spelled = symbols(token)
            except KeyError:  # a special token
                continue
            self.spelling[i] = spelled
            node = 0
            for s in spelled:
                nxt = self.child.get(node << 9 | s)
                if nxt is None:
                    nxt = self.child[node << 9 | s] = len(self.token)
                    self.token.append(-1)
                node = nxt
            self.token[node] = i
            if len(spelled) == 1:
                self.unit[spelled[0]] = i
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault((vocabulary[left], vocabulary[right]), (rank, vocabulary[left + right]))
        self.forget()

    def forget(self) -> None:
        """Drop the compiled states."""
        self.alone: dict[tuple[int, int], bool] = {}
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.size = 0
        self._table(1 << 16)

    def _table(self, slots: int) -> None:
        self.keys = np.full(slots, -1, np.int64)
        self.targets = np.zeros(slots, np.int32)
        self.counts = np.zeros(slots, np.uint8)

    def bpe(self, symbols) -> list[int]:
        """Tokens by repeatedly merging the leftmost pair of least rank."""
        out = [self.unit[s] for s in symbols]
        while len(out) > 1:
            best = min(((self.merge[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in self.merge), default=None)
            if best is None:
                break
            i = best[1]
            out[i:i + 2] = [self.merge[out[i], out[i + 1]][1]]
        return out

    def follows(self, last: int, token: int) -> bool:
        """Whether ``token`` can come after ``last`` (-1: be a word's first) in the BPE of a word."""
        known = self.alone.get((last, token))
        if known is None:
            if last < 0:
                known = self.bpe(self.spelling[token]) == [token]
            else:
                known = self.follows(-1, token) and self.bpe(self.spelling[last] + self.spelling[token]) == [last, token]
            self.alone[last, token] = known
        return known

    def transition(self, state: int, symbol: int) -> tuple[int, int]:
        """Next state and emitted count; compiled from the state's open readings (vocabulary prefix, token before, count)."""
        kept, ended = [], None
        for node, last, count in self.states[state]:
            nxt = self.child.get(node << 9 | symbol)
            if nxt is None:
                continue
            token = self.token[nxt]
            if ended is None and token >= 0 and self.follows(last, token):
                ended = (0, token, count + 1)
            kept.append((nxt, last, count))
        if ended is None:
            raise ValueError("the vocabulary lacks a byte")
        if symbol >= 256:
            return 0, ended[2]
        readings = [*kept, ended]
        least = min(r[2] for r in readings)
        after = tuple((n, t, c - least) for n, t, c in readings)
        number = self.number.get(after)
        if number is None:
            number = self.number[after] = len(self.states)
            self.states.append(after)
        return number, least

    def _add(self, keys: np.ndarray) -> None:
        """Compile transitions (state * 512 + symbol) that the table lacks."""
        found = [self.transition(k >> 9, k & 511) for k in keys.tolist()]
        self._insert(keys, np.array([t for t, _ in found], np.int32), np.array([c for _, c in found], np.uint8))
        if 2 * self.size > len(self.keys):
            full = self.keys >= 0
            old = self.keys[full], self.targets[full], self.counts[full]
            self._table(4 * len(self.keys))
            self.size = 0
            self._insert(*old)

    def _insert(self, keys, targets, counts) -> None:
        mask = len(self.keys) - 1
        slot = splitmix(keys).astype(np.int64) & mask
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            at = left[free]
            self.keys[slot[at]] = keys[at]  # of several keys that want a slot one gets it
            got = np.zeros(len(left), bool)
            got[free] = self.keys[slot[at]] == keys[at]
            won = left[got]
            self.targets[slot[won]], self.counts[slot[won]] = targets[won], counts[won]
            left = left[~got]
            slot[left] = (slot[left] + 1) & mask
        self.size += len(keys)

    def follow(self, state: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted counts of many lanes."""
        keys = state.astype(np.int64) << 9 | symbols
        while True:
            mask = len(self.keys) - 1
            slot = splitmix(keys).astype(np.int64) & mask
            seen = self.keys[slot]
            odd = np.flatnonzero(seen != keys)
            missing = np.zeros(0, np.int64)
            while len(odd):
                none = seen[odd] < 0
                missing = np.concatenate([missing, keys[odd[none]]])
                odd = odd[~none]
                slot[odd] = (slot[odd] + 1) & mask
                seen[odd] = self.keys[slot[odd]]
                odd = odd[seen[odd] != keys[odd]]
            if not len(missing):
                return self.targets[slot], self.counts[slot]
            self._add(np.unique(missing))

    def emitted(self, symbols: np.ndarray, starts: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Count emitted at each symbol of words that start at ``starts``."""
        out = np.zeros(len(symbols), np.uint8)
        if not len(symbols):
            return out
        if self.size > MOST_TRANSITIONS:
            self.forget()
        want = np.arange(0, len(symbols), chunk)
        nearest = starts[np.minimum(np.searchsorted(starts, want), len(starts) - 1)]
        cuts = np.unique(np.where((nearest >= want) & (nearest < want + chunk), nearest, want))
        inside = np.flatnonzero(~np.isin(cuts, starts))  # chunks that start inside a word
        lengths = np.diff(np.append(cuts, len(symbols)))
        path = np.zeros(len(symbols), np.int32) if len(inside) else None
        ends = np.zeros(len(cuts), np.int32)
        self._lanes(symbols, cuts, lengths, np.arange(len(cuts)), np.zeros(len(cuts), np.int32), out, path, ends, False)
        began = np.zeros(len(cuts), np.int32)
        while len(inside):
            inside = inside[ends[inside - 1] != began[inside]]
            began[inside] = ends[inside - 1]
            self._lanes(symbols, cuts, lengths, inside, began[inside], out, path, ends, True)
        return out

    def _lanes(self, symbols, cuts, lengths, lanes, state, out, path, ends, again) -> None:
        """Run chunks together; a second run of a chunk ends where it meets the first."""
        order = np.argsort(-lengths[lanes], kind="stable")
        lanes, state = lanes[order], state[order]
        at, left = cuts[lanes].copy(), lengths[lanes].copy()
        while len(lanes):
            state, count = self.follow(state, symbols[at])
            out[at] = count
            left -= 1
            go = left > 0
            if path is not None:
                same = path[at] == state if again else np.zeros(len(at), bool)
                path[at] = state
                ends[lanes[~go]] = state[~go]
                go &= ~same
            at += 1
            if not go.all():
                lanes, state, at, left = lanes[go], state[go], at[go], left[go]


class Tokenizer:
    """Counts of whole texts; made of the text of a tokenizer's JSON file."""

    def __init__(self, spec: str) -> None:
        parts = json.loads(spec)
        model = parts["model"]
        steps = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != SUFFIX or steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("only lower-casing byte-level BPE files with word ends can be compiled")
        # Special strings are cut out of the raw text, each one token.
        self.special = [t["content"].encode() for t in parts["added_tokens"]]
        self.counter = Counter(model["vocab"], model["merges"])
        self.splitter = splitter()
        self.classes = code_point_classes()

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text (UTF-8)."""
        out = np.zeros(len(texts), np.int64)
        parts: list[bytes] = []
        owner: list[int] = []
        for i, t in enumerate(texts):
            cut = self._cut(t, self.special)
            out[i] = len(cut) - 1
            parts += map(normalised, cut)
            owner += [i] * len(cut)
        np.add.at(out, owner, self._count(parts))
        return out

    def _cut(self, text: bytes, special: list[bytes]) -> list[bytes]:
        """The stretches between special strings."""
        for i, s in enumerate(special):
            if s in text:
                return [p for part in text.split(s) for p in self._cut(part, special[i + 1:])]
        return [text]

    def symbols(self, data: np.ndarray) -> np.ndarray:
        """``data`` with the bytes above ASCII replaced by the class of their code point, or INSIDE."""
        out = data.copy()
        high = np.flatnonzero(data >= 128)
        if len(high):
            out[high] = INSIDE
            lead = high[data[high] >= 0xC0]
            b = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F for k in range(4)]
            first = data[lead].astype(np.int64)
            two = (first & 0x1F) << 6 | b[1]
            three = (first & 0x0F) << 12 | b[1] << 6 | b[2]
            four = (first & 0x07) << 18 | b[1] << 12 | b[2] << 6 | b[3]
            points = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
            out[lead] = self.classes[points]
        return out

    def _count(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0, np.int64)
        data, at = joined(texts, b"\n")
        marks = self.splitter.run(self.symbols(data))
        first = marks & START
        before = np.flatnonzero(marks & START_BEFORE)
        first[before - 1] |= START
        kept = np.flatnonzero((marks & DROP) == 0)
        starts = np.flatnonzero(first[kept])
        symbols = data[kept].astype(np.int64)
        symbols[np.append(starts[1:], len(kept))[:len(starts)] - 1] += 256
        sums = np.concatenate([[0], np.cumsum(self.counter.emitted(symbols, starts), dtype=np.int64)])
        bounds = np.searchsorted(kept, np.append(at, len(data)))
        return sums[bounds[1:]] - sums[bounds[:-1]]


_compiled: dict[bytes, Tokenizer] = {}


def _tokenizer(digest: bytes, packed: bytes) -> Tokenizer:
    if digest not in _compiled:
        _compiled.clear()
        _compiled[digest] = Tokenizer(zlib.decompress(packed).decode())
    return _compiled[digest]


def with_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", bytes_name: str = "n_bytes",
                tokens_name: str = "n_tokens") -> DataFrame:
    """``docs`` with two long columns, UTF-8 bytes and tokens of ``text`` (these replace columns of
    the same names).  Null and empty texts have none; repeated rows count alike; bytes that aren't
    UTF-8 count as U+FFFD; special strings in a text are one token each.  The file is read where the
    driver runs and sent to tasks once; its size doesn't depend on the data.
    """
    with open(tokenizer_path, "rb") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((hashlib.sha256(spec).digest(), zlib.compress(spec)))
    names = [c for c in docs.columns if c not in (bytes_name, tokens_name)]
    rows = docs.select(*names, F.col(text).cast("string").cast("binary").alias("__text"))

    def run(batches):
        tokenizer = _tokenizer(*shared.value)
        for b in batches:
            texts = utf8(b.column(b.num_columns - 1))
            counts = [tokenizer.count(texts[lo:hi]) for lo, hi in slices([len(t) for t in texts], BLOCK_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(np.concatenate(counts or [np.zeros(0, np.int64)]))], [*names, bytes_name, tokens_name])

    return rows.mapInArrow(run, extended(docs.select(*names).schema, f"`{bytes_name}` long, `{tokens_name}` long"))
