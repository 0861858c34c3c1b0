"""Deterministic finite-state transducers over bytes, as tables, run over chunks in parallel.

A text block is cut into chunks of equal length.  First every chunk's state map
is found: the state it ends in for each state it may start in (chunks whose
start states have all met go on as a single state).  A parallel prefix scan
composes the maps, in a logarithm of rounds, and so gives each chunk its real
start state; then all chunks run at once and every byte gets the value that
its transition emits.
"""

from __future__ import annotations

import numpy as np

MOST_WIDTH, LEAST_WIDTH, LANES = 512, 32, 2048


class Transducer:
    """``step[state][byte]`` is the next state, ``emit[state][byte]`` the value given out."""

    def __init__(self, step: np.ndarray, emit: np.ndarray, start: int = 0) -> None:
        self.states = len(step)
        self.step = (step.astype(np.int32) * 256).ravel()
        self.emit = emit.astype(np.uint8).ravel()
        self.start = start

    @classmethod
    def build(cls, states: int, rule, start: int = 0) -> Transducer:
        """From ``rule(state, byte) -> (next state, emitted value)``."""
        table = np.array([[rule(s, b) for b in range(256)] for s in range(states)])
        return cls(table[:, :, 0], table[:, :, 1], start)

    def run(self, data: np.ndarray) -> np.ndarray:
        """The value emitted at every byte of ``data`` (uint8), from the start state."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint8)
        width = min(MOST_WIDTH, max(LEAST_WIDTH, n // LANES))
        lanes = -(-n // width)
        padded = np.zeros(lanes * width, np.uint8)
        padded[:n] = data
        columns = np.ascontiguousarray(padded.reshape(lanes, width).T)
        state = self.entries(columns).astype(np.int32) * 256
        out = np.empty((width, lanes), np.uint8)
        for column, values in zip(columns, out):
            state += column
            np.take(self.emit, state, out=values)
            state = self.step[state]
        return np.ascontiguousarray(out.T).ravel()[:n]

    def entries(self, columns: np.ndarray) -> np.ndarray:
        """The state in which each chunk (a column of ``columns``) starts."""
        maps = self.maps(columns)
        shift = 1
        while shift < len(maps):  # maps[k] becomes the map of chunks k - 2 * shift + 1 to k
            maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift], axis=1)
            shift *= 2
        out = np.full(len(maps), self.start, np.int32)
        out[1:] = maps[:-1, self.start]
        return out

    def maps(self, columns: np.ndarray) -> np.ndarray:
        """End state of each chunk for each start state."""
        width, lanes = columns.shape
        out = np.empty((lanes, self.states), np.int32)
        apart, wide = np.arange(lanes), np.tile(np.arange(self.states, dtype=np.int32) * 256, (lanes, 1))
        met, narrow = np.zeros(0, np.int64), np.zeros(0, np.int32)
        for i, column in enumerate(columns):
            if len(met):
                narrow = self.step[narrow + column[met]]
            if len(apart):
                wide = self.step[wide + column[apart][:, None]]
                if i % 8 == 7:
                    same = (wide == wide[:, :1]).all(axis=1)
                    if same.any():
                        met, narrow = np.concatenate([met, apart[same]]), np.concatenate([narrow, wide[same, 0]])
                        apart, wide = apart[~same], wide[~same]
        out[met] = (narrow // 256)[:, None]
        out[apart] = wide // 256
        return out


def joined(texts: list[bytes], separator: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each followed by the one-byte separator, and where each text starts."""
    data = np.frombuffer(separator.join([*texts, b""]), np.uint8)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]).astype(np.int64)
    return data, starts
