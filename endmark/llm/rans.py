"""A static range asymmetric numeral system over 64-bit states, for many blocks at once.

A block is a sequence of symbols dealt in turn to LANES interleaved states: symbol i belongs to lane i mod LANES and
step i div LANES. All blocks share one frequency table whose frequencies sum to 2**SCALE. Steps are encoded from the
last to the first; before a lane takes a symbol it hands over its low 32 bits if the state would leave [2**31, 2**63).
The words stand in the order in which decoding needs them: by step, then by lane. After every CHECK steps the states and the
place in the words are kept as a checkpoint, so each segment between checkpoints decodes by itself. The last step
is filled up with the commonest symbol. Every step works on all lanes of all blocks (or segments) that still have symbols.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LANES, CHECK, SCALE = 64, 512, 20
SEGMENT = LANES * CHECK
_LOW = np.uint64(1 << 31)
_WORD, _SCALE = np.uint64(32), np.uint64(SCALE)
_LIMIT = np.uint64(63 - SCALE)
_MASK = np.uint64((1 << SCALE) - 1)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least one that sum to 2**SCALE, near the shares of the counts (all positive): largest remainders, ties to the first."""
    if len(counts) > 1 << SCALE:
        raise ValueError(f"more than {1 << SCALE} symbols")
    if not len(counts):
        return np.zeros(0, np.uint32)
    total, room = int(counts.sum()), (1 << SCALE) - len(counts)
    exact = [divmod(int(c) * room, total) for c in counts]  # exact for counts of any size
    out = np.array([1 + q for q, _ in exact], dtype=np.int64)
    left = (1 << SCALE) - int(out.sum())
    out[sorted(range(len(exact)), key=lambda k: (-exact[k][1], k))[:left]] += 1
    return out.astype(np.uint32)


class Model(NamedTuple):
    """ids: the symbols' ids in ascending order; the other arrays are indexed by symbol, `symbol` by slot."""

    ids: np.ndarray
    freq: np.ndarray
    start: np.ndarray
    symbol: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, freq: np.ndarray) -> Model:
        start = np.cumsum(freq, dtype=np.uint64) - freq.astype(np.uint64)
        return cls(ids.astype(np.int64), freq.astype(np.uint64), start, np.repeat(np.arange(len(ids), dtype=np.uint32), freq))

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        """The symbol of each id; an id without one is an error."""
        known = np.full(max(int(self.ids.max(initial=0)), int(ids.max(initial=0))) + 1, len(self.ids), np.uint32)
        known[self.ids] = np.arange(len(self.ids))
        at = known[ids]
        if (at == len(self.ids)).any():
            raise ValueError("an id is missing in the frequency table")
        return at


class Coded(NamedTuple):
    """words: one uint32 array per segment; states: uint64 states before each segment, a row per segment."""

    words: list[np.ndarray]
    states: np.ndarray


def encode(model: Model, blocks: list[np.ndarray]) -> list[Coded]:
    """Each block of symbols (not empty), coded."""
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    fill = int(model.freq.argmax()) if len(model.freq) else 0
    sheets = []
    for k in order:
        padded = np.full(-(-len(blocks[k]) // LANES) * LANES, fill, dtype=np.uint32)
        padded[: len(blocks[k])] = blocks[k]
        sheets.append(padded.reshape(-1, LANES))
    steps = np.array([len(s) for s in sheets])
    x = np.full((len(sheets), LANES), _LOW)
    words: list[list[np.ndarray]] = [[] for _ in sheets]
    states: list[list[np.ndarray]] = [[] for _ in sheets]
    for low in reversed(range(0, int(steps.max(initial=0)), CHECK)):
        here = [s[low : low + CHECK] for s in sheets[: int((steps > low).sum())]]
        given, handed = np.empty((len(here[0]), len(here), LANES), np.uint32), np.zeros((len(here[0]), len(here), LANES), bool)
        symbols = np.zeros((len(here[0]), len(here), LANES), np.uint32)
        for b, sheet in enumerate(here):
            symbols[: len(sheet), b] = sheet
        for t in reversed(range(len(here[0]))):
            live = int((steps > low + t).sum())
            s, own = symbols[t, :live], x[:live]
            f = model.freq[s]
            full = own >= f << _LIMIT
            given[t, :live], handed[t, :live] = own & np.uint64(0xFFFFFFFF), full
            own = np.where(full, own >> _WORD, own)
            q = own // f
            x[:live] = (q << _SCALE) + (own - q * f) + model.start[s]
        for b in range(len(here)):
            words[b].append(given[:, b][handed[:, b]])
            states[b].append(x[b].copy())
    out: list[Coded | None] = [None] * len(blocks)
    for b, k in enumerate(order):
        out[k] = Coded(words[b][::-1], np.array(states[b][::-1]).reshape(-1, LANES))
    return out


def decode(model: Model, segments: list[tuple[np.ndarray, np.ndarray, int]]) -> list[np.ndarray]:
    """The symbols of each segment, given as (words, states, number of symbols)."""
    order = sorted(range(len(segments)), key=lambda k: -segments[k][2])
    steps = np.array([-(-segments[k][2] // LANES) for k in order])
    words = np.concatenate([*(segments[k][0] for k in order), np.zeros(LANES, np.uint32)]).astype(np.uint64)
    at = np.cumsum([0, *(len(segments[k][0]) for k in order)])[:-1].reshape(-1, 1)
    ends = at.ravel() + [len(segments[k][0]) for k in order]
    x = np.array([segments[k][1] for k in order], dtype=np.uint64).reshape(-1, LANES)
    found = np.empty((int(steps.max(initial=0)), len(order), LANES), np.uint32)
    for t in range(len(found)):
        live = int((steps > t).sum())
        own = x[:live]
        slot = own & _MASK
        s = model.symbol[slot]
        own = model.freq[s] * (own >> _SCALE) + slot - model.start[s]
        short = own < _LOW
        place = at[:live] + np.cumsum(short, axis=1)
        x[:live] = np.where(short, own << _WORD | words[np.minimum(place - 1, len(words) - 1)], own)
        at[:live] = place[:, -1:]
        found[t, :live] = s
    if (at.ravel() != ends).any():
        raise ValueError("a segment does not end where its words do")
    out: list[np.ndarray | None] = [None] * len(segments)
    for b, k in enumerate(order):
        out[k] = found[: steps[b], b].ravel()[: segments[k][2]]
    return out
