"""Token ids of many texts at once, each different piece encoded once.

A piece is a string between places across which the tokenizer joins nothing: break characters, and the borders between an ASCII letter and an ASCII
punctuation mark (but `'`, which contractions begin with). Both are tested on examples, border by border; no border lies inside a token that is looked for in
the text as a whole. A slice of texts is cut in one vectorised pass, its pieces are told apart, the tokenizers library encodes each different one, and the
ids are gathered back in text order. Where breaks don't hold, texts go to `bpe`'s chunks instead. What a worker keeps between slices is bounded in bytes (the pieces of the last
two generations, `bpe.Pieces`); forgetting only costs time.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import bpe

KEEP = 32 << 20  # bytes of pieces a generation
MARKS = "".join(c for c in string.punctuation if c != "'")


@lru_cache(maxsize=2)
def borders(path: str) -> np.ndarray:
    """Pairs of bytes, at 256 * first + second, between which the tokenizer joins nothing."""
    own = bpe.encoder(path)
    pairs = [(a, m) for a in string.ascii_letters for m in MARKS] + [(m, a) for a in string.ascii_letters for m in MARKS]
    cases = [(x + a, b + y) for a, b in pairs for x in ("", "'", "x") for y in ("", "x", ".")]
    ids = lambda texts: [e.ids for e in own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    apart = np.array([a + b == c for a, b, c in zip(ids([x for x, _ in cases]), ids([y for _, y in cases]), ids([x + y for x, y in cases]), strict=True)]).reshape(len(pairs), -1).all(axis=1)
    out = np.zeros(1 << 16, bool)
    for (a, b), holds in zip(pairs, apart.tolist(), strict=True):
        out[256 * ord(a) + ord(b)] = holds
    for token in own.tokenizer.get_added_tokens_decoder().values():
        inner = token.content.encode()
        for a, b in zip(inner, inner[1:], strict=False):
            out[256 * a + b] = False
    return out


def cut(data: np.ndarray, ends: np.ndarray, breaks: bytes, border: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes without breaks, places where pieces begin and the end, how many pieces stand before each text's end). ends: of texts in data."""
    gap = np.zeros(256, bool)
    gap[list(breaks)] = True
    keep = ~gap[data]
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    begins = np.zeros(before[-1] + 1, bool)
    begins[[0, -1]] = True
    begins[before[ends]] = True
    begins[before[:-1][~keep]] = True
    if len(data) > 1:
        begins[before[1:-1][border[data[:-1].astype(np.uint16) << 8 | data[1:]]]] = True
    places = np.flatnonzero(begins)
    return data[keep], places, np.searchsorted(places, before[ends])


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(from, rows) of stretches of texts of `most` bytes, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + most, side="right")))
        yield low, high - low
        low = high


def encoded(own: bpe.Encoder, path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the texts (null: empty), one after another, and where each text's begin and the last one's end."""
    if not own.breaks or any(b in t.content for t in own.tokenizer.get_added_tokens_decoder().values() for b in own.breaks):
        lists = bpe._encoded(own, column)
        return lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, buffer = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffer, np.uint8)[edges[0] : edges[-1]] if buffer is not None else np.zeros(0, np.uint8)
    kept, places, upto = cut(data, edges[1:] - edges[0], own.breaks.encode(), borders(path))
    pieces = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(kept)]).dictionary_encode()
    if own.pieces.most > KEEP:
        own.pieces = bpe.Pieces(KEEP, own.many)
    known = own.pieces
    which = known.places(pieces.dictionary.cast(pa.large_string()).to_pylist())[pieces.indices.to_numpy()]
    sizes, starts = known.size[which], known.start[which]
    after = np.cumsum(sizes)
    ids = known.flat[np.arange(after[-1] if len(after) else 0) - np.repeat(after - sizes - starts, sizes)]
    return ids, np.concatenate([[0], np.concatenate([[0], after])[upto]])
