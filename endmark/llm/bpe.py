"""BPE encoding by content-defined chunk reuse, and decoding.

A rolling hash of the last eight bytes cuts each text at places that depend on its content alone, so passages
that documents share fall into the same chunks wherever they stand. A worker encodes each chunk once, as if it were a
text, and keeps its token ids. Where chunks meet the ids may be wrong: the join is repaired by encoding anew a window
of pieces on both sides of it. If the window's ids begin and end with those of its outer pieces, as their chunks have
them, the ids between replace the pieces between; else the window grows until they agree, or until it holds
the chunks whole, then their neighbours.

Pieces are what a chunk's ids can be cut into. If the tokenizer joins nothing across the break characters (`breaks_hold`, on
examples), the pieces of a chunk are the strings between breaks: they are told apart for a whole batch at once and each different one is
encoded once (`breaks=""` turns that off). Otherwise chunks are encoded whole and the pieces are the tokenizer's own words, by their offsets.

There is no shuffle and nothing is broadcast. What a worker remembers is bounded in bytes (chunks and pieces of the
last two generations) and lives as long as it does, so chunks are encoded once per worker and window; forgetting only
costs time. Texts of any length are handled, with or without spaces; null and empty texts give no ids and decode to the empty text.
Rows, their order and extra columns are kept; columns named like the results are replaced.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BREAKS = " \n"
CHUNK_BITS = 10  # a cut about every 1024 bytes
#: Bytes of chunks and of pieces that a worker keeps a generation, with what Python needs beside them; the longest piece kept.
KEEP_CHUNKS, KEEP_PIECES, LONGEST = 24 << 20, 64 << 20, 256
SAME = 2  # outer pieces that must agree on either side of a window
ENOUGH = 8  # pieces that a chunk must hold, or it is put together with the next
EDGE = 96  # bytes on either side of a join that are tried first
SLICE = 4 << 20  # bytes of texts handled at once (or one text)
EXAMPLES = ("a", "it's", "Zé", "#!", "\u0301x", "12", " ")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def cuts(data: np.ndarray) -> np.ndarray:
    """Byte places p (8 <= p < len) where a chunk ends: the hash of the 8 bytes before p has CHUNK_BITS leading zeros and p starts a character."""
    if len(data) < 9:
        return np.zeros(0, dtype=np.int64)
    last8 = np.ndarray((len(data) - 8,), dtype="<u8", buffer=data, strides=(1,))
    with np.errstate(over="ignore"):
        hit = np.flatnonzero((last8 * _ODD) >> np.uint64(64 - CHUNK_BITS) == 0) + 8
    return hit[(data[hit] & 0xC0) != 0x80]


class Remembered:
    """Values by key, of the last two generations of `most` bytes each."""

    def __init__(self, most: int):
        self.most, self.bytes, self.new, self.old = most, 0, {}, {}

    def get(self, key):
        got = self.new.get(key)
        return self.old.get(key) if got is None else got

    def keep(self, key, value, size: int) -> None:
        if self.bytes >= self.most:
            self.old, self.new, self.bytes = self.new, {}, 0
        self.new[key] = value
        self.bytes += size + 200  # a dictionary's entry and two objects


class Pieces(Remembered):
    """Ids of strings, all in one array; a string's value is its place in `start` and `size`. `encode` gives (ids, sizes) of strings that are missing."""

    def __init__(self, most: int, encode):
        super().__init__(most)
        self.encode = encode
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, texts: list[str]) -> np.ndarray:
        """The place of each string (all different)."""
        if self.bytes >= self.most:
            self._turn()
        new, old = self.new, self.old
        out = [new.get(t, -1) for t in texts]
        missing = []
        for k, at in enumerate(out):
            if at < 0:
                at = out[k] = old.get(texts[k], -1)
                if at < 0:
                    missing.append(k)
                else:
                    self._count(texts[k], at)
        if missing:
            ids, size = self.encode([texts[k] for k in missing])
            first = len(self.start)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, ids])
            for n, k in enumerate(missing):
                out[k] = first + n
                self._count(texts[k], first + n)
        return np.array(out, dtype=np.int64)

    def _count(self, text: str, at: int) -> None:
        if len(text) <= LONGEST:  # a longer one stands in the array until the next turn only
            self.new[text] = at
            self.bytes += 160 + len(text) + 4 * int(self.size[at]) if at < len(self.size) else 0

    def _turn(self) -> None:
        """The new generation is the old one; ids of none other are kept."""
        names, at = list(self.new), np.fromiter(self.new.values(), dtype=np.int64, count=len(self.new))
        self.flat = self.ids(at)
        self.size = self.size[at]
        self.start = np.cumsum(self.size) - self.size
        self.old, self.new, self.bytes = dict(zip(names, range(len(names)), strict=True)), {}, 0

    def ids(self, places: np.ndarray) -> np.ndarray:
        """The ids at these places, one after another."""
        own = self.size[places]
        ends = np.cumsum(own)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - own - self.start[places], own)]


Piece = tuple[str, bytes]  # a text and its packed ids


class Encoder:
    """Token ids are kept packed, four bytes each, so that pieces are put together by joining bytes."""

    def __init__(self, path: str, breaks: str = BREAKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._break_bytes = [b.encode() for b in breaks]
        self.breaks = breaks if breaks and breaks_hold(self.tokenizer, breaks) else ""
        added = self.tokenizer.get_added_tokens_decoder()
        # no window ends closer to a join than the longest token that is looked for in the text as a whole
        self.margin = max([len(t.content) for t in added.values()], default=0)
        self.between_texts = next((x for x in added.items() if self._parts_texts(*x)), None)
        self.pieces, self.chunks = Pieces(KEEP_PIECES, self.many), Remembered(KEEP_CHUNKS)

    def _parts_texts(self, no: int, token) -> bool:
        """Whether an added token keeps what stands before and after it apart, on examples."""
        ids = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        return not (token.lstrip or token.rstrip or token.single_word or token.normalized) and all(ids(a + token.content + b) == [*ids(a), no, *ids(b)] for a in EXAMPLES for b in EXAMPLES)

    def direct(self, texts: list[str]) -> list[bytes]:
        """Packed ids, straight from the library."""
        ids, size = self.many(texts)
        every, ends = ids.tobytes(), (4 * np.cumsum(size)).tolist()
        return [every[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one text after another, and how many each has. Short texts go to the library many at a time with an added token between."""
        flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for low in range(0, len(texts), 4096):
            group = texts[low : low + 4096]
            if self.between_texts:
                no, token = self.between_texts
                joined = [token.content.join(group[k : k + 64]) for k in range(0, len(group), 64)]
                got = np.concatenate([np.array([*x.ids, no], dtype=np.int32) for x in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
                at = np.flatnonzero(got == no)
                if len(at) == len(group):  # else a text holds the token itself
                    flat.append(np.delete(got, at))
                    sizes.append(np.diff(np.r_[-1, at]) - 1)
                    continue
            one = [x.ids for x in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
            flat.append(np.array([i for x in one for i in x], dtype=np.int32))
            sizes.append(np.array([len(x) for x in one], dtype=np.int64))
        return np.concatenate(flat), np.concatenate(sizes)

    # pieces

    def words(self, text: str) -> list[Piece]:
        """A text cut before each word of the tokenizer, in order; the texts add up to it and the ids to its ids."""
        coded = self.tokenizer.encode(text, add_special_tokens=False)
        out, start, at = [], 0, 0
        for k in range(1, len(coded.ids)):
            edge = coded.offsets[k][0]
            if coded.word_ids[k] != coded.word_ids[k - 1] and coded.offsets[k - 1][1] <= edge and edge > start:
                out.append((text[start:edge], array("i", coded.ids[at:k]).tobytes()))
                start, at = edge, k
        return [*out, (text[start:], array("i", coded.ids[at:]).tobytes())]

    def between(self, texts: list[str]) -> list[list[Piece]]:
        """Texts cut behind each break."""
        split = []
        for text in texts:
            whole = text
            for b in self.breaks[1:]:
                whole = whole.replace(b, self.breaks[0])
            parts, at, own = whole.split(self.breaks[0]), 0, []
            for part in parts:
                own.append(text[at : at + len(part) + 1])
                at += len(part) + 1
            split.append((own, parts))
        ids = self.pieces_of(list({p for _, parts in split for p in parts}))
        return [[(t, ids[p]) for t, p in zip(own, parts, strict=True)] for own, parts in split]

    def pieces_of(self, texts: list[str]) -> dict[str, bytes]:
        """The packed ids of strings without breaks."""
        places = self.pieces.places(texts)
        every, ends = self.pieces.ids(places).tobytes(), (4 * np.cumsum(self.pieces.size[places])).tolist()
        return {t: every[a:b] for t, a, b in zip(texts, [0, *ends], ends, strict=False)}

    def cut(self, text: str) -> list[Piece]:
        return self.between([text])[0] if self.breaks else self.words(text)

    # chunks

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Packed ids of each chunk, as a text by itself."""
        got = [self.chunks.get(c) for c in chunks]
        missing = [k for k, x in enumerate(got) if x is None]
        if missing:
            new = [chunks[k] for k in missing]
            for k, chunk, ids in zip(missing, new, self._spans(new) if self.breaks else self.direct([c.decode() for c in new]), strict=True):
                got[k] = ids
                self.chunks.keep(chunk, ids, len(chunk) + len(ids))
        return got

    def _spans(self, chunks: list[bytes]) -> list[bytes]:
        """The same by pieces between breaks: told apart in one pass, each different one encoded once, and their ids gathered in one."""
        text = pa.array(chunks, pa.large_binary()).cast(pa.large_string())
        for b in self.breaks[1:]:
            text = pc.replace_substring(text, b, self.breaks[0])
        lists = pc.split_pattern(text, self.breaks[0])
        coded = lists.flatten().dictionary_encode()
        places = self.pieces.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        every = self.pieces.ids(places).tobytes()
        ends = 4 * np.r_[0, np.cumsum(self.pieces.size[places])]
        edges = ends[lists.offsets.to_numpy()].tolist()
        return [every[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    # joins

    def units(self, chunks: list[bytes]) -> list[bytes]:
        """The chunks, those with too few pieces put together with the next."""
        out: list[bytes] = []
        held, have, tried = [], 0, 0
        for chunk in chunks:
            held.append(chunk)
            if self.breaks:
                have += sum(map(chunk.count, self._break_bytes))
            elif sum(map(len, held)) >= 2 * tried:  # looked at again when it has doubled, so the work stays in proportion
                have, tried = len(self.words(b"".join(held).decode())), sum(map(len, held))
            if have >= ENOUGH:
                out.append(chunk if len(held) == 1 else b"".join(held))
                held, have, tried = [], 0, 0
        if held:
            last = b"".join(held)
            out = [*out[:-1], out[-1] + last] if out and have < ENOUGH else [*out, last]
        return out

    def _agrees(self, left: list[Piece], right: list[Piece], ids: bytes) -> bytes | None:
        """What stands between the outer pieces of a window, if its ids begin and end with theirs."""
        first, last = b"".join(i for _, i in left[:SAME]), b"".join(i for _, i in right[-SAME:])
        if first and last and len(ids) >= len(first) + len(last) and ids.startswith(first) and ids.endswith(last):
            return ids[len(first) : len(ids) - len(last)]
        return None

    def _wide(self, left: list[Piece], right: list[Piece], wide: int) -> tuple[list[Piece], list[Piece]] | None:
        """The pieces of a window of `wide` inner pieces on either side, None if it is too narrow for a token that spans the join."""
        a, b = left[-wide - SAME :], right[: wide + SAME]
        if len(a) <= SAME or len(b) <= SAME or min(sum(len(t) for t, _ in a[SAME:]), sum(len(t) for t, _ in b[:-SAME])) < self.margin:
            return None
        return a, b

    def repair(self, left: list[Piece], right: list[Piece]) -> tuple[list[Piece], list[Piece]] | None:
        """(pieces before the join that stay, pieces from there on): windows grow until they agree; None if none does."""
        wide = 1
        while True:
            window = self._wide(left, right, wide)
            if window:
                a, b = window
                ids = self._agrees(a, b, self.direct(["".join(t for t, _ in [*a, *b])])[0])
                if ids is not None:
                    a, b = len(a) - SAME, len(b) - SAME
                    middle = "".join(t for t, _ in [*left[len(left) - a :], *right[:b]])
                    return left[: len(left) - a], [(middle, ids), *right[b:]]
            if wide + SAME >= max(len(left), len(right)):
                return None
            wide *= 2

    def by_windows(self, units: list[bytes]) -> bytes:
        """Packed ids of a text: each join by windows that grow, two units without agreement encoded as one."""
        out, left = [], self.cut(units[0].decode())
        for unit in units[1:]:
            right = self.cut(unit.decode())
            got = self.repair(left, right)
            if got is None:
                left = self.cut("".join(t for t, _ in [*left, *right]))
            else:
                out += [i for _, i in got[0]]
                left = got[1]
        return b"".join([*out, *[i for _, i in left]])

    def _edges(self, joins: list[tuple[bytes, bytes]]) -> list[tuple[int, int, bytes, int, int] | None]:
        """The first windows of many joins at once, from the last and first bytes of the units that meet: (bytes of ids to take from the left, from the
        right, what to put in, bytes of the outer pieces' ids left and right); None where a wider window is needed."""
        table, one = bytes.maketrans(b"".join(self._break_bytes), self._break_bytes[0] * len(self._break_bytes)), self._break_bytes[0]
        out: list[tuple[int, int, bytes, int, int] | None] = [None] * len(joins)
        todo = []
        for k, (a, b) in enumerate(joins):
            left, right = a.translate(table), b.translate(table)
            # breaks around the outer pieces: left of the inner ones, right of them
            l1 = left.rfind(one, 0, len(left) - self.margin)
            l3 = l1
            r1 = right.find(one, self.margin)
            r3 = r1
            for _ in range(SAME):
                l3 = left.rfind(one, 0, l3) if l3 > 0 else -1
                r3 = right.find(one, r3 + 1) if r3 >= 0 else -1
            if l3 >= 0 and r3 >= 0:
                todo.append((k, (a[l3 + 1 :] + b[:r3]).decode(), [x.decode().split(one.decode()) for x in (left[l3 + 1 : l1], left[l1 + 1 :], right[:r1], right[r1 + 1 : r3])]))
        ids = self.pieces_of(list({p for _, _, parts in todo for x in parts for p in x}))
        for (k, _, parts), got in zip(todo, self.direct([w for _, w, _ in todo]), strict=True):
            first, inner_left, inner_right, last = (b"".join(map(ids.__getitem__, x)) for x in parts)
            if first and last and len(got) >= len(first) + len(last) and got.startswith(first) and got.endswith(last):
                out[k] = len(inner_left), len(inner_right), got[len(first) : len(got) - len(last)], len(first), len(last)
        return out

    def encode_texts(self, texts: list[list[bytes]]) -> list[bytes]:
        """Packed ids of texts given as their chunks."""
        texts = [self.units(chunks) if len(chunks) > 1 else chunks for chunks in texts]
        if not self.breaks:
            return [self.by_windows(units) if len(units) > 1 else self.encode_chunks(units)[0] if units else b"" for units in texts]
        different = list({u for units in texts for u in units})
        ids = dict(zip(different, self.encode_chunks(different), strict=True))
        joins = list({(a[-EDGE:], b[:EDGE]) for units in texts for a, b in zip(units, units[1:], strict=False)})
        fixed = dict(zip(joins, self._edges(joins), strict=True))
        return [self._joined(units, ids, fixed) for units in texts]

    def _joined(self, units: list[bytes], ids: dict[bytes, bytes], fixed: dict) -> bytes:
        out = [ids[units[0]]] if units else []
        for a, b in zip(units, units[1:], strict=False):
            join, right = fixed[a[-EDGE:], b[:EDGE]], ids[b]
            # outer pieces must lie in what no other window has replaced
            if join is None or join[0] + join[3] > len(out[-1]) or join[1] + join[4] > len(right):
                return self.by_windows(units)
            out[-1] = out[-1][: len(out[-1]) - join[0]]
            out += [join[2], right[join[1] :]]
        return b"".join(out)

    def encode_text(self, text: str) -> list[int]:
        data = text.encode()
        at = [0, *cuts(np.frombuffer(data, dtype=np.uint8)).tolist(), len(data)]
        return list(memoryview(self.encode_texts([[data[a:b] for a, b in zip(at, at[1:], strict=False)]])[0]).cast("i"))


@lru_cache(maxsize=2)
def encoder(path: str, breaks: str = BREAKS) -> Encoder:
    return Encoder(path, breaks)


def breaks_hold(tokenizer, breaks: str) -> bool:
    """Whether the tokenizer joins nothing across the breaks in the examples."""
    ids = lambda x: tokenizer.encode(x, add_special_tokens=False).ids
    return all(ids(left + b + right) == ids(left) + ids(right) for b in breaks for left in EXAMPLES for right in EXAMPLES)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [(f, c) for f, c in zip(batch.schema, batch.columns, strict=True) if f.name.lower() != name.lower()]
    return pa.RecordBatch.from_arrays([*[c for _, c in kept], values], schema=pa.schema([*[f for f, _ in kept], pa.field(name, values.type)]))


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(from, rows) of stretches of SLICE bytes, which bounds what a worker holds beside the batch it was sent."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())).to_numpy() if pa.types.is_string(column.type) else 64 * np.arange(1, len(column) + 1)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + SLICE, side="right")))
        yield low, high - low
        low = high


def _encoded(own: Encoder, column: pa.Array) -> pa.Array:
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    coded = _coded(own, data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data is not None else b"", ends - ends[0])
    at = np.cumsum([0, *map(len, coded)]) // 4
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(coded), dtype=np.int32)))


def _coded(own: Encoder, data: bytes, ends: np.ndarray) -> list[bytes]:
    places = cuts(np.frombuffer(data, dtype=np.uint8))
    low = np.searchsorted(places, ends[:-1] + 8)  # the window lies inside the text
    high = np.searchsorted(places, ends[1:])
    texts = []
    for k in range(len(ends) - 1):
        edges = [int(ends[k]), *places[low[k] : high[k]].tolist(), int(ends[k + 1])]
        texts.append([data[a:b] for a, b in zip(edges, edges[1:], strict=False)])
    return own.encode_texts(texts)


def _decoded(own: Encoder, column: pa.Array) -> pa.Array:
    column = column.cast(pa.list_(pa.int32())).fill_null([])
    at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    ids = [flat[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]  # far cheaper than to_pylist()
    return pa.array(own.tokenizer.decode_batch(ids, skip_special_tokens=False), pa.string())


def _apply(df: DataFrame, path: str, breaks: str, steps: list[tuple[str, str, object, T.DataType]], drop: tuple[str, ...] = ()) -> DataFrame:
    """df with a column for each step (input, output, function, type), computed in one pass; without the columns of drop."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, breaks)
        for batch in batches:
            for at, rows in _slices(batch.column(batch.schema.get_field_index(steps[0][0]))):
                part = batch.slice(at, rows)
                for source, name, of, _ in steps:
                    part = _with_column(part, name, of(own, part.column(part.schema.get_field_index(source))))
                yield part.select([f.name for f in part.schema if f.name not in drop])

    fields = list(df.schema)
    for _, name, _, kind in steps:
        fields = [f for f in fields if f.name.lower() != name.lower()] + [T.StructField(name, kind)]
    return df.mapInArrow(run, T.StructType([f for f in fields if f.name not in drop]))


IDS, TEXT = T.ArrayType(T.IntegerType()), T.StringType()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", breaks: str = BREAKS) -> DataFrame:
    """docs with the token ids (array<int>) of each text."""
    return _apply(docs, path, breaks, [(text, ids, _encoded, IDS)])


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the text that the token ids stand for, special tokens included; null ids stand for none."""
    return _apply(df, path, BREAKS, [(ids, text, _decoded, TEXT)])


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", breaks: str = BREAKS) -> DataFrame:
    """docs without the text, with its token ids and what they decode to, in one pass over the rows."""
    return _apply(docs, path, breaks, [(text, ids, _encoded, IDS), (ids, decoded, _decoded, TEXT)], (text,))
