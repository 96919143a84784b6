"""Phrase collocations by level-wise passes (Apriori).

Texts are lower-cased (A-Z), split at `[.,;:!?\\x0A-\\x0D]` into pieces and these into words `[^\\x20\\x09]+`. Level 1 counts all words. The pass of
level k reads the texts again with the frequent (k-1)-grams sent along and emits a k-gram only where both of its (k-1)-grams are frequent; its counts are
exact, so what the level keeps is too. Scores are cut from the level tables.

Level 2 has by far the most different grams, so its pass counts their digests first; the grams themselves are counted where the digest's sum reaches the
threshold (those of a frequent gram do, whatever shares it). The same reading keeps, of each text, the stretches in which all neighbours may be frequent pairs, three words
long at least: all occurrences of longer frequent phrases lie in them, and the later levels read nothing else.

What is sent along is a bitmap of 64-bit digests of the frequent grams (language and words): 16 bits a gram or more, at most 2**MOST_BITS bits (64 MB). Two grams
that share a bit let a gram through that the count then drops; so results are the same at every size, and only pruning weakens beyond some 2**25 frequent grams a level.
A worker counts what it holds (SLICE bytes of texts) before anything is shuffled, so a phrase of any frequency arrives as a row for each such slice.

Each language is a corpus of its own (null: `und`). Null and empty texts hold no words; repeated rows count repeatedly; columns other than the text and the language are not read; an empty table gives
an empty result. Texts of any length are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import forget, fresh, written

MOST_BITS, LEAST_BITS = 29, 20
SLICE = 16 << 20
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
NO_TEXT = 0xFF  # a byte that UTF-8 never holds
_UPPER = bytes(range(65, 91))
_TABLE = bytes.maketrans(_UPPER + SEPARATORS + b"\t", _UPPER.lower() + bytes([NO_TEXT]) * len(SEPARATORS) + b" ")
_END, _SPACED = bytes([NO_TEXT]), b" " + bytes([NO_TEXT]) + b" "
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
LEVEL = "lang string, phrase string, f long"
SALTS = 32


def coded(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different words of texts and the words one after another as places among them; -1 stands between pieces."""
    spaced = _END.join(texts).translate(_TABLE).replace(_END, _SPACED)
    words = pc.split_pattern(pa.array([spaced], pa.large_binary()), b" ").flatten().dictionary_encode()
    names, codes = words.dictionary.to_pylist(), words.indices.to_numpy().astype(np.int64)
    to = np.arange(len(names))
    for mark, value in ((_END, -1), (b"", -2)):
        if mark in names:
            to[names.index(mark)] = value
    codes = to[codes]
    return names, codes[codes != -2]


def _word_digests(lang: bytes, words: list[bytes]) -> np.ndarray:
    import xxhash

    own = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), dtype=np.uint64, count=len(words))
    return own ^ np.uint64(xxhash.xxh64_intdigest(lang, 7))


def _longer(digests: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Digests of grams that go on by one word."""
    return (digests ^ digests >> np.uint64(29)) * _ODD + last


class Bitmap:
    """Which digests may belong to frequent grams: a digest's bit is given by its mixed top bits."""

    def __init__(self, bits: int, places: np.ndarray, words: np.ndarray):
        self.bits = bits
        self.words = np.zeros(1 << max(bits - 6, 0), np.uint64)
        self.words[places] = words

    def holds(self, digests: np.ndarray) -> np.ndarray:
        at = spots(digests, self.bits)
        return self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) == 1


def spots(digests: np.ndarray, bits: int) -> np.ndarray:
    return digests * _MIX >> np.uint64(64 - bits)


def bitmap(rows: DataFrame, digests) -> Bitmap:
    """The bitmap of rows' digests, which a function of batches gives; what is gathered is the bitmap's words, bounded by its size."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * rows.count()).bit_length()))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = spots(digests(batch), bits)
            bit = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bit.view(np.int64))], ["place", "word"])

    words = rows.mapInArrow(marked, "place long, word long").groupBy("place").agg(F.bit_or("word").alias("word")).toPandas()
    return Bitmap(bits, words["place"].to_numpy(np.int64), words["word"].to_numpy(np.int64).view(np.uint64))


def _of_grams(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([gram_digest(lang.encode(), phrase.encode()) for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)], np.uint64)


def _of_digests(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("digest").to_numpy().view(np.uint64)


def gram_digest(lang: bytes, phrase: bytes) -> int:
    own = _word_digests(lang, phrase.split(b" "))
    out = own[:1]
    for k in range(1, len(own)):
        out = _longer(out, own[k : k + 1])
    return int(out[0])


def pairs(lang: bytes, names: list[bytes], codes: np.ndarray, frequent: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    """For each word but the last: whether it and the next are frequent, and the pair's digest."""
    words = np.append(_word_digests(lang, names), np.uint64(0))[codes]  # what stands at -1 is never used
    good = (codes >= 0) & frequent.holds(words)
    return good[:-1] & good[1:], _longer(words[:-1], words[1:])


def stretches(names: list[bytes], codes: np.ndarray, good: np.ndarray) -> bytes:
    """The words of runs of good pairs that are three words long at least, runs being pieces of their own."""
    triple = np.zeros(len(codes), bool)
    triple[: len(good) - 1] = good[:-1] & good[1:]
    kept = triple.copy()
    kept[1:] |= triple[:-1]
    kept[2:] |= triple[:-2]
    at = np.flatnonzero(kept)
    # a run ends where the next kept word stands elsewhere or the pair is not good
    ends = np.append((np.diff(at) > 1) | ~good[at[:-1]], True) if len(at) else np.zeros(0, bool)
    own = np.insert(codes[at], np.flatnonzero(ends) + 1, len(names))
    every = [*names, b"\n"]
    return b" ".join([every[c] for c in own.tolist()])


def grams(lang: bytes, names: list[bytes], codes: np.ndarray, k: int, filters: list[Bitmap]) -> tuple[list[bytes], np.ndarray]:
    """The k-grams (k over 1) of coded words with their counts, where both (k-1)-grams may be frequent; filters: of levels 1 to k-1."""
    if len(codes) < k:
        return [], np.zeros(0, np.int64)
    words = np.append(_word_digests(lang, names), np.uint64(0))[codes]
    digests, good = words, (codes >= 0) & filters[0].holds(words)
    for level in range(2, k):
        good = good[:-1] & good[1:]
        digests = _longer(digests[:-1], words[level - 1 :])
        good[good] = filters[level - 1].holds(digests[good])
    at = np.flatnonzero(good[:-1] & good[1:])
    # keys of whole grams: those of a word fewer, numbered, and the next word
    key = codes[at]
    for j in range(1, k):
        if j > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(names) + codes[at + j]
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return [b" ".join([names[c] for c in codes[i : i + k].tolist()]) for i in at[first].tolist()], count


def _sliced(of):
    """A function of batches (lang, text) that gives what `of` makes of SLICE bytes of texts at a time: a dictionary of each language's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                own = text.as_py()
                held.setdefault(lang, []).append(own)
                size += len(own)
                if size >= SLICE:
                    yield of(held)
                    held, size = {}, 0
        if held:
            yield of(held)

    return run


def _pass(k: int, filters: list[Bitmap]):
    """Rows (lang, phrase, f): the counts of a slice. At level 1 the row without a phrase has the number of words."""

    def counted(texts: dict[str, list[bytes]]) -> pa.RecordBatch:
        langs, phrases, counts = [], [], []
        for lang, own in texts.items():
            names, codes = coded(own)
            if k == 1:
                count = np.bincount(codes[codes >= 0], minlength=len(names))
                seen = np.flatnonzero(count)
                found, count = [None, *(names[c] for c in seen.tolist())], np.append(count.sum(), count[seen])
            else:
                found, count = grams(lang.encode(), names, codes, k, filters)
            langs += [lang] * len(found)
            phrases += found
            counts.append(count)
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(np.concatenate(counts), pa.int64())], ["lang", "phrase", "f"])

    return _sliced(counted)


def _pair_digests(frequent: Bitmap):
    """Rows (digest, f): how often pairs of frequent words occur in a slice."""

    def counted(texts: dict[str, list[bytes]]) -> pa.RecordBatch:
        found = []
        for lang, own in texts.items():
            good, digests = pairs(lang.encode(), *coded(own), frequent)
            found.append(digests[good])
        digests, count = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(digests.view(np.int64)), pa.array(count, pa.int64())], ["digest", "f"])

    return _sliced(counted)


def _pairs_and_stretches(frequent: Bitmap, likely: Bitmap):
    """Rows (lang, phrase, f) for the pairs of a slice that may be frequent, and a row whose f is 0 for the stretches of such pairs."""

    def counted(texts: dict[str, list[bytes]]) -> pa.RecordBatch:
        langs, phrases, counts = [], [], []
        for lang, own in texts.items():
            names, codes = coded(own)
            good, digests = pairs(lang.encode(), names, codes, frequent)
            good[good] = likely.holds(digests[good])
            at = np.flatnonzero(good)
            key, count = np.unique(codes[at] * len(names) + codes[at + 1], return_counts=True)
            found = [names[a] + b" " + names[b] for a, b in zip((key // max(len(names), 1)).tolist(), (key % max(len(names), 1)).tolist(), strict=True)]
            langs += [lang] * (len(found) + 1)
            phrases += [*found, stretches(names, codes, good)]
            counts += [*count.tolist(), 0]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "phrase", "f"])

    return _sliced(counted)


def levels(docs: DataFrame, least: int, longest: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, f): phrases of 1 to `longest` words found `least` times or more, and for each language a row without a phrase: its number of words. A written table."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).filter("text IS NOT NULL AND text <> ''")
    kept = lambda found: written(found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(f"phrase IS NULL OR f >= {int(least)}"))
    tables = [kept(rows.mapInArrow(_pass(1, []), LEVEL))]
    filters, made = [bitmap(tables[0].filter("phrase IS NOT NULL"), _of_grams)], []
    if longest > 1:
        digests = written(rows.mapInArrow(_pair_digests(filters[0]), "digest long, f long").groupBy("digest").agg(F.sum("f").alias("f")).filter(F.col("f") >= least))
        second = written(rows.mapInArrow(_pairs_and_stretches(filters[0], bitmap(digests, _of_digests)), LEVEL))
        made = [digests, second]
        tables.append(kept(second.filter("f > 0")))
        rows = second.filter("f = 0 AND phrase <> ''").select("lang", F.col("phrase").alias("text"))
    for k in range(3, longest + 1):
        filters.append(bitmap(tables[-1], _of_grams))
        tables.append(kept(rows.mapInArrow(_pass(k, filters), LEVEL)))
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    out = written(every)
    forget(*tables, *made)
    return out


def _looked_up(rows: DataFrame, keys: list[str], values: DataFrame, name: str) -> DataFrame:
    """rows with f of the values (one row a key) as `name`. A part such as a very common word is looked up by many rows: keys are dealt by a salt too."""
    salt = fresh(rows, "salt")[0]
    salted = rows.withColumn(salt, F.pmod(F.xxhash64("lang", "phrase"), F.lit(SALTS)).cast("int"))
    needed = salted.select(*keys, salt).distinct().join(values.toDF(*keys, name), keys)
    return salted.join(needed, [*keys, salt]).drop(salt)


def scored(level: DataFrame, scale: int = 1000, absorb: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of two words or more: their lowest-scoring cut, ties to the shortest first part. Phrases inside a longer one
    with absorb % of their count or more are left out. Products are decimals of 38 digits: exact for counts below 10**16."""
    single, words = level.filter("phrase IS NOT NULL").select("lang", "phrase", "f"), level.filter("phrase IS NULL").select("lang", "f")
    size = F.size(F.split("phrase", " "))
    candidates = single.withColumn("k", size).filter("k > 1").withColumnRenamed("f", "a")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', cut)"), "right": F.expr("substring_index(phrase, ' ', cut - k)")})
    cuts = _looked_up(_looked_up(_looked_up(cuts, ["lang", "left"], single, "l"), ["lang", "right"], single, "r"), ["lang"], words, "n")
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    product = wide(F.col("a") * scale, 19) * wide(F.col("n"), 18)
    cuts = cuts.withColumn("score", F.call_function("div", product, wide(F.col("l"), 18) * wide(F.col("r"), 18)))
    best = cuts.groupBy("lang", "phrase", "a", "k").agg(F.min(F.struct("score", "cut", "l", "r", "n")).alias("best"))
    # contiguous parts of each candidate, with the count of the longest-lived phrase around them
    places = F.expr("explode(flatten(transform(sequence(1, k - 1), m -> transform(sequence(1, k - m + 1), i -> struct(m, i)))))")
    inner = candidates.filter("k > 2").select("lang", "a", "phrase", places.alias("p")).filter("p.m > 1")
    part = F.expr("substring_index(substring_index(phrase, ' ', p.i + p.m - 1), ' ', -p.m)")
    around = inner.select("lang", part.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = best.join(around, ["lang", "phrase"], "left").filter(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * absorb))
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "best.n", "best.score")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, first: int | None = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases by score and count descending, then by the bytes of the phrase; the `first` of them, or all if None."""
    out = scored(levels(docs, least, longest, text, lang))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    if first is not None:  # the first of each salt hold the first of all, so no language is gathered whole
        place, salt = fresh(out, "place", "salt")
        salted = out.withColumn(salt, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        out = salted.withColumn(place, F.row_number().over(W.partitionBy("lang", salt).orderBy(*order))).filter(F.col(place) <= first).drop(place, salt)
        out = out.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= first)
    else:
        out = out.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
