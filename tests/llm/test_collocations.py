"""Collocations against a plain version, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from endmark.llm import collocations
from endmark.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
R = random.Random(11)


def plain(rows: list[tuple], least: int, longest: int, first: int | None, scale: int = 1000, absorb: int = 100) -> set[tuple]:
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = set()
    for lang, own in counts.items():
        n = sum(f for p, f in own.items() if len(p) == 1)
        candidates = {p: f for p, f in own.items() if len(p) > 1 and f >= least}
        around: dict[tuple, int] = {}
        for p, f in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i : i + m]] = max(f, around.get(p[i : i + m], 0))
        kept = []
        for p, a in candidates.items():
            score, k = min((scale * a * n // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            if around.get(p, 0) * 100 < a * absorb:
                kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:first], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def texts() -> list[tuple]:
    words = ["tra", "Été", "x", "straße", "New", "York", "\x00", "ß\xa0", "n ", "city"]
    few = [(R.choice(["en", "fr", None]), R.choice([" ", "\t", "  "]).join(R.choice(words) for _ in range(R.randrange(60)))) for _ in range(150)]
    ends = [("en", R.choice(".,;:!?\n\x0b\x0c\r").join(["new york city hall"] * 9)) for _ in range(10)]
    return [*few, *few[:20], *ends, ("en", None), (None, None), ("de", ""), ("de", " \t\n .,"), ("de", "one"), ("en", "new york " * 4000), ("", "a b a b a b"), ("q\ny", "a b a b"), (None, "new york " * 30)]


@pytest.mark.parametrize(("least", "longest", "first"), [(10, 5, 2000), (3, 3, 7), (2, 5, None)])
def test_plain_version(spark, least, longest, first):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "lang string, text string, f int, phrase string, rank double").repartition(3)
    got = [tuple(r) for r in collocations.collocations(docs, least, longest, first).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, least, longest, first)


def test_absorption_share(spark):
    rows = [("en", "a b c")] * 9 + [("en", "a b")] * 1
    docs = spark.createDataFrame(rows, "lang string, text string")
    level = collocations.levels(docs, 2, 5)
    for share in (90, 91, 100):
        got = {r.phrase for r in collocations.scored(level, absorb=share).collect()}
        assert got == ({"a b c"} if share == 90 else {"a b c", "a b"})


def test_counts_past_64_bits(spark):
    n = 9 * 10**15
    level = spark.createDataFrame([("en", None, n), ("en", "a", n // 2), ("en", "b", n // 3), ("en", "a b", n // 7)], "lang string, phrase string, f long")
    got = collocations.scored(level).first()
    assert got.score == 1000 * (n // 7) * n // ((n // 2) * (n // 3))


def test_crowded_bitmap_changes_no_result(spark, monkeypatch):
    rows = texts()
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "MOST_BITS", 7)
    assert {tuple(r) for r in collocations.collocations(docs, 3).collect()} == plain(rows, 3, 5, 2000)


def test_only_grams_of_frequent_parts_are_emitted():
    names, codes = collocations.coded([b"A b  c.\ta b d, a b", b"a b"])
    bits = np.zeros(1 << 14, np.uint64)
    for w in (b"a", b"b"):
        at = int(collocations.spots(np.array([collocations.gram_digest(b"en", w)], np.uint64), 20)[0])
        bits[at >> 6] |= np.uint64(1 << (at & 63))
    at = np.flatnonzero(bits)
    found, count = collocations.grams(b"en", names, codes, 2, [collocations.Bitmap(20, at, bits[at])])
    assert found == [b"a b"] and count.tolist() == [4]


def test_stretches_hold_all_longer_phrases():
    names, codes = collocations.coded([b"a b c x a b. a b c d e, y z z z z"])
    good = np.array([names[a] + names[b] in (b"ab", b"bc", b"cd", b"zz") if min(a, b) >= 0 else False for a, b in zip(codes, codes[1:], strict=False)])
    got = collocations.coded([collocations.stretches(names, codes, good)])
    assert [" ".join("|" if c < 0 else got[0][c].decode() for c in got[1])] == ["a b c | a b c d | z z z z |"]
    assert collocations.stretches([], np.zeros(0, np.int64), np.zeros(0, bool)) == b"" and collocations.stretches([b"a"], np.array([0]), np.zeros(0, bool)) == b""


def test_slices_add_up(spark, monkeypatch):
    rows = texts()
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    want = {tuple(r) for r in collocations.levels(docs, 3, 3).collect()}
    monkeypatch.setattr(collocations, "SLICE", 50)
    assert {tuple(r) for r in collocations.levels(docs, 3, 3).collect()} == want


def test_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_query(spark, tmp_path):
    rows = [r for r in texts() for _ in range(3)]
    spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_collocations"](spark, str(tmp_path))
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]
    assert {tuple(r) for r in got.collect()} == plain(rows, 100, 5, 2000)
