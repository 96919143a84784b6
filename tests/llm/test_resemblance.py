"""Near copies by exact similarity, against all pairs."""

from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from endmark.llm import resemblance, simhash

from . import brute


def grams(text: str | None) -> set:
    w = brute.SPACE.findall((text or "").translate(brute.LOW))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(rows) -> list:
    sets = [grams(t) for _, t in rows]
    of = list(range(len(rows)))
    for k in range(len(rows)):
        for j in range(k):
            if of[j] != of[k] and jaccard(sets[j], sets[k]) >= 0.8:
                old, new = of[k], of[j]
                of = [new if x == old else x for x in of]
    least = {}
    for (i, _), c in zip(rows, of, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [least.get(c) for c in of]


def rows() -> list[tuple]:
    r = random.Random(3)
    out = [(900, None), (901, " \n"), (902, "one two"), (903, "One\ttwo"), (904, "one two three")]
    for g in range(30):
        words = [f"w{r.randrange(3000)}" for _ in range(300)]
        out.append((10 * g, " ".join(words)))
        for k in range(1, 5):
            near = list(words)
            for at in r.sample(range(300), 3 * k):  # similarities from 0.9 to about 0.65
                near[at] = f"x{r.randrange(10**6)}"
            out.append((10 * g + k if k != 2 or g else None, " ".join(near)))
    return out + [(5000 + k, " ".join([f"c{n}" for n in range(100)] + [f"d{k}"])) for k in range(60)]  # one large group


def test_near_copies(spark):
    docs = rows()
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((tuple(x) for x in resemblance.near_copies(table).select("doc_id", "component_id").collect()), key=repr)
    assert got == sorted(((i, c) for (i, _), c in zip(docs, plain(docs), strict=True)), key=repr)
    assert resemblance.near_copies(table.limit(0)).count() == 0


def test_pipeline_stage_drops_near_copies_beyond_four_bits(spark):
    docs = rows()
    sets = [grams(t) for _, t in docs]
    far = [(j, k) for k in range(len(docs)) for j in range(k) if 0.8 <= jaccard(sets[j], sets[k]) < 1 and (brute.fingerprint(docs[j][1]) ^ brute.fingerprint(docs[k][1])).bit_count() > 4]
    assert far
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.dedup_stage(spark, table, "").collect() if r.doc_id is not None}
    assert kept == {i for (i, _), c in zip(docs, plain(docs), strict=True) if i is not None and i == c}
    assert not any({docs[j][0], docs[k][0]} <= kept for j, k in far)


def test_fingerprints_propose_pairs(spark, monkeypatch):
    docs = rows()
    texts = [t for _, t in docs if brute.SPACE.findall(t or "")]
    fps = [simhash.fingerprint(t.encode(), 5) for t in texts]
    near = {(j, k) for k in range(len(fps)) for j in range(k) if (fps[j] ^ fps[k]).bit_count() <= resemblance.REACH}
    assert near and any(grams(texts[j]) != grams(texts[k]) for j, k in near)
    nodes = spark.createDataFrame([(k, fp - (fp >> 63 << 64)) for k, fp in enumerate(fps)], "node long, fp long")
    bucket = {r.node: r.bucket for r in resemblance.fingerprint_buckets(nodes).collect()}
    assert sorted(bucket) == list(range(len(fps))) and all(bucket[j] == bucket[k] for j, k in near)
    # the pipeline's stage searches the fingerprints of its five-word shingles, by operator 5's trees
    seen = []
    search = resemblance.fingerprint_links
    monkeypatch.setattr(resemblance, "fingerprint_links", lambda nodes, reach: (seen.extend(r.fp for r in nodes.collect()), search(nodes, reach))[1])
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    corpus_pipeline.dedup_stage(spark, table, "").count()
    assert set(seen) == {fp - (fp >> 63 << 64) for fp in fps}


def test_two_documents_of_one_id_both_stay(spark):
    words = [" ".join(f"{c}{k}" for k in range(80)) for c in "abc"]
    docs = [(1, words[0]), (1, words[1]), (1, words[1]), (2, words[0]), (None, words[2]), (None, words[2]), (None, words[0])]
    table = spark.createDataFrame([(*d, k) for k, d in enumerate(docs)], "doc_id long, text string, kept int")
    got = resemblance.keep_one(table)
    assert got.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(1, words[0]), (1, words[1]), (None, words[2])], key=repr)


def test_bucket_links():
    sets = [np.arange(a, a + 100, dtype=np.uint64) for a in (0, 500, 10, 505, 20)]
    assert list(resemblance.bucket_links(sets, 0.8)) == [0, 1, 0, 1, 0]  # a chain: 0 and 4 have 80 of 120


def test_large_bucket_looks_up_few_sets(monkeypatch):
    """One text copied with ever more words changed: most pairs lie below the bound and are ruled out without looking up their shingles; components are those of all pairs."""
    r = np.random.default_rng(5)
    sets = []
    for k in range(400):
        words = [f"w{n}" for n in range(300)]
        for at in r.integers(0, 300, 3 + k % 30):
            words[at] = f"x{r.integers(0, 10**6)}"
        sets.append(np.unique(resemblance.shingles(" ".join(words).encode())[1]))
    sets.append(np.zeros(1, dtype=np.uint64))  # far smaller
    sets.append(np.unique(r.integers(0, 2**63, 200_000, dtype=np.uint64)))  # fills every bit of a bitmap
    looked, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *more: (looked.append(len(v)), search(a, v, *more))[1])
    got = resemblance.bucket_links(sets, 0.8)
    monkeypatch.undo()
    links = simhash.Links(len(sets))
    pairs = [(j, k) for k in range(len(sets)) for j in range(k) if jaccard_of(sets[j], sets[k]) >= 0.8]
    links.add(*np.array(pairs).T)
    assert np.array_equal(got, simhash._roots(links.parent)) and len(set(got.tolist())) > 50
    assert sum(looked) < 0.05 * 300 * 400 * 400 / 2


def jaccard_of(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True)) if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) else 0
    return common / (len(a) + len(b) - common)
