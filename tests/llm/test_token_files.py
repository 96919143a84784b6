"""Token files: exact round trips, checkpoints, checksums, order, and the query against the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from endmark.llm import bpe, piecewise, rans, token_files
from endmark.llm.queries import QUERIES, tokenizer_path


def library():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(tokenizer_path())
    out.no_truncation()
    out.no_padding()
    return out


def documents() -> list[tuple]:
    R = random.Random(12)  # noqa: N806
    words = ["tra", "Été", "straße", "12", "##", "<|endoftext|>", "́x", '"', "\x00"]
    rows = [(R.choice([*range(40), None, -5]), " ".join(R.choice(words) for _ in range(R.randrange(200)))) for _ in range(120)]
    return [*rows, *rows[:3], (3, None), (4, ""), (41, "word " * 40_000), (-(2**62), "least"), (2**62, " \n ")]


def model_of(blocks: list[np.ndarray]) -> rans.Model:
    every = np.concatenate([*blocks, np.zeros(0, np.int64)])
    seen, n = np.unique(every, return_counts=True)
    return rans.Model.of(seen, rans.frequencies(n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000)), min_size=1, max_size=300), min_size=1, max_size=5))
def test_blocks_come_back(blocks):
    blocks = [np.array(b, dtype=np.int64) for b in blocks]
    model = model_of(blocks)
    coded = rans.encode(model, [model.symbols(b) for b in blocks])
    for own, c in zip(blocks, coded, strict=True):
        got = rans.decode(model, [(w, s, min(rans.SEGMENT, len(own) - g * rans.SEGMENT)) for g, (w, s) in enumerate(zip(c.words, c.states, strict=True))])
        assert np.array_equal(model.ids[np.concatenate(got)], own)


def test_long_blocks_near_their_entropy_and_segments_alone():
    rng = np.random.default_rng(3)
    blocks = [np.minimum(rng.zipf(1.3, n), 49_000).astype(np.int64) for n in (1, rans.SEGMENT, 5 * rans.SEGMENT + 77, 3 * rans.SEGMENT - 1)]
    model = model_of(blocks)
    coded = rans.encode(model, [model.symbols(b) for b in blocks])
    share = model.freq / model.freq.sum()
    for own, c in zip(blocks, coded, strict=True):
        for g in range(len(c.words)):
            want = own[g * rans.SEGMENT : (g + 1) * rans.SEGMENT]
            assert np.array_equal(model.ids[rans.decode(model, [(c.words[g], c.states[g], len(want))])[0]], want)
    own, c = blocks[2], coded[2]
    bits = -np.log2(share[model.symbols(own)]).sum()
    assert 32 * sum(map(len, c.words)) < 1.01 * bits + 64 * rans.LANES


def test_frequencies():
    assert rans.frequencies(np.array([5])).tolist() == [1 << rans.SCALE]
    big = rans.frequencies(np.array([10**17, 1, 1, 10**17]))
    assert int(big.sum()) == 1 << rans.SCALE and big.min() == 1 and abs(int(big[0]) - int(big[3])) <= 1
    assert len(rans.frequencies(np.zeros(0, np.int64))) == 0
    with pytest.raises(ValueError):
        rans.Model.of(np.array([3]), np.array([1 << rans.SCALE], np.uint32)).symbols(np.array([4]))


def test_pieces_give_the_library_s_ids():
    path, tok = tokenizer_path(), library()
    own = bpe.Encoder(path)
    assert own.breaks and piecewise.borders(path)[256 * ord("a") + ord(",")] and not piecewise.borders(path)[256 * ord("'") + ord("s")] and not piecewise.borders(path)[256 * ord("|") + ord("e")]
    r = random.Random(5)
    parts = ["it's", "'ll", "we're", "x'", "''s", "Word,", "(left", "a.b.c", "...", "?!", "12.5", "é,", ",é", "e\u0301", "\u0301", "İ", "Σ.", "ﬁ-", "<|endoftext|>", "<|endoftext", "|e", "t|", "\t", "\r\n", "\x0b", "\xa0", "\x00", "ǅ", "字", "a_b", "--", "\ud7ff", "😀x", "x😀"]
    texts = [None, "", " ", "\n\n", *["".join(r.choice([*parts, " ", "\n", " "]) for _ in range(r.randrange(1, 40))) for _ in range(1500)], "z" * 3000]
    ids, at = piecewise.encoded(own, path, pa.array(["skipped", *texts], pa.string()).slice(1))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    plain = bpe.Encoder(path, breaks="")
    few, at = piecewise.encoded(plain, path, pa.array(texts[:50], pa.string()))
    assert [few[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [tok.encode(t or "", add_special_tokens=False).ids for t in texts[:50]]
    assert piecewise.encoded(own, path, pa.array([], pa.string()))[1].tolist() == [0]
    assert list(piecewise.slices(pa.array(["aa", None, "bbb", "c" * 9, "", "d"], pa.string()), 5)) == [(0, 3), (3, 1), (4, 2)] and list(piecewise.slices(pa.array([], pa.string()), 5)) == []


@pytest.fixture(scope="module")
def folder(spark):
    out = token_files.new_folder(spark)
    docs = spark.createDataFrame([(*r, 1, "x", b"y") for r in documents()], "doc_id long, text string, key int, start string, ids binary").repartition(5)
    token_files.write_tokens(docs, tokenizer_path(), out)
    return out


def test_round_trip_in_order(spark, folder):
    tok = library()
    want = sorted((((-(2**63) if k is None else k), np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for k, t in documents()))
    got = token_files.read_tokens(spark, folder).orderBy("start").collect()
    assert sorted((-(2**63) if r.doc_id is None else r.doc_id, bytes(r.ids)) for r in got) == want
    assert [r.doc_id is None for r in got] == sorted((r.doc_id is None for r in got), reverse=True)
    kept = [r.doc_id for r in got if r.doc_id is not None]
    assert kept == sorted(kept)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens


def test_windows(spark, folder):
    every = b"".join(bytes(r.ids) for r in token_files.read_tokens(spark, folder).orderBy("start").collect())
    ids = np.frombuffer(every, "<u4")
    for start, count in ((0, 1), (len(ids) - 5, 100), (1000, 70_000), (0, len(ids)), (7, 0), (rans.SEGMENT - 1, 2)):
        got = token_files.read_window(spark, folder, start, count).orderBy("position").collect()
        assert [r.position for r in got] == list(range(start, min(start + count, len(ids)))) and [r.id for r in got] == ids[start : start + count].tolist()


@pytest.mark.parametrize("field", ["words", "ids_crc32"])
def test_damage_is_seen(spark, folder, field, tmp_path):
    bad = str(tmp_path / "bad")
    for name in ("format", "frequencies", "parts"):
        spark.read.parquet(f"{folder}/{name}").write.parquet(f"{bad}/{name}")
    blocks = spark.read.parquet(f"{folder}/blocks")
    changed = F.expr("concat(cast(x'ffffffff' AS binary), substr(words, 5))") if field == "words" else F.col("ids_crc32") + 1
    blocks.withColumn(field, changed).write.parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="checksum"):
        token_files.read_tokens(spark, bad).collect()


def test_empty(spark):
    out = token_files.new_folder(spark)
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path(), out)
    assert token_files.read_tokens(spark, out).collect() == [] and token_files.read_window(spark, out, 0, 10).collect() == []


def test_query(spark, tmp_path):
    rows = [(k, t) for k, (_, t) in enumerate(documents())]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_token_files"](spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    tok, at, want = library(), 0, set()
    for k, t in sorted(rows, key=lambda r: r[0]):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.add((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert {tuple(r) for r in got.collect()} == want
