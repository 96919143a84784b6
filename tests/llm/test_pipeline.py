"""The pipeline against its stages done plainly, on a small table beside labels."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from endmark.llm import quality, secret_scan
from endmark.llm.queries import tokenizer_path

from . import brute
from .test_operators import documents, prose
from .test_resemblance import plain


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in documents() if i is not None]
    rows = list(dict.fromkeys(rows)) + rows[:5]
    rows += [(100 + k, f"{prose(70)} password={'%018x' % (k * 7919)}", "en", f"s{k % 4}", 9) for k in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(100 + k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), rows


def test_pipeline(spark, sf_dir):
    at, rows = sf_dir
    rows = [r for r in rows if (m := brute.measures(r[1]))[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    comp = plain([(k, r[1]) for k, r in enumerate(rows)])  # all pairs of five-word shingle sets at 0.8
    first = lambda r: (r[0], hashlib.md5(f"{len(str(r[0]))}:{r[0]}{r[1]}".encode()).hexdigest())
    rows = [min((r for r, c in zip(rows, comp, strict=True) if c == g), key=first) for g in sorted(set(comp))]
    rows = [(i, brute.redacted(t, brute.spans(t, secret_scan.RULES), "[SECRET]"), lang, s) for i, t, lang, s, _ in rows]
    sized = [(s, len(brute.SPACE.findall(t)), hashlib.md5(f"7:{i}:{t}".encode()).hexdigest()) for i, t, _, s in rows]
    _, taken = brute.mix(sized)
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    own.no_truncation()
    want = []
    for (i, t, _, s), (_, n, _), words in zip(rows, sized, taken, strict=True):
        want += [(i, s, own.encode(t, add_special_tokens=False).ids)] * (words // n)
    got = corpus_pipeline.run(spark, at)
    assert sorted((tuple(r) for r in got.select("doc_id", "source", "ids").collect()), key=repr) == sorted(want, key=repr)
    assert got.filter(F.col("n_tokens") != F.size("ids")).count() == 0
    assert not any("password=0" in r.decoded.replace(" ", "") for r in got.collect())


def test_stages_keep_columns_and_empty_tables(spark, sf_dir):
    at, _ = sf_dir
    docs = spark.read.parquet(f"{at}/documents.parquet")
    none = docs.limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, none, at)
        assert out.count() == 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes


def test_clean_documents_stay(spark, sf_dir):
    at, rows = sf_dir
    docs = spark.read.parquet(f"{at}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, at).collect()}
    assert {100 + k for k in range(40)} <= kept
    assert quality.RULES
