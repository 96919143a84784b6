"""Site windows over all documents, and enrichment by comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from endmark.operators import models
from endmark.plans import adapters


def test_windows_reach_all_ids_and_places(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lpad(F.col("id").cast("string"), 60, "A"), F.repeat(F.lit("C"), F.lit(300))).alias("seq"))
    sites = spark.range(2000).select(F.concat(F.lit("P"), "id").alias("pac_id"), (F.col("id") * 7 + 3).alias("coordinate"))
    got = adapters.site_windows(sites, docs).collect()
    assert len(got) == 2000 and {len(r.window) for r in got} == {60}
    assert any(r.window == "C" * 60 for r in got)
    one = docs.withColumn("seq", F.lpad(F.col("doc_id").cast("string"), 60, "0"))
    ids = {int(r.window) for r in adapters.site_windows(sites, one).collect()}
    assert max(ids) > 2900 and len([i for i in ids if i >= 500]) > len(ids) / 2


def test_enrichment_by_comparison(spark):
    rows = [(c, f"g{g}", f"p{g}.{k}", (k + g + (c == "C2") * g) % 3 == 0, ("ACGT" * 3)[(k * 5 + g) % 7 :][:5]) for c in ("C1", "C2") for g in range(6) for k in range(5)]
    sites = spark.createDataFrame(rows, "comparison string, gene_id string, pac_id string, event boolean, window string")
    got = sorted(map(tuple, models.kmer_enrichment(sites, 3, keys=("comparison",)).select("comparison", "kmer", "strata", "odds_ratio", "chi_square", "p", "fdr").collect()), key=repr)
    want = [(c, *r) for c in ("C1", "C2") for r in models.kmer_enrichment(sites.filter(F.col("comparison") == c), 3).select("kmer", "strata", "odds_ratio", "chi_square", "p", "fdr").collect()]
    assert {c for c, *_ in want} == {"C1", "C2"} and [x[:3] for x in got] == [x[:3] for x in sorted(want, key=repr)]
    near = {x[:2]: x for x in want}
    assert all(a == b or abs(a - b) < 1e-9 for x in got for a, b in zip(x[3:], near[x[:2]][3:], strict=True))
