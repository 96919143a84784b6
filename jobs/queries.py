"""The jobs as queries over the driver's tables, with the DuckDB SQL they must equal. Each call works in a new folder of the shared one."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from endmark.plans import adapters
from endmark.plans.storage import shared_dir

from . import motif_report, site_counts


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def job1_site_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as read ends, counted at the sites of the adapter atlas; the second run finds nothing new."""
    folder, settings = _folder(spark, "job1"), site_counts.config()
    adapters.atlas(spark, sf_dir).withColumnRenamed("chrom", "contig").write.parquet(f"{folder}/atlas")
    for _ in range(2):
        site_counts.update(spark, f"{sf_dir}/lineitem.parquet", f"{folder}/atlas", f"{folder}/out", f"{folder}/checkpoint", settings)
    return site_counts.result(spark, f"{folder}/out")


def job2_motif_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sequences, grouped by language with sources as strata."""
    folder, settings = _folder(spark, "job2"), motif_report.config()
    for _ in range(2):
        motif_report.report(spark, f"{sf_dir}/documents.parquet", folder, settings)
    return motif_report.result(spark, folder, settings)


_SITES = f"""{adapters.FULL} SELECT a.pac_id, a.gene_id, a.chrom AS contig, a.strand, a.coordinate, coalesce(c."count", 0) AS "count",
 CAST(sum(coalesce(c."count", 0)) OVER w AS BIGINT) AS gene_total, coalesce(c."count", 0) / nullif(sum(coalesce(c."count", 0)) OVER w, 0) AS pau, s.sample_id
FROM atlas_v a CROSS JOIN (SELECT DISTINCT sample_id FROM obs) s LEFT JOIN counts c ON c.pac_id=a.pac_id AND c.gene_id=a.gene_id AND c.sample_id=s.sample_id
WINDOW w AS (PARTITION BY a.gene_id, s.sample_id)"""


def _motifs() -> str:
    settings = json.loads(motif_report.CONFIG.read_text(encoding="utf-8"))
    motifs = ", ".join(f"('{m}', '{kind}', {priority})" for m, kind, priority in settings["motifs"])
    low, high = settings["core"]
    longest = max(len(m) for m, _, _ in settings["motifs"])
    tail = f"right(seq, {settings['tail']})"
    run = "CAST(coalesce(list_max(list_transform(regexp_extract_all({0}, 'A+'), lambda x: length(x))), 0) AS INT)"
    share = "CASE WHEN length({0})>0 THEN (length({0})-length(replace({0}, 'A', '')))/length({0}) ELSE 0 END"
    tests = ("odds_ratio", "chi_square", "p", "fdr")
    texts = {"stratum": "VARCHAR", "length": "INT", "a_fraction": "DOUBLE", "longest_a_run": "INT", "tail_of_a": "INT", "n_hits": "INT", "primary_motif": "VARCHAR", "motif_class": "VARCHAR", "distance": "INT", "motifs": "VARCHAR"}
    counts = {"motif": "VARCHAR", "n_sequences": "BIGINT", "with_motif": "BIGINT", "strata": "BIGINT", **dict.fromkeys(tests, "DOUBLE")}
    none = lambda kinds: ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in kinds.items())
    return f"""WITH s AS (SELECT row_number() OVER () AS no, doc_id AS id, coalesce(nullif(lang, ''), 'none') AS part, source AS stratum,
 coalesce(translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTAACGTAAACGTAAACGTTACGA'), '') AS seq FROM documents),
m(motif, motif_class, priority) AS (VALUES {motifs}),
-- in pieces of 200 letters, as finding a letter's place costs time in long texts
c AS (SELECT no, n, k*200 AS base, substr(seq, CAST(k*200 AS INT)+1, {199 + longest}) AS piece FROM (SELECT no, seq, length(seq) AS n, unnest(range(0, (length(seq)+199)//200)) AS k FROM s)),
h AS (SELECT no, motif, motif_class, priority, n-base-i AS distance FROM (SELECT no, n, base, motif, motif_class, priority,
 unnest(list_filter(range(0, 200), lambda i: substr(piece, CAST(i AS INT)+1, length(motif))=motif)) AS i FROM c, m WHERE contains(piece, motif))),
r AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY priority, CASE WHEN distance BETWEEN {low} AND {high} THEN 0 ELSE 1 END, abs(distance-20), distance) AS rn FROM h),
q AS (SELECT no, CAST(count(*) AS INT) AS n, string_agg(DISTINCT motif, ',' ORDER BY motif) AS motifs FROM h GROUP BY 1),
t AS MATERIALIZED (SELECT id, stratum, CAST(length(seq) AS INT) AS length, round({share.format('seq')}, 9) AS a_fraction, {run.format('seq')} AS longest_a_run,
 CAST({run.format(tail)}>6 OR {share.format(tail)}>0.7 AS INT) AS tail_of_a, coalesce(q.n, 0) AS n_hits, coalesce(r.motif, 'no_recognized_motif') AS primary_motif, r.motif_class, CAST(r.distance AS INT) AS distance, coalesce(q.motifs, '') AS motifs, part
 FROM s LEFT JOIN r ON r.no=s.no AND r.rn=1 LEFT JOIN q ON q.no=s.no),
z AS (SELECT part, stratum, motif, count(*) AS n, count(*) FILTER (list_contains(string_split(motifs, ','), motif)) AS a FROM t, (SELECT motif FROM m) GROUP BY 1, 2, 3),
u AS (SELECT *, n-a AS b, sum(a) OVER w-a AS c, sum(n-a) OVER w-(n-a) AS d FROM z WINDOW w AS (PARTITION BY stratum, motif)),
k AS (SELECT part, motif, CAST(sum(n) AS BIGINT) AS n_sequences, CAST(sum(a) AS BIGINT) AS with_motif FROM u GROUP BY 1, 2),
g AS (SELECT part, motif, count(*) AS strata, sum(a*d/t) AS up, sum(b*c/t) AS down, sum(a-(a+b)*(a+c)/t) AS x, sum((a+b)*(c+d)*(a+c)*(b+d)/(t*t*(t-1))) AS v
 FROM (SELECT part, motif, a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c, d::DOUBLE AS d, (a+b+c+d)::DOUBLE AS t FROM u) WHERE a+b>0 AND c+d>0 AND a+c>0 AND b+d>0 GROUP BY 1, 2),
x AS (SELECT part, motif, strata, CASE WHEN down>0 THEN up/down ELSE 'inf'::DOUBLE END AS odds_ratio, CASE WHEN v>0 THEN x*x/v END AS chi_square FROM g),
-- Simpson's rule for the tail of the normal distribution
p AS (SELECT *, 2/sqrt(pi())*0.001/3*list_sum(list_transform(range(0, 7001), lambda i: (CASE WHEN i IN (0, 7000) THEN 1 WHEN i%2=1 THEN 4 ELSE 2 END)*exp(-(sqrt(chi_square/2)+i*0.001)*(sqrt(chi_square/2)+i*0.001)))) AS p FROM x),
o AS (SELECT *, count(*) FILTER (p IS NOT NULL) OVER (PARTITION BY part) AS tests, count(p) OVER (PARTITION BY part ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank FROM p),
f AS (SELECT *, CASE WHEN p IS NOT NULL THEN least(1, min(p*tests/rank) OVER (PARTITION BY part ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS fdr FROM o)
SELECT id, {', '.join(texts)}, part, 'sequences' AS "table", {none(counts)} FROM t
UNION ALL SELECT CAST(NULL AS BIGINT), {none(texts)}, part, 'enrichment', motif, n_sequences, with_motif, coalesce(strata, 0), round(odds_ratio, 9), round(chi_square, 9), round(p, 7), round(fdr, 7) FROM k LEFT JOIN f USING (part, motif)"""


QUERIES = {f.__name__: f for f in (job1_site_counts, job2_motif_report)}
ORACLES = {"job1_site_counts": _SITES, "job2_motif_report": _motifs()}
