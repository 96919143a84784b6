"""Queries of the candidate sites' status and of the joint model, with the DuckDB SQL they must equal where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import aggregates, candidates, family, models, regression
from .plans import adapters as v
from .plans.adapters import BASE
from .plans.storage import written
from .queries import query

SUPPORT = candidates.Support(least_total=420, least_count=60, least_samples=0.7, rescue_total=200, known_radius=4)

# A cluster holds the coordinates of a stretch of 200; its seed is the least one that has as many reads as any.
_CLUSTERS = f"""{BASE}, pos AS (SELECT contig, strand, coordinate, coordinate//200 AS block, sum("count") AS n, sum(poly_a_clip_count) AS clips FROM obs GROUP BY 1, 2, 3, 4),
cl AS (SELECT contig, strand, block, arg_min(coordinate, (-n, coordinate)) AS seed FROM pos GROUP BY 1, 2, 3),
m AS (SELECT cl.seed, pos.* FROM pos JOIN cl USING (contig, strand, block)),
ps AS (SELECT m.contig, m.strand, m.seed, o.sample_id, sum(o."count") AS n FROM m JOIN obs o ON o.contig=m.contig AND o.strand=m.strand AND o.coordinate=m.coordinate GROUP BY 1, 2, 3, 4),
size AS (SELECT condition, count(*) AS size FROM samples_v GROUP BY 1),
sup AS (SELECT contig, strand, seed, s.condition, count(*) AS support, max(size) AS size FROM ps JOIN samples_v s USING (sample_id) JOIN size ON size.condition=s.condition WHERE n>={SUPPORT.least_count} GROUP BY 1, 2, 3, 4),
ok AS (SELECT *, support>=ceil({SUPPORT.least_samples}*size) AS passes FROM sup),
best AS (SELECT *, row_number() OVER (PARTITION BY contig, strand, seed ORDER BY passes DESC, support/size DESC, support DESC, condition) AS rn FROM ok),
sc AS (SELECT contig, strand, seed, CAST(sum(support) AS BIGINT) AS total_supporting, max(support) FILTER (rn=1) AS supporting, max(condition) FILTER (rn=1) AS best, bool_or(passes) AS supported,
 coalesce(string_agg(condition, ';' ORDER BY condition) FILTER (passes), '') AS conditions FROM best GROUP BY 1, 2, 3),
run AS (SELECT *, sum(n) OVER (PARTITION BY contig, strand, seed ORDER BY coordinate) AS cum, sum(n) OVER (PARTITION BY contig, strand, seed) AS total FROM m),
wide AS (SELECT contig, strand, seed, min(coordinate) FILTER (cum>round_even(0.95::DOUBLE*(total-1)::DOUBLE, 0))-min(coordinate) FILTER (cum>round_even(0.05::DOUBLE*(total-1)::DOUBLE, 0)) AS width FROM run GROUP BY 1, 2, 3),
flank AS (SELECT cl.contig, cl.strand, cl.seed, sum(pos.n) AS flank FROM cl JOIN pos ON pos.contig=cl.contig AND pos.strand=cl.strand AND abs(pos.coordinate-cl.seed)>24 AND abs(pos.coordinate-cl.seed)<=48 GROUP BY 1, 2, 3),
cap AS (SELECT contig, strand, seed, sum(least(n, 3)) AS capped FROM ps GROUP BY 1, 2, 3),
known AS (SELECT DISTINCT cl.contig, cl.strand, cl.seed FROM cl JOIN atlas_v a ON a.chrom=cl.contig AND a.strand=cl.strand AND abs(a.coordinate-cl.seed)<={SUPPORT.known_radius}),
met AS (SELECT contig, strand, seed, sum(n) AS total, sum(clips) AS clips, sum(n) FILTER (abs(coordinate-seed)<=2) AS near, min(coordinate) AS low, max(coordinate)+1 AS high, count(*) AS members FROM m GROUP BY 1, 2, 3),
c AS (SELECT met.*, capped, width, coalesce(flank, 0) AS flank, coalesce(supported, false) AS supported, coalesce(supporting, 0) AS supporting, coalesce(total_supporting, 0) AS total_supporting, coalesce(best, '') AS best, coalesce(conditions, '') AS conditions,
 known.seed IS NOT NULL AS known FROM met JOIN cap USING (contig, strand, seed) JOIN wide USING (contig, strand, seed) LEFT JOIN flank USING (contig, strand, seed) LEFT JOIN sc USING (contig, strand, seed)
 LEFT JOIN known ON known.contig=met.contig AND known.strand=met.strand AND known.seed=met.seed),
cand AS (SELECT *, CASE WHEN total>={SUPPORT.least_total} AND supported THEN 'primary' WHEN known AND total>={SUPPORT.rescue_total} AND supported THEN 'known_rescue_only' ELSE 'rejected' END AS status FROM c)"""


def _clusters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    observed = v.observed(spark, sf_dir)
    at = observed.groupBy("contig", "strand", "coordinate").agg(F.sum("count").alias("n"))
    order = F.struct(-F.col("n"), F.col("coordinate"))
    clusters = at.groupBy("contig", "strand", F.expr("coordinate div 200").alias("block")).agg(F.min_by("coordinate", order).alias("seed"), F.array_sort(F.collect_list("coordinate")).alias("members")).drop("block")
    return clusters, observed


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters, observed = _clusters(spark, sf_dir)
    return candidates.exact_candidates(clusters, observed, v.samples(spark), 24, SUPPORT, v.atlas(spark, sf_dir).withColumnRenamed("chrom", "contig"))


@query(f"""{_CLUSTERS} SELECT contig, strand, seed AS coordinate, CAST(total AS BIGINT) AS total_count, CAST(supporting AS BIGINT) AS supporting_samples, CAST(capped AS BIGINT) AS capped_support, CAST(members AS INT) AS members, status,
 CASE WHEN status<>'rejected' THEN '' ELSE concat_ws(';', CASE WHEN total<{SUPPORT.least_total} THEN 'total_count<{SUPPORT.least_total}' END, CASE WHEN NOT supported THEN 'supporting_sample_fraction<0.7' END) END AS rejection_reason,
 round(coalesce(near, 0)/total, 9) AS fraction_within_2nt, CAST(width AS BIGINT) AS width_90, round(clips/total, 9) AS poly_a_clip_fraction, round(total/greatest(flank, 1), 9) AS local_enrichment, low AS region_start, high AS region_end,
 CAST(1 AS BIGINT) AS resolution_nt, CAST(total_supporting AS BIGINT) AS total_supporting_samples, best AS best_supporting_condition, conditions AS supporting_conditions FROM cand""")
def a25_a27_candidate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = {name: F.round(name, 9) for name in ("fraction_within_2nt", "poly_a_clip_fraction", "local_enrichment")}
    return _candidates(spark, sf_dir).withColumn("members", F.size("members")).withColumns(rounded)


def _continuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each read end of an even order as reads spliced out of a block that begins at it."""
    d = v.observed(spark, sf_dir).filter("coordinate div 200 % 3 < 2")
    return d.select("sample_id", "contig", "strand", F.col("coordinate").alias("upstream_start"), (F.col("coordinate") + 7 + F.col("coordinate") % 11).alias("upstream_end"),
                    (F.col("coordinate") + 100).alias("downstream_start"), (F.col("coordinate") + 160).alias("downstream_end"), "count")


@query(f"""{_CLUSTERS}, b AS (SELECT o.contig, o.strand, o.coordinate-5 AS low, o.coordinate+7+o.coordinate%11+5 AS high, s.condition, "count" AS n FROM obs o JOIN samples_v s USING (sample_id) WHERE coordinate//200%3<2),
w AS (SELECT contig, strand, seed, CASE WHEN strand='+' THEN seed-10 ELSE seed+10 END AS pile, unnest(string_split(conditions, ';')) AS condition FROM cand WHERE conditions<>''),
r AS (SELECT w.contig, w.strand, w.seed, w.condition, coalesce(sum(b.n), 0)>=180 AS reached FROM w LEFT JOIN b ON b.contig=w.contig AND b.strand=w.strand AND b.condition=w.condition AND b.low<=w.pile AND b.high>=w.pile GROUP BY 1, 2, 3, 4),
x AS (SELECT contig, strand, seed, bool_and(reached) AS every FROM r GROUP BY 1, 2, 3)
SELECT contig, strand, seed AS coordinate, supporting_conditions, CASE WHEN every THEN 'rejected' ELSE status END AS status, CASE WHEN every THEN 'constitutive_readthrough' ELSE rejection END AS rejection_reason
FROM (SELECT c.contig, c.strand, c.seed, c.conditions AS supporting_conditions, status, coalesce(every, false) AS every, CASE WHEN status='rejected' THEN concat_ws(';', CASE WHEN total<{SUPPORT.least_total} THEN 'total_count<{SUPPORT.least_total}' END, CASE WHEN NOT supported THEN 'supporting_sample_fraction<0.7' END) ELSE '' END AS rejection
 FROM cand c LEFT JOIN x ON x.contig=c.contig AND x.strand=c.strand AND x.seed=c.seed)""")
def j13_readthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept and the rejected sites in one table."""
    found = written(_candidates(spark, sf_dir))
    kept, rejected = candidates.readthrough(found, _continuations(spark, sf_dir), v.samples(spark), 180, 2, 5)
    return kept.unionByName(rejected).select("contig", "strand", "coordinate", "supporting_conditions", "status", "rejection_reason")


@query()
def m1_m2_m3_joint_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The family of control C0 by the design `~ batch + condition`: every gene's precision, contrast, omnibus and site tests."""
    sheet = v.samples(spark).filter("condition = 'C0' OR control_condition = 'C0'")
    rows = [{**r.asDict(), "batch": "ab"[int(r.sample_id[1:]) % 2]} for r in sheet.collect()]  # a sheet
    layout = family.family_layout(rows, "C0", ("batch",))
    counts = aggregates.complete(v.site_counts(spark, sf_dir), v.atlas(spark, sf_dir).select("pac_id", "gene_id"), sheet, ["pac_id", "gene_id"])
    counts = written(counts)
    fits = regression.fit_family(counts.join(regression.precisions(counts, layout), "gene_id"), layout)
    p = lambda lr, df: F.round(models.chi_square_tail(F.col(lr), df), 6)
    return fits.select("gene_id", "treatment", "pac_id", F.round("control_fit", 4).alias("control_fit"), F.round("treatment_fit", 4).alias("treatment_fit"), p("gene_lr", F.col("gene_df")).alias("gene_p"), p("pac_lr", F.lit(1)).alias("pac_p"),
                       p("omnibus_lr", F.col("omnibus_df")).alias("omnibus_p"), "status")
