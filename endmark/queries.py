"""One query for each operator over the adapter views, with the DuckDB SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import records, sequences
from .operators import aggregates, clustering, joins, testing
from .plans import adapters as v
from .plans.adapters import BASE, FULL, INTERVALS, SEQS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _r(c, name: str):
    return F.round(c, 9).alias(name)


# ---- records and sequences -------------------------------------------------------------------

_FLAG = "CAST((event_id*37)%4096 AS BIGINT)"


@query(f"""WITH e AS (SELECT event_id, {_FLAG} AS flag, event_id%60 AS mapq, 'c'||(event_id%7) AS contig, CASE WHEN event_id%3=0 THEN NULL ELSE 1+event_id%5//4 END AS hits FROM events)
SELECT CASE WHEN flag&4!=0 THEN 'unmapped' WHEN flag&256!=0 THEN 'secondary' WHEN flag&2048!=0 THEN 'supplementary' WHEN flag&512!=0 THEN 'qc_failed' WHEN flag&1024!=0 THEN 'duplicate'
 WHEN mapq<10 THEN 'low_mapq' WHEN contig='c3' THEN 'excluded_contig' WHEN hits IS NOT NULL AND hits!=1 THEN 'multimapped' ELSE 'kept' END AS reason, count(*) AS n, min(event_id) AS first_record FROM e GROUP BY 1""")
def p1_a3_record_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = v.load(spark, sf_dir, "events")
    flag, hits = (F.col("event_id") * 37) % 4096, F.when(F.col("event_id") % 3 == 0, None).otherwise(1 + F.expr("(event_id % 5) div 4"))
    why = records.filter_reason(flag, F.col("event_id") % 60, F.concat(F.lit("c"), F.col("event_id") % 7), hits, 10, ["c3"])
    return e.select("event_id", F.coalesce(why, F.lit("kept")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"), F.min("event_id").alias("first_record"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey+CAST(l_quantity AS BIGINT)+CASE WHEN l_linenumber%2=0 THEN l_suppkey ELSE 0 END+7 AS ref_end,
 CASE WHEN l_linestatus='O' THEN l_partkey+CAST(l_quantity AS BIGINT)+CASE WHEN l_linenumber%2=0 THEN l_suppkey ELSE 0 END+7 ELSE l_partkey END AS boundary,
 CASE WHEN l_linenumber%2=0 THEN 2 ELSE 1 END AS n_blocks FROM lineitem""")
def p6_p8_p9_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.load(spark, sf_dir, "lineitem").withColumn("strand", F.when(F.col("l_linestatus") == "O", "+").otherwise("-"))
    op = lambda code, n: F.struct(F.lit(code).alias("op"), n.cast("long").alias("len"))
    mid = F.when(F.col("l_linenumber") % 2 == 0, op(3, F.col("l_suppkey"))).otherwise(op(1, F.lit(5)))
    d = d.withColumn("cigar", F.array(op(4, F.lit(3)), op(0, F.col("l_quantity")), mid, op(0, F.lit(7)))).withColumn("e", records.reference_end(F.col("l_partkey"), F.col("cigar")))
    return d.select("l_orderkey", "l_linenumber", F.col("e").alias("ref_end"), records.boundary(F.col("strand"), F.col("l_partkey"), F.col("e"), F.lit("read_3p")).cast("long").alias("boundary"), F.size(records.splice_blocks(F.col("l_partkey"), F.col("cigar"))).alias("n_blocks"))


@query(f"""WITH {SEQS} SELECT doc_id, reverse(translate(seq,'ACGTN','TGCAN')) AS revcomp, CAST(coalesce(list_max(list_transform(regexp_extract_all(seq,'A+'), lambda x: length(x))),0) AS INT) AS a_run,
 CASE WHEN length(seq)>0 THEN round((length(seq)-length(replace(seq,'A','')))/length(seq),9) ELSE 0 END AS a_fraction, CASE WHEN coalesce(seq,'')='' THEN 'none' ELSE translate(seq,'T','U') END AS rna,
 (length(seq)>=6 AND (length(seq)-length(replace(seq,'A','')))/length(seq)>=0.8) AS poly_a, contains(seq,'AATAAA') AS has_signal FROM seqs""")
def f1_f4_f5_f6_f8_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(v.sequences(spark, sf_dir))


def _features(d: DataFrame) -> DataFrame:
    s = F.col("seq")
    return d.select(
        "doc_id", sequences.reverse_complement(s).alias("revcomp"), sequences.longest_run(s, "A").alias("a_run"), _r(sequences.base_fraction(s, "A"), "a_fraction"), sequences.to_rna(s).alias("rna"),
        sequences.poly_a_like(s).alias("poly_a"), F.contains(s, F.lit("AATAAA")).alias("has_signal"))


@query(f"""WITH {SEQS} SELECT kmer, count(*) AS n FROM (SELECT doc_id, unnest(list_distinct(list_transform(range(1,length(seq)-2), lambda i: substr(seq,i,4)))) AS kmer FROM seqs WHERE length(seq)>=4) GROUP BY 1""")
def f7_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kmer_counts(v.sequences(spark, sf_dir))


def _kmer_counts(d: DataFrame) -> DataFrame:
    return d.select(F.explode(sequences.kmers(F.col("seq"), 4)).alias("kmer")).groupBy("kmer").agg(F.count("*").alias("n"))


@query(f"""WITH {SEQS}, m(motif,motif_class,priority) AS (VALUES ('AATAAA','canonical',1),('ATTAAA','variant',2),('AAGAAA','variant',3),('ACGTAA','other',4)),
h AS (SELECT doc_id, motif, motif_class, priority, length(seq)-i AS distance FROM seqs, m, range(0,(SELECT max(length(seq)) FROM seqs)) r(i) WHERE i<=length(seq)-6 AND contains(seq,motif) AND substr(seq,CAST(i AS INT)+1,6)=motif),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY priority, CASE WHEN distance BETWEEN 15 AND 30 THEN 0 ELSE 1 END, abs(distance-20), distance) rn, count(*) OVER (PARTITION BY doc_id) n FROM h)
SELECT s.doc_id, coalesce(motif,'no_recognized_motif') AS motif, motif_class, CAST(distance AS INT) AS distance, CAST(coalesce(n,0) AS INT) AS hits FROM seqs s LEFT JOIN r ON r.doc_id=s.doc_id AND rn=1""")
def f2_f3_motifs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _motifs(v.sequences(spark, sf_dir))


def _motifs(d: DataFrame) -> DataFrame:
    hits = sequences.motif_hits(F.col("seq"), [("AATAAA", "canonical", 1), ("ATTAAA", "variant", 2), ("AAGAAA", "variant", 3), ("ACGTAA", "other", 4)], (15, 30))
    d = d.withColumn("hits", hits)
    return d.select("doc_id", sequences.primary_motif(F.col("hits")).alias("motif"), F.get("hits", F.lit(0))["motif_class"].alias("motif_class"), F.get("hits", F.lit(0))["distance"].cast("int").alias("distance"), F.size("hits").alias("hits"))


@query("""SELECT c_custkey, CAST(sign(b)*((abs(b)+3)//7) AS BIGINT) AS bin7, regexp_replace(c_name,'[^A-Za-z0-9._-]+','_','g') AS safe
 FROM (SELECT *, CAST(c_nationkey-12 AS BIGINT) AS b FROM customer)""")
def p14_p21_bins_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.load(spark, sf_dir, "customer").select("c_custkey", sequences.nearest_bin(F.col("c_nationkey").cast("long") - 12, 7).alias("bin7"), sequences.safe_component(F.col("c_name")).alias("safe"))


# ---- joins -----------------------------------------------------------------------------------


@query(f"""{BASE}, n AS (SELECT o.sample_id, o.contig, o.strand, o.coordinate, a.pac_id, row_number() OVER (PARTITION BY o.sample_id, o.contig, o.strand, o.coordinate ORDER BY abs(o.coordinate-a.coordinate), a.coordinate) rn
 FROM obs o LEFT JOIN atlas_v a ON a.chrom=o.contig AND a.strand=o.strand AND abs(o.coordinate-a.coordinate)<=9) SELECT sample_id, contig, strand, coordinate, pac_id FROM n WHERE rn=1""")
def j3_nearest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = v.atlas(spark, sf_dir).select("pac_id", F.col("chrom").alias("contig"), "strand", F.col("coordinate").alias("site"))
    out = joins.nearest_within(v.observed(spark, sf_dir), sites, ["contig", "strand"], ["sample_id", "contig", "strand", "coordinate"], "coordinate", "site", 9)
    return out.select("sample_id", "contig", "strand", "coordinate", "pac_id")


def _band_sql(tie: str) -> str:
    return f"""{BASE}, k AS (SELECT CAST(i AS BIGINT) AS "offset", CAST(31-abs(i) AS DOUBLE)/961 AS weight FROM range(-30,31) t(i)),
c AS (SELECT o.sample_id, o.contig, o.strand, o.coordinate, a.pac_id, k.weight, a.coordinate AS site, CASE WHEN o.strand='+' THEN a.coordinate ELSE -a.coordinate END AS osite FROM obs o LEFT JOIN atlas_v a ON a.chrom=o.contig AND a.strand=o.strand AND abs(o.coordinate-a.coordinate)<=30
 LEFT JOIN k ON k."offset"=CASE WHEN o.strand='+' THEN a.coordinate-o.coordinate ELSE o.coordinate-a.coordinate END),
r AS (SELECT *, row_number() OVER w AS rn, lead(weight) OVER w AS second FROM c WINDOW w AS (PARTITION BY sample_id, contig, strand, coordinate ORDER BY weight DESC NULLS LAST, {tie}))
SELECT sample_id, contig, strand, coordinate, CASE WHEN weight IS NULL THEN 'unassigned' WHEN second>0 AND weight<1.5*second THEN 'ambiguous' ELSE 'assigned' END AS status,
 CASE WHEN weight IS NULL OR (second>0 AND weight<1.5*second) THEN NULL ELSE pac_id END AS pac_id FROM r WHERE rn=1"""


def _band(spark: SparkSession, sf_dir: str, ties: str) -> DataFrame:
    kernel = spark.range(-30, 31).select(F.col("id").alias("offset"), ((31 - F.abs("id")).cast("double") / 961).alias("weight"))
    sites = v.atlas(spark, sf_dir).select("pac_id", F.col("chrom").alias("contig"), "strand", F.col("coordinate").alias("site"))
    out = joins.band_assign(v.observed(spark, sf_dir), sites, kernel, ["contig", "strand"], ["sample_id", "contig", "strand", "coordinate"], "coordinate", "site", 30, 1.5, ties)
    return out.select("sample_id", "contig", "strand", "coordinate", "status", "pac_id")


@query(_band_sql("site"))
def j4_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _band(spark, sf_dir, "genomic")


@query(_band_sql("osite"))
def j5_band_join_oriented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _band(spark, sf_dir, "oriented")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pid"), F.col("l_linenumber").alias("no"), (F.col("l_orderkey") * 20 + F.col("l_linenumber") * 13).cast("long").alias("pos"))


_POINTS = "pts AS (SELECT l_orderkey AS pid, l_linenumber AS no, CAST(l_orderkey*20+l_linenumber*13 AS BIGINT) AS pos FROM lineitem)"


@query(f"""WITH {_POINTS}, {INTERVALS} SELECT grp, count(*) AS pairs, CAST(sum(pos-start) AS BIGINT) AS depth FROM pts JOIN ivals ON pos BETWEEN start AND "end" GROUP BY 1""")
def j7_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = joins.contained(_points(spark, sf_dir), v.intervals(spark, sf_dir), [], "pos", width=128)
    return out.groupBy("grp").agg(F.count("*").alias("pairs"), F.sum(F.col("pos") - F.col("start")).alias("depth"))


@query(f"""WITH {INTERVALS} SELECT a.grp, count(*) AS pairs, CAST(sum(least(a."end",b."end")-greatest(a.start,b.start)) AS BIGINT) AS shared FROM ivals a JOIN ivals b ON a.grp=b.grp AND a.start<b."end" AND b.start<a."end" AND a.id<b.id GROUP BY 1""")
def j9_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = v.intervals(spark, sf_dir)
    b = a.withColumnsRenamed({"id": "id2", "start": "start2", "end": "end2"})
    out = joins.overlapping(a, b, ["grp"], ("start", "end"), ("start2", "end2"), 256).filter("id < id2")
    return out.groupBy("grp").agg(F.count("*").alias("pairs"), F.sum(F.least("end", "end2") - F.greatest("start", "start2")).alias("shared"))


@query(f"""{BASE} SELECT pac_id, (SELECT count(DISTINCT o.coordinate) FROM obs o WHERE o.contig=a.chrom AND o.strand=a.strand AND abs(o.coordinate-a.coordinate)<=12) AS known,
 (SELECT string_agg(c::VARCHAR, ',' ORDER BY c) FROM (SELECT DISTINCT o.coordinate AS c FROM obs o WHERE o.contig=a.chrom AND o.strand=a.strand AND abs(o.coordinate-a.coordinate)<=12)) AS sites FROM atlas_v a""")
def j11_radius_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = v.observed(spark, sf_dir).select("contig", "strand", F.col("coordinate").alias("known")).distinct()
    sites = v.atlas(spark, sf_dir).withColumnRenamed("chrom", "contig")
    out = joins.within(sites, known, ["contig", "strand"], "coordinate", "known", 12, "left").groupBy("pac_id").agg(F.array_sort(F.collect_set("known")).alias("k"))
    return out.select("pac_id", F.size("k").cast("long").alias("known"), F.nullif(F.array_join(F.col("k").cast("array<string>"), ","), F.lit("")).alias("sites"))


@query(f"""{BASE} SELECT sample_id, contig, strand, coordinate FROM obs o WHERE NOT EXISTS (SELECT 1 FROM atlas_v a WHERE a.chrom=o.contig AND a.strand=o.strand AND abs(o.coordinate-a.coordinate)<=5)""")
def j14_anti_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = v.atlas(spark, sf_dir).withColumnRenamed("chrom", "contig")
    return joins.without_neighbours(v.observed(spark, sf_dir), sites, ["contig", "strand"], "coordinate", "coordinate", 5).select("sample_id", "contig", "strand", "coordinate")


@query(f"""{BASE}, c AS (SELECT o.sample_id, o.contig, o.strand, o.coordinate, a.coordinate AS site, a.gene_id, row_number() OVER (PARTITION BY o.sample_id, o.contig, o.strand, o.coordinate ORDER BY abs(o.coordinate-a.coordinate), a.coordinate, a.gene_id) rn
 FROM obs o JOIN atlas_v a ON a.chrom=o.contig AND a.strand=o.strand AND abs(o.coordinate-a.coordinate)<=7) SELECT sample_id, contig, strand, coordinate, site, gene_id FROM c WHERE rn=1""")
def j6_nearest_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = v.atlas(spark, sf_dir).select(F.col("chrom").alias("contig"), "strand", F.col("coordinate").alias("end"), F.col("gene_id").alias("gene"))
    points = v.observed(spark, sf_dir).select("sample_id", "contig", "strand", "coordinate")
    return joins.nearest_end(points, ends, ["contig", "strand"], "coordinate", 7).withColumnsRenamed({"end": "site", "gene": "gene_id"})


# ---- aggregates and windows ------------------------------------------------------------------


@query(f"{BASE} SELECT *, 'read_3p' AS evidence_source FROM obs")
def a1_read_end_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each read end of the table, counted again by the operator."""
    n, clipped = F.col("l_quantity").cast("long"), F.round(F.col("l_discount") * 100).cast("long")
    place = ((F.col("l_orderkey") % 500) * 200 + F.col("l_linenumber") * 3).cast("long")
    reads = v.load(spark, sf_dir, "lineitem").filter(n > 0).select(
        F.concat(F.lit("S"), F.col("l_suppkey") % 8).alias("sample_id"), F.concat(F.lit("ctg"), "l_returnflag").alias("contig"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        place.alias("coordinate"), F.lit("read_3p").alias("evidence_source"), clipped.alias("clipped"), F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("no"))
    return aggregates.read_end_counts(reads.withColumn("poly_a_clip", F.col("no") <= F.col("clipped")))


@query(f"{FULL}, g AS (SELECT gene_id, sample_id, CAST(sum(\"count\") AS BIGINT) AS gene_total FROM counts GROUP BY 1,2) SELECT gene_id, sample_id, gene_total FROM g")
def a6_gene_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.gene_totals(v.site_counts(spark, sf_dir))


@query(f"{FULL} SELECT a.pac_id, s.sample_id, coalesce(c.\"count\",0) AS \"count\" FROM atlas_v a CROSS JOIN samples_v s LEFT JOIN counts c ON c.pac_id=a.pac_id AND c.sample_id=s.sample_id")
def a7_complete_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.complete(v.site_counts(spark, sf_dir), v.atlas(spark, sf_dir).select("pac_id"), v.samples(spark), ["pac_id"])


@query(f"{FULL}, g AS (SELECT gene_id, sample_id, sum(\"count\") AS t FROM counts GROUP BY 1,2) SELECT gene_id, CAST(min(t) AS BIGINT) AS least_total FROM g GROUP BY 1 HAVING min(t)>=200 AND count(*)=8")
def a8_covered_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.covered_genes(aggregates.gene_totals(v.site_counts(spark, sf_dir)), 200, 8)


@query(f"{FULL} SELECT pac_id, gene_id, sample_id, \"count\", CAST(sum(\"count\") OVER (PARTITION BY gene_id, sample_id) AS BIGINT) AS gene_total, round(\"count\"/nullif(sum(\"count\") OVER (PARTITION BY gene_id, sample_id),0),9) AS pau FROM counts")
def w1_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.usage(v.site_counts(spark, sf_dir)).withColumn("pau", F.round("pau", 9))


@query(f"""{BASE}, r AS (SELECT pac_id, row_number() OVER (PARTITION BY gene_id, strand ORDER BY CASE WHEN strand='+' THEN coordinate ELSE -coordinate END, pac_id) AS site_rank, count(*) OVER (PARTITION BY gene_id, strand) AS n_sites FROM atlas_v)
SELECT pac_id, CAST(site_rank AS INT) AS site_rank, n_sites, CASE WHEN site_rank=1 THEN 'proximal' WHEN site_rank=n_sites THEN 'distal' ELSE 'middle' END AS site_label FROM r""")
def w2_site_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.ranked_sites(v.atlas(spark, sf_dir)).select("pac_id", "site_rank", "n_sites", "site_label")


_LOCI = """loc AS (SELECT contig, strand, coordinate//200 AS locus, coordinate%200 AS o, CAST(sum("count") AS BIGINT) AS w FROM obs GROUP BY 1,2,3,4),
cum AS (SELECT *, sum(w) OVER (PARTITION BY contig, strand, locus ORDER BY o) AS c, sum(w) OVER (PARTITION BY contig, strand, locus) AS n FROM loc)"""


@query(f"""{BASE}, {_LOCI} SELECT contig, strand, locus, CAST(max(n) AS BIGINT) AS n, min(CASE WHEN c>round_even(0.05*(n-1),0) THEN o END) AS q05, min(CASE WHEN c>round_even(0.5*(n-1),0) THEN o END) AS q50, min(CASE WHEN c>round_even(0.95*(n-1),0) THEN o END) AS q95 FROM cum GROUP BY 1,2,3""")
def a11_weighted_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.observed(spark, sf_dir).select("contig", "strand", F.expr("coordinate div 200").alias("locus"), (F.col("coordinate") % 200).alias("o"), "count")
    return aggregates.weighted_rank_coordinate(d, ["contig", "strand", "locus"], "o", "count", {"q05": 0.05, "q50": 0.5, "q95": 0.95})


_OFFS = 'offs AS (SELECT sample_id, coordinate%200-9 AS "offset", CAST(sum("count") AS BIGINT) AS c, CAST(sum(poly_a_clip_count) AS BIGINT) AS clips FROM obs GROUP BY 1,2)'


@query(f"""{BASE}, {_OFFS}, x AS (SELECT sample_id, "offset", c, clips, sum(c) OVER (PARTITION BY sample_id) AS n, sum(c) OVER (PARTITION BY sample_id ORDER BY "offset") AS cum FROM offs)
SELECT sample_id, CAST(max(n) AS BIGINT) AS n, arg_min("offset", (-c, "offset")) AS modal_offset,
 CAST(min(CASE WHEN cum>floor(0.5*(n-1)) THEN "offset" END)+(0.5*(max(n)-1)-floor(0.5*(max(n)-1)))*(min(CASE WHEN cum>floor(0.5*(n-1))+1 THEN "offset" END)-min(CASE WHEN cum>floor(0.5*(n-1)) THEN "offset" END)) AS DOUBLE) AS median_offset,
 round(sum(CASE WHEN abs("offset")<=1 THEN c ELSE 0 END)/sum(c),9) AS boundary_fraction, round(sum(clips)/sum(c),9) AS poly_a_clip_fraction FROM x GROUP BY 1""")
def a10_a12_calibration_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.observed(spark, sf_dir).select("sample_id", (F.col("coordinate") % 200 - 9).alias("offset"), "count", "poly_a_clip_count")
    out = aggregates.offset_metrics(d, ["sample_id"], 0.05, 0.95, clips="poly_a_clip_count")
    return out.select("sample_id", "n", "modal_offset", "median_offset", *[_r(F.col(c), c) for c in ("boundary_fraction", "poly_a_clip_fraction")])


_KERNEL = f"""{_OFFS}, grid AS (SELECT sample_id, CAST(i AS BIGINT) AS "offset" FROM samples_v, range(-30,31) t(i)),
dense AS (SELECT g.sample_id, g."offset", coalesce(c,0) AS c FROM grid g LEFT JOIN offs o ON o.sample_id=g.sample_id AND o."offset"=g."offset"),
sm AS (SELECT sample_id, "offset", coalesce(lag(c,2) OVER w,0)+2*coalesce(lag(c,1) OVER w,0)+3*c+2*coalesce(lead(c,1) OVER w,0)+coalesce(lead(c,2) OVER w,0) AS s FROM dense WINDOW w AS (PARTITION BY sample_id ORDER BY "offset")),
kern AS (SELECT sample_id, "offset", s/sum(s) OVER (PARTITION BY sample_id) AS weight FROM sm)"""


def _kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.observed(spark, sf_dir).select("sample_id", (F.col("coordinate") % 200 - 9).alias("offset"), "count")
    return aggregates.empirical_kernel(d, ["sample_id"], 30)


@query(f'{BASE}, {_KERNEL} SELECT sample_id, "offset", round(weight,9) AS weight FROM kern')
def a16_w7_empirical_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kernels(spark, sf_dir).withColumn("weight", F.round("weight", 9))


@query(f"""{BASE}, {_KERNEL}, x AS (SELECT sample_id, weight, (sum(weight) OVER (PARTITION BY "offset")-weight)/7 AS rest FROM kern) SELECT sample_id, round(corr(weight,rest),6) AS reproducibility FROM x GROUP BY 1""")
def a17_reproducibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.reproducibility(_kernels(spark, sf_dir), "sample_id").withColumn("reproducibility", F.round("reproducibility", 6))


@query(f"""{BASE}, {_KERNEL}, p AS (SELECT "offset", avg(weight) AS w FROM kern GROUP BY 1), q AS (SELECT "offset", w/sum(w) OVER () AS w FROM p WHERE w>0)
SELECT b."offset"-a."offset" AS shift, round(sum(least(a.w,b.w)),9) AS overlap FROM q a JOIN q b ON b."offset">=a."offset" GROUP BY 1""")
def a18_a19_pooled_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.self_overlap(aggregates.pooled_kernel(_kernels(spark, sf_dir))).withColumn("overlap", F.round("overlap", 9))


@query(f"""{FULL}, s AS (SELECT condition, count(*) AS size FROM samples_v GROUP BY 1),
p AS (SELECT pac_id, c.condition, count(DISTINCT n.sample_id) AS support, max(size) AS size FROM counts n JOIN samples_v c ON c.sample_id=n.sample_id JOIN s ON s.condition=c.condition WHERE n."count">=40 GROUP BY 1,2),
q AS (SELECT *, support>=ceil(0.7*size) AS passes, row_number() OVER (PARTITION BY pac_id ORDER BY support>=ceil(0.7*size) DESC, support/size DESC, support DESC, condition) AS rn FROM p)
SELECT pac_id, max(CASE WHEN rn=1 THEN condition END) AS best_condition, max(CASE WHEN rn=1 THEN support END) AS best_support, bool_or(passes) AS supported, coalesce(string_agg(CASE WHEN passes THEN condition END, ';' ORDER BY condition),'') AS passing FROM q GROUP BY 1""")
def a22_condition_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.condition_support(v.site_counts(spark, sf_dir).drop("gene_id"), v.samples(spark).select("sample_id", "condition"), ["pac_id"], 40, 0.7)


@query(f"""{FULL}, p AS (SELECT pac_id, c.condition, count(DISTINCT n.sample_id) AS support FROM counts n JOIN samples_v c ON c.sample_id=n.sample_id WHERE n."count">=40 GROUP BY 1,2),
q AS (SELECT *, support>=2 AS passes, row_number() OVER (PARTITION BY pac_id ORDER BY support>=2 DESC, support DESC, condition) AS rn FROM p)
SELECT pac_id, max(CASE WHEN rn=1 THEN condition END) AS best_condition, max(CASE WHEN rn=1 THEN support END) AS best_support, bool_or(passes) AS supported, coalesce(string_agg(CASE WHEN passes THEN condition END, ';' ORDER BY condition),'') AS passing FROM q GROUP BY 1""")
def a22_condition_support_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.condition_support(v.site_counts(spark, sf_dir).drop("gene_id"), v.samples(spark).select("sample_id", "condition"), ["pac_id"], 40, 2)


@query(f"""{BASE}, st AS (SELECT DISTINCT contig, strand, coordinate FROM obs), x AS (SELECT s.contig, s.strand, s.coordinate, o.sample_id, sum(CASE WHEN abs(s.coordinate-o.coordinate)<=4 THEN o."count" ELSE 0 END) AS s, sum(CASE WHEN abs(s.coordinate-o.coordinate)>4 THEN o."count" ELSE 0 END) AS f
 FROM st s JOIN obs o ON o.contig=s.contig AND o.strand=s.strand AND abs(s.coordinate-o.coordinate)<=8 GROUP BY 1,2,3,4)
SELECT contig, strand, coordinate, count(*) FILTER (s>0) AS supporting, CAST(sum(least(s,3)) AS BIGINT) AS capped, CAST(sum(s) AS BIGINT) AS raw, CAST(sum(f) AS BIGINT) AS flank FROM x GROUP BY 1,2,3""")
def a23_a24_w8_seed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.seed_metrics(v.observed(spark, sf_dir), 4)


@query(f"""WITH {INTERVALS}, r AS (SELECT *, max("end") OVER (PARTITION BY grp ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ivals),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start>reach THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM r)
SELECT grp, CAST(island AS BIGINT) AS island, min(start) AS start, max("end") AS "end", count(*) AS members FROM i GROUP BY 1,2""")
def a30_w10_merged_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.merged_intervals(v.intervals(spark, sf_dir), ["grp"])


@query(f"""{FULL}, u AS (SELECT pac_id, sample_id, "count"/nullif(sum("count") OVER (PARTITION BY gene_id, sample_id),0) AS pau FROM counts), f AS (SELECT * FROM u WHERE pac_id IN (SELECT pac_id FROM u WHERE pau IS NOT NULL GROUP BY 1 HAVING count(*)=8))
SELECT x.sample_id AS a, y.sample_id AS b, count(*) AS n, round(corr(x.pau,y.pau),6) AS r FROM f x JOIN f y ON x.pac_id=y.pac_id AND x.sample_id<y.sample_id GROUP BY 1,2""")
def a46_sample_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.sample_correlation(aggregates.usage(v.site_counts(spark, sf_dir)), 8).withColumn("r", F.round("r", 6))


# ---- fitted table, calls and tests -----------------------------------------------------------

_FIT = """u AS (SELECT c.pac_id, c.gene_id, s.condition, c.sample_id, c."count", sum(c."count") OVER (PARTITION BY c.gene_id, c.sample_id) AS t FROM counts c JOIN samples_v s ON s.sample_id=c.sample_id),
g AS (SELECT pac_id, gene_id, condition, sum("count") AS n, count(*) FILTER ("count">0) AS sup, sum(t) AS t, round(sum("count")/sum(t),9) AS fit FROM u GROUP BY 1,2,3),
cmp AS (SELECT c.pac_id, c.gene_id, t.condition AS comparison, round(t.fit-c.fit,9) AS delta, c.fit AS c_fit, t.fit AS t_fit, c.sup AS c_sup, t.sup AS t_sup, CAST(c.t AS BIGINT) AS c_total, CAST(t.t AS BIGINT) AS t_total
 FROM g c JOIN g t ON c.pac_id=t.pac_id AND c.condition='C0' AND t.condition IN ('C1','C2')),
fitted AS (SELECT m.*, a.strand, a.coordinate, ((a.coordinate*7919)%10007)/10007.0 AS p FROM cmp m JOIN atlas_v a ON a.pac_id=m.pac_id)"""


def fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group usages and deltas of two comparisons with a synthetic p-value."""
    u = aggregates.usage(v.site_counts(spark, sf_dir)).join(v.samples(spark), "sample_id")
    g = u.groupBy("pac_id", "gene_id", "condition").agg(F.count_if(F.col("count") > 0).alias("sup"), F.sum("gene_total").alias("t"), F.round(F.sum("count") / F.sum("gene_total"), 9).alias("fit"))
    c = g.filter("condition = 'C0'").select("pac_id", "gene_id", F.col("fit").alias("c_fit"), F.col("sup").alias("c_sup"), F.col("t").alias("c_total"))
    t = g.filter("condition in ('C1', 'C2')").select("pac_id", F.col("condition").alias("comparison"), F.col("fit").alias("t_fit"), F.col("sup").alias("t_sup"), F.col("t").alias("t_total"))
    d = c.join(t, "pac_id").join(v.atlas(spark, sf_dir).select("pac_id", "strand", "coordinate"), "pac_id")
    return d.withColumn("delta", F.round(F.col("t_fit") - F.col("c_fit"), 9)).withColumn("p", ((F.col("coordinate") * 7919) % 10007) / F.lit(10007.0))


_FDR = """bh AS (SELECT *, rank() OVER (PARTITION BY comparison ORDER BY p)+count(*) OVER (PARTITION BY comparison, p)-1 AS rk, count(*) OVER (PARTITION BY comparison) AS m FROM fitted WHERE p IS NOT NULL),
fdr AS (SELECT *, least(1.0, min(p*m/rk) OVER (PARTITION BY comparison ORDER BY p DESC)) AS fdr FROM bh)"""


@query(f"{FULL}, {_FIT}, {_FDR} SELECT pac_id, comparison, round(p,9) AS p, round(fdr,9) AS fdr FROM fdr")
def m9_w5_benjamini_hochberg(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = testing.benjamini_hochberg(fitted(spark, sf_dir), "p", keys=["comparison"])
    return out.select("pac_id", "comparison", _r(F.col("p"), "p"), _r(F.col("fdr"), "fdr"))


_EVENT = """CASE WHEN c_sup<2 AND t_sup>=2 AND c_fit<=0.3 AND t_fit>=0.3 AND delta>=0.05 THEN CASE WHEN p<=0.5 AND c_total>=20 THEN 'gained' ELSE 'gained_candidate' END
 WHEN t_sup<2 AND c_sup>=2 AND t_fit<=0.3 AND c_fit>=0.3 AND delta<=-0.05 THEN CASE WHEN p<=0.5 AND t_total>=20 THEN 'lost' ELSE 'lost_candidate' END
 WHEN c_sup>=2 AND t_sup>=2 AND p<=0.5 AND delta>=0.05 THEN 'increased_usage' WHEN c_sup>=2 AND t_sup>=2 AND p<=0.5 AND delta<=-0.05 THEN 'decreased_usage' ELSE 'none' END"""


def _called(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    event = testing.event_type(c("c_sup"), c("t_sup"), c("delta"), c("c_fit"), c("t_fit"), c("p"), c("p"), F.lit(True), F.lit(True), c("c_total"), c("t_total"), 2, 0.05, 0.3, 0.3, 0.5, 0.5)
    return fitted(spark, sf_dir).withColumn("event_type", event)


@query(f"{FULL}, {_FIT} SELECT pac_id, comparison, {_EVENT} AS event_type, delta FROM fitted")
def a40_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _called(spark, sf_dir).select("pac_id", "comparison", "event_type", "delta")


@query(f"{FULL}, {_FIT} SELECT comparison, {_EVENT} AS event_type, count(*) AS n FROM fitted GROUP BY 1,2")
def a43_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _called(spark, sf_dir).groupBy("comparison", "event_type").agg(F.count("*").alias("n"))


@query(f"""{FULL}, {_FIT}, e AS (SELECT *, {_EVENT} AS ev, CASE WHEN strand='+' THEN coordinate ELSE -coordinate END AS o FROM fitted),
x AS (SELECT *, ev IN ('gained','increased_usage') AS up, ev IN ('lost','decreased_usage') AS down FROM e),
f AS (SELECT comparison, gene_id, arg_min((pac_id,o), (-delta,p,pac_id)) FILTER (up) AS t, arg_min((pac_id,o), (delta,p,pac_id)) FILTER (down) AS fr FROM x GROUP BY 1, 2 HAVING bool_or(up OR down)),
y AS (SELECT x.comparison, x.gene_id, any_value(f.t) AS t, any_value(f.fr) AS fr, arg_min((pac_id,o),(delta,p,pac_id)) FILTER (f.t IS NULL OR pac_id<>f.t[1]) AS f2, arg_min((pac_id,o),(-delta,p,pac_id)) FILTER (f.fr IS NULL OR pac_id<>f.fr[1]) AS t2
 FROM x JOIN f ON f.gene_id=x.gene_id AND f.comparison=x.comparison GROUP BY 1, 2),
z AS (SELECT comparison, gene_id, coalesce(fr,f2) AS a, coalesce(t,t2) AS b FROM y)
SELECT comparison, gene_id, a[1] AS from_pac, b[1] AS to_pac, CASE WHEN b[2]>a[2] THEN 'distal' ELSE 'proximal' END AS direction FROM z""")
def a41_gene_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testing.gene_shifts(_called(spark, sf_dir).withColumnRenamed("p", "pac_fdr"), ["comparison"])


@query(f"""{FULL}, {_FIT}, d AS (SELECT pac_id, comparison, delta, abs(delta)>=0.05 AS called FROM fitted) SELECT x.comparison AS a, y.comparison AS b, count(*) AS n, count(*) FILTER (x.called AND y.called) AS called_in_both, round(corr(x.delta,y.delta),6) AS r
FROM d x JOIN d y ON x.pac_id=y.pac_id AND x.comparison<y.comparison GROUP BY 1,2""")
def a45_j17_concordance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.concordance(fitted(spark, sf_dir).withColumn("called", F.abs("delta") >= 0.05)).withColumn("r", F.round("r", 6))


@query(f"""{FULL}, full_c AS (SELECT a.pac_id, a.gene_id, s.sample_id, coalesce(c."count",0) AS n FROM atlas_v a CROSS JOIN samples_v s LEFT JOIN counts c ON c.pac_id=a.pac_id AND c.sample_id=s.sample_id),
t AS (SELECT *, sum(n) OVER (PARTITION BY gene_id, sample_id) AS t FROM full_c), p AS (SELECT pac_id, gene_id, sum(n) AS sc, count(*) FILTER (n>0) AS sup, count(*) FILTER (t>0 AND t>=10 AND n>=0.2*t-1e-12) AS used, sum(t) AS gt FROM t GROUP BY 1,2),
r AS (SELECT *, concat_ws(';', CASE WHEN sc<150 THEN 'site_count<150' END, CASE WHEN sup<2 THEN 'supporting_samples<2' END, CASE WHEN used<2 THEN 'sample_usage<0.2' END) AS site FROM p),
e AS (SELECT *, sum(CASE WHEN site='' THEN 1 ELSE 0 END) OVER (PARTITION BY gene_id) AS el FROM r),
f AS (SELECT *, CASE WHEN site<>'' THEN site ELSE concat_ws(';', CASE WHEN gt<20 THEN 'gene_total<20' END, CASE WHEN el<2 THEN 'fewer_than_2_testable_pacs' END) END AS reason FROM e)
SELECT pac_id, gene_id, CAST(sc AS BIGINT) AS site_count, sup AS supporting_samples, reason, reason='' AS tested FROM f""")
def a33_p18_family_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pacs = v.atlas(spark, sf_dir).select("pac_id", "gene_id")
    whole = aggregates.complete(v.site_counts(spark, sf_dir), pacs, v.samples(spark), ["pac_id", "gene_id"])
    return testing.family_filter(whole, v.samples(spark), least_count=150, least_usage=0.2)


@query(f"""{FULL}, ge AS (SELECT DISTINCT gene_id FROM atlas_v), d AS (SELECT g.gene_id, s.sample_id, s.condition, coalesce(sum(c."count"),0) AS t FROM ge g CROSS JOIN samples_v s LEFT JOIN counts c ON c.gene_id=g.gene_id AND c.sample_id=s.sample_id WHERE s.condition IN ('C0','C2') GROUP BY 1,2,3),
l AS (SELECT sample_id, sum("count") AS lib FROM counts GROUP BY 1), e AS (SELECT d.*, lib, t*1e6/lib AS cpm FROM d JOIN l ON l.sample_id=d.sample_id),
m AS (SELECT *, avg(cpm) FILTER (condition='C0') OVER (PARTITION BY gene_id) AS cc, avg(cpm) FILTER (condition='C2') OVER (PARTITION BY gene_id) AS tc FROM e),
a AS (SELECT gene_id, max(cc) AS cc, max(tc) AS tc, count(*) FILTER (condition='C0' AND t>=300 AND cpm>=1) AS cd, count(*) FILTER (condition='C2' AND t>=300 AND cpm>=1) AS td, count(*) FILTER (condition='C0' AND t>0) AS cs, count(*) FILTER (condition='C2' AND t>0) AS ts,
 count(*) FILTER (condition='C0' AND tc*lib/1e6>=300) AS ch, count(*) FILTER (condition='C2' AND cc*lib/1e6>=300) AS th FROM m GROUP BY 1),
z AS (SELECT gene_id, cc, tc, CASE WHEN td>=2 AND cs<2 AND ch>=2 AND tc>=1 THEN 'turned_on' WHEN cd>=2 AND ts<2 AND th>=2 AND cc>=1 THEN 'turned_off' WHEN cd<2 AND td<2 THEN 'too_low_in_both' WHEN td>=2 AND cd<2 THEN 'too_low_in_control' WHEN cd>=2 AND td<2 THEN 'too_low_in_treatment' END AS status FROM a)
SELECT gene_id, status, round(cc,6) AS control_cpm, round(tc,6) AS treatment_cpm FROM z WHERE status IS NOT NULL""")
def a36_comparison_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = v.site_counts(spark, sf_dir)
    totals = aggregates.complete(aggregates.gene_totals(counts).withColumnRenamed("gene_total", "count"), v.atlas(spark, sf_dir).select("gene_id").distinct(), v.samples(spark), ["gene_id"]).withColumnRenamed("count", "gene_total")
    libraries = counts.groupBy("sample_id").agg(F.sum("count").alias("library"))
    out = testing.comparison_depth(totals, libraries, v.samples(spark).select("sample_id", "condition"), "C0", "C2", least_reads=300, floor=1.0)
    return out.withColumn("control_cpm", F.round("control_cpm", 6)).withColumn("treatment_cpm", F.round("treatment_cpm", 6))


@query(f"""{FULL}, {_FIT} SELECT comparison, gene_id, sum(delta) FILTER (false) AS nothing, round(quantile_cont(delta,0.025),6) AS low, round(quantile_cont(delta,0.975),6) AS high, count(*) AS successes FROM fitted GROUP BY 1,2 HAVING count(*)>=8""".replace(" sum(delta) FILTER (false) AS nothing,", ""))
def m14_percentile_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = testing.percentile_interval(fitted(spark, sf_dir), ["comparison", "gene_id"], "delta", replicates=10, share=0.8).filter("low is not null")
    return out.select("comparison", "gene_id", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "successes")


@query("""WITH s AS (SELECT l_returnflag AS k, l_suppkey%97 AS stratum, count(*) FILTER (l_linenumber%2=0 AND l_tax>0.04) AS a, count(*) FILTER (l_linenumber%2=0 AND l_tax<=0.04) AS b, count(*) FILTER (l_linenumber%2=1 AND l_tax>0.04) AS c, count(*) FILTER (l_linenumber%2=1 AND l_tax<=0.04) AS d FROM lineitem GROUP BY 1,2),
n AS (SELECT *, CAST(a+b+c+d AS DOUBLE) AS n FROM s WHERE a+b>0 AND c+d>0 AND a+c>0 AND b+d>0)
SELECT k, count(*) AS strata, CASE WHEN sum(b*c/n)=0 THEN 'inf'::DOUBLE ELSE round(sum(a*d/n)/sum(b*c/n),9) END AS odds_ratio,
 round(exp(ln(sum(a*d/n)/sum(b*c/n))-1.959963984540054*sqrt(sum((a+d)/n*a*d/n)/(2*pow(sum(a*d/n),2))+sum((a+d)/n*b*c/n+(b+c)/n*a*d/n)/(2*sum(a*d/n)*sum(b*c/n))+sum((b+c)/n*b*c/n)/(2*pow(sum(b*c/n),2)))),9) AS ci_low,
 round(exp(ln(sum(a*d/n)/sum(b*c/n))+1.959963984540054*sqrt(sum((a+d)/n*a*d/n)/(2*pow(sum(a*d/n),2))+sum((a+d)/n*b*c/n+(b+c)/n*a*d/n)/(2*sum(a*d/n)*sum(b*c/n))+sum((b+c)/n*b*c/n)/(2*pow(sum(b*c/n),2)))),9) AS ci_high, round(pow(sum(a-(a+b)*(a+c)/n),2)/sum((a+b)*(c+d)*(a+c)*(b+d)/(n*n*(n-1))),6) AS chi_square FROM n GROUP BY 1""")
def m17_mantel_haenszel(spark: SparkSession, sf_dir: str) -> DataFrame:
    even, high = F.col("l_linenumber") % 2 == 0, F.col("l_tax") > 0.04
    s = v.load(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("k"), (F.col("l_suppkey") % 97).alias("stratum")).agg(F.count_if(even & high).alias("a"), F.count_if(even & ~high).alias("b"), F.count_if(~even & high).alias("c"), F.count_if(~even & ~high).alias("d"))
    out = testing.mantel_haenszel(s, ["k"])
    return out.select("k", "strata", *[_r(F.col(c), c) for c in ("odds_ratio", "ci_low", "ci_high")], F.round("chi_square", 6).alias("chi_square"))


# ---- sorts, pivots, sets ---------------------------------------------------------------------


@query(f"{FULL} SELECT pac_id, " + ", ".join(f"coalesce(sum(\"count\") FILTER (sample_id='S{i}'),0)::BIGINT AS S{i}" for i in range(8)) + " FROM counts GROUP BY 1")
def u5_pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.site_counts(spark, sf_dir).groupBy("pac_id").pivot("sample_id", [f"S{i}" for i in range(8)]).agg(F.sum("count")).na.fill(0)


@query(f"""{FULL}, {_FIT}, {_FDR}, b AS (SELECT gene_id, min(fdr) AS f FROM fdr GROUP BY 1) SELECT gene_id, round(f,9) AS gene_fdr FROM b ORDER BY f NULLS LAST, gene_id LIMIT 50""")
def t3_top_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = testing.benjamini_hochberg(fitted(spark, sf_dir), "p", keys=["comparison"])
    return d.groupBy("gene_id").agg(F.min("fdr").alias("f")).orderBy(F.col("f").asc_nulls_last(), "gene_id").limit(50).select("gene_id", _r(F.col("f"), "gene_fdr"))


@query(f"""{FULL}, {_FIT}, r AS (SELECT *, row_number() OVER (PARTITION BY comparison, gene_id ORDER BY CASE WHEN strand='+' THEN coordinate ELSE -coordinate END DESC, pac_id) AS rn FROM fitted) SELECT comparison, gene_id, pac_id, delta FROM r WHERE rn=1""")
def t5_distal_pacs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("comparison", "gene_id").orderBy(sequences.oriented(F.col("coordinate"), F.col("strand")).desc(), "pac_id")
    return fitted(spark, sf_dir).withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("comparison", "gene_id", "pac_id", "delta")


@query(f"{FULL}, {_FIT} SELECT pac_id, CAST(count(DISTINCT comparison) AS BIGINT) AS n, round(min(delta),9) AS lowest FROM fitted GROUP BY 1 HAVING count(DISTINCT comparison)=2")
def u2_in_all_comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(spark, sf_dir).groupBy("pac_id").agg(F.count_distinct("comparison").alias("n"), _r(F.min("delta"), "lowest")).filter("n = 2")


# ---- clustering (no SQL form; tests hold it against a plain version) --------------------------


@query()
def a25_greedy_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.greedy_clusters(v.observed(spark, sf_dir), 4, 8)


@query()
def a26_kernel_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.kernel_peaks(v.observed(spark, sf_dir), [1.0, 2.0, 3.0, 2.0, 1.0], 0, 3, 12)
