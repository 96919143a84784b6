"""Further queries: validation, updates, summaries, figure tables and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import labels, sequences
from .operators import aggregates, checks, joins, models
from .plans import adapters as v
from .plans.adapters import BASE, FULL, SEQS
from .queries import _EVENT, _FIT, _called, _r, fitted, query


@query("""WITH s AS (SELECT 'c'||(c_custkey%1400) AS sample_id, 'n'||c_nationkey AS condition, CASE WHEN c_nationkey<20 THEN 'n'||(c_nationkey%7) ELSE 'n'||(c_nationkey+c_custkey%3) END AS control_condition FROM customer),
i AS (SELECT sample_id, count(*) AS n FROM s GROUP BY 1), c AS (SELECT condition, count(*) AS n, count(DISTINCT control_condition) AS k FROM s GROUP BY 1)
SELECT 'duplicate_sample' AS problem, sample_id AS item FROM i WHERE n>1 UNION ALL SELECT DISTINCT 'own_control', condition FROM s WHERE condition=control_condition UNION ALL SELECT 'several_controls', condition FROM c WHERE k>1 UNION ALL SELECT 'few_replicates', condition FROM c WHERE n<60
UNION ALL SELECT DISTINCT 'unknown_control', control_condition FROM s WHERE control_condition NOT IN (SELECT condition FROM s)""")
def v3_v4_v5_v7_sample_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, c = F.col("c_nationkey"), F.col("c_custkey")
    control = F.concat(F.lit("n"), F.when(n < 20, n % 7).otherwise(n + c % 3))
    s = v.load(spark, sf_dir, "customer").select(F.concat(F.lit("c"), c % 1400).alias("sample_id"), F.concat(F.lit("n"), n).alias("condition"), control.alias("control_condition"))
    return checks.sample_sheet(s, 60)


@query("""WITH s AS (SELECT DISTINCT 'n'||n_nationkey AS condition, CASE WHEN n_nationkey%3=0 THEN 'n'||n_nationkey ELSE 'n'||(n_nationkey-n_nationkey%3) END AS control_condition FROM nation)
SELECT condition, CASE WHEN control_condition<>condition AND condition IN (SELECT control_condition FROM s t WHERE t.condition<>t.control_condition) THEN 'treatment_and_control' WHEN control_condition<>condition THEN 'treatment' ELSE 'control' END AS role FROM s""")
def v9_control_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return checks.control_roles(v.load(spark, sf_dir, "nation").select(F.concat(F.lit("n"), n).alias("condition"), F.concat(F.lit("n"), n - n % 3).alias("control_condition")))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS child, CASE WHEN p_partkey%50=7 THEN p_partkey ELSE p_partkey//2 END AS parent FROM part), r(start, pos, depth) AS (SELECT child, parent, 1 FROM e UNION ALL SELECT start, e.parent, depth+1 FROM r JOIN e ON e.child=r.pos WHERE depth<40)
SELECT DISTINCT start AS node FROM r WHERE depth=40""")
def v6_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    return checks.cyclic(v.load(spark, sf_dir, "part").select(p.alias("child"), F.when(p % 50 == 7, p).otherwise(F.expr("p_partkey div 2")).alias("parent")), "child", "parent")


@query("""SELECT 'ctg'||s_nationkey AS contig, CASE WHEN n_nationkey IS NULL THEN 'missing' ELSE 'length' END AS problem FROM (SELECT s_suppkey%40 AS s_nationkey, count(*) AS length FROM supplier GROUP BY 1) s
LEFT JOIN (SELECT n_nationkey, 2+n_regionkey AS l FROM nation) n ON n_nationkey=s_nationkey WHERE n_nationkey IS NULL OR length<>l""")
def v1_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = v.load(spark, sf_dir, "supplier").groupBy(F.concat(F.lit("ctg"), F.col("s_suppkey") % 40).alias("contig")).agg(F.count("*").alias("length"))
    return checks.contigs(a, v.load(spark, sf_dir, "nation").select(F.concat(F.lit("ctg"), "n_nationkey").alias("contig"), (F.col("n_regionkey") + 2).alias("length")))


@query("SELECT o_custkey AS gene, count(DISTINCT o_orderpriority) AS names FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority)>1")
def v11_several_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.several_names(v.load(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "gene"), "gene", "o_orderpriority")


@query(f"""{FULL}, u AS (SELECT gene_id, pac_id, sample_id, "count", sum("count") OVER w AS t, "count"/nullif(sum("count") OVER w,0) AS pau FROM counts WINDOW w AS (PARTITION BY gene_id, sample_id)), x AS (SELECT a.coordinate, u.* FROM u JOIN atlas_v a ON a.pac_id=u.pac_id)
SELECT gene_id, sample_id FROM x GROUP BY 1,2 HAVING sum("count")<>max(t+CASE WHEN coordinate%1400=0 THEN 3 ELSE 0 END) OR (max(t+CASE WHEN coordinate%1400=0 THEN 3 ELSE 0 END)>0 AND abs(sum(pau*CASE WHEN coordinate%2200=0 THEN 1.01 ELSE 1 END)-1)>1e-8+1e-5)""")
def v10_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and shares are spoiled at some sites."""
    d = aggregates.usage(v.site_counts(spark, sf_dir)).join(v.atlas(spark, sf_dir).select("pac_id", "coordinate"), "pac_id")
    d = d.withColumn("gene_total", F.col("gene_total") + F.when(F.col("coordinate") % 1400 == 0, 3).otherwise(0)).withColumn("pau", F.col("pau") * F.when(F.col("coordinate") % 2200 == 0, 1.01).otherwise(1.0))
    return checks.broken_totals(d)


@query(f"{FULL}, u AS (SELECT pac_id, sample_id, \"count\"/sum(\"count\") OVER (PARTITION BY gene_id, sample_id) AS pau FROM counts) SELECT a.strand, u.sample_id, count(*) AS n, round(avg(pau),9) AS mean_pau FROM u JOIN atlas_v a ON a.pac_id=u.pac_id GROUP BY 1,2")
def j1_usage_by_strand(spark: SparkSession, sf_dir: str) -> DataFrame:
    pau = aggregates.usage(v.site_counts(spark, sf_dir))
    return pau.join(v.atlas(spark, sf_dir).select("pac_id", "strand"), "pac_id").groupBy("strand", "sample_id").agg(F.count("*").alias("n"), _r(F.avg("pau"), "mean_pau"))


@query(f"""{FULL}, {_FIT}, base AS (SELECT pac_id, comparison, delta FROM fitted), new AS (SELECT pac_id, comparison, CASE WHEN coordinate%5=0 THEN NULL ELSE delta*2 END AS delta FROM fitted WHERE coordinate%3=0)
SELECT b.pac_id, b.comparison, round(CASE WHEN n.pac_id IS NOT NULL THEN n.delta ELSE b.delta END,9) AS delta FROM base b LEFT JOIN new n ON n.pac_id=b.pac_id AND n.comparison=b.comparison""")
def j16_keyed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fitted(spark, sf_dir)
    new = d.filter("coordinate % 3 = 0").select("pac_id", "comparison", F.when(F.col("coordinate") % 5 != 0, F.col("delta") * 2).alias("delta"))
    out = joins.updated(d.select("pac_id", "comparison", "delta"), new, ["pac_id", "comparison"], ["delta"])
    return out.withColumn("delta", F.round("delta", 9))


@query("""WITH c AS (SELECT n_name AS stem, n_regionkey AS control, 'n'||n_nationkey AS treatment FROM nation) SELECT a.stem AS a, b.stem AS b, CASE WHEN a.control=b.control THEN 'shared_control' ELSE 'unrelated' END AS relation FROM c a JOIN c b ON a.stem<b.stem""")
def j18_comparison_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = v.load(spark, sf_dir, "nation").select(F.col("n_name").alias("stem"), F.col("n_regionkey").cast("string").alias("control"), F.concat(F.lit("n"), "n_nationkey").alias("treatment"))
    return joins.comparison_pairs(c).select("a", "b", "relation")


@query("""WITH al AS (SELECT n_nationkey AS alias, n_regionkey AS target FROM nation WHERE n_nationkey<15) SELECT coalesce('r'||target, 'n'||c_nationkey) AS contig, count(*) AS n, round(sum(c_acctbal),2) AS total FROM customer LEFT JOIN al ON alias=c_nationkey GROUP BY 1""")
def j19_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    al = v.load(spark, sf_dir, "nation").filter("n_nationkey < 15").select(F.concat(F.lit("n"), "n_nationkey").alias("alias"), F.concat(F.lit("r"), "n_regionkey").alias("target"))
    d = joins.renamed_contigs(v.load(spark, sf_dir, "customer").withColumn("contig", F.concat(F.lit("n"), "c_nationkey")), al)
    return d.groupBy("contig").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query(f"""{BASE}, iv AS (SELECT contig, strand, coordinate//200 AS id, min(coordinate) AS start, max(coordinate) AS "end", sum("count") AS n, sample_id FROM obs GROUP BY 1,2,3,7)
SELECT a.pac_id, count(*) AS blocks, CAST(sum(iv.n) AS BIGINT) AS reads FROM atlas_v a JOIN iv ON iv.contig=a.chrom AND iv.strand=a.strand AND iv.start<=a.coordinate+4 AND iv."end">=a.coordinate-4 GROUP BY 1""")
def j13_stabbing(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = v.observed(spark, sf_dir).groupBy("contig", "strand", F.expr("coordinate div 200").alias("id"), "sample_id").agg(F.min("coordinate").alias("start"), F.max("coordinate").alias("end"), F.sum("count").alias("n"))
    slack = blocks.withColumn("start", F.col("start") - 4).withColumn("end", F.col("end") + 4)
    sites = v.atlas(spark, sf_dir).withColumnRenamed("chrom", "contig")
    out = joins.contained(sites, slack, ["contig", "strand"], "coordinate", width=256)
    return out.groupBy("pac_id").agg(F.count("*").alias("blocks"), F.sum("n").alias("reads"))


@query("""WITH tx AS (SELECT o_custkey AS gene_id, o_orderkey AS tx, CASE WHEN o_custkey%2=0 THEN '+' ELSE '-' END AS strand, min((l_partkey%50)*40) AS start, max((l_partkey%50)*40+10+l_suppkey%60) AS "end"
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey GROUP BY 1, 2, 3),
e AS (SELECT gene_id, CASE WHEN strand='+' THEN "end" ELSE start END AS site FROM tx) SELECT gene_id, max(site) AS end_site FROM e GROUP BY 1 HAVING count(DISTINCT site)=1""")
def a4_single_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as genes, their orders as transcripts and line items as exons."""
    lines = v.load(spark, sf_dir, "lineitem").join(v.load(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    start = F.col("l_partkey") % 50 * 40
    return aggregates.single_ends(lines.select(
        F.col("o_custkey").alias("gene_id"), F.col("o_orderkey").alias("transcript_id"), F.when(F.col("o_custkey") % 2 == 0, "+").otherwise("-").alias("strand"), start.alias("start"), (start + 10 + F.col("l_suppkey") % 60).alias("end")))


@query(f"""{FULL}, x AS (SELECT pac_id, gene_id, s.condition, sum(coalesce(c."count",0)) AS n FROM (SELECT a.pac_id, a.gene_id, s.sample_id, c."count" FROM atlas_v a CROSS JOIN samples_v s LEFT JOIN counts c ON c.pac_id=a.pac_id AND c.sample_id=s.sample_id) c JOIN samples_v s ON s.sample_id=c.sample_id GROUP BY 1,2,3) SELECT DISTINCT gene_id FROM x WHERE n=0""")
def a34_m5_boundary_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.boundary_genes(_family(spark, sf_dir))


def _family(spark: SparkSession, sf_dir: str) -> DataFrame:
    pacs = v.atlas(spark, sf_dir).select("pac_id", "gene_id")
    return aggregates.complete(v.site_counts(spark, sf_dir), pacs, v.samples(spark), ["pac_id", "gene_id"]).join(F.broadcast(v.samples(spark).select("sample_id", "condition")), "sample_id")  # 8 rows


@query(f"""{FULL}, s AS (SELECT c.gene_id, s.condition, sum("count") AS n FROM counts c JOIN samples_v s ON s.sample_id=c.sample_id WHERE NOT (s.condition='C2' AND contains(c.gene_id,'7')) GROUP BY 1,2), g AS (SELECT DISTINCT gene_id FROM atlas_v)
SELECT g.gene_id, c.condition FROM g CROSS JOIN (SELECT DISTINCT condition FROM samples_v) c LEFT JOIN s ON s.gene_id=g.gene_id AND s.condition=c.condition WHERE coalesce(n,0)=0""")
def a35_silent_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of some genes are taken out of one condition."""
    lost = (F.col("condition") == "C2") & F.contains("gene_id", F.lit("7"))
    return aggregates.silent_groups(_family(spark, sf_dir).withColumn("count", F.when(lost, 0).otherwise(F.col("count"))))


@query(f"""{FULL}, {_FIT}, d AS (SELECT comparison, gene_id, arg_min(pac_id, (-c_fit, coordinate)) AS control_dominant, arg_min(pac_id, (-t_fit, coordinate)) AS treatment_dominant, count(*) FILTER (c_fit>=0.05) AS control_active, count(*) FILTER (t_fit>=0.05) AS treatment_active FROM fitted GROUP BY 1,2)
SELECT comparison, gene_id, control_dominant, treatment_dominant, CAST(treatment_active-control_active AS BIGINT) AS active_change, control_dominant<>treatment_dominant AS dominant_switch FROM d""")
def a38_a39_dominant_pacs(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = lambda fit: F.min_by("pac_id", F.struct(-F.col(fit), F.col("coordinate")))
    d = fitted(spark, sf_dir).groupBy("comparison", "gene_id").agg(first("c_fit").alias("control_dominant"), first("t_fit").alias("treatment_dominant"), F.count_if(F.col("c_fit") >= 0.05).alias("ca"), F.count_if(F.col("t_fit") >= 0.05).alias("ta"))
    return d.select("comparison", "gene_id", "control_dominant", "treatment_dominant", (F.col("ta") - F.col("ca")).alias("active_change"), (F.col("control_dominant") != F.col("treatment_dominant")).alias("dominant_switch"))


@query(f"""{FULL}, {_FIT}, b AS (SELECT comparison, least(10, greatest(3, ceil(sqrt(count(*))))) AS bins FROM fitted GROUP BY 1)
SELECT comparison, CAST(least(floor(p*bins), bins-1) AS BIGINT) AS bin, count(*) AS n FROM fitted JOIN b USING (comparison) GROUP BY 1, 2""")
def a47_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.unit_histogram(fitted(spark, sf_dir), "p", ["comparison"])


@query(f"""{FULL}, t AS (SELECT gene_id, sum("count") AS n FROM counts GROUP BY 1 ORDER BY n DESC, gene_id LIMIT 8), u AS (SELECT c.gene_id, c.pac_id, s.condition, "count"/sum("count") OVER (PARTITION BY c.gene_id, c.sample_id) AS pau FROM counts c JOIN samples_v s ON s.sample_id=c.sample_id)
SELECT gene_id, pac_id, condition, round(avg(pau),9) AS mean_pau FROM u WHERE gene_id IN (SELECT gene_id FROM t) GROUP BY 1,2,3""")
def a48_t4_top_gene_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = v.site_counts(spark, sf_dir)
    top = counts.groupBy("gene_id").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "gene_id").limit(8).select("gene_id")
    u = aggregates.usage(counts).join(top, "gene_id", "left_semi").join(v.samples(spark), "sample_id")
    return u.groupBy("gene_id", "pac_id", "condition").agg(_r(F.avg("pau"), "mean_pau"))


@query(f"""{FULL}, {_FIT}, x AS (SELECT comparison, pac_id, delta, p, -log10(nullif(p,0)) AS s FROM fitted) SELECT comparison, pac_id, delta, round(coalesce(s, 1.05*greatest(1, max(s) OVER (PARTITION BY comparison))),9) AS score FROM x""")
def t6_volcano(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fitted(spark, sf_dir).withColumn("s", -F.log10(F.nullif("p", F.lit(0.0))))
    top = 1.05 * F.greatest(F.lit(1.0), F.max("s").over(Window.partitionBy("comparison")))
    return d.select("comparison", "pac_id", "delta", _r(F.coalesce("s", top), "score"))


@query(f"""{FULL}, {_FIT}, r AS (SELECT comparison, pac_id, delta, row_number() OVER (PARTITION BY comparison, delta>0 ORDER BY abs(delta) DESC, pac_id) AS rn FROM fitted WHERE delta<>0) SELECT comparison, pac_id, delta FROM r WHERE rn<=20""")
def w6_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("comparison", F.col("delta") > 0).orderBy(F.abs("delta").desc(), "pac_id")
    return fitted(spark, sf_dir).filter("delta <> 0").withColumn("_n", F.row_number().over(w)).filter("_n <= 20").select("comparison", "pac_id", "delta")


@query(f"""{FULL}, {_FIT}, e AS (SELECT *, {_EVENT} AS ev FROM fitted), grid AS (SELECT gene_id, max(CASE WHEN comparison='C1' AND ev<>'none' THEN ev END) AS C1, max(CASE WHEN comparison='C2' AND ev<>'none' THEN ev END) AS C2, min(p) AS best FROM e GROUP BY 1)
SELECT gene_id, C1, C2, CASE WHEN C1 IS NOT NULL THEN 1 ELSE 0 END+CASE WHEN C2 IS NOT NULL THEN 1 ELSE 0 END AS n_called, round(best,9) AS best FROM grid WHERE C1 IS NOT NULL OR C2 IS NOT NULL ORDER BY n_called DESC, best, gene_id LIMIT 50""")
def t7_u5_pattern_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _called(spark, sf_dir)
    grid = d.groupBy("gene_id").pivot("comparison", ["C1", "C2"]).agg(F.max(F.when(F.col("event_type") != "none", F.col("event_type"))))
    best = d.groupBy("gene_id").agg(F.min("p").alias("best"))
    out = grid.filter("C1 is not null or C2 is not null").join(best, "gene_id").withColumn("n_called", F.col("C1").isNotNull().cast("int") + F.col("C2").isNotNull().cast("int"))
    return out.orderBy(F.desc("n_called"), "best", "gene_id").limit(50).select("gene_id", "C1", "C2", "n_called", _r(F.col("best"), "best"))


@query(f"{FULL}, {_FIT} SELECT comparison, pac_id, least(c_total, t_total) AS depth, delta FROM fitted WHERE least(c_total, t_total)>0 AND delta IS NOT NULL")
def t8_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(spark, sf_dir).select("comparison", "pac_id", F.least("c_total", "t_total").alias("depth"), "delta").filter("depth > 0 and delta is not null")


@query(f"""{BASE} SELECT DISTINCT s.condition AS treatment, s.control_condition AS control
FROM samples_v s WHERE s.condition<>s.control_condition AND s.sample_id IN (SELECT sample_id FROM obs)""")
def t9_comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparisons of samples that have evidence."""
    sheet = v.samples(spark).join(v.observed(spark, sf_dir).select("sample_id").distinct(), "sample_id", "left_semi")
    return sheet.filter("condition <> control_condition").select(F.col("condition").alias("treatment"), F.col("control_condition").alias("control")).distinct()


@query(f"""{FULL} SELECT pac_id, sample_id, CAST(sum("count") AS BIGINT) AS "count" FROM counts GROUP BY 1, 2""")
def u4_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all samples, made wide and long again."""
    names = [f"S{k}" for k in range(8)]
    wide = v.site_counts(spark, sf_dir).groupBy("pac_id").pivot("sample_id", names).agg(F.sum("count"))
    return wide.unpivot("pac_id", names, "sample_id", "count").filter("count is not null")


@query(f"{FULL}, {_FIT} SELECT pac_id FROM fitted WHERE comparison='C1' AND delta>0.05 EXCEPT SELECT pac_id FROM fitted WHERE comparison='C2' AND delta>0.05")
def u2_u3_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = fitted(spark, sf_dir).filter("delta > 0.05")
    return up.filter("comparison = 'C1'").select("pac_id").distinct().subtract(up.filter("comparison = 'C2'").select("pac_id"))


@query(f"{BASE} SELECT chrom||chr(9)||coordinate||chr(9)||(coordinate+1)||chr(9)||pac_id||chr(9)||least(coordinate,1000)||chr(9)||strand AS value FROM atlas_v")
def k5_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.sinks import bed6

    return bed6(v.atlas(spark, sf_dir).withColumn("total", F.col("coordinate")))


@query(f"{BASE} SELECT strand, contig||chr(9)||coordinate||chr(9)||(coordinate+1)||chr(9)||CAST(sum(\"count\") AS BIGINT) AS value FROM obs GROUP BY strand, contig, coordinate")
def k4_bedgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.sinks import bedgraph

    return bedgraph(v.observed(spark, sf_dir))


@query(f"""{FULL}, {_FIT}, {SEQS}, ev AS (SELECT comparison, pac_id, gene_id, {_EVENT}<>'none' AS event, coordinate FROM fitted), z AS (SELECT ev.*, substr(s.seq, CAST((ev.coordinate*31)%greatest(length(s.seq)-59,1)+1 AS INT), 60) AS w FROM ev JOIN seqs s ON s.doc_id=(ev.coordinate*7919)%(SELECT max(doc_id)+1 FROM seqs)),
n AS (SELECT *, count(*) FILTER (event) OVER (PARTITION BY comparison, gene_id) AS e, count(*) FILTER (NOT event) OVER (PARTITION BY comparison, gene_id) AS b FROM z), k AS (SELECT *, unnest(list_distinct(list_transform(range(1,length(w)-1), lambda i: substr(w,i,3)))) AS kmer FROM n WHERE e>0 AND b>0 AND length(w)>=3),
t AS (SELECT comparison, kmer, gene_id, e, b, count(*) FILTER (event) AS a, count(*) FILTER (NOT event) AS c FROM k GROUP BY 1,2,3,4,5), q AS (SELECT comparison, kmer, a, e-a AS b, c, b-c AS d, CAST(e+b AS DOUBLE) AS n FROM t WHERE a+c>0 AND (e-a)+(b-c)>0)
SELECT comparison, kmer, count(*) AS strata, CASE WHEN sum(b*c/n)=0 THEN 'inf'::DOUBLE ELSE round(sum(a*d/n)/sum(b*c/n),6) END AS odds_ratio, round(pow(sum(a-(a+b)*(a+c)/n),2)/sum((a+b)*(c+d)*(a+c)*(b+d)/(n*n*(n-1))),6) AS chi_square FROM q GROUP BY 1,2""")
def m18_kmer_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.site_windows(_called(spark, sf_dir), v.sequences(spark, sf_dir))
    out = models.kmer_enrichment(d.select("comparison", "gene_id", "pac_id", (F.col("event_type") != "none").alias("event"), "window"), 3, keys=("comparison",))
    return out.select("comparison", "kmer", "strata", F.round("odds_ratio", 6).alias("odds_ratio"), F.round("chi_square", 6).alias("chi_square"))


@query()
def m2_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.moderated_precision(_family(spark, sf_dir))


@query()
def m3_proportion_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.fit_genes(_family(spark, sf_dir).withColumn("precision", F.lit(40.0)), "C0")


@query()
def m19_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, scores, shares = models.usage_pca(aggregates.usage(v.site_counts(spark, sf_dir)), 8, 10)
    return spark.createDataFrame([(s, k + 1, float(scores[j, k]), float(shares[k])) for j, s in enumerate(names) for k in range(scores.shape[1])], "sample_id string, component int, score double, variance_share double")


@query(f"""{FULL}, m AS (SELECT pac_id, 'M'||(coordinate%7) AS motif, coordinate%11=0 AS rescued FROM atlas_v), tot AS (SELECT gene_id, sample_id, sum("count") AS t FROM counts GROUP BY 1,2), cov AS (SELECT gene_id FROM tot GROUP BY 1 HAVING min(t)>=200),
d AS (SELECT c.gene_id, c.pac_id, c.sample_id, c."count", motif FROM counts c JOIN m ON m.pac_id=c.pac_id WHERE NOT rescued AND c.gene_id IN (SELECT gene_id FROM cov)),
w AS (SELECT *, sum("count") OVER (PARTITION BY gene_id, sample_id) AS t FROM d), n AS (SELECT gene_id, sample_id, count(DISTINCT pac_id) AS n FROM d GROUP BY 1,2),
p AS (SELECT w.sample_id, w.gene_id, motif, sum("count"/t) AS share FROM w JOIN n ON n.gene_id=w.gene_id AND n.sample_id=w.sample_id WHERE t>0 AND n>=2 GROUP BY 1,2,3) SELECT sample_id, motif, round(asin(sqrt(avg(share))),9) AS score, count(*) AS genes FROM p GROUP BY 1,2""")
def a9_w3_f9_motif_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.annotation import motif_usage

    c = F.col("coordinate")
    motifs = v.atlas(spark, sf_dir).select("pac_id", F.concat(F.lit("M"), c % 7).alias("motif"), (c % 11 == 0).alias("rescued"))
    return motif_usage(aggregates.usage(v.site_counts(spark, sf_dir)), motifs, 200).withColumn("score", F.round("score", 9))


@query(f"""{BASE} SELECT 'PACv1.x.'||chrom||'.'||strand||'.'||coordinate AS pac_id, chrom||':'||coordinate||':'||strand AS locus, chrom||':'||coordinate||'-'||(coordinate+1) AS browser_interval,
 CASE WHEN coordinate%13=0 OR coordinate%7=0 THEN 'low' WHEN coordinate%5=0 THEN 'moderate' WHEN coordinate%2=0 AND coordinate%9>=2 THEN 'high' ELSE 'moderate' END AS confidence FROM atlas_v""")
def p15_p16_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.annotation import confidence, labels

    c = F.col("coordinate")
    d = labels(v.atlas(spark, sf_dir).withColumnRenamed("chrom", "contig"), "x")
    return d.select("pac_id", "locus", "browser_interval", confidence(c % 13 == 0, c % 7 == 0, c % 5 == 0, c % 2 == 0, c % 9).alias("confidence"))


@query(f"""WITH {SEQS} SELECT doc_id, coalesce(list_max(list_transform(regexp_extract_all(w,'A+'), lambda x: length(x))),0)>8 OR (length(w)>0 AND (length(w)-length(replace(w,'A','')))/length(w)>0.5) AS primed FROM (SELECT doc_id, seq AS w FROM seqs)""")
def p17_priming(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.annotation import priming

    return v.sequences(spark, sf_dir).select("doc_id", priming(F.col("seq"), 8, 0.5).alias("primed"))


@query("""SELECT o_custkey AS gene_id, coalesce(arg_min(nm, o_orderkey) FILTER (g AND nm IS NOT NULL), arg_min(nm, o_orderkey) FILTER (nm IS NOT NULL), CAST(o_custkey AS VARCHAR)) AS gene_name FROM (SELECT *, o_orderstatus='F' AS g, CASE WHEN o_orderkey%3=0 THEN NULL ELSE o_orderpriority END AS nm FROM orders) GROUP BY o_custkey""")
def a5_gene_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.annotation import gene_names

    key = F.col("o_orderkey")
    d = v.load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("gene_id"), F.when(F.col("o_orderstatus") == "F", "gene").otherwise("exon").alias("type"), F.when(key % 3 != 0, F.col("o_orderpriority")).alias("gene_name"), key.alias("line_no"))
    return gene_names(d).select("gene_id", F.col("gene_name").cast("string").alias("gene_name"))


@query(f"""WITH e AS (SELECT o_custkey AS gene_id, o_orderkey AS tx, CASE WHEN o_custkey%2=0 THEN '+' ELSE '-' END AS strand, CAST(l_linenumber*100000+l_partkey*10+l_suppkey%10 AS BIGINT) AS line_no, (l_partkey%50)*40 AS start, (l_partkey%50)*40+10+l_suppkey%60 AS "end" FROM lineitem JOIN orders ON l_orderkey=o_orderkey),
d AS (SELECT *, row_number() OVER (PARTITION BY gene_id, tx ORDER BY CASE WHEN strand='+' THEN "end" ELSE -start END DESC, line_no)=1 AS last, count(*) OVER (PARTITION BY gene_id, tx) AS n FROM e), s AS (SELECT *, max(n) OVER (PARTITION BY gene_id)>1 AS spliced FROM d)
SELECT gene_id, tx AS transcript_id, start, "end" FROM s WHERE last AND NOT (n=1 AND spliced AND NOT EXISTS (SELECT 1 FROM s m WHERE m.n>1 AND m.gene_id=s.gene_id AND s.start<m."end" AND m.start<s."end")) AND NOT EXISTS (SELECT 1 FROM s i WHERE NOT i.last AND i.gene_id=s.gene_id AND i.tx<>s.tx AND s.start<i."end" AND i.start<s."end")""")
def a29_terminal_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.annotation import terminal_exons

    lines = v.load(spark, sf_dir, "lineitem").join(v.load(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    start = (F.col("l_partkey") % 50) * 40
    e = lines.select(F.col("o_custkey").alias("gene_id"), F.col("o_orderkey").alias("transcript_id"), F.lit("c").alias("contig"), F.when(F.col("o_custkey") % 2 == 0, "+").otherwise("-").alias("strand"), start.alias("start"), (start + 10 + F.col("l_suppkey") % 60).alias("end"), (F.col("l_linenumber") * 100000 + F.col("l_partkey") * 10 + F.col("l_suppkey") % 10).cast("long").alias("line_no"))
    return terminal_exons(e).select("gene_id", "transcript_id", "start", "end")


@query(f"""{FULL}, {_FIT} SELECT comparison, round(median(delta),9) AS median_delta, round(quantile_cont(delta,0.25),9) AS q25 FROM fitted GROUP BY 1""")
def f12_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    delta = F.col("delta")
    return fitted(spark, sf_dir).groupBy("comparison").agg(_r(labels.median_finite(delta), "median_delta"), _r(F.percentile(labels.finite(delta), 0.25), "q25"))


@query(f"""{FULL}, x AS (SELECT c.pac_id, c.gene_id, s.condition, count(*) FILTER ("count">0) AS supporting, CAST(sum("count") AS BIGINT) AS reads, string_agg("count"::VARCHAR, ',' ORDER BY c.sample_id) AS raw FROM counts c JOIN samples_v s ON s.sample_id=c.sample_id GROUP BY 1,2,3) SELECT pac_id, condition, supporting, reads, CAST(sum(reads) OVER (PARTITION BY gene_id, condition) AS BIGINT) AS gene_total, raw FROM x""")
def a37_w4_group_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = v.site_counts(spark, sf_dir).join(v.samples(spark), "sample_id").groupBy("pac_id", "gene_id", "condition")
    raw = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sample_id", "count"))), lambda x: x["count"].cast("string")), ",")  # a condition's samples are few
    g = d.agg(F.count_if(F.col("count") > 0).alias("supporting"), F.sum("count").alias("reads"), raw.alias("raw"))
    return g.select("pac_id", "condition", "supporting", "reads", F.sum("reads").over(Window.partitionBy("gene_id", "condition")).alias("gene_total"), "raw")


@query(f"""{FULL}, {_FIT}, e AS (SELECT *, {_EVENT} AS ev, CASE WHEN coordinate%3=0 THEN 'intron' ELSE 'last_exon' END AS region FROM fitted) SELECT r.region AS region, v.ev AS event_type, coalesce(n,0) AS n FROM (VALUES ('intron'),('last_exon'),('internal_exon')) r(region) CROSS JOIN (VALUES ('gained'),('lost'),('increased_usage'),('decreased_usage')) v(ev)
LEFT JOIN (SELECT region, ev, count(*) AS n FROM e GROUP BY 1,2) c ON c.region=r.region AND c.ev=v.ev""")
def a44_counts_with_zero_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _called(spark, sf_dir).withColumn("region", F.when(F.col("coordinate") % 3 == 0, "intron").otherwise("last_exon"))
    levels = [(r, e) for r in ("intron", "last_exon", "internal_exon") for e in ("gained", "lost", "increased_usage", "decreased_usage")]
    grid = spark.createDataFrame(levels, "region string, event_type string")
    return aggregates.with_zero_rows(d, grid)


@query(f"""{FULL}, {_FIT} SELECT pac_id, comparison, row_number() OVER (PARTITION BY comparison ORDER BY gene_id, coordinate, pac_id) AS place FROM fitted""")
def t1_t2_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("comparison").orderBy("gene_id", "coordinate", "pac_id")
    return fitted(spark, sf_dir).select("pac_id", "comparison", F.row_number().over(w).cast("long").alias("place"))


@query("""WITH s AS (SELECT 'c'||c_custkey AS sample_id, CASE c_nationkey%5 WHEN 0 THEN '' WHEN 1 THEN 'SE' WHEN 2 THEN 'PE' WHEN 3 THEN 'auto' ELSE 'se' END AS layout, CASE WHEN c_custkey%9=0 THEN 'reversed' ELSE 'reverse' END AS strandedness, CASE WHEN c_custkey%13=0 THEN '' ELSE c_mktsegment END AS donor FROM customer)
SELECT sample_id, 'layout' AS field, 'invalid' AS problem FROM s WHERE layout='se' UNION ALL SELECT sample_id, 'strandedness', 'invalid' FROM s WHERE strandedness='reversed' UNION ALL SELECT sample_id, 'donor', 'missing' FROM s WHERE donor='' UNION ALL SELECT NULL, 'batch', 'no_column'""")
def v8_sample_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, c = F.col("c_nationkey") % 5, F.col("c_custkey")
    layout = F.when(n == 0, "").when(n == 1, "SE").when(n == 2, "PE").when(n == 3, "auto").otherwise("se")
    s = v.load(spark, sf_dir, "customer").select(F.concat(F.lit("c"), c).alias("sample_id"), layout.alias("layout"), F.when(c % 9 == 0, "reversed").otherwise("reverse").alias("strandedness"), F.when(c % 13 == 0, "").otherwise(F.col("c_mktsegment")).alias("donor"))
    return checks.sample_fields(s, ("donor", "batch"))


@query("""WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) SELECT c_custkey AS sample_id, n<(SELECT avg(n) FROM c) AS exploratory FROM customer JOIN c USING (c_nationkey)""")
def v7_exploratory(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_nationkey").alias("condition"))
    mean = s.groupBy("condition").count().agg(F.avg("count").alias("m")).first()["m"]
    return checks.replicates(s, mean, "warn").select("sample_id", "exploratory")


@query("""WITH i AS (SELECT 'C'||(l_linenumber%3) AS comparison, CASE WHEN l_orderkey%17=0 THEN '' ELSE 'g'||l_orderkey END AS gene_id, 'p'||(l_linenumber//3) AS feature_id, l_discount-0.05 AS lo, 0.04-l_tax AS hi, l_quantity-(CASE WHEN l_partkey%31=0 THEN 0.5 ELSE 0 END) AS n, l_suppkey%20-1 AS p, CASE WHEN l_partkey%7=0 THEN 'none' ELSE 'ok' END AS st FROM lineitem),
b AS (SELECT *, n>=0 AND n=floor(n) AND p>=0 AS whole FROM i)
SELECT comparison, gene_id, feature_id, 'no_key' AS problem FROM b WHERE gene_id='' UNION ALL SELECT comparison, gene_id, feature_id, 'counts' FROM b WHERE NOT whole UNION ALL SELECT comparison, gene_id, feature_id, 'perturbed' FROM b WHERE whole AND p>n
UNION ALL SELECT comparison, gene_id, feature_id, 'status' FROM b WHERE st='none' UNION ALL SELECT comparison, gene_id, feature_id, 'bounds' FROM b WHERE lo>hi UNION ALL SELECT comparison, gene_id, feature_id, 'repeated' FROM b GROUP BY 1,2,3 HAVING count(*)>1""")
def v12_bootstrap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    i = v.load(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("C"), line % 3).alias("comparison"), F.when(F.col("l_orderkey") % 17 == 0, "").otherwise(F.concat(F.lit("g"), "l_orderkey")).alias("gene_id"), F.concat(F.lit("p"), F.expr("l_linenumber div 3")).alias("feature_id"),
        (F.col("l_discount") - 0.05).alias("delta_pau_ci_low"), (0.04 - F.col("l_tax")).alias("delta_pau_ci_high"), (F.col("l_quantity") - F.when(part % 31 == 0, 0.5).otherwise(0)).alias("bootstrap_successes"),
        (F.col("l_suppkey") % 20 - 1).alias("bootstrap_perturbed"), F.when(part % 7 == 0, "none").otherwise("ok").alias("bootstrap_status"))
    return checks.bootstrap_intervals(i)


@query("""WITH d AS (SELECT o_orderkey, o_orderpriority AS stem, CASE o_orderkey%5 WHEN 0 THEN NULL WHEN 1 THEN 'utr_shortening;intronic_gain' WHEN 2 THEN 'intronic_loss_potential_internal_priming;utr_lengthening' WHEN 3 THEN 'other' ELSE 'utr_lengthening_potential_internal_priming' END AS p FROM orders)
SELECT o_orderkey, replace('a_vs_'||stem, '_vs_', ' vs ') AS title, CASE o_orderkey%5 WHEN 1 THEN 'utr_shortening' WHEN 2 THEN 'intronic_loss' WHEN 4 THEN 'utr_lengthening' ELSE 'none' END AS pattern, coalesce(split_part(p,';',1) LIKE '%_potential_internal_priming', false) AS flagged,
format('{:,}', o_orderkey)||CASE WHEN o_orderkey=1 THEN ' read' ELSE ' reads' END AS reads, CASE WHEN abs(o_custkey%50-10)<=abs(o_custkey%50-30) THEN 10 ELSE 30 END AS nearest FROM d JOIN (SELECT o_orderkey, o_custkey FROM orders) USING (o_orderkey)""")
def f14_f15_j20_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    p = F.when(key % 5 == 1, "utr_shortening;intronic_gain").when(key % 5 == 2, "intronic_loss_potential_internal_priming;utr_lengthening").when(key % 5 == 3, "other").when(key % 5 == 4, "utr_lengthening_potential_internal_priming")
    peaks = F.array(F.lit(10), F.lit(30))
    return v.load(spark, sf_dir, "orders").select("o_orderkey", labels.comparison_title(F.concat(F.lit("a_vs_"), "o_orderpriority")).alias("title"), labels.first_pattern(p).alias("pattern"), labels.first_flagged(p).alias("flagged"), labels.plural(key, "read").alias("reads"), labels.nearest_of(F.col("o_custkey") % 50, peaks).cast("int").alias("nearest"))
