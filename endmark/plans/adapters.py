"""Evidence-shaped views over the star-schema tables, so that every operator runs on data of any scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(8).select(
        F.concat(F.lit("S"), i).alias("sample_id"), F.when(i < 2, "C0").when(i < 4, "C1").when(i < 6, "C2").otherwise("C3").alias("condition"),
        F.when(i < 6, "C0").otherwise("C1").alias("control_condition"))


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read-end evidence: (sample_id, contig, strand, coordinate) with count and poly_a_clip_count."""
    quantity = F.col("l_quantity").cast("long")
    return load(spark, sf_dir, "lineitem").groupBy(
        F.concat(F.lit("S"), F.col("l_suppkey") % 8).alias("sample_id"), F.concat(F.lit("ctg"), "l_returnflag").alias("contig"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        ((F.col("l_orderkey") % 500) * 200 + F.col("l_linenumber") * 3).cast("long").alias("coordinate"),
    ).agg(F.sum(quantity).cast("long").alias("count"), F.sum(F.least(F.round(F.col("l_discount") * 100).cast("long"), quantity)).cast("long").alias("poly_a_clip_count"))


def atlas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sites per 200-nt locus, genes of 1000 nt."""
    at = F.explode(F.array(*[(F.expr("coordinate div 200") * 200 + 9 * k).cast("long") for k in (0, 2)]))
    sites = observed(spark, sf_dir).select("contig", "strand", at.alias("coordinate")).distinct()
    side = F.when(F.col("strand") == "+", "p").otherwise("m")
    return sites.select(
        F.concat_ws(".", F.lit("PACv1.tpch"), "contig", "strand", "coordinate").alias("pac_id"), F.col("contig").alias("chrom"), "strand", "coordinate",
        F.concat(F.lit("G"), F.expr("coordinate div 1000"), side, "contig").alias("gene_id"))


def site_counts(spark: SparkSession, sf_dir: str, radius: int = 9) -> DataFrame:
    """Reads of each sample assigned to the nearest site within radius: (pac_id, gene_id, sample_id, count)."""
    from ..operators.joins import nearest_within

    sites = atlas(spark, sf_dir).select("pac_id", "gene_id", F.col("chrom").alias("contig"), "strand", F.col("coordinate").alias("site"))
    near = nearest_within(observed(spark, sf_dir), sites, ["contig", "strand"], ["sample_id", "contig", "strand", "coordinate"], "coordinate", "site", radius)
    return near.filter("pac_id is not null").groupBy("pac_id", "gene_id", "sample_id").agg(F.sum("count").alias("count"))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return load(spark, sf_dir, "documents").select("doc_id", F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTAACGTAAACGTAAACGTTACGA").alias("seq"))


def site_windows(sites: DataFrame, docs: DataFrame, size: int = 60) -> DataFrame:
    """sites (with coordinate) and window: size letters of a document (doc_id, seq); coordinates are dealt over all ids and all places of the whole text."""
    top = docs.agg((F.max("doc_id") + 1).alias("ids"))  # one row
    at = sites.crossJoin(top).withColumn("doc_id", (F.col("coordinate") * 7919) % F.col("ids")).join(docs, "doc_id")
    first = (F.col("coordinate") * 31) % F.greatest(F.char_length("seq") - size + 1, F.lit(1)) + 1
    return at.withColumn("window", F.substr("seq", first.cast("int"), F.lit(size))).drop("ids", "doc_id", "seq")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.col("o_orderkey") * 20).cast("long")
    return load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("grp"), start.alias("start"), (start + 1 + F.floor("o_totalprice") % 90).alias("end"))


# The same views for DuckDB.
SAMPLES = """samples_v AS (SELECT 'S'||i AS sample_id, CASE WHEN i<2 THEN 'C0' WHEN i<4 THEN 'C1' WHEN i<6 THEN 'C2' ELSE 'C3' END AS condition,
 CASE WHEN i<6 THEN 'C0' ELSE 'C1' END AS control_condition FROM range(8) t(i))"""
OBS = """obs AS (SELECT 'S'||(l_suppkey%8) AS sample_id, 'ctg'||l_returnflag AS contig, CASE WHEN l_linestatus='O' THEN '+' ELSE '-' END AS strand,
 CAST((l_orderkey%500)*200+l_linenumber*3 AS BIGINT) AS coordinate, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS "count",
 CAST(SUM(LEAST(CAST(round(l_discount*100) AS BIGINT),CAST(l_quantity AS BIGINT))) AS BIGINT) AS poly_a_clip_count FROM lineitem GROUP BY 1,2,3,4)"""
ATLAS = """atlas_v AS (SELECT 'PACv1.tpch.'||contig||'.'||strand||'.'||coordinate AS pac_id, contig AS chrom, strand, coordinate,
 'G'||(coordinate//1000)||CASE WHEN strand='+' THEN 'p' ELSE 'm' END||contig AS gene_id
 FROM (SELECT DISTINCT contig, strand, CAST((coordinate//200)*200+l*9 AS BIGINT) AS coordinate FROM obs, (VALUES (0),(2)) v(l)))"""
COUNTS = """near AS (SELECT o.*, a.pac_id, a.gene_id, row_number() OVER (PARTITION BY o.sample_id, o.contig, o.strand, o.coordinate ORDER BY abs(o.coordinate-a.coordinate), a.coordinate) rn
 FROM obs o JOIN atlas_v a ON a.chrom=o.contig AND a.strand=o.strand AND abs(o.coordinate-a.coordinate)<=9),
counts AS (SELECT pac_id, gene_id, sample_id, CAST(SUM("count") AS BIGINT) AS "count" FROM near WHERE rn=1 GROUP BY 1,2,3)"""
SEQS = """seqs AS (SELECT doc_id, translate(regexp_replace(lower(text),'[^a-z]','','g'),'abcdefghijklmnopqrstuvwxyz','ACGTAACGTAAACGTAAACGTTACGA') AS seq FROM documents)"""
INTERVALS = """ivals AS (SELECT o_orderkey AS id, o_orderstatus AS grp, CAST(o_orderkey*20 AS BIGINT) AS start, o_orderkey*20+1+CAST(floor(o_totalprice) AS BIGINT)%90 AS "end" FROM orders)"""
BASE = f"WITH {SAMPLES}, {OBS}, {ATLAS}"
FULL = f"{BASE}, {COUNTS}"
