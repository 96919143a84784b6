"""The annotated atlas: genes, regions, last exons, ranks, motifs, priming, known sites and confidence of every cluster, in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequences
from ..operators import aggregates, annotation, joins
from ..sources.readers import fetch_windows
from .storage import written


def annotate(clusters: DataFrame, features: DataFrame, chunks: DataFrame, motifs: list[tuple[str, str, int]], known: DataFrame, assembly: str, upstream: int = 50, core: tuple[int, int] = (10, 30), downstream: int = 20,
             known_radius: int = 24, most_downstream: int = 5000, chunk_width: int = 10_000) -> DataFrame:
    """clusters: contig, strand, coordinate, total, samples. features: resolved, with line_no. chunks: the genome in chunks. -> one row a cluster; several genes are joined by commas."""
    sites = written(annotation.labels(clusters, assembly))
    exons = features.filter("type = 'exon'")
    genes = features.filter("type = 'gene'")
    terminal = written(annotation.terminal_exons(exons))
    place = sites.select("pac_id", "contig", "strand", "coordinate")
    assigned = written(annotation.assigned_genes(place, terminal, exons, genes, most_downstream))
    loci = aggregates.merged_intervals(terminal, ["contig", "strand", "gene_id"]).withColumn("locus", F.concat("contig", F.lit(":"), (F.col("start") + 1).cast("string"), F.lit("-"), F.col("end").cast("string")))
    last = annotation.last_exon_locus(assigned.filter("gene_id is not null"), loci).select("pac_id", "last_exon_locus").distinct()
    # a site's genes are the few that tie
    gene = assigned.groupBy("pac_id").agg(F.array_join(F.array_sort(F.collect_set("gene_id")), ",").alias("gene_id"), F.min("region").alias("region"))
    row = place.withColumn("row", F.col("pac_id"))
    plus = F.col("strand") == "+"
    c = F.col("coordinate")
    up = fetch_windows(row, chunks, F.when(plus, c - upstream).otherwise(c), F.when(plus, c).otherwise(c + upstream), chunk_width).select(F.col("row").alias("pac_id"), F.col("window").alias("upstream_window"))
    down = fetch_windows(row, chunks, F.when(plus, c).otherwise(c - downstream), F.when(plus, c + downstream).otherwise(c), chunk_width).select(F.col("row").alias("pac_id"), F.col("window").alias("downstream_window"))
    near = joins.within(place, known.select("contig", "strand", F.col("coordinate").alias("known")), ["contig", "strand"], "coordinate", "known", known_radius).groupBy("pac_id").agg(F.array_sort(F.collect_set("known")).alias("known_sites"))
    d = sites.join(gene, "pac_id", "left").join(last, "pac_id", "left").join(up, "pac_id", "left").join(down, "pac_id", "left").join(near, "pac_id", "left")
    hits = sequences.motif_hits(F.coalesce("upstream_window", F.lit("")), motifs, core, upstream) if motifs else F.array().cast("array<struct<priority:int,outside:int,off:int,distance:int,motif:string,motif_class:string>>")
    d = d.withColumn("motif_hits", hits).withColumn("primary_motif", sequences.primary_motif(F.col("motif_hits"))).withColumn("primary_motif_class", F.get("motif_hits", F.lit(0))["motif_class"])
    d = d.withColumn("internal_priming_flag", annotation.priming(F.coalesce("downstream_window", F.lit(""))))
    ambiguous = F.contains(F.coalesce("gene_id", F.lit("")), F.lit(","))
    d = d.withColumn("confidence", annotation.confidence(ambiguous, F.col("internal_priming_flag"), F.lit(False), F.col("known_sites").isNotNull(), F.col("samples")))
    w = Window.partitionBy("gene_id", "strand")
    one = (F.coalesce("gene_id", F.lit("")) != "") & ~ambiguous
    rank = F.row_number().over(w.orderBy(sequences.oriented(c, F.col("strand")), "pac_id"))
    return d.withColumn("site_rank", F.when(one, rank)).withColumn("n_sites", F.when(one, F.count("*").over(w)))
