"""Gene model joins and what a site gets from them: terminal exons, gene assignment, last exon, priming, confidence, motif usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import arcsine_sqrt, base_fraction, longest_run, oriented
from .joins import contained, prioritised


def gene_names(features: DataFrame) -> DataFrame:
    """(gene_id, gene_name): the first name on a gene record, else the first elsewhere, else the id. features: gene_id, type, gene_name, line_no."""
    first = lambda c: F.min_by("gene_name", F.when(c & F.col("gene_name").isNotNull(), F.col("line_no")))
    names = features.filter("gene_id is not null").groupBy("gene_id").agg(first(F.col("type") == "gene").alias("a"), first(F.lit(True)).alias("b"))
    return names.select("gene_id", F.coalesce("a", "b", F.col("gene_id").cast("string")).alias("gene_name"))


def terminal_exons(exons: DataFrame) -> DataFrame:
    """Each transcript's last exon, but one that overlaps another transcript's internal exon, or whose transcript has a single exon that lies apart from all exons of the gene's spliced ones.
    exons: gene_id, transcript_id, contig, strand, start, end, line_no; equal 3' ends: the first in the file."""
    three = F.when(F.col("strand") == "+", F.col("end")).otherwise(-F.col("start"))
    w = Window.partitionBy("gene_id", "transcript_id")
    d = exons.withColumn("last", F.row_number().over(w.orderBy(three.desc(), "line_no")) == 1).withColumn("n", F.count("*").over(w))
    d = d.withColumn("spliced", F.max("n").over(Window.partitionBy("gene_id")) > 1)
    many = d.filter("n > 1").select(F.col("gene_id").alias("_g"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    alone = (F.col("n") == 1) & F.col("spliced")
    beside = (F.col("gene_id") == F.col("_g")) & (F.col("start") < F.col("_e")) & (F.col("_s") < F.col("end"))
    final = d.filter(F.col("last") & ~alone).unionByName(d.filter(F.col("last") & alone).join(many, beside, "left_semi"))
    inner = d.filter("not last").select(F.col("gene_id").alias("_g"), F.col("transcript_id").alias("_t"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    inside = (F.col("gene_id") == F.col("_g")) & (F.col("transcript_id") != F.col("_t")) & (F.col("start") < F.col("_e")) & (F.col("_s") < F.col("end"))
    return final.join(inner, inside, "left_anti").drop("last", "n", "spliced")


def assigned_genes(sites: DataFrame, terminal: DataFrame, exons: DataFrame, genes: DataFrame, most_downstream: int = 5000) -> DataFrame:
    """sites (pac_id, contig, strand, coordinate) with gene_id and region: terminal exon, else any exon, else gene (intron), else the nearest gene that ends upstream
    within most_downstream (all that tie), else null. One row per gene."""
    span = lambda df, region: contained(sites, df.select("contig", "strand", "start", "end", "gene_id").distinct(), ["contig", "strand"], "coordinate").select(*sites.columns, "gene_id", F.lit(region).alias("region")).distinct()
    end = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start"))
    reach = genes.withColumn("_end", end).withColumn("_low", F.when(F.col("strand") == "+", end).otherwise(end - most_downstream)).withColumn("_high", F.when(F.col("strand") == "+", end + most_downstream).otherwise(end))
    below = contained(sites, reach.select("contig", "strand", F.col("_low").alias("start"), F.col("_high").alias("end"), "_end", "gene_id"), ["contig", "strand"], "coordinate")
    below = below.withColumn("_d", F.abs(F.col("coordinate") - F.col("_end"))).withColumn("_m", F.min("_d").over(Window.partitionBy("pac_id"))).filter("_d = _m")
    below = below.select(*sites.columns, "gene_id", F.lit("downstream_of_gene").alias("region")).distinct()
    return prioritised(sites, [span(terminal, "last_exon"), span(exons, "internal_exon"), span(genes, "intron"), below], "pac_id")


def last_exon_locus(assigned: DataFrame, loci: DataFrame) -> DataFrame:
    """assigned with last_exon_locus: the merged last-exon interval that holds the site if it is the only one and the gene is, else ''. loci: contig, strand, gene_id, locus, start, end."""
    one = assigned.withColumn("_genes", F.size(F.collect_set("gene_id").over(Window.partitionBy("pac_id")))).filter("_genes = 1")
    hit = contained(one, loci, ["contig", "strand", "gene_id"], "coordinate").groupBy("pac_id").agg(F.count_distinct("locus").alias("n"), F.max("locus").alias("locus"))
    return assigned.join(hit.filter("n = 1").select("pac_id", "locus"), "pac_id", "left").withColumn("last_exon_locus", F.coalesce("locus", F.lit(""))).drop("locus")


def priming(window: Column, most_run: int = 6, most_fraction: float = 0.7) -> Column:
    """Whether the sequence downstream looks like internal priming."""
    return (longest_run(window, "A") > most_run) | (base_fraction(window, "A") > most_fraction)


def confidence(ambiguous: Column, primed: Column, rescued: Column, known: Column, support: Column) -> Column:
    return F.when(ambiguous | primed, "low").when(rescued, "moderate").when(known & (support >= 2), "high").otherwise("moderate")


def labels(sites: DataFrame, assembly: str) -> DataFrame:
    """sites with pac_id, locus and browser interval: the boundary base, or the resolution region where sites have region_start and region_end."""
    c = F.col("coordinate")
    return sites.withColumns({"pac_id": F.concat_ws(".", F.lit("PACv1"), F.lit(assembly), "contig", "strand", c.cast("string")), "locus": F.format_string("%s:%d:%s", "contig", c, "strand"),
                              "browser_interval": F.format_string("%s:%d-%d", "contig", F.col("region_start") if "region_start" in sites.columns else c, F.col("region_end") if "region_end" in sites.columns else c + 1)})


def motif_usage(pau: DataFrame, motifs: DataFrame, least_total: int = 10, level: str = "motif") -> DataFrame:
    """(sample_id, level, score, genes): usage of the retained sites of a gene (pau rows: gene_id, pac_id, sample_id, count, gene_total; motifs: pac_id, motif, rescued) summed by motif, averaged
    over the genes that have the motif, arcsine-square-rooted. The genes are a fixed set: those with enough reads in every sample, rescued sites included. Then these are left out, and a gene counts in a
    sample with reads and two sites or more."""
    w = Window.partitionBy("gene_id", "sample_id")
    d = pau.join(motifs.select("pac_id", level, "rescued"), "pac_id")
    d = d.withColumn("_least", F.min("gene_total").over(Window.partitionBy("gene_id"))).filter((F.col("_least") >= least_total) & ~F.col("rescued"))
    d = d.withColumn("_t", F.sum("count").over(w)).filter("_t > 0").withColumn("_n", F.size(F.collect_set("pac_id").over(w))).filter("_n >= 2")
    per = d.groupBy("sample_id", "gene_id", level).agg(F.sum(F.col("count") / F.col("_t")).alias("share"))
    return per.groupBy("sample_id", level).agg(arcsine_sqrt(F.avg("share")).alias("score"), F.count("*").alias("genes"))


def strandedness(reads: DataFrame, exons: DataFrame, most: int = 100_000, decision: float = 0.8, least: int = 100, seed: int = 1) -> DataFrame:
    """One row (n, forward, reverse, protocol) from reads (read_id, contig, start, end, read_strand) that overlap exons of one gene and strand only. The sample is the reads with
    the least keyed hashes, so it is the same however the reads are stored."""
    from .joins import overlapping

    hit = overlapping(reads, exons.select("contig", "strand", "gene_id", F.col("start").alias("s"), F.col("end").alias("e")).distinct(), ["contig"], ("start", "end"), ("s", "e"))
    one = hit.groupBy("read_id", "read_strand").agg(F.count_distinct("gene_id", "strand").alias("n"), F.min("strand").alias("strand")).filter("n = 1")
    some = one.orderBy(F.xxhash64(F.lit(seed), "read_id"), "read_id").limit(most)
    f = F.avg((F.col("read_strand") == F.col("strand")).cast("double"))
    out = some.agg(F.count("*").alias("n"), f.alias("forward"), (1 - f).alias("reverse"))
    return out.withColumn("protocol", F.when(F.col("n") < least, "undetermined").when(F.col("forward") >= decision, "forward").when(F.col("reverse") >= decision, "reverse").otherwise("unstranded"))


def apa_patterns(rows: DataFrame, least_change: float = 0.1, least_share: float = 0.1, cut: float = 0.05) -> DataFrame:
    """Pattern of alternative polyadenylation of each gene. rows: gene_id, pac_id, strand, coordinate, region, last_exon_locus, control_fit, treatment_fit, gene_fdr, called, up, down
    (confident calls), flagged_up, flagged_down (further ones that hold if a priming flag is lifted).
    -> (gene_id, delta_intronic_share, last_exon_switch, delta_utr_distal_share, pattern); patterns that only flagged calls support follow with a suffix."""
    thr = least_change - 1e-9
    c, t = F.col("control_fit"), F.col("treatment_fit")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    pos = oriented(F.col("coordinate"), F.col("strand"))
    d = rows.withColumn("_pos", pos).withColumn("_locus", F.coalesce("last_exon_locus", F.lit(""))).withColumn("_three", F.col("region").isin("last_exon", "downstream_of_gene")).withColumn("_up_region", F.col("region").isin("intron", "internal_exon"))
    flags = ("up", "down", "all_up", "all_down")
    d = d.withColumn("all_up", F.col("up") | F.col("flagged_up")).withColumn("all_down", F.col("down") | F.col("flagged_down"))
    exon = Window.partitionBy("gene_id", "_locus", "_three")
    d = d.withColumn("_distal", F.struct("_pos", "pac_id") == F.max(F.struct("_pos", "pac_id")).over(exon))
    per = d.filter("_three").groupBy("gene_id", "_locus").agg(
        F.sum(c).alias("c"), F.sum(t).alias("t"), F.count("*").alias("n"), F.max("_pos").alias("far"), F.max(F.when(F.col("_distal"), c)).alias("cd"), F.max(F.when(F.col("_distal"), t)).alias("td"),
        *[F.bool_or(x).alias(x) for x in flags], *[F.bool_or(F.col(x) & ~F.col("_distal")).alias(f"near_{x}") for x in flags], *[F.bool_or(F.col(x) & F.col("_distal")).alias(f"far_{x}") for x in flags])
    per = per.withColumn("delta", F.col("t") - F.col("c"))
    main = F.struct("c", "t", "n", "cd", "td", "delta", *[f"{k}_{x}" for k in ("near", "far") for x in flags])
    exons = per.groupBy("gene_id").agg(
        F.count("*").alias("exons"), F.max("delta").alias("most"), F.min("delta").alias("least"), F.max_by(main, F.struct(F.col("c") + F.col("t"), F.col("far"))).alias("main"),
        *[F.max_by(x, F.struct("delta", "far")).alias(f"top_{x}") for x in ("up", "all_up")], *[F.min_by(x, F.struct("delta", "far")).alias(f"low_{x}") for x in ("down", "all_down")])
    gene = d.groupBy("gene_id").agg(
        F.bool_and(finite(c) & finite(t)).alias("finite"), F.coalesce(F.sum(F.when(F.col("_up_region"), t - c)), F.lit(0.0)).alias("intronic"), F.min("gene_fdr").alias("fdr"), F.bool_or("called").alias("called"),
        *[F.bool_or(F.col(x) & F.col("_up_region")).alias(f"in_{x}") for x in flags])
    g = gene.join(exons, "gene_id", "left")
    m = F.col("main")
    switch = F.when(F.col("exons") >= 2, F.least("most", -F.col("least")))
    whole = (m["n"] >= 2) & (m["c"] >= least_share - 1e-9) & (m["t"] >= least_share - 1e-9)
    utr = F.when(whole, m["td"] / m["t"] - m["cd"] / m["c"])
    g = g.withColumn("_switch", switch).withColumn("_utr", utr)

    def found(prefix: str) -> Column:
        up, down = f"{prefix}up", f"{prefix}down"
        ok = lambda x: F.coalesce(x, F.lit(False))
        shifted = ok(F.abs("intronic") >= thr) | ok(F.col("_switch") >= thr)
        use_up, use_down = ~shifted | ok(m["delta"] < 0), ~shifted | ok(m["delta"] > 0)
        big = ok(F.abs("_utr") >= thr)
        tests = {
            "intronic_gain": ok(F.col("intronic") >= thr) & ok(F.col(f"in_{up}")), "intronic_loss": ok(F.col("intronic") <= -thr) & ok(F.col(f"in_{down}")),
            "alternative_last_exon": ok(F.col("_switch") >= thr) & ok(F.col(f"top_{up}")) & ok(F.col(f"low_{down}")),
            "utr_shortening": big & ok(F.col("_utr") < 0) & ((use_up & ok(m[f"near_{up}"])) | (use_down & ok(m[f"far_{down}"]))),
            "utr_lengthening": big & ok(F.col("_utr") > 0) & ((use_up & ok(m[f"far_{up}"])) | (use_down & ok(m[f"near_{down}"]))),
        }
        return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))

    g = g.withColumn("_sure", found("")).withColumn("_more", F.array_except(found("all_"), F.col("_sure")))
    named = F.array_join(F.concat("_sure", F.transform("_more", lambda x: F.concat(x, F.lit("_potential_internal_priming")))), ";")
    open_ = F.col("finite") & F.coalesce(F.col("fdr") <= cut, F.lit(False)) & F.col("called")
    pattern = F.when(~open_, "none").when(named == "", "unclassified_change").otherwise(named)
    metric = lambda x: F.when(F.col("finite"), x)
    return g.select("gene_id", metric(F.col("intronic")).alias("delta_intronic_share"), metric(F.col("_switch")).alias("last_exon_switch"), metric(F.col("_utr")).alias("delta_utr_distal_share"), pattern.alias("pattern"))


def shift_region_counts(shifts: DataFrame) -> DataFrame:
    """(from_region, to_region, direction, n) for all pairs of regions seen, with zero rows. Regions are a fixed handful."""
    regions = ("last_exon", "internal_exon", "intron", "downstream_of_gene")
    grid = F.explode(F.array(*[F.struct(F.lit(a).alias("from_region"), F.lit(b).alias("to_region"), F.lit(x).alias("direction")) for a in regions for b in regions for x in ("distal", "proximal")]))
    whole = shifts.sparkSession.range(1).select(grid.alias("g")).select("g.*")
    n = shifts.groupBy("from_region", "to_region", "direction").agg(F.count("*").alias("n"))
    return whole.join(n, ["from_region", "to_region", "direction"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
