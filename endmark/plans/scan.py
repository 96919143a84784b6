"""From alignment records to evidence: filters, read ends for every source in one pass, splice edges and counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records, sequences
from ..operators.aggregates import read_end_counts


@dataclass(frozen=True)
class ScanSettings:
    protocol: str = "forward"
    least_mapq: int = 10
    excluded: tuple[str, ...] = ()
    drop_duplicates: bool = True
    sources: tuple[str, ...] = ("read_3p", "polyA_junction")


def judged(alignments: DataFrame, settings: ScanSettings, aliases: DataFrame | None = None) -> DataFrame:
    """alignments with target (the contig's own or alias name) and reason (null if kept); a contig is excluded by either name."""
    d = alignments.withColumn("target", F.col("contig"))
    if aliases is not None:
        al = aliases.select(F.col("alias").alias("_alias"), F.col("target").alias("_target"))
        d = d.join(al, F.col("contig") == F.col("_alias"), "left").withColumn("target", F.coalesce("_target", "contig")).drop("_alias", "_target")
    excluded = list(settings.excluded)
    why = records.filter_reason(F.col("flag"), F.col("mapq"), F.col("contig"), F.col("hits"), settings.least_mapq, excluded, settings.drop_duplicates)
    return d.withColumn("reason", F.when(why.isNull() & F.col("target").isin(excluded), "excluded_contig").when((why == "multimapped") & F.col("target").isin(excluded), "excluded_contig").otherwise(why))


def counters(judged_records: DataFrame) -> DataFrame:
    """(reason, n) with `kept` for those that stay."""
    return judged_records.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def read_ends(judged_records: DataFrame, sample_id: str, settings: ScanSettings) -> DataFrame:
    """A row for each kept single-end record and source; the polyA_junction source has only reads with a poly(A)-like clip."""
    d = judged_records.filter("reason is null")
    d = d.withColumn("strand", records.transcript_strand(F.col("flag"), F.lit(settings.protocol))).withColumn("end", records.reference_end(F.col("start"), F.col("cigar")))
    d = d.withColumn("poly_a_clip", sequences.poly_a_like(records.terminal_clip(F.col("strand"), F.col("cigar"), F.col("sequence")))).withColumn("evidence_source", F.explode(F.array(*map(F.lit, settings.sources))))
    d = d.filter((F.col("evidence_source") != "polyA_junction") | F.col("poly_a_clip"))
    return d.select(F.lit(sample_id).alias("sample_id"), F.col("target").alias("contig"), "strand", records.boundary(F.col("strand"), F.col("start"), F.col("end"), F.col("evidence_source")).cast("long").alias("coordinate"), "evidence_source", "poly_a_clip")


def evidence(judged_records: DataFrame, sample_id: str, settings: ScanSettings) -> DataFrame:
    return read_end_counts(read_ends(judged_records, sample_id, settings))


def fragments(judged_records: DataFrame, need_proper: bool = True) -> DataFrame:
    """Paired records as one row a name: one and two (the mates, first in pair first) and reason; a name without exactly two primary records is orphan_or_multiple_primary."""
    mate = F.struct(F.when(records.has(F.col("flag"), records.FIRST), 0).otherwise(1).alias("order"), "name", "flag", F.col("target").alias("contig"), "start", "cigar", "sequence", "reason")
    primary = ~records.has(F.col("flag"), records.SECONDARY) & ~records.has(F.col("flag"), records.SUPPLEMENTARY)
    # two primary records at most are ever used, so a name with many is counted, not gathered
    d = judged_records.filter(primary).groupBy("name").agg(F.count("*").alias("n"), F.min(mate).alias("one"), F.max(mate).alias("two"))
    why = F.when(F.col("n") != 2, "orphan_or_multiple_primary").otherwise(records.pair_reason(F.col("one"), F.col("two"), F.col("one.reason"), F.col("two.reason"), need_proper))
    return d.select("name", "one", "two", why.alias("reason"))


def splice_counts(judged_records: DataFrame, sample_id: str, settings: ScanSettings, by_fragment: bool = False) -> DataFrame:
    """Counts of splice edges; with by_fragment an edge that both mates show counts once."""
    d = judged_records.filter("reason is null").withColumn("strand", records.transcript_strand(F.col("flag"), F.lit(settings.protocol)))
    d = d.select("name", F.col("target").alias("contig"), "strand", F.explode(F.array_distinct(records.splice_edges(F.col("strand"), records.splice_blocks(F.col("start"), F.col("cigar"))))).alias("e"))
    d = d.distinct() if by_fragment else d
    return d.groupBy(F.lit(sample_id).alias("sample_id"), "contig", "strand", "e.upstream_start", "e.upstream_end", "e.downstream_start", "e.downstream_end").agg(F.count("*").alias("count"))


def layout(alignments: DataFrame, first: int = 10_000, share: float = 0.95) -> str:
    """Paired, single or mixed by the first records, unknown without any."""
    r = alignments.limit(first).agg(F.count("*").alias("n"), F.avg(records.has(F.col("flag"), records.PAIRED).cast("double")).alias("paired")).first()
    return "unknown" if not r.n else "paired" if r.paired >= share else "single" if r.paired <= 1 - share else "mixed"
