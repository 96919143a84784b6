"""Predicates and coordinates of aligned read records, as column expressions.

A record has flag (SAM bits), contig, start, mapq, hits (null if not recorded) and cigar: array<struct<op:int,len:int>>.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequences import first_reason, reverse_complement

# SAM flag bits.
PAIRED, PROPER, UNMAPPED, REVERSE, FIRST, SECOND, SECONDARY, QC_FAILED, DUPLICATE, SUPPLEMENTARY = 1, 2, 4, 16, 64, 128, 256, 512, 1024, 2048
#: CIGAR operations that consume the reference, and those of splices and soft clips.
CONSUMES, SPLICE, SOFT_CLIP = (0, 2, 3, 7, 8), 3, 4


def has(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(bit) != 0


def filter_reason(flag: Column, mapq: Column, contig: Column, hits: Column, least_mapq: int, excluded: list[str], drop_duplicates: bool = True) -> Column:
    """The first reason to leave a record out, null if it stays."""
    return first_reason(
        (has(flag, UNMAPPED), "unmapped"), (has(flag, SECONDARY), "secondary"), (has(flag, SUPPLEMENTARY), "supplementary"), (has(flag, QC_FAILED), "qc_failed"),
        (F.lit(drop_duplicates) & has(flag, DUPLICATE), "duplicate"), (mapq < least_mapq, "low_mapq"), (contig.isin(excluded), "excluded_contig"), (hits.isNotNull() & (hits != 1), "multimapped"))


def pair_reason(first: Column, second: Column, one: Column, other: Column, need_proper: bool = True) -> Column:
    """For two records (structs with name, flag, contig) and their own reasons: the first reason to leave the pair out."""
    mates = (has(first["flag"], FIRST) & has(second["flag"], SECOND)) | (has(first["flag"], SECOND) & has(second["flag"], FIRST))
    return F.coalesce(
        F.when(first["name"] != second["name"], "query_name_mismatch"), F.when(~mates, "mate_designation"), one, other,
        F.when(first["contig"] != second["contig"], "interchromosomal"), F.when(F.lit(need_proper) & ~(has(first["flag"], PROPER) & has(second["flag"], PROPER)), "improper_pair"))


def transcript_strand(flag: Column, protocol: Column) -> Column:
    """Strand of the transcript: the read's own for a forward protocol, the other for a reverse one; second mates count as the fragment's first."""
    backwards = has(flag, REVERSE) != (has(flag, PAIRED) & has(flag, SECOND))
    return F.when(backwards == (protocol == "reverse"), "+").otherwise("-")


def reference_end(start: Column, cigar: Column) -> Column:
    return F.aggregate(cigar, start.cast("long"), lambda a, x: a + F.when(x["op"].isin(*CONSUMES), x["len"]).otherwise(0))


def boundary(strand: Column, start: Column, end: Column, source: Column) -> Column:
    """3' (read_3p, polyA_junction) or 5' (read_5p) end of a read on the transcript's strand."""
    three = F.when(strand == "+", end).otherwise(start)
    return F.when(source == "read_5p", F.when(strand == "+", start).otherwise(end)).otherwise(three)


def fragment_boundary(strand: Column, starts: list[Column], ends: list[Column]) -> Column:
    return F.when(strand == "+", F.greatest(*ends)).otherwise(F.least(*starts))


def splice_blocks(start: Column, cigar: Column) -> Column:
    """Aligned blocks between splices: array of (start, end), empty ones dropped."""
    zero = F.struct(start.cast("long").alias("at"), start.cast("long").alias("open"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done"))

    def step(s: Column, x: Column) -> Column:
        to = s["at"] + F.when(x["op"].isin(*CONSUMES), x["len"]).otherwise(0)
        cut = x["op"] == SPLICE
        closed = F.concat(s["done"], F.array(F.struct(s["open"].alias("start"), s["at"].alias("end"))))
        return F.struct(to.alias("at"), F.when(cut, to).otherwise(s["open"]).alias("open"), F.when(cut, closed).otherwise(s["done"]).alias("done"))

    last = lambda s: F.concat(s["done"], F.array(F.struct(s["open"].alias("start"), s["at"].alias("end"))))
    return F.filter(F.aggregate(cigar, zero, step, last), lambda b: b["end"] > b["start"])


def splice_edges(strand: Column, blocks: Column) -> Column:
    """Consecutive blocks as (upstream_start, upstream_end, downstream_start, downstream_end) in transcript order."""
    pairs = F.when(F.size(blocks) > 1, F.sequence(F.lit(0), F.size(blocks) - 2)).otherwise(F.array().cast("array<int>"))

    def edge(i: Column) -> Column:
        a, b = F.get(blocks, i), F.get(blocks, i + 1)
        up, down = F.when(strand == "+", a).otherwise(b), F.when(strand == "+", b).otherwise(a)
        return F.struct(up["start"].alias("upstream_start"), up["end"].alias("upstream_end"), down["start"].alias("downstream_start"), down["end"].alias("downstream_end"))

    return F.transform(pairs, edge)


def terminal_clip(strand: Column, cigar: Column, sequence: Column) -> Column:
    """The soft clip at the transcript's 3' edge, in its direction; empty if there is none."""
    at = F.when(strand == "+", F.try_element_at(cigar, F.lit(-1))).otherwise(F.try_element_at(cigar, F.lit(1)))
    n = F.when(at["op"] == SOFT_CLIP, at["len"]).otherwise(0)
    return F.when(strand == "+", F.right(sequence, n)).otherwise(reverse_complement(F.left(sequence, n)))
