"""Scalar functions on nucleotide sequences and coordinates, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Over ACGTN; other letters stay as they are."""
    return F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))


def longest_run(seq: Column, base: str) -> Column:
    """Length of the longest run of a base."""
    # plain searches for short runs, as a long sequence has very many; only runs of 8 and more are taken out and measured
    runs = F.regexp_extract_all(seq, F.lit(f"{base}{{8,}}"), F.lit(0))
    longest = F.when(seq.contains(base * 8), F.array_max(F.transform(runs, F.char_length)))
    for n in range(7, 0, -1):
        longest = longest.when(seq.contains(base * n), F.lit(n))
    return longest.otherwise(F.lit(0))


def base_count(seq: Column, base: str) -> Column:
    return F.char_length(seq) - F.char_length(F.replace(seq, F.lit(base), F.lit("")))


def base_fraction(seq: Column, base: str) -> Column:
    """Share of a base; 0 for an empty sequence."""
    return F.when(F.char_length(seq) > 0, base_count(seq, base) / F.char_length(seq)).otherwise(F.lit(0.0))


def poly_a_like(clip: Column, least: int = 6, fraction: float = 0.8) -> Column:
    return (F.char_length(clip) >= least) & (base_fraction(clip, "A") >= fraction)


def to_rna(seq: Column) -> Column:
    """T as U; no sequence as `none`."""
    return F.when(F.coalesce(seq, F.lit("")) == "", "none").otherwise(F.translate(seq, "Tt", "Uu"))


def kmers(seq: Column, k: int) -> Column:
    """Distinct k-mers over ACGT, sorted."""
    # a look-ahead yields the k letters at every place in one pass
    return F.array_sort(F.array_distinct(F.regexp_extract_all(seq, F.lit(f"(?=([ACGT]{{{k}}}))"), F.lit(1))))


def motif_hits(seq: Column, motifs: list[tuple[str, str, int]], core: tuple[int, int], upstream: int | None = None, usual: int = 20) -> Column:
    """All (overlapping) hits of motifs (text, class, priority) in an upstream window: array of (priority, outside, off, distance, motif, motif_class) in order of
    preference: priority, in the core range of distances or not, how far off the usual distance, distance. It is counted from `upstream`, where the window
    begins (its length, if none is given; a window cut at a contig's start is shorter), down to the hit's start."""
    begin = F.char_length(seq) if upstream is None else F.lit(upstream)
    found = []
    for motif, kind, priority in motifs:
        hits = _hits(seq, motif)
        named = [F.lit(priority).alias("priority"), F.lit(motif).alias("motif"), F.lit(kind).alias("motif_class")]
        found.append(F.transform(hits, _hit(begin, named, core, usual)))
    return F.sort_array(F.concat(*found))


def motif_count(seq: Column, motifs: list[str]) -> Column:
    """Number of (overlapping) hits of different motifs."""
    if any(a != b and b.startswith(a) for a in motifs for b in motifs):  # a place may have several hits
        return sum((F.regexp_count(seq, F.lit(f"(?={m})")) for m in motifs[1:]), F.regexp_count(seq, F.lit(f"(?={motifs[0]})")))
    return F.regexp_count(seq, F.lit(f"(?={'|'.join(motifs)})")) if motifs else F.lit(0)


def preferred_hit(seq: Column, turned: Column, motifs: list[tuple[str, str, int]], core: tuple[int, int], usual: int = 20) -> Column:
    """The first of motif_hits of a whole sequence, null if there are none; turned: the sequence reversed. Beyond both the core range and the usual distance nearer
    is better, so a motif's hits near the end and the last one before them decide, however many there are."""
    near = max(core[1], usual)
    found = []
    for motif, kind, priority in motifs:
        place = F.locate(motif[::-1], turned, max(0, near - len(motif) + 1) + 1)
        named = [F.lit(priority).alias("priority"), F.lit(motif).alias("motif"), F.lit(kind).alias("motif_class")]
        found.append(F.when(place > 0, _hit(place - 1 + len(motif), named, core, usual)(F.lit(0))))
    return F.array_min(F.concat(motif_hits(F.right(seq, F.lit(near)), motifs, core, usual=usual), F.array(*found)))


def _hits(seq: Column, motif: str) -> Column:
    """The places, from 0, where a motif begins, overlapping ones too: the text is cut before each, and the pieces' lengths add up (a piece may be shorter than the motif)."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("hits"))
    step = lambda s, piece: F.struct((s["at"] + F.char_length(piece)).alias("at"), F.when((s["at"] > 0) | seq.startswith(motif), F.concat(s["hits"], F.array(s["at"]))).otherwise(s["hits"]).alias("hits"))
    return F.aggregate(F.split(seq, f"(?={motif})", -1), start, step, lambda s: s["hits"])


def _hit(begin: Column, named: list[Column], core: tuple[int, int], usual: int):
    def of(i: Column) -> Column:
        distance = begin - i
        outside = (~distance.between(*core)).cast("int")
        return F.struct(named[0], outside.alias("outside"), F.abs(distance - usual).alias("off"), distance.alias("distance"), *named[1:])

    return of


def primary_motif(hits: Column) -> Column:
    return F.coalesce(F.get(hits, F.lit(0))["motif"], F.lit("no_recognized_motif"))


def arcsine_sqrt(share: Column) -> Column:
    return F.asin(F.sqrt(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))))


def oriented(coordinate: Column, strand: Column) -> Column:
    """Grows towards the 3' end on both strands."""
    return F.when(strand == "+", coordinate).otherwise(-coordinate)


def nearest_bin(v: Column, b: int) -> Column:
    """Nearest multiple's number, halves away from zero."""
    return (F.signum(v) * F.floor((F.abs(v) + b // 2) / F.lit(b))).cast("long")


def safe_component(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9._-]+", "_")


def seed_of(text: Column, base: int) -> Column:
    """Deterministic seed: Horner hash of the code points in base 131 mod 2^31 - 1, plus base."""
    m = (1 << 31) - 1
    points = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    return (F.aggregate(points, F.lit(0).cast("long"), lambda h, c: (h * 131 + c) % m) + base) % m


def reasons(*labelled: tuple[Column, Column | str]) -> Column:
    """The labels of all conditions that hold, joined by `;` in order; empty if none does."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), x if isinstance(x, Column) else F.lit(x)) for c, x in labelled])), ";")


def first_reason(*labelled: tuple[Column, str]) -> Column:
    """The label of the first condition that holds; null if none does."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(x)) for c, x in labelled])
