"""Writers. What grows with the data goes through Spark's writers; byte-stable single files are for tables of published size."""

from __future__ import annotations

import gzip
import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import conform


def write_small_tsv(df: DataFrame, path: str, columns: list[str]) -> None:
    """One deterministic TSV file on the driver (gz by suffix, no time stamp): fixed columns, extra ones left out, nulls empty. Rows stream by partition."""
    raw = open(path, "wb")
    out = gzip.GzipFile(fileobj=raw, mode="wb", filename="", mtime=0) if path.endswith(".gz") else raw
    with raw, out:
        out.write(("\t".join(columns) + "\n").encode())
        for r in conform(df, columns).toLocalIterator():
            out.write(("\t".join("" if x is None else str(x) for x in r) + "\n").encode())


def write_evidence(df: DataFrame, path: str) -> None:
    df.repartition("sample_id", "contig", "strand").sortWithinPartitions("contig", "strand", "coordinate", "sample_id").write.partitionBy("sample_id").parquet(path)


def bedgraph(evidence: DataFrame) -> DataFrame:
    """(strand, line) of per-strand tracks, to be written partitioned by strand."""
    per = evidence.groupBy("contig", "strand", "coordinate").agg(F.sum("count").alias("count"))
    return per.select("strand", F.concat_ws("\t", "contig", "coordinate", (F.col("coordinate") + 1).cast("string"), F.col("count").cast("string")).alias("value"))


def bed6(atlas: DataFrame) -> DataFrame:
    """Sites as BED6 lines: the boundary base, or the resolution region where there is one; scores capped at 1000."""
    c = F.col("coordinate")
    start, end = (F.col("region_start"), F.col("region_end")) if {"region_start", "region_end"} <= set(atlas.columns) else (c, c + 1)
    return atlas.select(F.concat_ws("\t", "chrom", start.cast("string"), end.cast("string"), "pac_id", F.least("total", F.lit(1000)).cast("string"), "strand").alias("value"))


def flattened(candidates: DataFrame, members: str = "members", conditions: str = "supporting_conditions") -> DataFrame:
    """Array columns as text: members joined by commas, conditions by semicolons."""
    joined = {members: ",", conditions: ";"}
    return candidates.withColumns({c: F.array_join(F.col(c).cast("array<string>"), sep) for c, sep in joined.items() if c in candidates.columns})


def write_json(value: object, path: str) -> None:
    Path(path).write_text(json.dumps(value, sort_keys=True, indent=2) + "\n")


def file_sha256(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def concatenated(parts: dict[str, DataFrame], name: str = "family") -> DataFrame:
    """Shards with equal columns as one table, in the order of their names; a mismatch is an error."""
    out = None
    for key in sorted(parts):
        one = parts[key].withColumn(name, F.lit(key))
        if out is not None and out.columns != one.columns:
            raise ValueError(f"{key} has other columns")
        out = one if out is None else out.unionByName(one)
    return out


def write_continuations(df: DataFrame, path: str) -> None:
    """Splice continuations as one TSV in their fixed columns, sorted. They are bounded by the introns a sample uses, and stream by partition."""
    columns = ["sample_id", "contig", "strand", "upstream_start", "upstream_end", "downstream_start", "downstream_end", "count"]
    write_small_tsv(df.orderBy(*columns[:-1]), path, columns)


def write_scan(folder: str, sample_id: str, layout: str, strandedness: str, sources: dict[str, tuple[DataFrame, list[tuple[str, int]]]], splice: tuple[DataFrame, list[tuple[str, int]]] | None = None) -> str:
    """A sample's scan: each source's evidence and the continuations as Parquet tables, and the manifest that names them, whose path is returned. Filter counts
    keep their order. The folder must be one that driver and executors share."""
    named = {}
    for source, (df, filtering) in sources.items():
        table = f"{sample_id}.{source}.parquet"
        df.write.parquet(f"{folder}/{table}")
        named[source] = {"table": table, "filtering": [[k, n] for k, n in filtering]}
    spliced = None
    if splice is not None:
        table = f"{sample_id}.splice_continuations.parquet"
        splice[0].write.parquet(f"{folder}/{table}")
        spliced = {"table": table, "filtering": [[k, n] for k, n in splice[1]]}
    manifest = f"{folder}/{sample_id}.filtering.json"
    write_json({"sample_id": sample_id, "layout": layout, "strandedness": strandedness, "sources": named, "splice": spliced}, manifest)
    return manifest


def fingerprint(path: str) -> dict[str, int]:
    """Size and time of change of a file, which tell whether it is still the one that was scanned."""
    at = Path(path).stat()
    return {"source_size": at.st_size, "source_mtime_ns": at.st_mtime_ns}


def check_fingerprint(path: str, recorded: dict[str, int]) -> None:
    """An error if the file is gone or isn't the recorded one."""
    if not Path(path).is_file():
        raise ValueError(f"{path} is not readable")
    if lacking := {"source_size", "source_mtime_ns"} - set(recorded):
        raise ValueError(f"the record of {path} lacks {', '.join(sorted(lacking))}")
    if fingerprint(path) != {k: int(recorded[k]) for k in ("source_size", "source_mtime_ns")}:
        raise ValueError(f"{path} changed after it was recorded")


def write_r_tsv(df: DataFrame, path: str, columns: list[str]) -> None:
    """A gz table for R: missing values and NaN are empty fields."""
    from pyspark.sql import types as T

    d = conform(df, columns)
    doubles = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)) for f in d.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    write_small_tsv(d.withColumns(doubles) if doubles else d, path if path.endswith(".gz") else f"{path}.gz", columns)
