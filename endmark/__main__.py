"""Command line: python -m endmark COMMAND --help."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import checks
from .plans import atlas, parameters, report, run, scan
from .plans.storage import written
from .sources import bam, readers


def _scan(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.records.endswith(".bam"):
        spark.dataSource.register(bam.BamSource)
        records = spark.read.format("bam").load(a.records)
    else:
        records = readers.read_sam(spark, a.records)
    settings = scan.ScanSettings(protocol=a.protocol, least_mapq=a.least_mapq, excluded=tuple(a.exclude))
    judged = scan.judged(records, settings, readers.read_aliases(spark, a.aliases) if a.aliases else None)
    scan.evidence(judged, a.sample, settings).write.mode("overwrite").parquet(a.out)
    for r in scan.counters(judged).orderBy("reason").collect():
        print(r.reason, r.n, sep="\t")


def _validate(spark: SparkSession, a: argparse.Namespace) -> None:
    sheet = _sheet(spark, a.samples)
    problems = checks.sample_sheet(sheet, a.least_replicates).collect()  # a sheet's rows are few
    for r in problems:
        print(r.problem, r.item, sep="\t")
    if problems:
        raise SystemExit(1)


def _cluster(spark: SparkSession, a: argparse.Namespace) -> None:
    evidence = spark.read.parquet(*a.evidence).filter(F.col("evidence_source") == a.source)
    settings = parameters.load(a.parameters)
    if a.samples:
        known = readers.read_known_sites(spark, a.known) if a.known else None
        spliced = readers.read_continuations(spark, a.continuations) if a.continuations else None
        accepted, rejected = run.judge(evidence, _sheet(spark, a.samples), settings, known, spliced)
        accepted.write.mode("overwrite").parquet(a.out)
        rejected.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}_rejected")
    else:
        run.discover(evidence, settings).write.mode("overwrite").parquet(a.out)


def _sheet(spark: SparkSession, path: str):
    return readers.read_tsv(spark, path, ("",)).select("sample_id", "condition", F.col("control").alias("control_condition"))


def _annotate(spark: SparkSession, a: argparse.Namespace) -> None:
    features = written(readers.resolve_features(readers.read_features(spark, a.annotation)))
    known = readers.read_known_sites(spark, a.known) if a.known else spark.createDataFrame([], "contig string, strand string, coordinate long")
    motifs = readers.read_motifs(spark, a.motifs) if a.motifs else []
    sites = atlas.annotate(spark.read.parquet(a.clusters), features, readers.read_fasta(spark, a.fasta), motifs, known, a.assembly)
    names = features.filter("gene_id is not null").select("gene_id", "gene_name").distinct()
    sites.join(names, "gene_id", "left").write.mode("overwrite").parquet(a.out)


def _analyse(spark: SparkSession, a: argparse.Namespace) -> None:
    settings = parameters.load(a.parameters)
    evidence = spark.read.parquet(*a.evidence).filter(F.col("evidence_source") == a.source)
    sites = spark.read.parquet(a.atlas)
    sheet = _sheet(spark, a.samples)
    family = sheet.filter((F.col("condition") == a.control) | (F.col("control_condition") == a.control)).select("sample_id", "condition")
    counts = run.quantify(evidence.join(family.select("sample_id"), "sample_id", "left_semi"), sites, settings)
    tables = run.compare(counts, sites, family, a.control, settings)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{a.out}/{name}")
    if a.report:
        with open(a.report, "w", encoding="utf-8") as f:
            f.write(report.html_report(f"Comparisons with {a.control}", tables))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="endmark", description=__doc__)
    commands = p.add_subparsers(required=True)

    def command(name: str, of, *options: tuple[str, dict]) -> None:
        one = commands.add_parser(name)
        for flag, how in options:
            one.add_argument(flag, **how)
        one.set_defaults(of=of)

    need, many = {"required": True}, {"required": True, "nargs": "+"}
    settings = ("--parameters", {"help": "JSON or YAML"})
    source = ("--source", {"default": "read_3p"})
    command("validate", _validate, ("--samples", need), ("--least-replicates", {"type": int, "default": 2}))
    command("scan", _scan, ("--records", need), ("--sample", need), ("--out", need), ("--protocol", {"default": "forward", "choices": ["forward", "reverse"]}), ("--least-mapq", {"type": int, "default": 10}), ("--exclude", {"nargs": "*", "default": []}), ("--aliases", {}))
    command("cluster", _cluster, ("--evidence", many), ("--out", need), ("--samples", {"help": "judge the clusters by this sheet; the rejected go to OUT_rejected"}), ("--known", {}), ("--continuations", {"nargs": "+"}), settings, source)
    command("annotate", _annotate, ("--clusters", need), ("--fasta", need), ("--annotation", need), ("--out", need), ("--assembly", need), ("--motifs", {}), ("--known", {}))
    command("analyse", _analyse, ("--evidence", many), ("--atlas", need), ("--samples", need), ("--control", need), ("--out", need), ("--report", {}), settings, source)
    return p


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    a.of(SparkSession.builder.appName("endmark").getOrCreate(), a)


if __name__ == "__main__":
    main()
