"""Readers of the text, table and alignment formats the engine takes. Paths are opened by Spark's readers only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.checks import cyclic
from ..plans.storage import written

YES = ("true", "t", "1", "yes")


def read_tsv(spark: SparkSession, path: str, missing: tuple[str, ...] = ()) -> DataFrame:
    """A table with a header, all values text, gz by suffix. Values listed in missing are null; an empty field is the empty text unless listed."""
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote='"', emptyValue="", nullValue="\u0000")
    for c in df.columns:
        value = F.coalesce(F.col(c), F.lit(""))
        df = df.withColumn(c, F.when(~value.isin(*missing), value) if missing else value)
    return df


def flag(c: Column, yes: tuple[str, ...] = YES) -> Column:
    return F.lower(F.trim(c)).isin(*yes)


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns, in order; a missing one is an error."""
    if lacking := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df.select(*columns)


def read_typed(spark: SparkSession, path: str, required: list[str], numeric: tuple[str, ...] = (), flags: tuple[str, ...] = ()) -> DataFrame:
    """A TSV with required columns; numbers that don't parse are null, "" and NA are missing."""
    df = read_tsv(spark, path, ("", "NA"))
    conform(df, required)
    return df.withColumns({c: F.col(c).try_cast("double") for c in numeric if c in df.columns} | {c: flag(F.col(c)) for c in flags if c in df.columns})


def read_evidence(spark: SparkSession, path: str, columns: list[str] | None = None, in_order: bool = False) -> DataFrame:
    """Read-end evidence; in_order asserts that it is sorted by (contig, strand, coordinate, sample_id)."""
    df = spark.read.parquet(path)
    if in_order and not is_sorted(df, ["contig", "strand", "coordinate", "sample_id"]):
        raise ValueError(f"{path} isn't sorted")
    return df.select(*columns) if columns else df


def is_sorted(df: DataFrame, keys: list[str]) -> bool:
    """Whether rows stand in key order: within partitions by neighbours, across them by their first and last keys (a row a partition)."""
    key = F.struct(*keys)
    numbered = df.select(key.alias("k"), F.monotonically_increasing_id().alias("id")).withColumn("part", F.shiftright("id", 33))
    w = Window.partitionBy("part").orderBy("id")
    wrong = numbered.withColumn("before", F.lag("k").over(w)).filter("before > k").limit(1).count()
    ends = numbered.groupBy("part").agg(F.min_by("k", "id").alias("first"), F.max_by("k", "id").alias("last"))
    apart = ends.withColumn("before", F.lag("last").over(Window.orderBy("part"))).filter("before > first").limit(1).count()
    return not wrong and not apart


def merged(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Per-sample evidence as one table, sorted within partitions of (contig, strand)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.repartition(*keys[:2]).sortWithinPartitions(*keys)


def _attributes(text: Column) -> Column:
    """GFF3 `k=v;` (up to a comma) or GTF `k "v";`; the last of equal keys wins."""
    gff = F.contains(text, F.lit("=")) & ~F.contains(text, F.lit(' "'))
    entries = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x != "")
    of = lambda x, sep: F.struct(F.trim(F.substring_index(x, sep, 1)).alias("k"), F.substr(x, F.instr(x, sep) + 1).alias("v"))
    as_gff = F.transform(F.filter(entries, lambda x: F.contains(x, F.lit("="))), lambda x: F.struct(of(x, "=")["k"].alias("k"), F.substring_index(of(x, "=")["v"], ",", 1).alias("v")))
    as_gtf = F.transform(F.filter(entries, lambda x: F.contains(x, F.lit(" "))), lambda x: F.struct(of(x, " ")["k"].alias("k"), F.trim(F.translate(of(x, " ")["v"], '"', "")).alias("v")))
    return F.when(gff, as_gff).otherwise(as_gtf)


def attribute(attributes: Column, *keys: str) -> Column:
    """The last value of the first of keys that is set."""
    values = [F.try_element_at(F.filter(attributes, _named(k)), F.lit(-1))["v"] for k in keys]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in values])


def _named(key: str):
    return lambda x: x["k"] == key


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value): the lines of text files, numbered from 1 through the files in path order. Lines are numbered in their split, and splits, of which there are few, by the lines before them; no task sees a whole file."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    lines = written(spark.read.text(path).select("value", place.alias("split"), F.monotonically_increasing_id().alias("seen")))
    splits = lines.groupBy("split").agg(F.min("seen").alias("first"), F.count("*").alias("n")).collect()  # a row a split
    before, starts = 0, []
    for r in sorted(splits, key=lambda r: (r.split.file, r.split.at)):
        starts.append((r.split, before - r.first + 1))
        before += r.n
    shifts = spark.createDataFrame(starts, "split struct<file:string,at:long>, shift long")
    return lines.join(shifts, "split").select((F.col("seen") + F.col("shift")).alias("line_no"), "value")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Records of a GTF or GFF3 file: contig, type, start (0-based), end, strand, attributes, line_no. A record without nine fields is an error when it is read."""
    lines = numbered_lines(spark, path).filter("trim(value) <> '' and not startswith(value, '#')").withColumn("f", F.split("value", "\t", -1))
    checked = lines.withColumn("f", F.when(F.size("f") == 9, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("not nine fields: "), "value"))))
    f = F.col("f")
    kind = F.when(F.get(f, F.lit(2)).isin("ncRNA_gene", "pseudogene"), "gene").otherwise(F.get(f, F.lit(2)))
    return checked.select(
        F.get(f, F.lit(0)).alias("contig"), kind.alias("type"), (F.get(f, F.lit(3)).cast("long") - 1).alias("start"), F.get(f, F.lit(4)).cast("long").alias("end"), F.get(f, F.lit(6)).alias("strand"), _attributes(F.get(f, F.lit(8))).alias("attributes"), "line_no")


def resolve_features(features: DataFrame) -> DataFrame:
    """Stranded features with gene_id, transcript_id, gene_name and line_no; GFF3 parents are followed up to a gene, level by level, however many there are. Of records that share an id the first
    in the file is the parent; a gene's name is that of its first gene record with one, else the first elsewhere, else its id. An exon, transcript
    or gene without a gene is an error when it is read, parents that form a cycle one at once."""
    a = F.col("attributes")
    d = features.filter("strand in ('+', '-')").withColumns({"id": attribute(a, "ID"), "parent": attribute(a, "Parent"), "gene_id": attribute(a, "gene_id"), "transcript_id": attribute(a, "transcript_id"), "gene_name": attribute(a, "gene_name", "Name", "gene")})
    d = d.withColumn("gene_id", F.coalesce("gene_id", F.when(F.col("type") == "gene", F.col("id")))).withColumn("transcript_id", F.coalesce("transcript_id", F.when(F.col("type").isin("transcript", "mRNA"), F.col("id")), F.when(F.col("type") == "exon", F.col("parent"))))
    named = d.filter("id is not null").groupBy(F.col("id").alias("_id")).agg(F.min_by(F.struct(F.col("parent").alias("_up"), F.col("gene_id").alias("_gene")), "line_no").alias("_first")).select("_id", "_first.*")
    d = d.withColumn("_at", F.col("parent"))
    above = 0
    while d.filter("gene_id is null and _at is not null").limit(1).count():
        if above and above % 8 == 0:
            if cyclic(named, "_id", "_up").limit(1).count():
                raise ValueError("parents form a cycle")
            d = written(d)  # a long plan costs more than a table
        above += 1
        d = d.join(named, d["_at"] == named["_id"], "left").withColumn("gene_id", F.coalesce("gene_id", "_gene")).withColumn("_at", F.when(F.col("gene_id").isNull(), F.col("_up"))).drop("_id", "_up", "_gene")
    needed = F.col("type").isin("gene", "exon", "transcript", "mRNA") & F.col("gene_id").isNull()
    d = d.withColumn("gene_id", F.when(needed, F.raise_error(F.concat(F.lit("no gene for "), F.coalesce("id", "type")))).otherwise(F.col("gene_id")))
    w = Window.partitionBy("gene_id")
    first = lambda of: F.min_by("gene_name", F.when(of & F.col("gene_name").isNotNull(), F.col("line_no"))).over(w)
    name = F.coalesce(first(F.col("type") == "gene"), first(F.lit(True)), F.col("gene_id"))
    return d.withColumn("gene_name", F.when(F.col("gene_id").isNotNull(), name)).select("contig", "type", "start", "end", "strand", "gene_id", "transcript_id", "gene_name", "line_no")


def annotated_contigs(features: DataFrame) -> DataFrame:
    return features.filter("strand in ('+', '-')").select("contig").distinct()


def read_known_sites(spark: SparkSession, path: str) -> DataFrame:
    """(contig, strand, coordinate) of a BED file: the end on +, the start on -; lines of under three fields are skipped, + is the default."""
    f = F.col("f")
    d = spark.read.text(path).filter("not startswith(value, '#')").withColumn("f", F.split("value", "\t")).filter(F.size("f") >= 3)
    strand = F.coalesce(F.when(F.get(f, F.lit(5)).isin("+", "-"), F.get(f, F.lit(5))), F.lit("+"))
    return d.select(F.get(f, F.lit(0)).alias("contig"), strand.alias("strand"), F.when(strand == "-", F.get(f, F.lit(1)).cast("long")).otherwise(F.get(f, F.lit(2)).cast("long")).alias("coordinate")).distinct()


def read_motifs(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(motif, class, priority) of a catalogue, sorted by priority and motif. Lines are a motif of six of ACGT, its class and, if given, its priority (else its number among the motifs); empty lines, those that start with `#` and a header in
    the first line are skipped; anything else is an error that names the line. Catalogues are small."""
    lines = "".join(r.value for r in spark.read.text(path, wholetext=True).collect()).splitlines()
    out: list[tuple[str, str, int]] = []
    for no, line in enumerate(lines, 1):
        fields = [x.strip() for x in line.split("\t")]
        if not line.strip() or line.startswith("#") or (no == 1 and fields[0].lower() == "motif"):
            continue
        motif, kind, priority = (*fields[:3], "", "")[:3]
        if not re.fullmatch("[ACGT]{6}", motif.upper()):
            raise ValueError(f"{path}, line {no}: not a motif of six bases: {motif}")
        if not kind or not re.fullmatch("-?[0-9]*", priority):
            raise ValueError(f"{path}, line {no}: a class is needed, and a whole number if there is a priority")
        out.append((motif.upper(), kind, int(priority) if priority else len(out) + 1))
    return sorted(out, key=lambda m: (m[2], m[0]))


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, target) of a two-column file; a header line is skipped."""
    f = F.split("value", "\t")
    return spark.read.text(path).filter("trim(value) <> ''").select(F.get(f, F.lit(0)).alias("alias"), F.get(f, F.lit(1)).alias("target")).filter(~F.lower("alias").isin("alias", "source", "from"))


def densify_kernel(sparse: DataFrame) -> DataFrame:
    """(offset, weight) for every offset of the span, 0 where none is given."""
    span = sparse.agg(F.explode(F.sequence(F.min("offset"), F.max("offset"))).alias("offset")) if sparse.limit(1).count() else sparse.select("offset")
    return span.join(sparse, "offset", "left").select("offset", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def read_fasta(spark: SparkSession, path: str, width: int = 10_000) -> DataFrame:
    """(contig, chunk, seq) of a FASTA file in chunks of fixed width, read record by record with `>` as separator. A contig is one record in memory."""
    if path.endswith(".gz"):
        raise ValueError("an uncompressed FASTA file is needed")
    d = spark.read.option("lineSep", ">").text(path).filter("trim(value) <> ''")
    name = F.regexp_extract("value", r"^(\S+)", 1)
    seq = F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", ""))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.char_length("seq") - 1) / width).cast("int")), lambda k: F.substr(F.col("seq"), k * width + 1, F.lit(width)))
    return d.select(name.alias("contig"), seq.alias("seq")).filter("seq <> ''").select("contig", F.posexplode(chunks).alias("chunk", "seq"))


def fetch_windows(points: DataFrame, chunks: DataFrame, start: Column, end: Column, width: int = 10_000) -> DataFrame:
    """points (row key `row`, contig, strand) with the oriented sequence of [start, end), clipped to the contig; reverse-complemented on -."""
    from ..functions.sequences import reverse_complement

    d = points.withColumn("_s", F.greatest(start, F.lit(0))).withColumn("_e", end)
    d = d.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("_s") / width).cast("int"), F.floor(F.greatest(F.col("_e") - 1, F.col("_s")) / width).cast("int"))))
    j = d.join(chunks, ["contig", "chunk"])
    low = F.greatest(F.col("_s") - F.col("chunk") * width, F.lit(0))
    piece = F.substr("seq", (low + 1).cast("int"), (F.least(F.col("_e") - F.col("chunk") * width, F.lit(width)) - low).cast("int"))
    whole = j.withColumn("piece", piece).groupBy("row", "contig", "strand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "piece"))), lambda x: x["piece"]), "").alias("window"))
    return whole.withColumn("window", F.when(F.col("strand") == "-", reverse_complement(F.col("window"))).otherwise(F.col("window")))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment records of SAM text: name, flag, contig, start (0-based), mapq, cigar (array of op, len), sequence, hits (tag NH, null if absent)."""
    record = ~F.col("value").startswith("@") & (F.trim("value") != "")
    # filters may be evaluated in any order: header lines have no fields, so nothing fails on them
    d = spark.read.text(path).filter(record).withColumn("f", F.when(record, F.split("value", "\t")))
    f = F.col("f")
    code = lambda m: (F.instr(F.lit("MIDNSHP=X"), F.right(m, F.lit(1))) - 1).cast("int")
    cigar = F.transform(F.regexp_extract_all(F.get(f, F.lit(5)), F.lit("[0-9]+[MIDNSHP=X]"), F.lit(0)), lambda m: F.struct(code(m).alias("op"), F.regexp_extract(m, "^([0-9]+)", 1).cast("int").alias("len")))
    hits = F.try_element_at(F.filter(f, lambda x: x.startswith("NH:i:")), F.lit(1))
    return d.select(F.get(f, F.lit(0)).alias("name"), F.get(f, F.lit(1)).cast("int").alias("flag"), F.get(f, F.lit(2)).alias("contig"), (F.get(f, F.lit(3)).cast("long") - 1).alias("start"), F.get(f, F.lit(4)).cast("int").alias("mapq"), cigar.alias("cigar"), F.get(f, F.lit(9)).alias("sequence"), F.substr(hits, F.lit(6)).cast("int").alias("hits"))


CONTINUATION = "sample_id string, contig string, strand string, upstream_start long, upstream_end long, downstream_start long, downstream_end long, count long"


def _typed(df: DataFrame, schema: str) -> DataFrame:
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    return conform(df, [n for n, _ in fields]).select(*[F.col(n).cast(t).alias(n) for n, t in fields])


def read_transcript_ends(spark: SparkSession, path: str) -> DataFrame:
    """(contig, strand, coordinate, gene_id) of reference transcript ends; a coordinate that is no number is an error. Rows are looked up by the joins, so they have no order."""
    return _typed(read_tsv(spark, path), "contig string, strand string, coordinate long, gene_id string")


def read_continuations(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Splice continuations of several files as one table; other columns are left out."""
    parts = [_typed(read_tsv(spark, p), CONTINUATION) for p in paths]
    out = spark.createDataFrame([], CONTINUATION)
    for part in parts:
        out = out.unionByName(part)
    return out


def read_scan(spark: SparkSession, path: str) -> dict[str, object]:
    """The manifest that sinks.write_scan left: its fields, with each source's table as an absolute path and the order of its filter counts kept. A table it
    names that isn't there is an error. Opened through Hadoop, as the tables are."""
    import json

    text = "".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())
    found = json.loads(text)
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
    lacking = []

    def at(name: str) -> str:
        where = jvm.org.apache.hadoop.fs.Path(folder, name)
        if not where.getFileSystem(conf).exists(where):
            lacking.append(name)
        return where.toString()

    for one in found["sources"].values():
        one["table"], one["filtering"] = at(one["table"]), dict(one["filtering"])
    if found["splice"]:
        found["splice"]["table"], found["splice"]["filtering"] = at(found["splice"]["table"]), dict(found["splice"]["filtering"])
    if lacking:
        raise ValueError(f"{path} names missing tables: {', '.join(lacking)}")
    return found
