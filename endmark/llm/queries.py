"""Queries of the corpus operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat_format, collocations, license_scan, mixing, pii, secret_scan, sharding, simhash, token_files
from .common import table, text_of
from .oracles import ORACLES
from .quality import MEASURES, quality_report


def tokenizer_path() -> str:
    """The public vocabulary that the queries use; operators take a path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _attached(turns: DataFrame) -> DataFrame:
    """turns with parts: its text, cut in two where it is longer than 64 code points, and on three of 16 turns an attachment between or behind.
    The table has texts only; the rule brings every kind of part through the query."""
    at, n = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(16)), F.char_length("text")
    few = F.pmod("conv_id", F.lit(5)).cast("int")
    uri = F.concat_ws("/", "conv_id", "turn")
    pieces = F.when(n > 64, F.array(F.substr("text", F.lit(1), F.floor(n / 2).cast("int")), F.substr("text", F.floor(n / 2).cast("int") + 1))).otherwise(F.array("text"))
    texts = F.transform(pieces, lambda x: chat_format.part("text", text=x))
    extra = (
        F.when(at == 1, chat_format.part("image", uri=uri, width=28 * (few + 1), height=F.lit(56)))
        .when(at == 2, chat_format.part("audio", uri=uri, seconds=few + 0.5))
        .when(at == 3, chat_format.part("document", uri=uri, pages=few))
    )
    return turns.withColumn("parts", F.array_compact(F.concat(F.slice(texts, 1, 1), F.array(extra), F.slice(texts, 2, 1))))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    out = chat_format.format_chat(_attached(turns.unionByName(extra)))
    out = out.withColumn("turns", chat_format.read_back(F.col("formatted"))).withColumn("learned", F.array_join(chat_format.under_loss(F.col("formatted"), F.col("loss")), ""))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"), F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"), F.size("attachments").cast("long").alias("n_attachments"), "attachment_tokens")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.array(*[F.lit(r.kind) for r in secret_scan.RULES])
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", F.get(kinds, x["kind_no"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda no: F.size(F.filter("secrets", lambda x: x["kind_no"] == no)).cast("long")
    base = F.filter("secrets", lambda x: x["kind_no"] < 3)
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key="endmark demonstration key")
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", "text", F.size("pii").cast("long").alias("n_values"), *map(count, pii.KINDS))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *MEASURES, "base_failed", "kept")


def op8_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", (F.octet_length(text_of()).cast("long") + 16).alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"))
    out = sharding.shard_rows(sized, shards=40, seed=2024, order=["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep_text=False)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    coded = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, first=2000)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.new_folder(spark)
    token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), folder, key="doc_id", end=1)
    return token_files.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_chat_format, op3_nearest_neighbours, op4_secret_scan, op5_simhash, op6_pii, op7_quality_rules, op8_feistel_sharding, op9_mixing, op10_bpe, op11_collocations, op12_token_files, pipeline)}


__all__ = ["ORACLES", "QUERIES"]
