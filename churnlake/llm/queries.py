"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import (
    conversation_repair,
    decontamination,
    html_text,
    language_id,
    license_scan,
    mixing,
    near_duplicates,
    placement,
    quality_rules,
    spelling,
    suffix_dedup,
    token_blocks,
    word_bpe,
)
from churnlake.llm.common import read_table, staged
from churnlake.llm.near_duplicates import small_batches


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """A public BPE vocabulary, a file that is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(docs, items).drop("key")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_table(read_table(spark, sf_dir, "documents"), tokenizer_file())


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.class_table(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.withColumnRenamed("id", "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *quality_rules.RULES)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(read_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return placement.place(docs, "doc_id", placement.named_shards(spark))


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    with small_batches(spark):
        return staged(word_bpe.digests(docs, tokenizer_file("word_bpe_49k.json")), "word-bpe")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose checksum with their document's id is a multiple of 97 lose one letter, as if mistyped."""
    docs = read_table(spark, sf_dir, "documents").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(spelling.runs_of(F.col("text"))).alias("run"))
    hashed = docs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    typed = F.expr("CASE WHEN h % 97 = 0 THEN concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))"
                   " ELSE run END")
    return spelling.variants(spelling.vocabulary(hashed.select(typed.alias("word"))))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    hurt = conversation_repair.damaged(rows)
    fixed = staged(conversation_repair.repair(hurt), "conversations-repaired")
    hashes = conversation_repair.applied(hurt, fixed, sink=conversation_repair.HashSink)
    same = F.col("conv_id").eqNullSafe(F.col("k"))
    out = rows.select("conv_id").distinct().join(fixed.withColumnRenamed("conv_id", "k"), same, "left").drop("k")
    out = out.join(hashes.withColumnRenamed("conv_id", "k"), same, "left").drop("k")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_license_scan": op3_license_scan,
    "op4_token_blocks": op4_token_blocks,
    "op5_html_text": op5_html_text,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_mixing": op9_mixing,
    "op10_sharding": op10_sharding,
    "op11_word_bpe": op11_word_bpe,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}
