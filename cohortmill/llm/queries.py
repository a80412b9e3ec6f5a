"""The registered queries of the operators in this subpackage, and the SQL that must return the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortmill.llm import (
    byte_bpe, conversation_repair, decontamination, embeddings, html_extraction, interpolated_lm, language_id, licenses, merkle,
    minhash, oracles, quotation, sharding, warc,
)
from cohortmill.llm.staging import staged

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that language ID never learns from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def ranks() -> dict[bytes, int]:
    return byte_bpe.read_ranks(public_tokenizers.path(VOCABULARY))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_extraction.main_text(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    of_method = F.transform("matches", lambda m: m["label"])
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", of_method)), ",").alias("labels"),
        F.when(F.size("matches") > 0, 1.0).when(F.col("n_base") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.link_quotations(table(spark, sf_dir, "conversations"))


def op5_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.round_trip(table(spark, sf_dir, "pages"))
    pages = staged(captures.select("record_id", "page_id", "response.*"), "captures")
    originals = staged(pages.groupBy("record_id").agg(F.min("page_id").alias("original")), "originals")
    return pages.join(originals.withColumnRenamed("record_id", "refers_to"), "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("original").alias("refers_to"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op8_byte_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, ~held_out())
    return language_id.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), ranks())


def op11_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    part = F.when(remainder == 0, interpolated_lm.SCORED).when(remainder == 9, interpolated_lm.DELETED).otherwise(interpolated_lm.KEPT)
    scores, totals, _ = interpolated_lm.score(table(spark, sf_dir, "documents"), part)
    return scores.select("doc_id", (F.col("part") == interpolated_lm.SCORED).alias("held_out"), "n_tokens", "n_known",
                         F.lit(totals.tokens[1]).cast("long").alias("train_tokens"), "base_score", "score")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(*damaged(table(spark, sf_dir, "conversations")))[0]


def damaged(turns: DataFrame) -> tuple[DataFrame, Column]:
    """The turns with the faults of the contract, and how often each row counts."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    role = F.when(kind == 4, "user").otherwise(known("role"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies")), F.col("copies")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    tampered = {"text": F.when(is_even, F.translate("text", "\n", "")).otherwise(F.col("text"))}
    return merkle.manifest(table(spark, sf_dir, "documents"), changed=tampered).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof().alias("proof_sha256"), "folded_root", "verified")


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_benchmark_decontamination, op3_license_scans, op4_quotation_linking, op5_warc_transactions,
    op6_minhash_near_dedup, op7_embedding_near_dedup, op8_byte_sharding, op9_language_id, op10_byte_bpe,
    op11_interpolated_lm, op12_conversation_repair, op13_merkle_manifest,
)}
ORACLES = {
    "op2_benchmark_decontamination": oracles.DECONTAMINATION,
    "op3_license_scans": oracles.licenses(),
    "op5_warc_transactions": oracles.WARC,
    "op6_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op7_embedding_near_dedup": oracles.VECTORS,
    "op12_conversation_repair": oracles.CONVERSATIONS,
    "op13_merkle_manifest": oracles.MERKLE,
}
