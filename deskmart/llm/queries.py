"""Registered queries of the corpus operators, one per operator, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmart.llm import decontamination, html_extraction, mixing, prefix_trie, recurrent_lm, secrets, simhash_neardup, slot_sharding, suffix_dedup, syncmers, token_alignment, toxicity, warc
from deskmart.llm.common import read


def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_with_edits(read(spark, sf_dir, "documents"))


def op2_consensus_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_main_text(read(spark, sf_dir, "pages"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op4_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_neardup.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(read(spark, sf_dir, "pages")).filter("reason is null")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_sharding.shard_documents(read(spark, sf_dir, "documents"))


def op7_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_overlaps(docs, read(spark, sf_dir, "benchmark"), prefix="")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        decontamination.items_digest(F.col("items")).alias("items_sha256"),
        decontamination.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op8_subset_sum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("copies")


def op9_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op10_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[_count(kind) for kind in secrets.KINDS[:3]],
        F.sha2(secrets.digest(F.col("base")), 256).alias("base_sha256"),
        secrets.digest(F.col("spans")).alias("spans"),
    )


#: Folder of the public tokenizers' files.
TOKENIZERS = "/opt/tokenizers"


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_alignment.Tokenizers.load(f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    return token_alignment.align_documents(read(spark, sf_dir, "documents"), files)


def op12_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_syncmer_fingerprints,
        op2_consensus_extraction,
        op3_suffix_array_dedup,
        op4_simhash_neardup,
        op5_warc_salvage,
        op6_slot_sharding,
        op7_winnowing_decontamination,
        op8_subset_sum_mixing,
        op9_counterfactual_toxicity,
        op10_randomness_secrets,
        op11_cross_tokenizer_alignment,
        op12_recurrent_lm,
        op13_prefix_trie,
    )
}
