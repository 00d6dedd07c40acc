"""One query per operator, with production parameters over the whole of its table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (align, chat_format, decontaminate, exact_dedup, hilbert, license_scan, lm_score, mixing, ngram_join,
               pack, prefix_trie, quality, warc)
from .common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.sha2(exact_dedup.normalised("text").cast("binary"), 256)
    return exact_dedup.exact_dedup(docs.select("doc_id", "text", digest.alias("text_sha256")), carry=["text_sha256"])


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"), k=4, threshold="0.85")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontaminate.items_digest("items").alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, where=quality.fold() != 1)
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(quality.fold() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_format.read_back(chat_format.chat_format(conversations))


def op7_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("binary")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + hilbert.OVERHEAD
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        hilbert.text_level("source").alias("source_level"), hilbert.text_level("lang").alias("lang_level"),
        hilbert.size_level(size).alias("size_level"))
    placed = hilbert.hilbert_shards(rows, ["source_level", "lang_level", "size_level"], ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_warc(manifest, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = prefix_trie.with_shared_openings(table(spark, sf_dir, "conversations"))
    nodes, members = prefix_trie.build(turns, conversations)
    none = F.lit(hashlib.sha256().hexdigest())
    return nodes.join(prefix_trie.ends_digest(members), "name", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))


def op13_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (op1_exact_dedup, op2_license_scan, op3_ngram_jaccard_join, op4_decontaminate, op5_quality_classifier,
            op6_chat_format, op7_hilbert_sharding, op8_lm_score, op9_mix_sources, op10_warc,
            op11_align_tokens, op12_prefix_trie, op13_pack)
    return {f.__name__: f for f in each}
