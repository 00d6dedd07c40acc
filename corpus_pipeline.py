"""A training corpus from ``documents``: five stages of the operators in :mod:`meterline.llm`.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that go on, as rows of the columns of
``documents``; the last one returns their shards.  :func:`run` writes every stage's rows to the shared
folder and the next one reads them, so that a lost executor costs at most a stage.

* ``quality``: trees learn ``labels.quality`` from the stage's labelled documents; rejected documents go.
* ``near_duplicates``: of documents that links of five-word shingles (Jaccard 0.8 or more) connect, the
  smallest doc_id stays.  Documents without words are kept.
* ``decontamination``: documents that hold a window of a benchmark item go.
* ``mixing``: a document stays as often as the mix of sources takes it (0 to 3 times).
* ``sharding``: 40 shards of equal row counts along a Hilbert curve.

Rows with a null doc_id pass the second stage as they are.  Rows that repeat an id are judged by their own texts there: of
rows of one id in a group the first in the order of the other columns (nulls first) stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import decontaminate, hilbert, mixing, ngram_join, quality
from meterline.llm.common import keep, spread, table, written
from meterline.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _other(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "doc_id"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, carry=_other(docs)).where("score >= 0.5").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1").isEmpty():
        found = ngram_join.ngram_jaccard_join(docs, k=5, threshold="0.8")
        goes = found.where("component_id is not null and doc_id != component_id").select("doc_id")
        return docs.join(goes, "doc_id", "left_anti").select(*docs.columns)
    # Ids that repeat don't tell rows apart, so the rows get numbers, and each group's first row stays.
    rows = written(docs.withColumn("row", F.monotonically_increasing_id()))
    found = ngram_join.ngram_jaccard_join(
        rows.where("doc_id is not null").select(F.col("row").alias("doc_id"), "text"), k=5, threshold="0.8")
    groups = keep(found.select(F.col("doc_id").alias("row"), "component_id"))
    several = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    members = rows.join(groups.join(spread(several), "component_id"), "row")
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", *_other(docs), "row")).alias("first"))
    goes = (groups.join(spread(first.select("component_id", F.col("first.row").alias("stays"))), "component_id")
            .where("row != stays").select("row"))
    return rows.join(goes, "row", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=_other(docs))
    return found.where("n_hit = 0").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(docs, carry=[c for c in _other(docs) if c != "source"])
    return (mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*docs.columns))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + hilbert.OVERHEAD
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        "doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"),
        hilbert.text_level("source").alias("source_level"), hilbert.text_level("lang").alias("lang_level"),
        hilbert.size_level(size).alias("size_level"))
    placed = hilbert.hilbert_shards(rows, ["source_level", "lang_level", "size_level"], ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage), ("sharding", sharding_stage)]

#: A trained classifier and hashes that SQL lacks: tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, "pipeline", f"{i}_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
