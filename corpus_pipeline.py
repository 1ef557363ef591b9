"""Clean a corpus: drop low quality, repeated lines, near copies and benchmark leaks, then encode what is left.

Every stage but the last takes documents and returns the columns of documents; a stage works on all that the one before
kept. Texts changed by a stage have their n_chars counted anew.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from terrane.llm._shared import shared_dir, stored

#: A document goes when the classifier finds it less likely than this to be of quality 1, as op10_quality predicts.
REJECT_BELOW = 0.5
#: The classifier learns from the rows whose crc32(doc_id as text) mod 3 isn't 1, as in its own query.
FOLDS, HELD_OUT = 3, 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the network rejects go. Rows without an id or a text are scored like any other."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.fit(docs, labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT))
    return quality.score(docs, net, out="_score").where(F.col("_score") >= REJECT_BELOW).drop("_score")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of similar lines one stays in the corpus. A document that loses all its lines goes; one that had none
    stays as it is."""
    done = line_dedup.dedup(docs, out="_kept").where((F.col("_kept") != "") | (F.size("removed_lines") == 0))
    changed = F.size("removed_lines") > 0
    done = done.withColumn("text", F.when(changed, F.col("_kept")).otherwise(F.col("text")))
    return done.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of documents linked by similarity the one with the smallest id stays. Texts without words and documents
    without links stay; rows that repeat the id of a document that stays, with a text of its group, stay too. Rows are judged
    each by its own text: rows without an id go when their group has an id, or all but one of the group's rows do."""
    rows, nodes = ngram_join.join(docs)
    lead = nodes.where("class is null").groupBy("root").agg(F.min("node").alias("lead"))
    fates = rows.join(nodes, "node").join(lead, "root", "left").where("id is null or id <> class")
    fates = stored(fates.select(F.col("id").alias("_id"), F.col("node").alias("_at"), F.coalesce(F.col("node") == F.col("lead"), F.lit(False)).alias("_lead")).distinct(), "fates")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_node") == F.col("_at"))
    stays = ngram_join.with_node(docs).join(fates, same, "left").where("_lead is null").select(*docs.columns)
    if not fates.where("_lead").take(1):
        return stays
    nameless = ngram_join.with_node(docs.where("doc_id is null")).join(fates.where("_lead").select("_at"), F.col("_node") == F.col("_at"))
    return stays.unionByName(nameless.dropDuplicates(["_node"]).select(*docs.columns))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents of which benchmark windows cover a twentieth of the words or more go. Rows are judged each by
    its own text, known by its 64-bit hash, so rows without an id go too, and rows that repeat an id go alone."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs.select(F.xxhash64("text").alias("_text"), "text"), items, key="_text")
    gone = found.where("n_hit > 0 and 20 * n_hit >= n_words").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.xxhash64("text") == F.col("_gone"), "left_anti").select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token ids of every text that is left, checked by decoding them."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    done = bpe.encode_and_decode(docs.select("doc_id", "text"), path, pattern)
    return done.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE encoding and decoding", encode_stage),
]

#: SQL can express neither the network nor MinHash banding; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each stage's rows written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = shared_dir(spark, f"stage-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
