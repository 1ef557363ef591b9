"""The queries op1 to op10 over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(key: str, n: int) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.llm import line_dedup

    done = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.size("removed_lines").cast("long").alias("n_removed"), "removed_lines", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from terrane.llm import bpe

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    done = bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    return done.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.llm import katz

    scored = katz.score(table(spark, sf_dir, "documents"), bucket("doc_id", 5) != 1).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", F.coalesce(bucket("doc_id", 5) == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.llm import decontaminate

    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


OP4_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
 iw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
 wins AS (SELECT DISTINCT item, list_slice(w, i, i + least(13, len(w)) - 1) AS p FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
 lens AS (SELECT DISTINCT len(p) AS n FROM wins),
 dwin AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS p FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
 hits AS (SELECT d.doc_id, d.i, d.n, x.item FROM dwin d JOIN wins x ON d.p = x.p),
 words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
 items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hits GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.llm import warc
    from terrane.llm._shared import shared_dir

    archives = warc.write(warc.link_revisits(table(spark, sf_dir, "pages")), shared_dir(spark, "warc"))
    return warc.read(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
 g AS (SELECT h, max(page_id) AS last FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
  CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN last <> page_id THEN last END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h
"""


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.llm import ngram_join

    rows, nodes = ngram_join.join(table(spark, sf_dir, "documents"))
    links = F.when(F.col("copies").isNull(), F.lit(0)).otherwise(F.col("links") + F.col("copies") - 1)
    return rows.join(nodes, "node", "left").select(F.col("id").alias("doc_id"), F.coalesce("class", "id").alias("class_id"), links.cast("long").alias("n_links"), "n_words")


def op7_virtual_slots(spark: SparkSession, sf_dir: str, shards: int = 40) -> DataFrame:
    from terrane.llm import sharding
    from terrane.llm._shared import shared_dir

    text = F.col("text").cast("binary")
    sized = table(spark, sf_dir, "documents").select("doc_id", (F.coalesce(F.length(text), F.lit(0)) + 16).cast("long").alias("size"), F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"))
    slotted = sharding.into_slots(sized, ["doc_id", "text_crc32"])
    load = sharding.measure(slotted, "size")
    slot_map = sharding.SlotMap(spark, shared_dir(spark, "slot-map"))
    slot_map.edit(load, shards)
    latest = slot_map.edit(load, shards, 0.0)
    placed = sharding.assign(slotted, latest, ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.llm import embedding_dedup

    done = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return done.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.llm import substring_dedup

    done = substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
 win AS (SELECT doc_id, i, list_slice(w, i, i + 49) AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
 least AS (SELECT p, min(doc_id) AS m FROM win GROUP BY p HAVING min(doc_id) < max(doc_id)),
 gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM (SELECT doc_id, i FROM win JOIN least USING (p) WHERE doc_id > m)),
 kept AS (SELECT u.doc_id, count(*) AS n, string_agg(u.x, ' ' ORDER BY u.k) AS s
          FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d) u ANTI JOIN gone g ON u.doc_id = g.doc_id AND u.k = g.k GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrane.llm import quality

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = quality.fit(docs, labels.where(bucket("doc_id", 3) != 1))
    scored = quality.score(docs.select("doc_id", "text"), net)
    return scored.select("doc_id", F.coalesce(bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": OP4_SQL, "op5_warc": OP5_SQL, "op9_substring_dedup": OP9_SQL}
