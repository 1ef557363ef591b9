"""Similarity join of documents by the Jaccard similarity of their word n-gram sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm import minhash
from terrane.llm._bytes import SPACED, blob_table, blobs, mix, ragged, runs, spans, tidy, window_hashes, word_hashes
from terrane.llm._shared import small_batches, stored

NGRAM, THRESHOLD, ROWS = 5, 0.8, 6
#: Bands that let a pair at the threshold meet with probability 0.998.
BANDS = minhash.bands_for(THRESHOLD, 0.998, ROWS)


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes (repeats included) and their bounds, number of words and a hash of all words of each text.
    A text of fewer than n words, but not none, has one shingle: all of them."""
    starts, ends, at = spans(data, offsets, SPACED)
    words = word_hashes(data, starts, ends)
    count = np.diff(at)
    whole = np.zeros(len(count), np.uint64)
    if len(words):
        some = np.flatnonzero(count)
        turned = words * np.uint64(0xD6E8FEB86659FD93)
        # position inside the text takes part, so the order of words does
        inside = (np.arange(len(words)) - np.repeat(at[:-1], count)).astype(np.uint64)
        whole[some] = np.add.reduceat(mix(turned ^ mix(inside)), at[:-1][some])
    whole = mix(whole + count.astype(np.uint64))
    window = window_hashes(words, n)
    lengths = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    out = np.zeros(bounds[-1], np.uint64)
    long = count >= n
    out[ragged(bounds[:-1][long], lengths[long])] = window[ragged(at[:-1][long], lengths[long])]
    short = (count > 0) & ~long
    out[bounds[:-1][short]] = whole[short]
    return out, bounds, count, whole


def shingler(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts, bounds = [], [np.zeros(1, np.int64)]
    for _, offsets, data in runs(bodies):
        s, b, _, _ = _sets(data, offsets, NGRAM)
        parts.append(s)
        bounds.append(b[1:] + bounds[-1][-1])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate(bounds)


_SIG = pa.schema([("id", pa.int64()), ("node", pa.int64()), ("n_words", pa.int64()), ("bands", pa.binary())])


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, node (hash of the word sequence), n_words, and band keys (null for a text without words) of every row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in runs(batch.column(1)):
                s, bounds, count, whole = _sets(data, offsets, NGRAM)
                some = np.flatnonzero(count)
                keys = np.zeros((len(count), BANDS), np.uint64)
                if len(some):
                    keys[some] = minhash.band_keys(s, np.append(bounds[:-1][some], bounds[-1]), BANDS, ROWS)
                packed = blobs(keys.ravel(), np.arange(len(count) + 1) * BANDS)
                packed = pa.array([v if c else None for v, c in zip(packed.to_pylist(), count.tolist(), strict=True)], pa.binary())
                yield blob_table(_SIG, {"id": batch.column(0).slice(first, len(count)), "node": whole.view(np.int64), "n_words": count.astype(np.int64), "bands": packed})

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(tidy(work), "id long, node long, n_words long, bands binary")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes). rows: id, node, n_words of every document. nodes: node, copies, links (documents with another word
    sequence that are similar, copies counted), class (smallest id reachable by links) and root (smallest node so reachable)
    of every word sequence.

    Words are what white space parts, unchanged. Equal word sequences are one node. Texts without words, null ones too,
    link with nothing and have no node row. A node whose ids are all null has its texts fetched by its hash."""
    small_batches(docs.sparkSession)
    sig = stored(signatures(docs, key, text), "signatures")
    worded = sig.where("bands is not null")
    nodes = stored(worded.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"), F.max("bands").alias("bands")), "nodes")
    clusters = stored(minhash.candidates(nodes), "clusters")
    wanted = clusters.join(nodes.select("node", "copies", "first"), "node").select("cluster", "node", F.col("copies").alias("weight"), "first")
    texts = docs.select(F.col(key).cast("long").alias("first"), F.col(text).alias("body"))
    bodies = wanted.where("first is not null").join(texts.where("first is not null"), "first")
    nameless = wanted.where("first is null")
    if nameless.take(1):
        hashed = _hashed(texts.where("first is null"))
        bodies = bodies.unionByName(nameless.join(hashed.dropDuplicates(["node"]), "node").select("first", "cluster", "node", "weight", "body"))
    verified = stored(minhash.verify(_own(bodies).select("cluster", "node", "weight", "body"), clusters, shingler, threshold), "verified")
    classed = nodes.select("node", "copies", "first").join(verified, "node", "left").select("node", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"), "first")
    least = classed.groupBy("root").agg(F.min("first").alias("class"))
    return sig.select("id", "node", "n_words"), classed.join(least, "root").select("node", "copies", "links", "class", "root")


def _hashed(texts: DataFrame) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, offsets, data in runs(b.column("body")):
                whole = _sets(data, offsets, NGRAM)[3]
                yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), b.column("body").slice(first, len(whole))], names=["node", "body"])

    return texts.select("body").mapInArrow(tidy(work), "node long, body string")


def with_node(docs: DataFrame, text: str = "text", out: str = "_node") -> DataFrame:
    """Every row with the node of its text in column `out`; texts without words have one that no node row has."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, offsets, data in runs(b.column(b.schema.get_field_index(text))):
                whole = _sets(data, offsets, NGRAM)[3].view(np.int64)
                part = b.slice(first, len(whole))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(whole)], names=[*part.schema.names, out])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(tidy(work), f"{columns}, `{out}` long")


def _own(bodies: DataFrame) -> DataFrame:
    """Only the texts that are the node's: rows that repeat an id may hold other texts."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, offsets, data in runs(b.column("body")):
                whole = _sets(data, offsets, NGRAM)[3].view(np.int64)
                part = b.slice(first, len(whole))
                yield part.filter(pa.array(whole == np.asarray(part.column("node"))))

    return bodies.select("cluster", "node", "weight", "body").mapInArrow(tidy(work), "cluster long, node long, weight long, body string")
