"""Fuzzy deduplication of lines across documents.

Lines that are equal become one node. MinHash signatures over shingles of 5 decoded characters are banded for high recall, lines
of a candidate cluster are compared on their full shingle sets, and distributed union-find gives the components; each
keeps its first line (smallest document id, then line number).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm import minhash
from terrane.llm._bytes import SPACED, blob_table, blobs, mix, ragged, runs, tidy, word_hashes
from terrane.llm._shared import discard, small_batches, stored

#: Characters a shingle. A changed character takes up to SHINGLE shingles from either line, so at 0.8 it still links lines of
#: 10 * SHINGLE - 1 = 49 characters or more (more if they repeat shingles). Fewer characters make unrelated lines alike: with
#: three, English texts of 150,000 characters have 0.81. ROWS keeps chance bands rare: on a sample of check_s, times 440,000
#: lines, a line meets 0.007 unrelated ones with 7 rows, 0.5 with 5 rows and, with four characters and 5 rows, 30.
SHINGLE, THRESHOLD, ROWS = 5, 0.8, 7
_BASE = np.uint64(0x9E3779B97F4A7C15)
BANDS = minhash.bands_for(THRESHOLD, 0.995, ROWS)
#: Bands lie in this many columns, which meet one after another, so that only one column's keys are shuffled at a time.
COLUMNS = 3


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number and number in its text of every line that holds more than white space. Lines end at a
    newline; the numbers count blank lines too."""
    breaks = np.flatnonzero(data == 10)
    # a text's end closes its last line; an empty text has one empty line
    ends = np.sort(np.concatenate([breaks, offsets[1:] - 0.5]))
    is_break = ends == np.floor(ends)
    stop = np.where(is_break, ends, ends + 0.5).astype(np.int64)
    start = np.empty_like(stop)
    start[:1] = 0
    start[1:] = stop[:-1] + is_break[:-1]
    text = np.concatenate(([0], np.cumsum(~is_break)[:-1])) if len(stop) else np.zeros(0, np.int64)
    first = np.searchsorted(text, np.arange(len(offsets) - 1))
    number = np.arange(len(stop)) - first[text] if len(stop) else stop
    inked = np.concatenate(([0], np.cumsum(SPACED[data])))
    keep = inked[stop] > inked[start]
    return start[keep], stop[keep], text[keep], number[keep]


def _shingles(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of SHINGLE characters of each line; a shorter line has one, of all its characters
    and their number."""
    begins = (data & 0xC0) != 0x80
    begins[start[start < len(data)]] = True
    place = np.flatnonzero(begins)
    number = np.concatenate(([0], np.cumsum(begins)))
    # a character is its bytes as an integer, counted from 1
    width = np.minimum(np.diff(np.append(place, len(data))), 4)
    every = np.ndarray((len(data) + 1,), "<u4", np.concatenate([data, np.zeros(4, np.uint8)]).tobytes(), strides=(1,))
    chars = np.zeros(len(place) + SHINGLE, np.uint64)
    chars[: len(place)] = every[place] & (np.uint32(0xFFFFFFFF) >> (32 - 8 * width).astype(np.uint32))
    chars[: len(place)] += np.uint64(1)
    first = number[start]
    length = number[stop] - first
    count = np.maximum(length - SHINGLE + 1, 1)
    bounds = np.concatenate(([0], np.cumsum(count)))
    hashed = np.full(len(place) + 1, SHINGLE, np.uint64)
    for j in range(SHINGLE):
        hashed *= _BASE
        hashed += chars[j : j + len(hashed)]
    out = hashed[ragged(first, count)]
    short = np.flatnonzero(length < SHINGLE)
    low = length[short].astype(np.uint64)
    for j in range(SHINGLE):
        low *= _BASE
        low += np.where(j < length[short], chars[first[short] + j], np.uint64(0))
    out[bounds[short]] = low
    return out, bounds


def shingler(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts, bounds = [], [np.zeros(1, np.int64)]
    for _, offsets, data in runs(bodies):
        s, b = _shingles(data, offsets[:-1], offsets[1:])
        parts.append(s)
        bounds.append(b[1:] + bounds[-1][-1])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate(bounds)


_LINE = pa.schema([("node", pa.int64()), ("key", pa.int64()), ("line", pa.int32()), *[(f"bands{c}", pa.binary()) for c in range(COLUMNS)]])


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key and text. A row without an id is keyed by a hash of its text, below all non-negative ids' negatives."""
    nameless = -1 - F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 1)
    return docs.select(F.coalesce(F.col(key).cast("long"), nameless).alias("key"), F.col(text).alias("text"))


def signatures(keyed: DataFrame) -> DataFrame:
    """node (hash of the line), key, line and band keys of the lines; equal lines of a run of texts are told once."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for first, offsets, data in runs(batch.column(1)):
                start, stop, text, number = lines_of(data, offsets)
                if not len(start):
                    continue
                node = word_hashes(data, start, stop).view(np.int64)
                order = np.lexsort((number, ids[first + text], node))
                order = np.sort(order[np.append(True, np.diff(node[order]) != 0)])
                start, stop, text, number, node = start[order], stop[order], text[order], number[order], node[order]
                parts, i = [], 0
                while i < len(start):
                    j = max(i + 1, int(np.searchsorted(stop, start[i] + minhash.CACHED, "right")))
                    s, bounds = _shingles(data[start[i] : stop[j - 1]], start[i:j] - start[i], stop[i:j] - start[i])
                    parts.append(minhash.band_keys(s, bounds, BANDS, ROWS))
                    i = j
                keys = np.concatenate(parts)
                columns = {f"bands{c}": blobs(k.ravel(), np.arange(len(k) + 1) * k.shape[1]) for c, k in enumerate(np.array_split(keys, COLUMNS, axis=1))}
                yield blob_table(_LINE, {"node": node, "key": ids[first + text], "line": number.astype(np.int32), **columns})

    return keyed.mapInArrow(tidy(work), ", ".join(["node long, key long, line int", *[f"bands{c} binary" for c in range(COLUMNS)]]))


_SPAN = pa.schema([("cluster", pa.int64()), ("node", pa.int64()), ("weight", pa.int64()), ("body", pa.binary())])


def _bodies(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text of the wanted lines: cluster, node, weight, body. wanted: key, line, node, cluster."""
    per_text = wanted.groupBy("key").agg(F.collect_list(F.struct("line", "node", "cluster")).alias("want"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = b.column("want")
            where = want.offsets.to_numpy()
            wanted_line, wanted_node, wanted_cluster = (np.asarray(want.values.field(x)) for x in ("line", "node", "cluster"))
            for first, offsets, data in runs(b.column("text")):
                start, stop, text, number = lines_of(data, offsets)
                lo, hi = where[first], where[first + len(offsets) - 1]
                owner = np.repeat(np.arange(len(offsets) - 1), np.diff(where[first : first + len(offsets)]))
                have, sought = text << 32 | number, owner << 32 | wanted_line[lo:hi].astype(np.int64)
                at = np.searchsorted(have, sought)
                there = np.flatnonzero(np.append(have, -1)[at] == sought)
                at = at[there]
                # rows that repeat an id may hold other lines at these numbers
                same = word_hashes(data, start[at], stop[at]).view(np.int64) == wanted_node[lo:hi][there]
                at, there = at[same], there[same]
                size = stop[at] - start[at]
                body = blobs(data[ragged(start[at], size)], np.concatenate(([0], np.cumsum(size))))
                yield blob_table(_SPAN, {"cluster": wanted_cluster[lo:hi][there], "node": wanted_node[lo:hi][there], "weight": np.ones(len(at), np.int64), "body": body})

    return keyed.join(per_text, "key").select("text", "want").mapInArrow(tidy(work), "cluster long, node long, weight long, body binary")


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(lines, classes). lines: node, key, line of the first line of every distinct text of a line, and kept. classes:
    node and root node of the lines that are similar to others."""
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, key, text)
    # signatures stay where they were made: places are told apart by small rows, and candidates take repeated lines
    rows = stored(signatures(keyed), "signatures", "none")
    lines = stored(rows.groupBy("node").agg(F.min(F.struct("key", "line")).alias("at")).select("node", "at.key", "at.line"), "lines")
    clusters = stored(minhash.candidates(rows), "clusters")
    discard(rows)
    large = stored(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > minhash.BLOCK).select("cluster"), "large")
    if large.take(1):
        # most of a large cluster is tied by chance; comparing it whole would copy each text once a block
        wanted = lines.select("node", "key", "line").join(clusters.join(large, "cluster", "left_semi"), "node")
        clusters = clusters.join(large, "cluster", "left_anti").unionByName(minhash.parted(_bodies(keyed, wanted), shingler, BANDS, ROWS, threshold, COLUMNS))
    wanted = lines.select("node", "key", "line").join(clusters, "node")
    verified = stored(minhash.verify(_bodies(keyed, wanted), clusters, shingler, threshold).select("node", "root"), "verified")
    # a component keeps its first line, which need not be the node with the smallest hash
    placed = verified.join(lines.select("node", "key", "line"), "node")
    first = placed.groupBy("root").agg(F.min(F.struct("key", "line", "node")).alias("f"))
    lost = placed.join(first, "root").where("node <> f.node").select("node")
    return lines.select("node", "key", "line").join(lost.withColumn("lost", F.lit(True)), "node", "left").select("node", "key", "line", F.col("lost").isNull().alias("kept")), verified


def _without(data: np.ndarray, offsets: np.ndarray, owner: np.ndarray, line: np.ndarray, node: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The texts without the lines that aren't among the kept ones (owner: number of the text), the numbers of the lines
    that went, and where each text's begin in them. A removed line takes its newline along, the last one the newline
    before it; a text that keeps none of its lines becomes empty."""
    start, stop, text, number = lines_of(data, offsets)
    place = lambda of, at, what: mix((of << 32 | at).astype(np.uint64)) ^ what.view(np.uint64)
    gone = ~np.isin(place(text, number, word_hashes(data, start, stop).view(np.int64)), place(owner, line.astype(np.int64), node))
    n = len(offsets) - 1
    lost = np.bincount(text[gone], minlength=n)
    emptied = (lost > 0) & (lost == np.bincount(text, minlength=n))
    end = offsets[text + 1]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start[gone]] += 1
    edge[np.minimum(stop + 1, end)[gone]] -= 1
    stays = (np.cumsum(edge[:-1], dtype=np.int8) == 0) & ~np.repeat(emptied, np.diff(offsets))
    tail = text[gone & (stop == end) & ~emptied[text]]
    breaks = np.flatnonzero((data == 10) & stays)
    stays[breaks[np.searchsorted(breaks, offsets[tail + 1]) - 1]] = False
    return blobs(data[stays], np.concatenate(([0], np.cumsum(stays)))[offsets]), number[gone], np.concatenate(([0], np.cumsum(lost)))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "kept_text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row with two columns more: `out`, the text without the lines that repeat another's, and removed_lines, their
    numbers from 0.

    Of a component of similar lines the one with the smallest document id, then line number, stays. Blank lines stay, but
    a text that loses all its other lines becomes empty. Null and empty texts give an empty `out` and no numbers. Rows
    that repeat an id are one document: a kept line stays in each row that has it at its place. Rows without an id are
    keyed by their text. Columns named like the new ones are an error."""
    clash = {out, "removed_lines", "_key", "_keep"} & set(docs.columns)
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    lines, _ = kept_lines(docs, key, text, threshold)
    keep = lines.where("kept").groupBy("key").agg(F.collect_list(F.struct("line", "node")).alias("_keep")).withColumnRenamed("key", "_key")
    nameless = -1 - F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 1)
    joined = docs.withColumn("_key", F.coalesce(F.col(key).cast("long"), nameless)).join(keep, "_key", "left").drop("_key")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = b.column("_keep")
            where = keep.offsets.to_numpy()
            line, node = np.asarray(keep.values.field("line")), np.asarray(keep.values.field("node"))
            rest = b.drop_columns(["_keep"])
            for first, offsets, data in runs(b.column(b.schema.get_field_index(text))):
                n = len(offsets) - 1
                mine = slice(where[first], where[first + n])
                owner = np.repeat(np.arange(n), np.diff(where[first : first + n + 1]))
                kept, numbers, bounds = _without(data, offsets, owner, line[mine], node[mine])
                part = rest.slice(first, n)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(numbers, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, kept.cast(pa.binary()).cast(pa.string()), lists], names=[*part.schema.names, out, "removed_lines"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.select(*docs.columns, "_keep").mapInArrow(tidy(work), f"{columns}, `{out}` string, removed_lines array<int>")
