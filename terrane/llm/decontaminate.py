"""Benchmark decontamination through a positional inverted index.

Training texts are cut into segments of whole texts. Each segment has one row a term with the term's sorted positions, and
a directory row; texts in a segment lie one position apart, so no phrase crosses them. A query takes, in every segment, the
rarest term of each benchmark phrase first and intersects the other terms' positions, adjusted by their offsets, from rare
to frequent. With a slop, a term may stand that many places off: proximity matches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._bytes import ALNUM, LOWER, blob_table, blobs, ragged, runs, spans, tidy, word_hashes
from terrane.llm._shared import small_batches, stored

SEGMENT = 4 << 20
#: Phrases that one pass over the index looks for; more are taken in further passes, each broadcast being so bounded.
PHRASES = 200_000
_INDEX = pa.schema([("segment", pa.int64()), ("term", pa.int64()), ("n", pa.int32()), ("postings", pa.binary())])
_INDEX_SQL = "segment long, term long, n int, postings binary"
_DIRECTORY = np.dtype([("id", "<i8"), ("known", "<i4"), ("start", "<i4"), ("words", "<i4")])


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all whole texts (null: no words): term postings, and a directory row (term null) a segment.

    Built without a shuffle. A text longer than a segment is a segment of its own. Repeated keys are separate texts."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys = batch.column(0)
            known = np.asarray(keys.is_valid())
            ids = np.asarray(keys.fill_null(0).cast(pa.int64()))
            for first, offsets, data in runs(batch.column(1), SEGMENT):
                n = len(offsets) - 1
                data = LOWER[data]
                starts, ends, at = spans(data, offsets, ALNUM)
                terms = _hashes(data, starts, ends).view(np.int64)
                words = np.diff(at)
                place = np.arange(len(terms), dtype=np.uint32) + np.repeat(np.arange(n, dtype=np.uint32), words)
                order = np.argsort(terms, kind="stable")
                terms, place = terms[order], place[order]
                cut = np.flatnonzero(np.diff(terms, prepend=terms[:1] ^ 1)) if len(terms) else np.zeros(0, np.int64)
                bounds = np.append(cut, len(terms))
                directory = np.zeros(n, _DIRECTORY)
                directory["id"], directory["known"], directory["words"] = ids[first : first + n], known[first : first + n], words
                directory["start"] = at[:-1] + np.arange(n)
                yield blob_table(_INDEX, {"segment": [number], "term": [None], "n": [n], "postings": [directory.tobytes()]})
                step = 20_000
                for i in range(0, len(cut), step):
                    b = bounds[i : i + step + 1]
                    yield blob_table(_INDEX, {"segment": np.full(len(b) - 1, number), "term": terms[b[:-1]], "n": np.diff(b).astype(np.int32), "postings": blobs(place[b[0] : b[-1]], b - b[0])})
                number += 1

    return stored(docs.select(F.col(key), F.col(text)).mapInArrow(tidy(work), _INDEX_SQL), "postings")


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word hashes, in runs so that the temporaries stay small."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(0, len(starts), 1 << 17):
        j = min(i + (1 << 17), len(starts))
        lo, hi = starts[i], ends[j - 1]
        out[i:j] = word_hashes(data[lo:hi], starts[i:j] - lo, ends[i:j] - lo)
    return out


def phrases(items: DataFrame, key: str = "item_id", text: str = "text", length: int = 13) -> Iterator[list[tuple]]:
    """Blocks of (item, term hashes): all runs of `length` words of each item, or all its words if it has fewer.

    Items stream to the driver a partition at a time and are handed on in blocks of at most PHRASES phrases."""
    block: list[tuple] = []
    for row in items.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).toLocalIterator():
        data = LOWER[np.frombuffer((row.t or "").encode(), np.uint8)]
        starts, ends, _ = spans(data, np.array([0, len(data)]), ALNUM)
        if not len(starts):
            continue
        h = _hashes(data, starts, ends).view(np.int64)
        for i in range(max(1, len(h) - length + 1)):
            block.append((row.k if row.k is not None else "null", h[i : i + length]))
            if len(block) >= PHRASES:
                yield block
                block = []
    if block:
        yield block


_FOUND = pa.schema([("segment", pa.int64()), ("doc", pa.int32()), ("item", pa.string()), ("first", pa.int32()), ("words", pa.int32())])
_FOUND_SQL = "segment long, doc int, item string, first int, words int"


def find(index: DataFrame, block: list[tuple], slop: int = 0) -> DataFrame:
    """Where phrases of one block occur: segment, text number in it, item, first word and number of words.

    slop 0 finds exact phrases; otherwise each term but the rarest may stand up to `slop` places from its own."""
    spark = index.sparkSession
    longest = max(len(h) for _, h in block)
    vocabulary = np.unique(np.concatenate([h for _, h in block]))
    matrix = np.full((len(block), longest), -1, np.int32)
    for i, (_, h) in enumerate(block):
        matrix[i, : len(h)] = np.searchsorted(vocabulary, h)
    names = [k for k, _ in block]
    # equal phrases of the same item are looked for once
    matrix, at = np.unique(np.column_stack([matrix, np.unique(names, return_inverse=True)[1].astype(np.int32)]), axis=0, return_index=True)
    matrix, names = matrix[:, :-1], [names[i] for i in at]
    shared = spark.sparkContext.broadcast((vocabulary, matrix, names))
    wanted = spark.createDataFrame(pa.table({"term": pa.array(vocabulary)}))
    postings = index.join(F.broadcast(wanted), "term", "left_semi").unionByName(index.where("term is null"))

    def work(table: pa.Table) -> pa.Table:
        vocabulary, matrix, names = shared.value
        table = table.combine_chunks()
        terms = table.column("term").to_pylist()
        blob = table.column("postings").to_pylist()
        where = terms.index(None)
        directory = np.frombuffer(blob[where], _DIRECTORY)
        lists: dict[int, np.ndarray] = {}
        rest = [i for i in range(len(terms)) if i != where]
        for k, i in zip(np.searchsorted(vocabulary, np.array([terms[i] for i in rest], np.int64)).tolist(), rest, strict=True):
            lists[k] = np.frombuffer(blob[i], np.uint32)
        hits = _intersect(lists, matrix, len(vocabulary), slop)
        segment = table.column("segment")[0].as_py()
        doc = np.searchsorted(directory["start"], hits[1], "right") - 1
        first = hits[1] - directory["start"][doc] if len(doc) else hits[1]
        size = (matrix[hits[0]] >= 0).sum(1)
        # a phrase that is found by slop may reach over its text; an empty text shares its start with the next
        good = (first >= 0) & (first + size <= directory["words"][doc]) if len(doc) else np.zeros(0, bool)
        picked = hits[0][good]
        return pa.table([np.full(len(picked), segment), doc[good].astype(np.int32), [names[i] for i in picked], first[good].astype(np.int32), size[good].astype(np.int32)], schema=_FOUND)

    return postings.groupBy("segment").applyInArrow(work, _FOUND_SQL)


def _intersect(lists: dict[int, np.ndarray], matrix: np.ndarray, n_terms: int, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start) of the matches in one segment, by intersecting position lists from the rarest term on."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    present = sorted(lists)
    if not present:
        return none
    count = np.zeros(n_terms + 1, np.int64)
    count[present] = [len(lists[k]) for k in present]
    positions = np.concatenate([lists[k] for k in present]).astype(np.int64)
    begin = np.zeros(n_terms + 1, np.int64)
    begin[present] = np.concatenate(([0], np.cumsum(count[present])[:-1]))
    coded = np.repeat(np.array(present, np.int64), count[present]) << 33 | positions
    cost = np.where(matrix >= 0, count[matrix], np.iinfo(np.int64).max)
    live = np.flatnonzero(cost.min(1) > 0)
    if not len(live):
        return none
    order = np.argsort(cost[live], axis=1, kind="stable")
    rare = matrix[live, order[:, 0]]
    phrase = np.repeat(np.arange(len(live)), count[rare])
    start = positions[ragged(begin[rare], count[rare])] - np.repeat(order[:, 0], count[rare])
    for turn in range(1, matrix.shape[1]):
        offset = order[phrase, turn]
        term = matrix[live[phrase], offset]
        want = (term.astype(np.int64) << 33) + start + offset
        at = np.searchsorted(coded, want - slop)
        at[at == len(coded)] = 0
        ok = (term < 0) | ((coded[at] >= want - slop) & (coded[at] <= want + slop)) & (start + offset >= 0)
        phrase, start = phrase[ok], start[ok]
        if not len(phrase):
            return none
    return live[phrase], start


def directory(index: DataFrame) -> DataFrame:
    """segment, doc, doc_id and number of words of every indexed text, from the directory rows."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for segment, blob in zip(b.column("segment").to_pylist(), b.column("postings").to_pylist(), strict=True):
                d = np.frombuffer(blob, _DIRECTORY)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), segment)), pa.array(np.arange(len(d), dtype=np.int32)), pa.array(d["id"], mask=d["known"] == 0), pa.array(d["words"].astype(np.int64))], names=["segment", "doc", "doc_id", "n_words"])

    return index.where("term is null").select("segment", "postings").mapInArrow(tidy(work), "segment long, doc int, doc_id long, n_words long")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", length: int = 13, slop: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any occurrence) and items (sorted ids, as strings) of every text.

    Texts without words have zeros and no items. Repeated ids give a row each. An item id that is null counts as 'null'."""
    small_batches(docs.sparkSession)
    index = build_index(docs, key, text)
    found = None
    for block in phrases(items, item, item_text, length):
        part = stored(find(index, block, slop), "matches")
        found = part if found is None else found.unionByName(part)
    texts = directory(index)
    if found is None:
        return texts.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    ends = F.array_sort(F.collect_set(F.struct("first", (F.col("first") + F.col("words")).alias("stop"))))
    covered = F.aggregate(
        "s", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("stop")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["first"], a["stop"]))).cast("long").alias("n"), F.greatest(a["stop"], x["stop"]).alias("stop")),
        lambda a: a["n"],
    )
    hit = found.groupBy("segment", "doc").agg(ends.alias("s"), F.array_sort(F.collect_set("item")).alias("items")).select("segment", "doc", covered.alias("n_hit"), "items")
    return texts.join(hit, ["segment", "doc"], "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
