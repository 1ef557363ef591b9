"""Removal of long passages that repeat across documents, by prefix-partitioned suffix trees over words.

A window is WINDOW consecutive words. Its anchor is its smallest GRAM-word hash, so equal windows have equal anchors at
equal offsets, and only suffixes that begin at an anchor are needed (one in about twenty). Anchors that only one document has
are left out, and of occurrences with equal surroundings those of larger documents are removed at once. The other suffixes
are split by prefixes of variable length until a group fits GROUP_BYTES:

1. by the GRAM words of the anchor;
2. a group that is too large by LONGER words around the anchor: windows that begin less than HALF words before it by the words
   after it, the others by the HALF words before it as well;
3. a group that still is too large by the whole window. Then a group is a single node of its tree, which needs no more than
   its smallest document, a minimum that tasks combine before they shuffle.

A group that fits is made into one tree in one task, held as sorted suffixes with their common prefix lengths; a second tree
holds what stands before the anchors, read backwards. A deep node of one tree with a node of the other is one repeated window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm._bytes import SPACED, as_binary, blob_table, mix, powers, ragged, runs, spans, tidy, window_hashes, word_hashes
from terrane.llm._shared import partitions, small_batches, stored

WINDOW, GRAM = 50, 8
HALF = (WINDOW - GRAM + 1) // 2
LONGER = GRAM + HALF
#: Bytes of the two matrices that a group's trees are read from, which bounds its suffixes: a row holds the group and the
#: words from the anchor on, and the group and the words before it.
GROUP_BYTES = 3 << 20
ROW_BYTES = 8 * (WINDOW + 1 + WINDOW - GRAM + 1)
_NULL = (1 << 63) - 1


def _most() -> int:
    return max(2, GROUP_BYTES // ROW_BYTES)


def _hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of some texts, and where each text's begin."""
    starts, ends, at = spans(data, offsets, SPACED)
    return word_hashes(data, starts, ends), at


def _anchored(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same anchor occurrence: first window, number of windows, anchor place, anchor hash."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if len(words) < WINDOW:
        return none
    gram = window_hashes(words, GRAM)
    bits = max(20, int(len(gram)).bit_length())
    low = (np.uint64(1) << np.uint64(bits)) - np.uint64(1)
    least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)  # the leftmost of equal hashes
    wide, width = WINDOW - GRAM + 1, 1
    while 2 * width <= wide:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    n = len(words) - WINDOW + 1
    least = np.minimum(least[:n], least[wide - width : wide - width + n])
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    valid = owner[:n] == owner[WINDOW - 1 :]
    place = (least & low).astype(np.int64)
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (place[1:] != place[:-1]) | (owner[1:n] != owner[: n - 1])
    first = np.flatnonzero(begin)
    if not len(first):
        return none
    number = np.add.reduceat(valid.astype(np.int64), first)
    return first, number, place[first], gram[place[first]]


def _spans_hash(words: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the words of each span; spans may overlap."""
    power, inverse = powers(3, len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power, out=total[1:])
    return mix((total[first + length] - total[first]) * inverse[first] + length.astype(np.uint64))


_RUN = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("key", pa.int64()), ("id", pa.int64()), ("pos", pa.int32()), ("off", pa.int32()), ("n", pa.int32())])
_RUN_SQL = "anchor long, ctx long, key long, id long, pos int, off int, n int"


def occurrences(keyed: DataFrame) -> DataFrame:
    """Runs of n windows with the same anchor: the first begins at word pos of its text, the anchor off words later; ctx is a
    hash of all words of the run."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, own = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for row, offsets, data in runs(batch.column(2)):
                words, at = _hash_words(data, offsets)
                first, number, place, anchor = _anchored(words, at)
                if len(first):
                    text = np.searchsorted(at, first, "right") - 1
                    ctx = _spans_hash(words, first, number + WINDOW - 1)
                    yield blob_table(_RUN, {"anchor": anchor.view(np.int64), "ctx": ctx.view(np.int64), "key": key[row + text], "id": own[row + text], "pos": (first - at[text]).astype(np.int32), "off": (place - first).astype(np.int32), "n": number.astype(np.int32)})

    return keyed.mapInArrow(tidy(work), _RUN_SQL)


_SPAN_SQL = "level int, g long, key long, id long, pos int, off int, n int, body binary"
_SPAN = pa.schema([("level", pa.int32()), ("g", pa.int64()), ("key", pa.int64()), ("id", pa.int64()), ("pos", pa.int32()), ("off", pa.int32()), ("n", pa.int32()), ("body", pa.binary())])


def _fetched(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of the wanted runs, by their group: that of the anchor (level 1), or for anchors with too many suffixes
    (large) that of LONGER words around it (level 2), for which a run is parted at HALF."""
    per_text = wanted.groupBy("key", "id").agg(F.collect_list(F.struct("large", "anchor", "pos", "off", "n")).alias("want"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want, where = b.column("want").values, b.column("want").offsets.to_numpy()
            cols = {f: np.asarray(want.field(f)) for f in ("anchor", "pos", "off", "n")}
            large = np.asarray(want.field("large"))
            keys, ids = np.asarray(b.column("key")), np.asarray(b.column("id"))
            for i, body in enumerate(as_binary(b.column("text"))):
                data = np.frombuffer(body.as_py(), np.uint8)
                starts, ends, _ = spans(data, np.array([0, len(data)]), SPACED)
                mine = slice(where[i], where[i + 1])
                anchor, pos, off, n = (cols[f][mine].astype(np.int64) for f in ("anchor", "pos", "off", "n"))
                big = large[mine]
                yield rows(1, anchor[~big], keys[i], ids[i], pos[~big], off[~big], n[~big], data, starts, ends)
                if big.any():
                    words = word_hashes(data, starts, ends)
                    anchor, pos, off, n = anchor[big], pos[big], off[big], n[big]
                    # windows that begin HALF words before the anchor or more
                    early = np.clip(off - HALF + 1, 0, n)
                    for some, skip, size, shift in ((early > 0, 0 * early, early, HALF), (early < n, early, n - early, 0)):
                        a, q = anchor[some], (pos + skip)[some]
                        o = (off - skip)[some]
                        around = _spans_hash(words, q + o - shift, np.full(len(q), LONGER))
                        g = mix(a.view(np.uint64) ^ mix(around + np.uint64(shift)))
                        yield rows(2, g.view(np.int64), keys[i], ids[i], q, o, size[some], data, starts, ends)

    def rows(level: int, g: np.ndarray, key: int, own: int, pos: np.ndarray, off: np.ndarray, n: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        text = [data[a:z].tobytes() for a, z in zip(starts[pos].tolist(), ends[pos + n + WINDOW - 2].tolist(), strict=True)]
        full = lambda v: np.full(len(pos), v, np.int64)
        return blob_table(_SPAN, {"level": np.full(len(pos), level, np.int32), "g": g, "key": full(key), "id": full(own), "pos": pos.astype(np.int32), "off": off.astype(np.int32), "n": n.astype(np.int32), "body": pa.array(text, pa.binary())})

    return keyed.join(per_text, ["key", "id"]).mapInArrow(tidy(work), _SPAN_SQL)


_WHOLE = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("key", pa.int64()), ("id", pa.int64()), ("pos", pa.int32())])


def _whole(rows: DataFrame) -> DataFrame:
    """Every window of some runs by two hashes of its words."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, own, pos, n = (np.asarray(b.column(f)).astype(np.int64) for f in ("key", "id", "pos", "n"))
            for first, offsets, data in runs(b.column("body")):
                starts, ends, at = spans(data, offsets, SPACED)
                some = slice(first, first + len(offsets) - 1)
                where = ragged(at[:-1], n[some])
                of = np.repeat(np.arange(len(offsets) - 1), n[some])
                h1, h2 = (window_hashes(word_hashes(data, starts, ends, k), WINDOW, k)[where].view(np.int64) for k in (0, 1))
                yield blob_table(_WHOLE, {"h1": h1, "h2": h2, "key": key[some][of], "id": own[some][of], "pos": (pos[some][of] + where - at[:-1][of]).astype(np.int32)})

    return rows.select("key", "id", "pos", "n", "body").mapInArrow(tidy(work), "h1 long, h2 long, key long, id long, pos int")


def _sorted_suffixes(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the common prefix length of each sorted row with the one before it."""
    width = matrix.shape[1]
    flat = np.ascontiguousarray(matrix.astype(">u8"))
    order = np.argsort(flat.view(f"V{8 * width}").ravel(), kind="stable")
    ranked = matrix[order]
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = ranked[1:] != ranked[:-1]
        lcp[1:] = np.where(differ.any(1), differ.argmax(1), width)
    return order, lcp


def deep_nodes(words: np.ndarray, at: np.ndarray, off: np.ndarray, n: np.ndarray, group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, window number in the row's run) of windows that a smaller key has too, from the two trees of each group.

    Row i's span is words[at[i]:at[i + 1]], its anchor stands at off[i], and its windows start at its first n[i] words."""
    rows = len(off)
    forward, backward = np.zeros((rows, WINDOW + 1), np.uint64), np.zeros((rows, WINDOW - GRAM + 1), np.uint64)
    forward[:, 0] = backward[:, 0] = group
    step = np.arange(WINDOW)
    place = at[:-1, None] + off[:, None] + step
    inside = place < at[1:, None]
    forward[:, 1:][inside] = words[place[inside]]
    step = np.arange(WINDOW - GRAM)
    place = at[:-1, None] + off[:, None] - 1 - step
    inside = step < off[:, None]
    backward[:, 1:][inside] = words[place[inside]]
    order_f, lcp_f = _sorted_suffixes(forward)
    order_b, lcp_b = _sorted_suffixes(backward)
    node_f, node_b = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    hit_row, hit_window = [], []
    for before in range(WINDOW - GRAM + 1):
        has = np.flatnonzero((off >= before) & (off - before < n))
        if len(has) < 2:
            continue
        # nodes at these depths (the group's column counts as one more)
        node_f[order_f] = np.cumsum(lcp_f < WINDOW - before + 1)
        node_b[order_b] = np.cumsum(lcp_b < before + 1)
        both = node_f[has] * (rows + 1) + node_b[has]
        order = np.lexsort((key[has], both))
        both, who = both[order], has[order]
        new = np.append(True, both[1:] != both[:-1])
        least = key[who][np.maximum.accumulate(np.where(new, np.arange(len(who)), 0))]
        gone = who[key[who] > least]
        hit_row.append(gone)
        hit_window.append(off[gone] - before)
    if not hit_row:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hit_row), np.concatenate(hit_window)


_CUT = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("first", pa.int32()), ("words", pa.int32())])
_CUT_SQL = "key long, id long, first int, words int"


def _trees(runs_df: DataFrame) -> DataFrame:
    """Windows to remove, found by the trees of whole groups; a task sorts some groups together, a bounded number of rows."""
    rows = runs_df.select("g", "key", "id", "pos", "off", "n", "body").repartition(2 * partitions(runs_df.sparkSession), "g").sortWithinPartitions("g")
    most = _most()

    def grow(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        g = np.asarray(table.column("g").chunk(0))
        parts, bounds = [], [np.zeros(1, np.int64)]
        for _, offsets, data in runs(table.column("body").chunk(0)):
            words, at = _hash_words(data, offsets)
            parts.append(words)
            bounds.append(at[1:] + bounds[-1][-1])
        group = np.cumsum(np.append(0, g[1:] != g[:-1]))
        col = {f: np.asarray(table.column(f).chunk(0)).astype(np.int64) for f in ("key", "id", "pos", "off", "n")}
        row, window = deep_nodes(np.concatenate(parts), np.concatenate(bounds), col["off"], col["n"], group, col["key"])
        order = np.lexsort((window, row))
        row, window = row[order], window[order]
        # neighbouring windows of a row make one cut
        new = np.append(True, (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1))[: len(row)]
        begin = np.flatnonzero(new)
        if len(begin):
            length = np.diff(np.append(begin, len(row)))
            r = row[begin]
            yield blob_table(_CUT, {"key": col["key"][r], "id": col["id"][r], "first": (col["pos"][r] + window[begin]).astype(np.int32), "words": (length + WINDOW - 1).astype(np.int32)})

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for b in batches:
            # long batches are cut so that the matrices stay small
            for i in range(0, len(b), 2000):
                kept.append(b.slice(i, 2000))
                size += len(kept[-1])
                if size > 3 * most:
                    table = pa.Table.from_batches(kept)
                    g = table.column("g").to_numpy()
                    last = int(np.searchsorted(g, g[-1]))
                    if last:
                        yield from grow(table.slice(0, last))
                        kept = table.slice(last).to_batches()
                        size = len(table) - last
        if kept and size:
            yield from grow(pa.Table.from_batches(kept))

    return rows.mapInArrow(tidy(work), _CUT_SQL)


def _shared(of: DataFrame, by: str) -> DataFrame:
    """The groups that more than one document has, with their numbers of rows. Stored, so that a join with it is a stage of
    its own, in which adaptive execution can split a frequent group."""
    return stored(of.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("a"), F.max("key").alias("z")).where("a < z").select(by, "rows"), "groups")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, id, first, words, by: spans of words that start in a document with a smaller key too, and which step found them
    (0 equal surroundings; 1, 2, 3 groups of the three prefixes). id is a hash of the text, which tells rows that repeat a key
    apart; the key of a null id is larger than all others."""
    small_batches(docs.sparkSession)
    keyed = docs.select(_key(key).alias("key"), _id(text).alias("id"), F.col(text).alias("text"))
    found = stored(occurrences(keyed), "anchors")
    met = stored(found.join(_shared(found, "anchor").select("anchor"), "anchor", "left_semi"), "shared")
    around = ["anchor", "ctx", "off", "n"]
    least = stored(met.groupBy(*around).agg(F.min("key").alias("least")), "least")
    met = stored(met.join(least, around).select("*", (F.col("key") > F.col("least")).alias("covered")), "covered")
    covered = met.where("covered").select("key", "id", F.col("pos").alias("first"), (F.col("n") + WINDOW - 1).alias("words"), F.lit(0).alias("by"))
    rest = met.where("not covered").select("anchor", "key", "id", "pos", "off", "n")
    wanted = rest.join(_shared(rest, "anchor"), "anchor").withColumn("large", F.col("rows") > _most())
    spans_ = stored(_fetched(keyed, wanted), "spans")
    second = spans_.where("level = 2")
    second = stored(second.join(_shared(second, "g"), "g"), "longer")
    windows = stored(_whole(second.where(F.col("rows") > _most())), "windows")
    one = stored(windows.groupBy("h1", "h2").agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a < z"), "least")
    third = windows.join(one, ["h1", "h2"]).where("key > a").select("key", "id", F.col("pos").alias("first"), F.lit(WINDOW).alias("words"), F.lit(3).alias("by"))
    first = _trees(spans_.where("level = 1")).withColumn("by", F.lit(1))
    second = _trees(second.where(F.col("rows") <= _most())).withColumn("by", F.lit(2))
    return covered.unionByName(first).unionByName(second).unionByName(third)


def _key(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(_NULL))


def _id(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "kept_text") -> DataFrame:
    """Every row with n_words, n_removed and `out`: the kept words joined by one space.

    A word goes if a window over it also starts in a document with a smaller id; windows are judged on the input. Texts of
    fewer than WINDOW words, empty and null ones lose nothing. Ids are read as longs (an id that is no number fails the cast); a
    null id counts as larger than all others. Rows that repeat an id, or have none, don't remove words from each other. An
    empty table gives an empty table. Columns named like the new ones are an error."""
    clash = {out, "n_words", "n_removed", "_key", "_id", "_cuts"} & set(docs.columns)
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    cuts = repeats(docs, key, text).groupBy(F.col("key").alias("_key"), F.col("id").alias("_id")).agg(F.collect_list(F.struct("first", "words")).alias("_cuts"))
    joined = docs.withColumn("_key", _key(key)).withColumn("_id", _id(text)).join(cuts, ["_key", "_id"], "left").select(*docs.columns, "_cuts")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = b.column("_cuts")
            where, there = cut.offsets.to_numpy(), np.asarray(cut.is_valid())
            begins, lengths = (np.asarray(cut.values.field(f)) for f in ("first", "words"))
            rest = b.drop_columns(["_cuts"])
            texts, total, gone, first, size = [], [], [], 0, 0
            bodies = as_binary(b.column(b.schema.get_field_index(text)))
            for i, body in enumerate(bodies):
                words = body.as_py().split()
                keep = None
                if there[i]:
                    begin, length = begins[where[i] : where[i + 1]], lengths[where[i] : where[i + 1]]
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + length, -1)
                    keep = np.cumsum(change)[:-1] == 0
                    texts.append(b" ".join([words[k] for k in np.flatnonzero(keep)]))
                else:
                    texts.append(b" ".join(words))
                total.append(len(words))
                gone.append(0 if keep is None else int(len(words) - keep.sum()))
                size += len(texts[-1])
                if size > 8 << 20 or i + 1 == len(bodies):
                    part = rest.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], names=[*part.schema.names, "n_words", "n_removed", out])
                    texts, total, gone, first, size = [], [], [], i + 1, 0

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(tidy(work), f"{columns}, n_words long, n_removed long, `{out}` string")
