"""MinHash banding with exact verification, shared by the line and the document operators.

Candidates: items that agree on a band are tied to the smallest of them, which keeps every bucket linear in its size, and
the ties' components are the candidate clusters. Verification compares the full shingle sets of all items of a cluster, so
no pair that shares a band is lost. Clusters larger than BLOCK are compared block by block in tasks of their own.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._bytes import as_binary, blob_table, blobs, mix, tidy
from terrane.llm._shared import discard, partitions, stored
from terrane.llm.components import components, labels, reduced

BLOCK = 3000
#: Shingles that are hashed together: two arrays of this many 32-bit numbers fit a core's cache.
CACHED, LANES = 1 << 16, 8
_rng = np.random.default_rng(411)
#: Permutations of 32-bit numbers: products with odd factors. Shingles are mixed hashes, so no offset is needed (in 3000 pairs
#: at 0.8 each, 10 to 200 shingles, 23 bands of 7 met 0.995 to 0.997 without and 0.994 to 0.996 with one).
_A = _rng.integers(1, 1 << 31, 512, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def recall(similarity: float, bands: int, rows: int) -> float:
    """Chance that a pair of this similarity shares a band."""
    return 1 - (1 - similarity**rows) ** bands


def bands_for(similarity: float, target: float, rows: int) -> int:
    """Bands needed so that a pair at the threshold shares one with the target probability."""
    b = 1
    while recall(similarity, b, rows) < target:
        b += 1
    return b


def band_keys(shingles: np.ndarray, offsets: np.ndarray, bands: int, rows: int, sketches: list[np.ndarray] | None = None) -> np.ndarray:
    """One 64-bit key a band for each item (none of which is empty), from minima of independent permutations. sketches: gets
    arrays of the items' last bytes of all minima."""
    out = np.zeros((len(offsets) - 1, bands), np.uint64)
    i = 0
    while i < len(out):
        # a block of items whose shingles stay in the processor's cache while all permutations pass over them
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CACHED, "right")) - 1)
        x = (mix(shingles[offsets[i] : offsets[j]]) >> np.uint64(32)).astype(np.uint32)
        count = np.diff(offsets[i : j + 1])
        # an item's shingles lie in LANES rows, the last one repeated, so that minima are taken lane by lane first
        width = -(-count // LANES)
        starts = np.cumsum(width) - width
        inside = np.arange(width.sum()) - np.repeat(starts, width)
        lane = np.arange(LANES)[:, None] * np.repeat(width, width) + inside
        x = x[np.repeat(offsets[i:j] - offsets[i], width) + np.minimum(lane, np.repeat(count - 1, width))]
        turned = np.empty_like(x)
        low = np.empty(x.shape[1], np.uint32)
        least = np.empty((bands * rows, j - i), np.uint32)
        for r in range(bands * rows):
            np.minimum.reduce(np.multiply(x, _A[r], out=turned), axis=0, out=low)
            np.minimum.reduceat(low, starts, out=least[r])
        key = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[:, None], j - i, axis=1)
        for r in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least[r::rows])
        out[i:j] = key.T
        if sketches is not None:
            sketches.append(least.T.astype(np.uint8))
        i = j
    return out


_PACKED = pa.schema([("p", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary()), ("src", pa.binary()), ("dst", pa.binary())])
_PACKED_SQL = "p int, keys binary, nodes binary, src binary, dst binary"


def _ties(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each key the smallest node, and links from it to the key's other nodes."""
    order = np.argsort(keys)
    keys, nodes = keys[order], nodes[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(nodes, first) if len(first) else nodes
    head = np.repeat(least, np.diff(np.append(first, len(keys))))
    other = head != nodes
    return keys[first], least, head[other], nodes[other]


def candidates(items: DataFrame) -> DataFrame:
    """node and cluster of the items that share a band with another. items: node long and band keys in binary columns,
    all whose names begin with bands; an item may come several times. Several columns meet one after another: the links of each
    are stored, which are few, and its keys' shuffle files go before the next column's are written.

    A task combines its own rows first: of a key it sends on one node only, so a key that a third of all items share
    reaches a reducer once a task, packed with others, and not once an item."""
    spark = items.sparkSession
    n_parts = partitions(spark)

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate([k.ravel() for k, _ in held])
            nodes = np.concatenate([np.repeat(n, k.shape[1]) for k, n in held])
            keys, nodes, src, dst = _ties(keys, nodes)
            src, dst = reduced(src, dst)
            part = ((keys >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)  # keys are sorted, so parts are
            bounds = np.searchsorted(part, np.arange(n_parts + 1))
            spread = np.linspace(0, len(src), n_parts + 1).astype(np.int64)
            yield blob_table(_PACKED, {"p": np.arange(n_parts, dtype=np.int32), "keys": blobs(keys, bounds), "nodes": blobs(nodes, bounds), "src": blobs(src, spread), "dst": blobs(dst, spread)})

        for b in batches:
            rows = as_binary(b.column(1))
            if not len(rows):
                continue
            keys = np.frombuffer(b"".join(rows.to_pylist()), np.uint64).reshape(len(rows), -1)
            held.append((keys, np.asarray(b.column("node"))))
            size += keys.size
            if size > 1_500_000:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[], [], [], []]
        for b in batches:
            for to, name, kind in zip(got, ("keys", "nodes", "src", "dst"), (np.uint64, np.int64, np.int64, np.int64), strict=True):
                to += [np.frombuffer(x, kind) for x in b.column(name).to_pylist()]
        if got[0]:
            keys, nodes, src, dst = (np.concatenate(x) for x in got)
            _, _, more_src, more_dst = _ties(keys, nodes)
            src, dst = reduced(np.concatenate([src, more_src]), np.concatenate([dst, more_dst]))
            for i in range(0, len(src), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(src[i : i + 50_000]), pa.array(dst[i : i + 50_000])], names=["src", "dst"])

    columns = [c for c in items.columns if c.startswith("bands")]
    links = [items.select("node", c).mapInArrow(tidy(packed), _PACKED_SQL).repartitionById(n_parts, "p").mapInArrow(tidy(joined), "src long, dst long") for c in columns]
    if len(links) > 1:
        links = [stored(x, "ties") for x in links]
    return components(functools.reduce(DataFrame.unionByName, links)).select("node", F.col("root").alias("cluster"))


def _linked(sketch: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the sketches of a bucket as all pairs that agree in at least so many bytes do."""
    rest, src, dst = np.arange(len(sketch)), [], []
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = (sketch[rest] == sketch[at]).sum(1) >= least
            if near.any():
                found, rest = rest[near], rest[~near]
                src.append(np.full(len(found), at))
                dst.append(found)
                front += found.tolist()
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *src]), np.concatenate([none, *dst])


def parted(bodies: DataFrame, shingler: Shingler, bands: int, rows: int, threshold: float, columns: int = 1) -> DataFrame:
    """node and cluster of the items (node, body) again, without ties by chance: of the items that share a band only those
    are tied whose sketches agree as those of similar ones do; an item may come several times. A pair at the threshold fails that with a chance below 1e-7.

    Ties by chance grow with the square of the table and make one cluster of many, all pairs of which would be compared.
    Sketches are sent only to bands that are shared, and a column of bands after another."""
    spark = bodies.sparkSession
    n, agree = bands * rows, threshold + (1 - threshold) / 256
    least = n * agree - 6 * (n * agree * (1 - agree)) ** 0.5
    schema = pa.schema([("node", pa.int64()), ("sketch", pa.binary()), *[(f"bands{c}", pa.binary()) for c in range(columns)]])

    def marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                sketches: list[np.ndarray] = []
                keys = band_keys(*shingler(b.column("body")), bands, rows, sketches)
                parts = {f"bands{c}": blobs(k.ravel(), np.arange(len(k) + 1) * k.shape[1]) for c, k in enumerate(np.array_split(keys, columns, axis=1))}
                yield blob_table(schema, {"node": b.column("node"), "sketch": blobs(np.concatenate(sketches).ravel(), np.arange(len(keys) + 1) * n), **parts})

    def spelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(np.asarray(b.column("node")), len(keys) // max(1, len(b))))], names=["key", "node"])

    def links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in itertools.chain(batches, [None]):
            if b is not None:
                held.append(b)
                if sum(len(x) for x in held) < 20_000:
                    continue
            if not held or not sum(len(x) for x in held):
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            if b is not None:  # the last key may go on
                held = table.slice(int(first[-1])).to_batches()
                table, first = table.slice(0, int(first[-1])), first[:-1]
            if not len(table):
                continue
            node = table.column("node").to_numpy()
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
            size = np.diff(np.append(first, len(node)))
            two = first[size == 2]
            two = two[(sketch[two] == sketch[two + 1]).sum(1) >= least]
            src, dst = [two], [two + 1]
            for at, to in zip(first[size > 2].tolist(), (first + size)[size > 2].tolist(), strict=True):
                i, j = _linked(sketch[at:to], least)
                src.append(i + at)
                dst.append(j + at)
            yield pa.RecordBatch.from_arrays([pa.array(node[np.concatenate(src)]), pa.array(node[np.concatenate(dst)])], names=["src", "dst"])

    every = ", ".join(["node long, sketch binary", *[f"bands{c} binary" for c in range(columns)]])
    marked = stored(bodies.select("node", "body").mapInArrow(tidy(marks), every), "sketches", "none")
    found = []
    for c in range(columns):
        keys = marked.select("node", f"bands{c}").mapInArrow(tidy(spelled), "key long, node long")
        shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        met = keys.join(shared, "key").join(marked.select("node", "sketch"), "node").select("key", "node", "sketch")
        met = met.repartition(2 * partitions(spark), "key").sortWithinPartitions("key", "node")
        found.append(stored(met.mapInArrow(tidy(links), "src long, dst long"), "ties"))
    done = stored(components(functools.reduce(DataFrame.unionByName, found)).select("node", F.col("root").alias("cluster")), "parted")
    for x in (marked, *found):
        discard(x)
    return done


#: Sets of some bodies: unsorted 64-bit shingles, and where each body's begin (one more entry than bodies).
Shingler = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def similar(shingles: np.ndarray, offsets: np.ndarray, group: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of items of one group whose sets have at least this Jaccard similarity. Groups are numbered in order."""
    n = len(offsets) - 1
    item = np.repeat(np.arange(n), np.diff(offsets))
    code = mix(shingles ^ mix(group[item].astype(np.uint64)))
    order = np.argsort(code, kind="stable")
    code, item = code[order], item[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (item[1:] != item[:-1])
    code, item = code[fresh], item[fresh]
    sizes = np.bincount(item, minlength=n)
    begin = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(code)))
    found: list[np.ndarray] = []
    for c in range(2, 13):
        held = item[begin[count == c][:, None] + np.arange(c)]
        i, j = np.triu_indices(c, 1)
        found.append((held[:, i] * n + held[:, j]).ravel())
    pairs, hits = np.unique(np.concatenate(found), return_counts=True)
    common = np.flatnonzero(count > 12)
    if len(common):
        dense_pairs, dense_hits = _dense(item, begin[common], count[common], group, n)
        pairs, back = np.unique(np.concatenate([pairs, dense_pairs]), return_inverse=True)
        hits = np.bincount(back, weights=np.concatenate([hits, dense_hits])).astype(np.int64)
    i, j = pairs // n, pairs % n
    good = hits >= threshold * (sizes[i] + sizes[j] - hits) - 1e-9
    return i[good], j[good]


def _dense(item: np.ndarray, begin: np.ndarray, count: np.ndarray, group: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles of items of large groups, counted by products of 0/1 matrices, a group and some shingles at a time."""
    owner = group[item[begin]]
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for g in np.unique(owner):
        mine = np.flatnonzero(owner == g)
        members = np.flatnonzero(group == g)
        local = np.full(n, -1)
        local[members] = np.arange(len(members))
        total = np.zeros((len(members), len(members)), np.float32)
        width = max(64, min(2048, 8_000_000 // len(members)))
        for at in range(0, len(mine), width):
            cols = mine[at : at + width]
            x = np.zeros((len(members), len(cols)), np.float32)
            lengths = count[cols]
            place = np.repeat(begin[cols] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
            x[local[item[place]], np.repeat(np.arange(len(cols)), lengths)] = 1
            total += x @ x.T
        i, j = np.nonzero(np.triu(total, 1))
        out.append((members[i] * n + members[j], total[i, j].astype(np.int64)))
    return np.concatenate([p for p, _ in out]), np.concatenate([h for _, h in out])


def verify(bodies: DataFrame, clusters: DataFrame, shingler: Shingler, threshold: float) -> DataFrame:
    """node, links (summed weights of the items it is similar to) and root (smallest node reachable by verified links).

    bodies: cluster long, node long, weight long, body string or binary; a node that comes twice counts once. clusters: node
    and cluster of all of them, read to find the large ones, so that bodies are made once."""
    spark = bodies.sparkSession
    sizes = stored(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK), "large")
    large = sizes.take(1)
    if large:
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        cut = bodies.join(sizes, "cluster", "left").withColumn("blocks", F.coalesce(blocks, F.lit(1))).withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other"))
    else:
        cut = bodies.withColumn("part", F.lit(0)).withColumn("lo", F.lit(0)).withColumn("hi", F.lit(0))
    cut = cut.select("cluster", "lo", "hi", "node", "part", "weight", "body").repartition(2 * partitions(spark), "cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi", "node")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            kept.append(b)
            size += b.nbytes
            if size > 3 << 20:
                table = pa.Table.from_batches(kept)
                cuts = _starts(table)
                last = int(cuts[-1])
                if last:
                    yield from compare(table.slice(0, last))
                    rest = table.slice(last).to_batches()
                    kept, size = rest, sum(x.nbytes for x in rest)
        if kept:
            yield from compare(pa.Table.from_batches(kept))

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        starts = _starts(table)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(table))))
        node = np.asarray(table.column("node").chunk(0))
        first = np.ones(len(node), bool)
        first[1:] = (node[1:] != node[:-1]) | (group[1:] != group[:-1])
        if not first.all():
            table, group, node = table.filter(pa.array(first)).combine_chunks(), group[first], node[first]
        part = np.asarray(table.column("part").chunk(0))
        cross = np.asarray(table.column("lo").chunk(0)) != np.asarray(table.column("hi").chunk(0))
        weight = np.asarray(table.column("weight").chunk(0))
        shingles, offsets = shingler(table.column("body").chunk(0))
        i, j = similar(shingles, offsets, group, threshold)
        use = ~cross[i] | (part[i] != part[j])
        i, j = i[use], j[use]
        links = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
        root = node[labels(len(node), i, j)]
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links.astype(np.int64)), pa.array(root)], names=["node", "links", "root"])

    done = cut.mapInArrow(tidy(work), "node long, links long, root long")
    if not large:
        return done
    done = stored(done, "verified")
    roots = components(done.select(F.col("root").alias("src"), F.col("node").alias("dst")))
    return done.groupBy("node").agg(F.sum("links").alias("links")).join(roots, "node", "left").select("node", "links", F.coalesce("root", "node").alias("root"))


def _starts(table: pa.Table) -> np.ndarray:
    """First rows of the groups."""
    change = np.zeros(len(table), bool)
    change[:1] = True
    for name in ("cluster", "lo", "hi"):
        x = table.column(name).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(change)
