"""Near-duplicate embeddings through an inverted multi-index.

Each half of the unit vectors has a codebook of its own; pairs of codewords are the cells of a product grid, and every
vector lies in one. A query walks both sequences of codewords from near to far, by how far a vector must move to fall to
them (its distance from the bisector): a frontier over the two sorted sequences gives the cells in the order of their two
distances together, and the walk ends at a radius. The radius is calibrated so that partners at the threshold, in random
directions, are met with the target recall; what is met is verified by cosine in double precision. Each pair is looked for
from the lower cell only. Vectors of different lengths have grids of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm._bytes import as_binary, blobs, ragged, tidy, word_hashes
from terrane.llm._shared import partitions, small_batches, stored
from terrane.llm.components import components, labels

THRESHOLD, RECALL = 0.9, 0.995
#: Vectors a cell on average: codebooks grow with the square root of the table. They are fitted on SAMPLE vectors, or
#: PER_CODEWORD a codeword if that is more. About RESIDENTS vectors are held and compared with queries at once.
PER_CELL, SAMPLE, PER_CODEWORD, RESIDENTS = 64, 6000, 16, 8192


class Grid:
    def __init__(self, sample: np.ndarray, codewords: int, threshold: float, recall: float, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.half = sample.shape[1] // 2
        self.books = [_kmeans(h, codewords, rng) for h in (sample[:, : self.half], sample[:, self.half :])]
        self.size = len(self.books[1])
        self.apart = [np.sqrt(np.maximum(_squares(b, b), 1e-24)) for b in self.books]
        self.radius = self._calibrated(sample[:2000], threshold, recall, rng)

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.maximum(_squares(h, b), 0) for h, b in zip((x[:, : self.half], x[:, self.half :]), self.books, strict=True)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * self.size + b.argmin(1)

    def moves(self, x: np.ndarray) -> list[np.ndarray]:
        """Squared distance to the bisector between a half's own codeword and each other."""
        out = []
        for d, apart in zip(self.distances(x), self.apart, strict=True):
            own = d.argmin(1)
            out.append((np.maximum(d - d.min(1)[:, None], 0) / (2 * apart[own])) ** 2)
        return out

    def _calibrated(self, x: np.ndarray, threshold: float, recall: float, rng: np.random.Generator) -> float:
        side = rng.normal(size=x.shape)
        side -= (side * x).sum(1)[:, None] * x
        side /= np.maximum(np.linalg.norm(side, axis=1), 1e-12)[:, None]
        to = self.cells(threshold * x + np.sqrt(1 - threshold**2) * side)
        a, b = self.moves(x)
        rows = np.arange(len(x))
        return float(np.quantile(a[rows, to // self.size] + b[rows, to % self.size], recall)) + 1e-12

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, cell) of the cells to visit, by the multi-sequence walk: of the cells at the frontier of a query the
        nearest is visited, and its successor in the second sequence and, from the first column, in the first join the
        frontier. A walk ends beyond the radius. All queries take their steps together."""
        a, b = self.moves(x)
        near_a, near_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        a, b = np.take_along_axis(a, near_a, 1), np.take_along_axis(b, near_b, 1)
        live = np.arange(len(x))
        head = np.full((len(x), 8), np.inf)  # of each codeword of the first sequence the frontier's distance
        place = np.zeros((len(x), 8), np.int64)  # and its place in the second sequence
        head[:, 0] = a[:, 0] + b[:, 0]
        who, cells = [], []
        while len(live):
            row = np.arange(len(live))
            i = head.argmin(1)
            go = head[row, i] <= self.radius
            if not go.all():
                live, head, place, i = live[go], head[go], place[go], i[go]
                row = np.arange(len(live))
                if not len(live):
                    break
            j = place[row, i]
            who.append(live)
            cells.append(near_a[live, i] * self.size + near_b[live, j])
            more = j + 1 < b.shape[1]
            head[row, i] = np.where(more, a[live, i] + b[live, np.minimum(j + 1, b.shape[1] - 1)], np.inf)
            place[row, i] = j + 1
            opens = np.flatnonzero((j == 0) & (i + 1 < a.shape[1]))
            if len(opens):
                if int(i[opens].max()) + 1 >= head.shape[1]:
                    wider = min(head.shape[1], a.shape[1])
                    head, place = np.hstack([head, np.full((len(live), wider), np.inf)]), np.hstack([place, np.zeros((len(live), wider), np.int64)])
                head[opens, i[opens] + 1] = a[live[opens], i[opens] + 1] + b[live[opens], 0]
        return (np.concatenate(who), np.concatenate(cells)) if who else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return (x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([_squares(x[i : i + 2000], centre).argmin(1) for i in range(0, len(x), 2000)])
        order = np.argsort(own, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(own[order]) != 0))
        centre[own[order][first]] = np.add.reduceat(x[order], first, axis=0) / np.diff(np.append(first, len(x)))[:, None]
    return centre


def _units(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id, length, node (hash of the components) and the unit vector as doubles; node is null for what links with nothing."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            for length in np.unique(sizes).tolist():
                mine = pa.array(np.flatnonzero(sizes == length))
                n = len(mine)
                ids, lengths = b.column(0).take(mine), pa.array(np.full(n, length, np.int32))
                if not length:
                    yield pa.RecordBatch.from_arrays([ids, lengths, pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names=["id", "length", "node", "unit"])
                    continue
                out = np.array(lists.take(mine).flatten().cast(pa.float64()).fill_null(float("nan"))).reshape(n, length)
                ok = np.isfinite(out).all(1)
                out[~ok] = 0
                scale = np.abs(out).max(1)
                ok &= scale > 0
                out[ok] /= scale[ok, None]
                out[ok] /= np.linalg.norm(out[ok], axis=1, keepdims=True)
                out += 0.0  # no negative zeros
                at = np.arange(n + 1) * 8 * length
                node = word_hashes(np.frombuffer(out.tobytes(), np.uint8), at[:-1], at[1:]).view(np.int64)
                unit = blobs(out.ravel(), np.arange(n + 1) * length).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([ids, lengths, pa.array(node, mask=~ok), pc.if_else(pa.array(ok), unit, pa.scalar(None, pa.binary()))], names=["id", "length", "node", "unit"])

    return df.select(F.col(key).cast("long"), F.col(vector)).mapInArrow(tidy(work), "id long, length int, node long, unit binary")


_ROW_SQL = "cell_row int, part int, chunk int, query int, node long, weight long, cells binary, unit binary"


class Layout:
    """Where residents are held: a row of the grid is cut into `parts` equal ranges of columns, and a part of more than
    RESIDENTS vectors into as many chunks by the vectors' hashes. Only such parts are listed."""

    def __init__(self, grid: Grid, count: int, nodes: DataFrame):
        self.parts = max(1, min(grid.size, round(count / (len(grid.books[0]) * RESIDENTS))))
        self.size = grid.size

        def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, len(b), 500):
                    row, part = self.of(grid.cells(_matrix(b.slice(at, 500).column("unit"))))
                    yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), pa.array(part.astype(np.int32))], names=["r", "p"])

        full = nodes.select("unit").mapInArrow(tidy(places), "r int, p int").groupBy("r", "p").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > RESIDENTS).collect()
        self.chunks = {(r, p): -(-n // RESIDENTS) for r, p, n in full}

    def of(self, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return cell // self.size, cell % self.size * self.parts // self.size

    def count(self, row: np.ndarray, part: np.ndarray) -> np.ndarray:
        if not self.chunks:
            return np.ones(len(row), np.int64)
        return np.array([self.chunks.get(k, 1) for k in zip(row.tolist(), part.tolist(), strict=True)], np.int64)


def _matrix(units: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(as_binary(units).to_pylist()), np.float64).reshape(len(units), -1)


def _routed(nodes: DataFrame, grid: Grid, layout: Layout) -> DataFrame:
    """Residents go to the chunk of their part; queries to all chunks of the parts that they visit, with the cells there."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                b = whole.slice(at, 500)
                x = _matrix(b.column("unit"))
                node, weight = np.asarray(b.column("node")), np.asarray(b.column("copies"))
                own = grid.cells(x)
                row, part = layout.of(own)
                to = (node.view(np.uint64) >> np.uint64(7)).astype(np.int64) % layout.count(row, part)
                yield rows(b, np.arange(len(b)), row, part, to, np.zeros(len(b), np.int64), own, np.arange(len(b) + 1), weight)
                q, cell = grid.visits(x)
                keep = cell >= own[q]
                q, cell = q[keep], cell[keep]
                r, p = layout.of(cell)
                order = np.lexsort((cell, p, r, q))
                q, cell, r, p = q[order], cell[order], r[order], p[order]
                new = np.append(True, (q[1:] != q[:-1]) | (r[1:] != r[:-1]) | (p[1:] != p[:-1]))[: len(q)]
                first = np.flatnonzero(new)
                bounds = np.append(first, len(q))
                kind = np.where(cell[first] == own[q[first]], 2, 1)  # 2: the first cell is the query's own
                copies = layout.count(r[first], p[first])
                for k in range(int(copies.max(initial=0))):
                    some = np.flatnonzero(copies > k)
                    f = first[some]
                    yield rows(b, q[f], r[f], p[f], np.full(len(f), k), kind[some], cell, np.stack([bounds[some], bounds[some + 1]]), weight)

    def rows(b, who, row, part, chunk, query, cells, bounds, weight) -> pa.RecordBatch:
        if bounds.ndim == 2:
            n = bounds[1] - bounds[0]
            cells, bounds = cells[ragged(bounds[0], n)], np.concatenate(([0], np.cumsum(n)))
        pick = pa.array(who)
        ints = [pa.array(v.astype(np.int32)) for v in (row, part, chunk, query)]
        return pa.RecordBatch.from_arrays([*ints, b.column("node").take(pick), pa.array(weight[who]), blobs(cells.astype("<i8"), bounds).cast(pa.binary()), b.column("unit").take(pick)], names=["cell_row", "part", "chunk", "query", "node", "weight", "cells", "unit"])

    return nodes.select("node", "copies", "unit").mapInArrow(tidy(work), _ROW_SQL)


def _met(routed: DataFrame, threshold: float) -> DataFrame:
    """node, links and root of the vectors that meet partners: residents of a chunk are held, queries stream past."""
    place = ("cell_row", "part", "chunk")
    rows = routed.repartition(4 * partitions(routed.sparkSession), *place).sortWithinPartitions(*place, "query")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, [], None
        for whole in batches:
            row, part, chunk, query = (np.asarray(whole.column(c)) for c in (*place, "query"))
            new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (part[1:] != part[:-1]) | (chunk[1:] != chunk[:-1]) | (query[1:] != query[:-1])))
            for f, s in zip(new.tolist(), np.append(new[1:], len(row)).tolist(), strict=True):
                if at != (row[f], part[f], chunk[f]):
                    at, held, ready = (row[f], part[f], chunk[f]), [], None
                b = whole.slice(f, s - f)
                if not query[f]:
                    held.append(b)
                    continue
                if ready is None:
                    if not held:
                        continue
                    ready = _residents(pa.Table.from_batches(held))
                for i in range(0, len(b), 2000):
                    yield from _compare(ready, b.slice(i, 2000), threshold)

    return rows.mapInArrow(tidy(work), "node long, links long, root long")


def _residents(table: pa.Table) -> tuple[np.ndarray, ...]:
    x = _matrix(table.column("unit"))
    cell = np.frombuffer(b"".join(table.column("cells").to_pylist()), "<i8")
    order = np.argsort(cell, kind="stable")
    return x[order], cell[order], table.column("node").to_numpy()[order], table.column("weight").to_numpy()[order]


def _compare(residents: tuple[np.ndarray, ...], b: pa.RecordBatch, threshold: float) -> Iterator[pa.RecordBatch]:
    y, cell, other, other_weight = residents
    x = _matrix(b.column("unit"))
    node, weight = np.asarray(b.column("node")), np.asarray(b.column("weight"))
    lists = [np.frombuffer(v, "<i8") for v in b.column("cells").to_pylist()]
    who, want = np.repeat(np.arange(len(b)), [len(v) for v in lists]), np.concatenate(lists)
    order = np.argsort(want, kind="stable")
    who, want = who[order], want[order]
    left, right = [], []
    for c in np.unique(want):
        lo, hi = np.searchsorted(cell, (c, c + 1))
        if lo == hi:
            continue
        mine = who[np.searchsorted(want, c) : np.searchsorted(want, c, "right")]
        i, j = np.nonzero(x[mine] @ y[lo:hi].T >= threshold)
        i, j = mine[i], lo + j
        left.append(i)
        right.append(j)
    if not left:
        return
    i, j = np.concatenate(left), np.concatenate(right)
    # inside one cell both meet each other: the smaller node counts the pair. In its own part a query's first cell is its own
    same_cell = (np.asarray(b.column("query"))[i] == 2) & (cell[j] == np.array([v.min() for v in lists])[i])
    use = (node[i] != other[j]) & (~same_cell | (node[i] < other[j]))
    i, j = i[use], j[use]
    if not len(i):
        return
    ids, at = np.unique(np.concatenate([node[i], other[j]]), return_inverse=True)
    a, z = at[: len(i)], at[len(i) :]
    links = np.bincount(a, other_weight[j], len(ids)) + np.bincount(z, weight[i], len(ids))
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links.astype(np.int64)), pa.array(ids[labels(len(ids), a, z)])], names=["node", "links", "root"])


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """id, n_links and component_id (smallest id reachable by links) of every row.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing: their component is their
    own id. Only vectors of the same length can link; each length has a grid of its own, so a table should hold few. Equal
    unit vectors are one node, whose rows all link with each other. Rows that repeat an id are separate vectors, null ids
    are larger than all others. Ids are read as longs. No row is dropped; other columns are not read."""
    small_batches(df.sparkSession)
    units = stored(_units(df, key, vector), "units")
    nodes = stored(units.where("node is not null").groupBy("length", "node").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"), F.first("unit").alias("unit")), "vectors")
    met = None
    for length, count in sorted(tuple(r) for r in nodes.groupBy("length").count().collect()):
        if length > 1 and count > 1:  # two different unit vectors of length 1 are opposite
            found = _links(nodes.where(F.col("length") == length), length, count, threshold, recall)
            met = found if met is None else met.unionByName(found)
    if met is None:
        placed = nodes.select("length", "node", F.col("first").alias("component_id"), (F.col("copies") - 1).alias("n_links"))
    else:
        # nodes of different lengths may share a hash, so the two together are hashed again
        roots = components(met.select(_name("root").alias("src"), _name("node").alias("dst")))
        links = met.groupBy("length", "node").agg(F.sum("links").alias("links"))
        named = nodes.select("length", "node", "copies", "first", _name("node").alias("name"))
        placed = named.join(links, ["length", "node"], "left").join(roots.select(F.col("node").alias("name"), "root"), "name", "left").withColumn("root", F.coalesce("root", "name"))
        least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
        placed = placed.join(least, "root").select("length", "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return units.select("id", "length", "node").join(placed, ["length", "node"], "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))


def _name(column: str) -> Column:
    return F.xxhash64("length", column)


def _links(nodes: DataFrame, length: int, count: int, threshold: float, recall: float) -> DataFrame:
    """length, node, links and root of the vectors of one length that meet partners."""
    codewords = max(4, 2 ** round(np.log2(max(1, count / PER_CELL) ** 0.5)))
    picked = nodes.orderBy("node").limit(max(SAMPLE, PER_CODEWORD * codewords)).select("unit").toArrow()
    grid = Grid(_matrix(picked.column("unit").combine_chunks()), codewords, threshold, recall)
    met = stored(_met(_routed(nodes, grid, Layout(grid, count, nodes)), threshold), "met")
    return met.withColumn("length", F.lit(length))
