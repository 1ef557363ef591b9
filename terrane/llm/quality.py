"""A byte-level convolutional network in numpy for document quality.

Learned filters slide over every byte of a text. Chunks of CHUNK bytes that overlap by half cover the whole text; in each
chunk every filter's response is max-pooled, and the mean and the maximum over the chunks feed one logistic unit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._bytes import runs, tidy
from terrane.llm._shared import small_batches

CHUNK, FILTERS, WIDTH = 256, 12, 6
#: The fit reads at most so many labelled texts, each whole.
SAMPLE_ROWS = 3000
#: Bytes of texts whose responses are held at once; a text is never cut for it.
RUN = 1 << 17


@dataclass
class Network:
    table: np.ndarray  # WIDTH x 256 x FILTERS: the filters applied to one-hot bytes
    bias: np.ndarray
    out: np.ndarray  # mean and maximum of each filter
    out_bias: float

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Responses max-pooled in half chunks, where each text's half chunks begin, and the padded bytes with the places
        of their half chunks. Every text is padded by the filters' width, so none sees its neighbour."""
        width = self.table.shape[0]
        lengths = np.maximum(np.diff(offsets), 1)
        where = np.concatenate(([0], np.cumsum(lengths + width - 1)))
        padded = np.zeros(where[-1], np.uint8)
        for i in range(len(lengths)):
            padded[where[i] : where[i] + offsets[i + 1] - offsets[i]] = data[offsets[i] : offsets[i + 1]]
        n = len(padded) - width + 1
        half = CHUNK // 2
        counts = -(-lengths // half)
        first = np.concatenate(([0], np.cumsum(counts)))
        starts = np.repeat(where[:-1], counts) + half * (np.arange(first[-1]) - np.repeat(first[:-1], counts))
        response = self.table[0][padded[:n]]
        for j in range(1, width):
            response += self.table[j][padded[j : n + j]]
        stops = np.minimum(starts + half, np.repeat(where[:-1] + lengths, counts))
        bounds = np.stack([starts, stops], 1).ravel()
        # the padding between texts is cut out by pooling it into entries of its own; the last stop may be the array's end
        top = np.maximum.reduceat(response, bounds[:-1] if bounds[-1] >= n else bounds, axis=0)[::2]
        return top, first, padded, bounds

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        top, first, _, _ = self.pooled(data, offsets)
        act = np.maximum(top + self.bias, 0)
        chunk, _ = _chunks(act, first)
        starts = _chunk_starts(first)
        mean = np.add.reduceat(chunk, starts, axis=0) / np.diff(np.append(starts, len(chunk)))[:, None]
        return np.concatenate([mean, np.maximum.reduceat(chunk, starts, axis=0)], axis=1)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = self.features(data, offsets).astype(np.float64) @ self.out.astype(np.float64) + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _chunk_starts(first: np.ndarray) -> np.ndarray:
    """Chunks join two neighbouring half chunks; a text of one half chunk has one chunk."""
    return np.concatenate(([0], np.cumsum(np.maximum(np.diff(first) - 1, 1))))[:-1]


def _chunks(act: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(first)
    count = np.maximum(n - 1, 1)
    start = np.concatenate(([0], np.cumsum(count)))
    left = np.repeat(first[:-1], count) + np.arange(start[-1]) - np.repeat(start[:-1], count)
    right = np.minimum(left + 1, np.repeat(first[1:], count) - 1)
    return np.maximum(act[left], act[right]), np.where(act[left] >= act[right], left[:, None], right[:, None])


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 10, batch: int = 24, rate: float = 0.02, seed: int = 7) -> Network:
    """Fit by Adam on the logistic loss. The same texts and labels in the same order give the same network."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), 0.0)
    if len(texts) == 0 or labels.min() == labels.max():
        p = (labels.sum() + 1) / (len(labels) + 2) if len(texts) else 0.5
        net.out[:], net.out_bias = 0, float(np.log(p / (1 - p)))
        return net
    net.out_bias = float(np.log(max(labels.mean(), 1e-3) / max(1 - labels.mean(), 1e-3)))
    shapes = [net.table, net.bias, net.out, np.zeros(1, np.float32)]
    moment, second, step = [np.zeros_like(x) for x in shapes], [np.zeros_like(x) for x in shapes], 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            grads = [np.zeros_like(x) for x in shapes]
            for first, offsets, data in runs(pa.array([texts[i] for i in pick], pa.binary()), RUN):
                y = labels[pick[first : first + len(offsets) - 1]].astype(np.float32)
                for total, part in zip(grads, _gradients(net, data, offsets, y, len(pick)), strict=True):
                    total += part
            step += 1
            pace = rate * (1 - 0.9 * epoch / epochs)
            values = [net.table, net.bias, net.out, np.array([net.out_bias], np.float32)]
            for k, (v, g) in enumerate(zip(values, grads, strict=True)):
                g = g + 1e-4 * v
                moment[k] = 0.9 * moment[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                v -= pace * (moment[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            net.out_bias = float(values[3][0])
    return net


def _gradients(net: Network, data: np.ndarray, offsets: np.ndarray, y: np.ndarray, batch: int) -> list[np.ndarray]:
    """Gradients of the loss over some texts of a batch of so many, divided by the batch."""
    top, first, padded, bounds = net.pooled(data, offsets)
    act = np.maximum(top + net.bias, 0)
    chunk, source = _chunks(act, first)
    starts = _chunk_starts(first)
    sizes = np.diff(np.append(starts, len(chunk)))
    mean = np.add.reduceat(chunk, starts, axis=0) / sizes[:, None]
    most = np.maximum.reduceat(chunk, starts, axis=0)
    feats = np.concatenate([mean, most], axis=1)
    p = 1 / (1 + np.exp(-np.clip(feats @ net.out + net.out_bias, -50, 50)))
    dz = (p - y) / batch
    n_filters = len(net.bias)
    d_feats = dz[:, None] * net.out
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # neighbouring chunks share a half, so several may hold the maximum: the first takes the gradient
    top_here = chunk == most[owner]
    rank = np.cumsum(top_here, axis=0)
    rank -= (rank[starts] - top_here[starts])[owner]
    d_chunk = d_feats[owner, :n_filters] / sizes[owner, None] + d_feats[owner, n_filters:] * (top_here & (rank == 1))
    d_act = np.zeros_like(act)
    np.add.at(d_act, (source, np.arange(n_filters)[None, :]), d_chunk)
    d_act *= act > 0
    # where in its half chunk each filter responded most
    k, f = np.nonzero(d_act)
    width, half = net.table.shape[0], CHUNK // 2
    n = len(padded) - width + 1
    grad = np.zeros_like(net.table)
    begin, stop = bounds[::2][k], bounds[1::2][k]
    for at in range(0, len(k), 4096):
        b, s, ff, g = begin[at : at + 4096], stop[at : at + 4096], f[at : at + 4096], d_act[k[at : at + 4096], f[at : at + 4096]]
        place = b[:, None] + np.arange(half)
        bytes_at = np.minimum(place, n - 1)
        response = np.zeros(place.shape, np.float32)
        for j in range(width):
            response += net.table[j][padded[bytes_at + j], ff[:, None]]
        response[place >= s[:, None]] = -np.inf
        best = b + response.argmax(1)
        for j in range(width):
            np.add.at(grad[j], (padded[best + j], ff), g)
    return [grad, d_act.sum(0), feats.T @ dz, np.array([dz.sum()], np.float32)]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> Network:
    """Fit on a bounded sample: the `rows` labelled keys that come first by hash (a key with several labels takes the
    largest, one with several texts the least of them), each with its whole text. Null labels and keys are left out; null
    texts count as empty. Without any row, or with one label only, the network gives the (smoothed) share of label 1."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    held = labels.select(F.col(key).alias("k"), F.col(label).alias("y")).where("k is not null and y is not null").groupBy("k").agg(F.max("y").alias("y"))
    chosen = spark.createDataFrame(held.orderBy(F.xxhash64("k"), "k").limit(rows).toArrow())
    sample = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(chosen), "k")
    got = sample.groupBy("k").agg(F.min("t").alias("t"), F.max("y").alias("y")).toArrow()
    got = got.take(pc.sort_indices(got, [("k", "ascending")])) if len(got) else got
    return train([t.encode() for t in got.column("t").to_pylist()], np.array(got.column("y").to_pylist(), np.float64))


def score(df: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the probability of label 1 to every row; null and empty texts are scored as empty. All bytes of a text count."""
    small_batches(df.sparkSession)
    if out in df.columns:
        raise ValueError(f"the input has a column {out} already")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            scores = np.zeros(len(column))
            for first, offsets, data in runs(column, RUN):
                scores[first : first + len(offsets) - 1] = net.score(data, offsets)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, out])

    return df.mapInArrow(tidy(work), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` double")
