"""Language-model scores: Katz backoff over word bigrams with Good-Turing discounts.

Counts are kept by hash partitions. Texts are cut into blocks of tokens; a block asks the unigram partitions for its
words' counts, then sends its bigrams to the bigram partitions, grouped by history, together with where they stand. A
partition has all bigrams of its histories, so it can count, normalise and evaluate them on the spot: it stores their counts
and what the backoff weight of each history follows from, and only sums per text go back. Frequent histories are dealt over
all partitions by the word that follows, and their statistics are added up. Frequent bigrams, at most a few for each
partition, are counted first, with a combining aggregate, and then evaluated in the blocks themselves.

The stored tables are the model: `Model.log_probability` evaluates any documents by them, from a bigram back to its word.

The model: P(w|h) = d(c(h,w)) c(h,w) / c(h) for a bigram that was seen, otherwise alpha(h) P(w); alpha(h) is exactly what
the seen bigrams leave of 1 over what their words leave of 1 in the unigram model. An unseen history has alpha 1. P(w) is
the discounted share of w, and what the seen words leave goes to one class of unseen words. d(r) is Katz's Good-Turing
ratio up to r = 5 (where the counts of counts give no ratio between 0 and 1, (r - 1/2) / r), and beyond (r - 1/10) / r.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm._bytes import LOWER, SPACED, blob_table, blobs, mix, ragged, runs, spans, tidy, word_hashes
from terrane.llm._shared import discard, partitions, small_batches, stored

K, LARGE = 5, 0.1
#: Words and bigrams are frequent beyond a quarter of a partition's share of all tokens, and beyond this.
OFTEN = 1000
#: Bytes and texts of a block, and passes over the blocks, each for a share of the histories: a pass's bigrams are on disk at once.
BLOCK_BYTES, BLOCK_TEXTS, PASSES = 12 << 20, 60_000, 3
END, BOS = np.uint64(0x51ED270B9F3A6C11), np.uint64(0x2F8C1D3E4B5A6977)
_DOC = np.dtype([("id", "<i8"), ("known", "u1"), ("train", "u1"), ("n", "<u4")])


class Discounts:
    """d(r) from counts of counts n_1 .. n_{K+1}."""

    def __init__(self, n: np.ndarray):
        self.low = np.ones(K + 1)
        top = (K + 1) * n[K] / n[0] if n[0] else 1.0
        for r in range(1, K + 1):
            ratio = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 1.0
            d = (ratio - top) / (1 - top) if top != 1 else 0.0
            self.low[r] = d if 0 < d < 1 else (r - 0.5) / r

    def counts(self, c: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        c = np.asarray(c, np.float64)
        return np.where(c > K, c - LARGE, c * self.low[np.minimum(c, K).astype(np.int64)])


class Unigrams:
    """Shares of words from their counts: n tokens, v words, and n_1 .. n_{K+1} words of these counts."""

    def __init__(self, tokens: int, words: int, n: np.ndarray):
        self.tokens, self.words, self.d = tokens, words, Discounts(n)
        low = np.arange(1, K + 1)
        kept = (self.d.low[1:] * low * n[:K]).sum() + (tokens - (low * n[:K]).sum()) - LARGE * (words - n[:K].sum())
        self.unseen = 1 - kept / tokens if tokens else 1.0

    def share(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d.counts(c) / max(self.tokens, 1), self.unseen)


def _ranges(keys: np.ndarray, n_parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers as rows of as many bytes, low ones first, as the largest needs."""
    wide = np.ascontiguousarray(values, "<u8")
    width = max(1, -(-int(wide.max(initial=0)).bit_length() // 8))
    return np.ascontiguousarray(wide.view(np.uint8).reshape(-1, 8)[:, :width])


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers: one byte that says how many bytes each has, then all first bytes, all second ones and so on."""
    rows = _narrow(values)
    return bytes([rows.shape[1]]) + np.ascontiguousarray(rows.T).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<i8").ravel()


def _widened(raw: bytes, width: int) -> np.ndarray:
    """Numbers of so many bytes each."""
    rows = np.frombuffer(raw, np.uint8).reshape(-1, width)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :width] = rows
    return out.view("<i8").ravel()


_TOKENS_SQL = "kind int, block long, p int, a binary, b binary, c binary"
_TOKENS = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("p", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of texts: their directory, their sorted distinct word hashes and their tokens as numbers of these."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for at in range(0, len(whole), BLOCK_TEXTS):
                batch = whole.slice(at, BLOCK_TEXTS)
                ids, train = batch.column("id"), np.asarray(batch.column("train"))
                values, known = np.asarray(ids.fill_null(0)), np.asarray(ids.is_valid())
                for first, offsets, data in runs(batch.column("text"), BLOCK_BYTES):
                    n = len(offsets) - 1
                    data = LOWER[data]
                    starts, ends, words_at = spans(data, offsets, SPACED)
                    hashes = np.zeros(len(starts) + n, np.uint64)
                    counts = np.diff(words_at)
                    last = np.cumsum(counts + 1) - 1
                    is_end = np.zeros(len(hashes), bool)
                    is_end[last] = True
                    plain = np.empty(len(starts), np.uint64)
                    for i in range(0, len(starts), 1 << 17):
                        j = min(i + (1 << 17), len(starts))
                        lo, hi = starts[i], ends[j - 1]
                        plain[i:j] = word_hashes(data[lo:hi], starts[i:j] - lo, ends[i:j] - lo)
                    hashes[is_end], hashes[~is_end] = END, plain
                    vocabulary, tokens = np.unique(hashes, return_inverse=True)
                    directory = np.zeros(n, _DOC)
                    directory["id"], directory["known"] = values[first : first + n], known[first : first + n]
                    directory["train"], directory["n"] = train[first : first + n], counts + 1
                    yield blob_table(_TOKENS, {"kind": [0], "block": [number], "p": [-1], "a": [directory.tobytes()], "b": [vocabulary.tobytes()], "c": [_packed(tokens)]})
                    number += 1

    return stored(docs.mapInArrow(tidy(work), _TOKENS_SQL), "tokens")


def _unigrams(blocks: DataFrame) -> DataFrame:
    """Count partitions: statistics (kind 2), counts for each asking block in the order of its words (1), and the table (3)."""
    n_parts = partitions(blocks.sparkSession)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, a, v, c in zip(*(b.column(x).to_pylist() for x in ("block", "a", "b", "c")), strict=True):
                directory, vocabulary, tokens = np.frombuffer(a, _DOC), np.frombuffer(v, np.uint64), _unpacked(c)
                train = np.repeat(directory["train"] > 0, directory["n"])
                counts = [np.bincount(x, minlength=len(vocabulary)) for x in (tokens[train], tokens)]
                at = np.searchsorted(_ranges(vocabulary, n_parts), np.arange(n_parts + 1))
                both = [[_packed(x[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)] for x in counts]
                yield blob_table(_TOKENS, {"kind": np.zeros(n_parts, np.int32), "block": np.full(n_parts, block), "p": np.arange(n_parts, dtype=np.int32), "a": blobs(vocabulary, at), "b": both[0], "c": both[1]})

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [(block, p, np.frombuffer(a, np.uint64), _unpacked(b), _unpacked(c)) for r in batches for block, p, a, b, c in zip(*(r.column(x).to_pylist() for x in ("block", "p", "a", "b", "c")), strict=True)]
        if not asked:
            return
        keys, where = np.unique(np.concatenate([x[2] for x in asked]), return_inverse=True)
        total, every = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        np.add.at(total, where, np.concatenate([x[3] for x in asked]))
        np.add.at(every, where, np.concatenate([x[4] for x in asked]))
        seen = total[total > 0]
        stats = np.concatenate(([seen.sum(), len(seen), every.sum()], np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1 : K + 2]))
        p = asked[0][1]
        yield blob_table(_TOKENS, {"kind": [2], "block": [-1], "p": [p], "a": [stats.astype("<i8").tobytes()], "b": [None], "c": [None]})
        kept = total > 0
        yield blob_table(_TOKENS, {"kind": [3], "block": [-1], "p": [p], "a": [keys[kept].tobytes()], "b": [_packed(total[kept])], "c": [None]})
        at = 0
        for block, p, a, *_ in asked:
            mine = where[at : at + len(a)]
            yield blob_table(_TOKENS, {"kind": [1], "block": [block], "p": [p], "a": [total[mine].astype("<i8").tobytes()], "b": [every[mine].astype("<i8").tobytes()], "c": [None]})
            at += len(a)

    return stored(blocks.select("block", "a", "b", "c").mapInArrow(tidy(ask), _TOKENS_SQL).repartitionById(n_parts, "p").mapInArrow(tidy(answer), _TOKENS_SQL), "unigrams")


#: What a block sends to a partition: histories with their counts and numbers of pairs; words that follow, their counts, the
#: pairs' counts in training texts and in all; the texts of all occurrences. All but the hashes have as many bytes as needed.
_FIELDS = ("h", "ch", "pairs", "w", "cw", "ct", "nr", "refs")
_PAIRS = pa.schema([("p", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("widths", pa.binary()), *((f, pa.binary()) for f in _FIELDS), ("docs", pa.binary()), ("base", pa.binary()), ("known", pa.binary()), ("own", pa.binary())])
_PAIRS_SQL = "p int, block long, n int, widths binary, " + ", ".join(f"{f} binary" for f in _FIELDS) + ", docs binary, base binary, known binary, own binary"
_SUMS = pa.schema([("kind", pa.int32()), ("block", pa.int64()), *((f, pa.binary()) for f in "abcde"), ("hot", pa.int64())])
_SUMS_SQL = "kind int, block long, a binary, b binary, c binary, d binary, e binary, hot long"
DOCS, LINEAR, UNSEEN, COUNTS, HOT, TABLE, HISTORIES = range(7)


def _counted(blocks: DataFrame, unigrams: DataFrame) -> DataFrame:
    """The blocks with the counts of their words (d): each block meets its answers once."""
    n_parts = partitions(blocks.sparkSession)
    rows = blocks.unionByName(unigrams.where("kind = 1")).repartition(2 * n_parts, "block").sortWithinPartitions("block", "kind", "p")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, counts = None, None, []
        for b in batches:
            for i in range(len(b)):
                kind, block = b.column("kind")[i].as_py(), b.column("block")[i].as_py()
                if block != now:
                    if parts:
                        yield row(now, parts, counts)
                    now, parts, counts = block, None, []
                if kind == 0:
                    parts = [b.column(x)[i].as_py() for x in "abc"]
                else:
                    counts.append([b.column(x)[i].as_py() for x in "ab"])
        if parts:
            yield row(now, parts, counts)

    def row(block: int, parts: list[bytes], counts: list[list[bytes]]) -> pa.RecordBatch:
        both = [_packed(np.frombuffer(b"".join(x), "<i8")) for x in zip(*counts, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([block]), *(pa.array([v], pa.binary()) for v in (*parts, *both))], names=["block", "a", "b", "c", "d", "e"])

    return stored(rows.mapInArrow(tidy(work), "block long, a binary, b binary, c binary, d binary, e binary"), "counted")


class _Block:
    """A block's texts, words, counts (the begin of a text is the word after the last) and tokens with their histories."""

    def __init__(self, b: pa.RecordBatch, i: int, texts: int, every: int):
        self.block, a, v, c, d, e = (b.column(x)[i].as_py() for x in ("block", "a", "b", "c", "d", "e"))
        self.raw, self.directory, vocabulary = a, np.frombuffer(a, _DOC), np.frombuffer(v, np.uint64)
        self.tokens, self.counts, self.every = _unpacked(c), np.append(_unpacked(d), texts), np.append(_unpacked(e), every)
        self.hashes, self.size = np.append(vocabulary, BOS), len(vocabulary)
        lengths = self.directory["n"].astype(np.int64)
        self.doc, self.first = np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths) - lengths
        self.history = np.empty_like(self.tokens)
        self.history[1:] = self.tokens[:-1]
        self.history[self.first] = self.size
        self.train = self.directory["train"] > 0


_PAIR = pa.schema([("h", pa.int64()), ("w", pa.int64()), ("c", pa.int64()), ("n", pa.int64())])


def _frequent(counted: DataFrame, texts: int, every: int, often: int) -> list[tuple[int, int, int, int]]:
    """(h, w, count in training texts, in all) of the bigrams that occur more than `often` times. Only pairs of words that
    both do are counted, each once a block; so many can't be more than all tokens divided by `often`."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                x = _Block(b, i, texts, every)
                much = x.every > often
                mine = np.flatnonzero(much[x.history] & much[x.tokens])
                code, where = np.unique(x.history[mine] * (x.size + 1) + x.tokens[mine], return_inverse=True)
                c = np.bincount(where[x.train[x.doc[mine]]], minlength=len(code))
                n = np.bincount(where, minlength=len(code))
                h, w = x.hashes[code // (x.size + 1)].view(np.int64), x.hashes[code % (x.size + 1)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in (h, w, c, n)], schema=_PAIR)

    pairs = counted.mapInArrow(tidy(work), "h long, w long, c long, n long").groupBy("h", "w").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    return [tuple(r) for r in pairs.where(F.col("n") > often).orderBy("h", "w").collect()]


def _bigrams(counted: DataFrame, model: Unigrams, texts: int, every: int, often: int, frequent: list[tuple[int, int, int, int]], turn: int) -> DataFrame:
    """Sums of one share of the histories: see the kinds. Kept in the shared folder."""
    n_parts = partitions(counted.sparkSession)
    known = np.array(frequent, np.int64).reshape(-1, 4)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                yield pairs(_Block(b, i, texts, every))

    def own(x: _Block, code: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, bytes | None]:
        """Of occurrences those that aren't of a frequent bigram, and the sums of the others: linear part, counts up to K,
        and what the unseen ones back off from."""
        at = [np.searchsorted(x.hashes[:-1], known[:, k].view(np.uint64)) for k in (0, 1)]
        h, w = (np.minimum(v, x.size - 1) for v in at)
        h = np.where(known[:, 0].view(np.uint64) == BOS, x.size, h)
        there = np.flatnonzero((x.hashes[h] == known[:, 0].view(np.uint64)) & (x.hashes[w] == known[:, 1].view(np.uint64)))
        if not len(there):
            return mine, None
        codes = h[there] * (x.size + 1) + w[there]
        order = np.argsort(codes)
        place = np.minimum(np.searchsorted(codes[order], code), len(codes) - 1)
        hit = codes[order][place] == code
        pair = there[order][place[hit]]
        doc, n, c = x.doc[mine[hit]], len(x.directory), known[pair, 2]
        ch, share = x.counts[h[pair]], model.share(x.counts[w[pair]])
        linear = np.bincount(doc, _linear(c, ch, share), n)
        small = np.bincount(doc * (K + 1) + np.where(c <= K, c, 0), minlength=n * (K + 1)).reshape(n, K + 1)[:, 1:]
        miss = np.flatnonzero((c == 0) & (ch > 0))
        packed = [linear.tobytes(), small.astype("<i8").tobytes(), known[pair[miss], 0].tobytes(), doc[miss].astype("<i8").tobytes()]
        return mine[~hit], np.array([len(v) for v in packed], "<i8").tobytes() + b"".join(packed)

    def pairs(x: _Block) -> pa.RecordBatch:
        extra = {"docs": None, "base": None, "known": None}
        if turn == 0:
            log = np.log10(x.counts + 0.5)[x.tokens]
            extra = {"docs": x.raw, "base": np.add.reduceat(log, x.first).tobytes(), "known": np.add.reduceat((x.counts > 0)[x.tokens].astype(np.int64), x.first).tobytes()}
        mine = np.flatnonzero((mix(x.hashes) % np.uint64(PASSES) == np.uint64(turn))[x.history])
        code = x.history[mine] * (x.size + 1) + x.tokens[mine]
        extra["own"] = None
        if len(known):
            mine, extra["own"] = own(x, code, mine)
            code = x.history[mine] * (x.size + 1) + x.tokens[mine]
        order = np.argsort(code, kind="stable")
        code, doc = code[order], x.doc[mine[order]]
        begin = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
        nr = np.diff(np.append(begin, len(order)))
        ct = np.add.reduceat(x.train[doc].astype(np.int64), begin) if len(begin) else begin
        h, w = code[begin] // (x.size + 1), code[begin] % (x.size + 1)
        by = mix(x.hashes[h])
        hot = x.every[h] > often
        by[hot] = mix(by[hot] ^ mix(x.hashes[w[hot]]))
        part = _ranges(by, n_parts)
        move = np.argsort(part, kind="stable")
        part, h, w, ct, nr, begin = part[move], h[move], w[move], ct[move], nr[move], begin[move]
        lead = np.ones(len(h), bool)
        lead[1:] = (h[1:] != h[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(lead)
        n = np.arange(n_parts + 1)
        by_pair, by_lead = np.searchsorted(part, n), np.searchsorted(part[at], n)
        ref_at = np.concatenate(([0], np.cumsum(nr)))
        refs = doc[ragged(begin, nr)]
        values = {"h": (x.hashes[h[at]], by_lead), "ch": (2 * x.counts[h[at]] + hot_of(x, h[at]), by_lead), "pairs": (np.diff(np.append(at, len(h))), by_lead), "w": (x.hashes[w], by_pair), "cw": (x.counts[w], by_pair), "ct": (ct, by_pair), "nr": (nr, by_pair), "refs": (refs, ref_at[by_pair])}
        table, widths = {}, []
        for f in _FIELDS:
            rows = _narrow(values[f][0])
            widths.append(rows.shape[1])
            table[f] = blobs(rows.ravel(), values[f][1] * rows.shape[1])
        table |= {"p": np.arange(n_parts, dtype=np.int32), "block": np.full(n_parts, x.block), "n": np.full(n_parts, len(x.directory), np.int32), "widths": pa.array([bytes(widths)] * n_parts, pa.binary())}
        host = x.block % n_parts
        table |= {k: pa.array([v if i == host else None for i in range(n_parts)], pa.binary()) for k, v in extra.items()}
        return blob_table(_PAIRS, table)

    def hot_of(x: _Block, h: np.ndarray) -> np.ndarray:
        return (x.every[h] > often).astype(np.int64)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list] = {f: [] for f in _FIELDS}
        sources = []
        for b in batches:
            widths = b.column("widths").to_pylist()
            for k, f in enumerate(_FIELDS):
                got[f] += [_widened(x, v[k]) for x, v in zip(b.column(f).to_pylist(), widths, strict=True)]
            sources += list(zip(b.column("block").to_pylist(), b.column("n").to_pylist(), strict=True))
            for block, docs, base, known_words, own_sums in zip(*(b.column(x).to_pylist() for x in ("block", "docs", "base", "known", "own")), strict=True):
                if docs is not None:
                    yield _sums(DOCS, block, docs, base, known_words)
                if own_sums is not None:
                    at = np.concatenate(([32], 32 + np.cumsum(np.frombuffer(own_sums[:32], "<i8"))))
                    linear, small, heads, cols = (own_sums[i:j] for i, j in zip(at[:-1], at[1:], strict=True))
                    yield _sums(LINEAR, block, linear, small)
                    if heads:
                        keys, head = np.unique(np.frombuffer(heads, "<i8").view(np.uint64), return_inverse=True)
                        yield _sums(UNSEEN, -1, np.zeros((len(keys), K + 4)), keys, np.full(len(head), block, "<i8"), np.frombuffer(cols, "<i8"), head.astype("<i8"))
        if not sources:
            return
        sizes = np.array([len(x) for x in got["refs"]])
        x = {f: np.concatenate(v) for f, v in got.items()}
        per = x["pairs"]
        h, ch, w = np.repeat(x["h"].view(np.uint64), per), np.repeat(x["ch"], per), x["w"].view(np.uint64)
        order = np.lexsort((w, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
        begin = np.flatnonzero(new) if len(h) else np.zeros(0, np.int64)
        total = np.add.reduceat(x["ct"][order], begin) if len(begin) else begin
        key_h, key_ch, share = h[order][begin], ch[order][begin] >> 1, model.share(x["cw"][order][begin])
        yield _sums(COUNTS, -1, np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1 : K + 2].astype("<i8"))
        if not len(begin):
            return
        # statistics by history: bigrams of count 1 .. K, number and sum of the larger counts, shares of the seen words
        lead = np.flatnonzero(np.append(True, key_h[1:] != key_h[:-1]))
        stats = np.zeros((len(lead), K + 4))
        for r in range(1, K + 1):
            stats[:, r - 1] = np.add.reduceat((total == r).astype(np.float64), lead)
        stats[:, K] = np.add.reduceat((total > K).astype(np.float64), lead)
        stats[:, K + 1] = np.add.reduceat(np.where(total > K, total, 0).astype(np.float64), lead)
        stats[:, K + 2] = np.add.reduceat(np.where(total > 0, share, 0), lead)
        stats[:, K + 3] = key_ch[lead]
        number = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(key_h))))
        hot = (ch[order][begin] & 1)[lead] == 1
        for i in np.flatnonzero(hot):
            yield _sums(HOT, -1, stats[i], hot=int(key_h[lead[i]].view(np.int64)))
        seen = total > 0
        key_w = w[order][begin]
        yield _sums(TABLE, -1, key_h[seen], key_w[seen], _packed(total[seen]))
        cold = ~hot & (stats[:, K + 3] > 0)
        yield _sums(HISTORIES, -1, key_h[lead[cold]], stats[cold])
        unseen = (total == 0) & (key_ch > 0)
        value = _linear(total, key_ch, share)
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        low = np.where(total <= K, total, 0)
        pair_of_ref = np.repeat(of, x["nr"])
        refs = x["refs"]
        at = np.concatenate(([0], np.cumsum(sizes)))
        rows, cols, heads = [], [], []
        for s, (block, n) in enumerate(sources):
            r, q = refs[at[s] : at[s + 1]], pair_of_ref[at[s] : at[s + 1]]
            if not len(r):
                continue
            # all texts of the block, or those that have bigrams here if they are few
            some, to = np.unique(r, return_inverse=True)
            if 2 * len(some) > n:
                some, to = None, r
            m = n if some is None else len(some)
            linear = np.bincount(to, value[q], m)
            small = np.bincount(to * (K + 1) + low[q], minlength=m * (K + 1)).reshape(m, K + 1)[:, 1:]
            yield _sums(LINEAR, block, linear, small.astype("<u2" if small.max(initial=0) < 65536 else "<i8"), None if some is None else some.astype("<u4"))
            miss = unseen[q]
            if miss.any():
                rows.append(np.full(int(miss.sum()), block))
                cols.append(r[miss])
                heads.append(number[q[miss]])
        if rows:
            used, head = np.unique(np.concatenate(heads), return_inverse=True)
            yield _sums(UNSEEN, -1, stats[used], key_h[lead[used]], np.concatenate(rows).astype("<i8"), np.concatenate(cols).astype("<i8"), head.astype("<i8"))

    return stored(counted.mapInArrow(tidy(send), _PAIRS_SQL).repartitionById(n_parts, "p").mapInArrow(tidy(meet), _SUMS_SQL), "bigrams")


def _linear(total: np.ndarray, history: np.ndarray, share: np.ndarray) -> np.ndarray:
    """log10 of what is known of a bigram's probability before the discounts and weights are: the discount's factor is left
    out up to K, and the weight where the bigram is unseen."""
    with np.errstate(divide="ignore"):
        return np.where(total > 0, np.log10(np.where(total > K, total - LARGE, np.maximum(total, 1)) / np.maximum(history, 1)), np.log10(share))


def _sums(kind: int, block: int, *values, hot: int | None = None) -> pa.RecordBatch:
    raw = [v if isinstance(v, bytes) or v is None else np.ascontiguousarray(v).tobytes() for v in values]
    raw += [None] * (5 - len(raw))
    return blob_table(_SUMS, {"kind": [kind], "block": [block], **{f: [v] for f, v in zip("abcde", raw, strict=True)}, "hot": [hot]})


def log_alpha(stats: np.ndarray, d: Discounts) -> np.ndarray:
    """log10 of the backoff weights from the statistics by history."""
    kept = stats[:, :K] @ (d.low[1:] * np.arange(1, K + 1)) + stats[:, K + 1] - LARGE * stats[:, K]
    with np.errstate(divide="ignore", invalid="ignore"):  # a history that training lacks has no weight, and needs none
        return np.log10((1 - kept / stats[:, K + 3]) / (1 - stats[:, K + 2]))


_SCORED = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])


class Model:
    """A trained model: `unigrams` (w, count), `bigrams` (h, w, count) and `histories` (h, count, log_alpha), kept as hash
    partitions in the shared folder. Words are 64-bit hashes; the begin of a text is BOS, its end END."""

    def __init__(self, unigrams: DataFrame, sums: DataFrame, base: Unigrams, d: Discounts, hot: list[tuple]):
        self.base, self.d = base, d
        self.unigrams = unigrams.where("kind = 3").select("a", "b").mapInArrow(tidy(_words), "w long, count long")
        self.bigrams = sums.where(F.col("kind") == TABLE).select("a", "b", "c").mapInArrow(tidy(_table), "h long, w long, count long")
        columns = "h long, count long, log_alpha double"

        def weights(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for h, stats in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
                    stats = np.frombuffer(stats, np.float64).reshape(-1, K + 4)
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, "<i8")), pa.array(stats[:, K + 3].astype(np.int64)), pa.array(log_alpha(stats, d))], names=["h", "count", "log_alpha"])

        self.histories = sums.where(F.col("kind") == HISTORIES).select("a", "b").mapInArrow(tidy(weights), columns)
        if hot:
            stats = np.array([r[1:] for r in hot], np.float64)
            rows = [(int(r[0]), int(r[-1]), float(x)) for r, x in zip(hot, log_alpha(stats, d), strict=True) if r[-1] > 0]
            self.histories = self.histories.unionByName(sums.sparkSession.createDataFrame(rows, columns))

    def log_probability(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """key and score (log10 probability) of every row, looked up in the tables: a bigram that was seen has its own
        probability, another one its history's weight times the word's. Rows that repeat a key are added up."""
        spark = docs.sparkSession
        small_batches(spark)

        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(len(b)):
                    for _, offsets, data in runs(b.column("text").slice(i, 1)):
                        data = LOWER[data]
                        starts, ends, _ = spans(data, offsets, SPACED)
                        w = np.append(word_hashes(data, starts, ends), END)
                        pairs, n = np.unique(np.stack([np.append(BOS, w[:-1]), w], 1), axis=0, return_counts=True)
                        yield pa.RecordBatch.from_arrays([b.column("key").slice(i, 1).take(pa.array(np.zeros(len(n), np.int64))), pa.array(pairs[:, 0].view(np.int64)), pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64)), pa.array(n)], names=["key", "h", "w", "n"])

        asked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(tidy(work), "key long, h long, w long, n long")
        found = asked.join(self.bigrams.withColumnRenamed("count", "c"), ["h", "w"], "left").join(self.unigrams.withColumnRenamed("count", "cw"), "w", "left").join(self.histories.withColumnRenamed("count", "ch"), "h", "left")

        def kept(d: Discounts, c: Column) -> Column:
            out = F.when(c > K, c - F.lit(LARGE))
            for r in range(1, K + 1):
                out = out.when(c == r, F.lit(float(r * d.low[r])))
            return out

        share = F.coalesce(kept(self.base.d, F.col("cw")) / F.lit(float(max(self.base.tokens, 1))), F.lit(float(self.base.unseen)))
        p = F.when(F.col("c").isNotNull(), F.log10(kept(self.d, F.col("c")) / F.col("ch"))).otherwise(F.coalesce("log_alpha", F.lit(0.0)) + F.log10(share))
        return found.groupBy("key").agg(F.sum(p * F.col("n")).alias("score")).withColumnRenamed("key", key)


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w, count in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(w, "<i8")), pa.array(_unpacked(count))], names=["w", "count"])


def _table(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for h, w, count in zip(*(b.column(x).to_pylist() for x in "abc"), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, "<i8")), pa.array(np.frombuffer(w, "<i8")), pa.array(_unpacked(count))], names=["h", "w", "count"])


def score(docs: DataFrame, train, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score (log10 probability) of every row: see fit_score."""
    return fit_score(docs, train, key, text)[0]


def fit_score(docs: DataFrame, train, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Model]:
    """(scores, model), trained on the rows where the column expression `train` is true (null: not). scores: id, n_tokens,
    n_known, train_tokens, base_score and score (log10 probability) of every row.

    Words are what white space parts, A-Z in small letters; every text ends with one end token, so a null or empty text
    has that alone. Words that training lacks are one class. Without training texts every score follows from that class;
    an empty table gives no rows. Ids are read as longs; rows that repeat an id, or have none, are scored each by itself.
    Other columns are not read, whatever their names."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    blocks = _blocks(rows)
    unigrams = _unigrams(blocks)
    stats = np.sum([np.frombuffer(r[0], "<i8") for r in unigrams.where("kind = 2").select("a").collect()] or [np.zeros(K + 4, np.int64)], axis=0)
    tokens, words, occurrences = (int(x) for x in stats[:3])
    base = Unigrams(tokens, words, stats[3:])
    texts, every = rows.agg(F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0)), F.count(F.lit(1))).first()
    counted = _counted(blocks, unigrams)
    discard(blocks)
    words_only = stored(unigrams.where("kind = 3"), "words")
    discard(unigrams)
    unigrams = words_only
    often = max(OFTEN, occurrences // (4 * partitions(spark)))
    frequent = _frequent(counted, texts, every, often)
    turns = [_bigrams(counted, base, texts, every, often, frequent, turn) for turn in range(PASSES)]
    discard(counted)
    sums = turns[0]
    for more in turns[1:]:
        sums = sums.unionByName(more)
    counts = np.sum([np.frombuffer(r[0], "<i8") for r in sums.where(F.col("kind") == COUNTS).select("a").collect()] or [np.zeros(K + 1, np.int64)], axis=0)
    # frequent bigrams and histories: at most a few times the number of partitions
    for _, _, c, _ in frequent:
        if 0 < c <= K + 1:
            counts[c - 1] += 1
    d = Discounts(counts)
    hot = sums.where(F.col("kind") == HOT).select("hot", "a").mapInArrow(tidy(_wide), "hot long, " + ", ".join(f"s{i} double" for i in range(K + 4)))
    hot = hot.groupBy("hot").agg(*(F.sum(f"s{i}") for i in range(K + 3)), F.max(f"s{K + 3}")).collect()
    hot = _with_frequent({r[0]: np.array(r[1:], np.float64) for r in hot}, frequent, base, unigrams, texts)
    hot_keys = np.array(sorted(hot), np.int64).view(np.uint64)
    hot_keys = np.sort(hot_keys)
    hot_alpha = log_alpha(np.array([hot[int(k.view(np.int64))] for k in hot_keys], np.float64).reshape(-1, K + 4), d) if len(hot_keys) else np.zeros(0)

    def backed_off(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kind, block, a, bb, c, dd, e in zip(*(b.column(x).to_pylist() for x in ("kind", "block", "a", "b", "c", "d", "e")), strict=True):
                if kind != UNSEEN:
                    yield _sums(kind, block, a, bb, c)
                    continue
                keys = np.frombuffer(bb, np.uint64)
                alpha = log_alpha(np.frombuffer(a, np.float64).reshape(-1, K + 4), d)
                if len(hot_keys):
                    at = np.minimum(np.searchsorted(hot_keys, keys), len(hot_keys) - 1)
                    alpha = np.where(hot_keys[at] == keys, hot_alpha[at], alpha)
                of, doc, head = (np.frombuffer(v, "<i8") for v in (c, dd, e))
                for one in np.unique(of):
                    mine = of == one
                    yield _sums(UNSEEN, int(one), np.bincount(doc[mine], alpha[head[mine]]))

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, directory, base, known, total = None, None, None, None, None
        with np.errstate(divide="ignore"):
            low = np.log10(d.low[1:])

        def finish() -> pa.RecordBatch:
            n = directory["n"].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(directory["id"]), mask=directory["known"] == 0), pa.array(n), pa.array(known), pa.array(base - n * np.log10(tokens + 0.5 * (words + 1))), pa.array(total)], schema=_SCORED)

        for b in batches:
            for kind, block, a, bb, c in zip(*(b.column(x).to_pylist() for x in ("kind", "block", "a", "b", "c")), strict=True):
                if block != now:
                    if directory is not None:
                        yield finish()
                    now = block
                if kind == DOCS:
                    directory, base, known = np.frombuffer(a, _DOC), np.frombuffer(bb, np.float64), np.frombuffer(c, np.int64)
                    total = np.zeros(len(directory))
                elif kind == LINEAR:
                    linear = np.frombuffer(a, np.float64)
                    small = np.frombuffer(bb, "<u2" if len(bb) == 2 * K * len(linear) else "<i8").reshape(-1, K)
                    total[slice(None) if c is None else np.frombuffer(c, "<u4")] += linear + small @ low
                else:
                    part = np.frombuffer(a, np.float64)
                    total[: len(part)] += part
        if directory is not None:
            yield finish()

    flat = sums.where(F.col("kind") <= UNSEEN).select("kind", "block", "a", "b", "c", "d", "e").mapInArrow(tidy(backed_off), _SUMS_SQL).select("kind", "block", "a", "b", "c")
    done = flat.repartition(2 * partitions(spark), "block").sortWithinPartitions("block", "kind").mapInArrow(tidy(added), "id long, n_tokens long, n_known long, base double, score double")
    scores = done.select("id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
    pairs = spark.createDataFrame(pa.table({"h": pa.array([x[0] for x in frequent], pa.int64()), "w": pa.array([x[1] for x in frequent], pa.int64()), "count": pa.array([x[2] for x in frequent], pa.int64())})) if frequent else None
    model = Model(unigrams, sums, base, d, [(int(k.view(np.int64)), *hot[int(k.view(np.int64))]) for k in hot_keys])
    if pairs is not None:
        model.bigrams = model.bigrams.unionByName(pairs.where("count > 0"))
    return scores, model


def _with_frequent(hot: dict[int, np.ndarray], frequent: list[tuple[int, int, int, int]], base: Unigrams, unigrams: DataFrame, texts: int) -> dict[int, np.ndarray]:
    """The statistics of the frequent histories, the frequent bigrams added. Their words' counts are read from the stored table."""
    if not frequent:
        return hot
    wanted = {x for h, w, _, _ in frequent for x in (h, w)}
    words = unigrams.where("kind = 3").select("a", "b").mapInArrow(tidy(_words), "w long, count long")
    few = words.sparkSession.createDataFrame([(x,) for x in wanted], "w long")
    count = dict(tuple(r) for r in words.join(F.broadcast(few), "w").collect()) | {int(BOS.view(np.int64)): texts}
    for h, w, c, _ in frequent:
        stats = hot.setdefault(h, np.zeros(K + 4))
        stats[K + 3] = count.get(h, 0)
        if c:
            stats[K + 2] += float(base.share(np.array([count.get(w, 0)]))[0])
            if c <= K:
                stats[c - 1] += 1
            else:
                stats[K] += 1
                stats[K + 1] += c
    return hot


def _wide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = np.frombuffer(b"".join(b.column("a").to_pylist()), np.float64).reshape(len(b), -1)
        yield pa.RecordBatch.from_arrays([b.column("hot"), *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=["hot", *(f"s{i}" for i in range(x.shape[1]))])
