"""Byte-level BPE encoding and decoding by a monoid tree reduction.

The encoding of a piece is a tree: halves are encoded recursively and joined. A join keeps the tokens of both sides and
re-encodes a window around the boundary, growing it until the tokens at both of its ends are compatible with their
neighbours outside. Two tokens are compatible when the bytes of both together encode to these two tokens; a sequence whose
adjacent tokens are all compatible is the encoding of its bytes, so nothing outside a stable window can change.
Matches of the pattern are encoded apart: between them the join is plain concatenation.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from terrane.llm._bytes import as_binary, tidy
from terrane.llm._shared import small_batches

#: Bytes of the longest subtrees that are kept for reuse. The leaves of the tree are single bytes.
KEPT_BYTES = 6
_TWO_SPACES = regex.compile(r"\s\s")
#: Fixed value: a pattern whose matches, in texts without two white-space characters in a row, span neither a newline nor the
#: place before a space. Texts are matched unit by unit under it, and as a whole under any other pattern.
UNIT_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class TreeBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kept: int = 200_000):
        self.ranks, self.kept = ranks, kept
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self._by_units = pattern == UNIT_PATTERN
        self.forget()
        self._newline = self._packed("\n")

    def forget(self) -> None:
        """Empty the caches, which would stay in an idle worker's memory."""
        self._spines: tuple[dict, dict] = ({}, {})
        self._trees: dict[bytes, tuple[set[int], set[int]]] = {}
        self._pairs: dict[tuple[int, int], tuple[int, ...] | None] = {}
        self._subtrees: dict[bytes, tuple[int, ...]] = {}
        self._plain, self._after_space = _Units(self, ""), _Units(self, " ")

    # -- one piece ---------------------------------------------------------------------------------------------------
    def merge(self, window: bytes) -> tuple[int, ...]:
        """The encoding of a window from its single bytes: the lowest rank first, of equal ones the leftmost."""
        ranks, n = self.ranks, len(window)
        if n <= 24:
            return self._merge_short(window)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(window[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(window[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if (h := before[i]) >= 0 and (r := ranks.get(window[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[window[i : end[i]]])
            i = after[i]
        return tuple(out)

    def _merge_short(self, window: bytes, seen=None) -> tuple[int, ...]:
        """The same by looking at all adjacent parts for each merge."""
        ranks = self.ranks
        get, none = ranks.get, len(ranks) + 1
        parts = [window[i : i + 1] for i in range(len(window))]
        costs = [get(window[i : i + 2], none) for i in range(len(window) - 1)]
        while costs and (least := min(costs)) != none:
            i = costs.index(least)
            parts[i : i + 2] = [merged := parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = get(merged + parts[i + 1], none)
            if i:
                costs[i - 1] = get(parts[i - 1] + merged, none)
            if seen:
                seen(parts)
        return tuple([ranks[p] for p in parts])

    def _spine(self, token: int, right: bool) -> list[tuple[bytes, float]]:
        """What stands at one edge of a token while it is being merged, from the single byte on, each with the rank of
        the merge that consumes it. Ranks are token ids, so that is the id of the next entry; the token itself stays."""
        cache = self._spines[right]
        out = cache.get(token)
        if out is None:
            whole = self.bytes_of[token]
            grown = [n for n in range(1, len(whole) + 1) if self._stands(whole, n, right)]
            parts = [whole[-n:] if right else whole[:n] for n in grown]
            out = cache[token] = [*zip(parts, [*(self.ranks[p] for p in parts[1:]), float("inf")], strict=True)]
        return out

    def _stands(self, whole: bytes, n: int, right: bool) -> bool:
        if n in (1, len(whole)):
            return True
        steps = self._trees.get(whole)
        if steps is None:
            steps = self._trees[whole] = self._edges(whole)
        return n in steps[right]

    def _edges(self, whole: bytes) -> tuple[set[int], set[int]]:
        """Lengths of the parts at the left and at the right edge in the course of the merges."""
        left, right = set(), set()
        self._merge_short(whole, lambda parts: (left.add(len(parts[0])), right.add(len(parts[-1]))))
        return left, right

    def compatible(self, a: int, b: int) -> bool:
        """No merge across the boundary comes before the merges inside the two tokens; of equal ranks the leftmost is first."""
        x, y, i, j, ranks = self._spine(a, True), self._spine(b, False), 0, 0, self.ranks
        while True:
            (p, until_p), (q, until_q) = x[i], y[j]
            across = ranks.get(p + q)
            if across is not None and across < until_p and across <= until_q:
                return False
            if until_p <= until_q:
                i += 1
                if i == len(x):
                    return True
            else:
                j += 1

    def _meet(self, a: int, b: int) -> tuple[int, ...] | None:
        """What two adjacent tokens become: the encoding of their bytes, or None if they are compatible."""
        known = self._pairs.get((a, b), False)
        if known is False:
            known = None if self.compatible(a, b) else self.merge(self.bytes_of[a] + self.bytes_of[b])
            if len(self._pairs) > self.kept:
                self._pairs.clear()
            self._pairs[a, b] = known
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the joined bytes of two encodings."""
        if not left or not right:
            return left or right
        middle = self._meet(left[-1], right[0])
        if middle is None:
            return left + right
        i = j = 1
        while True:
            left_ok = i == len(left) or self._meet(left[-i - 1], middle[0]) is None
            right_ok = j == len(right) or self._meet(middle[-1], right[j]) is None
            if left_ok and right_ok:
                return left[: len(left) - i] + middle + right[j:]
            i, j = i if left_ok else min(2 * i, len(left)), j if right_ok else min(2 * j, len(right))
            middle = self.merge(b"".join([self.bytes_of[t] for t in left[len(left) - i :] + right[:j]]))

    def _tree(self, piece: bytes) -> tuple[int, ...]:
        """Halves down to single bytes; short subtrees are kept for reuse."""
        if len(piece) == 1:
            return (self.ranks[piece],)
        short = len(piece) <= KEPT_BYTES
        if short and (got := self._subtrees.get(piece)) is not None:
            return got
        half = len(piece) // 2
        out = self.join(self._tree(piece[:half]), self._tree(piece[half:]))
        if short:
            if len(self._subtrees) > self.kept // 2:
                self._subtrees.clear()
            self._subtrees[piece] = out
        return out

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """A piece that is a token is that token, whatever its merges would give."""
        rank = self.ranks.get(piece)
        return (rank,) if rank is not None else self._tree(piece) if piece else ()

    # -- whole texts -------------------------------------------------------------------------------------------------
    def _packed(self, text: str) -> bytes:
        ids = [t for piece in self.find(text) for t in self.encode_piece(piece.encode())]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers.

        Under UNIT_PATTERN and without two white-space characters in a row, units between newlines and spaces are looked
        up; any other text is matched as a whole.
        """
        if not text:
            return b""
        if not self._by_units:
            return self._packed(text)
        if _TWO_SPACES.search(text):
            return self._concat([self._plain[piece] if piece[:1] != " " else self._after_space[piece[1:]] for piece in self.find(text)])
        lines = []
        for line in text.split("\n"):
            units = line.split(" ")
            lines.append(self._plain[units[0]] + b"".join([self._after_space[u] for u in units[1:]]))
        return self._concat(lines, self._newline)

    @staticmethod
    def _concat(parts: list[bytes], between: bytes = b"") -> bytes:
        return between.join(parts)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a run of ids, concatenated up the tree of halves."""
        if len(ids) > 4096:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join([self.bytes_of[t] for t in ids.tolist()])


class _Units(dict):
    """Ids of a unit behind a fixed prefix, made when first asked for. There are two generations: when the younger is full
    it becomes the older, and what is still asked for comes over from there."""

    def __init__(self, owner: TreeBPE, prefix: str):
        super().__init__()
        self.owner, self.prefix, self.older = owner, prefix, {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.owner._packed(self.prefix + unit)
        if len(unit) <= 64:
            if len(self) >= self.owner.kept:
                self.older = dict(self)
                self.clear()
            self[unit] = ids
        return ids


_loaded: dict[tuple[str, str], TreeBPE] = {}


def tokenizer(path: str, pattern: str) -> TreeBPE:
    """The process's encoder for a rank file, loaded once."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = TreeBPE(load_ranks(path), pattern)
    return _loaded[path, pattern]


def _mapped(df: DataFrame, column: str, outs: list[str], path: str, pattern: str, step: Callable[[TreeBPE, bytes], tuple[bytes, ...]], limit: int) -> DataFrame:
    """Binary columns `outs` made from one column, value by value, in one worker a task."""
    small_batches(df.sparkSession)
    clash = set(outs) & set(df.columns)
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern)
        try:
            for batch in batches:
                values = as_binary(batch.column(batch.schema.get_field_index(column)))
                made, size, first = [], 0, 0
                for i, value in enumerate(values):
                    made.append(step(bpe, value.as_py()))
                    size += sum(map(len, made[-1]))
                    if size >= limit or i + 1 == len(values):
                        part = batch.slice(first, i + 1 - first)
                        yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x, pa.binary()) for x in zip(*made, strict=True))], names=[*part.schema.names, *outs])
                        made, size, first = [], 0, i + 1
        finally:
            bpe.forget()

    return df.mapInArrow(tidy(work), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + "".join(f", `{o}` binary" for o in outs))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", limit: int = 8 << 20) -> DataFrame:
    """Adds the token ids of whole texts as a binary column of little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Rows are kept as they are, repeats and extra columns included. No special tokens.
    An empty table stays empty. Columns named like the new ones are an error.
    """
    return _mapped(df, text, [ids], path, pattern, lambda bpe, b: (bpe.encode(b.decode("utf-8")),), limit)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded", limit: int = 8 << 20) -> DataFrame:
    """Adds the bytes that the ids stand for; null ids decode to empty bytes. An id without a token raises KeyError."""
    return _mapped(df, ids, [out], path, pattern, lambda bpe, b: (bpe.decode(np.frombuffer(b, "<u4")),), limit)


def encode_and_decode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded", limit: int = 8 << 20) -> DataFrame:
    """Both: the ids, and the bytes that these ids decode to, in one worker a task instead of two."""

    def step(bpe: TreeBPE, b: bytes) -> tuple[bytes, bytes]:
        made = bpe.encode(b.decode("utf-8"))
        return made, bpe.decode(np.frombuffer(made, "<u4"))

    return _mapped(df, text, [ids, out], path, pattern, step, limit)
