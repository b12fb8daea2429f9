"""Suffix-array dedup of byte strings by induced sorting with queues that spill to disk.

Suffixes of a shard are sorted by induction: from the order of its leftmost-small (LMS) suffixes the larger and then the
smaller types follow by one scan each. The scan takes suffixes from a priority queue keyed by first byte, first in first
out within a byte, which is what the induction needs; the queue holds blocks of positions and puts full ones on disk.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillon.llm.anchors import Spec, removed, repeated_spans
from quillon.llm.common import BYTE_CODE, mix, prefix_hash, span_hash

#: Positions that a queue holds in memory before it writes to disk.
IN_MEMORY = 8_000_000


class BucketQueue:
    """A monotone priority queue: blocks of positions by key, first in first out within a key, spilling to a file."""

    def __init__(self, keys: int, limit: int = IN_MEMORY):
        self.blocks: list[list] = [[] for _ in range(keys)]
        self.limit, self.held, self.file = limit, 0, None

    def push(self, key: int, block: np.ndarray) -> None:
        if self.held + len(block) > self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()  # in the executor's own folder; gone when closed
            self.file.seek(0, 2)
            self.blocks[key].append((self.file.tell(), len(block)))
            self.file.write(block.astype(np.int64).tobytes())
        else:
            self.held += len(block)
            self.blocks[key].append(block)

    def pop(self, key: int) -> np.ndarray:
        out = []
        for block in self.blocks[key]:
            if isinstance(block, tuple):
                self.file.seek(block[0])
                block = np.frombuffer(self.file.read(8 * block[1]), dtype=np.int64)
            else:
                self.held -= len(block)
            out.append(block)
        self.blocks[key] = []
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def deal(self, positions: np.ndarray, keys: np.ndarray) -> None:
        """Push each position under its key, keeping the order within a key."""
        if not len(positions):
            return
        order = np.argsort(keys, kind="stable")
        positions, keys = positions[order], keys[order]
        head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        for a, b in zip(head, [*head[1:], len(keys)]):
            self.push(int(keys[a]), positions[a:b])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the one that follows; the last is larger than the empty suffix."""
    n = len(s)
    differs = np.full(n, n - 1)
    change = np.flatnonzero(s[:-1] != s[1:])
    differs[change] = change
    differs = np.minimum.accumulate(differs[::-1])[::-1]
    return (differs < n - 1) & (s[differs] < s[np.minimum(differs + 1, n - 1)])


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, keys: int) -> np.ndarray:
    """The order of all suffixes from the order of the LMS suffixes (or of all LMS substrings from any order by first key)."""
    seeds = BucketQueue(keys)
    seeds.deal(lms, s[lms])
    queue, larger = BucketQueue(keys), BucketQueue(keys)
    queue.push(int(s[-1]), np.array([len(s) - 1]))
    for c in range(keys):
        while len(block := queue.pop(c)):
            larger.push(c, block)
            before = block[block > 0] - 1
            before = before[~small[before]]
            queue.deal(before, s[before])
        block = seeds.pop(c)
        before = block[block > 0] - 1
        before = before[~small[before]]
        queue.deal(before, s[before])
    out: list[np.ndarray] = []
    for c in range(keys - 1, -1, -1):
        mine = []
        while len(block := queue.pop(c)):  # the greatest first
            mine.append(block)
            before = block[block > 0] - 1
            before = before[small[before]]
            queue.deal(before, s[before])
        block = larger.pop(c)[::-1]
        before = block[block > 0] - 1
        before = before[small[before]]
        queue.deal(before, s[before])
        out += [*mine, block]
    for q in (seeds, queue, larger):
        q.close()
    return np.concatenate(out)[::-1] if out else np.zeros(0, np.int64)


def _doubling(names: np.ndarray) -> np.ndarray:
    """The suffix order of a string over a large alphabet, by prefix doubling."""
    rank, k, n = names.astype(np.int64), 1, len(names)
    while True:
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1 or k >= n:
            return order
        k *= 2


def suffix_order(s: np.ndarray, keys: int = 257) -> np.ndarray:
    """Positions of s (numbers below `keys`) in the order of their suffixes."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    small = suffix_types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms):
        by_part = _induce(s, small, lms, keys)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ranked = by_part[is_lms[by_part]]
        # Names of LMS substrings: equal ones share a name. Each ends with the next LMS position.
        which = np.searchsorted(lms, ranked)
        stop = np.minimum(np.concatenate([lms[1:], [n - 1]])[which] + 1, n)
        codes = mix(s.astype(np.uint64) + np.uint64(1))
        one, two = prefix_hash(codes, 0), prefix_hash(codes, 1)
        a, b, size = span_hash(one, ranked, stop, 0), span_hash(two, ranked, stop, 1), stop - ranked
        differ = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (size[1:] != size[:-1]) | (which[1:] == len(lms) - 1) | (which[:-1] == len(lms) - 1)
        name = np.concatenate([[0], np.cumsum(differ)])
        if name[-1] < len(lms) - 1:
            string = np.empty(len(lms), np.int64)
            string[which] = name
            inner = suffix_order(string, int(name[-1]) + 1) if name[-1] < 512 else _doubling(string)
            ranked = lms[inner]
        lms = ranked
    return _induce(s, small, lms, keys)


def repeated_windows(table: pa.Table, spec: Spec) -> tuple[np.ndarray, ...]:
    """Of all variants of a shard, the windows that stand at two places or more."""
    doc, mark, start, known = (table.column(c).to_numpy() for c in ("doc", "mark", "start", "known"))
    pieces = table.column("piece").to_pylist()
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    text = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    s = text.astype(np.int64) + 1
    s[begin + sizes] = 0  # ends pieces
    order = suffix_order(s)
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    offset = np.arange(len(s)) - begin[piece]
    whole = offset[order] + spec.length <= sizes[piece[order]]
    at = order[whole]  # neighbours among whole windows are neighbours wherever their common prefix is long enough
    codes = BYTE_CODE[text]
    one, two = (span_hash(prefix_hash(codes, k), at, at + spec.length, k) for k in (0, 1))
    same = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
    again = at[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(at) else at
    again = np.sort(again[known[piece[again]] == 0])
    # Consecutive windows of one piece are one range.
    head = np.flatnonzero(np.concatenate([[True], (again[1:] != again[:-1] + 1) | (piece[again[1:]] != piece[again[:-1]])])) if len(again) else again
    last = again[np.concatenate([head[1:], [len(again)]]) - 1] if len(again) else again
    first = again[head]
    p = piece[first]
    return doc[p], mark[p], start[p] + offset[first], start[p] + offset[last] + spec.length


def _cut_bytes(text: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[int, bytes]:
    out, at = [], 0
    for a, b in zip(start.tolist(), stop.tolist()):
        out.append(text[at:a])
        at = b
    return len(text), b"".join([*out, text[at:]]) if out else text


def dedup_bytes(docs: DataFrame, length: int = 400) -> DataFrame:
    """Remove every byte of docs (doc_id, text) that a string of `length` bytes covers which also starts anywhere else.

    Texts are UTF-8 bytes, null is empty; matches never cross documents, may overlap, and are judged on the input.
    Returns doc_id, n_units (bytes), spans (maximal removed ranges) and kept (binary: a cut may fall inside a
    character). Rows that repeat doc_id and text are documents of their own, and so repeat each other. A null doc_id is
    kept as null. An empty table gives no rows.
    """
    spec = Spec("byte", length, max(1, length // 2), keep_first=False)
    return removed(repeated_spans(docs, spec, repeated_windows), _cut_bytes, "binary")
