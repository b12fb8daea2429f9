"""Byte-level BPE with a two-tier lookup: whole pre-tokens by a minimal perfect hash, the rest by merging linked bytes.

A batch's pre-tokens are told apart once. Those that are in the vocabulary are found by one vectorised probe each: two
hash values give the slot, and the bytes that stand there are compared, so that an unknown pre-token is never taken for a
known one. Only what misses is merged, lowest rank first, by a heap of pairs over a doubly linked list of its bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice
from operator import methodcaller
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from quillon.llm.common import U64, mix, slices, text_bytes, word_codes

#: Keys of a bucket, on average; each bucket has one displacement.
LOAD = 4
STEP = U64(0x9E3779B97F4A7C15)
NONE = 1 << 31
#: Pre-tokens of up to so many bytes are kept once merged, at most twice so many of them; links of longer ones go into arrays.
SHORT, CACHE, LONG = 64, 150_000, 4096
#: Bytes of text, and pre-tokens, that are taken at once.
TEXTS, AT_ONCE = 2 << 20, 250_000
GROUP = methodcaller("group")


def _concat(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all spans one after the other, and where each begins (one more at the end)."""
    sizes = ends - starts
    edges = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=edges[1:])
    return data[np.repeat(starts - edges[:-1], sizes) + np.arange(edges[-1])], edges


class PerfectHash:
    """A minimal perfect hash over different byte strings: n keys, n slots, about one displacement for four keys.

    Buckets are placed from the largest on; the displacement of a bucket is the first that sends all of its keys to free
    slots. `find` compares the bytes in the slot, so strings that are no keys are not found.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // LOAD)
        data, edges = text_bytes(pa.array(keys, pa.large_binary()))
        code = word_codes(data, edges[:-1], edges[1:]) if len(keys) else np.zeros(0, U64)
        bucket = (mix(code) % U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.displacement = np.zeros(self.buckets, dtype=U64)
        self.slot_key = np.full(self.n, -1, dtype=np.int64)
        for b in np.argsort(-np.diff(cuts), kind="stable").tolist():
            own = order[cuts[b] : cuts[b + 1]]
            if not len(own):
                break
            first = U64(0)
            while True:
                tries = first + np.arange(64 if len(own) > 1 else 4096, dtype=U64)
                slots = self._slots(code[own][None, :], tries[:, None])
                free = (self.slot_key[slots] < 0).all(axis=1)
                for t in np.flatnonzero(free).tolist():
                    if len(set(slots[t].tolist())) == len(own):
                        break
                else:
                    first += U64(len(tries))
                    continue
                self.displacement[b] = tries[t]
                self.slot_key[slots[t]] = own
                break
        self.data, self.edges = data, edges

    def _slots(self, code: np.ndarray, displacement: np.ndarray) -> np.ndarray:
        return (mix(code + displacement * STEP) % U64(self.n)).astype(np.int64)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of the key that equals each span, -1 if none does."""
        if not self.n or not len(starts):
            return np.full(len(starts), -1, dtype=np.int64)
        code = word_codes(data, starts, ends)
        key = self.slot_key[self._slots(code, self.displacement[(mix(code) % U64(self.buckets)).astype(np.int64)])]
        at = np.flatnonzero(self.edges[key + 1] - self.edges[key] == ends - starts)
        one, edges = _concat(data, starts[at], ends[at])
        two, _ = _concat(self.data, self.edges[key[at]], self.edges[key[at] + 1])
        out = np.full(len(starts), -1, dtype=np.int64)
        alike = np.zeros(len(one) + 1, dtype=np.int64)
        np.cumsum(one == two, out=alike[1:])
        same = at[np.diff(alike[edges]) == np.diff(edges)]
        out[same] = key[same]
        return out


class Vocabulary:
    """Tokens by rank; the rank of a token is its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing or b"" in ranks:
            raise ValueError("a byte-level vocabulary has every single byte and no empty token")
        self.pattern = pattern
        self.digest = hashlib.sha256(repr((pattern, ranks)).encode()).hexdigest()
        self.tokens, self.ids = list(ranks), np.array(list(ranks.values()), dtype=np.int64)
        self.hash = PerfectHash(self.tokens)
        size = int(self.ids.max()) + 1
        self.starts, self.ends = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self.starts[self.ids], self.ends[self.ids] = self.hash.edges[:-1], self.hash.edges[1:]

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Vocabulary:
        """Lines of a token in base 64 and its rank."""
        lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where each id's begin (one more at the end)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.starts) or (self.starts[ids] < 0).any()):
            raise ValueError("an id that is not in the vocabulary")
        return _concat(self.hash.data, self.starts[ids], self.ends[ids])


class Encoder:
    """Texts to ids, in a task: the vocabulary and what only merging needs."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(vocabulary.pattern)
        ids = dict(zip(vocabulary.tokens, vocabulary.ids.tolist()))
        self.single, self.shift = [ids[bytes([b])] for b in range(256)], len(vocabulary.starts).bit_length()
        # What two adjacent tokens become: every way to cut a token into two others, by the numbers of the two.
        self.pairs = {ids[t[:k]] << self.shift | ids[t[k:]]: r for t, r in ids.items() for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids}
        self.merged: dict[bytes, array] = {}
        self.older: dict[bytes, array] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank is joined first, the leftmost of several."""
        n, get, shift = len(piece), self.pairs.get, self.shift
        token = [self.single[b] for b in piece]
        rank = [get(a << shift | b, NONE) for a, b in zip(token, token[1:])]
        rank.append(NONE)  # nothing follows the last byte
        heap = [r << 32 | i for i, r in enumerate(rank) if r != NONE]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        if n > LONG:  # numbers of 8 bytes instead of objects
            token, rank, after, before = (array("q", x) for x in (token, rank, after, before))
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            if rank[i] != r:
                continue  # one of the pair has been joined otherwise
            gone = after[i]
            j = after[i] = after[gone]
            token[i], rank[gone] = r, NONE
            if j < n:
                before[j] = i
                rank[i] = new = get(r << shift | token[j], NONE)
                if new != NONE:
                    heappush(heap, new << 32 | i)
            else:
                rank[i] = NONE
            h = before[i]
            if h >= 0:
                rank[h] = new = get(token[h] << shift | r, NONE)
                if new != NONE:
                    heappush(heap, new << 32 | h)
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out

    def missing(self, piece: bytes) -> array:
        """Ids of a pre-token that is not in the vocabulary; short ones are kept for when they come again, the latest asked for longest."""
        known = self.merged.get(piece)
        if known is None:
            known = self.older.get(piece)
            if known is None:
                known = array("i", self.merge(piece))
            if len(piece) <= SHORT:
                if len(self.merged) >= CACHE:
                    self.older, self.merged = self.merged, {}
                self.merged[piece] = known
        return known

    def lookup(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pre-tokens one after the other, and where each one's begin (one more at the end)."""
        data, edges = text_bytes(pieces)
        key = self.vocabulary.hash.find(data, edges[:-1], edges[1:])
        missed = np.flatnonzero(key < 0)
        raw = data.tobytes()
        merged, sizes = array("i"), np.ones(len(key), dtype=np.int64)
        for i, a, b in zip(missed.tolist(), edges[missed].tolist(), edges[missed + 1].tolist()):
            own = self.missing(raw[a:b])
            merged.extend(own)
            sizes[i] = len(own)
        starts = np.zeros(len(key) + 1, dtype=np.int64)
        np.cumsum(sizes, out=starts[1:])
        whole = np.repeat(key >= 0, sizes)
        ids = np.empty(starts[-1], dtype=np.int64)
        ids[whole] = self.vocabulary.ids[key[key >= 0]]
        ids[~whole] = np.frombuffer(merged, dtype=np.int32) if merged else 0
        return ids, starts

    def _split(self, texts: list[str | None]) -> Iterator[tuple[list[str], list[int]]]:
        """Pre-tokens of texts in order, AT_ONCE at a time, with how many of them each text has there, text by text."""
        held: list[str] = []
        counts: list[int] = []
        for text in texts:
            text = text or ""
            # No more pre-tokens than characters: those of a longer text are not listed whole.
            found = iter(self.pattern.findall(text)) if len(text) <= AT_ONCE else map(GROUP, self.pattern.finditer(text))
            while True:
                part = list(islice(found, AT_ONCE - len(held)))
                held += part
                if len(held) < AT_ONCE:
                    counts.append(len(part))
                    break
                yield held, [*counts, len(part), -1]  # -1: the last text goes on
                held, counts = [], []
        yield held, counts

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin (one more at the end)."""
        out, sizes, open_ = [], [], 0
        for pieces, counts in self._split(texts):
            coded = pa.array(pieces, pa.large_string()).dictionary_encode()
            ids, starts = self.lookup(coded.dictionary)
            at = coded.indices.to_numpy().astype(np.int64)
            flat, edges = _concat(ids, starts[at], starts[at + 1])
            goes_on = counts[-1:] == [-1]
            ends = np.cumsum([0, *(counts[:-1] if goes_on else counts)])
            per_text = np.diff(edges[ends]).tolist()
            if per_text:
                per_text[0] += open_
                open_ = per_text.pop() if goes_on else 0
            sizes += per_text
            out.append(flat)
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(sizes, out=bounds[1:])
        return np.concatenate(out), bounds


_coders: dict[str, Encoder] = {}


def _coder(words: Vocabulary) -> Encoder:
    """The encoder of this worker process, with what it has merged in earlier tasks; one vocabulary at a time."""
    if words.digest not in _coders:
        _coders.clear()
        _coders[words.digest] = Encoder(words)
    return _coders[words.digest]


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary.from_file(path, pattern)


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values from their bytes one after the other."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with `text` replaced by `ids`: the token ids as little-endian unsigned 32-bit numbers.

    `path` names a file of ranks (a token in base 64 and its rank in each line), read once by the driver; it travels with
    the tasks, as its size is the vocabulary's and not the data's. `pattern` cuts a text into pre-tokens, which are
    encoded apart; no special token is known. A null or empty text has no ids. A column `ids` gives way; other columns are
    kept, and rows that repeat are encoded each. Memory is that of one text, or of 2 MB of shorter ones, and of its
    longest pre-token's links.
    """
    words, keep = vocabulary(path, pattern), [c for c in docs.columns if c not in (text, "ids")]
    shape = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(words)
        for batch in batches:
            for piece in slices(batch, text, TEXTS):
                ids, bounds = coder(piece.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), _binary(ids.astype("<u4").view(np.uint8), 4 * bounds)], [*keep, "ids"])

    return docs.select(*keep, text).mapInArrow(run, f"{shape}, ids binary" if shape else "ids binary")


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """rows with the column `decoded` added: the bytes that `ids` (as `encode` gives them) stand for; null for null.

    A column `decoded` gives way. An id that is not in the vocabulary is an error.
    """
    words, keep = vocabulary(path, pattern), [c for c in rows.columns if c != "decoded"]
    shape = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c in keep) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "ids", TEXTS):
                data, bounds = text_bytes(piece.column("ids"))
                out, edges = words.decode(np.frombuffer(data.tobytes(), "<u4").astype(np.int64))
                column = _binary(out, edges[bounds // 4])
                if piece.column("ids").null_count:
                    column = pc.if_else(piece.column("ids").is_valid(), column, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), column], [*keep, "decoded"])

    return rows.select(*keep).mapInArrow(run, shape)
