"""Best-fit packing of token sequences by exact-complement hashing.

Documents are tokenised once. The lengths that remain below the capacity form a histogram of at most `capacity`
numbers, however large the corpus is; the packing is planned on that histogram and each piece then finds its own
place from its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import settle, slices, tidy

#: Pieces of one length are ranked in parts of about so many, so that no length is one task's alone.
PART_ROWS = 200_000
#: White space besides the plain space; a space before any of these does not begin a token of its own.
OTHER_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0                　"
CACHE = 300_000


class _Pieces(dict):
    """Token ids, as little-endian bytes, of what stands between spaces. Bounded: emptied when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encode(" " + piece), dtype="<u4").tobytes()
        if len(self) >= CACHE:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Encoder:
    """The ids that `Tokenizer.from_file(path).encode(text, add_special_tokens=False)` gives, as bytes.

    The vocabulary's pattern lets a token begin with one space and never lets a space that precedes other text join
    what is before it, so a text may be cut at each such space and the parts encoded apart, from a cache. Texts with
    unusual white space are encoded whole, and those that hold a special token by the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        ranks = Path(path).with_suffix(".tiktoken")
        self.fast = self._fast(ranks) if ranks.exists() else None
        self.pieces = _Pieces(self.fast)

    @staticmethod
    def _fast(ranks: Path):
        import public_tokenizers
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.open("rb"))}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if "  " in text or text[-1] == " " or any(" " + s in text for s in (OTHER_SPACE[:9] if text.isascii() else OTHER_SPACE)):
            return np.array(self.fast(text), dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        head = np.array(self.fast(first), dtype="<u4").tobytes() if first else b""
        return head + b"".join(map(self.pieces.__getitem__, rest))


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(ids: bytes, capacity: int, end_id: int) -> list[tuple[int, int, bytes]]:
    """(start, length, ids) of the pieces of one document; only the first may be shorter than the capacity."""
    ids += int(end_id).to_bytes(4, "little")
    n = len(ids) // 4
    if n <= capacity:
        return [(0, n, ids)]
    first = n % capacity
    edges = [0, *range(first or capacity, n + 1, capacity)]
    return [(a, b - a, ids[4 * a : 4 * b]) for a, b in zip(edges, edges[1:])]


def tokenize(docs: DataFrame, path: str, capacity: int, end_id: int = 0, with_ids: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece: doc_id, the columns to carry, piece, start, length, ids_crc32 (and ids)."""
    own = ["doc_id", *carry]
    kinds = dict(docs.dtypes)
    shape = "".join(f"`{c}` {kinds[c]}, " for c in own) + "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            for some in slices(batch, "text"):  # ids of 4 MB of text are held at once, or of one longer text
                rows = [(k, i, a, n, zlib.crc32(x), x) for k, text in enumerate(some.column("text").to_pylist()) for i, (a, n, x) in enumerate(cut(encode(text or ""), capacity, end_id))]
                cols = list(zip(*rows)) or [[]] * 6
                row = pa.array(cols[0], pa.int64())
                arrays = [*(some.column(c).take(row) for c in own), pa.array(cols[1], pa.int32()), *(pa.array(cols[j], pa.int64()) for j in (2, 3, 4))]
                names = [*own, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    ends = np.cumsum([0, *cols[3]], dtype=np.int32)
                    arrays.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(cols[5]), "<i4"))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)
        tidy()

    return docs.select(*own, "text").mapInArrow(run, shape)


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths, how many alike): exact complements by one, two or three lengths, then best fit for the rest."""
    left = [int(x) for x in counts]
    out: list[tuple[tuple[int, ...], int]] = []
    held = sum(1 << n for n in range(1, capacity + 1) if left[n])
    turned = sum(1 << (capacity - n) for n in range(1, capacity + 1) if left[n])

    def take(lengths: tuple[int, ...]) -> int:
        nonlocal held, turned
        times = min(left[n] // lengths.count(n) for n in set(lengths))
        if times:
            out.append((tuple(sorted(lengths, reverse=True)), times))
            for n in lengths:
                left[n] -= times
            for n in set(lengths):
                if not left[n]:
                    held &= ~(1 << n)
                    turned &= ~(1 << (capacity - n))
        return times

    def pairs(total: int):
        """Lengths a <= total / 2 with total - a at hand too, largest first."""
        both = held & (turned >> (capacity - total)) & ((1 << (total // 2 + 1)) - 1) if total > 1 else 0
        while both:
            a = both.bit_length() - 1
            both ^= 1 << a
            yield a, total - a

    take((capacity,))
    for n in range(capacity - 1, 0, -1):
        gap = capacity - n
        if left[n]:
            take((n, gap))
        for a, b in list(pairs(gap)) if left[n] else ():
            take((n, a, b))
            if not left[n]:
                break
        if left[n]:
            rest = held & ((1 << max(gap - 1, 0)) - 1)
            while rest and left[n]:
                a = rest.bit_length() - 1
                rest ^= 1 << a
                if 3 * a < gap:
                    break
                for b, c in list(pairs(gap - a)):
                    if c <= a:
                        take((n, a, b, c))
                    if not left[n] or not left[a]:
                        break
    bins: dict[int, list[list]] = {}
    room = 0  # bit r: there are bins with r left
    for n in range(capacity, 0, -1):
        while left[n]:
            fits = room >> n
            if fits:
                r = n + (fits & -fits).bit_length() - 1
                lengths, have = bins[r].pop()
                times = min(have, left[n])
                if have > times:
                    bins[r].append([lengths, have - times])
                if not bins[r]:
                    room &= ~(1 << r)
                lengths = (*lengths, n)
            else:
                r, lengths, times = capacity, (n,), left[n]
                each = capacity // n
                if each > 1 and times >= each:
                    lengths, times = (n,) * each, times // each
            left[n] -= times * (len(lengths) if not fits else 1)
            r -= n * (len(lengths) if not fits else 1)
            if r:
                bins.setdefault(r, []).append([lengths, times])
                room |= 1 << r
            else:
                out.append((lengths, times))
    return out + [(tuple(b[0]), b[1]) for kind in bins.values() for b in kind]


def _places(bins: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """For each length, runs of ranks and where their pieces go: key (length, first rank), first sequence, pieces a sequence, offset."""
    seen, base, rows = np.zeros(capacity + 1, dtype=np.int64), 0, []
    for lengths, times in bins:
        at = 0
        for n in sorted(set(lengths), reverse=True):
            each = lengths.count(n)
            rows.append(((n << 44) + int(seen[n]), base, each, at))
            seen[n] += each * times
            at += n * each
        base += times
    rows.sort()
    return tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


def best_fit_pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most `capacity` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, the columns to carry, and
    ids where asked for. A piece of full length is a sequence of its own, numbered below 0 without any ranking; others find their place from
    the plan. A null or empty text is the end id alone. Rows that repeat a doc_id are packed as documents of their own;
    a null doc_id stays null. Other columns are ignored. An empty table gives no rows. `path` is the tokenizer's file.
    """
    pieces = settle(tokenize(docs, path, capacity, end_id, with_ids, carry))
    alone = pieces.filter(F.col("length") == capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.filter(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for n, rows in rest.groupBy("length").agg(F.count("*")).collect():  # at most capacity rows
        counts[n] = rows
    parts = np.maximum(1, -(-counts // PART_ROWS))
    first = np.cumsum(parts) - parts  # the number of a length's first part among all parts
    many = F.element_at(F.array(*(F.lit(int(p)) for p in parts)), (F.col("length") + 1).cast("int"))
    dealt = rest.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), many.cast("long")).cast("int"))
    sizes = np.zeros(int(parts.sum()), dtype=np.int64)
    if (parts > 1).any():  # one number for PART_ROWS pieces
        for n, p, rows in dealt.groupBy("length", "part").agg(F.count("*")).collect():
            sizes[first[n] + p] = rows
    else:
        sizes[first] = counts
    before = np.cumsum(sizes) - sizes
    before -= np.repeat(before[first], parts)
    places = _places(plan(counts, capacity), capacity)
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")))
    keep = pieces.columns
    shape = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, base, each, at = places
        for batch in batches:
            n, p, r = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "part", "rank"))
            rank = before[first[n] + p] + r - 1
            i = np.searchsorted(key, (n << 44) + rank, side="right") - 1
            nth = rank - (key[i] & ((1 << 44) - 1))
            new = [pa.array(base[i] + nth // each[i]), pa.array(at[i] + nth % each[i] * n)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new], [*keep, "sequence_id", "offset"])

    return ranked.mapInArrow(run, shape).unionByName(alone)


def sequences(pieces: DataFrame, own: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """sequence_id, ids, parts for packed pieces with ids: the token ids of a sequence in order of their offsets, and of
    each part its offset, length, piece and the columns `own`. A sequence has at most `capacity` ids, so no group is large.
    """
    part = F.struct("offset", "length", "piece", *own, "ids")
    held = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part), lambda a, b: a["offset"].cast("int") - b["offset"].cast("int")).alias("held"))
    shown = F.transform("held", lambda p: F.struct(p["offset"].alias("offset"), p["length"].alias("length"), p["piece"].alias("piece"), *(p[c].alias(c) for c in own)))
    return held.select("sequence_id", F.flatten(F.transform("held", lambda p: p["ids"])).alias("ids"), shown.alias("parts"))
