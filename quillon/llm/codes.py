"""Vector code compression: product codes of eight parts, their codebooks fitted on all vectors in integer arithmetic.

The vectors become columnar blocks of integers, written once. Each round is one treeAggregate over those blocks: in a task
the distances of a whole block to a codebook grow dimension by dimension, np.add.at adds the block to tensors of sums and
counts, and these tensors, whose size depends on the codebooks alone, are merged through a tree of tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import discard, match, settle

#: Vectors of a block.
BLOCK = 4096
#: The largest result of a row; what is larger is given as this.
MOST = 2**63 - 1


@dataclass(frozen=True)
class Codebooks:
    """entries[part][entry][position]; `kind` holds components, `wide` sums of squared differences without overflow."""

    entries: np.ndarray
    kind: np.dtype
    wide: np.dtype

    @property
    def digest(self) -> str:
        """All entries' decimal components by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def finite(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _type(limit: int) -> np.dtype:
    """The narrowest type for whole numbers up to a limit; Python's own beyond 64 bits."""
    return next((np.dtype(t) for t in (np.int16, np.int32, np.int64) if limit <= np.iinfo(t).max), np.dtype(object))


def _floor(x: np.ndarray, scale: int, kind: np.dtype) -> np.ndarray:
    if kind == object:
        return np.array([math.floor(Fraction(v) * scale) for v in x.tolist()], dtype=object)
    return np.floor(x * scale).astype(kind)


def _columns(vectors: pa.Array, dim: int, scale: int, kind: np.dtype) -> np.ndarray:
    """(dim, rows) of whole numbers, one row of the block for each dimension; shorter vectors are filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = _floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), scale, kind)
    out = np.zeros((len(vectors), dim), dtype=kind)
    out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return out.T


def _nearest(block: np.ndarray, book: np.ndarray, wide: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """For each vector's part the nearest entry (the lower of two as near) and its squared distance."""
    far = np.zeros((len(book), block.shape[1]), dtype=wide)
    for column, values in zip(block, book.T):
        apart = column.astype(wide)[None, :] - values.astype(wide)[:, None]
        far += apart * apart
    best = far.argmin(axis=0) if block.shape[1] else np.zeros(0, np.int64)
    return best, far[best, np.arange(block.shape[1])]


def _tensors(books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Sums by part, position and entry, and counts by part and entry."""
    parts, entries, width = books.entries.shape
    return np.zeros((parts, width, entries), dtype=books.entries.dtype), np.zeros((parts, entries), dtype=np.int64)


def _add(books: Codebooks, dim: int):
    """Add a block to the tensors of sums and counts."""
    parts, _, width = books.entries.shape

    def run(held: tuple[np.ndarray, np.ndarray], row) -> tuple[np.ndarray, np.ndarray]:
        sums, counts = held
        block = _unpack(row, dim, books.kind)
        for part in range(parts):
            own = block[part * width : (part + 1) * width]
            best, _ = _nearest(own, books.entries[part], books.wide)
            np.add.at(counts[part], best, 1)
            for total, column in zip(sums[part], own):
                np.add.at(total, best, column.astype(sums.dtype))
        return sums, counts

    return run


def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] + b[0], a[1] + b[1]


def _unpack(row, dim: int, kind: np.dtype) -> np.ndarray:
    if kind == object:
        out = np.array([int(x) for x in bytes(row.cells).decode().split(",") if x], dtype=object)
        return out.reshape(dim, row.n)
    return np.frombuffer(row.cells, dtype=kind).reshape(dim, row.n)


def _blocks(dim: int, scale: int, kind: np.dtype):
    """Blocks of at most BLOCK vectors, as the bytes of their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                cells = _columns(batch.column("vector").slice(at, BLOCK), dim, scale, kind)
                data = ",".join(map(str, cells.ravel().tolist())).encode() if kind == object else np.ascontiguousarray(cells).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([cells.shape[1]], pa.int32()), pa.array([data], pa.binary())], ["n", "cells"])

    return run


def _assign(books: Codebooks, dim: int, scale: int, keep: list[str]):
    """The code of each vector and its squared distance, summed over parts."""
    parts, _, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                piece = batch.slice(at, BLOCK)
                block = _columns(piece.column("vector"), dim, scale, books.kind)
                best, apart = zip(*(_nearest(block[k * width : (k + 1) * width], books.entries[k], books.wide) for k in range(parts)))
                codes = np.stack(best, axis=1).astype(np.uint8)
                errors = np.minimum(sum(a.astype(np.int64 if a.dtype != object else object) for a in apart), MOST).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors)], [*keep, "code", "error"])

    return run


def fit(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codebooks | None:
    """Codebooks for rows (vec_id, vector) without null or non-finite components; None for a table without rows.

    The codebook of each part begins as that part of the rows with the smallest vec_ids (ties by the vector, null ids
    last), fewer where there are fewer rows. A round takes each part to its nearest entry and then each entry to the
    floor of its parts' mean; entries that no part is nearest to stay.
    """
    facts = rows.agg(F.max(F.size("vector")).alias("size"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("most")).first()
    if facts["size"] is None:
        return None
    dim = -(-facts["size"] // parts) * parts
    width = dim // parts
    limit = (int(facts["most"] or 0) + 1) * scale
    kind, wide = _type(limit), _type(4 * limit * limit * max(1, dim))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow().column("vector")
    start = np.ascontiguousarray(_columns(first, dim, scale, kind).T).reshape(len(first), parts, width).transpose(1, 0, 2)
    books = Codebooks(start.astype(np.int64 if kind != object else object), kind, wide)
    blocks = settle(rows.select("vector").mapInArrow(_blocks(dim, scale, kind), "n int, cells binary"))
    for _ in range(rounds):
        sums, counts = blocks.rdd.treeAggregate(_tensors(books), _add(books, dim), _merge)
        used = counts > 0
        after = books.entries.copy()
        after[used] = sums.transpose(0, 2, 1)[used] // counts[used][:, None]
        books = Codebooks(after, kind, wide)
    discard(blocks)
    return books


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for each row of vectors (vec_id, embedding, label) that can be coded.

    A component x counts as floor(scale * x). `code` has two hex digits for each part: the nearest entry, the lower index
    of two as near. `error` is the squared distance to the coded vector, `label_error` the sum of errors over equal labels
    (nulls are equal); both are given as 2**63 - 1 where they are larger.
    Rows are dropped whose vector is null or holds a null or non-finite component. Vectors that are shorter than the
    longest, or whose length is no multiple of `parts`, are filled up with zeros; an empty vector is all zeros.
    Rows that repeat a vec_id count each; other columns are ignored. An empty table gives no rows.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vector")).filter(finite(F.col("vector")))
    books = fit(rows, parts, entries, rounds, scale)
    shape = f"vec_id {dict(rows.dtypes)['vec_id']}, label {dict(rows.dtypes)['label']}, code string, error long"
    if books is None:
        return rows.sparkSession.createDataFrame([], f"vec_id {dict(rows.dtypes)['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    dim = books.entries.shape[0] * books.entries.shape[2]
    coded = settle(rows.mapInArrow(_assign(books, dim, scale, ["vec_id", "label"]), shape))
    summed = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST)).cast("long").alias("label_error"))
    return match(coded, summed, ["label"], "left").select("vec_id", "code", "error", "label_error", F.lit(books.digest).alias("codebooks_sha256"))
