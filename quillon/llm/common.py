"""Shared pieces: durable intermediate tables and vectorised word and hash primitives over Arrow text."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, LF, VT, FF and CR.
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

U64 = np.uint64
_rng = np.random.default_rng(20240607)
#: A random 64-bit value for each byte, and two odd multipliers with their inverses modulo 2**64.
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
BASES = tuple(int(x) | 1 for x in _rng.integers(2**40, 2**63, 2))
INVERSES = tuple(pow(b, -1, 2**64) for b in BASES)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where it is unset and one machine does all the work."""
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(spark, "_quillon_dir", None)
    if own is None:
        own = spark._quillon_dir = "file://" + tempfile.mkdtemp(prefix="quillon-")
    return own


def settle(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: lineage is cut, and a lost executor costs only a reread."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillon-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._quillon_path = path
    return out


def discard(*settled: DataFrame) -> None:
    """Delete settled tables that nothing will read any more."""
    for df in settled:
        spark, path = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._quillon_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(lines: Column, gone: Column) -> Column:
    """An array of lines without those whose numbers (from 0) are in `gone`, a sorted array without repeats; linear in both.

    `lines` should be a column of its own, as it is read once for each stretch that stays.
    """
    before, after = F.concat(F.array(F.lit(-1)), gone), F.concat(gone, F.array(F.size(lines)))
    return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def partitions(spark: SparkSession) -> int:
    """How many ways to deal rows: what the cluster has set for shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on every input bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(29))
    x = x * U64(0xFF51AFD7ED558CCD)
    return x ^ (x >> U64(32))


class Powers:
    """Powers of a base modulo 2**64, from two small tables."""

    def __init__(self, base: int):
        self.low = self._table(base, 4096)
        self.high = self._table(pow(base, 4096, 2**64), 65536)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=U64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def __call__(self, at: np.ndarray) -> np.ndarray:
        return self.low[at & 4095] * self.high[at >> 12]

    def first(self, n: int) -> np.ndarray:
        rows = -(-n // 4096)
        return (self.high[:rows, None] * self.low[None, :]).reshape(-1)[:n]


POWERS = tuple(Powers(b) for b in BASES)
UNPOWERS = tuple(Powers(b) for b in INVERSES)


def prefix_hash(codes: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums of codes[i] * base**i; at most 2**28 codes at once."""
    out = np.zeros(len(codes) + 1, dtype=U64)
    np.cumsum(codes * POWERS[which].first(len(codes)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """The hash of codes[start:end], the same wherever the codes stand."""
    return (prefix[end] - prefix[start]) * UNPOWERS[which](start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins (one more at the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    column = column.fill_null(b"") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the index of its first word (one more at the end)."""
    if len(buf) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z made lower case, all other bytes as they are."""
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf)


def word_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word."""
    return mix(span_hash(prefix_hash(BYTE_CODE[buf]), starts, ends) + (ends - starts).astype(U64))


def slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20):
    """Cut a batch into pieces of whole rows with about limit bytes of text each (a longer text stays whole)."""
    sizes = np.diff(text_bytes(batch.column(text))[1])
    at = 0
    while at < len(sizes):
        total = np.cumsum(sizes[at:])
        n = max(1, int(np.searchsorted(total, limit, side="right")))
        yield batch.slice(at, n)
        at += n


def tidy() -> None:
    """Give back what Arrow holds in reserve: a worker process stays, with that, beside the JVM through stages without Python."""
    pa.default_memory_pool().release_unused()


def match(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys match each other; the keys appear once, from the left."""
    renamed = right.withColumnsRenamed({k: f"#right_{k}" for k in on})
    condition = None
    for k in on:
        same = left[k].eqNullSafe(renamed[f"#right_{k}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*(f"#right_{k}" for k in on))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_quillon_shipped", False):
        return
    import shutil
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='quillon-')}/quillon", "zip", root, "quillon")
    context.addPyFile(archive)
    context._quillon_shipped = True
